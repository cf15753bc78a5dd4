"""Classifiers, personal data, mixing and the pipeline's stages."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import mixing, pii, quality, toxicity
from rollcall.llm.common import held_out


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# --- mixing ---


def targets_by_hand(sizes, weights=(1, 2, 3), most=3):
    names = sorted([n for n in sizes if n is not None]) + ([None] if None in sizes else [])
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[n] for n in capped)
        opened = sum(weight[n] for n in names if n not in capped)
        target = {n: most * sizes[n] if n in capped else weight[n] * rest / opened for n in names}
        new = {n for n in names if n not in capped and target[n] > most * sizes[n]}
        if not new:
            return target
        capped |= new


def test_mix_meets_every_budget(spark):
    rng = random.Random(1)
    data = []
    for i in range(400):
        source = rng.choice(["a"] * 6 + ["b", "c", "é", "Z", None])
        data.append((i, " ".join("w" for _ in range(rng.randrange(0, 40))), source))
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    got = mixing.mix(docs).collect()
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = targets_by_hand(sizes)
    taken = {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
    assert taken == {s: int(t + 1e-9) for s, t in want.items()}
    again = mixing.mix(docs.repartition(7))
    assert rows(again, "doc_id", "taken") == sorted(((r["doc_id"], r["taken"]) for r in got), key=repr)


def test_mixed_documents_follow_the_plan(odd):
    plan = mixing.mix(odd)
    made = mixing.mix_documents(odd)
    assert made.columns == odd.columns
    words = made.select("source", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n"))
    got = {r[0]: r[1] for r in words.groupBy("source").agg(F.sum("n")).collect()}
    want = {r[0]: r[1] for r in plan.groupBy("source").agg(F.sum("taken")).collect() if r[1]}
    assert got == want


def test_mix_of_odd_rows_and_none(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == 14 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mix_documents(none).count() == 0


def test_equal_keys_share_what_is_left(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x")] * 3 + [(2, "a b c d e f g h", "y")], "doc_id bigint, text string, source string")
    got = mixing.mix(docs, weights=(1, 3)).collect()
    x = [r["taken"] for r in got if r["source"] == "x"]
    assert x == [1, 1, 1] and sum(r["taken"] for r in got if r["source"] == "y") == 15


# --- toxicity ---


def best_segments(scores):
    """Maximal segments by their definition, from the best segment outwards."""
    found = []

    def split(lo, hi):
        best = None
        for i in range(lo, hi):
            for j in range(i + 1, hi + 1):
                total = round(sum(scores[i:j]), 9)
                if total > 0 and (best is None or total > best[0] or (total == best[0] and j - i < best[2] - best[1])):
                    best = (total, i, j)
        if best:
            found.append((best[1], best[2], best[0]))
            split(lo, best[1])
            split(best[2], hi)

    split(0, len(scores))
    return sorted(found)


def test_segments_are_the_maximal_ones():
    rng = random.Random(2)
    for _ in range(60):
        scores = [rng.uniform(-2, 2) for _ in range(rng.randrange(0, 18))]
        got = sorted((a, b, round(s, 9)) for a, b, s in toxicity.segments(np.array(scores)))
        want = best_segments(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_toxicity_learns_words_and_stems(spark):
    rng = random.Random(3)
    plain = [f"{a}{b}" for a in ("an", "the", "or", "in") for b in ("", "re", "st", "ly", "ble")]
    data, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words[rng.randrange(60)] = rng.choice(["vilest", "grumpf" + rng.choice(["", "ig", "er", "en", "est"])])
        data.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = toxicity.score(docs, model).join(docs, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    right = [(r["score"] >= 0.5) == (r["doc_id"] % 6 == 0) for r in got]
    assert len(got) > 60 and np.mean(right) > 0.97
    for r in got:
        for p in r["passages"]:
            assert re.search("vilest|grumpf", r["text"][p["start"] : p["end"]])


def test_toxicity_of_odd_rows_and_none(odd, none, odd_labels):
    got = toxicity.score(odd, toxicity.learn(odd, odd_labels)).collect()
    assert len(got) == 14 and all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1
    empty = toxicity.learn(none, odd_labels.limit(0))
    assert toxicity.score(none, empty).count() == 0
    assert {r["score"] for r in toxicity.score(odd, empty).collect()} == {0.5}


# --- quality ---


def test_quality_learns_bytes(spark):
    rng = random.Random(4)
    data, labels = [], []
    for i in range(400):
        words = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randrange(5, 400))]
        bad = i % 5 == 0
        data.append((i, ("$$ " if bad else " ").join(words) + "."))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    model = quality.learn(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    got = quality.score(docs, model).filter(held_out(F.col("doc_id"))).collect()
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 5 != 0) for r in got]) > 0.95
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and 300 <= kept.count() <= 340


def test_chunks_cover_every_byte():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        parts = quality.chunks(text)
        places = {at * quality.STRIDE + j for at in range(len(parts)) for j in range(quality.CHUNK) if parts[at][j] != quality.PAD}
        assert places == set(range(n))


def test_quality_gradient_matches_differences():
    net = quality.Network(3)
    net.weight[:] = np.linspace(-1, 1, quality.FILTERS)
    part = np.concatenate([quality.chunks("some text " * 70), quality.chunks("more!! " * 20)])
    owner, label, scale = np.array([0] * (len(part) - 1) + [1]), np.array([1.0, 0.0], np.float32), np.ones(2, np.float32)

    def loss():
        total = 0
        for i in (0, 1):
            own = part[owner == i]
            z = float((net.features(own) / len(own) * net.weight).sum() + net.offset[0])
            p = 1 / (1 + np.exp(-z))
            total -= label[i] * np.log(p) + (1 - label[i]) * np.log(1 - p)
        return total

    table, bias, weight, offset = net.gradients(part, owner, label, scale)
    for array, grad, at in ((net.weight, weight, 2), (net.offset, offset, 0), (net.table, table, (1, ord("e"), 15))):
        old = array[at]
        array[at] = old + 1e-3
        up = loss()
        array[at] = old - 1e-3
        down = loss()
        array[at] = old
        assert grad[at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-3)


def test_quality_of_odd_rows_and_none(odd, none, odd_labels):
    model = quality.learn(odd, odd_labels)
    got = quality.score(odd, model).collect()
    assert len(got) == 14 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.learn(none, odd_labels) is None
    assert {r["score"] for r in quality.score(odd, None).collect()} == {0.5}
    assert quality.keep_good(none, model).count() == 0 and quality.keep_good(odd, None).count() == 14


# --- personal data ---

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_by_hand(text):
    found = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                found.append((m.start(), i, m.end()))
    return sorted(found)


def test_base_spans_match_the_patterns():
    rng = random.Random(5)
    pieces = ["a.b", "@", "x", "-", "1.2.3.4", "300.1.1.1", "4111111111111111", "+49 30 1234567", " ", ".", "9", "+", "(", ")",
              "joe@ex-ample.co.uk", "@@", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "00255.1.1.1", "é", "\n", "5"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        good, _ = pii.base_spans(text)
        assert sorted((s, k, e) for k, s, e in good) == base_by_hand(text), text


def test_long_runs_take_linear_time():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 300_000, "a@" * 150_000, "(" * 300_000, "+1" + "(" * 300_000):
        pii.candidates(run)


def test_loose_patterns_take_long_secrets_and_spaced_addresses():
    key = "eyJ" + "aB3x" * 75
    text = f"write to joe.doe [ at ] example [ dot ] com with token={key} or 'password: {key[:40]}' now"
    spans = {(k, text[a:b]) for k, a, b in pii.loose_spans(text)}
    assert spans == {(0, "joe.doe [ at ] example [ dot ] com"), (5, key), (5, key[:40])}
    at = text.index(f"{key} or")
    assert pii._decoded(pii.votes(text, 5, at, at + len(key), pii.NOTHING))[1][4] == pii.YES  # set off


def test_personal_data_of_odd_rows_and_none(odd, none):
    model = pii.learn(odd)
    got = {r["doc_id"]: r["spans"] for r in pii.find(odd, model).collect()}
    assert [s["kind"] for s in got[11]] == ["email", "phone", "ip"] and got[1] == [] and got[2] == []
    masked = {r["doc_id"]: r for r in pii.mask_documents(odd, model).collect()}
    assert masked[11]["text"] == "mail <EMAIL> or <PHONE> at <IP>" and masked[1]["text"] is None
    assert masked[7]["text"] == "word " * 60_000 and masked[7]["score"] == 0.5
    assert pii.find(none, pii.learn(none)).count() == 0 and pii.mask_documents(none).count() == 0


def test_overlapping_spans_are_masked_once():
    assert pii.masked("ab12cd", [(2, 1, 4, True), (3, 2, 5, True)]) == "a<CARD>d"


def test_unreliable_labelers_are_found_out():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.5
    cast = np.zeros((4000, pii.LABELERS), dtype=int)
    for j, right in enumerate((0.95, 0.9, 0.85, 0.6, 0.55)):
        agrees = rng.random(4000) < right
        cast[:, j] = np.where(truth == agrees, pii.YES, pii.NO)
    chance, posterior = pii.reliabilities(cast, np.ones(4000))
    assert ((posterior > 0.5) == truth).mean() > 0.95
    assert chance[1, 0, pii.YES] > chance[1, 3, pii.YES]


def test_digest_of_spans(spark, odd):
    found = pii.find(odd, pii.learn(odd)).filter("doc_id = 11")
    text = found.select(pii.joined(F.col("spans"))).first()[0]
    assert text == "email:5:24,phone:28:45,ip:49:59"
    assert hashlib.sha256(text.encode()).hexdigest() == found.select(F.sha2(pii.joined(F.col("spans")), 256)).first()[0]
