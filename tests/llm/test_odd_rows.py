"""Rows that once broke an operator or grew out of bounds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import labelled, mixing, neighbours, pii, quality, simhash, toxicity


def test_long_runs_of_digits_in_addresses():
    zeros = "0" * 10_000
    for text, spans in (
        (f"{zeros}.1.1.1", [(1, 0, 10_006)]), (f"{zeros}9.1.1.1", [(1, 0, 10_007)]), ("9" * 10_000 + ".1.1.1", []),
        (f"1.2.{zeros}256.3", []), (f"{zeros}.{zeros}.{zeros}.255", [(1, 0, 30_006)]),
    ):
        assert [s for s in pii.base_spans(text)[0] if s[0] == 1] == spans


def test_spelled_addresses_and_names_of_any_length():
    local, label, name = "a" * 90, "b" * 80, "A" + "n" * 60
    text = f"write {local} [at] {label} [dot] x.{label} [dot] c.d.e.org or Mr {name} {name}"
    found = [text[s:e] for _, s, e in pii.loose_spans(text)]
    assert any(f.startswith(f"{local} [at] {label}") for f in found) and f"Mr {name} {name}" in found
    text = f"mail {local} [ at ] {label} [dot] com today"
    assert [text[s:e] for k, s, e in pii.loose_spans(text) if k == 0] == [f"{local} [ at ] {label} [dot] com"]
    list(pii.loose_spans("a%" * 200_000 + " at] [at]"))  # in proportion to the text


VECTORS = "vec_id bigint, embedding array<double>"


@pytest.mark.parametrize("sizes", [(1e200,), (1e-200,), (1e200, 1.0, 1e-200), (1e308, 5e-324)])
def test_vectors_of_any_finite_size(spark, sizes):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.standard_normal(4) / 8 * sizes[i % len(sizes)]]) for i in range(60)]
    rows = [r for r in rows if any(r[1]) and np.isfinite(r[1]).all()]
    df = spark.createDataFrame(rows, VECTORS)
    got = {}
    for r in neighbours.nearest(df, df.filter("vec_id % 5 = 0"), 8).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))

    def score(x, y):
        with np.errstate(all="ignore"):
            total = np.float64(0)
            for a, b in zip(x, y):
                total = total + np.float64(a) * np.float64(b)
        return -np.inf if np.isnan(total) else float(total)

    found = 0
    for q, x in rows:
        if q % 5:
            continue
        least = sorted((score(x, y) for i, y in rows if i != q), reverse=True)[7]
        hits, lookup = sorted(got[q]), dict(rows)
        assert len(hits) == 8 and [r for r, _, _ in hits] == list(range(1, 9))
        assert all(s == score(x, lookup[i]) for _, i, s in hits)
        found += sum(s >= least for _, _, s in hits)
    assert found >= 0.9 * 8 * len(got)


def test_equal_sizes_are_found_as_before(spark):
    big = spark.createDataFrame([(i, [1e200 * (i + 1), 1.0]) for i in range(5)], VECTORS)
    got = neighbours.nearest(big, big, 2).collect()
    assert len(got) == 10 and all(r["score"] == float("inf") for r in got)


def test_one_id_with_many_texts_gives_each_once(spark):
    rows = [(7, f"text number {i}") for i in range(1000)] + [(8, "same")] * 500 + [(9, "other")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 1)], "doc_id bigint, toxic int")
    used = {r[0] for r in docs.select("doc_id").distinct().collect() if not _held_out(r[0])}
    texts = labelled.training_texts(docs, labelled.training_ids(docs, labels, "toxic")).collect()
    want = {t for i, t in rows if i in used}
    assert len(texts) == len(want) and {r["text"] for r in texts} == want


def _held_out(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_learners_take_a_hot_id(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["good", "fine", "bad", "vile", "thing"])
    docs = spark.createDataFrame([(7, " ".join(word() for _ in range(9)) + f" {i}") for i in range(300)] + [(3, "bad vile")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(7, 1, 0), (3, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs, labels)).count() == 301
    assert quality.score(docs, quality.learn(docs, labels)).count() == 301


def test_rows_without_an_id_spend_the_whole_budget(spark):
    rng = random.Random(5)
    rows = [(None, " ".join(["w"] * rng.choice([1, 2, 50])) + f" x{i}", "a") for i in range(55)]
    rows += [(i, "one two three", "b") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert r["taken"] == int(r["target"])
    mixed = mixing.mix_documents(docs, weights=(1, 9))
    assert mixed.filter("source = 'a'").count() > 0


def test_families_the_sample_misses_lose_no_pair(spark, monkeypatch):
    """A family of hundreds shares boilerplate that no sample shows as common; true pairs stand inside it."""
    monkeypatch.setattr(simhash, "COMMON", 1)
    rng = random.Random(11)
    shared = [f"s{i}" for i in range(70)]
    rows, pairs = [], []
    for i in range(150):
        own = [f"o{i}_{j}" for j in range(25)]
        rows.append((2 * i, " ".join(shared + own)))
        if i % 10 == 0:
            rows.append((2 * i + 1, " ".join(shared + own + [f"e{i}"])))
            pairs.append((2 * i, 2 * i + 1))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = {r["doc_id"] for r in simhash.drop_near_copies(docs).collect()}
    assert kept == {i for i, _ in rows} - {b for _, b in pairs}
