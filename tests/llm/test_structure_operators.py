"""Near copies, fingerprints, chat, neighbours, token files, packing, pipeline, queries."""

import os
import random
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import (
    chat, components, neighbours, order_minhash, packing, queries, simhash, token_files, tokens,
)
from rollcall.llm.common import hash_key, prefix_sums
from rollcall.operators.rank import rank_rows
from rollcall.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from tools.verify import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
NEEDS_TABLES = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
WORDS = [a + b for a in "ba be bi bo bu da de di do du".split() for b in "ra re ri ro ru na ne ni".split()]


def some_text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def near(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


# --- helpers and components ---


def test_prefix_sums_and_ranks(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([0, 0, 0, 1, 2]), rng.randrange(10)) for i in range(500)]
    df = spark.createDataFrame(data, "i bigint, g int, v bigint").select(
        "*", hash_key(F.col("i")).alias("key"), F.lit(7).cast("bigint").alias("slices")
    )
    got = prefix_sums(df, "g", "slices", "key", [F.col("i")], F.col("v"), "before").collect()
    for r in got:
        assert r["before"] == sum(x["v"] for x in got if x["g"] == r["g"] and x["key"] < r["key"])
    ranked = rank_rows(df.select("i"), [F.col("i").desc()], "at", "t").collect()
    assert all(r["at"] == 499 - r["i"] for r in ranked)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(80)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r["node"], r["component"]) for r in got} == {(x, root(x)) for x in parent if root(x) != x}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- SimHash ---


def bits_by_hand(text, size):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < size else [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, radius):
    ids, parent = list(prints), {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.fixture(scope="module")
def near_docs(spark):
    rng, data = random.Random(3), []
    for _ in range(40):
        base = some_text(rng, rng.randrange(3, 200))
        for k in range(rng.randrange(1, 8)):
            data.append((len(data), near(rng, base, k // 2)))
    base = some_text(rng, 400)  # a large group of near copies in a chain
    for _ in range(150):
        base = near(rng, base, 1)
        data.append((len(data), base))
    data += [(len(data), ""), (len(data) + 1, None), (len(data) + 2, "Once"), (len(data) + 3, "ONCE")]
    return data


@pytest.mark.parametrize("bucket_rows", [2048, 6])
def test_near_groups_are_exact(spark, near_docs, monkeypatch, bucket_rows):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket_rows)  # the small one divides buckets again and again
    docs = spark.createDataFrame(near_docs, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r for r in simhash.near_groups(docs).collect()}
    prints = {i: bits_by_hand(t, 3) for i, t in near_docs}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == groups_by_hand(prints, 3)


def test_near_copies_go_and_others_stay(spark):
    rng, data, home = random.Random(4), [], {}
    for g in range(60):
        base = some_text(rng, 300)
        for k in range(1 + g % 4):
            # one changed word breaks five of about 300 shingles
            home[len(data)] = g
            data.append((len(data), near(rng, base, k)))
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    kept = {r["doc_id"] for r in simhash.drop_near_copies(docs).collect()}
    assert kept == {min(i for i in home if home[i] == g) for g in range(60)}


def test_texts_less_alike_stay(spark):
    rng, base = random.Random(14), some_text(random.Random(15), 400)
    data = [(0, base), (1, near(rng, base, 30)), (2, "De " * 200 + some_text(rng, 30)), (3, "De " * 220 + some_text(rng, 30))]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert simhash.drop_near_copies(docs).count() == 4  # 30 changed words leave less than 0.8


def family(pairs, singles):
    """Texts of 300 shingles, 0.70 alike; each two of the first are 0.82 alike."""
    words = iter(f"w{i}" for i in range(10**7))
    take = lambda n: [next(words) for _ in range(n)]
    shared, data = take(251), []
    for _ in range(pairs):
        both = take(24)
        data += [" ".join(shared + both + take(29)) for _ in range(2)]
    return data + [" ".join(shared + take(53)) for _ in range(singles)]


def test_copies_inside_a_family_with_boilerplate(spark):
    docs = spark.createDataFrame(list(enumerate(family(100, 1800))), "doc_id bigint, text string").repartition(8)
    kept = {r["doc_id"] for r in simhash.drop_near_copies(docs).select("doc_id").collect()}
    assert kept == set(range(2000)) - set(range(1, 200, 2))


def test_copies_are_found_in_any_order_of_shingles(spark, monkeypatch):
    data = family(40, 20)
    tokens, n = np.unique(np.concatenate([simhash.shingle_set(t, 5) for t in data]), return_counts=True)
    # boilerplate counts as rarest, so that all texts stand under the same shingles
    monkeypatch.setattr(simhash, "common_shingles", lambda docs, size: (tokens[n < 3], np.full((n < 3).sum(), 9)))
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id bigint, text string")
    kept = {r["doc_id"] for r in simhash.drop_near_copies(docs).select("doc_id").collect()}
    assert kept == set(range(100)) - set(range(1, 80, 2))


def test_short_texts_at_the_limit_are_found(spark):
    data = []
    for i in range(200):  # 4 of 5 shingles are exactly 0.8; 3 of 4 are less
        words = [f"s{i}x{k}" for k in range(9)]
        data += [" ".join(words), " ".join(words[:8]), " ".join(f"t{i}x{k}" for k in range(8)), " ".join(f"t{i}x{k}" for k in range(7))]
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id bigint, text string")
    kept = {r["doc_id"] for r in simhash.drop_near_copies(docs).select("doc_id").collect()}
    assert kept == {i for i in range(800) if i % 4 != 1}


def test_repeated_ids_lose_only_copies(spark):
    rng = random.Random(23)
    a, b, c, d, e = (some_text(rng, 100) for _ in range(5))
    data = [(1, a), (5, a), (5, b), (7, c), (7, d), (7, d), (None, e), (None, e), (None, c), (None, None), (None, "")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    kept = [(r["doc_id"], r["text"] or "") for r in simhash.drop_near_copies(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (5, b), (7, c), (7, d), (None, e), (None, "")], key=str)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = some_text(random.Random(5), 3000)
    whole = simhash.fingerprint(text, 3, 2)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 255)
    assert (simhash.fingerprint(text, 3, 2) == whole).all() and int(whole[0]) == bits_by_hand(text, 3)


def test_near_groups_of_odd_rows_and_none(odd, none):
    got = {r["doc_id"]: r for r in simhash.near_groups(odd).collect()}
    assert len(simhash.near_groups(odd).collect()) == 14
    assert got[1]["component_id"] == got[2]["component_id"] == got[3]["component_id"] == 1
    assert got[4]["component_id"] == got[5]["component_id"] == got[6]["component_id"] == 4
    assert got[None]["component_id"] is None and len(got[None]["fingerprint"]) == 16
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["0", "1", "4", "7", "8", "9", "10", "11", "None"])
    assert simhash.near_groups(none).count() == 0 and simhash.drop_near_copies(none).count() == 0


# --- order MinHash ---


def test_likeness_follows_the_edits(spark):
    rng = random.Random(6)
    base = some_text(rng, 600)
    texts = [base, near(rng, base, 6), near(rng, base, 60), " ".join(base.split()[300:] + base.split()[:300]), some_text(rng, 600)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(order_minhash.fingerprint(F.col("text")).alias("fp"))
    prints = [r["fp"] for r in df.collect()]
    pairs = spark.createDataFrame([(prints[0], p) for p in prints], "a array<int>, b array<int>")
    same, few, many, moved, other = [r[0] for r in pairs.select(order_minhash.likeness(F.col("a"), F.col("b"))).collect()]
    assert same == 1 and same > few > many > other and 0.8 < few and other < 0.1
    assert moved < few  # the same k-mers in another order


def test_repeated_kmers_are_numbered(spark):
    texts = ["a b c " * 2, "a b c " * 9, "a b c " * 9, "a b c a b c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    prints = [r[0] for r in df.select(order_minhash.fingerprint(F.col("text"))).collect()]
    assert prints[1] == prints[2] and prints[0] == prints[3] and prints[0] != prints[1]
    assert len(prints[1]) > 3  # nine occurrences are nine k-mers, not one


def test_edits_against_hand(spark, odd, none):
    data = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=lambda d: (d[0] is None, -(d[0] or 0), d[1]))
    import hashlib

    got = {}
    for r in order_minhash.compare_edits(odd).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for (i, text), (_, after) in zip(data, data[1:] + data[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i][0]["n_chars"] == len(text)
        if i != 9:
            assert got[i][0]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert got[4][0]["fingerprint"] == got[5][0]["fingerprint"] and got[5][0]["near_next"] == 1
    assert got[2][0]["fingerprint"] == "" and got[3][0]["near_next"] == 1
    assert order_minhash.compare_edits(none).count() == 0


def test_next_document_over_many_slices(spark, monkeypatch):
    data = [(i * i, some_text(random.Random(i), 5)) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r["doc_id"]: r["next"]["text"] for r in order_minhash.with_next(docs).collect()}
    down = sorted(data, reverse=True)
    assert got == {a[0]: b[1] for a, b in zip(down, down[1:] + down[:1])}


# --- chat ---

TURNS = "conv_id bigint, turn bigint, role string, text string, example int, parts string"


def test_examples_and_read_back(spark):
    hard = ["", "<|im_end|>", "a\\b", "<\\|", "\\<|im_start|>x\n", "<", "|>", "<|", "\\\\<\\\\|"]
    data = [(1, k, "assistant" if k % 2 else "user", t, 0, "") for k, t in enumerate(hard)]
    data += [(2, 0, "system", None, 0, ""), (2, 0, "system", None, 0, ""), (3, None, "ro\nle", "x", 0, ""), (None, 1, None, "y", 0, ""),
             (4, 0, "assistant", "only", 0, "")]
    turns = spark.createDataFrame(data, TURNS)
    made = chat.examples(turns)
    each = made.select("conv_id", "example", chat.masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("m"),
                       chat.read_turns(F.col("formatted")).alias("t")).collect()
    one = sorted((r for r in each if r["conv_id"] == 1), key=lambda r: r["example"])
    assert [r["m"] for r in one] == [hard[1], hard[3], hard[5], hard[7], ""]
    assert [[t["text"] for t in r["t"]] for r in one] == [hard[:2], hard[:4], hard[:6], hard[:8], hard]
    odd_role = next(r for r in each if r["conv_id"] == 3)
    assert [tuple(t) for t in odd_role["t"]] == [("ro\nle", "x")] and odd_role["m"] == ""
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    assert {i: r["n_turns"] for i, r in got.items()} == {1: 9, 2: 2, 3: 1, None: 1, 4: 1}
    assert got[4]["loss_chars"] == 4 and got[1]["loss_chars"] == sum(map(len, hard[1::2]))
    assert chat.digests(chat.examples(spark.createDataFrame([], TURNS))).count() == 0


# --- neighbours ---


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(12, size=3000)] + 0.6 * rng.normal(size=(3000, 16))
    x[100:140] = x[100]  # copies
    data = [(i, x[i].tolist()) for i in range(3000)]
    got = neighbours.nearest(*(lambda v: (v, v.filter("vec_id % 20 = 0")))(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"))).collect()
    by, hit = {}, 0
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(range(0, 3000, 20))
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21)) and q not in {r["vec_id"] for r in found}
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        score = x @ x[q]
        score[q] = -np.inf
        assert [r["score"] for r in found] == pytest.approx([score[r["vec_id"]] for r in found], abs=1e-12)
        hit += len({r["vec_id"] for r in found} & set(np.lexsort((np.arange(3000), -score))[:20]))
    assert hit >= 0.9 * 20 * len(by)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0]), (None, [1.0, 1.0]), (20, [-1.0, 0.0]), (21, [1.0, 0.0]), (40, [0.0, 3.0])]
    v = spark.createDataFrame([(*d, 1, 2) for d in data], "vec_id bigint, embedding array<double>, t int, bucket int")
    got = neighbours.nearest(v, v.filter("vec_id % 20 = 0 or vec_id is null")).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert by[0] == [(21, 1.0), (1, 0.5), (40, 0.0), (20, -1.0)]
    assert by[20] == [(40, 0.0), (1, -0.5), (0, -1.0), (21, -1.0)] and set(by) == {0, 20, 40}
    assert neighbours.nearest(v.limit(0), v.limit(0)).count() == 0
    assert neighbours.nearest(v.filter("vec_id = 0"), v.filter("vec_id = 0")).count() == 0


# --- token files and packing ---


@pytest.fixture(scope="module")
def path():
    return tokens.default_path()


def ids_by_hand(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer(path):
    rng, coder = random.Random(8), tokens.Encoder(path)
    assert coder.by_units
    signs = list("abzABZ019 .,'\"!?-_\n\t\r\x0b\x0c\x1c\x85\xa0") + ["é", "É", "ß", "İ", "ſ", "ÿ", "×", "µ", "²", "½", "e\u0301", "漢", "😀", "\u2028",
             "'s", "'LL", "don't", "<|endoftext|>", "<|", "\x00", "ǅ", "Σ", "ς"]
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(0, 25)))
        whole = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == whole, repr(text)


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 32])
def test_bits_round_trip(width):
    ids = np.random.default_rng(9).integers(0, 2**width, 1001, dtype=np.uint64).astype("<u4")
    data = token_files.pack(ids, width)
    assert len(data) == -(-1001 * width // 8) and (token_files.unpack(data, width, 1001) == ids).all()


@pytest.mark.parametrize("width", [16, 17])
def test_file_random_access(tmp_path, monkeypatch, width):
    monkeypatch.setattr(token_files, "BLOCK", 64)
    rng = np.random.default_rng(10)
    docs = [(i if i else None, rng.integers(0, 49408, rng.integers(0, 200)).astype("<u4")) for i in range(30)]
    writer = token_files.FileWriter(str(tmp_path / "x.tok"), width)
    for i, ids in docs:
        writer.add(i, ids.tobytes())
    writer.finish()
    reader = token_files.FileReader(str(tmp_path / "x.tok"))
    everything = np.concatenate([ids for _, ids in docs])
    assert [(i, got.tolist()) for i, _, got in reader.documents()] == [(i, ids.tolist()) for i, ids in docs]
    for _ in range(50):
        a, b = sorted(rng.integers(0, len(everything) + 1, 2).tolist())
        assert (reader.ids(a, b) == everything[a:b]).all()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["x.tok"]


def test_token_files_of_odd_rows_and_none(spark, odd, none, path):
    files = token_files.write_token_files(odd, scratch_path(spark, "tokens"), path)
    got = token_files.read_token_files(files).collect()
    data = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=lambda d: (d[0] is not None, d[0] or 0))
    start, want = 0, []
    for i, text in data:
        ids = np.array([*ids_by_hand(path, text), 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    empty = token_files.write_token_files(none, scratch_path(spark, "tokens"), path)
    assert token_files.read_token_files(empty).count() == 0


def check_packing(got, texts, path, size):
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= size
    for i, text in texts.items():
        ids, at = np.array([*ids_by_hand(path, text), 2], "<u4"), 0
        for p in sorted((r for r in got if r["doc_id"] == i), key=lambda p: p["start"]):
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(part.tobytes())
            at += len(part)
        assert at == len(ids)
    return len(sequences)


def test_packing_places_every_id_once(spark, path):
    rng = random.Random(11)
    texts = {i: some_text(rng, int(rng.lognormvariate(3, 1))) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = packing.pack(docs, path, size=256, grain=4).collect()
    used = check_packing(got, texts, path, 256)
    total = sum(r["length"] for r in got)
    assert 1 - total / (used * 256) < 0.03
    again = packing.pack(docs.repartition(5), path, size=256, grain=4).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_packing_of_odd_rows_and_none(odd, none, path):
    got = packing.pack(odd, path).collect()
    texts = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] not in (9, None)}
    check_packing(got, texts, path, packing.SIZE)
    assert sum(r["doc_id"] == 9 for r in got) == 2
    assert packing.pack(none, path).count() == 0


def test_linear_program_reaches_the_bound():
    rng = np.random.default_rng(12)
    demand = np.bincount(rng.integers(1, 33, 5000), minlength=33)[1:33]
    bound = sum(x for _, x in packing.solve(demand, 32))
    assert bound >= (demand * np.arange(1, 33)).sum() / 32 - 1e-6
    made = packing.plan(demand, 32)
    assert sum((p * n for p, n in made)).tolist() == demand.tolist()
    assert all((p * np.arange(1, 33)).sum() <= 32 for p, _ in made)
    assert sum(n for _, n in made) <= bound + 4
    big = np.array([0] * 16 + [7] + [0] * 15)  # pieces of 17 of 32: one in each
    assert sum(n for _, n in packing.plan(big, 32)) == 7 and packing.plan(np.zeros(32, dtype=int), 32) == []


def test_knapsack_against_search():
    rng = np.random.default_rng(13)
    for _ in range(30):
        values, limits = rng.random(5), rng.integers(0, 4, 5)
        got = packing.price(values, limits, 9)
        best = max(
            (np.dot(c, values) for c in np.ndindex(*(limits + 1)) if np.dot(c, np.arange(1, 6)) <= 9), default=0
        )
        assert (got <= limits).all() and (got * np.arange(1, 6)).sum() <= 9 and (got * values).sum() == pytest.approx(best)


# --- pipeline and queries ---


def test_every_stage_takes_odd_rows_and_none(spark, odd, none, odd_labels, tmp_path):
    odd_labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            made = stage(spark, docs, str(tmp_path))
            if name != "packing":
                assert made.columns == docs.columns
            count = made.count()
            assert count == 0 if docs is none else count > 0


@NEEDS_TABLES
def test_pipeline_keeps_its_promises(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.keep_good(spark, docs, SF)
    assert 0.7 * docs.count() < good.count() <= docs.count()
    packed = corpus_pipeline.run(spark, SF).collect()
    per = {}
    for r in packed:
        per[r["sequence_id"]] = per.get(r["sequence_id"], 0) + r["length"]
    assert packed and max(per.values()) <= packing.SIZE


@NEEDS_TABLES
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_on_driver_tables(spark, name):
    df = queries.QUERIES[name](spark, SF)
    got = df.collect()
    assert got
    if name in ("op1_mix_sources", "op4_order_minhash", "op5_chat_examples"):
        plan = df._jdf.queryExecution().toString()
        assert not any(n in plan for n in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
    if name in queries.ORACLE:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        cur = con.execute(queries.ORACLE[name])
        columns = [d[0] for d in cur.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_of(df.columns, got) == rows_of(columns, cur.fetchall())


def test_the_pipeline_drops_by_fingerprints(spark):
    rng, data = random.Random(31), []
    for g in range(40):
        base = some_text(rng, 2000)
        data += [(3 * g, base), (3 * g + 1, base), (3 * g + 2, near(rng, base, 1 + g % 20))]
    docs = spark.createDataFrame([*data, (200, None), (201, ""), (None, data[0][1])], "doc_id bigint, text string").repartition(3)
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(docs).collect()}
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept) == sorted({c for c in groups.values() if c is not None}) and 41 < len(kept) < 81
