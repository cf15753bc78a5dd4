"""Dictionary tables and bitmap joins against brute force."""

import random

from pyspark.sql import functions as F

import rollcall.session as session
from rollcall.operators import bitmap as B
from rollcall.operators import dictionary as D
from rollcall.operators import match as M

TEXT = "doc_id int, text string"


def some_rows(rng):
    words = ["the", "cat", "catalog", "con", "a", "été", "x" * 700, "e-mail", "data\nbase", "", "Straße", "concat"]
    texts = [(i, " ".join(rng.choices(words, k=rng.randrange(12)))) for i in range(200)]
    texts += [(200, None), (201, ""), (202, " "), (203, "y" * 2000 + "needle" + "y" * 300)]
    entries = [" ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(60)]
    entries += [t[i : i + n] for _, t in texts[:60] if t for i, n in [(rng.randrange(len(t)), rng.choice([1, 2, 5, 14]))]]
    return texts, [*entries, "", " ", None, "needle", "x" * 300, "yneedley", "a ", " a", "e the c", "zz", "zz zz"]


def test_hits_equal_contains(spark, monkeypatch):
    rng = random.Random(2)
    texts, entries = some_rows(rng)
    df = spark.createDataFrame(texts, TEXT).repartition(3)
    words = spark.createDataFrame([(e,) for e in entries], "word string")
    want = {(i, e) for i, t in texts if t for e in entries if e and e.strip() and e in t}
    assert {tuple(r) for r in D.dictionary_hits(df, words, "doc_id").collect()} == want
    flags = {r["doc_id"]: r["matched"] for r in D.matches_any(df, words, "doc_id").collect()}
    assert flags == {i: any(i == j for j, _ in want) for i, _ in texts}
    # above the broadcast limit the bitmap goes first
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in D.dictionary_hits(df, words, "doc_id").collect()} == want


def test_no_entries_or_no_texts(spark):
    df = spark.createDataFrame([(1, "some text")], TEXT)
    none = spark.createDataFrame([], "word string")
    assert D.dictionary_hits(df, none, "doc_id").count() == 0
    assert [r["matched"] for r in D.matches_any(df, none, "doc_id").collect()] == [False]
    words = spark.createDataFrame([("some",), ("e t",)], "word string")
    assert D.dictionary_hits(df.limit(0), words, "doc_id").count() == 0


def test_bitmap_lets_all_partners_and_few_others_through(spark):
    keys = spark.range(0, 300_000, 3).select((F.col("id") * 7919).alias("k"))
    rows = spark.range(300_000).select((F.col("id") * 7919).alias("k"))
    words, bits = B.bitmap_of(keys, "k", keys.count())
    assert len(words.first()["words"]) == bits // 64
    passed = rows.filter(B.may_be_in(F.col("k"), words, bits))
    assert passed.join(keys, "k").count() == 100_000
    assert passed.count() < 2 * 100_000  # hits and false alarms
    assert "NestedLoop" not in passed._jdf.queryExecution().toString()


def test_pairs_are_the_same_above_the_broadcast_limit(spark, monkeypatch):
    rng = random.Random(5)
    names = ["".join(rng.choices("abcd", k=rng.randrange(3, 14))) for _ in range(400)]
    longs = spark.createDataFrame([(n,) for n in names], "long string")
    shorts = spark.createDataFrame([(n,) for n in names[:200]], "short string")
    texts = spark.createDataFrame([(i, " ".join(rng.choices(names, k=30))) for i in range(60)], TEXT)
    passages = texts.filter("doc_id < 20").select(
        F.col("doc_id").alias("item_id"), F.array_join(F.slice(F.split("text", " "), 3, 6), " ").alias("text")
    )

    def found():
        return (
            sorted(map(tuple, M.contained_names(longs, shorts).collect())),
            sorted(map(tuple, M.passages_in_texts(texts, passages, "doc_id", "item_id").collect())),
        )

    small = found()
    seen = []
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(B, "may_be_in", lambda *a, test=B.may_be_in: seen.append(a) or test(*a))
    assert found() == small and seen
    assert small[0] == sorted({(a, b) for a in names for b in names[:200] if len(b) > 4 and b in a})


def test_entries_of_one_space_make_no_candidates(spark, monkeypatch):
    """Units that very many entries and texts share cost nothing where no two neighbours are an entry."""
    rng = random.Random(9)
    ends, starts = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    texts = [(i, " ".join(f"x{rng.choice(ends)} {rng.choice(starts)}y" for _ in range(20))) for i in range(60)]
    texts += [(60, "a1  b1"), (61, " b1"), (62, "a1 "), (63, "été b1 a1 b2"), (64, None), (65, ""), (66, "xa1\tb1 b2y")]
    entries = [f"{e} {s}" for e in ends for s in starts if rng.random() < 0.5] + [" b1", "a1 ", "té b", "a1  b1", "y xa3"]
    seen = []
    monkeypatch.setattr(D, "broadcast_if_small", lambda df, label, of=D.broadcast_if_small: (
        seen.append(df.count()) if label == "candidates" else None, of(df, label))[1])
    df = spark.createDataFrame(texts, TEXT).repartition(3)
    words = spark.createDataFrame([(e,) for e in entries], "word string")
    want = {(i, e) for i, t in texts if t for e in entries if e in t}
    assert {tuple(r) for r in D.dictionary_hits(df, words, "doc_id").collect()} == want
    assert len(want) > 300 and seen and max(seen) < 100  # of the entry with two spaces only


def test_rows_that_share_an_id_count_each_for_entries_with_spaces(spark):
    rows = [(1, "a cat sat"), (1, "a cat sat"), (1, "no cat"), (2, "cat sat cat sat")]
    words = spark.createDataFrame([(e,) for e in ("cat", "cat sat", "a cat sat")], "word string")
    got = sorted(tuple(r) for r in D.dictionary_hits(spark.createDataFrame(rows, TEXT), words, "doc_id").collect())
    assert got == [(1, "a cat sat")] * 2 + [(1, "cat")] + [(1, "cat sat")] * 2 + [(2, "cat"), (2, "cat sat")]
