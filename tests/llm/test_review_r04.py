"""The pipeline's near-copy stage drops all that either of its two searches finds."""

import random

import numpy as np

import corpus_pipeline
from rollcall.llm import simhash


def some_text(rng, n):
    return " ".join(rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(n))


def test_the_stage_drops_what_fingerprints_miss(spark):
    rng, data = random.Random(41), []
    for _ in range(12):
        words = some_text(rng, 300).split()
        data.append(" ".join(words))
        for changed in (1, 4):  # of about 296 sets of five words 5 or 20 go
            near = list(words)
            for at in rng.sample(range(20, 280), changed):
                near[at] = f"new{rng.randrange(10**6)}"
            data.append(" ".join(near))
    docs = spark.createDataFrame([*enumerate(data), (50, None), (51, "")], "doc_id bigint, text string").repartition(3)
    (stage,) = [f for name, f in corpus_pipeline.STAGES if name == "near copies"]
    kept = {r["doc_id"] for r in stage(spark, docs, "").collect()}

    sets = [set(simhash.shingle_set(t, 5).tolist()) for t in data]
    prints = [int(simhash.fingerprint(t)[0]) for t in data]
    home = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            alike = len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            if alike or (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = home[i], home[j]
                home = [min(a, b) if h in (a, b) else h for h in home]
    assert kept == {*home, 50}
    assert kept < {r["doc_id"] for r in simhash.drop_fingerprint_copies(docs).collect()}


def test_sketches_never_part_alike_sets():
    rng = np.random.default_rng(5)
    for n in (1, 5, 63, 64, 70, 300, 1000, 5000):
        base = rng.integers(0, 2**64, n, dtype=np.uint64)
        for left in range(0, n // 5 + 1, max(1, n // 20)):
            one, other = np.unique(base), np.unique(base[: n - left])
            made = [simhash.sketch(one), simhash.sketch(other)]
            size = np.array([len(one), len(other)])
            for least in (0.8, 0.9):
                found = simhash.may_be_alike(made, size, np.array([0]), np.array([1]), least)[0]
                assert found or len(other) < least * len(one)
    far = [simhash.sketch(rng.integers(0, 2**64, 500, dtype=np.uint64)) for _ in range(20)]
    i, j = np.triu_indices(20, 1)
    assert not simhash.may_be_alike(far, np.full(20, 500), i, j, 0.8).any()
