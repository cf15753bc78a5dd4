"""Packing documents into fixed-length sequences by cutting-stock column generation.

A document's ids are cut into full sequences and a rest. The rests form a
histogram by length class (lengths rounded up to ``GRAIN``). A linear program over
patterns, the ways to fill a sequence with classes, covers the histogram with the
fewest sequences: a knapsack by dynamic programming prices new patterns from the
duals until none improves. Each pattern is then used as often as the histogram
allows, rounded down, best first; what is left over is a bounded number of pieces,
for which the same knapsack fills one sequence after the other.

Only the histogram, at most ``SIZE / GRAIN`` counts, reaches the driver. Pieces are
ranked within their class by distributed prefix sums, and rank alone tells sequence
and slot, so the plan is a small table of rank ranges whatever the corpus size.

Nulls and odd input: a missing or empty text is one piece with the end id alone; rows
that repeat an id are documents of their own; missing ids sort first among equal
keys; an empty table gives an empty result. Other columns are not read. No text is
too long: it is cut, and each id lies in exactly one piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import hash_key, prefix_sums, ship, slice_count
from rollcall.llm.tokens import encoder
from rollcall.session import materialize

SIZE = 4096
GRAIN = 16


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, size: int = SIZE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: full pieces and a rest of each document."""
    ship(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            rows, texts = [], batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                ids = coder.encode(texts[i].as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, size):
                    piece = ids[4 * start : 4 * (start + size)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, ", ".join(f"{n} bigint" for n in names)
    )


def price(values: np.ndarray, limits: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of classes 1..n (class c has size c) of most value that fit the capacity.

    Bounded knapsack: each class is offered in powers of two up to its limit.
    """
    best = np.zeros(capacity + 1)
    taken: list[tuple[int, int, np.ndarray]] = []
    for c in np.nonzero((values > 1e-12) & (limits > 0))[0]:
        left, many = min(int(limits[c]), capacity // (c + 1)), 1
        while left > 0:
            many = min(many, left)
            weight = many * (c + 1)
            if weight > capacity:
                break
            offer = best[: capacity + 1 - weight] + many * values[c]
            better = np.zeros(capacity + 1, dtype=bool)
            better[weight:] = offer > best[weight:] + 1e-12
            best[weight:] = np.where(better[weight:], offer, best[weight:])
            taken.append((c, many, better))
            left -= many
            many *= 2
    counts, room = np.zeros(len(values), dtype=np.int64), int(np.argmax(best))
    for c, many, better in reversed(taken):
        if better[room]:
            counts[c] += many
            room -= many * (c + 1)
    return counts


def inverted(columns: list[np.ndarray]) -> np.ndarray:
    """Inverse of a small matrix by Gauss-Jordan steps with row exchange.

    Plain array operations: the threads of a linear algebra library don't always
    survive the forks of a Spark driver.
    """
    a = np.stack(columns, axis=1).astype(float)
    n = len(a)
    a = np.concatenate([a, np.eye(n)], axis=1)
    for i in range(n):
        best = i + int(np.argmax(np.abs(a[i:, i])))
        a[[i, best]] = a[[best, i]]
        a[i] /= a[i, i]
        factor = a[:, i].copy()
        factor[i] = 0
        a -= factor[:, None] * a[i]
    return a[:, n:]


def solve(demand: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often the linear program uses them to cover the demand.

    Revised simplex: the basis starts with one-class patterns; each round the
    knapsack finds the pattern of most dual value, and the ratio test swaps it in.
    """
    classes = np.nonzero(demand)[0]
    if not len(classes):
        return []
    m = len(classes)
    need = demand[classes].astype(float)
    patterns = [np.eye(m, dtype=np.int64)[i] * (capacity // (c + 1)) for i, c in enumerate(classes)]
    inverse = np.diag([1.0 / p[i] for i, p in enumerate(patterns)])
    limits = np.zeros_like(demand)
    limits[classes] = capacity
    for step in range(rounds):
        use = (inverse * need).sum(axis=1)
        duals = inverse.sum(axis=0)  # every sequence costs 1
        values = np.zeros(len(demand))
        values[classes] = np.maximum(duals, 0)
        column = price(values, limits, capacity)[classes]
        if (column * duals).sum() <= 1 + 1e-9:
            break
        moved = (inverse * column).sum(axis=1)
        rise = moved > 1e-9
        ratio = np.where(rise, np.maximum(use, 0) / np.where(rise, moved, 1), np.inf)
        out = int(np.argmin(ratio))
        patterns[out] = column
        inverse[out] /= moved[out]
        moved[out] = 0
        inverse -= moved[:, None] * inverse[out]
        if step % 100 == 99:  # keep rounding errors from piling up
            inverse = inverted(patterns)
    use = np.maximum((inverse * need).sum(axis=1), 0)
    whole = []
    for p, x in zip(patterns, use, strict=True):
        full = np.zeros(len(demand), dtype=np.int64)
        full[classes] = p
        whole.append((full, float(x)))
    return whole


def plan(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and whole numbers of sequences that take every piece of the histogram once."""
    left, made = demand.astype(np.int64).copy(), []
    sizes = np.arange(1, len(left) + 1)
    for pattern, x in sorted(solve(left, capacity), key=lambda p: -int((p[0] * sizes).sum())):
        used = pattern > 0
        times = min(int(x + 1e-9), int((left[used] // pattern[used]).min())) if used.any() else 0
        if times:
            made.append((pattern, times))
            left -= times * pattern
    while left.any():
        # larger pieces count a little more, so that small ones are kept to fill gaps
        pattern = price(sizes + 1e-6 * sizes**2, left, capacity)
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        made.append((pattern, times))
        left -= times * pattern
    return made


def plan_rows(made: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """class, first rank, end rank, first sequence, pieces of the class in each, first slot there."""
    rows, used, sequence = [], {}, 0
    for pattern, times in made:
        slot = 0
        for c in np.nonzero(pattern)[0][::-1]:
            many, first = int(pattern[c]), used.get(int(c), 0)
            rows.append((int(c) + 1, first, first + many * times, sequence, many, slot))
            used[int(c)] = first + many * times
            slot += many
        sequence += times
    return rows


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = SIZE, grain: int = GRAIN
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Full pieces are the class of the whole sequence. A sequence's pieces lie from
    offset 0 without gaps; what is free at its end is padding.
    """
    spark = docs.sparkSession
    made = materialize(pieces_of(docs, tokenizer, end_id, size), "pieces")
    capacity = size // grain
    kind = F.ceil(F.col("length") / grain).cast("int")
    counts = {r["k"]: r["n"] for r in made.groupBy(kind.alias("k")).agg(F.count("*").alias("n")).collect()}
    demand = np.zeros(capacity, dtype=np.int64)
    for k, n in counts.items():
        demand[k - 1] = n
    schema = "class int, lo bigint, hi bigint, first bigint, many int, slot int"
    planned = spark.createDataFrame(plan_rows(plan(demand, capacity)), schema)
    sliced = spark.createDataFrame(sorted(counts.items()), "_class int, _n bigint").select(
        "_class", slice_count(F.col("_n")).alias("_slices")
    )
    keyed = made.select(
        "*", kind.alias("_kind"), hash_key(F.col("doc_id"), F.col("start"), seed=23).alias("_key")
    ).join(F.broadcast(sliced), F.col("_kind") == F.col("_class"))  # a row for each length class
    ranked = prefix_sums(
        keyed, "_kind", "_slices", "_key",
        [F.col("doc_id"), F.col("start"), F.col("ids_crc32"), F.col("doc_tokens")], F.lit(1), "_rank"
    )
    inside = (F.col("_kind") == F.col("class")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    at = F.col("_rank") - F.col("lo")
    placed = ranked.join(F.broadcast(planned), inside).select(  # a few rows for each length class
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.floor(at / F.col("many"))).cast("bigint").alias("sequence_id"),
        (F.col("slot") + at % F.col("many")).alias("_slot"),
    )
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("_slot")
