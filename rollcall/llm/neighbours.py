"""Nearest neighbours by largest inner product, with multiprobe p-stable hashing.

Largest inner product becomes smallest distance by one more coordinate that brings
all vectors to the same length. Every vector is indexed in ``TABLES`` hash tables: a
table has a few Gaussian projections, cut into cells of equal width, and the cells
together name the bucket. A query visits its own bucket and then perturbed ones, in
the order of the distance from the query to their cells, the least first, which is
the estimated order of success. Candidates of all tables are merged and ranked by the
inner product of the original vectors in double precision, summed left to right. The
k-th best score among the sample bounds a query's k-th best from below, so worse
candidates are not passed on.

The number of projections follows the number of vectors, so that buckets keep about
``BUCKET_ROWS`` rows. Width and number of probes are fitted on at most ``SAMPLE``
vectors (in hash order): the probes are as many as find ``TARGET`` of the sample
queries' neighbours. All vectors are indexed. A bucket is searched in blocks of rows
against blocks of queries, so a bucket with very many vectors is many tasks. A query
that finds fewer neighbours than it should have is compared with all vectors, in
blocks too.

Nulls and odd input: vectors that are null, zero, of another length than most, or
hold a null or non-finite component take no part, nor do rows without an id; finite
components of any size do, and a score beyond what a double holds is infinite (lowest, if
its parts overflow to both sides); rows
that repeat an id are one candidate, with the better score, and a query that repeats
is one query, with its best scores; an empty table gives an empty result. Columns
other than vec_id and embedding are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import ship
from rollcall.session import broadcast_if_small, materialize

TABLES, REACH = 2, 2
CELLS = 2.8  # cells a projection uses, about
WIDTH = 3.0  # of a cell, in standard deviations of a projection
BUCKET_ROWS, MAX_HASHES = 1000, 6
SAMPLE, SAMPLE_QUERIES, TARGET = 8192, 256, 0.97
BLOCK = 4096
CELL_BITS = 10


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part, and of the usual length."""
    fine = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    lengths = fine.groupBy(F.size("embedding").alias("d")).count().orderBy(F.col("count").desc(), "d").limit(1).collect()
    return fine.filter(F.size("embedding") == (lengths[0]["d"] if lengths else 0))


def _orthonormal(rng: np.random.Generator, dims: int, count: int) -> np.ndarray:
    """Gaussian directions, each freed of the ones before, as columns."""
    made: list[np.ndarray] = []
    while len(made) < min(count, dims):
        v = rng.standard_normal(dims)
        for u in made:
            v = v - (v * u).sum() * u
        made.append(v / np.sqrt((v * v).sum()))
    return np.stack(made, axis=1)


def scaled(x: np.ndarray, exponent: int | None = None) -> np.ndarray:
    """Vectors times a power of two, so that products neither overflow nor vanish.

    Rows take the one of all vectors; a query takes its own, which changes the order of its
    candidates as little as its length does. Without under- or overflow nothing is rounded.
    """
    if exponent is None:
        exponent = np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None]
    return np.ldexp(x, -exponent)


class Hashes:
    """The tables' projections, and buckets and probes of vectors."""

    def __init__(self, dims: int, count: int, longest: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.longest, self.count = longest, min(count, dims + 1)
        self.exponent = 0  # vectors are scaled by this power of two before anything is squared
        self.directions = [_orthonormal(rng, dims + 1, self.count) for _ in range(TABLES)]
        self.shifts = rng.random((TABLES, self.count))
        self.width, self.probes = np.ones(TABLES), 1
        self.steps = np.array(list(itertools.product(range(-REACH, REACH + 1), repeat=self.count)))

    def rows(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def queries(self, x: np.ndarray) -> np.ndarray:
        scale = self.longest / np.sqrt((x * x).sum(axis=1))
        return np.concatenate([x * scale[:, None], np.zeros((len(x), 1))], axis=1)

    def places(self, x: np.ndarray, t: int) -> np.ndarray:
        """Where vectors lie along the projections of a table, in cells."""
        return np.einsum("ij,jk->ik", x, self.directions[t]) / self.width[t] + self.shifts[t]

    def key(self, cells: np.ndarray) -> np.ndarray:
        bits = cells.astype(np.int64) & ((1 << CELL_BITS) - 1)
        return (bits << (CELL_BITS * np.arange(self.count, dtype=np.int64))).sum(axis=-1)

    def costs(self, places: np.ndarray) -> np.ndarray:
        """Squared distance from each query to every perturbed bucket."""
        inside = places - np.floor(places)
        total = np.zeros((len(places), len(self.steps)))
        for i in range(self.count):
            s = self.steps[:, i]
            away = np.where(s > 0, s - inside[:, i : i + 1], np.where(s < 0, inside[:, i : i + 1] - s - 1, 0))
            total += away**2
        return total

    def visits(self, x: np.ndarray, t: int) -> np.ndarray:
        """Keys of the buckets each query visits in a table, the likeliest first."""
        places = self.places(self.queries(x), t)
        order = np.argsort(self.costs(places), axis=1, kind="stable")[:, : self.probes]
        return self.key(np.floor(places)[:, None, :] + self.steps[order])

    def floors(self, ids: list[int], x: np.ndarray) -> np.ndarray:
        """Of each scaled query, a scaled score that its k-th best candidate reaches at least."""
        own_ids, sample, k = self.sample
        score = np.einsum("ij,kj->ik", x, sample)
        score[np.array(ids)[:, None] == own_ids] = -np.inf
        if len(own_ids) < k:
            return np.full(len(x), -np.inf)
        least = np.partition(score, len(own_ids) - k, axis=1)[:, len(own_ids) - k]
        return least - 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))

    def fit(self, ids: np.ndarray, sample: np.ndarray, total: int, k: int) -> None:
        """Cell width and number of probes, from a sample of the vectors as they are."""
        some, sample = scaled(sample[:SAMPLE_QUERIES]), scaled(sample, self.exponent)
        once = np.unique(ids, return_index=True)[1]  # rows that repeat an id are one candidate
        self.sample = (ids[once], sample[once], k)
        rows = self.rows(sample)
        for t in range(TABLES):
            spread = np.einsum("ij,jk->ik", rows, self.directions[t]).std()
            self.width[t] = WIDTH * max(float(spread), 1e-12)
        score = np.einsum("ij,kj->ik", some, sample)
        score[np.arange(len(some)), np.arange(len(some))] = -np.inf
        near = min(len(sample) - 1, max(1, math.ceil(k * len(sample) / total)))
        if near < 1:
            self.probes = len(self.steps)
            return
        nearest = np.argpartition(-score, near - 1, axis=1)[:, :near]
        first = np.full(nearest.shape, len(self.steps))
        base = 2 * REACH + 1
        for t in range(TABLES):
            places, cells = self.places(self.queries(some), t), np.floor(self.places(rows, t))
            rank = np.argsort(np.argsort(self.costs(places), axis=1, kind="stable"), axis=1)
            step = (cells[nearest] - np.floor(places)[:, None, :]).astype(int)
            number = ((step + REACH) * base ** np.arange(self.count - 1, -1, -1)).sum(axis=-1)
            within = (np.abs(step) <= REACH).all(axis=-1)
            found = np.take_along_axis(rank, np.where(within, number, 0), axis=1)
            first = np.minimum(first, np.where(within, found, len(self.steps)))
        needed = np.sort(first.ravel())[math.ceil(TARGET * first.size) - 1]
        self.probes = int(min(needed + 1, len(self.steps)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def _keyed(vectors: DataFrame, hashes: Hashes | None, is_query: bool) -> DataFrame:
    """Each vector under its buckets: table, bucket, vec_id, embedding, floor. Without hashes, one bucket."""
    schema = "t int, bucket bigint, vec_id bigint, embedding array<double>, floor double"
    if hashes is None:
        return vectors.select(
            F.lit(-1).alias("t"), F.lit(0).cast("bigint").alias("bucket"), "vec_id", "embedding",
            F.lit(float("-inf")).alias("floor"),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = scaled(_matrix(part.column(1)), None if is_query else hashes.exponent)
                floor = hashes.floors(part.column(0).to_pylist(), x) if is_query else np.zeros(len(x))
                for t in range(TABLES):
                    keys = hashes.visits(x, t) if is_query else hashes.key(np.floor(hashes.places(hashes.rows(x), t)))[:, None]
                    owner = np.repeat(np.arange(len(x)), keys.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(owner), t, np.int32)), pa.array(keys.ravel()),
                         *[part.column(i).take(pa.array(owner)) for i in range(2)], pa.array(floor[owner])],
                        names=["t", "bucket", "vec_id", "embedding", "floor"],
                    )

    return vectors.select("vec_id", "embedding").mapInArrow(run, schema)


def best_pairs(
    q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, exponent: int = 0
) -> pd.DataFrame:
    """The k best candidates of every query among these rows, ties to smaller ids, none below its floor.

    Candidates are told apart by scaled products; those near the k-th get their exact score.
    Where exact scores may be infinite, all are worked out, as scaled ones would part equals.
    """
    parts, small = [], scaled(x, exponent)
    most = float(np.abs(x).max(initial=0))

    def exactly(q: np.ndarray, y: np.ndarray) -> np.ndarray:
        total = np.zeros(np.broadcast_shapes(q.shape[:-1], y.shape[:-1]))
        with np.errstate(over="ignore", invalid="ignore"):
            for j in range(x.shape[1]):  # summed in one order everywhere, so that equal pairs score equally
                total += q[..., j] * y[..., j]
        return np.where(np.isnan(total), -np.inf, total)  # overflow to both sides

    for at in range(0, len(q_ids), 512):
        own, some = q_ids[at : at + 512], q[at : at + 512]
        huge = math.log2(max(most, 1)) + math.log2(max(float(np.abs(some).max(initial=0)), 1)) + x.shape[1].bit_length() > 1023
        rough = exactly(some[:, None], x[None]) if huge else scaled(some) @ small.T
        others = own[:, None] != ids
        rough[~others] = -np.inf
        keep = min(k, len(ids))
        least = np.partition(rough, len(ids) - keep, axis=1)[:, len(ids) - keep]
        least = least - 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
        if not huge:
            least = np.maximum(least, floor[at : at + 512] - 1e-9)
        qi, xi = np.nonzero((rough >= least[:, None]) & others)
        exact = exactly(some[qi], x[xi])
        order = np.lexsort((ids[xi], -exact, qi))
        qi, xi, exact = qi[order], xi[order], exact[order]
        rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
        top = rank < k
        parts.append(pd.DataFrame({"query_id": own[qi[top]], "vec_id": ids[xi[top]], "score": exact[top]}))
    return pd.concat(parts) if parts else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _search(rows: DataFrame, queries: DataFrame, hashes: Hashes | None, k: int, exponent: int) -> DataFrame:
    """Best candidates of each query in each block of each bucket it visits."""
    indexed = materialize(_keyed(rows, hashes, False), "ann-rows")
    asked = materialize(_keyed(queries, hashes, True), "ann-queries")
    key = ["t", "bucket"]
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    sizes = broadcast_if_small(
        indexed.groupBy(*key).agg(blocks(F.count("*")).alias("row_blocks"))
        .join(asked.groupBy(*key).agg(blocks(F.count("*")).alias("query_blocks")), key),
        "ann-sizes",
    )
    row_block = F.pmod(F.xxhash64("vec_id"), F.col("row_blocks")).cast("int")
    query_block = F.pmod(F.xxhash64("vec_id"), F.col("query_blocks")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(sizes, key).select(*key, query_block.alias("qb"), every("row_blocks").alias("rb"), "vec_id", "embedding", "floor")
    right = indexed.join(sizes, key).select(*key, row_block.alias("rb"), every("query_blocks").alias("qb"), "vec_id", "embedding")

    def run(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best_pairs(
            q["vec_id"].to_numpy(), np.stack(q["embedding"].to_numpy()), q["floor"].to_numpy(),
            x["vec_id"].to_numpy(), np.stack(x["embedding"].to_numpy()), k, exponent,
        )

    groups = [*key, "rb", "qb"]
    return left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(
        run, "query_id bigint, vec_id bigint, score double"
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the nearest found of every query, itself left out."""
    spark = vectors.sparkSession
    ship(spark)
    rows, asked = usable(vectors), usable(queries)
    largest = F.array_max(F.transform("embedding", F.abs))
    total, biggest, dims = rows.agg(F.count("*"), F.max(largest), F.max(F.size("embedding"))).first()
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    exponent = math.frexp(biggest)[1]
    # in two steps, as one factor may be beyond what a double holds
    half = F.lit(2.0 ** -(exponent // 2)), F.lit(2.0 ** -(exponent - exponent // 2))
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(x * half[0] * half[1], 2))
    longest = rows.agg(F.sqrt(F.max(square))).first()[0]
    count = math.ceil(math.log(max(total / BUCKET_ROWS, 1.01)) / math.log(CELLS))
    hashes = Hashes(dims, min(max(count, 1), MAX_HASHES), longest)
    hashes.exponent = exponent
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    hashes.fit(np.array([r["vec_id"] for r in sample]), np.array([r["embedding"] for r in sample]), total, k)
    first = materialize(_ranked(_search(rows, asked, hashes, k, exponent), k), "ann-found")
    enough = min(k, total - 1)
    full = first.filter(F.col("rank") == enough).select(F.col("query_id").alias("vec_id"))
    short = materialize(asked.join(broadcast_if_small(full, "ann-full"), "vec_id", "left_anti"), "ann-short")
    if enough < 1 or short.isEmpty():
        return first
    again = _ranked(_search(rows, short, None, k, exponent), k)
    asked_again = short.select(F.col("vec_id").alias("query_id"))
    return first.join(asked_again, "query_id", "left_anti").unionByName(again)
