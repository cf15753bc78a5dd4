"""How far the sources of a language differ in their words, over hash-consed segment trees.

Each language keeps the terms in at least ``LEAST`` of its documents and numbers them, those
in most documents first. The counts of a group (a source in a language) over these numbers
are the leaves of a segment tree. The trees are cut into blocks of numbers; a task gets
the counts of all groups of a language in some blocks. Within a block a node is the pair of
its children's names, so subtrees with the same counts are one node, in whichever group
and place they stand; among the rarer terms, where counts are mostly 0, 1 and 2, that is most
of them. To compare two groups their trees are walked together from the top, level by
level, and at each level equal pairs of nodes are merged, so every pair of subtrees is priced
once however often it stands in the two trees; the prices of pairs add up to the top. The
blocks' prices are summed by Spark.

A term's share in a group is p = 1 + floor(10^9 (count + 5) / (N + 5 V)), N the group's words
of the V kept terms, all in whole numbers. ``pair`` rows hold the sum of abs(p - q) over the
kept terms to every other source of the language, ``term`` rows the terms most above the
language as a whole.

Words are counted where the documents are, in tasks, before anything is shuffled; a hot
source is just more of these partial counts. A block's width follows from the number of
the language's groups, so that a block holds at most ``CELLS`` counts.

Nulls and odd input: a missing text, lang or source is empty, a language and a source like
any other; a group whose documents have no kept term has all counts 0; a language without kept
terms has prices of 0 and no term rows; a source alone in its language has no pair rows;
repeated rows are documents of their own; an empty table gives an empty result. Texts
are read whole, of any length. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import ship
from rollcall.operators.rank import rank_rows
from rollcall.session import broadcast_if_small, materialize

LEAST = 30
TOP = 50
PRIOR = 5
SCALE = 1_000_000_000
CELLS = 1 << 18
WIDEST = 4096
HELD = 400_000  # counts a task holds before it passes them on

# letters and everything beyond ASCII, in UTF-8 bytes, A-Z as a-z; all else parts words
BYTES = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256)).lower()

COUNTS = "lang string, source string, term string, count bigint, docs bigint"
PRICES = "lang string, a bigint, b bigint, value bigint"


def group_terms(docs: DataFrame) -> DataFrame:
    """Occurrences of every term in every (lang, source), and documents with it; written out."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, text in zip(zip(langs, sources, strict=True), batch.column(2), strict=True):
                words = Counter(text.as_buffer().to_pybytes().translate(BYTES).split())
                total, docs_with = held.setdefault(key, (Counter(), Counter()))
                total.update(words)
                docs_with.update(words.keys())
                if len(total) >= HELD:
                    yield from _counts({key: held.pop(key)})
            if sum(len(total) for total, _ in held.values()) >= HELD:
                yield from _counts(held)
                held = {}
        yield from _counts(held)

    rows = _named(docs).select("lang", "source", F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    partial = rows.mapInArrow(count, COUNTS)
    whole = partial.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    return materialize(whole, "divergence-counts")


def _named(docs: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(blank("lang"), blank("source"), "text")


def _counts(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (total, docs_with) in held.items():
        names = list(total)
        for at in range(0, len(names), 50_000):
            some = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(some)), pa.array([source] * len(some)),
                    pa.array(some, pa.binary()).cast(pa.string()),
                    pa.array([total[t] for t in some], pa.int64()), pa.array([docs_with[t] for t in some], pa.int64()),
                ],
                names=["lang", "source", "term", "count", "docs"],
            )


def kept_terms(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """The kept terms of each language with their number ``seq`` in it from 0, and their ``total``."""
    kept = (
        counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"))
        .filter(F.col("docs") >= least)
    )
    ranked = materialize(
        rank_rows(kept, [F.col("lang"), F.col("docs").desc(), F.col("term")], "_rank", "divergence-ranked"),
        "divergence-kept",
    )
    first = ranked.groupBy(F.col("lang").alias("_lang")).agg(F.min("_rank").alias("_first"))  # a row for each lang
    return ranked.join(broadcast_if_small(first, "divergence-first"), F.col("lang") == F.col("_lang")).select(
        "lang", "term", "total", (F.col("_rank") - F.col("_first")).alias("seq")
    )


def groups(docs: DataFrame, cells: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source) with its number ``g``, words ``n`` of kept terms, and of its language: ``v``
    kept terms, words ``lang_n`` and the ``width`` of a block. One row for each group, written out."""
    found = _named(docs).select("lang", "source").distinct()
    ranked = rank_rows(found, [F.col("lang"), F.col("source")], "g", "divergence-groups")
    words = cells.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.sum("count").alias("_n"))
    of_lang = kept.groupBy(F.col("lang").alias("_k")).agg(F.count("*").alias("_v"), F.sum("total").alias("_t"))
    members = found.groupBy(F.col("lang").alias("_m")).agg(F.count("*").alias("_size"))
    width = F.pow(F.lit(2), F.floor(F.log2(F.lit(CELLS) / F.col("_size"))))
    joined = (
        ranked.join(words, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left")
        .join(of_lang, F.col("lang") == F.col("_k"), "left")
        .join(members, F.col("lang") == F.col("_m"))
    )
    zero = F.lit(0).cast("bigint")
    return materialize(
        joined.select(
            "lang", "source", "g", F.coalesce("_n", zero).alias("n"), F.coalesce("_v", zero).alias("v"),
            F.coalesce("_t", zero).alias("lang_n"),
            F.least(F.greatest(width, F.lit(16)), F.lit(WIDEST)).cast("bigint").alias("width"),
        ),
        "divergence-members",
    )


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count, in whole numbers."""
    wide = lambda c: c.cast("decimal(19,0)")
    over = F.call_function("div", (wide(count) + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"), wide(total) + PRIOR * wide(kept))
    return over + 1


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The same in a task; totals have the prior added."""
    if len(counts) and int(counts.max()) >= (1 << 63) // SCALE - PRIOR:  # too large for 64 bits
        return np.array(
            [1 + SCALE * (int(c) + PRIOR) // int(n) for c, n in zip(counts, totals, strict=True)], np.int64
        )
    return 1 + SCALE * (counts + PRIOR) // totals


class Forest:
    """Segment trees of a block, one for each group, whose equal subtrees are one node.

    ``names[d][g, i]`` is the node of group g at place i of depth d, the root at depth 0.
    Nodes of a depth are numbered from 0; ``left`` and ``right`` are a node's children, and
    the nodes of the last depth are the distinct counts, ``values``.
    """

    def __init__(self, counts: np.ndarray):
        self.values, leaves = np.unique(counts, return_inverse=True)
        names = leaves.reshape(counts.shape).astype(np.int64)
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []
        size = len(self.values)
        while names.shape[1] > 1:
            pairs, inverse = np.unique(names[:, 0::2] * size + names[:, 1::2], return_inverse=True)
            names = inverse.reshape(len(counts), -1).astype(np.int64)
            self.left.insert(0, pairs // size)
            self.right.insert(0, pairs % size)
            size = len(pairs)
        self.roots = names[:, 0]
        self.nodes = [len(x) for x in self.left] + [len(self.values)]

    def prices(self, g: int, others: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Sum of abs(p - q) over the block between group g and each of the others.

        Pairs of nodes are told apart by the other group too, whose total is part of the price.
        """
        pairs = [np.arange(len(others))], [np.full(len(others), self.roots[g])], [self.roots[others]]
        back = []
        for left, right, size in zip(self.left, self.right, self.nodes[1:], strict=True):
            h, a, b = (np.concatenate(x) for x in pairs)
            key = np.concatenate([(h * size + c[a]) * size + c[b] for c in (left, right)])
            once, places = np.unique(key, return_inverse=True)
            back.append(places.reshape(2, -1))
            pairs = [once // (size * size)], [once // size % size], [once % size]
        h, a, b = (np.concatenate(x) for x in pairs)
        price = np.abs(
            shares(self.values[a], np.full(len(a), totals[g])) - shares(self.values[b], totals[others[h]])
        )
        for places in reversed(back):
            price = price[places[0]] + price[places[1]]
        return price


def block_prices(cells: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """Prices between all groups of a language in one block of numbers."""
    members = members.sort_values("g")
    ids, totals = members["g"].to_numpy(), (members["n"] + PRIOR * members["v"]).to_numpy()
    lang, width, size = members["lang"].iloc[0], int(members["width"].iloc[0]), int(members["size"].iloc[0])
    counts = np.zeros((len(ids), width), np.int64)
    if len(cells):
        counts[np.searchsorted(ids, cells["g"].to_numpy()), cells["place"].to_numpy()] = cells["count"].to_numpy()
    found = []
    for start, run in _full_trees(size):  # the last block of a language may be no power of two
        forest = Forest(counts[:, start : start + run])
        for i in range(len(ids) - 1):
            others = np.arange(i + 1, len(ids))
            found.append((i, others, forest.prices(i, others, totals)))
    if not found:
        return pd.DataFrame({"lang": [], "a": [], "b": [], "value": []}).astype({"lang": str, "a": int, "b": int, "value": int})
    return pd.DataFrame({
        "lang": lang,
        "a": np.concatenate([np.full(len(o), ids[i]) for i, o, _ in found]),
        "b": np.concatenate([ids[o] for _, o, _ in found]),
        "value": np.concatenate([p for _, _, p in found]),
    })


def _full_trees(size: int) -> Iterator[tuple[int, int]]:
    """Runs of powers of two that cover so many places."""
    start = 0
    while start < size:
        run = 1 << ((size - start).bit_length() - 1)
        yield start, run
        start += run


def prices(cells: DataFrame, members: DataFrame) -> DataFrame:
    """Sum of abs(p - q) over all kept terms for every two groups ``a`` < ``b`` of a language."""
    places = cells.select(
        "lang", F.floor(F.col("seq") / F.col("width")).alias("block"), "g",
        (F.col("seq") % F.col("width")).alias("place"), "count",
    )
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("v") / F.col("width")).cast("bigint") - 1))
    size = F.least(F.col("width"), F.col("v") - F.col("block") * F.col("width")).alias("size")
    there = members.filter(F.col("v") > 0).select("lang", "g", "n", "v", "width", blocks.alias("block")).select("*", size)
    priced = (
        places.groupBy("lang", "block")
        .cogroup(there.groupBy("lang", "block"))
        .applyInPandas(block_prices, PRICES)
    )
    return priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank of all ``pair`` and the first ``term`` rows."""
    counts = group_terms(docs)
    kept = materialize(kept_terms(counts, least), "divergence-terms")
    shared = broadcast_if_small(kept.select(F.col("lang").alias("_kl"), F.col("term").alias("_kt"), "total", "seq"), "divergence-vocabulary")
    cells = materialize(
        counts.join(shared, (F.col("lang") == F.col("_kl")) & (F.col("term") == F.col("_kt"))).select(
            "lang", "source", "term", "count", "total", "seq"
        ),
        "divergence-cells",
    )
    members = groups(docs, cells, kept)
    small = broadcast_if_small(members.withColumnsRenamed({"lang": "_ml", "source": "_ms"}), "divergence-groups")
    placed = cells.join(small, (F.col("lang") == F.col("_ml")) & (F.col("source") == F.col("_ms")))

    above = share(F.col("count"), F.col("n"), F.col("v")) - share(F.col("total"), F.col("lang_n"), F.col("v"))
    terms = placed.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), above.alias("value"))
    both = prices(placed, members)
    sides = [
        both.select(F.col(x).alias("_x"), F.col(y).alias("_y"), F.col("value").alias("_value"))
        for x, y in (("a", "b"), ("b", "a"))
    ]
    one = members.select("lang", "source", "g")
    other = members.select(F.col("lang").alias("_l"), F.col("source").alias("item"), F.col("g").alias("_h"))
    pairs = (
        one.join(other, (F.col("lang") == F.col("_l")) & (F.col("g") != F.col("_h")))
        .join(sides[0].unionByName(sides[1]), (F.col("g") == F.col("_x")) & (F.col("_h") == F.col("_y")), "left")
        .select(
            "lang", "source", F.lit("pair").alias("part"), "item",
            F.coalesce("_value", F.lit(0).cast("bigint")).alias("value"),
        )
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    first = ranked(terms.filter(F.col("value") > 0)).filter(F.col("rank") <= top)
    return ranked(pairs).unionByName(first)
