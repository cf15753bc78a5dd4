"""Ranked lexical search by NRA: sorted reads only, score intervals until nothing is open.

Documents are an inverted index in segments: each holds some documents' postings of the
query's terms, one list for each term, in descending order of impact. For an item a
segment's lists are read from their heads, down to a level of score that sinks round by
round. What has been read bounds every document: below by the sum of its impacts read so
far, above by that plus, for each list it has not been met in, what the next entry of that
list could add. A document nobody has met is bounded by the sum of those. A document
whose upper bound is below the k-th best lower bound leaves; reading goes on until
no unmet document can come in and every document still in has both bounds equal, so
membership, order among equals and scores are final. Lists that no open document waits for
are not read on. No document is looked up by its id.

Spark counts N, L and the document frequencies over all documents first, so all segments
score alike. A task reads its segments one after another and keeps each item's k best; later
segments start from the k-th of these, and only the k best of the task leave it. The k
best of all tasks are a grouped limit. Nothing is shuffled but counts and these rows.

The terms of the items are shipped to the tasks in blocks of about ``BLOCK_TERMS`` rows of
an item and a term; more items are searched block by block.

Nulls and odd input: a missing or empty text has no terms and is no document; rows that
repeat a doc_id are documents of their own, and a missing doc_id is the last among equal
scores; rows that share an item_id (or have none) are one item with the terms of all; an
item without terms, or without a document above 0, has no rows; an empty table gives an
empty result. Texts are read whole, of any length. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import ship
from rollcall.operators.rank import rank_rows, top_per_group
from rollcall.session import broadcast_if_small, materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# the same terms in UTF-8 bytes: digits, letters and everything beyond ASCII; all else parts them
BYTES = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).translate(
    bytes.maketrans(UPPER.encode(), LOWER.encode())
)

K = 20
BLOCK_TERMS = 250_000
SEGMENT_POSTINGS = 2_000_000
SINK = 4  # each round reads down to a level so many times lower
FULL = 1_000_000  # above every impact

FOUND = "item bigint, doc_id bigint, score bigint"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id``, ``term`` and its repeats ``qtf``."""
    return (
        items.select("item_id", F.explode(terms_of(F.col("text"))).alias("term"))
        .groupBy("item_id", "term").agg(F.count("*").alias("qtf"))
    )


class Block:
    """Some items' terms, numbered from 0, as the tasks get them."""

    def __init__(self, rows: list[tuple[int, str, int]]):
        self.terms = {t: i for i, t in enumerate(sorted({term.encode() for _, term, _ in rows}))}
        self.items: dict[int, list[tuple[int, int]]] = {}
        for item, term, qtf in rows:
            self.items.setdefault(item, []).append((self.terms[term.encode()], qtf))


def blocks(terms: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The numbered items' terms in runs of items of about so many rows; an item is never divided."""
    count = -(-terms.count() // block_terms)
    for number in range(count):
        rows = terms.filter(F.col("item") % count == number).select("item", "term", "qtf").collect()
        yield Block([tuple(r) for r in rows])


def index_documents(docs: DataFrame, block: Block) -> DataFrame:
    """``doc_id``, ``n`` terms, and the block's terms in each document with their counts, written out.

    Documents without terms are left out; those without any of the block's stay, with empty lists.
    """
    ship(docs.sparkSession)
    wanted = docs.sparkSession.sparkContext.broadcast(block.terms)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = wanted.value.get
        for batch in batches:
            ids, sizes, terms, counts, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                words = text.as_buffer().to_pybytes().translate(BYTES).split() if text.is_valid else []
                if not words:
                    continue
                found = Counter(map(number, words))
                found.pop(None, None)
                ids.append(doc_id.as_py())
                sizes.append(len(words))
                terms += found.keys()
                counts += found.values()
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    found = rows.mapInArrow(index, "doc_id bigint, n bigint, terms array<int>, counts array<int>")
    return materialize(found, "lexical-index")


def weights(index: DataFrame, documents: int) -> dict[int, int]:
    """w of every term that occurs, from its document frequency. A row for each term of the block."""
    n = F.lit(2.0 * documents + 2)
    w = F.floor(1000 * F.log(n / (2 * F.col("df") + 1))).cast("bigint")
    df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return dict(df.select("term", w).collect())


def term_lists(ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, m: np.ndarray, size: int):
    """A segment's postings by term and descending impact: documents, impacts, start of each list."""
    docs = np.repeat(np.arange(len(m)), np.diff(ends))
    tf = counts.astype(np.int64)
    impacts = (1_000_000_000 * tf) // (1000 * tf + 12 * m[docs])
    order = np.argsort(terms.astype(np.int64) * (2 * FULL) + (FULL - impacts), kind="stable")
    starts = np.searchsorted(terms[order], np.arange(size + 1))
    return docs[order], impacts[order], starts


class Lists:
    """The lists of one item in a segment, with how far each has been read."""

    def __init__(self, segment, factors: list[tuple[int, int]]):
        docs, impacts, starts = segment
        self.factors, self.docs, self.impacts, self.at = [], [], [], []
        for term, factor in factors:
            a, b = starts[term], starts[term + 1]
            if a < b and factor > 0:
                self.factors.append(factor)
                self.docs.append(docs[a:b])
                self.impacts.append(impacts[a:b])
                self.at.append(0)

    def __len__(self) -> int:
        return len(self.factors)

    def next(self, i: int) -> int:
        """What the next entry of a list adds; 0 at its end."""
        return int(self.impacts[i][self.at[i]]) * self.factors[i] if self.at[i] < len(self.docs[i]) else 0

    def read(self, i: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries that add the level or more: documents, what each adds."""
        left = self.impacts[i][self.at[i] :]
        least = -(-level // self.factors[i])
        count = int(np.searchsorted(-left, -least, side="right"))
        a, b = self.at[i], self.at[i] + count
        self.at[i] = b
        return self.docs[i][a:b], self.impacts[i][a:b] * self.factors[i]


def nra(lists: Lists, size: int, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores above 0 that can be among the k best, given k others reach ``floor``.

    All scores are exact. Documents that tie with the k-th are all returned.
    """
    lower = np.zeros(size, np.int64)
    met = np.zeros((len(lists), size), bool)
    frontier = np.array([lists.next(i) for i in range(len(lists))], np.int64)
    level, inside, bar = int(frontier.max(initial=0)), None, max(floor, 1)
    while True:
        level = max(1, level // SINK)
        for i in range(len(lists)):
            if inside is not None and met[i, inside].all():
                frontier[i] = 0  # nobody waits for the rest of this list
                continue
            docs, adds = lists.read(i, level)
            lower[docs] += adds
            met[i, docs] = True
            frontier[i] = lists.next(i)
        if inside is None:
            seen = np.flatnonzero(lower)
            if len(seen) >= k:
                bar = max(bar, int(np.partition(lower[seen], len(seen) - k)[len(seen) - k]))
            if frontier.sum() >= bar:
                continue  # an unmet document may still come in
            inside = seen
        elif len(inside) >= k:
            bar = max(bar, int(np.partition(lower[inside], len(inside) - k)[len(inside) - k]))
        upper = lower[inside] + frontier @ ~met[:, inside]
        inside = inside[upper >= bar]
        if not len(inside) or not (frontier @ ~met[:, inside]).any():
            return inside, lower[inside]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id; a missing id is the largest."""
    return np.lexsort((ids, -scores))[:k]


NO_ID = (1 << 63) - 1


class Best:
    """The k best of every item over the segments of a task."""

    def __init__(self, block: dict[int, list[tuple[int, int]]], size: int, k: int):
        self.block, self.size, self.k = block, size, k
        none = np.empty(0, np.int64)
        self.held = {item: (none, none) for item in block}

    def add(self, ids: np.ndarray, m: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        segment = term_lists(ends, terms, counts, m, self.size)
        for item, factors in self.block.items():
            held_ids, held = self.held[item]
            floor = int(held[-1]) if len(held) == self.k else 0
            docs, scores = nra(Lists(segment, factors), len(m), self.k, floor)
            all_ids, all_scores = np.concatenate([held_ids, ids[docs]]), np.concatenate([held, scores])
            keep = best(all_scores, all_ids, self.k)
            self.held[item] = all_ids[keep], all_scores[keep]

    def batches(self) -> Iterator[pa.RecordBatch]:
        for item, (ids, scores) in self.held.items():
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), item, np.int64)), pa.array(ids, mask=ids == NO_ID), pa.array(scores)],
                    names=["item", "doc_id", "score"],
                )


def search_index(
    index: DataFrame, block: Block, documents: int, length: int, k: int, segment_postings: int = SEGMENT_POSTINGS
) -> DataFrame:
    """Each task's k best documents of every item of the block (``FOUND``)."""
    w = weights(index, documents)
    size = len(block.terms)
    factors = {item: [(t, qtf * w.get(t, 0)) for t, qtf in held] for item, held in block.items.items()}
    shipped = index.sparkSession.sparkContext.broadcast(factors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, held, postings = Best(shipped.value, size, k), [], 0

        def segment() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            terms, counts = rows["terms"].combine_chunks(), rows["counts"].combine_chunks()
            ends = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))])
            ids = rows["doc_id"].fill_null(NO_ID).to_numpy()
            top.add(ids, rows["m"].to_numpy(), ends, terms.flatten().to_numpy(), counts.flatten().to_numpy())

        for batch in batches:
            held.append(batch)
            postings += len(batch.column(2).flatten())
            if postings >= segment_postings:
                segment()
                held, postings = [], 0
        if held:
            segment()
        yield from top.batches()

    exact = F.expr(  # 25 * n * N outgrows 64 bits before the quotient does
        f"75 + (25BD * cast(n as decimal(19,0)) * cast({documents} as decimal(15,0))) div {max(length, 1)}BD"
    )
    return index.select("doc_id", exact.cast("bigint").alias("m"), "terms", "counts").mapInArrow(search, FOUND)


def search(
    docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS, segment_postings: int = SEGMENT_POSTINGS
) -> DataFrame:
    """The k best documents of every item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    terms = item_terms(items)
    ranked = rank_rows(terms.select("item_id").distinct(), [F.col("item_id").asc_nulls_first()], "item", "lexical-items")
    known = broadcast_if_small(ranked.select(F.col("item_id").alias("_id"), "item"), "lexical-numbers")
    numbered = materialize(
        terms.join(known, F.col("item_id").eqNullSafe(F.col("_id"))).select("item", "term", "qtf"), "lexical-terms"
    )
    found = spark.createDataFrame([], FOUND)
    for block in blocks(numbered, block_terms):
        index = index_documents(docs, block)
        documents, length = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        found = found.unionByName(search_index(index, block, documents, length, k, segment_postings))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    top = top_per_group(found, ["item"], order, k)
    kept = top.join(known.withColumnRenamed("item", "_item"), F.col("item") == F.col("_item"))
    return kept.select(F.col("_id").alias("item_id"), F.col("rank").cast(T.IntegerType()).alias("rank"), "doc_id", "score")
