"""SimHash near-duplicates, found with pivot distance tables.

A fingerprint has one or more words of 64 bits; a bit is 1 where more than half of
the shingle hashes have it set. Documents with equal fingerprints are one class,
and classes link at ``radius`` or fewer differing bits. Documents that reach each
other by links are one component.

Classes are compared inside buckets of equal bits under a mask. The bits are cut into
one part more than ``radius``, so that a linked pair has one part equal (of four parts
at a radius of three); a bucket that is too large is divided by the parts of its other
bits, again and again, which loses nothing.

Inside a bucket the distances of every fingerprint to ``PIVOTS`` reference
fingerprints are tabulated. By the triangle inequality a pair whose distances to
any reference differ by more than the radius is no link and is discarded; the
others are verified. Only a spanning forest of a bucket's links leaves the task, so a
dense group gives as many rows as it has members, and no link between classes is lost
to the components.

``drop_near_copies`` doesn't go by fingerprints but by the texts' sets of distinct
shingles and their Jaccard index. Shingles are ordered from rare to common; two sets as
alike as asked share one of the first few of both, so looking under those finds every
such pair. What many texts share comes last in that order, so boilerplate brings no
candidates. All classes under a shingle are held against two of them, and then every
pair that verified links don't join yet, so a pair is left out only where its ends are
in one group already. Sketches, of about a bit a shingle, tell most pairs apart before
their sets are moved. Equality of sets and of shingles is that of 64-bit hashes.
``drop_copies`` joins the links of both searches.

Nulls and odd input: a missing or empty text has fingerprint zero, linked like any
other; repeated rows have equal fingerprints and share their component; rows without
an id get a fingerprint and no component, and link nothing; an empty table gives an
empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship
from rollcall.llm.components import components
from rollcall.session import broadcast_if_small, materialize

HASH_SEED = 42
PIVOTS = 16
BUCKET_ROWS = 2048  # a larger bucket is divided
SAMPLE_ROWS = 20_000  # at least so many documents, or one in SAMPLED, tell which shingles are common
SAMPLED = 16
COMMON = 200_000
SHINGLES_AT_ONCE = 255 * 64
SKETCH_BITS = 1 << 16  # at most; a sketch of fewer bits than shingles only tells less
COMPARED_AT_ONCE = 1 << 20
PAIRS_AT_ONCE = 1 << 20


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    if len(words) <= size:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(size)]))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(g, HASH_SEED) for g in grams], dtype=np.uint64)


def widen(h: np.ndarray, words: int) -> np.ndarray:
    """More hash words for each hash: the first is the hash itself, the others are mixed from it."""
    out = np.empty((len(h), words), dtype=np.uint64)
    out[:, 0] = h
    for i in range(1, words):
        x = h + np.uint64((i * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, i] = x ^ (x >> np.uint64(31))
    return out


def split(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lowered."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def hash_blocks(tokens: list[bytes], size: int, repeats: bool) -> Iterator[np.ndarray]:
    """Shingle hashes of a text in blocks of bounded size, each once unless ``repeats``."""
    if not tokens:
        return
    blocks = (
        shingle_hashes(tokens[start : start + SHINGLES_AT_ONCE + size - 1], size)
        for start in range(0, max(1, len(tokens) - size + 1), SHINGLES_AT_ONCE)
    )
    if repeats:
        yield from blocks
        return
    once = np.unique(np.concatenate(list(blocks)))
    yield from (once[at : at + SHINGLES_AT_ONCE] for at in range(0, len(once), SHINGLES_AT_ONCE))


def fingerprint(text: str | None, size: int = 3, words: int = 1, repeats: bool = True) -> np.ndarray:
    """Fingerprint as ``words`` unsigned 64-bit integers."""
    counts, total = np.zeros(64 * words, dtype=np.int64), 0
    for block in hash_blocks(split(text), size, repeats):
        h = widen(block, words)
        total += len(h)
        for at in range(0, len(h), 255):  # counts of 255 rows fit a byte
            part = np.unpackbits(h[at : at + 255].view(np.uint8), axis=1, bitorder="little")
            counts += np.add.reduce(part, axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > total, bitorder="little").view("<u8").astype(np.uint64)


def fingerprints(
    docs: DataFrame, size: int = 3, words: int = 1, repeats: bool = True, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id and the fingerprint's words as long columns f0, f1, ..; ``keep`` are longs passed on."""
    ship(docs.sparkSession)
    names = [f"f{i}" for i in range(words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            made = np.empty((len(texts), words), dtype=np.uint64)
            for i in range(len(texts)):
                made[i] = fingerprint(texts[i].as_py(), size, words, repeats)
            columns = [pa.array(made[:, j].view(np.int64)) for j in range(words)]
            kept = [batch.column(2 + j) for j in range(len(keep))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *kept], names=["doc_id", *names, *keep])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *keep).mapInArrow(
        run, "doc_id bigint, " + ", ".join(f"{n} bigint" for n in [*names, *keep])
    )


def _as_words(bits: np.ndarray, words: int) -> tuple[int, ...]:
    """Signed words with the bits at these positions set."""
    flags = np.zeros(64 * words, dtype=np.uint8)
    flags[bits] = 1
    return tuple(int(x) for x in np.packbits(flags, bitorder="little").view("<i8"))


class Parts:
    """Masks that are exact: of one part more than bits may differ, one is equal."""

    def __init__(self, words: int, radius: int):
        self.words, self.parts = words, radius + 1

    def roots(self) -> list[np.ndarray]:
        return self.children(np.array([], dtype=int))

    def children(self, mask: np.ndarray) -> list[np.ndarray]:
        left = np.setdiff1d(np.arange(64 * self.words), mask)
        return [np.concatenate([mask, p]) for p in np.array_split(left, self.parts)]


def _keyed(rows: DataFrame, masks: list[tuple], words: int) -> DataFrame:
    """The rows under each mask of their parent: bucket key, mask number, class and fingerprint.

    ``masks`` has parent, number and the mask's words; there are only as many as the rule draws.
    """
    one = lambda m: F.struct(
        F.lit(m[1]).alias("mask"), *[F.lit(w).cast("bigint").alias(f"m{i}") for i, w in enumerate(m[2:])]
    )
    by_parent = {p: F.array(*[one(m) for m in masks if m[0] == p]) for p in {m[0] for m in masks}}
    if len(by_parent) == 1:
        fitting = next(iter(by_parent.values()))
    else:
        pairs = [x for p, found in by_parent.items() for x in (F.lit(p), found)]
        fitting = F.try_element_at(F.create_map(*pairs), F.col("parent"))
    each = rows.select("head", *[f"f{i}" for i in range(words)], F.explode(fitting).alias("m"))
    masked = [F.col(f"f{i}").bitwiseAND(F.col(f"m.m{i}")) for i in range(words)]
    return each.select(
        F.xxhash64(F.col("m.mask"), *masked).alias("key"), F.col("m.mask").alias("mask"), "head",
        *[f"f{i}" for i in range(words)],
    )


def pivot_table(fp: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distance of every fingerprint to every reference fingerprint."""
    out = np.empty((len(fp), len(pivots)), dtype=np.int16)
    for j, p in enumerate(pivots):
        out[:, j] = np.bitwise_count(fp ^ p).sum(axis=1, dtype=np.int16)
    return out


class Forest:
    """Spanning forest of the links added."""

    def __init__(self, nodes: int):
        self.parent = list(range(nodes))

    def _root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def add(self, i: int, j: int) -> None:
        a, b = self._root(i), self._root(j)
        self.parent[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self._root(i) for i in range(len(self.parent))])


def bucket_links(key: np.ndarray, fp: np.ndarray, pivots: np.ndarray, radius: int) -> np.ndarray:
    """Row pairs of a spanning forest of the links inside each bucket.

    Rows are sorted by key. Pairs are compared by their distance in that order, so
    that one pass of array operations handles all buckets.
    """
    n = len(key)
    table = pivot_table(fp, pivots)
    at, found = np.arange(n), []
    for step in range(1, n):
        at = at[at + step < n]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        left = at
        for j in range(len(pivots)):
            left = left[np.abs(table[left, j] - table[left + step, j]) <= radius]
        away = np.bitwise_count(fp[left] ^ fp[left + step]).sum(axis=1, dtype=np.int32)
        left = left[away <= radius]
        if len(left):
            found.append(np.stack([left, left + step], axis=1).astype(np.int32))
    if not found:
        return np.empty((0, 2), dtype=int)
    links, spanning = np.concatenate(found), Forest(n)
    for start in range(0, len(links), 65536):
        part, top = links[start : start + 65536], spanning.roots()
        for i, j in part[top[part[:, 0]] != top[part[:, 1]]].tolist():  # those already joined are most
            spanning.add(i, j)
    root = spanning.roots()  # each member with its root: as well connected, and by shorter paths
    member = np.nonzero(root != np.arange(n))[0]
    return np.stack([member, root[member]], axis=1)


def _links(buckets: DataFrame, words: int, radius: int) -> DataFrame:
    names = [f"f{i}" for i in range(words)]
    pivots = np.random.default_rng(3).integers(0, 2**64, (PIVOTS, words), dtype=np.uint64)

    def found(key, head, fp) -> pa.RecordBatch:
        pairs = bucket_links(key, fp, pivots, radius)
        return pa.RecordBatch.from_arrays(
            [pa.array(head[pairs[:, 0]]), pa.array(head[pairs[:, 1]])], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # a bucket may go on in the next batch
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            part = [columns[0], columns[1], np.stack(columns[2:], axis=1).view(np.uint64)]
            if rest is not None:
                part = [np.concatenate(x) for x in zip(rest, part, strict=True)]
            if not len(part[0]):
                continue
            cut = int(np.searchsorted(part[0], part[0][-1]))
            if cut:
                yield found(*[x[:cut] for x in part])
            rest = [x[cut:] for x in part]
        if rest is not None:
            yield found(*rest)

    sorted_rows = buckets.select("key", "head", *names).repartition("key").sortWithinPartitions("key", "head")
    return sorted_rows.mapInArrow(run, "a bigint, b bigint")


def class_links(classes: DataFrame, words: int, radius: int, family) -> DataFrame:
    """Links between classes (``head`` and fingerprint): a spanning forest of each bucket."""
    rows, links, numbered = classes.withColumn("parent", F.lit(0)), None, 0
    known: dict[int, np.ndarray] = {}
    parents = {0: family.roots()}
    while True:
        table = []
        for parent, children in parents.items():
            for child in children:
                numbered += 1
                known[numbered] = child
                table.append((parent, numbered, *_as_words(child, words)))
        keyed = materialize(_keyed(rows, table, words), "simhash-keys")
        large = broadcast_if_small(
            keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > BUCKET_ROWS).select("key"),
            "simhash-large",
        )
        any_large = not large.isEmpty()
        small = keyed.join(large, "key", "left_anti") if any_large else keyed
        part = materialize(_links(small, words, radius), "simhash-links")
        links = part if links is None else links.unionByName(part)
        if not any_large:
            return links
        rows = (
            keyed.join(large, "key", "left_semi").withColumnRenamed("mask", "parent").drop("key")
        )
        used = [r[0] for r in rows.select("parent").distinct().collect()]  # masks, fixed by rule
        parents = {p: family.children(known[p]) for p in used}


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    blocks = list(hash_blocks(split(text), size, False))
    return np.unique(np.concatenate(blocks)) if blocks else np.empty(0, np.uint64)


def common_shingles(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, of shingles that stand in several documents of a sample, and in how many.

    They only set the order in which shingles count as rare; any order gives the same links.
    """
    every = max(1, min(SAMPLED, docs.count() // SAMPLE_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, held = [], 0
            for i, text in enumerate(batch.column(0)):
                sets.append(shingle_set(text.as_py(), size))
                held += len(sets[-1])
                if held > 1 << 20 or i == batch.num_rows - 1:
                    token, n = np.unique(np.concatenate(sets), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], names=["token", "n"])
                    sets, held = [], 0

    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("text")
    found = (
        chosen.mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
        .filter(F.col("n") > 2).orderBy(F.col("n").desc(), "token").limit(COMMON).toArrow()
    )
    token = found.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], found.column("n").to_numpy()[order]


def rarest(tokens: np.ndarray, common: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """The rarest shingles of a set, so many that another set as alike as ``least`` has one of them among its own."""
    n = len(tokens)
    if not n:
        return tokens
    known, counts = common
    count = np.zeros(n, dtype=np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        count = np.where(known[at] == tokens, counts[at], 0)
    return tokens[np.lexsort((tokens, count))[: n - math.ceil(least * n - 1e-9) + 1]]


def sketch(tokens: np.ndarray) -> np.ndarray:
    """For each of some bits, of which a set has about as many as shingles, whether an odd number of its shingles falls to it.

    Two sketches differ in no more bits than their sets in shingles. The halves of a sketch
    xored make the sketch of half as many bits.
    """
    bits = 64
    while bits < min(len(tokens), SKETCH_BITS):
        bits *= 2
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def folded(made: np.ndarray, words: int) -> np.ndarray:
    while len(made) > words:
        made = made[: len(made) // 2] ^ made[len(made) // 2 :]
    return made


def may_be_alike(
    sketches: list[np.ndarray], n: np.ndarray, a: np.ndarray, b: np.ndarray, least: float
) -> np.ndarray:
    """Whether the sets at ``a`` and ``b`` can have a Jaccard index of ``least``, by their sketches; never wrongly no."""
    width = np.array([len(x) for x in sketches], dtype=np.int64)
    both, keep = np.minimum(width[a], width[b]), np.zeros(len(a), dtype=bool)
    most = (n[a] + n[b]) * ((1 - least) / (1 + least)) + 1e-6  # shingles that alike sets may differ in
    for words in np.unique(both).tolist():
        at = np.flatnonzero(both == words)
        used = np.unique(np.concatenate([a[at], b[at]]))
        table = np.stack([folded(sketches[i], words) for i in used.tolist()])
        for part in np.array_split(at, 1 + len(at) * words // COMPARED_AT_ONCE):
            x, y = table[np.searchsorted(used, a[part])], table[np.searchsorted(used, b[part])]
            keep[part] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= most[part]
    return keep


def shingle_classes(docs: DataFrame, size: int, least: float, prints: int = 0) -> DataFrame:
    """doc_id, text hash ``t``, class of equal shingle sets and set size ``n`` of every row.

    The first row of a class in a task has the set's sketch and rarest shingles as well. With ``prints``
    there is ``f0``, the fingerprint of shingles of so many words.
    """
    ship(docs.sparkSession)
    common = common_shingles(docs, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            cls, n, made, prefix = [], [], [], []
            for text in batch.column(2):
                tokens = shingle_set(text.as_py(), size)
                cls.append(xxhash.xxh64_intdigest(tokens.tobytes(), HASH_SEED))
                n.append(len(tokens))
                new = cls[-1] not in seen
                seen.add(cls[-1])
                made.append(sketch(tokens).tobytes() if new else None)
                prefix.append(rarest(tokens, common, least).view(np.int64) if new else None)
            columns = {
                "doc_id": batch.column(0), "t": batch.column(1), "cls": pa.array(np.array(cls, np.uint64).view(np.int64)),
                "n": pa.array(n, pa.int64()), "sketch": pa.array(made, pa.binary()),
                "prefix": pa.array(prefix, pa.list_(pa.int64())),
            }
            if prints:
                f0 = [fingerprint(text.as_py(), prints)[0] for text in batch.column(2)]
                columns["f0"] = pa.array(np.array(f0, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), "text"
    ).mapInArrow(
        run, "doc_id bigint, t bigint, cls bigint, n bigint, sketch binary, prefix array<bigint>" + ", f0 bigint" * bool(prints)
    )


def alike(docs: DataFrame, classes: DataFrame, links: DataFrame, size: int, least: float) -> DataFrame:
    """The links whose texts have a Jaccard index of distinct shingles of at least ``least``.

    Sets are built and moved only for links that the sketches leave.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = [np.frombuffer(x.as_py(), "<u8") for c in (2, 4) for x in batch.column(c)]
            n = np.concatenate([batch.column(c).to_numpy() for c in (3, 5)])
            at = np.arange(batch.num_rows)
            kept = batch.filter(pa.array(may_be_alike(made, n, at, at + batch.num_rows, least)))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            new = [i for i, cls in enumerate(batch.column(0).to_pylist()) if not (cls in seen or seen.add(cls))]
            made = [shingle_set(batch.column(1)[i].as_py(), size).tobytes() for i in new]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(new, pa.int64())), pa.array(made, pa.binary())], names=["cls", "set"])

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= least * (len(x) + len(y) - both) - 1e-9)
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    of = lambda end, made, n: classes.select(F.col("cls").alias(end), F.col("sketch").alias(made), F.col("n").alias(n))
    sketched = links.join(of("a", "x", "nx"), "a").join(of("b", "y", "ny"), "b").select("a", "b", "x", "nx", "y", "ny")
    links = materialize(sketched.mapInArrow(near, "a bigint, b bigint"), "copies-near")
    ids = links.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    used = classes.select("cls", "t").join(broadcast_if_small(ids, "copies-ids"), "cls", "left_semi")
    texts = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), "text").join(
        broadcast_if_small(used, "copies-used"), "t"
    )
    made = texts.select("cls", "text").mapInArrow(sets, "cls bigint, set binary").groupBy("cls").agg(F.min("set").alias("set"))
    made = materialize(made, "copies-sets")
    one = made.select(F.col("cls").alias("a"), F.col("set").alias("x"))
    other = made.select(F.col("cls").alias("b"), F.col("set").alias("y"))
    pairs = links.join(one, "a").join(other, "b").select("a", "b", "x", "y")
    return materialize(pairs.mapInArrow(enough, "a bigint, b bigint"), "copies-alike")


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by their first column, cut anew so that rows of one key are in one batch."""
    rest = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut or (rest and rest[0].column(0)[0].as_py() != key[0]):
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)]).combine_chunks().to_batches()[0] if rest else batch.slice(0, cut)
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def _could_overlap(n: np.ndarray, pos: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Whether sizes, and what is left of the sets after a shingle that is the first they share, are near enough."""
    return np.minimum(n[i] - pos[i], n[j] - pos[j]) * (1 + least) >= (n[i] + n[j]) * least - 1e-6


def _groups_of(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the first and the last row of its token."""
    start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    count = np.diff(np.append(start, len(token)))
    return np.repeat(start, count), np.repeat(start + count - 1, count)


def _gathered(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes, two columns, as batches without the repeats among those held at once."""
    held, rows = [], 0
    for pairs in found:
        held.append(pairs)
        rows += len(pairs)
        if rows > PAIRS_AT_ONCE:
            held = [np.unique(np.concatenate(held), axis=0)]
            rows = len(held[0])
            if rows > PAIRS_AT_ONCE // 2:
                yield pa.RecordBatch.from_arrays([pa.array(held[0][:, 0]), pa.array(held[0][:, 1])], names=["a", "b"])
                held, rows = [], 0
    if rows:
        once = np.unique(np.concatenate(held), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(once[:, 0]), pa.array(once[:, 1])], names=["a", "b"])


def end_pairs(keys: DataFrame, least: float) -> DataFrame:
    """The classes under each shingle against its smallest and largest one, as ``a`` and ``b``; and, as rows with
    ``token``, class ``a`` and place ``b``, the classes under shingles that have other pairs."""
    names = ["token", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = []

        def pairs() -> Iterator[np.ndarray]:
            for batch in _whole_keys(batches):
                token, cls, place = (c.to_numpy() for c in batch.columns)
                new = np.concatenate([[True], (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])])
                token, cls, place = token[new], cls[new], place[new]
                first, last = _groups_of(token)
                n, pos, at = place >> 32, place & 0xFFFFFFFF, np.arange(len(token))
                more = np.flatnonzero(last - first >= 3)
                if len(more):
                    members.append(pa.RecordBatch.from_arrays([pa.array(x[more]) for x in (token, cls, place)], names=names))
                inner = at[at != first]
                outer = at[(at != first) & (at != last)]
                i, j = np.concatenate([inner, last[outer]]), np.concatenate([first[inner], outer])
                near = _could_overlap(n, pos, i, j, least)
                yield np.stack([cls[i[near]], cls[j[near]]], axis=1)

        for found in _gathered(pairs()):
            none = pa.nulls(found.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, *found.columns], names=names)
            yield from members
            members.clear()
        yield from members

    sorted_keys = keys.repartition("token").sortWithinPartitions("token", "cls")
    return sorted_keys.mapInArrow(run, "token bigint, a bigint, b bigint")


def inner_pairs(members: DataFrame, least: float) -> DataFrame:
    """The other pairs of classes under each shingle that are in different components and whose sketches are near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[np.ndarray]:
            for batch in _whole_keys(batches):
                token, cls, place, comp = (batch.column(i).to_numpy() for i in range(4))
                made = [np.frombuffer(x.as_py(), "<u8") for x in batch.column(4)]
                first, last = _groups_of(token)
                n, pos = place >> 32, place & 0xFFFFFFFF
                for start in np.unique(first).tolist():
                    inner = np.arange(start + 1, last[start])
                    if not len(inner):
                        continue
                    _, comps, count = np.unique(comp[inner], return_inverse=True, return_counts=True)
                    minor = np.flatnonzero(comps != count.argmax())  # of two in different components one is in a minor one
                    for part in np.array_split(minor, 1 + len(minor) * len(inner) // COMPARED_AT_ONCE):
                        x, y = np.repeat(part, len(inner)), np.tile(np.arange(len(inner)), len(part))
                        other = (comps[x] != comps[y]) & ((comps[y] == count.argmax()) | (x > y))
                        i, j = inner[x[other]], inner[y[other]]
                        near = _could_overlap(n, pos, i, j, least)
                        i, j = i[near], j[near]
                        near = may_be_alike(made, n, i, j, least)
                        i, j = i[near], j[near]
                        yield np.stack([np.maximum(cls[i], cls[j]), np.minimum(cls[i], cls[j])], axis=1)

        yield from _gathered(pairs())

    sorted_rows = members.repartition("token").sortWithinPartitions("token", "cls")
    return sorted_rows.mapInArrow(run, "a bigint, b bigint")


def copy_groups(docs: DataFrame, size: int, least: float, prints: int = 0, radius: int = 0) -> DataFrame:
    """doc_id, text hash ``t``, class and group of every row: groups hang together by pairs as alike as ``least``
    and, with ``prints``, by links of fingerprints of shingles of so many words.

    Two sets that alike have one of their rarest shingles in common, so the classes under
    each rare shingle hold every such pair. First all classes of a shingle are held against
    its smallest and largest one; then every pair whose ends no verified links join yet.
    """
    rows = materialize(shingle_classes(docs, size, least, prints), "copies-rows")
    classes = materialize(
        rows.filter(F.col("sketch").isNotNull()).groupBy("cls")
        .agg(F.min("t").alias("t"), F.min("n").alias("n"), F.min("sketch").alias("sketch")),
        "copies-classes",
    )
    placed = rows.select("cls", F.shiftleft("n", 32).alias("n"), F.posexplode("prefix").alias("pos", "token"))
    keys = placed.select("token", "cls", (F.col("n") + F.col("pos")).alias("place"))
    met = materialize(end_pairs(keys, least), "copies-met")
    first = materialize(met.filter(F.col("token").isNull()).select("a", "b").distinct(), "copies-first")
    good = alike(docs, classes, first, size, least)
    if prints:
        heads = materialize(rows.groupBy("f0").agg(F.min("cls").alias("head")), "copies-prints")
        same = rows.select("cls", "f0").distinct().join(heads, "f0").select(F.col("cls").alias("a"), F.col("head").alias("b"))
        good = materialize(
            good.unionByName(same.filter("a != b")).unionByName(class_links(heads, 1, radius, Parts(1, radius))).distinct(),
            "copies-good",
        )
    joined = components(good)

    members = met.filter(F.col("token").isNotNull()).select("token", F.col("a").alias("cls"), F.col("b").alias("place"))
    marked = materialize(
        members.join(broadcast_if_small(joined, "copies-joined"), F.col("cls") == F.col("node"), "left")
        .select("token", "cls", "place", F.coalesce("component", "cls").alias("comp")),
        "copies-marked",
    )
    apart = marked.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi")
    apart = marked.join(broadcast_if_small(apart.select("token"), "copies-apart"), "token", "left_semi")
    open_rows = apart.join(classes.select("cls", "sketch"), "cls").select("token", "cls", "place", "comp", "sketch")
    rest = inner_pairs(open_rows, least).distinct().join(first, ["a", "b"], "left_anti")
    rest = materialize(rest, "copies-rest")
    if not rest.isEmpty():
        joined = components(good.unionByName(alike(docs, classes, rest, size, least)))
    return rows.select("doc_id", "t", "cls").join(
        broadcast_if_small(joined, "copies-groups"), F.col("cls") == F.col("node"), "left"
    ).select("doc_id", "t", "cls", F.coalesce("component", "cls").alias("group"))


def as_hex(words: int) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(f"f{i}")), 16, "0") for i in range(words)])


def near_groups(
    docs: DataFrame, size: int = 3, words: int = 1, radius: int = 3, repeats: bool = True
) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (smallest id reachable) of every document.

    ``size`` words make a shingle; a fingerprint has 64 * ``words`` bits, and counts
    repeated shingles each time if ``repeats``. The search is exact; it is meant for a
    radius of a few bits, as buckets grow with it.
    """
    names = [f"f{i}" for i in range(words)]
    made = materialize(fingerprints(docs, size, words, repeats), "simhash")
    classes = materialize(
        made.filter(F.col("doc_id").isNotNull()).groupBy(*names).agg(F.min("doc_id").alias("head")), "simhash-classes"
    )
    family = Parts(words, radius)
    found = components(class_links(classes, words, radius, family))
    groups = materialize(
        classes.join(found, F.col("head") == F.col("node"), "left").select(
            *[F.col(n).alias(f"_{n}") for n in names], F.coalesce("component", "head").alias("component_id")
        ),
        "simhash-groups",
    )
    same = [F.col(n) == F.col(f"_{n}") for n in names]
    joined = made.join(groups, same, "left")
    return joined.select(
        "doc_id", as_hex(words).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def fingerprint_groups(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, text hash ``t`` and group of every row, those without an id included: groups hang together by links of
    64-bit fingerprints."""
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"))
    rows = materialize(fingerprints(hashed, size, keep=("t",)), "simhash-rows")
    classes = materialize(rows.select(F.col("f0").alias("head"), "f0").distinct(), "simhash-classes")
    found = components(class_links(classes, 1, radius, Parts(1, radius)))
    joined = rows.join(broadcast_if_small(found, "simhash-groups"), F.col("f0") == F.col("node"), "left")
    return joined.select("doc_id", "t", F.coalesce("component", "f0").alias("group"))


def drop_fingerprint_copies(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """The documents with one left of each component of :func:`near_groups`: the one with the smallest id.

    Rows are told as by :func:`drop_near_copies`, and rows without an id are compared like others.
    """
    return _first_of_groups(docs, fingerprint_groups(docs, size, radius))


def drop_near_copies(docs: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """The documents with one left of each group: the one with the smallest id.

    Texts are alike if their sets of distinct shingles of ``size`` words have a Jaccard
    index of ``least`` or more; the search for such pairs is exact. A row is told by its id
    and text, so an id with several texts may stay with some of them, and rows without
    an id are compared like others and come last. Of rows equal in both one stays.
    """
    return _first_of_groups(docs, copy_groups(docs, size, least))


def drop_copies(docs: DataFrame, size: int = 5, least: float = 0.8, prints: int = 3, radius: int = 3) -> DataFrame:
    """The documents with one left of each group that links of :func:`drop_near_copies` and of
    :func:`drop_fingerprint_copies` join together, so that all goes that either of them drops."""
    return _first_of_groups(docs, copy_groups(docs, size, least, prints, radius))


def _first_of_groups(docs: DataFrame, groups: DataFrame) -> DataFrame:
    groups = materialize(groups.select("doc_id", "t", "group"), "copies-members")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("first_id"), F.col("t").alias("first_t"))
    first = groups.groupBy(F.col("group").alias("_group")).agg(F.min(order).alias("f")).select("_group", "f.first_id", "f.first_t")
    gone = (
        groups.join(broadcast_if_small(first, "copies-heads"), F.col("group") == F.col("_group"))
        .filter(~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("t") == F.col("first_t"))))
        .select(F.col("doc_id").alias("_gone"), F.col("t").alias("_gone_t")).distinct()
    )
    repeated = (
        groups.groupBy(F.col("doc_id").alias("_again"), F.col("t").alias("_again_t")).count()
        .filter(F.col("count") > 1).select("_again", "_again_t")
    )
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").cast("bigint").alias("_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"),
    )
    same = lambda i, t: F.col("_id").eqNullSafe(F.col(i)) & (F.col("_t") == F.col(t))
    kept = rows.join(broadcast_if_small(gone, "copies-gone"), same("_gone", "_gone_t"), "left_anti")
    again = broadcast_if_small(repeated, "copies-again")
    if not again.isEmpty():
        one = kept.join(again, same("_again", "_again_t"), "left_semi").groupBy("_id", "_t").agg(
            F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row")
        )
        single = kept.join(again, same("_again", "_again_t"), "left_anti")
        kept = single.select("_row").unionByName(one.select("_row"))
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
