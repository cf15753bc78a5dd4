"""Document fingerprints by order MinHash, in column expressions only.

The k-mers of a text are runs of ``k`` words. Each is numbered by its occurrence,
so that a repeated k-mer counts as often as it stands there, and hashed. The hash
range is cut into ``BINS`` equal bins (one permutation does for all of them). In
each bin the two smallest numbered k-mers are selected, put back into text order
and hashed as a pair; these hashes are the fingerprint. Changed words and moved
passages both break pairs.

``likeness`` turns the share p of equal pairs into the share of k-mers two texts
have in common: sqrt(p) estimates their Jaccard index J, and 2J/(1+J) is the part
of k-mers kept, which for texts of equal length falls with the edits.

Nulls and odd input: a missing text is empty; an empty text has the empty
fingerprint, alike (1) to another empty one and unlike (0) to all others; a text of
fewer than ``k`` words is one k-mer. Equal texts have equal fingerprints. Repeated
rows are documents of their own and stand beside each other in text order; a missing
id comes last in descending order. Columns other than doc_id and text are not read.
A text may hold 2**30 words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import SPACE, SPACE_CHARS, let

K = 3
BINS = 64
POS_BITS = 30  # of a 64-bit value: hash above, position of the k-mer below
BIN_BITS = 6
HASH_MASK = -(1 << POS_BITS)
POS_MASK = (1 << POS_BITS) - 1
PAIR_BITS = 32 - BIN_BITS


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def _value(h: Column, pos: Column) -> Column:
    return h.bitwiseAND(F.lit(HASH_MASK)).bitwiseOR(pos.cast("bigint"))


def _hash(value: Column) -> Column:
    return F.shiftright(value, POS_BITS)


def _pos(value: Column) -> Column:
    return value.bitwiseAND(F.lit(POS_MASK))


def _bin(value: Column) -> Column:
    return F.shiftright(value, 64 - BIN_BITS)


def _repeats(s: Column) -> Column:
    """Of a sorted array, the values whose hash stands just before them as well."""
    return F.filter(s, lambda x, i: (i > 0) & (_hash(x) == _hash(F.get(s, i - 1))))


def _numbered(reps: Column) -> Column:
    """Repeated k-mers with their occurrence number (from 1) hashed in."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(reps) - 1),
        lambda i: (i == 0) | (_hash(F.get(reps, i)) != _hash(F.get(reps, i - 1))),
    )
    return let(starts, lambda st: F.flatten(F.transform(
        st,
        lambda a, j: F.transform(
            F.sequence(a, F.coalesce(F.get(st, j + 1), F.size(reps)) - 1),
            lambda i: _value(F.xxhash64(_hash(F.get(reps, i)), i - a + 1), _pos(F.get(reps, i))),
        ),
    )))


def _numbered_kmers(kmers: Column) -> Column:
    """Hashes of occurrence-numbered k-mers with their positions, sorted by hash.

    The first occurrence keeps the hash of the k-mer itself.
    """
    return let(kmers, lambda s: let(_repeats(s), lambda reps: F.when(F.size(reps) == 0, s).otherwise(
        F.sort_array(F.concat(
            F.filter(s, lambda x, i: (i == 0) | (_hash(x) != _hash(F.get(s, i - 1)))), _numbered(reps)
        ))
    )))


def _kmers(words: Column) -> Column:
    n = F.size(words)
    runs = F.transform(
        F.sequence(F.lit(0), n - K),
        lambda i: _value(F.xxhash64(*[F.get(words, i + j) for j in range(K)]), i),
    )
    whole = F.array(_value(F.xxhash64(F.array_join(words, " ")), F.lit(0)))
    return F.sort_array(
        F.when(n == 0, F.array().cast("array<bigint>")).when(n < K, whole).otherwise(runs)
    )


def _pairs(picked: Column) -> Column:
    """Selected values, sorted by bin and hash, to one hash for each bin."""
    starts = F.filter(
        F.transform(picked, lambda x, i: F.when((i == 0) | (_bin(x) != _bin(F.get(picked, i - 1))), i)),
        lambda i: i.isNotNull(),
    )

    def one(i: Column) -> Column:
        a, b = F.get(picked, i), F.get(picked, i + 1)
        alone = b.isNull() | (_bin(a) != _bin(b))
        pair = (
            F.when(alone, F.xxhash64(_hash(a)))
            .when(_pos(a) <= _pos(b), F.xxhash64(_hash(a), _hash(b)))
            .otherwise(F.xxhash64(_hash(b), _hash(a)))
        )
        low = pair.bitwiseAND(F.lit((1 << PAIR_BITS) - 1))
        return F.shiftleft(_bin(a), PAIR_BITS).bitwiseOR(low).cast("int")

    return F.transform(starts, one)


def fingerprint(text: Column) -> Column:
    """Array of one int for each bin that has k-mers: bin number above, pair hash below."""
    return let(words_of(text), lambda w: let(_numbered_kmers(_kmers(w)), lambda v: let(
        F.filter(v, lambda x, i: (i < 2) | (_bin(x) != _bin(F.get(v, i - 2)))), _pairs
    )))


def as_text(fp: Column) -> Column:
    """Eight hex digits for each bin."""
    return F.array_join(
        F.transform(fp, lambda c: F.lpad(F.lower(F.hex(c.cast("bigint") + F.lit(1 << 31))), 8, "0")), ""
    )


def likeness(a: Column, b: Column) -> Column:
    bins = lambda fp: F.transform(fp, lambda c: F.shiftright(c, PAIR_BITS))
    either = F.size(a) + F.size(b) - F.size(F.array_intersect(bins(a), bins(b)))
    jaccard = F.sqrt(F.size(F.array_intersect(a, b)) / either)
    return F.when(either == 0, F.lit(1.0)).otherwise(2 * jaccard / (1 + jaccard))


def _slices(docs: DataFrame) -> tuple[Column, DataFrame]:
    """Slice number of a document by descending id, and the first id of the next slice.

    The bounds are quantiles of the ids, a few for each shuffle partition; they
    and one row per slice are all that is shared.
    """
    spark = docs.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    found = ids.select(
        F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("b")
    ).first()["b"] or []
    bounds = F.array(*[F.lit(int(b)) for b in sorted(set(found))]).cast("array<bigint>")
    number = F.when(
        F.col("doc_id").isNotNull(), -F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))
    ).otherwise(1)
    order = Window.orderBy("slice")  # one row per slice
    heads = (
        ids.select(number.alias("slice"), "doc_id").groupBy("slice").agg(F.max("doc_id").alias("head"))
        .withColumn("at", F.row_number().over(order)).withColumn("n", F.count("*").over(Window.partitionBy(F.lit(1))))
    )
    after = heads.select((F.col("at") - 1).alias("before"), F.col("head").alias("next_head"))
    return number, heads.join(
        after, F.col("before") == F.col("at") % F.col("n")
    ).select("slice", "next_head")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fp of every document and of the next one by descending id.

    After the last document comes the first. Documents are sorted inside slices of
    the id range; only the first document of every slice is looked up apart.
    """
    number, heads = _slices(docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", fingerprint(F.col("text")).alias("fp"), number.alias("slice")
    )
    inside = Window.partitionBy("slice").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text"))
    led = rows.withColumn("led", F.lead(F.struct("text", "fp")).over(inside))
    first = (
        docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
        .join(F.broadcast(heads), F.col("_id").eqNullSafe(F.col("next_head")))  # a row per slice
        .groupBy(F.col("slice").alias("_slice")).agg(F.min("_text").alias("_text"))
        .select("_slice", F.struct(F.col("_text").alias("text"), fingerprint(F.col("_text")).alias("fp")).alias("_head"))
    )
    joined = led.join(first, F.col("slice") == F.col("_slice"), "left")
    return joined.select("doc_id", "text", "fp", F.coalesce("led", "_head").alias("next"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by the start of another text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(
        F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half)
    )


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    rows = with_next(docs).select(
        "doc_id", "text", "fp", "next.fp", edited(F.col("text"), F.col("next.text")).alias("edited")
    ).toDF("doc_id", "text", "fp", "next_fp", "edited")
    made = rows.select("*", F.explode_outer(F.array(fingerprint(F.col("edited")))).alias("edited_fp"))
    return made.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
