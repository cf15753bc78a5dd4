"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source the documents stand in
key order: the key range is cut into slices, prefix sums over the slices and then
inside the one slice where the source's budget ends find the exact cut. A source
whose budget is above its size is read again, up to ``max_epochs`` times. Only a
row for each source comes out of this, so the documents are never shuffled.

Nulls and odd input: a missing text has size 0 and is never taken; a missing
source is a source of its own, last in order; rows with the same id (or none) have
keys of their own by their texts, and only rows equal in both, at the cut, share what is
left evenly, rounded down; an empty
table gives an empty result. Columns other than id, text and
source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import SPACE, SPACE_CHARS, hash_key, key_slice, slice_count, word_count
from rollcall.operators.rank import rank_rows
from rollcall.session import broadcast_if_small, materialize

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 17


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source: ``sid``, ``source_size``, ``target``, ``slices``.

    The targets share the total size by weight. None may pass ``max_epochs``
    times its source; what is above goes to the others by weight, again and again
    until none is above. Each round takes two sums over the sources.
    """
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), slice_count(F.count("*")).alias("slices")
    )
    ranked = rank_rows(totals, [F.col("source").asc_nulls_last()], "sid", "mix-sources")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")
    )
    sources = materialize(ranked.withColumn("weight", weight), "mix-weights")
    cap = F.lit(max_epochs) * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # target of a source for each unit of weight
    while True:
        above = cap < F.col("weight") * F.lit(level)
        spent, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        new = (total - spent) / open_weight if open_weight else level
        if new <= level:
            break
        level = new
    share = (F.col("weight") * F.lit(float(total - spent))) / F.lit(float(open_weight or 1))
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(F.least(share, cap.cast("double"))))


def cuts(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Where each source's last epoch ends: ``cut`` key, words ``left`` there, ``sharers``."""
    rows = sized.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        "sid", "key", "size", "rest", key_slice(F.col("key"), F.col("slices")).alias("slice")
    )
    earlier = Window.partitionBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(earlier.orderBy("slice")), F.lit(0))
    ends_here = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    last = (
        rows.groupBy("sid", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        .withColumn("before", before).filter(ends_here)
        .select("sid", "slice", F.col("before").alias("_base"))
    )
    inside = (
        rows.join(broadcast_if_small(last, "mix-slices"), ["sid", "slice"])
        .groupBy("sid", "key")
        .agg(
            F.sum("size").alias("words"), F.count("*").alias("sharers"),
            F.first("rest").alias("rest"), F.first("_base").alias("_base"),
        )
    )
    before = F.col("_base") + F.coalesce(F.sum("words").over(earlier.orderBy("key")), F.lit(0))
    return inside.withColumn("before", before).filter(ends_here).select(
        F.col("sid").alias("_sid"), F.col("key").alias("cut"),
        (F.col("rest") - F.col("before")).alias("left"), "sharers",
    )


def row_key(seed: int) -> Column:
    """Hash-random key of a row, by its id and text."""
    return hash_key(F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")), seed=seed)


def mix_plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Ids, sources, sizes and keys of the documents; one row of decisions for each source."""
    sized = materialize(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            row_key(seed).alias("key"),
        ),
        "mix-sizes",
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    sources = broadcast_if_small(
        source_targets(sized, weights, max_epochs)
        .withColumnRenamed("source", "_source")
        .withColumn("epochs", epochs.cast("bigint"))
        .withColumn("rest", (budget - F.col("epochs") * F.col("source_size")).cast("bigint"))
        .drop("weight"),
        "mix-targets",
    )
    plan = sources.join(cuts(sized, sources), F.col("sid") == F.col("_sid"), "left").drop("_sid")
    return sized, broadcast_if_small(plan, "mix-plan")


def taken(size: Column, key: Column) -> Column:
    """Words taken of a document of this size and key, next to its source's decisions."""
    part = (
        F.when(F.col("cut").isNull() | (key > F.col("cut")), F.lit(0))
        .when(key < F.col("cut"), size)
        .otherwise(F.least(size, F.floor(F.col("left") / F.col("sharers"))))
    )
    return (F.col("epochs") * size + part).cast("bigint")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """Words the mix takes of every document.

    Columns: doc_id, source, size, source_size, target, taken. A source's
    ``taken`` add up to its target, rounded down, exactly: whole epochs, then
    documents in key order, the last one cut.
    """
    sized, plan = mix_plan(docs, weights, max_epochs, seed)
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        taken(F.col("size"), F.col("key")).alias("taken"),
    )


def mix_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each epoch of a document.

    The document at which a budget ends has its last copy cut after the words
    that are left. Documents of which nothing is taken go.
    """
    _, plan = mix_plan(docs, weights, max_epochs, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(
        row, F.col("source").alias("_src"), word_count(F.col("text")).alias("_size"),
        row_key(seed).alias("_key"),
    )
    chosen = rows.join(plan, F.col("_src").eqNullSafe(F.col("_source"))).select(
        "_row", "_size", taken(F.col("_size"), F.col("_key")).alias("_taken")
    ).filter(F.col("_taken") > 0)
    copies = F.ceil(F.col("_taken") / F.col("_size")).cast("int")
    each = chosen.select("_row", "_size", "_taken", F.explode(F.sequence(F.lit(1), copies)).alias("_copy"))
    words = F.least(F.col("_size"), F.col("_taken") - F.col("_size") * (F.col("_copy") - 1)).cast("int")
    head = F.array_join(F.slice(F.split(F.btrim(F.col("_row.text"), F.lit(SPACE_CHARS)), SPACE), 1, words), " ")
    text = F.when(words < F.col("_size"), head).otherwise(F.col("_row.text"))
    return each.select(
        *[text.alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    )
