"""Sorting, top-k, distributed numbering, batches and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.text import as_col
from rollcall.session import broadcast_if_small, materialize


def by_date_desc(df: DataFrame, day: Column | str, pos: str) -> DataFrame:
    """Newest first, rows without a date last, ingest order among equals."""
    return df.orderBy(F.nullif(as_col(day), F.lit("")).desc_nulls_last(), F.col(pos))


def top_n(df: DataFrame, order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of a total order with a 1-based rank.

    The window runs after the limit, over ``n`` rows only.
    """
    w = Window.partitionBy(F.lit(1)).orderBy(*order)
    return df.orderBy(*order).limit(n).withColumn(rank, F.row_number().over(w).cast("bigint"))


def top_per_group(
    df: DataFrame, groups: list[str], order: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows per group; Spark limits every map task to ``k`` rows per group."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return (
        df.withColumn(rank, F.row_number().over(w))
        .filter(F.col(rank) <= k)
        .withColumn(rank, F.col(rank).cast("bigint"))
    )


def overflow(count: Column, k: int) -> Column:
    """How many rows of a group are not among its first ``k``."""
    return F.greatest(count - k, F.lit(0))


def top_counts(df: DataFrame, value: str, n: int, first: str, count: str = "n") -> DataFrame:
    """Most frequent values; equal counts in order of first appearance."""
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count("*").alias(count), F.min(first).alias("_first"))
    )
    return top_n(counted, [F.col(count).desc(), F.col("_first")], n).drop("_first")


def rank_rows(df: DataFrame, order: list[Column], out: str, label: str = "ranked") -> DataFrame:
    """Position of every row from 0 in a total order, without one global window.

    Rows are range-partitioned and written with the number of their partition;
    one count per partition gives the offsets, so a partition is ranked by itself.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
        .select("_p", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("_part").orderBy(*order)
    return (
        ranged.withColumn("_inner", F.row_number().over(within))
        .join(F.broadcast(offsets), F.col("_part") == F.col("_p"))  # a row per partition
        .withColumn(out, F.col("_before") + F.col("_inner") - 1)
        .drop("_part", "_p", "_before", "_inner")
    )


def number_rows(df: DataFrame, order: str, start: int | Column = 0, out: str = "seq") -> DataFrame:
    """Consecutive numbers ``start+1, start+2, ..`` in the order of a unique numeric column.

    The rows are written once; only their order column is ranked, and the numbers
    are joined back.
    """
    rows = materialize(df, "unnumbered")
    ranks = rank_rows(rows.select(F.col(order).alias("_order")), [F.col("_order")], "_rank", "order")
    base = start if isinstance(start, Column) else F.lit(start)
    numbered = rows.join(broadcast_if_small(ranks, "ranks"), F.col(order) == F.col("_order"))
    return numbered.withColumn(out, (F.col("_rank") + 1 + base).cast("bigint")).drop("_order", "_rank")


def batches(df: DataFrame, order: str, size: int = 20, out: str = "batch") -> DataFrame:
    """Batch id of every row: its position divided by the batch size."""
    numbered = number_rows(df, order, out="_seq")
    return numbered.withColumn(out, F.floor((F.col("_seq") - 1) / size)).drop("_seq")


def share_of_max(counts: DataFrame, groups: list[str], value: str, out: str = "share") -> DataFrame:
    """Every count as a part of the largest one in its group, for bar lengths.

    The maxima are one row per group and come from a grouped aggregate, so a
    group with very many values is not pulled into one task.
    """
    top = broadcast_if_small(counts.groupBy(*groups).agg(F.max(value).alias("_max")), "maxima")
    return (
        counts.join(top, groups)
        .withColumn(out, F.when(F.col("_max") > 0, F.col(value) / F.col("_max")).otherwise(0.0))
        .drop("_max")
    )


def preview(df: DataFrame, groups: list[str], value: str, n: int, sep: str = ", ") -> DataFrame:
    """First ``n`` values per group as text, with the full count and a more flag."""
    total = df.groupBy(*groups).agg(F.count("*").alias("total"))
    head = (
        top_per_group(df.select(*groups, value), groups, [F.col(value)], n)
        .groupBy(*groups)
        .agg(F.array_sort(F.collect_list(value)).alias("_head"))
    )
    return head.join(total, groups).select(
        *groups,
        "total",
        F.concat(
            F.array_join("_head", sep), F.when(F.col("total") > n, "...").otherwise("")
        ).alias("preview"),
    )
