"""Comparing and accumulating catalog snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions.text import exact_key
from rollcall.operators.dedupe import drop_blank, first_wins
from rollcall.session import broadcast_if_small
from rollcall.sources.buckets import has_key

ADDED, KEPT, MISSING = "added", "kept", "missing"


def _row_counts(new: DataFrame, old: DataFrame, key: Column | str) -> DataFrame:
    """Rows per trimmed key on either side; one shuffle with map-side combine."""
    side = lambda df, n, o: df.select(
        exact_key(key).alias("key"), F.lit(n).alias("_n"), F.lit(o).alias("_o")
    )
    both = side(new, 1, 0).unionByName(side(old, 0, 1))
    return both.groupBy("key").agg(F.sum("_n").alias("n_new"), F.sum("_o").alias("n_old"))


def diff_snapshots(new: DataFrame, old: DataFrame, key: Column | str = "name") -> DataFrame:
    """Every distinct trimmed key with its status; null keys out."""
    in_new, in_old = F.col("n_new") > 0, F.col("n_old") > 0
    return _row_counts(new, old, key).filter(F.col("key").isNotNull()).select(
        "key", F.when(in_new & in_old, KEPT).when(in_new, ADDED).otherwise(MISSING).alias("status")
    )


def diff_buckets(new: DataFrame, old: DataFrame, key: str = "_key") -> DataFrame:
    """:func:`diff_snapshots` of two snapshots in buckets: each bucket is compared where it lies."""
    side = lambda df, n: df.filter(has_key(key)).groupBy(F.col(key).alias("key")).agg(F.count("*").alias(n))
    in_new, in_old = F.col("n_new").isNotNull(), F.col("n_old").isNotNull()
    return side(new, "n_new").join(side(old, "n_old"), "key", "full").select(
        "key", F.when(in_new & in_old, KEPT).when(in_new, ADDED).otherwise(MISSING).alias("status")
    )


def diff_counts(diff: DataFrame) -> DataFrame:
    return diff.agg(
        F.count_if(F.col("status") != MISSING).alias("new_total"),
        F.count_if(F.col("status") != ADDED).alias("old_total"),
        F.count_if(F.col("status") == ADDED).alias("added"),
        F.count_if(F.col("status") == KEPT).alias("kept"),
        F.count_if(F.col("status") == MISSING).alias("missing"),
    )


def run_metrics(run_date: str, new: DataFrame, old: DataFrame, key: str = "name") -> DataFrame:
    """One log row: rows before and after, names added and missing, column count."""
    named = F.col("key").isNotNull()
    return _row_counts(new, old, key).agg(
        F.lit(run_date).alias("run_date"),
        F.coalesce(F.sum("n_old"), F.lit(0)).alias("before"),
        F.coalesce(F.sum("n_new"), F.lit(0)).alias("after"),
        F.count_if(named & (F.col("n_old") == 0)).alias("added"),
        F.count_if(named & (F.col("n_new") == 0)).alias("missing"),
        F.lit(len(new.columns)).cast("bigint").alias("columns"),
    )


def is_new_row(flag: Column | str, words: list[str] = S.NEW_FLAGS) -> Column:
    c = F.col(flag) if isinstance(flag, str) else flag
    return F.coalesce(F.lower(exact_key(c)).isin(words), F.lit(False))


def sync_only_new(
    updated: DataFrame,
    previous: DataFrame | None,
    only: DataFrame | None,
    order: list[str],
    key: str = "name",
    flag: str = "is_new",
) -> DataFrame:
    """The accumulated only-new table after this run.

    New are names the previous snapshot lacks; on a first run, rows flagged New.
    Blank names and repeats inside the batch are dropped, stored names skipped.
    """
    names = lambda df: df.select(exact_key(key).alias("_key")).distinct()
    # which names are new is found on the names alone; rows move only for those
    if previous is None:
        updated = updated.filter(is_new_row(flag, ["new"]))
    fresh = drop_blank(names(updated), F.col("_key"))
    for known in (previous, only):
        if known is not None:
            fresh = fresh.join(names(known), "_key", "left_anti")
    rows = updated.withColumn("_key", exact_key(key))
    rows = rows.join(broadcast_if_small(fresh, "new-names"), "_key", "left_semi")
    rows = first_wins(rows, ["_key"], order).drop("_key")
    return rows if only is None else only.unionByName(rows, allowMissingColumns=True)
