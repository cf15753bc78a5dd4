"""Report counts kept current from what changed between two snapshots.

A changed row is its old version taken away and its new one added; counts take the signed
sum of both. An update of a catalog in parts (``sources.parts``) gives these versions from the parts it
rewrites, so counts follow without the rest of the catalog being read; for two whole
snapshots :func:`row_deltas` finds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import strip
from rollcall.operators.stats import coverage_rows, filled

SIGN = "_sign"


def row_deltas(new: DataFrame, old: DataFrame) -> DataFrame:
    """Row versions that only one snapshot has, with ``_sign`` 1 (only the new one) or -1.

    A version that both hold, however often, appears as often as it was won or lost. Both
    frames have the same columns, none of them a map.
    """
    side = lambda df, n: df.withColumn("_n", F.lit(n).cast("bigint"))
    net = side(new, 1).unionByName(side(old, -1)).groupBy(*new.columns).agg(F.sum("_n").alias(SIGN))
    return net.filter(F.col(SIGN) != 0)


def add_up(kept: DataFrame, change: DataFrame, keys: list[str], numbers: list[str]) -> DataFrame:
    """Stored numbers by key plus their changes; keys whose numbers are all zero go."""
    both = kept.unionByName(change.select(*kept.columns))
    summed = both.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in numbers])
    some = F.lit(False)
    for n in numbers:
        some = some | (F.col(n) != 0)
    return summed.filter(some)


def dim_changes(deltas: DataFrame, dims: list[str], new: Column | None = None) -> DataFrame:
    """Changes to :func:`stats.dim_counts`: dim, value, n."""
    value = lambda d: strip(F.col(d))
    pairs = [F.struct(F.lit(d).alias("dim"), value(d).alias("value")) for d in dims]
    if new is not None:
        pairs += [F.struct(F.lit(f"new_{d}").alias("dim"), F.when(new, value(d)).alias("value")) for d in dims]
    return (
        deltas.select(SIGN, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
        .groupBy("dim", "value").agg(F.sum(SIGN).alias("n"))
    )


def org_changes(deltas: DataFrame, org: str, is_open: Column, is_recent: Column) -> DataFrame:
    """Changes to :func:`stats.org_stats`. ``is_recent`` is a fixed window; a new one is a new count."""
    n = lambda test: F.sum(F.when(test, F.col(SIGN)).otherwise(0))
    return deltas.groupBy(F.coalesce(F.col(org), F.lit("Unknown")).alias(org)).agg(
        F.sum(SIGN).alias("total"), n(is_open).alias("open"), n(is_recent).alias("recent")
    )


def category_changes(deltas: DataFrame, org: str, category: str) -> DataFrame:
    """Changes to the counts by (organisation, category) that :func:`category_lists` reads."""
    return deltas.groupBy(F.coalesce(F.col(org), F.lit("unknown")).alias(org), category).agg(F.sum(SIGN).alias("n"))


def category_lists(counts: DataFrame, org: str, category: str) -> DataFrame:
    """:func:`stats.org_categories` from its kept counts."""
    return counts.groupBy(org).agg(
        F.sum("n").alias("total"), F.array_join(F.array_sort(F.collect_set(category)), ", ").alias("categories")
    )


def coverage_changes(deltas: DataFrame, columns: list[str], mode: str = "not_null") -> DataFrame:
    """Changes to filled cells by column, and to the rows under a missing field: field, filled."""
    sums = deltas.agg(
        F.coalesce(F.sum(SIGN), F.lit(0)).alias("total"),
        *[F.coalesce(F.sum(F.when(filled(c, mode), F.col(SIGN))), F.lit(0)).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    cells = [F.struct(F.lit(c).alias("field"), F.col(f"_{i}").alias("filled")) for i, c in enumerate(columns)]
    rows = F.struct(F.lit(None).cast("string").alias("field"), F.col("total").alias("filled"))
    return sums.select(F.inline(F.array(rows, *cells)))


def coverage_table(kept: DataFrame, columns: list[str]) -> DataFrame:
    """:func:`stats.coverage` from its kept counts; a handful of rows."""
    of = lambda test: F.coalesce(F.max(F.when(test, F.col("filled"))), F.lit(0))
    wide = kept.agg(
        of(F.col("field").isNull()).alias("total"), *[of(F.col("field") == c).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    return coverage_rows(wide, columns)
