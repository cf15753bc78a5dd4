"""Helpers the training-data operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# words as all contracts count them: anything between ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

KEY_BITS = 60
SLICE_ROWS = 50_000


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    A driver may have found the package by a path that its executors don't search.
    """
    sc = spark.sparkContext
    if getattr(sc, "_rollcall_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    base = os.path.join(tempfile.mkdtemp(prefix="rollcall-code-"), "rollcall_code")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "rollcall"))
    sc._rollcall_shipped = True


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words as a long; a missing text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hash_key(*parts: Column, seed: int = 0) -> Column:
    """Evenly spread key of 60 bits, the leading digits of an MD5, never null."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def held_out(doc_id: Column) -> Column:
    """The fold kept from learning: crc32 of the id as text divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slice_count(rows: Column, slice_rows: int = SLICE_ROWS) -> Column:
    """Slices for a group of so many rows; one task never gets a whole large group."""
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(slice_rows))).cast("bigint")


def key_slice(key: Column, slices: Column) -> Column:
    """Which of so many equal parts of the key range a ``hash_key`` lies in."""
    return F.shiftright(F.shiftright(key, KEY_BITS - 30) * slices, 30)


def prefix_sums(
    df: DataFrame, group: str, slices: str, key: str, ties: list[Column], value: Column, out: str
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group, in the order of ``key`` and ``ties``.

    ``key`` is a ``hash_key``, so cutting its range into ``slices`` equal parts
    (a column, the same for all rows of a group) gives slices of about equal
    size. Each slice is summed where its rows are; only one total per slice is
    summed over the group. A group with a third of all rows becomes many slices.
    Ties that are equal in everything are repeated rows, which may change places.
    """
    cut = key_slice(F.col(key), F.col(slices)).alias("_slice")
    cut_rows = df.select("*", cut, value.cast("bigint").alias("_value"))
    earlier = Window.partitionBy("_g").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        cut_rows.groupBy(F.col(group).alias("_g"), F.col("_slice").alias("_s"))
        .agg(F.sum("_value").alias("_sum"))
        .select("_g", "_s", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    within = (
        Window.partitionBy(group, "_slice").orderBy(F.col(key), *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = cut_rows.withColumn("_inner", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    joined = inner.join(totals, (F.col(group) == F.col("_g")) & (F.col("_slice") == F.col("_s")))
    return joined.withColumn(out, F.col("_before") + F.col("_inner")).drop(
        "_g", "_s", "_slice", "_value", "_before", "_inner"
    )
