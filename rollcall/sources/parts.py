"""A catalog in parts of its row id, of which an update rewrites only those it touches."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.maintain import SIGN
from rollcall.session import broadcast_if_small, materialize

PART = "_part"
PART_ROWS = 1_000_000  # ids in a part, at least
MOST_PARTS = 1024  # a catalog that would have more gets larger parts, so their number doesn't grow with it
_LAYOUT = "_layout"  # beside the parts, where no reader looks


def part_size(df: DataFrame, row_id: str, part_rows: int, most: int) -> int:
    """``part_rows``, or four times as many and so on until the ids of ``df`` lie in about ``most`` parts or fewer."""
    sizes = [part_rows << k for k in range(0, 63 - part_rows.bit_length(), 2)]
    counts = df.agg(*[F.approx_count_distinct(F.floor(F.col(row_id) / s)) for s in sizes]).first()
    return next((s for s, n in zip(sizes, counts, strict=True) if n <= most), sizes[-1])


def stored_size(spark: SparkSession, path: str, part_rows: int) -> int:
    """Ids in a part of the catalog as it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_LAYOUT}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return part_rows
    return spark.read.schema("part_rows bigint").parquet(f"{path}/{_LAYOUT}").first()[0]


def _placed(df: DataFrame, row_id: str, part_rows: int) -> DataFrame:
    return df.withColumn(PART, F.floor(F.col(row_id) / part_rows).cast("bigint"))


def _write(df: DataFrame, path: str) -> None:
    # the rows of a part come from one task, so a part is one file; the number of tasks is given, as
    # they take as long as their files are many, however few the bytes
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(tasks, PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(PART).parquet(path)
    )


def write_parts(df: DataFrame, path: str, row_id: str = "row_id", part_rows: int = PART_ROWS) -> None:
    """The whole catalog; ids are whole numbers and none is missing.

    A part has ``part_rows`` ids, or so many more that there are about ``MOST_PARTS`` of them.
    """
    spark = df.sparkSession
    size = part_size(df, row_id, part_rows, MOST_PARTS)
    spark.range(1).select(F.lit(size).cast("bigint").alias("part_rows")).write.mode("overwrite").parquet(f"{path}/{_LAYOUT}")
    placed, old = _placed(df, row_id, size), _stored_parts(spark, path)
    gone = old - {r[0] for r in placed.select(PART).distinct().collect()} if old else set()
    _write(placed, path)
    _remove(spark, path, gone)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


class Update(NamedTuple):
    parts: list[int]  # the parts rewritten
    deltas: DataFrame  # old versions of the ids with ``_sign`` -1, new ones with 1


def upsert_parts(
    spark: SparkSession, path: str, changed: DataFrame, row_id: str = "row_id", part_rows: int = PART_ROWS,
    removed: DataFrame | None = None,
) -> Update:
    """Put changed and new rows in place and take ``removed`` ids out.

    ``changed`` holds whole rows, one for each id. Parts without any of these ids are neither
    read nor written. The new contents are whole before the first part is replaced, and
    each part depends on the change alone, so a run that broke off is repeated as it was;
    the deltas are those of the run that found the parts unchanged. ``part_rows`` is that of
    :func:`write_parts`; parts that were made larger stay so.
    """
    part_rows = stored_size(spark, path, part_rows)
    changed = materialize(_placed(changed, row_id, part_rows), "changed-rows")
    ids = changed.select(row_id, PART)
    if removed is not None:
        ids = ids.unionByName(_placed(removed.select(row_id), row_id, part_rows))
    ids = materialize(ids.distinct(), "changed-ids")
    touched = sorted(r[0] for r in ids.select(PART).distinct().collect())  # at most a number for each part
    stored = spark.read.parquet(path).filter(F.col(PART).isin(touched)).select(*changed.columns)
    named = broadcast_if_small(ids.select(row_id), "replaced")
    signed = lambda df, n: df.drop(PART).withColumn(SIGN, F.lit(n).cast("bigint"))
    deltas = signed(stored.join(named, row_id, "left_semi"), -1).unionByName(signed(changed, 1))
    deltas = materialize(deltas, "deltas")
    rows = materialize(stored.join(named, row_id, "left_anti").unionByName(changed), "new-parts")
    _write(rows, path)
    _remove(spark, path, set(touched) - {r[0] for r in rows.select(PART).distinct().collect()})
    return Update(touched, deltas)


def _stored_parts(spark: SparkSession, path: str) -> set[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return {int(n.split("=")[1]) for n in names if n.startswith(f"{PART}=")}


def _remove(spark: SparkSession, path: str, parts: set[int]) -> None:
    for part in parts:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PART}={part}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
