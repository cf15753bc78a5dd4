"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


BROADCAST_ROWS = 5_000_000
BROADCAST_BYTES = 64 << 20  # of the table the driver builds, in which a row stands twice: as key and whole
ROW_BYTES = 32


def local_session(
    app: str = "rollcall", cores: int | str = 8, memory: str = "8g", shared: str | None = None
) -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a fresh temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rollcall-"))
    return sc.getCheckpointDir()


_RUNS: list[str] = []  # folders of the runs that are open, the innermost last


def scratch_path(spark: SparkSession, label: str) -> str:
    return os.path.join(_RUNS[-1] if _RUNS else shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Tables written in this block go to a folder of their own, which goes when it ends.

    Results that are still to be read have to be written elsewhere inside the block.
    """
    folder = scratch_path(spark, "run")
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, for results used more than once.

    Later stages read it with pruned columns and known size, and a lost executor
    costs a re-read instead of the whole lineage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes; only texts and nested columns are looked at."""
    size = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            size = size + 8
    return size


def measured(df: DataFrame, label: str) -> tuple[DataFrame, int, bool]:
    """The frame written out, its rows, and whether it is small enough to broadcast."""
    table = materialize(df, label)
    rows, size = table.agg(F.count("*"), F.sum(row_bytes(table))).first()
    return table, rows, rows <= BROADCAST_ROWS and 2 * (size or 0) + ROW_BYTES * rows <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, label: str) -> DataFrame:
    """The frame written out and measured, with a broadcast hint when it is small.

    For the computed side of a join whose other side is a whole catalog or all
    texts: known before the join starts, a small side spares the large one its
    shuffle. A side above the limits is joined by shuffle.
    """
    table, _, small = measured(df, label)
    return F.broadcast(table) if small else shuffled(table)


def shuffled(df: DataFrame) -> DataFrame:
    """The frame as a side of a join that Spark must not broadcast.

    Spark goes by the bytes of files, of which a few columns of a wide table, or repetitive
    ones, are a small part; the rows they unpack to need not fit the driver.
    """
    return df.hint("merge")
