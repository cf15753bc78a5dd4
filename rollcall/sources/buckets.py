"""Catalog snapshots in hash buckets of their key.

A snapshot is shuffled once, when it is written. Comparing two of them, finding a key's last row and
filling cells then read each bucket where it lies: no exchange stands above either scan,
only the incoming rows travel to the buckets. All snapshots of a catalog have the same
number of buckets.

Rows without a key are spread by their content under keys of their own that no incoming
key equals. A key that very many rows share makes its one bucket that large; only
the columns asked for are read of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.text import exact_key

KEY = "_key"
BUCKETS = 64
KEYLESS = "\x00"


def _stored_key(df: DataFrame, key: Column) -> Column:
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return F.coalesce(key, F.concat(F.lit(KEYLESS), row.cast("string")))


def has_key(key: Column | str = KEY) -> Column:
    return ~(F.col(key) if isinstance(key, str) else key).startswith(KEYLESS)


def write_buckets(
    df: DataFrame, name: str, path: str, key: Column | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """The snapshot as table ``name`` at ``path``, one file for each bucket, sorted by key; the table."""
    keyed = df.withColumn(KEY, _stored_key(df, exact_key("name") if key is None else key))
    (
        keyed.repartition(buckets, KEY).write.mode("overwrite").format("parquet")
        .bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(name)
    )
    return df.sparkSession.table(name)


def open_buckets(
    spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: int = BUCKETS
) -> DataFrame:
    """A snapshot an earlier session wrote; ``schema`` is that of the rows, without the stored key."""
    quoted = lambda s: s.replace("`", "``")
    columns = ", ".join(f"`{quoted(f.name)}` {f.dataType.simpleString()}" for f in [*schema, T.StructField(KEY, T.StringType())])
    spark.sql(
        f"create table if not exists `{quoted(name)}` ({columns}) using parquet "
        f"clustered by ({KEY}) sorted by ({KEY}) into {buckets} buckets location '{path}'"
    )
    return spark.table(name)
