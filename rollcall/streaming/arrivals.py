"""New entities from files as they arrive, each stored once.

A run takes all files that have come since the last one and ends. The checkpoint remembers which
files belong to which batch; a batch writes one partition of the table, named by its
number, and looks only at the partitions of others for names that are known. So a batch that
broke off, in the middle or after its write, is repeated with the same files and
replaces exactly what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.match import new_only

BATCH = "batch_id"


def stored_rows(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """All rows stored so far with the number of their batch; none before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    whole = T.StructType([*schema, T.StructField(BATCH, T.LongType())])
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(table)


def store_new(
    batch: DataFrame, number: int, table: str, order: list[str], name: str = "name", known: DataFrame | None = None
) -> None:
    """Write the batch's first row of every name that neither ``known`` nor another batch has."""
    spark = batch.sparkSession
    others = stored_rows(spark, table, batch.schema).filter(F.col(BATCH) != number).select(name)
    if known is not None:
        others = others.unionByName(known.select(name))
    fresh = new_only(batch, others, order, name).withColumn(BATCH, F.lit(number).cast("bigint"))
    (
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH).parquet(table)
    )


def run_arrivals(
    spark: SparkSession, folder: str, schema: T.StructType, table: str, checkpoint: str, order: list[str],
    name: str = "name", known: DataFrame | None = None, files_a_batch: int | None = None,
    each: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Take every Parquet file of the folder that has not been taken yet, in batches, and end.

    ``each`` replaces :func:`store_new` as what is done with a batch.
    """
    reader = spark.readStream.schema(schema)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)

    def take(batch: DataFrame, number: int) -> None:
        (each or (lambda df, n: store_new(df, n, table, order, name, known)))(batch, number)

    (
        reader.parquet(folder).writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )
