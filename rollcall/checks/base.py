"""Registry and the stand-in inputs several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


SPLIT_ROWS = 100_000


def check(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table; ``spread`` is for queries that work long on every row.

    A table of one small file is one task. It is spread over the cores then, and by its
    key if a task would still have more than ``SPLIT_ROWS`` rows, which a few row groups of
    narrow columns easily have; a table with enough splits is left as it is.
    """
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    if not spread:
        return df
    cores, splits = spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    tasks = -(-df.count() // SPLIT_ROWS)
    if tasks > splits:
        return df.repartition(max(tasks, cores), df.columns[0])
    return df.repartition(cores) if splits < cores else df


def geography(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """All customers as catalog rows, with gaps where the balance says so."""
    bal = F.col("c_acctbal")
    rows = table(spark, sf, "customer").join(
        geography(spark, sf), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rows.select(
        F.col("c_custkey").alias("row_id"),
        F.col("c_name").alias("name"),
        F.when(bal >= 0, F.col("c_mktsegment")).alias("company"),
        F.when(F.col("r_name") == "ASIA", "国内").when(F.col("r_name") != "EUROPE", "国外").alias("region"),
        F.when(bal >= 5000, "开源").when(bal >= 0, "闭源").otherwise("未知").alias("openness"),
        F.when(bal < 7000, F.concat(F.floor(bal).cast("string"), F.lit("B"))).alias("size"),
        F.col("n_name").alias("type"),
        F.when(bal >= 3000, "thinking").otherwise("non-thinking").alias("reasoning"),
        F.lit("通用对话").alias("task_type"),
        F.when(bal < 2000, "").otherwise(F.concat(F.lit("http://example.com/"), "c_custkey")).alias("website"),
        F.when(bal < 1000, " nan ").when(bal < 6000, F.concat(F.lit("note "), "c_mktsegment")).alias("note"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")), "yyyy-MM-dd").alias("released_at"),
        F.when(bal >= 4000, "New").when(bal < -500, " 是 ").alias("is_new"),
        F.when(bal < 3000, "nan").otherwise("seen").alias("verification"),
        bal.alias("balance"),
    )


CATALOG_SQL = """
catalog as (
  select c_custkey as row_id, c_name as name,
    case when c_acctbal >= 0 then c_mktsegment end as company,
    case when r_name = 'ASIA' then '国内' when r_name <> 'EUROPE' then '国外' end as region,
    case when c_acctbal >= 5000 then '开源' when c_acctbal >= 0 then '闭源' else '未知' end as openness,
    case when c_acctbal < 7000 then cast(cast(floor(c_acctbal) as bigint) as varchar) || 'B' end as size,
    n_name as type,
    case when c_acctbal >= 3000 then 'thinking' else 'non-thinking' end as reasoning,
    '通用对话' as task_type,
    case when c_acctbal < 2000 then '' else 'http://example.com/' || c_custkey end as website,
    case when c_acctbal < 1000 then ' nan ' when c_acctbal < 6000 then 'note ' || c_mktsegment end as note,
    strftime(date '2024-01-01' + c_nationkey, '%Y-%m-%d') as released_at,
    case when c_acctbal >= 4000 then 'New' when c_acctbal < -500 then ' 是 ' end as is_new,
    case when c_acctbal < 3000 then 'nan' else 'seen' end as verification,
    c_acctbal as balance
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as articles; the source number gives the day in the title."""
    day = (F.lit(20240101) + F.substring("source", 4, 9).cast("int")).cast("string")
    return table(spark, sf, "documents", spread=True).select(
        F.col("doc_id"),
        F.concat(F.lit("doc"), "doc_id").alias("file"),
        F.col("doc_id").cast("int").alias("seq"),
        F.concat_ws(" ", "source", day, "doc_id").alias("title"),
        F.concat(F.lit("http://example.com/"), "doc_id").alias("link"),
        day.alias("published"),
        day.cast("int").alias("date_int"),
        F.col("text").alias("body"),
    )


ARTICLES_SQL = """
articles as (
  select doc_id, 'doc' || doc_id as file, cast(doc_id as integer) as seq,
    source || ' ' || (20240101 + cast(substr(source, 4) as integer)) || ' ' || doc_id as title,
    'http://example.com/' || doc_id as link,
    cast(20240101 + cast(substr(source, 4) as integer) as varchar) as published,
    20240101 + cast(substr(source, 4) as integer) as date_int,
    text as body
  from documents
)"""

# a name is any capitalised word of five letters or more, anywhere in a text
NAME_PATTERN = "[A-Z][a-z]{4,}"


def names_in(column: str):
    return F.regexp_extract_all(F.col(column), F.lit(f"({NAME_PATTERN})"), 1)
