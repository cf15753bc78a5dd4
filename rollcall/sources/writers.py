"""Writers: catalog appends, snapshots, record files, article index."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions.dates import dotted
from rollcall.functions.text import safe_key, summary
from rollcall.operators.rank import number_rows
from rollcall.session import broadcast_if_small, materialize


def append_catalog(existing: DataFrame, new: DataFrame, columns: list[str] = S.CATALOG_COLUMNS) -> DataFrame:
    """Both frames with exactly the catalog columns; what a side lacks is null."""
    fixed = lambda df: df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    )
    return fixed(existing).unionByName(fixed(new))


def roll_snapshot(df: DataFrame, table: str, snapshot: str) -> None:
    """Write one snapshot partition; older ones stay as backups.

    Only the partition named is replaced, so a rerun of the same day is safe.
    """
    (
        df.withColumn("snapshot_date", F.lit(snapshot))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(table)
    )


def snapshots(spark: SparkSession, table: str) -> DataFrame:
    """All snapshots; dates stay text, as they were written."""
    return spark.read.parquet(table).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def snapshot_dates(spark: SparkSession, table: str) -> list[str]:
    """Dates of the stored snapshots, oldest first, from the names of their folders alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return sorted(unquote(n.split("=", 1)[1]) for n in names if n.startswith("snapshot_date="))


def previous_snapshot(spark: SparkSession, table: str, before: str) -> DataFrame:
    """Rows of the newest snapshot older than ``before``; no other one is read."""
    older = [d for d in snapshot_dates(spark, table) if d < before]
    day = F.lit(older[-1]) if older else F.lit(None).cast("string")
    return snapshots(spark, table).filter(F.col("snapshot_date") == day).drop("snapshot_date")


def write_records(df: DataFrame, path: str) -> None:
    """One JSON object per line; null fields are left out."""
    df.write.mode("overwrite").json(path)


def append_run_metrics(metrics: DataFrame, table: str) -> None:
    metrics.write.mode("append").parquet(table)


def usable_articles(articles: DataFrame, body: str = "body") -> DataFrame:
    """Articles with a body that is no crawl failure text."""
    text = F.coalesce(F.col(body), F.lit(""))
    failed = F.lit(False)
    for prefix in S.FAILED_BODY_PREFIXES:
        failed = failed | text.startswith(prefix)
    return articles.filter((text != "") & ~failed)


def new_articles(articles: DataFrame, existing: DataFrame, order: str, key: str = "article_key") -> DataFrame:
    """Usable articles that are not stored yet, each once, the first one read.

    An article is its whole number and title; ``existing`` has both as ``seq`` and
    ``title``. ``order`` is the unique ingest position. ``key`` is added as a short
    name to show, which several articles may share. Only numbers, titles and
    positions are grouped and joined; the bodies stay where they are unless the
    positions kept are too many to broadcast.
    """
    usable = usable_articles(articles)
    firsts = usable.groupBy("seq", "title").agg(F.min(order).alias("_first"))
    stored = existing.select(F.col("seq").alias("_seq"), F.col("title").alias("_title")).distinct()
    same = F.col("seq").eqNullSafe(F.col("_seq")) & F.col("title").eqNullSafe(F.col("_title"))
    fresh = broadcast_if_small(firsts.join(stored, same, "left_anti").select("_first"), "new-articles")
    number = F.col("seq").cast("string")
    name = F.concat_ws("_", F.lpad(number, F.greatest(F.lit(2), F.length(number)), F.lit("0")), safe_key("title"))
    return usable.join(fresh, F.col(order) == F.col("_first"), "left_semi").withColumn(key, name)


def sync_article_index(index: DataFrame, articles: DataFrame, order: str) -> DataFrame:
    """The rows to add to the article index: unknown titles, numbered from its maximum.

    ``order`` is the unique ingest position of the articles.
    """
    known = index.select("title").filter(F.col("title").isNotNull()).distinct()
    # bodies shrink to their summaries before the rows are numbered
    short = articles.select(
        order, "title", summary("body").alias("summary"), "link", dotted("published").alias("published")
    )
    fresh = materialize(short.join(known, "title", "left_anti"), "new-titles")
    top = index.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
    return number_rows(fresh, order, start=int(top), out="_seq").select(
        F.col("_seq").alias("seq"), "title", "summary", "link", "published",
        F.lit("").alias("reads"), F.lit("").alias("comments"),
    )


def article_result_rows(index_rows: DataFrame) -> DataFrame:
    """Copy of new index rows with the two mention columns still empty."""
    return index_rows.withColumns({"mentioned_models": F.lit(""), "untracked_models": F.lit("")})
