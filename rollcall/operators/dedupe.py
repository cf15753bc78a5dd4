"""First-wins deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import broadcast_if_small


def first_wins(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter sits directly on the window, so Spark keeps one row per key
    in every map task before it shuffles; a hot key costs one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def drop_blank(df: DataFrame, key: Column) -> DataFrame:
    return df.filter(F.coalesce(key, F.lit("")) != "")


def dedupe_bodies(
    articles: DataFrame, body: str = "body", order: str = "file", where: Column | None = None,
    dedupe_first: bool = False,
) -> DataFrame:
    """Exact-body duplicates out, first file name wins.

    ``order`` is unique. ``where`` is applied before the dedupe, so a copy
    outside the window cannot hide one inside it; ``dedupe_first`` turns that
    around. Only hashes are grouped: one row per repeated body says which copy
    stays, and the bodies themselves are not shuffled for it unless those rows
    are too many to broadcast.
    """
    if where is not None and not dedupe_first:
        articles = articles.filter(where)
    hashed = articles.withColumn("_md5", F.md5(F.encode(body, "UTF-8")))
    repeated = (
        hashed.groupBy("_md5")
        .agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    kept = (
        hashed.join(broadcast_if_small(repeated, "repeated-bodies"), "_md5", "left")
        .filter(F.col("_first").isNull() | (F.col("_first") == F.col(order)))
        .drop("_md5", "_first")
    )
    return kept.filter(where) if where is not None and dedupe_first else kept


def first_mention(mentions: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first mention of every entity, with its key."""
    return first_wins(mentions.withColumn("mention_key", key), ["mention_key"], order)
