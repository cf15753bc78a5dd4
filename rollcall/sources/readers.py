"""Readers: files in, DataFrames with positions out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import schema as S
from rollcall.functions.dates import title_date
from rollcall.functions.text import as_col, strip
from rollcall.operators.jsontext import object_texts, records_of, said_twice
from rollcall.operators.rows import explode_rows, posexplode_rows


def read_catalog(
    spark: SparkSession,
    path: str,
    snapshot: str | None = None,
    columns: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Catalog rows of one snapshot; only its partition and the named columns are read."""
    if path.endswith(".csv"):
        df = spark.read.csv(path, header=True, schema=schema or S.CATALOG)
    else:
        df = spark.read.parquet(path)
    if snapshot is not None:
        df = df.filter(F.col("snapshot_date") == F.lit(snapshot))
    return df.select(*columns) if columns else df


def whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: path, name and whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("value").alias("text"),
    )


def parse_records(files: DataFrame, text: str = "text") -> DataFrame:
    """JSON arrays of open objects, one row per object with its position.

    Elements of other types are left out, and of a key that is said twice the last value
    counts. A file that is no whole array gives the objects it holds whole, and
    :func:`damaged_files` names it; objects inside an object are part of it, never records.
    """
    whole = F.from_json(text, S.RECORDS)
    # only a file that is no array of objects with keys of their own is looked at again, piece by piece
    loose = records_of(object_texts(F.col(text)))
    parsed = files.select("file", text, whole.alias("_w"))
    fine = F.col("_w").isNotNull() & ~F.coalesce(said_twice(F.col("_w")), F.lit(False))
    found = parsed.select("file", F.when(fine, F.col("_w")).otherwise(loose).alias("_r"))
    return posexplode_rows(found, "_r", "pos", "record")


def damaged_files(files: DataFrame, text: str = "text") -> DataFrame:
    """Files that hold no JSON array of objects alone: ``file`` and the ``objects`` read from each."""
    broken = files.filter(F.from_json(text, S.RECORDS).isNull())
    found = records_of(object_texts(F.col(text)))
    return broken.select("file", F.coalesce(F.size(found), F.lit(0)).cast("bigint").alias("objects"))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_records(whole_files(spark, path))


def arena_entries(text: Column | str) -> Column:
    """Entries of a response that is a bare list or wraps it; null for anything else."""
    text = as_col(text)
    entries = T.ArrayType(S.ARENA)
    wrapped = F.from_json(text, T.StructType([T.StructField("leaderboard", entries)]))
    return F.when(F.ltrim(text).startswith("["), F.from_json(text, entries)).otherwise(
        wrapped["leaderboard"]
    )


def parse_arena(files: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    return explode_rows(files.select(*keep, arena_entries(text).alias("_e")), "_e", "_x").select(*keep, "_x.*")


def read_arena(spark: SparkSession, path: str, categories: DataFrame) -> DataFrame:
    """Arena entries tagged by file; ``categories`` has file, category, subcategory."""
    return parse_arena(whole_files(spark, path).join(categories, "file"), ["category", "subcategory"])


def parse_articles(files: DataFrame, file: str = "file", text: str = "text", min_body: int = 50) -> DataFrame:
    """Header lines, a rule of ``=``, then the body; short bodies are dropped."""
    lines = F.split(text, "\n")
    rule = F.nullif(
        F.array_position(F.transform(lines, lambda line: line.startswith("=" * 10)), True), F.lit(0)
    )
    head = F.slice("_l", 1, F.col("_r") - 1)

    def values(prefix: str) -> Column:
        found = F.filter(head, lambda line: line.startswith(prefix))
        return F.transform(found, lambda line: strip(F.substring(line, len(prefix) + 1, F.length(line))))

    # a header line given twice counts as last written, an unreadable number not at all
    last = lambda array: F.try_element_at(array, F.lit(-1))
    header = lambda prefix: F.coalesce(last(values(prefix)), F.lit(""))
    numbers = F.filter(F.transform(values(S.ARTICLE_SEQ), lambda v: v.try_cast("int")), lambda v: v.isNotNull())

    cut = files.withColumn("_l", lines).withColumn("_r", rule.cast("int")).filter(F.col("_r").isNotNull())
    body = strip(F.array_join(F.slice("_l", F.col("_r") + 1, F.size("_l")), "\n"))
    title = header(S.ARTICLE_TITLE)
    return cut.select(
        F.coalesce(last(numbers), F.lit(0)).alias("seq"),
        title.alias("title"),
        header(S.ARTICLE_LINK).alias("link"),
        title_date(title).alias("date_int"),
        body.alias("body"),
        F.col(file).alias("file"),
    ).filter(F.length("body") >= min_body)


def read_articles(spark: SparkSession, folder: str) -> DataFrame:
    return parse_articles(whole_files(spark, folder))


def pages_with_fallback(primary: DataFrame, fallback: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Fresh page per key, else the older copy; ``origin`` tells which.

    Either side holds a key once. Only the older pages meet the keys of the
    fresh ones; the fresh pages are passed on where they are.
    """
    fresh = primary.filter(F.col(html).isNotNull()).select(key, html, F.lit("fresh").alias("origin"))
    older = fallback.filter(F.col(html).isNotNull()).select(key, html, F.lit("cached").alias("origin"))
    return fresh.unionByName(older.join(fresh.select(key), key, "left_anti"))


def read_pages(spark: SparkSession, primary: str, fallback: str) -> DataFrame:
    """Saved pages of a folder, or of an older folder where the first has none."""
    return pages_with_fallback(
        *[whole_files(spark, p).select(F.col("file").alias("page"), F.col("text").alias("html")) for p in (primary, fallback)],
        key="page",
    )
