"""Collection: saved pages to new catalog rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import labels
from rollcall.functions.dates import date_int, first_date, in_window
from rollcall.operators.enrich import enrich_by_candidates
from rollcall.operators.extract import extract_embedded
from rollcall.operators.match import new_only
from rollcall.operators.merge import merge_open_records, with_priority
from rollcall.session import materialize
from rollcall.sources.writers import append_catalog


def records_from_pages(pages: DataFrame, tags: list[str], source: str = "source", page: str = "page", html: str = "html") -> DataFrame:
    """Embedded records of all pages, merged by the priority of their source."""
    found = extract_embedded(pages.withColumn("_at", F.struct(source, page)), "_at", html)
    placed = found.select(
        F.col(f"_at.{source}").alias("source"), F.struct(f"_at.{page}", "pos").alias("pos"), "record"
    )
    return merge_open_records(with_priority(placed, "source", tags), tags)


def release_text(record: Column) -> Column:
    return first_date(record["announcement_date"], record["release_date"])


def to_catalog_rows(records: DataFrame, created_at: str, base_url: str, verification: str) -> DataFrame:
    """Merged open records mapped to the catalog columns, plus ids and order."""
    r = F.col("record")
    text = lambda f: F.coalesce(r[f], F.lit(""))
    number = lambda f: r[f].try_cast("double")
    moe = r["is_moe"] == "true"
    is_open = F.when(r["is_open_source"] == "true", True).when(r["is_open_source"] == "false", False)
    return records.select(
        text("name").alias("name"),
        F.lit("").alias("is_integrated"),
        F.lit("").alias("workflow_status"),
        text("organization").alias("company"),
        labels.region(r["organization_id"], r["organization_country"]).alias("region"),
        labels.openness(is_open).alias("openness"),
        labels.size_label_text(r["params"]).alias("size"),
        labels.entity_type(r["name"], r["model_id"], labels.is_multimodal(r["multimodal"]), moe, number("params")).alias("type"),
        labels.reasoning(r["name"], r["model_id"], number("index_reasoning")).alias("reasoning"),
        F.lit("通用对话").alias("task_type"),
        labels.detail_url(base_url, r["model_id"]).alias("website"),
        labels.record_note(
            moe, number("params").cast("bigint"), number("context"), labels.modalities(r["multimodal"]),
            number("gpqa_score"), number("swe_bench_verified_score"),
            r["input_price"], r["output_price"], r["license"],
        ).alias("note"),
        F.lit(created_at).alias("created_at"),
        release_text(r).alias("released_at"),
        F.lit("New").alias("is_new"),
        F.lit(verification).alias("verification"),
        F.col("model_id"),
        text("organization_id").alias("organization_id"),
        F.col("first_seen"),
    )


def collect(
    pages: DataFrame,
    tags: list[str],
    catalog: DataFrame,
    registry: DataFrame,
    since: int | None,
    until: int | None,
    created_at: str,
    base_url: str,
    verification: str = "leaderboard",
) -> DataFrame:
    """New catalog rows of a run, checked against the registry.

    Dates outside the window drop a record, unreadable or missing ones do not.
    Append the result with :func:`append`.
    """
    rows = to_catalog_rows(records_from_pages(pages, tags), created_at, base_url, verification)
    rows = in_window(rows, date_int("released_at"), since, until, keep_unknown=True)
    # newest first decides which of two equal names is kept
    newest = F.nullif(F.col("released_at"), F.lit("")).desc_nulls_last()
    fresh = materialize(new_only(rows, catalog, [newest, F.col("first_seen")]), "fresh")
    return enrich_by_candidates(fresh, registry, row_id="model_id", org_id="organization_id")


def append(catalog: DataFrame, fresh: DataFrame) -> DataFrame:
    return append_catalog(catalog, fresh, S.CATALOG_COLUMNS)
