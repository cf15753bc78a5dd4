"""Review: new rows out in batches, verdicts back in."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators import review as R
from rollcall.operators.snapshots import is_new_row


class ReviewRun(NamedTuple):
    applied: DataFrame  # every catalog row with its action
    catalog: DataFrame
    log: DataFrame
    stats: DataFrame


def requests(catalog: DataFrame, only_new: bool = True, size: int = 20) -> DataFrame:
    """One row per batch: the JSON objects of its rows."""
    rows = catalog.filter(is_new_row("is_new")) if only_new else catalog
    return (
        R.review_input(rows, size=size)
        .groupBy("batch")
        .agg(F.array_sort(F.collect_list(F.struct("row_id", "payload"))).alias("_rows"))
        .select("batch", F.transform("_rows", lambda r: r["payload"]).alias("payloads"))
    )


def review_run(catalog: DataFrame, verdicts: DataFrame, order: str = "pos", **options) -> ReviewRun:
    applied = R.apply_review(catalog, verdicts, order, **options)
    return ReviewRun(
        applied, R.reviewed_catalog(applied), R.review_log(applied), R.review_stats(verdicts, applied)
    )
