"""Applying review verdicts to the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions.text import (
    append_text, blank_to_null, fold_key, is_blank, sparse_json, with_importance,
)
from rollcall.operators.rank import batches
from rollcall.session import broadcast_if_small

REVIEW_COLUMNS = [
    "name", "company", "region", "openness", "size", "type", "reasoning", "task_type",
    "website", "note", "released_at", "verification",
]

# what happened to a row
DROPPED, REMOVAL_PENDING, TAGGED, FILLED, UNCHANGED, PENDING, NO_VERDICT = (
    "dropped", "removal_pending", "tagged", "filled", "unchanged", "pending", "no_verdict",
)


def review_input(catalog: DataFrame, row_id: str = "row_id", size: int = 20) -> DataFrame:
    """Sparse JSON per row with its batch id; batches are consecutive rows."""
    return batches(catalog, row_id, size).select(
        row_id, "batch", sparse_json(REVIEW_COLUMNS).alias("payload")
    )


def last_verdicts(verdicts: DataFrame, order: str) -> DataFrame:
    """The last verdict of every name, as struct ``verdict`` under ``_key``."""
    named = verdicts.withColumn("_key", fold_key("model_name")).filter(F.col("_key") != "")
    return named.groupBy("_key").agg(
        F.max_by(F.struct(*[c for c in verdicts.columns if c != order]), order).alias("verdict")
    )


def apply_review(
    catalog: DataFrame,
    verdicts: DataFrame,
    order: str = "pos",
    fillable: list[str] | None = None,
    overwrite: bool = False,
    reviewer: str = "review",
) -> DataFrame:
    """Every catalog row with its ``action`` and the changed cells.

    Rows with action ``dropped`` are still in the result, so that the log can be
    built from the same frame; :func:`reviewed_catalog` leaves them out. Filled
    cells stay as they are unless ``overwrite`` is set.
    """
    fillable = fillable or [c for c in catalog.columns if c in S.CATALOG_COLUMNS and c != "name"]
    known = broadcast_if_small(last_verdicts(verdicts, order), "verdicts")
    rows = catalog.withColumn("_key", fold_key("name")).join(known, "_key", "left")
    v = lambda f: F.col("verdict")[f]
    remove = F.coalesce(v("should_remove"), F.lit(False))
    confidence = F.coalesce(v("confidence"), F.lit(S.LOW))
    high = confidence == S.HIGH
    fixes = F.map_filter(
        F.coalesce(v("corrections"), F.create_map().cast("map<string,string>")),
        lambda k, x: F.coalesce(x, F.lit("")) != "",
    )
    has_fixes = F.size(F.coalesce(v("corrections"), F.create_map().cast("map<string,string>"))) > 0
    issues = F.coalesce(v("issues"), F.array().cast("array<string>"))
    nothing = ~has_fixes & (F.size(issues) == 0)

    def applies(c: str) -> Column:
        wanted = F.try_element_at(fixes, F.lit(c))
        open_cell = F.lit(True) if overwrite else is_blank(c, S.BLANK_REVIEW)
        return wanted.isNotNull() & open_cell

    rows = rows.withColumn(
        "_changes",
        F.filter(
            F.array(*[F.when(applies(c), F.concat(F.lit(c + "="), F.try_element_at(fixes, F.lit(c)))) for c in fillable]),
            lambda c: c.isNotNull(),
        ),
    )
    rows = rows.withColumn(
        "action",
        F.when(F.col("verdict").isNull(), NO_VERDICT)
        .when(remove & high, DROPPED)
        .when(remove, REMOVAL_PENDING)
        .when(nothing, TAGGED)
        .when(high & (F.size("_changes") > 0), FILLED)
        .when(high, UNCHANGED)
        .otherwise(PENDING),
    )
    issue_text = F.array_join(issues, "; ")
    fix_text = F.array_join(
        F.transform(F.map_entries(fixes), lambda e: F.concat(e["key"], F.lit("→"), e["value"])), "; "
    )
    prefixed = lambda label, text: F.concat(F.lit(label), F.nullif(text, F.lit("")))
    advice = F.concat_ws(
        "; ", prefixed("建议修正: ", fix_text), prefixed("问题: ", issue_text), blank_to_null(v("notes"))
    )
    mark = lambda what, detail: F.concat(
        F.lit(f"⚠️ {reviewer}{what}("), confidence, F.lit("置信)待人工确认 — "), detail
    )
    reason = F.coalesce(F.nullif(issue_text, F.lit("")), F.lit(f"{reviewer}建议删除"))
    addition = (
        F.when(F.col("action") == REMOVAL_PENDING, mark("建议删除", reason))
        .when(F.col("action") == FILLED, F.lit(f"{reviewer}审核补全(高置信)"))
        .when(F.col("action") == PENDING, mark("审核", advice))
    )
    action = F.col("action")
    importance = F.when(
        action.isin(TAGGED, FILLED, UNCHANGED, PENDING), F.coalesce(v("importance"), F.lit(S.MEDIUM))
    )
    cells = {
        c: F.when((action == FILLED) & applies(c), F.try_element_at(fixes, F.lit(c))).otherwise(F.col(c))
        for c in fillable
    }
    cells["verification"] = F.when(
        addition.isNotNull(), append_text(cells.get("verification", F.col("verification")), addition)
    ).otherwise(F.col("verification"))
    note = cells.get("note", F.col("note"))
    cells["note"] = F.when(
        importance.isNotNull(), with_importance(note, importance, v("importance_reason"))
    ).otherwise(note)
    detail = (
        F.when(action == FILLED, F.array_join("_changes", ", "))
        .when(action.isin(DROPPED, REMOVAL_PENDING), reason)
        .when(action == PENDING, F.coalesce(F.nullif(fix_text, F.lit("")), issue_text))
    )
    return rows.select(
        *[cells.get(c, F.col(c)).alias(c) for c in catalog.columns],
        action,
        detail.alias("detail"),
        v("importance").alias("importance"),
        confidence.alias("confidence"),
    )


def reviewed_catalog(applied: DataFrame) -> DataFrame:
    """The catalog after the review: dropped rows out, log columns off."""
    return applied.filter(F.col("action") != DROPPED).drop(
        "action", "detail", "importance", "confidence"
    )


def review_log(applied: DataFrame) -> DataFrame:
    return applied.filter(F.col("action").isin(DROPPED, REMOVAL_PENDING, FILLED, PENDING)).select(
        "name", "action", "confidence", "detail"
    )


def review_stats(verdicts: DataFrame, applied: DataFrame) -> DataFrame:
    """Tidy counters: verdicts per importance, removals asked for, rows per action."""
    asked = verdicts.select(
        F.lit("importance").alias("metric"), F.coalesce("importance", F.lit(S.MEDIUM)).alias("value")
    ).unionByName(
        verdicts.filter("should_remove").select(
            F.lit("removal").alias("metric"), F.lit("suggested").alias("value")
        )
    )
    done = applied.select(F.lit("action").alias("metric"), F.col("action").alias("value"))
    return asked.unionByName(done).groupBy("metric", "value").agg(F.count("*").alias("n"))


def review_lists(verdicts: DataFrame) -> DataFrame:
    """Verdicts to look at: high importance, and medium or low confidence."""
    high = verdicts.filter(F.col("importance") == S.HIGH).select(
        F.lit("high_importance").alias("list"), "model_name",
        F.coalesce("notes", F.lit("")).alias("text"),
    )
    issues = F.concat(F.lit("问题: "), F.nullif(F.array_join("issues", ", "), F.lit("")))
    fixes = F.transform(
        F.filter(F.map_entries("corrections"), lambda e: F.coalesce(e["value"], F.lit("")) != ""),
        lambda e: F.concat(e["key"], F.lit("→"), e["value"]),
    )
    advice = F.concat(F.lit("建议: "), F.nullif(F.array_join(fixes, ", "), F.lit("")))
    pending = verdicts.filter(F.col("confidence").isin(S.MEDIUM, S.LOW)).select(
        F.lit("pending").alias("list"), "model_name",
        F.concat(F.lit("["), F.col("confidence"), F.lit("置信] "), F.concat_ws(" | ", advice, issues)).alias("text"),
    )
    return high.unionByName(pending)


