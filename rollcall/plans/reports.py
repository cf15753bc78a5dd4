"""Report tables in one tidy shape: section, rank, key, metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import labels
from rollcall.functions.dates import date_int, first_date, in_window, recent
from rollcall.functions.text import clip, importance_level, importance_reason, strip, without_importance
from rollcall.operators import rank as K
from rollcall.operators import stats as A
from rollcall.operators.merge import merge_open_records
from rollcall.operators.snapshots import diff_counts, diff_snapshots, is_new_row
from rollcall.session import broadcast_if_small, materialize


def tidy(df: DataFrame, section: str | Column, key: Column, metrics: dict[str, Column], rank: Column | None = None) -> DataFrame:
    pairs = [x for name, c in metrics.items() for x in (F.lit(name), c.cast("string"))]
    return df.select(
        (F.lit(section) if isinstance(section, str) else section).alias("section"),
        (rank if rank is not None else F.lit(None)).cast("bigint").alias("rank"),
        key.cast("string").alias("key"),
        F.create_map(*pairs).alias("metrics"),
    )


def stack(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _scores(df_cols: list[str]) -> dict[str, Column]:
    return {c: labels.score_text(c) for c in df_cols}


SCORES = ["gpqa_score", "swe_bench_verified_score", "hle_score", "aime_2025_score"]
COVERED = [*SCORES, "params", "context", "input_price", "license", "is_moe", "multimodal"]


def leaderboard_records(stacked: DataFrame, tags: list[str]) -> DataFrame:
    """Open records of several sources, merged and typed for :func:`leaderboard_tables`.

    ``stacked`` has ``_prio``, ``pos`` and the map ``record``. The last record of
    the first source is the base, the others supplement it.
    """
    merged = merge_open_records(stacked, tags, base="last")
    r = F.col("record")
    number = lambda f: r[f].try_cast("double").alias(f)
    whole = lambda f: r[f].try_cast("double").try_cast("bigint").alias(f)
    text = ["name", "organization", "announcement_date", "release_date", "license", "input_price", "output_price", "multimodal"]
    return merged.select(
        F.col("first_seen").alias("pos"), "sources",
        *[r[f].alias(f) for f in text], *[number(f) for f in SCORES],
        whole("params"), whole("context"), (r["is_moe"] == "true").alias("is_moe"),
        labels.is_open_record(r).alias("is_open"),
    )


def leaderboard_tables(records: DataFrame, as_of: str, months: int = 3, top: int = 20, orgs: int = 25) -> DataFrame:
    """Recent records, the best open ones by score, organisations, field coverage, sources.

    ``records`` are typed, with ``is_open`` and a unique ``pos``. Fields that the
    records lack altogether count as covered by none; ``sources``, where there are
    any, give the records per source.
    """
    lacking = [c for c in [*COVERED, "output_price"] if c not in records.columns]
    # read by every section below
    records = materialize(records.withColumns({c: F.lit(None).cast("string") for c in lacking}), "leaderboard")
    day = first_date("announcement_date", "release_date")
    df = records.withColumns({"_day": day, "_recent": recent(day, as_of, months)})
    newest = K.rank_rows(df.filter("_recent"), [F.col("_day").desc(), F.col("pos")], "_newest", "recent")
    new = tidy(
        newest, "recent", F.col("name"),
        {
            "organization": F.col("organization"), "params": labels.size_or_dash("params"),
            "open": F.col("is_open"), "date": F.col("_day"), **_scores(SCORES), "context": labels.thousands("context"),
            "input_price": labels.price_or_dash("input_price"),
            "output_price": labels.price_or_dash("output_price"),
        },
        F.col("_newest") + 1,
    )
    scored = df.filter(A.open_with_score(F.col("is_open"), "gpqa_score"))
    best = K.top_n(scored, [F.col("gpqa_score").desc(), F.col("pos")], top)
    open_top = tidy(
        best, "open_top", F.col("name"),
        {
            "organization": F.col("organization"), "params": labels.size_or_dash("params"),
            "moe": F.coalesce(F.col("is_moe").cast("boolean"), F.lit(False)),
            "license": F.coalesce("license", F.lit(S.DASH)), **_scores(SCORES),
        },
        F.col("rank"),
    )
    open_total = tidy(
        df.agg(F.count_if("is_open").alias("n"), F.count("*").alias("total")), "open_total", F.lit("all"),
        {"n": F.col("n"), "total": F.col("total")},
    )
    counted = A.org_stats(df, "organization", F.col("is_open"), F.col("_recent"), first="pos")
    by_org = K.top_n(counted, [F.col("total").desc(), F.col("first")], orgs)
    org_rows = tidy(
        by_org, "organizations", F.col("organization"),
        {c: F.col(c) for c in ("total", "open", "recent")}, F.col("rank"),
    )
    covered = A.coverage(records, COVERED, "present")
    cover_rows = tidy(
        covered, "coverage", F.col("field"), {"filled": F.col("filled"), "pct": F.col("pct_round")}
    )
    parts = [new, open_top, open_total, org_rows, cover_rows]
    if "sources" in records.columns:
        held = records.select(F.inline("sources")).groupBy("source").agg(F.sum("n").alias("n"))
        parts.append(tidy(held, "sources", F.col("source"), {"records": F.col("n")}))
    return stack(*parts)


def arena_tables(entries: DataFrame, top: int = 30, orgs: int = 20, pos: str = "pos") -> DataFrame:
    """Activity per subcategory, the best active entries of each, organisations across categories."""
    activity = A.arena_activity(entries)
    over = K.overflow(F.col("active"), top)
    overview = tidy(
        activity, "overview", F.concat_ws("/", "category", "subcategory"),
        {c: F.col(c) for c in ("total", "active", "inactive")} | {"more": over},
    )
    active = entries.filter(A.is_active("matches_played"))
    rating = F.coalesce("conservative_rating", F.lit(0.0))
    best = K.top_per_group(active, ["category", "subcategory"], [rating.desc(), F.col(pos)], top)
    ranked = tidy(
        best, F.concat_ws("/", F.lit("top"), "category", "subcategory"),
        F.coalesce("model_name", "model_id", F.lit("?")),
        {
            "organization": F.coalesce("organization", F.lit("?")),
            "rating": labels.rating_text("conservative_rating"),
            "matches": F.col("matches_played"),
            "win_rate": labels.win_rate_text("win_rate"),
            "price": labels.price_text("avg_generation_price"),
            "open": F.coalesce("is_open_source", F.lit(False)),
        },
        F.col("rank"),
    )
    per_org = A.org_categories(entries, "organization", "category", first=pos)
    across = K.top_n(per_org, [F.col("total").desc(), F.col("first")], orgs)
    org_rows = tidy(
        across, "organizations", F.col("organization"),
        {"total": F.col("total"), "categories": F.col("categories")}, F.col("rank"),
    )
    return stack(overview, ranked, org_rows)


REPORT_DIMS = ["company", "type", "region", "openness", "reasoning"]
REPORT_TOP = {"company": 15, "new_company": 10}
REPORT_FIELDS = [
    "name", "company", "region", "openness", "size", "type", "reasoning", "task_type", "website", "note",
]


def update_tables(catalog: DataFrame, old: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Overview, field coverage and value distributions with bar lengths.

    All distributions, of all rows and of the new ones, come from one pass.
    """
    new = F.coalesce(F.col("is_new") == "New", F.lit(False))
    overview = A.kpis(catalog, new=new)
    kpi = tidy(
        overview, "overview", F.lit("all"),
        {
            "total": F.col("total"), "new": F.col("new"),
            "new_pct": labels.fixed(F.col("new_pct"), 1),
        },
    )
    before = tidy(old.agg(F.count("*").alias("n")), "overview", F.lit("before"), {"total": F.col("n")})
    covered = A.coverage(catalog, [c for c in REPORT_FIELDS if c in catalog.columns])
    cover = tidy(
        covered, "coverage", F.col("field"),
        {"filled": F.col("filled"), "total": F.col("total"), "grade": labels.coverage_grade("pct")},
    )
    counts = A.dim_counts(catalog, REPORT_DIMS, new=new, first=row_id)
    counts = counts.filter(F.col("dim").isin(*REPORT_DIMS, "new_company", "new_type"))
    # counted once, ranked several times
    shared = K.share_of_max(materialize(counts, "counts"), ["dim"], "n")
    bars = {"n": F.col("n"), "bar": F.floor(F.col("share") * 30)}
    order = [F.col("n").desc(), F.col("first")]
    tops = [
        tidy(
            K.top_n(shared.filter(F.col("dim") == d), order, n), F.col("dim"), F.col("value"), bars,
            F.col("rank"),
        )
        for d, n in REPORT_TOP.items()
    ]
    rest = tidy(shared.filter(~F.col("dim").isin(*REPORT_TOP)), F.col("dim"), F.col("value"), bars)
    return stack(kpi, before, cover, *tops, rest)


def digest_rows(catalog: DataFrame, since: int, until: int) -> DataFrame:
    """Daily digest: overview, new rows by importance, all rows with their company's size.

    Rows without a readable date in the window are left out. A missing company
    is listed under its own label.
    """
    rows = in_window(catalog, date_int("released_at"), since, until, keep_unknown=False)
    rows = materialize(rows, "digest")
    text = lambda c: F.when(F.lower(strip(c)) == "nan", "").otherwise(F.coalesce(strip(c), F.lit("")))
    new = is_new_row("is_new")
    overview = A.kpis(rows, new=new)
    kpi = tidy(
        overview, "overview", F.lit("all"),
        {c: F.col(c) for c in ("total", "new", "domestic", "foreign", "open", "closed")},
    )
    note = text("note")
    why = F.coalesce(F.nullif(importance_reason(note), F.lit("")), without_importance(note))
    level = importance_level(note)
    fresh = tidy(
        rows.filter(new), F.concat(F.lit("new_"), F.when(level == S.HIGH, "high").when(level == S.LOW, "low").otherwise("medium")),
        text("name"),
        {
            "company": text("company"),
            "tags": F.concat_ws(" · ", *[F.nullif(text(c), F.lit("")) for c in ("type", "size")]),
            "reason": F.when(level != S.LOW, clip(why, 60, "...")).otherwise(""),
        },
    )
    label = F.coalesce(F.nullif(text("company"), F.lit("")), F.lit(S.UNKNOWN))
    sizes = A.digest_groups(rows.withColumn("company", F.nullif(text("company"), F.lit("")))).withColumnRenamed("n", "group_size")
    # one company may hold very many rows; its size comes to them, not they to it
    sizes = broadcast_if_small(sizes.withColumnRenamed("company", "_label"), "group-sizes")
    listed = rows.withColumn("_label", label).join(sizes, "_label")
    shown = F.when(F.length(note) > 2, clip(without_importance(note), 80, "...")).otherwise("")
    all_rows = tidy(
        listed, "company", F.col("_label"),
        {
            "group_size": F.col("group_size"), "name": text("name"),
            "info": F.concat_ws(" · ", *[F.nullif(text(c), F.lit("")) for c in ("type", "size", "openness")]),
            "note": shown,
        },
    )
    return stack(kpi, fresh, all_rows)


REQUIRED = ["company", "note", "released_at"]


def required_fill(catalog: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Fill of the fields that must be complete, graded."""
    return A.coverage(catalog, required, "text_not_nan").select(
        "field", "filled", "total", "pct_round",
        labels.coverage_grade(F.coalesce("pct", F.lit(0.0)), 100, 80).alias("grade"),
    )


def acceptance_tables(new: DataFrame, old: DataFrame, key: str = "name", required: list[str] = REQUIRED) -> DataFrame:
    """Counts before and after, coverage per column, and the quality checks."""
    diff = materialize(diff_counts(diff_snapshots(new, old, key)), "diff")
    totals = tidy(diff, "diff", F.lit("all"), {c: F.col(c) for c in diff.columns})
    before = tidy(old.agg(F.count("*").alias("n")), "rows", F.lit("before"), {"n": F.col("n")})
    after = tidy(new.agg(F.count("*").alias("n")), "rows", F.lit("after"), {"n": F.col("n"), "columns": F.lit(len(new.columns))})
    covered = A.coverage(new, new.columns, "text")
    cover = tidy(
        covered, "coverage", F.col("field"), {"filled": F.col("filled"), "pct": F.col("pct_floor")}
    )
    fill = tidy(
        required_fill(new, required), "required", F.col("field"),
        {"filled": F.col("filled"), "grade": F.col("grade")},
    )
    quality = A.checks(
        [
            ("updated_not_empty", F.sum("new_total"), lambda v: v > 0),
            ("names_grew", F.sum(F.col("new_total") - F.col("old_total")), lambda v: v > 0),
            ("nothing_missing", F.sum("missing"), lambda v: v == 0),
        ],
        diff,
    )
    check_rows = tidy(
        quality, "check", F.col("check"), {"value": F.col("value").cast("bigint"), "passed": F.col("passed")}
    )
    return stack(totals, before, after, cover, fill, check_rows)
