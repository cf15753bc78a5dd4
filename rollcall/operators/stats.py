"""Counts, coverage and other report aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions.text import as_col, is_blank, strip


def dim_counts(df: DataFrame, dims: list[str], new: Column | None = None, first: str | None = None) -> DataFrame:
    """Rows per value of several dimensions in one pass; nulls are not counted.

    With ``new`` the new rows are counted once more under ``new_<dim>``. ``first``
    adds the earliest position of every value, to break ties by appearance.
    """
    value = lambda d: strip(F.col(d))
    pairs = [F.struct(F.lit(d).alias("dim"), value(d).alias("value")) for d in dims]
    if new is not None:
        pairs += [F.struct(F.lit(f"new_{d}").alias("dim"), F.when(new, value(d)).alias("value")) for d in dims]
    extra = [F.min("_pos").alias("first")] if first else []
    at = [F.col(first).alias("_pos")] if first else []
    return (
        df.select(*at, F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("dim", "value")
        .agg(F.count("*").alias("n"), *extra)
    )


def org_stats(
    df: DataFrame, org: str, is_open: Column, is_recent: Column, first: str | None = None
) -> DataFrame:
    """Records per organisation, all, open and recent; ``first`` adds the earliest position."""
    return df.groupBy(F.coalesce(F.col(org), F.lit("Unknown")).alias(org)).agg(
        F.count("*").alias("total"),
        F.count_if(is_open).alias("open"),
        F.count_if(is_recent).alias("recent"),
        *([F.min(first).alias("first")] if first else []),
    )


def open_with_score(is_open: Column, score: Column | str) -> Column:
    """True for open records that have a score other than zero."""
    return is_open & (F.coalesce(as_col(score), F.lit(0.0)) != 0)


def is_active(played: Column | str) -> Column:
    """True where anything was played; a missing number is none."""
    return F.coalesce(as_col(played), F.lit(0)) > 0


def gap_lists(
    df: DataFrame, row_id: str, company: str = "company", openness: str = "openness",
    size: str = "size", website: str = "website",
) -> DataFrame:
    """A row for every gap of a catalog row, and for every row that has a size.

    Gaps are a missing company, an open entity without a size, and no website.
    """
    gaps = F.array(
        F.when(F.col(company).isNull(), "no_company"),
        F.when((F.col(openness) == S.OPEN) & F.col(size).isNull(), "open_without_size"),
        F.when(F.col(size).isNotNull(), "has_size"),
        F.when(is_blank(website), "no_website"),
    )
    return df.select(F.explode(gaps).alias("gap"), row_id).filter("gap is not null")


def org_categories(df: DataFrame, org: str, category: str, first: str | None = None) -> DataFrame:
    """Records per organisation and the sorted list of its categories.

    Counted per (organisation, category) first, so the list is built from one
    row per category and not from the records. ``first`` adds the earliest
    position of every organisation, to break ties by appearance.
    """
    at = [F.min(first).alias("_at")] if first else []
    pairs = df.groupBy(F.coalesce(F.col(org), F.lit("unknown")).alias(org), category).agg(
        F.count("*").alias("_n"), *at
    )
    return pairs.groupBy(org).agg(
        F.sum("_n").alias("total"),
        F.array_join(F.array_sort(F.collect_set(category)), ", ").alias("categories"),
        *([F.min("_at").alias("first")] if first else []),
    )


def filled(c: str, mode: str) -> Column:
    """What counts as filled: ``not_null``, ``text``, ``text_not_nan`` or ``present``."""
    col = F.col(c)
    if mode in ("not_null", "present"):
        return col.isNotNull()
    text = F.coalesce(strip(col.cast("string")), F.lit(""))
    return (text != "") if mode == "text" else ~text.isin("", "nan")


def coverage(df: DataFrame, columns: list[str], mode: str = "not_null") -> DataFrame:
    """Filled cells per column, with the share as number, floor and rounded percent."""
    wide = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(filled(c, mode)).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    return coverage_rows(wide, columns)


def coverage_rows(wide: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each column from ``total`` and the filled cells of the columns, ``_0`` and so on."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(f"_{i}").alias("filled")) for i, c in enumerate(columns)]
    )
    total = F.nullif(F.col("total"), F.lit(0))
    return wide.select("total", F.inline(cells)).select(
        "field",
        "filled",
        "total",
        (F.col("filled") / total * 100).alias("pct"),
        F.floor(F.col("filled") * 100 / total).alias("pct_floor"),
        F.bround(F.col("filled") / total * 100, 0).cast("bigint").alias("pct_round"),
    )


def map_coverage(df: DataFrame, record: str, fields: list[str]) -> DataFrame:
    """Coverage of open records: key present and not null."""
    return coverage(df.select(*[F.col(record)[f].alias(f) for f in fields]), fields, "present")


def kpis(df: DataFrame, region: str = "region", openness: str = "openness", new: Column | None = None) -> DataFrame:
    """Overview counters; whatever is not domestic counts as foreign, nulls too."""
    is_new = F.coalesce(new, F.lit(False)) if new is not None else F.lit(False)
    home = F.count_if(F.col(region) == S.DOMESTIC)
    total = F.count("*")
    return df.agg(
        total.alias("total"),
        F.count_if(is_new).alias("new"),
        (F.count_if(is_new) / F.nullif(total, F.lit(0)) * 100).alias("new_pct"),
        home.alias("domestic"),
        (total - home).alias("foreign"),
        F.count_if(F.col(openness) == S.OPEN).alias("open"),
        F.count_if(F.col(openness) == S.CLOSED).alias("closed"),
    )


def source_counts(df: DataFrame, source: str) -> DataFrame:
    return df.groupBy(source).agg(F.count("*").alias("n"))


def arena_activity(df: DataFrame) -> DataFrame:
    """Entries per subcategory; an entry without matches is inactive."""
    played = is_active("matches_played")
    return df.groupBy("category", "subcategory").agg(
        F.count("*").alias("total"),
        F.count_if(played).alias("active"),
        F.count_if(~played).alias("inactive"),
    )


def mention_lists(
    articles: DataFrame, mentions: DataFrame, article: str, pos: str = "pos",
    name: str = "model_name",
) -> DataFrame:
    """Per article the mentioned and the untracked names, in order, as text.

    Articles without mentions get their own text. One article's list is bounded
    by the one reply it was read from.
    """
    in_order = F.array_sort(F.collect_list(F.struct(pos, name, "tracked")))
    lists = mentions.groupBy(article).agg(in_order.alias("_m"))
    names = lambda ms: F.array_join(F.transform(ms, lambda m: m[name]), "\n")
    loose = F.filter("_m", lambda m: ~m["tracked"])
    return articles.join(lists, article, "left").select(
        *articles.columns,
        F.when(F.col("_m").isNull(), S.NO_MENTIONS).otherwise(names(F.col("_m"))).alias("mentioned"),
        F.when(F.col("_m").isNull(), "")
        .when(F.size(loose) == 0, S.ALL_TRACKED)
        .otherwise(names(loose))
        .alias("untracked"),
    )


def digest_groups(df: DataFrame, company: str = "company") -> DataFrame:
    """Rows per company, null or blank companies under one label."""
    label = F.coalesce(F.nullif(strip(F.col(company)), F.lit("")), F.lit(S.UNKNOWN))
    return df.groupBy(label.alias("company")).agg(F.count("*").alias("n"))


def checks(rules: list[tuple[str, Column, Callable[[Column], Column]]], df: DataFrame) -> DataFrame:
    """One aggregate over ``df`` turned into rows (check, value, passed).

    A rule is a name, an aggregate, and the test its value has to pass.
    """
    wide = df.agg(*[agg.cast("double").alias(f"_{i}") for i, (_, agg, _) in enumerate(rules)])
    cells = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(f"_{i}").alias("value"),
            F.coalesce(test(F.col(f"_{i}")), F.lit(False)).alias("passed"),
        )
        for i, (name, _, test) in enumerate(rules)
    ]
    return wide.select(F.inline(F.array(*cells)))


def resolve_dates(candidates: DataFrame, entity: str, since: int, until: int) -> DataFrame:
    """Confirmed release date per entity and what to do with it.

    ``candidates`` has ``source_rank`` (1 site, 2 press, 3 community) and
    ``date_int``. The best source decides, its earliest date wins. In the window
    is kept, outside is dropped, unknown stays flagged.
    """
    best = F.min_by("date_int", F.when(F.col("date_int").isNotNull(), F.struct("source_rank", "date_int")))
    day = F.col("confirmed")
    return candidates.groupBy(entity).agg(best.alias("confirmed")).withColumn(
        "decision",
        F.when(day.isNull(), "pending").when(day.between(since, until), "keep").otherwise("drop"),
    )


