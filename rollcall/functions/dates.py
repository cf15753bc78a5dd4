"""Dates kept as text or as yyyymmdd integers, and window filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import as_col, strip


def date_int(x: Column | str) -> Column:
    """``2026-04-20 00:00:00`` or ``2026/4/20T..`` to an integer, null when unreadable."""
    day = F.substring_index(F.substring_index(strip(as_col(x).cast("string")), " ", 1), "T", 1)
    return F.left(F.translate(day, "-/", ""), F.lit(8)).try_cast("int")


def title_date(title: Column | str) -> Column:
    """First run of eight digits in a title, 0 when there is none."""
    return F.coalesce(F.regexp_extract(as_col(title), r"(\d{8})", 1).try_cast("int"), F.lit(0))


def dashed(x: Column | str) -> Column:
    return F.regexp_replace(as_col(x), r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3")


def dotted(x: Column | str) -> Column:
    return F.regexp_replace(as_col(x), r"^(\d{4})(\d\d)(\d\d)$", "$1.$2.$3")


def range_label(since: Column | str, until: Column | str) -> Column:
    text = lambda c: dotted(as_col(c).cast("string"))
    return F.concat(text(since), F.lit(" ~ "), text(until))


def first_date(*columns: Column | str) -> Column:
    """First non-blank date text, in the order given."""
    return F.coalesce(*[F.nullif(as_col(c), F.lit("")) for c in columns], F.lit(""))


def in_window(
    df: DataFrame,
    day: Column | str,
    since: int | None,
    until: int | None,
    keep_unknown: bool,
) -> DataFrame:
    """Rows whose yyyymmdd day lies in the window, both ends included.

    ``keep_unknown`` decides about rows without a readable day. With no bound
    at all every row stays.
    """
    day = as_col(day)
    inside = F.lit(True)
    if since is not None:
        inside = inside & (day >= since)
    if until is not None:
        inside = inside & (day <= until)
    if since is None and until is None:
        return df
    return df.filter(F.coalesce(inside, F.lit(keep_unknown)))


def recent(day: Column | str, as_of: str, months: int = 3) -> Column:
    """True for valid dates in the last ``months`` months before ``as_of``.

    The first day is the same day of the earlier month, or that month's last.
    """
    parsed = F.try_to_date(as_col(day), "yyyy-MM-dd")
    return F.coalesce(parsed >= F.add_months(F.lit(as_of).cast("date"), -months), F.lit(False))
