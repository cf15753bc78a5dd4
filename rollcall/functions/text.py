"""Trimming, keys, blank tests and small text forms."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall import schema as S

# fixed values: the white space characters of Unicode, with the four information separators
SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# fixed values: bracketed parts of a name, and below the form of the importance tag
_BRACKETED = r"[(（].*?[)）]"


def as_col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Outer white space off, not only the plain space; looks at the two ends only."""
    return F.btrim(as_col(x), F.lit(SPACE))


def exact_key(x: Column | str) -> Column:
    """Outer whitespace off, case kept."""
    return strip(x)


def fold_key(x: Column | str) -> Column:
    return F.lower(strip(x))


def plain_key(x: Column | str) -> Column:
    """Lower case, bracketed parts removed, inner whitespace squeezed."""
    bare = F.regexp_replace(fold_key(x), rf"(?U)\s*{_BRACKETED}", "")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def loose_key(x: Column | str) -> Column:
    """Lower case without whitespace, dash, underscore, dot or bracketed parts."""
    joined = F.regexp_replace(fold_key(x), r"(?U)[\s\-_.]+", "")
    return F.regexp_replace(joined, _BRACKETED, "")


def manual_key(x: Column | str) -> Column:
    return F.translate(fold_key(x), "-_ ", "")


def clean_name(x: Column | str) -> Column:
    return strip(F.translate(as_col(x), "\n", " "))


def safe_key(x: Column | str) -> Column:
    """First line without characters a file name may not hold, at most 80 long."""
    first = strip(F.get(F.split(as_col(x), "\n"), F.lit(0)))
    return F.left(F.regexp_replace(first, r'[\\/:*?"<>|\r\n\t]', ""), F.lit(80))


def is_blank(x: Column | str, tokens: list[str] = S.BLANK_FILL) -> Column:
    return strip(F.coalesce(as_col(x), F.lit(""))).isin(tokens)


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(strip(x), F.lit(""))


def fill_blank(old: Column | str, new: Column | str, tokens: list[str] = S.BLANK_FILL) -> Column:
    """Take ``new`` only where ``old`` is blank and ``new`` is not."""
    old = as_col(old)
    value = blank_to_null(new)
    return F.when(is_blank(old, tokens) & value.isNotNull(), value).otherwise(old)


def any_contains(x: Column | str, words: list[str]) -> Column:
    """True when one of a short fixed word list occurs in the text."""
    return reduce(or_, [as_col(x).contains(w) for w in words])


def any_word(x: Column | str, words: list[str]) -> Column:
    # (?U): letters of every script count as part of a word
    return as_col(x).rlike(r"(?U)\b(" + "|".join(re.escape(w) for w in words) + r")\b")


def clip(x: Column | str, n: int, mark: str) -> Column:
    x = as_col(x)
    return F.when(F.length(x) > n, F.concat(F.left(x, F.lit(n)), F.lit(mark))).otherwise(x)


def append_text(old: Column | str, new: Column | str, sep: str = "; ") -> Column:
    """Old text, separator, new text; a missing or ``nan`` side adds nothing."""
    kept = F.nullif(blank_to_null(old), F.lit("nan"))
    return F.concat_ws(sep, kept, new if isinstance(new, Column) else F.col(new))


def summary(body: Column | str, lines: int = 3, width: int = 150) -> Column:
    """First long lines of an article, joined and cut."""
    stripped = F.transform(F.split(F.coalesce(as_col(body), F.lit("")), "\n"), strip)
    long_lines = F.filter(stripped, lambda line: F.length(line) > 10)
    return clip(F.array_join(F.slice(long_lines, 1, lines), "；"), width, "…")


_TAG = r"\[重要性[:：](高|中|低)(?:\|([^\]]*))?\]"


def importance_level(note: Column | str) -> Column:
    """Level of the tag in a note; untagged counts as medium."""
    return F.coalesce(F.nullif(F.regexp_extract(as_col(note), _TAG, 1), F.lit("")), F.lit(S.MEDIUM))


def importance_reason(note: Column | str) -> Column:
    return strip(F.regexp_extract(as_col(note), _TAG, 2))


def without_importance(note: Column | str) -> Column:
    return strip(F.regexp_replace(as_col(note), r"(?U)\s*" + _TAG, ""))


def with_importance(note: Column | str, level: Column | str, reason: Column | str) -> Column:
    """Append the tag once; a note that already carries one is left alone."""
    base = F.nullif(blank_to_null(note), F.lit("nan"))
    why = blank_to_null(F.coalesce(as_col(reason), F.lit("")))
    tag = F.concat(F.lit("[重要性:"), F.concat_ws("|", as_col(level), why), F.lit("]"))
    tagged = any_contains(F.coalesce(as_col(note), F.lit("")), ["重要性:", "重要性："])
    return F.when(tagged | F.coalesce(as_col(level), F.lit("")).isin([""]), as_col(note)).otherwise(
        F.concat_ws(" ", base, tag)
    )


def sparse_json(columns: list[str]) -> Column:
    """One JSON object that holds only the filled fields."""
    filled = [F.nullif(blank_to_null(F.col(c).cast("string")), F.lit("nan")).alias(c) for c in columns]
    return F.to_json(F.struct(*filled))


def is_product_name(x: Column | str, products: list[str] = S.PRODUCT_NAMES) -> Column:
    """Generic product names: listed, or digit-free and part of a listed one."""
    key = fold_key(x)
    # one text with a separator no name holds, so the key is worked out once for all
    inside = F.lit("\x00".join(products)).contains(key)
    return key.isin(products) | (~key.rlike(r"(?U)\d") & (F.length(key) > 3) & inside)
