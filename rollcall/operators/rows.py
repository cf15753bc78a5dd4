"""Arrays to rows.

The plain generators make the optimizer add a filter on the array below the
explode, and that filter works the whole array expression out a second time. The
outer ones do not; the empty rows they give are dropped afterwards, so the result
is the same and the array is built once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STRETCH = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))




def explode_rows(df: DataFrame, array: str, out: str) -> DataFrame:
    """One row per non-null element of the array, which itself is dropped."""
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, F.explode_outer(array).alias(out)).filter(F.col(out).isNotNull())


def posexplode_rows(df: DataFrame, array: str, pos: str, out: str) -> DataFrame:
    """Same with the 0-based position of the element."""
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, F.posexplode_outer(array).alias(pos, out)).filter(F.col(out).isNotNull())


def inline_rows(df: DataFrame, array: str, always: str) -> DataFrame:
    """One row per struct of the array; field ``always`` is never null in a struct."""
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, F.inline_outer(array)).filter(F.col(always).isNotNull())


def running(values: Column, start: Column, step, kind: str) -> Column:
    """The state after each element of a fold over the elements of an array.

    A fold copies the array it has built at every step. It runs over stretches of
    fixed length, and their results are joined once, so the work stays in
    proportion to the array.
    """
    none = F.array().cast(f"array<{kind}>")
    state = lambda out, last: F.struct(out.alias("out"), last.alias("last"))

    def one(s: Column, v: Column) -> Column:
        new = step(s["last"], v)
        return state(F.array_append(s["out"], new), new)

    def many(s: Column, part: Column) -> Column:
        done = F.aggregate(part, state(none, s["last"]), one)
        return F.transform(
            F.array(done), lambda d: state(F.array_append(s["out"], d["out"]), d["last"])
        )[0]

    def whole(v: Column) -> Column:
        stretches = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _STRETCH).cast("int")),
            lambda k: F.slice(v, k * _STRETCH + 1, F.lit(_STRETCH)),
        )
        first = state(F.array().cast(f"array<array<{kind}>>"), start)
        return F.when(F.size(v) > 0, F.flatten(F.aggregate(stretches, first, many)["out"])).otherwise(none)

    return F.transform(F.array(values), whole)[0]  # the values are worked out once
