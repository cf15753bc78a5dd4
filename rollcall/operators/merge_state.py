"""The priority merge as a stored state that takes new batches.

The state has a row for each key: for every field the winning value with its place, how
often each source came, and the first place. Of two states of a key the better place wins field
by field, and counts add up; that is the same in any order and grouping, so batches can be
merged as they come, several at once or in a tree, and the result is that of one merge over
all their rows. A batch is reduced to its own state before it meets the stored one.

Places (source and position) are unique. A batch is counted each time it is merged;
values don't change if one is merged twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import schema as S
from rollcall.operators.merge import concat_rows, source_list


def _present(df: DataFrame, field: str, sentinel: str) -> Column:
    c = F.col(field)
    text = df.schema[field].dataType == T.StringType()
    return (c.isNotNull() & (c != sentinel)) if text else c.isNotNull()


def batch_state(
    stacked: DataFrame, tags: list[str], key: str, fields: list[str], pos: str = "pos",
    base: str = "first", sentinel: str = S.SENTINEL,
) -> DataFrame:
    """State of one batch: the arguments are those of :func:`merge.merge_records`."""
    stacked = stacked.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    is_base = F.col("_prio") == 0
    place = [F.col("_prio").alias("prio"), F.col(pos).alias("pos")]

    def winner(field: str) -> Column:
        ok = _present(stacked, field, sentinel)
        ok = ok & ~is_base if base == "last" else ok
        return F.min(F.when(ok, F.struct(*place, F.col(field).alias("value"))))

    aggs = [winner(f).alias(f"_m_{f}") for f in fields]
    if base == "last":
        row = F.struct(F.col(pos).alias("pos"), *[F.col(f) for f in fields])
        aggs.append(F.max(F.when(is_base, row)).alias("_base"))
    for i in range(len(tags) + 1):
        once = base == "last" and i == 0
        aggs.append((F.max(is_base.cast("bigint")) if once else F.count_if(F.col("_prio") == i)).alias(f"_n{i}"))
    return stacked.groupBy(key).agg(*aggs, F.min(F.struct(*place)).alias("_first"))


def combine_states(*states: DataFrame) -> DataFrame:
    """One state of several; associative and commutative."""
    both = concat_rows(*states)
    key, *rest = both.columns
    has_base = "_base" in rest

    def best(c: str) -> Column:
        if c == "_base" or (c == "_n0" and has_base):
            return F.max(c)
        return F.sum(c) if c.startswith("_n") else F.min(c)

    return both.groupBy(key).agg(*[best(c).alias(c) for c in rest])


def state_rows(state: DataFrame, tags: list[str]) -> DataFrame:
    """The merged rows, as :func:`merge.merge_records` gives them."""
    key, *rest = state.columns
    fields = [c[3:] for c in rest if c.startswith("_m_")]
    value = lambda f: F.col(f"_m_{f}")["value"]
    pick = lambda f: F.coalesce(F.col("_base")[f], value(f)) if "_base" in rest else value(f)
    first = F.col("_first")
    return state.select(
        key, *[pick(f).alias(f) for f in fields], source_list(tags).alias("sources"),
        F.struct(first["prio"].alias("_prio"), first["pos"].alias("pos")).alias("first_seen"),
    )
