"""Priority merge of records that several sources hold for one entity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import schema as S

Sources = list[tuple[str, DataFrame]]


def stack_sources(sources: Sources) -> DataFrame:
    """All sources in one frame with their priority in ``_prio``."""
    tagged = [df.withColumn("_prio", F.lit(i)) for i, (_, df) in enumerate(sources)]
    return concat_rows(*tagged)


def with_priority(df: DataFrame, source: str, tags: list[str]) -> DataFrame:
    """Priority by position of the source tag; all other sources come last, missing ones too."""
    order = F.nullif(F.array_position(F.array(*[F.lit(t) for t in tags]), F.col(source)), F.lit(0))
    return df.withColumn("_prio", F.coalesce(order - 1, F.lit(len(tags))).cast("int"))


def concat_rows(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def source_list(tags: list[str]) -> Column:
    """How often each source held the entity, in priority order; sources without a tag count as one."""
    named = enumerate([*tags, S.OTHER_SOURCE])
    entries = [F.struct(F.lit(t).alias("source"), F.col(f"_n{i}").alias("n")) for i, t in named]
    return F.filter(F.array(*entries), lambda e: e["n"] > 0)


def merge_records(
    stacked: DataFrame,
    tags: list[str],
    key: str,
    fields: list[str],
    pos: str = "pos",
    base: str = "first",
    sentinel: str = S.SENTINEL,
) -> DataFrame:
    """One row per key: every field from the first source that has a value.

    ``stacked`` holds all sources with ``_prio`` 0 for the best one, in the order
    of ``tags``; ``pos`` orders the rows of one source. The sentinel counts as
    absent. With ``base='last'`` the last row of the first source is taken as it
    is, sentinels included, and later sources only fill what it lacks. It is one
    aggregation with map-side combine; nothing is collected per key, so a hot
    key stays cheap.
    """
    stacked = stacked.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    place = F.struct("_prio", pos)
    is_base = F.col("_prio") == 0

    def present(field: str) -> Column:
        c = F.col(field)
        text = stacked.schema[field].dataType == T.StringType()
        return (c.isNotNull() & (c != sentinel)) if text else c.isNotNull()

    aggs = []
    for f in fields:
        ok = present(f) & ~is_base if base == "last" else present(f)
        aggs.append(F.min_by(f, F.when(ok, place)).alias(f"_m_{f}"))
    if base == "last":
        aggs.append(F.max_by(F.struct(*fields), F.when(is_base, F.col(pos))).alias("_base"))
    for i in range(len(tags) + 1):
        # an overwritten base row leaves no trace in the source list
        once = base == "last" and i == 0
        n = F.max(is_base.cast("bigint")) if once else F.count_if(F.col("_prio") == i)
        aggs.append(n.alias(f"_n{i}"))
    aggs.append(F.min(place).alias("_first"))
    merged = stacked.groupBy(key).agg(*aggs)
    pick = lambda f: (
        F.coalesce(F.col("_base")[f], F.col(f"_m_{f}")) if base == "last" else F.col(f"_m_{f}")
    )
    return merged.select(
        key,
        *[pick(f).alias(f) for f in fields],
        source_list(tags).alias("sources"),
        F.col("_first").alias("first_seen"),
    )


def merge_sources(sources: Sources, key: str, fields: list[str], **options) -> DataFrame:
    """:func:`merge_records` over separate frames in priority order."""
    return merge_records(stack_sources(sources), [t for t, _ in sources], key, fields, **options)


def merge_open_records(
    stacked: DataFrame, tags: list[str], key: str = "model_id", record: str = "record",
    pos: str = "pos", base: str = "first", sentinel: str = S.SENTINEL,
) -> DataFrame:
    """Same merge for records with an open set of fields, held as map<string,string>.

    A field that is present with null in every source stays present with null.
    With ``base='last'`` the last record of the first source is taken as it is.
    """
    stacked = stacked.withColumn(key, F.col(record)[key])
    stacked = stacked.filter(F.coalesce(F.col(key), F.lit("")) != "")
    cells = stacked.select(key, "_prio", pos, F.explode(record).alias("field", "value"))
    # a null value keeps its key, the sentinel does not
    place = F.struct("_prio", pos)
    in_base = (F.col("_prio") == 0) & F.lit(base == "last")
    cells = cells.filter(in_base | ~F.col("value").eqNullSafe(F.lit(sentinel)))
    has_value = F.col("value").isNotNull() & ~in_base
    is_key = F.col("field") == key
    per_field = cells.groupBy(key, "field").agg(
        F.min_by("value", F.when(has_value, place)).alias("value"),
        F.max_by("value", F.when(in_base, F.col(pos))).alias("_last"),
        F.max(F.when(in_base, F.col(pos))).alias("_at"),
        F.count_if(~in_base).alias("_others"),
        # every record holds its key, so the key field counts the records
        *[F.count_if(is_key & (F.col("_prio") == i)).alias(f"_n{i}") for i in range(len(tags) + 1)],
        F.min(F.when(is_key, place)).alias("_first"),
    )
    # one entry per distinct field name of the entity
    merged = per_field.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("field", "value", "_last", "_at", "_others"))).alias("_cells"),
        F.max(F.when(is_key, F.col("_at"))).alias("_base"),
        *[F.max(f"_n{i}").alias(f"_n{i}") for i in range(len(tags) + 1)],
        F.min("_first").alias("first_seen"),
    )
    # a field of the base counts only if its last record has it
    held = lambda c: c["_at"].eqNullSafe(F.col("_base")) & F.col("_base").isNotNull()
    kept = F.filter("_cells", lambda c: held(c) | (c["_others"] > 0))
    entries = F.transform(
        kept, lambda c: F.struct(c["field"], F.coalesce(F.when(held(c), c["_last"]), c["value"]).alias("value"))
    )
    return merged.select(
        key, F.map_from_entries(entries).alias(record), source_list(tags).alias("sources"), "first_seen"
    )
