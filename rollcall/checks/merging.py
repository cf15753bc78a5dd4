from uuid import uuid4

from pyspark.sql import functions as F

from rollcall.checks.base import catalog, check, table
from rollcall.operators import merge as M
from rollcall.operators import snapshots as D
from rollcall.session import scratch_path
from rollcall.sources.buckets import write_buckets

TAGS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _held(spark, sf):
    """Every order as a record of its customer; its priority names the source."""
    price = F.col("o_totalprice")
    return M.with_priority(
        table(spark, sf, "orders", spread=True).select(
            F.when(price >= 5000, F.col("o_custkey").cast("string")).otherwise("").alias("model_id"),
            F.col("o_orderkey").alias("pos"),
            F.col("o_orderpriority"),
            F.when(F.col("o_orderstatus") == "P", None).when(price > 400000, "$undefined").otherwise(F.col("o_orderstatus")).alias("status"),
            F.when(price < 200000, price).alias("price"),
            F.when(price > 300000, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        ),
        "o_orderpriority", TAGS,
    )


_HELD = """
held as (
  select case when o_totalprice >= 5000 then cast(o_custkey as varchar) else '' end as model_id, o_orderkey as pos,
    cast(substr(o_orderpriority, 1, 1) as integer) - 1 as prio,
    case when o_orderstatus = 'P' then null when o_totalprice > 400000 then '$undefined' else o_orderstatus end as status,
    case when o_totalprice < 200000 then o_totalprice end as price,
    case when o_totalprice > 300000 then strftime(o_orderdate, '%Y-%m-%d') end as day
  from orders)"""

_PLACE = "prio * 1000000000000 + pos"


def _flat():
    """Counts per source as text: ``1-URGENT:3,2-HIGH:1``."""
    entry = lambda e: F.concat(e["source"], F.lit(":"), e["n"].cast("string"))
    return F.array_join(F.transform("sources", entry), ",")


_SOURCE_TEXT = "array_to_string(list_filter([" + ", ".join(
    f"case when count(*) filter (prio = {i}) > 0 then '{t}:' || count(*) filter (prio = {i}) end" for i, t in enumerate(TAGS)
) + "], lambda x: x is not null), ',')"


@check(
    "priority_merge",
    f"""
    with {_HELD}
    select model_id, arg_min(status, {_PLACE}) filter (status is not null and status <> '$undefined') as status,
      arg_min(price, {_PLACE}) filter (price is not null) as price,
      arg_min(day, {_PLACE}) filter (day is not null) as day,
      {_SOURCE_TEXT} as sources, arg_min(prio, {_PLACE}) as first_source, arg_min(pos, {_PLACE}) as first_pos
    from held where model_id <> '' group by model_id
    """,
)
def priority_merge(spark, sf):
    merged = M.merge_records(_held(spark, sf), TAGS, "model_id", ["status", "price", "day"])
    return merged.select(
        "model_id", "status", "price", "day", _flat().alias("sources"),
        F.col("first_seen._prio").alias("first_source"), F.col("first_seen.pos").alias("first_pos"),
    )


@check(
    "merge_unlisted_source",
    """
    with held as (select *, case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 else 2 end as prio from orders)
    select cast(o_custkey as varchar) as model_id, arg_min(o_orderstatus, prio * 1000000000000 + o_orderkey) as status,
      count(*) filter (prio = 2) as others from held group by 1
    """,
)
def merge_unlisted_source(spark, sf):
    """Sources without a tag, and rows without a source, come last and are counted together."""
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("model_id"), F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("source"),
    )
    tags = ["1-URGENT", "2-HIGH"]
    merged = M.merge_records(M.with_priority(rows, "source", tags), tags, "model_id", ["status"])
    others = F.get(F.filter("sources", lambda s: s["source"] == "other"), F.lit(0))["n"]
    return merged.select("model_id", "status", F.coalesce(others, F.lit(0)).alias("others"))


@check(
    "priority_merge_base",
    f"""
    with {_HELD},
    based as (select model_id, status, price, day from (select *, row_number() over (partition by model_id order by pos desc) as rn
      from held where prio = 0 and model_id <> '') where rn = 1),
    rest as (
      select model_id, arg_min(status, {_PLACE}) filter (prio > 0 and status is not null and status <> '$undefined') as status,
        arg_min(price, {_PLACE}) filter (prio > 0 and price is not null) as price,
        arg_min(day, {_PLACE}) filter (prio > 0 and day is not null) as day
      from held where model_id <> '' group by model_id)
    select rest.model_id, coalesce(based.status, rest.status) as status, coalesce(based.price, rest.price) as price,
      coalesce(based.day, rest.day) as day
    from rest left join based using (model_id)
    """,
)
def priority_merge_base(spark, sf):
    """The last record of the best source stays as it is, the others supplement."""
    merged = M.merge_records(_held(spark, sf), TAGS, "model_id", ["status", "price", "day"], base="last")
    return merged.select("model_id", "status", "price", "day")


@check(
    "priority_merge_open",
    f"""
    with {_HELD},
    cells as (
      select model_id, prio, pos, 'status' as field, status as value from held
      union all select model_id, prio, pos, 'day', day from held where prio > 1
      union all select model_id, prio, pos, 'model_id', model_id from held)
    select model_id, field, arg_min(value, {_PLACE}) filter (value is not null) as value
    from cells where model_id <> '' and (value is null or value <> '$undefined') group by model_id, field
    """,
)
def priority_merge_open(spark, sf):
    """Open records: urgent and high ones have no day key, others have it, null or not."""
    keys = [F.lit("model_id"), F.col("model_id"), F.lit("status"), F.col("status")]
    short, full = F.create_map(*keys), F.create_map(*keys, F.lit("day"), F.col("day"))
    held = _held(spark, sf).withColumn("record", F.when(F.col("_prio") > 1, full).otherwise(short))
    merged = M.merge_open_records(held.select("_prio", "pos", "record"), TAGS)
    return merged.select("model_id", F.explode("record").alias("field", "value"))


@check(
    "merge_two_frames",
    """
    select coalesce(c_mktsegment, s_name) as seg, coalesce(c, s) as balance,
      case when c is null then 0 else 1 end as from_customer
    from (select c_nationkey as k, min(c_custkey) as pos, arg_min(c_acctbal, c_custkey) as c, arg_min(c_mktsegment, c_custkey) as c_mktsegment from customer group by 1)
    full join (select s_nationkey as k, arg_min(s_acctbal, s_suppkey) as s, arg_min(s_name, s_suppkey) as s_name from supplier group by 1) using (k)
    """,
)
def merge_two_frames(spark, sf):
    a = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("pos"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("balance")
    )
    b = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("pos"), F.col("s_name").alias("seg"), F.col("s_acctbal").alias("balance")
    )
    merged = M.merge_sources([("customer", a), ("supplier", b)], "k", ["seg", "balance"])
    return merged.select(
        "seg", "balance", F.when(F.exists("sources", lambda s: s["source"] == "customer"), 1).otherwise(0).alias("from_customer")
    )


def _sides(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("row_id")
    )
    new = rows.filter("balance >= 0")
    old = rows.filter("balance < 8000").withColumn("name", F.concat(F.lit(" "), "name", F.lit("\t")))
    return new, old


_DIFF = """
    select c_name as key, case when c_acctbal >= 8000 then 'added' when c_acctbal >= 0 then 'kept' else 'missing' end as status
    from customer
    """


@check("snapshot_diff", _DIFF)
def snapshot_diff(spark, sf):
    return D.diff_snapshots(*_sides(spark, sf))


@check("snapshot_diff_buckets", _DIFF)
def snapshot_diff_buckets(spark, sf):
    """The same of two snapshots in buckets."""
    stored = [write_buckets(df, f"side_{uuid4().hex}", scratch_path(spark, "side")) for df in _sides(spark, sf)]
    return D.diff_buckets(*stored)


@check(
    "snapshot_diff_counts",
    """
    select count(*) filter (c_acctbal >= 0) as new_total, count(*) filter (c_acctbal < 8000) as old_total,
      count(*) filter (c_acctbal >= 8000) as added, count(*) filter (c_acctbal >= 0 and c_acctbal < 8000) as kept,
      count(*) filter (c_acctbal < 0) as missing
    from customer
    """,
)
def snapshot_diff_counts(spark, sf):
    return D.diff_counts(D.diff_snapshots(*_sides(spark, sf)))


@check(
    "sync_only_new",
    """
    select c_name as name, 'stored' as origin from customer where c_acctbal >= 9000
    union all select c_name, 'fresh' from customer where c_acctbal >= 8000 and c_acctbal < 9000
    """,
)
def sync_only_new(spark, sf):
    new, old = _sides(spark, sf)
    twice = new.unionByName(new.withColumn("name", F.concat("name", F.lit(" "))).withColumn("row_id", -F.col("row_id") - 1))
    stored = new.filter("balance >= 9000").select("name", F.lit("stored").alias("origin"))
    only = D.sync_only_new(twice.withColumn("origin", F.lit("fresh")), old, stored, [F.col("row_id").desc()])
    return only.select("name", "origin")


@check("sync_only_first_run", "select c_name as name from customer where c_acctbal >= 4000")
def sync_only_first_run(spark, sf):
    """Without an earlier snapshot the rows flagged New are taken."""
    return D.sync_only_new(catalog(spark, sf), None, None, ["row_id"]).select("name")
