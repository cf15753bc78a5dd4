from pyspark.sql import functions as F

from rollcall.checks.base import CATALOG_SQL, catalog, check, table
from rollcall.functions import labels as L
from rollcall.operators import snapshots as D
from rollcall.operators import stats as A
from rollcall.plans.reports import required_fill as fill


@check(
    "row_checks",
    """
    select 'not_empty' as "check", cast(count(*) as double) as value, count(*) > 0 as passed from orders
    union all select 'no_null_keys', cast(count(*) filter (o_custkey is null) as double), count(*) filter (o_custkey is null) = 0 from orders
    union all select 'all_final', cast(count(*) filter (o_orderstatus <> 'F') as double), count(*) filter (o_orderstatus <> 'F') = 0 from orders
    """,
)
def row_checks(spark, sf):
    rules = [
        ("not_empty", F.count("*"), lambda v: v > 0),
        ("no_null_keys", F.count_if(F.col("o_custkey").isNull()), lambda v: v == 0),
        ("all_final", F.count_if(F.col("o_orderstatus") != "F"), lambda v: v == 0),
    ]
    return A.checks(rules, table(spark, sf, "orders"))


@check(
    "required_fill",
    f"""
    with {CATALOG_SQL},
    c as (select 'company' as field, count(*) filter (coalesce(trim(company), '') not in ('', 'nan')) as filled, count(*) as total from catalog
      union all select 'note', count(*) filter (coalesce(trim(note), '') not in ('', 'nan')), count(*) from catalog
      union all select 'released_at', count(*) filter (coalesce(trim(released_at), '') not in ('', 'nan')), count(*) from catalog)
    select field, filled, total, cast(round_even(filled / total * 100, 0) as bigint) as pct_round,
      case when filled = total then 'ok' when filled / total * 100 >= 80 then 'warn' else 'fail' end as grade from c
    """,
)
def required_fill(spark, sf):
    return fill(catalog(spark, sf))


@check(
    "missing_check",
    """select 'nothing_missing' as "check", cast(count(*) filter (c_acctbal < 0) as double) as value,
      count(*) filter (c_acctbal < 0) = 0 as passed from customer""",
)
def missing_check(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_name").alias("name"), "c_acctbal")
    diff = D.diff_snapshots(rows.filter("c_acctbal >= 0"), rows)
    return A.checks([("nothing_missing", F.count_if(F.col("status") == "missing"), lambda v: v == 0)], diff)


@check(
    "extract_fill",
    """select 'extracted' as field, count(l.doc_id) as filled, count(*) as total, cast(floor(count(l.doc_id) * 100 / count(*)) as bigint) as pct_floor
      from documents d left join labels l on d.doc_id = l.doc_id""",
)
def extract_fill(spark, sf):
    """Share of the articles that have a result."""
    done = table(spark, sf, "labels").select("doc_id", F.lit("yes").alias("extracted"))
    docs = table(spark, sf, "documents", spread=True).select("doc_id").join(done, "doc_id", "left")
    return A.coverage(docs, ["extracted"], "text").select("field", "filled", "total", "pct_floor")


@check(
    "date_resolution",
    """
    with c as (
      select o_custkey, case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as source_rank,
        case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then null else cast(strftime(o_orderdate, '%Y%m%d') as integer) end as date_int
      from orders),
    d as (select o_custkey, arg_min(date_int, source_rank * 100000000 + date_int) filter (date_int is not null) as confirmed from c group by o_custkey)
    select o_custkey, confirmed, case when confirmed is null then 'pending' when confirmed between 19970101 and 19991231 then 'keep' else 'drop' end as decision from d
    """,
)
def date_resolution(spark, sf):
    sure = ~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    found = table(spark, sf, "orders").select(
        "o_custkey",
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).alias("source_rank"),
        F.when(sure, F.date_format("o_orderdate", "yyyyMMdd").cast("int")).alias("date_int"),
    )
    return A.resolve_dates(found, "o_custkey", 19970101, 19991231)


@check(
    "coverage",
    """
    with j as (select d.doc_id, case when quality = 1 then '  ' when toxic = 1 then 'nan' when l.doc_id is not null then 'x' end as t
      from documents d left join labels l on d.doc_id = l.doc_id)
    select mode, count(*) as total, count(*) filter (case mode when 'not_null' then t is not null
      when 'text' then trim(coalesce(t, '')) <> '' else trim(coalesce(t, '')) not in ('', 'nan') end) as filled
    from j, (values ('not_null'), ('text'), ('text_not_nan')) m(mode) group by mode
    """,
)
def coverage(spark, sf):
    text = F.when(F.col("quality") == 1, "  ").when(F.col("toxic") == 1, "nan").when(F.col("quality").isNotNull(), "x")
    docs = table(spark, sf, "documents", spread=True).select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    docs = docs.select("doc_id", text.alias("t"))
    modes = ["not_null", "text", "text_not_nan"]
    parts = [A.coverage(docs, ["t"], m).select(F.lit(m).alias("mode"), "total", "filled") for m in modes]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check(
    "coverage_grades",
    f"""
    with {CATALOG_SQL}, c as (
      select 'name' as field, count(name) as filled, count(*) as total from catalog
      union all select 'company', count(company), count(*) from catalog
      union all select 'region', count(region), count(*) from catalog
      union all select 'is_new', count(is_new), count(*) from catalog)
    select field, filled, total, cast(floor(filled * 100 / total) as bigint) as pct_floor,
      cast(round_even(filled / total * 100, 0) as bigint) as pct_round,
      case when filled / total * 100 >= 90 then 'ok' when filled / total * 100 >= 50 then 'warn' else 'fail' end as grade
    from c
    """,
)
def coverage_grades(spark, sf):
    done = A.coverage(catalog(spark, sf), ["name", "company", "region", "is_new"])
    return done.select("field", "filled", "total", "pct_floor", "pct_round", L.coverage_grade("pct").alias("grade"))


@check(
    "map_coverage",
    """select field, count(*) as total, count(*) filter (case field when 'k' then true when 'value' then value > 5 else false end) as filled
      from events, (values ('k'), ('value'), ('none')) f(field) group by field""",
)
def map_coverage(spark, sf):
    k = F.get_json_object("props", "$.k")
    big = F.when(F.col("value") > 5, F.col("value").cast("string"))
    rows = table(spark, sf, "events").select(F.create_map(F.lit("k"), k, F.lit("value"), big).alias("record"))
    return A.map_coverage(rows, "record", ["k", "value", "none"]).select("field", "total", "filled")
