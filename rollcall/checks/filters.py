from pyspark.sql import Window
from pyspark.sql import functions as F

from rollcall.checks.base import CATALOG_SQL, catalog, check, table
from rollcall.functions import dates as D
from rollcall.operators import dedupe
from rollcall.operators import rank as K
from rollcall.operators import stats as A
from rollcall.operators.snapshots import is_new_row
from rollcall.session import materialize


def _dated(spark, sf):
    """Orders with their day as text; urgent ones have none, low ones an unreadable one."""
    day = (
        F.when(F.col("o_orderpriority") == "1-URGENT", None)
        .when(F.col("o_orderpriority") == "5-LOW", "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return table(spark, sf, "orders").withColumn("day", day)


_DATED = """dated as (select *, case when o_orderpriority = '1-URGENT' then null when o_orderpriority = '5-LOW' then 'soon'
  else strftime(o_orderdate, '%Y-%m-%d') end as day from orders)"""


@check(
    "window_keep_null",
    f"""with {_DATED} select o_orderkey, day from dated
    where day is null or day = 'soon' or day between '1996-01-01' and '1997-06-30'""",
)
def window_keep_null(spark, sf):
    return D.in_window(_dated(spark, sf), D.date_int("day"), 19960101, 19970630, True).select("o_orderkey", "day")


@check(
    "window_drop_null",
    f"with {_DATED} select o_orderkey, day from dated where day <> 'soon' and day >= '1998-01-01'",
)
def window_drop_null(spark, sf):
    return D.in_window(_dated(spark, sf), D.date_int("day"), 19980101, None, False).select("o_orderkey", "day")


@check(
    "recent_months",
    f"""with {_DATED} select o_orderkey, day from dated
    where day <> 'soon' and cast(day as date) >= date '2001-02-28' - interval 3 month""",
)
def recent_months(spark, sf):
    """Three months back from the last of February, across the year: from 28 November on."""
    return _dated(spark, sf).filter(D.recent("day", "2001-02-28", 3)).select("o_orderkey", "day")


@check(
    "new_flag",
    f"""with {CATALOG_SQL} select row_id, coalesce(lower(trim(is_new)) in ('new', '是'), false) as any_flag,
      coalesce(is_new = 'New', false) as exact_flag from catalog""",
)
def new_flag(spark, sf):
    return catalog(spark, sf).select(
        "row_id", is_new_row("is_new").alias("any_flag"),
        F.coalesce(F.col("is_new") == "New", F.lit(False)).alias("exact_flag"),
    )


@check(
    "gap_lists",
    f"""with {CATALOG_SQL}
    select 'no_company' as gap, row_id from catalog where company is null
    union all select 'open_without_size', row_id from catalog where openness = '开源' and size is null
    union all select 'has_size', row_id from catalog where size is not null
    union all select 'no_website', row_id from catalog where website = ''""",
)
def gap_lists(spark, sf):
    return A.gap_lists(catalog(spark, sf), "row_id")


@check(
    "active_split",
    "select event_id, event_type <> 'error' and user_id > 0 as active from events",
)
def active_split(spark, sf):
    played = F.when(F.col("event_type") != "error", F.col("user_id"))
    return table(spark, sf, "events").select("event_id", A.is_active(played).alias("active"))


@check(
    "first_wins",
    """select o_custkey, o_orderkey, o_orderdate from (select *, row_number() over (partition by o_custkey
      order by o_orderdate, o_orderkey) as rn from orders) where rn = 1""",
)
def first_wins(spark, sf):
    return dedupe.first_wins(
        table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]
    )


@check(
    "body_md5_dedupe",
    "select min(doc_id) as doc_id, md5(text) as body_md5 from documents group by text",
)
def body_md5_dedupe(spark, sf):
    kept = dedupe.dedupe_bodies(table(spark, sf, "documents", spread=True).select("doc_id", "text"), "text", "doc_id")
    return kept.select("doc_id", F.md5("text").alias("body_md5"))


@check(
    "body_dedupe_order",
    """
    select min(doc_id) as doc_id, true as filter_first from documents where lang = 'en' and source <> 'src1' group by text
    union all
    select doc_id, false from (select min(doc_id) as doc_id from documents group by text) join documents using (doc_id)
    where lang = 'en' and source <> 'src1'
    """,
)
def body_dedupe_order(spark, sf):
    """The filter before the dedupe, and after it."""
    docs = table(spark, sf, "documents", spread=True).select("doc_id", "text", "lang", "source")
    keep = (F.col("lang") == "en") & (F.col("source") != "src1")
    before = dedupe.dedupe_bodies(docs, "text", "doc_id", keep).select("doc_id", F.lit(True).alias("filter_first"))
    after = dedupe.dedupe_bodies(docs, "text", "doc_id", keep, dedupe_first=True)
    return before.unionByName(after.select("doc_id", F.lit(False).alias("filter_first")))


@check(
    "sort_dates",
    f"""with {_DATED} select o_orderkey, day, row_number() over (order by case when day = 'soon' then null else day end desc nulls last, o_orderkey) as place
    from dated""",
)
def sort_dates(spark, sf):
    """The sorted rows, each with its place in the output."""
    clean = F.when(F.col("day") != "soon", F.col("day"))
    ordered = K.by_date_desc(_dated(spark, sf).select("o_orderkey", "day", clean.alias("sort_day")), "sort_day", "o_orderkey")
    # the place is read off the written files: rows in earlier parts plus the row's own index
    written = materialize(ordered, "sorted")
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("part")
    rows = written.select("o_orderkey", "day", number, "_metadata.row_index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    return rows.join(sizes, "part").select(
        "o_orderkey", "day", (F.col("before") + F.col("row_index") + 1).alias("place")
    )


@check(
    "topk_filtered",
    """select row_number() over (order by p_retailprice desc, p_partkey) as rank, p_partkey, p_retailprice from part
    where p_size > 10 and p_retailprice <> 0 order by p_retailprice desc, p_partkey limit 20""",
)
def topk_filtered(spark, sf):
    """The best twenty open records with a score."""
    part = table(spark, sf, "part").filter(A.open_with_score(F.col("p_size") > 10, "p_retailprice"))
    return K.top_n(part.select("p_partkey", "p_retailprice"), [F.col("p_retailprice").desc(), F.col("p_partkey")], 20)


@check(
    "topk_per_group",
    """
    with a as (select event_type, event_id, coalesce(case when user_id > 3 then value end, 0) as rating from events where user_id > 0),
    r as (select *, row_number() over (partition by event_type order by rating desc, event_id) as rank,
      greatest(count(*) over (partition by event_type) - 30, 0) as more from a)
    select event_type, event_id, rank, more from r where rank <= 30
    """,
)
def topk_per_group(spark, sf):
    rating = F.coalesce(F.when(F.col("user_id") > 3, F.col("value")), F.lit(0.0))
    active = table(spark, sf, "events").filter(A.is_active("user_id")).select("event_type", "event_id", rating.alias("rating"))
    more = active.groupBy("event_type").agg(K.overflow(F.count("*"), 30).alias("more"))
    best = K.top_per_group(active, ["event_type"], [F.col("rating").desc(), F.col("event_id")], 30)
    return best.join(more, "event_type").select("event_type", "event_id", "rank", "more")


@check(
    "rank_per_group",
    """select o_orderstatus, rank, o_orderkey from (select *, row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey) as rank
    from orders) where rank <= 25""",
)
def rank_per_group(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    best = K.top_per_group(orders, ["o_orderstatus"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 25)
    return best.select("o_orderstatus", "rank", "o_orderkey")


@check(
    "topn_counts",
    """select row_number() over (order by n desc, f) as rank, type, n from (select n_name as type, count(*) as n, min(c_custkey) as f
    from customer join nation on c_nationkey = n_nationkey group by 1) order by n desc, f limit 15""",
)
def topn_counts(spark, sf):
    return K.top_counts(catalog(spark, sf).select("type", "row_id"), "type", 15, "row_id")


@check(
    "share_of_max",
    """with c as (select c_mktsegment as dim, c_nationkey as value, count(*) as n from customer group by all)
    select dim, value, n, n / max(n) over (partition by dim) as share from c""",
)
def share_of_max(spark, sf):
    counts = table(spark, sf, "customer").groupBy(
        F.col("c_mktsegment").alias("dim"), F.col("c_nationkey").alias("value")
    ).agg(F.count("*").alias("n"))
    return K.share_of_max(counts, ["dim"], "n")


@check(
    "preview_lists",
    """with r as (select c_mktsegment, c_name, row_number() over (partition by c_mktsegment order by c_name) as rn,
      count(*) over (partition by c_mktsegment) as total from customer)
    select c_mktsegment, total, string_agg(c_name, ', ' order by c_name) || case when total > 20 then '...' else '' end as preview
    from r where rn <= 20 group by c_mktsegment, total""",
)
def preview_lists(spark, sf):
    return K.preview(table(spark, sf, "customer").select("c_mktsegment", "c_name"), ["c_mktsegment"], "c_name", 20)


@check(
    "first_mention",
    """
    with m as (select doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{4,}')) as name,
        generate_subscripts(regexp_extract_all(text, '[A-Z][a-z]{4,}'), 1) - 1 as pos from documents)
    select lower(name) as mention_key, min(doc_id) as doc_id, arg_min(pos, doc_id * 1000000 + pos) as pos from m group by 1
    """,
)
def first_mention(spark, sf):
    from rollcall.checks.base import names_in
    from rollcall.functions.text import plain_key

    m = table(spark, sf, "documents", spread=True).select("doc_id", F.posexplode(names_in("text")).alias("pos", "name"))
    first = dedupe.first_mention(m, plain_key("name"), ["doc_id", "pos"])
    return first.select("mention_key", "doc_id", F.col("pos").cast("bigint").alias("pos"))
