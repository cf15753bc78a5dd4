from pyspark.sql import functions as F

from rollcall.checks.base import ARTICLES_SQL, CATALOG_SQL, articles, catalog, check, table
from rollcall.session import scratch_path
from rollcall.sources import readers as R
from rollcall.sources import writers as W


@check("read_catalog", "select c_custkey, c_name, c_mktsegment from customer")
def read_catalog(spark, sf):
    return R.read_catalog(spark, f"{sf}/customer.parquet", columns=["c_custkey", "c_name", "c_mktsegment"])


@check(
    "props_records",
    "select event_id, cast(0 as bigint) as pos, regexp_extract(props, '\"k\": ([0-9]+)', 1) as k from events",
)
def props_records(spark, sf):
    files = table(spark, sf, "events").select(
        F.col("event_id").alias("file"), F.concat(F.lit("["), "props", F.lit("]")).alias("text")
    )
    return R.parse_records(files).select(
        F.col("file").alias("event_id"), F.col("pos").cast("bigint").alias("pos"), F.col("record")["k"].alias("k")
    )


@check(
    "arena_shapes",
    """
    select event_type as category, user_id as subcategory, 'e' || event_id as model_id,
      user_id as matches_played, value as conservative_rating
    from events where event_type in ('view', 'click')
    """,
)
def arena_shapes(spark, sf):
    entry = F.concat(
        F.lit('{"model_id": "e'), F.col("event_id"), F.lit('", "matches_played": '), F.col("user_id"),
        F.lit(', "conservative_rating": '), F.col("value"), F.lit("}"),
    )
    shape = (
        F.when(F.col("event_type") == "view", F.concat(F.lit(" ["), entry, F.lit("]")))
        .when(F.col("event_type") == "click", F.concat(F.lit('{"leaderboard": ['), entry, F.lit("]}")))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"rows": ['), entry, F.lit("]}")))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"leaderboard": [ oops'), entry))
        .otherwise("[]")
    )
    files = table(spark, sf, "events").select(
        F.col("event_type").alias("category"), F.col("user_id").alias("subcategory"), shape.alias("text")
    )
    return R.parse_arena(files, ["category", "subcategory"]).select(
        "category", "subcategory", "model_id", "matches_played", "conservative_rating"
    )


@check(
    "article_split",
    r"""
    select conv_id as seq, role || ' 2024011' || turn as title, 'http://example.com/' || turn as link,
      cast('2024011' || turn as integer) as date_int,
      regexp_replace(text, '^\s+|\s+$', '', 'g') as body, conv_id || '_' || turn as file
    from conversations where length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 50
    """,
)
def article_split(spark, sf):
    content = F.concat(
        F.lit("标题: "), "role", F.lit(" 2024011"), "turn", F.lit("\n链接: http://example.com/"), "turn",
        F.lit("\n序号: "), "conv_id", F.lit("\n" + "=" * 80 + "\n\n"), "text",
    )
    files = table(spark, sf, "conversations", spread=True).select(
        F.concat_ws("_", "conv_id", "turn").alias("file"), content.alias("text")
    )
    return R.parse_articles(files).withColumn("seq", F.col("seq").cast("bigint"))


@check(
    "page_fallback",
    """
    select page_id, case when url like 'https%' then 'fresh' else 'cached' end as origin,
      md5(case when url like 'https%' then html else 'old ' || html end) as html_md5
    from pages
    """,
)
def page_fallback(spark, sf):
    pages = table(spark, sf, "pages", spread=True)
    fresh = pages.select("page_id", F.when(F.col("url").startswith("https"), F.col("html")).alias("html"))
    older = pages.select("page_id", F.concat(F.lit("old "), "html").alias("html"))
    return R.pages_with_fallback(fresh, older, "page_id").select(
        "page_id", "origin", F.md5("html").alias("html_md5")
    )


@check(
    "append_fixed_schema",
    """
    select c_name as name, c_mktsegment as company, cast(null as varchar) as website from customer
    union all
    select s_name, null, 'http://example.com/' || s_suppkey from supplier
    """,
)
def append_fixed_schema(spark, sf):
    old = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("company"), "c_acctbal"
    )
    new = table(spark, sf, "supplier").select(
        F.concat(F.lit("http://example.com/"), "s_suppkey").alias("website"), F.col("s_name").alias("name")
    )
    return W.append_catalog(old, new, ["name", "company", "website"])


@check("concat_sources", "select c_name as name, c_acctbal as balance, c_mktsegment as segment from customer union all select s_name, s_acctbal, null from supplier")
def concat_sources(spark, sf):
    from rollcall.operators.merge import concat_rows

    a = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    b = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return concat_rows(a, b)


@check("records_roundtrip", "select p_partkey, p_name, case when p_size > 10 then p_brand end as p_brand, p_retailprice from part")
def records_roundtrip(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") > 10, F.col("p_brand")).alias("p_brand"), "p_retailprice"
    )
    path = scratch_path(spark, "records")
    W.write_records(part, path)
    return spark.read.schema(part.schema).json(path)


@check(
    "snapshot_roll",
    """
    select snapshot_date, o_orderstatus as status, count(*) as n, cast(sum(o_custkey) as bigint) as keys
    from (select '2024-01-01' as snapshot_date, * from orders where o_orderstatus <> 'O'
          union all select '2024-01-02', * from orders)
    group by all
    """,
)
def snapshot_roll(spark, sf):
    """Two days, the second written twice: the rerun replaces only its own day."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch_path(spark, "snapshots")
    W.roll_snapshot(orders.filter("o_orderstatus <> 'O'"), path, "2024-01-01")
    W.roll_snapshot(orders.filter("o_orderstatus = 'O'"), path, "2024-01-02")
    W.roll_snapshot(orders, path, "2024-01-02")
    return (
        W.snapshots(spark, path)
        .groupBy("snapshot_date", F.col("o_orderstatus").alias("status"))
        .agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))
    )


@check(
    "snapshot_previous",
    "select o_orderkey, o_custkey from orders where o_orderstatus <> 'O'",
)
def snapshot_previous(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch_path(spark, "snapshots")
    W.roll_snapshot(orders.filter("o_orderstatus = 'F'"), path, "2024-01-01")
    W.roll_snapshot(orders.filter("o_orderstatus <> 'O'"), path, "2024-01-08")
    W.roll_snapshot(orders, path, "2024-01-15")
    return W.previous_snapshot(spark, path, "2024-01-15").select("o_orderkey", "o_custkey")


@check(
    "run_metrics",
    """
    select '2024-01-02' as run_date,
      (select count(*) from customer where c_acctbal < 8000) as before,
      (select count(*) from customer where c_acctbal >= 0) as after,
      (select count(distinct c_name) from customer where c_acctbal >= 8000) as added,
      (select count(distinct c_name) from customer where c_acctbal < 0) as missing,
      cast(2 as bigint) as columns
    """,
)
def run_metrics(spark, sf):
    from rollcall.operators.snapshots import run_metrics as metrics

    rows = table(spark, sf, "customer").select(F.col("c_name").alias("name"), "c_acctbal")
    path = scratch_path(spark, "run-metrics")
    W.append_run_metrics(
        metrics("2024-01-02", rows.filter("c_acctbal >= 0"), rows.filter("c_acctbal < 8000")), path
    )
    return spark.read.parquet(path)


SUMMARY_SQL = r"""
  case when length(s) > 150 then substr(s, 1, 150) || '…' else s end"""
LONG_LINES_SQL = r"""
  array_to_string(list_filter(list_transform(string_split(body, chr(10)),
    lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 10)[1:3], '；') as s"""


@check(
    "article_index_sync",
    f"""
    with {ARTICLES_SQL},
    known as (select * from articles where substr(title, 1, 4) in ('src1', 'src2')),
    fresh as (select * from articles where title not in (select title from known)),
    lined as (select *, {LONG_LINES_SQL} from fresh)
    select (select max(seq) from known) + row_number() over (order by doc_id) as seq, title,
      {SUMMARY_SQL} as summary, link,
      substr(published, 1, 4) || '.' || substr(published, 5, 2) || '.' || substr(published, 7) as published,
      '' as reads, '' as comments, '' as mentioned_models, '' as untracked_models
    from lined
    """,
)
def article_index_sync(spark, sf):
    all_articles = articles(spark, sf)
    index = all_articles.filter(F.substring("title", 1, 4).isin("src1", "src2")).select(
        F.col("seq").cast("bigint").alias("seq"), "title"
    )
    return W.article_result_rows(W.sync_article_index(index, all_articles, "doc_id"))


@check(
    "seq_from_max",
    "select doc_id, 1000 + row_number() over (order by doc_id) as seq from documents",
)
def seq_from_max(spark, sf):
    from rollcall.operators.rank import number_rows

    return number_rows(table(spark, sf, "documents", spread=True).select("doc_id"), "doc_id", start=1000)


@check("batches", "select doc_id, (row_number() over (order by doc_id) - 1) // 20 as batch from documents")
def batches(spark, sf):
    from rollcall.operators.rank import batches as in_batches

    return in_batches(table(spark, sf, "documents", spread=True).select("doc_id"), "doc_id", 20)


@check(
    "damaged_records",
    """
    select cast(c_custkey as varchar) as file, cast(pos as bigint) as pos, c_name || pos as name, c_custkey % 4 in (1, 2) as damaged
    from customer, generate_series(0, 2) as g(pos) where c_custkey % 4 <> 3 and (c_custkey % 4 <> 1 or pos < 2)
    """,
)
def damaged_records(spark, sf):
    """Whole arrays, arrays cut off in the third object, with a number and a text inside, and no arrays."""
    name = lambda i: F.concat(F.lit('{"name":"'), "c_name", F.lit(f'{i}","x":"a]b"}}'))
    kind = F.col("c_custkey") % 4
    text = (
        F.when(kind == 0, F.concat(F.lit("["), name(0), F.lit(","), name(1), F.lit(","), name(2), F.lit("]")))
        .when(kind == 1, F.concat(F.lit("["), name(0), F.lit(","), name(1), F.lit(',{"name":"cut')))
        .when(kind == 2, F.concat(F.lit("["), name(0), F.lit(',5,"{}",'), name(1), F.lit(","), name(2), F.lit("]")))
        .otherwise("nothing here")
    )
    files = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("file"), text.alias("text"))
    rows = R.parse_records(files).select("file", F.col("pos").cast("bigint").alias("pos"), F.col("record")["name"].alias("name"))
    broken = R.damaged_files(files).select("file", F.lit(True).alias("hit"))
    return rows.join(broken, "file", "left").select("file", "pos", "name", F.coalesce("hit", F.lit(False)).alias("damaged"))


@check(
    "nested_records",
    """
    select cast(c_custkey as varchar) as file, cast(pos as bigint) as pos, c_name || pos as name, '{"y":' || c_custkey || '}' as inside
    from customer, generate_series(0, 2) as g(pos) where c_custkey % 3 <> 1 or pos < 2
    """,
)
def nested_records(spark, sf):
    """Records that hold objects: whole arrays, arrays cut off after an inner object, keys said twice."""
    inside = F.concat(F.lit(',"in":{"y":'), F.col("c_custkey"), F.lit("}"))
    name = lambda i: F.concat(F.lit('{"name":"'), "c_name", F.lit(f'{i}"'), inside, F.lit("}"))
    twice = lambda i: F.concat(F.lit('{"name":"first","in":{"z":0},"name":"'), "c_name", F.lit(f'{i}"'), inside, F.lit("}"))
    kind = F.col("c_custkey") % 3
    text = (
        F.when(kind == 0, F.concat(F.lit("["), name(0), F.lit(","), name(1), F.lit(","), name(2), F.lit("]")))
        .when(kind == 1, F.concat(F.lit("["), name(0), F.lit(","), name(1), F.lit(',{"name":"cut"'), inside, F.lit(',"q"')))
        .otherwise(F.concat(F.lit("["), twice(0), F.lit(","), name(1), F.lit(","), twice(2), F.lit("]")))
    )
    files = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("file"), text.alias("text"))
    record = F.col("record")
    return R.parse_records(files).select(
        "file", F.col("pos").cast("bigint").alias("pos"), record["name"].alias("name"), record["in"].alias("inside")
    )


@check(
    "article_persist",
    r"""
    with rows as (
      select conv_id * 100 + turn as seq, role, turn, copy, (conv_id * 100 + turn) * 10 + copy as pos,
        case when role = 'system' then '' when turn = 2 then '[爬取失败] ' || text else text || copy end as body,
        case when copy < 3 then ' ' || role || '?*' || turn || chr(10) || 'rest' when copy = 3 then role || '*' || turn
          else repeat('x', 90) || role || copy end as title
      from conversations, generate_series(1, 5) as g(copy)),
    firsts as (
      select *, row_number() over (partition by seq, title order by pos) as n from rows
      where body <> '' and not starts_with(body, '[爬取失败]'))
    select pos, lpad(cast(seq as varchar), cast(greatest(2, length(cast(seq as varchar))) as integer), '0')
        || '_' || case when copy < 4 then role || turn else repeat('x', 80) end as article_key, body
    from firsts where n = 1 and not (role = 'user' and copy < 3)
    """,
)
def article_persist(spark, sf):
    """Five articles of each number: two alike, one that differs in removed signs, two beyond the 80th sign."""
    copy = F.col("copy")
    talk = table(spark, sf, "conversations", spread=True).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5))))
    body = F.when(F.col("role") == "system", "").when(
        F.col("turn") == 2, F.concat(F.lit("[爬取失败] "), "text")
    ).otherwise(F.concat("text", copy))
    title = (
        F.when(copy < 3, F.concat(F.lit(" "), "role", F.lit("?*"), "turn", F.lit("\nrest")))
        .when(copy == 3, F.concat("role", F.lit("*"), "turn"))
        .otherwise(F.concat(F.lit("x" * 90), "role", copy))
    )
    seq = F.col("conv_id") * 100 + F.col("turn")
    rows = talk.select(seq.alias("seq"), (seq * 10 + copy).alias("pos"), title.alias("title"), body.alias("body"), "role", "copy")
    stored = rows.filter("role = 'user' and copy = 1").select("seq", "title")
    return W.new_articles(rows, stored, "pos").select("pos", "article_key", "body")


@check(
    "usable_articles",
    "select conv_id, turn from conversations where text <> '' and role <> 'system' and turn <> 1",
)
def usable_articles(spark, sf):
    body = (
        F.when(F.col("role") == "system", F.lit(None))
        .when(F.col("turn") == 1, F.concat(F.lit("[内容过短]"), "text"))
        .otherwise(F.col("text"))
    )
    rows = table(spark, sf, "conversations", spread=True).withColumn("body", body)
    return W.usable_articles(rows).select("conv_id", "turn")


@check(
    "catalog_append",
    f"""
    with {CATALOG_SQL}
    select name, cast(null as varchar) as is_integrated, company, region, note, is_new from catalog
    union all select s_name, null, null, null, 'supplier', 'New' from supplier
    """,
)
def catalog_append(spark, sf):
    new = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.lit("supplier").alias("note"), F.lit("New").alias("is_new"), "s_acctbal"
    )
    return W.append_catalog(catalog(spark, sf), new).select(
        "name", "is_integrated", "company", "region", "note", "is_new"
    )
