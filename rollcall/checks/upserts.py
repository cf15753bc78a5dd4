from uuid import uuid4

from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.checks.base import CATALOG_SQL, catalog, check, table
from rollcall.functions.text import plain_key
from rollcall.operators import review as R
from rollcall.operators import upsert as U
from rollcall.operators.upsert import upsert_fill as upsert
from rollcall.operators.upsert import usable_mentions as usable
from rollcall.session import scratch_path
from rollcall.sources.buckets import write_buckets


def _incoming(spark, sf):
    """Every order brings a mention of its customer, some of them under a new name."""
    customers = table(spark, sf, "customer")
    rows = table(spark, sf, "orders", spread=True).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    fresh = F.col("c_acctbal") >= 9000
    blank = F.lit("")
    return rows.select(
        F.col("o_orderkey").alias("pos"),
        F.when(fresh, F.concat("c_name", F.lit(" v2 (new)"))).otherwise(F.concat(F.lit(" "), F.upper("c_name"))).alias("model_name"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).otherwise("").alias("company"),
        F.lit("国外").alias("domestic"),
        F.lit("开源").alias("open_source"),
        F.lit(" 9B ").alias("size"),
        F.when(F.col("o_orderstatus") == "F", "https://example.org").otherwise("  ").alias("website"),
        F.lit("from order").alias("brief"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("release_date"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("source_date"),
        *[blank.alias(c) for c in ("model_type", "can_reason", "task_type")],
    )


_INCOMING = """
incoming as (
  select o_orderkey as pos, case when c_acctbal >= 9000 then c_name || ' v2' else c_name end as name, lower(c_name) as k, c_acctbal >= 9000 as fresh,
    case when c_acctbal >= 9000 then c_name || ' v2 (new)' else ' ' || upper(c_name) end as model_name,
    case when o_orderstatus <> 'P' then o_orderpriority else '' end as company,
    case when o_orderstatus = 'F' then 'https://example.org' else '  ' end as website,
    case when o_orderpriority = '5-LOW' then '' else strftime(o_orderdate, '%Y-%m-%d') end as release_date
  from orders join customer on o_custkey = c_custkey)"""

_USABLE = f"""{_INCOMING},
usable as (select * from (select *, row_number() over (partition by name order by pos) as rn from incoming
  where release_date = '' or release_date between '1996-01-01' and '1999-12-31') where rn = 1)"""


@check("usable_mentions", f"with {_USABLE} select pos, model_name, release_date from usable")
def usable_mentions(spark, sf):
    return usable(_incoming(spark, sf), ["pos"], 19960101, 19991231).select("pos", "model_name", "release_date")


@check(
    "usable_mentions_fallback",
    f"""with {_INCOMING},
    dated as (select i.* replace (strftime(o_orderdate, '%Y-%m-%d') as release_date) from incoming i join orders on pos = o_orderkey),
    kept as (select *, row_number() over (partition by name order by pos) as rn from dated where release_date between '1996-01-01' and '1999-12-31')
    select pos, release_date from kept where rn = 1""",
)
def usable_mentions_fallback(spark, sf):
    return usable(_incoming(spark, sf), ["pos"], 19960101, 19991231, date_fallback=True).select("pos", "release_date")


_UPSERT = f"""
    with {CATALOG_SQL}, {_USABLE},
    known as (
      select c.row_id, c.name,
        case when c.company is null and u.company <> '' then u.company else c.company end as company,
        case when c.region is null and u.k is not null then '国外' else c.region end as region,
        case when c.openness = '未知' and u.k is not null then '开源' else c.openness end as openness,
        case when c.size is null and u.k is not null then '9B' else c.size end as size,
        case when c.website = '' and trim(u.website) <> '' then u.website else c.website end as website,
        case when trim(coalesce(c.note, '')) in ('', 'nan') and u.k is not null then 'from order' else c.note end as note,
        c.released_at, c.is_new,
        array_to_string(list_filter([case when c.company is null and u.company <> '' then 'company' end,
          case when c.region is null and u.k is not null then 'region' end,
          case when c.openness = '未知' and u.k is not null then 'openness' end,
          case when c.size is null and u.k is not null then 'size' end,
          case when c.website = '' and trim(u.website) <> '' then 'website' end,
          case when trim(coalesce(c.note, '')) in ('', 'nan') and u.k is not null then 'note' end], lambda x: x is not null), ',') as change
      from catalog c left join (select * from usable where not fresh) u on lower(c.name) = u.k)
    select * from known
    union all
    select null, model_name, company, '国外', '开源', ' 9B ', website, 'from order', release_date, 'New', 'insert' from usable where fresh
    """


@check("upsert_fill", _UPSERT)
def upsert_fill(spark, sf):
    rows = catalog(spark, sf).drop("balance")
    incoming = usable(_incoming(spark, sf), ["pos"], 19960101, 19991231)
    done = upsert(rows, incoming, created_at="2024-02-01")
    return done.select(
        "row_id", "name", "company", "region", "openness", "size", "website", "note", "released_at", "is_new", "change"
    )


@check("upsert_buckets", _UPSERT)
def upsert_buckets(spark, sf):
    """The same from a catalog in buckets, which stays where it is."""
    rows = catalog(spark, sf).drop("balance")
    stored = write_buckets(rows, f"catalog_{uuid4().hex}", scratch_path(spark, "catalog"), plain_key("name"))
    done = U.upsert_buckets(stored, usable(_incoming(spark, sf), ["pos"], 19960101, 19991231), created_at="2024-02-01")
    return done.select(
        "row_id", "name", "company", "region", "openness", "size", "website", "note", "released_at", "is_new", "change"
    )


def reviewed_rows(spark, sf):
    """All documents as catalog rows; the label of a document is its verdict."""
    n = F.col("n_chars")
    blank = [F.lit(None).cast("string").alias(c) for c in S.CATALOG_COLUMNS if c not in ("name", "company", "size", "note", "is_new", "verification")]
    docs = table(spark, sf, "documents", spread=True).select(
        F.col("doc_id").alias("row_id"),
        F.concat(F.lit(" Doc "), "doc_id").alias("name"),
        F.when(n < 1500, "未知").otherwise(F.col("source")).alias("company"),
        F.when(n < 1000, "nan").otherwise(n.cast("string")).alias("size"),
        F.when(F.col("lang") == "fr", F.concat("lang", F.lit(" [重要性:低]"))).otherwise(F.col("lang")).alias("note"),
        F.when(F.col("lang") != "de", "New").alias("is_new"),
        F.when(F.col("lang") == "es", "nan").when(F.col("lang") != "en", "seen").alias("verification"),
        *blank,
    )
    return docs.select("row_id", *S.CATALOG_COLUMNS)


def verdicts(spark, sf):
    """Two verdicts per label, the second one counts. Toxic means remove, quality means sure."""
    sure = F.col("quality") == 1
    text = "map<string,string>"
    some = F.create_map(F.lit("company"), F.lit("Acme"), F.lit("size"), F.lit("1B"), F.lit("type"), F.lit(""))
    base = table(spark, sf, "labels").select(
        F.concat(F.lit("DOC "), "doc_id").alias("model_name"),
        (F.col("toxic") == 1).alias("should_remove"),
        F.when(F.length(F.col("doc_id").cast("string")) == 2, F.create_map().cast(text)).otherwise(some.cast(text)).alias("corrections"),
        F.when(sure, "高").otherwise("中").alias("confidence"),
        F.when(sure, "高").when(F.col("toxic") == 1, "低").alias("importance"),
        F.when(sure, "big").alias("importance_reason"),
        F.when(F.col("toxic") == 1, F.array(F.lit("old"), F.lit("name"))).otherwise(F.array().cast("array<string>")).alias("issues"),
        F.when(~sure, "look").alias("notes"),
        F.col("doc_id").alias("pos"),
    )
    first = base.withColumns({"pos": -F.col("pos") - 1, "should_remove": ~F.col("should_remove"), "confidence": F.lit("高")})
    return first.unionByName(base)


_REVIEWED = """
rows as (
  select doc_id as row_id, ' Doc ' || doc_id as name, case when n_chars < 1500 then '未知' else source end as company,
    case when n_chars < 1000 then 'nan' else cast(n_chars as varchar) end as size,
    case when lang = 'fr' then 'fr [重要性:低]' else lang end as note,
    case when lang <> 'de' then 'New' end as is_new,
    case when lang = 'es' then 'nan' when lang <> 'en' then 'seen' end as verification
  from documents),
v as (select *, length(cast(doc_id as varchar)) = 2 as plain from labels),
acted as (
  select r.*, v.quality, v.toxic, v.plain,
    coalesce(company, '') in ('', 'nan', '未知') as fill_company, coalesce(size, '') in ('', 'nan', '未知') as fill_size,
    case when v.doc_id is null then 'no_verdict' when toxic = 1 and quality = 1 then 'dropped' when toxic = 1 then 'removal_pending'
      when plain then 'tagged' when quality = 1 and (coalesce(company, '') in ('', 'nan', '未知') or coalesce(size, '') in ('', 'nan', '未知')) then 'filled'
      when quality = 1 then 'unchanged' else 'pending' end as action
  from rows r left join v on r.row_id = v.doc_id),
applied as (
  select row_id, name, action,
    case when action = 'filled' and fill_company then 'Acme' else company end as company,
    case when action = 'filled' and fill_size then '1B' else size end as size,
    case when action in ('tagged', 'filled', 'unchanged', 'pending') and note not like '%重要性%'
      then note || case when quality = 1 then ' [重要性:高|big]' else ' [重要性:中]' end else note end as note,
    case when action = 'filled' then concat_ws('; ', case when verification <> 'nan' then verification end, 'review审核补全(高置信)')
      when action = 'removal_pending' then concat_ws('; ', case when verification <> 'nan' then verification end, '⚠️ review建议删除(中置信)待人工确认 — old; name')
      when action = 'pending' then concat_ws('; ', case when verification <> 'nan' then verification end, '⚠️ review审核(中置信)待人工确认 — 建议修正: company→Acme; size→1B; look')
      else verification end as verification,
    case when action in ('dropped', 'removal_pending') then 'old; name'
      when action = 'pending' then 'company→Acme; size→1B'
      when action = 'filled' then concat_ws(', ', case when fill_company then 'company=Acme' end, case when fill_size then 'size=1B' end) end as detail
  from acted)"""


@check("apply_review", f"with {_REVIEWED} select * from applied")
def apply_review(spark, sf):
    done = R.apply_review(reviewed_rows(spark, sf), verdicts(spark, sf))
    return done.select("row_id", "name", "action", "company", "size", "note", "verification", "detail")


@check(
    "apply_review_overwrite",
    f"""with {_REVIEWED} select row_id, case when quality = 1 and toxic = 0 and not plain then 'Acme' else company end as company,
      case when quality = 1 and toxic = 0 and not plain then '1B' else size end as size from acted""",
)
def apply_review_overwrite(spark, sf):
    done = R.apply_review(reviewed_rows(spark, sf), verdicts(spark, sf), overwrite=True)
    return done.select("row_id", "company", "size")


@check(
    "review_log",
    f"""with {_REVIEWED} select name, action, detail from applied where action in ('dropped', 'removal_pending', 'filled', 'pending')""",
)
def review_log(spark, sf):
    return R.review_log(R.apply_review(reviewed_rows(spark, sf), verdicts(spark, sf))).drop("confidence")


@check(
    "review_stats",
    f"""
    with {_REVIEWED}
    select 'importance' as metric, value, 2 * count(*) as n from (select case when quality = 1 then '高' when toxic = 1 then '低' else '中' end as value from labels) group by value
    union all select 'removal', 'suggested', count(*) from labels
    union all select 'action', action, count(*) from applied group by action
    """,
)
def review_stats(spark, sf):
    v = verdicts(spark, sf)
    return R.review_stats(v, R.apply_review(reviewed_rows(spark, sf), v))


@check(
    "review_lists",
    """
    with v as (select * from labels, (values (1), (2)) t(turn))
    select 'high_importance' as list, 'DOC ' || doc_id as model_name, case when quality = 0 then 'look' else '' end as text from v where quality = 1
    union all
    select 'pending', 'DOC ' || doc_id, '[中置信] ' || concat_ws(' | ', case when length(cast(doc_id as varchar)) <> 2 then '建议: company→Acme, size→1B' end,
      case when toxic = 1 then '问题: old, name' end) from labels where quality = 0
    """,
)
def review_lists(spark, sf):
    return R.review_lists(verdicts(spark, sf))


@check(
    "review_requests",
    f"""with {_REVIEWED},
    n as (select *, row_number() over (order by row_id) as rn from rows where is_new = 'New')
    select (rn - 1) // 20 as batch, count(*) as n, '[' || string_agg('{{"name":"' || trim(name) || '","company":"' || company || '"'
      || case when size = 'nan' then '' else ',"size":"' || size || '"' end || ',"note":"' || note || '"'
      || case when coalesce(verification, 'nan') = 'nan' then '' else ',"verification":"' || verification || '"' end || '}}', ',' order by row_id) || ']' as payload
    from n group by 1""",
)
def review_requests(spark, sf):
    from rollcall.plans.review import requests

    found = requests(reviewed_rows(spark, sf))
    return found.select(
        "batch", F.size("payloads").cast("bigint").alias("n"),
        F.concat(F.lit("["), F.array_join("payloads", ","), F.lit("]")).alias("payload"),
    )
