from pyspark.sql import functions as F

from rollcall.checks.base import ARTICLES_SQL, articles, check, names_in, table
from rollcall.checks.upserts import _REVIEWED, reviewed_rows, verdicts
from rollcall.plans import collect as C
from rollcall.plans import review as V
from rollcall.plans.mentions import articles_in_window
from rollcall.plans.mentions import mention_run as run_mentions

BASE_URL = "http://example.com/models"
TAGS = ["best", "good", "open", "news"]


def _saved_pages(spark, sf):
    """Every part is held by a page of one source, some by two, with its record in the script."""
    part = table(spark, sf, "part", spread=True)
    kind, size = F.col("p_type"), F.col("p_size")
    text = lambda k, c: F.concat(F.lit(f'\\"{k}\\":\\"'), c, F.lit('\\",'))
    number = lambda k, c: F.concat(F.lit(f'\\"{k}\\":'), c.cast("string"), F.lit(","))
    day = F.concat(F.lit("2024-0"), F.floor(size / 8 + 1).cast("string"), F.lit("-15"))
    common = [F.lit('{\\"model_id\\":\\"m'), F.col("p_partkey"), F.lit('\\",')]
    full = [
        *common,
        text("name", F.concat_ws(" ", "p_name", F.floor(F.col("p_partkey") / 2).cast("string"))),
        text("organization", F.col("p_brand")),
        text("organization_country", F.when(size > 25, "CN").otherwise("US")),
        F.when(kind == "LARGE", "").otherwise(number("params", F.lit(7_000_000_000))),
        F.when(kind == "SMALL", "").otherwise(number("is_open_source", kind == "PROMO")),
        F.when(size <= 4, "").otherwise(text("announcement_date", day)),
        F.lit('\\"license\\":\\"$undefined\\"}'),
    ]
    extra = [*common, text("license", F.lit("mit")), F.lit('\\"index_reasoning\\":41.5}')]
    page = lambda head, items, key: F.concat(
        F.lit(f'<html>{head}<script>self.__next_f.push([1,"x:{{\\"{key}\\":['), *items, F.lit(']}"])</script>')
    )
    first = part.select(
        F.when(kind == "MEDIUM", "open").otherwise("best").alias("source"),
        F.col("p_partkey").alias("page"), page("a", full, "initialData").alias("html"),
    )
    second = part.filter(size > 40).select(
        F.lit("news").alias("source"), F.col("p_partkey").alias("page"), page("b", extra, "recentUpdates").alias("html")
    )
    return first.unionByName(second)


@check(
    "collect_run",
    """
    with p as (
      select *, p_name || ' ' || (p_partkey // 2) as name, case when p_size <= 4 then '' else '2024-0' || cast(floor(p_size / 8 + 1) as bigint) || '-15' end as day,
        case when p_type = 'MEDIUM' then 2 else 0 end as prio from part),
    w as (select * from p where day = '' or day between '2024-02-01' and '2024-05-31'),
    f as (select *, row_number() over (partition by lower(name) order by case when day = '' then null else day end desc nulls last, prio, p_partkey) as rn from w),
    k as (select * from f where rn = 1 and lower(name) not in (select lower(p_name || ' ' || p_partkey) from part where p_type = 'STANDARD')),
    n as (select *, case when p_type = 'PROMO' then '开源' when p_type = 'SMALL' then '未知' else '闭源' end as openness,
      case when p_type = 'LARGE' then '' else '7B' end as size0, p_type = 'PROMO' and name in (select name from p where p_size < 20) as hit from k)
    select name, p_brand as company, case when p_size > 25 then '国内' else '国外' end as region, openness, size0 as size,
      case when p_type = 'LARGE' then '领域' else '基座' end as type,
      case when p_size > 40 or regexp_matches(lower(name), 'thinking|reason|o1|o3|o4|r1|r2') then 'thinking' else 'non-thinking' end as reasoning,
      'http://example.com/models/m' || p_partkey as website, case when p_size > 40 then 'MIT' else '' end as note,
      day as released_at, case when hit then 'registry verified(' || name || ') · 参数量=9B' else 'leaderboard' end as verification
    from n
    """,
)
def collect_run(spark, sf):
    """Pages to records to new catalog rows, checked against a registry."""
    part = table(spark, sf, "part", spread=True)
    known = part.filter("p_type = 'STANDARD'").select(
        F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "), "p_partkey").alias("name")
    )
    registry = part.filter("p_size < 20").select(
        F.concat_ws(" ", "p_name", F.floor(F.col("p_partkey") / 2).cast("string")).alias("repo_id"),
        F.lit(9_000_000_000).alias("params_total"),
        F.array(F.lit("x")).alias("tags"), F.lit("").alias("pipeline_tag"), F.lit(False).alias("login_required"),
    ).distinct()
    rows = C.collect(
        _saved_pages(spark, sf), TAGS, known, registry, 20240201, 20240531, "2024-06-01", BASE_URL
    )
    return rows.select(
        "name", "company", "region", "openness", "size", "type", "reasoning", "website", "note", "released_at", "verification"
    )


def _mention_inputs(spark, sf):
    """Documents as articles, a reply per article with the names its text holds.

    The names of passages are tracked, the names in talks are known to the records.
    """
    docs = articles(spark, sf)
    names = F.transform(
        names_in("body"),
        lambda w: F.struct(
            w.alias("name"), F.col("published").alias("company"), F.lit("").alias("size"),
            F.when(F.length(w) > 9, F.lit("2024-01-09")).otherwise("").alias("release_date"),
        ),
    )
    content = F.concat(F.lit("names: "), F.to_json(names), F.lit(" done"))
    response = F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices")))
    replies = docs.select("file", response.alias("response"))
    words = lambda t, key: (
        table(spark, sf, t).select(key, F.explode(names_in("text")).alias("w"))
        .groupBy(F.lower("w").alias("w")).agg(F.min(key).alias("first"))
    )
    catalog = words("benchmark", "item_id").select(
        F.xxhash64("w").alias("row_id"), F.initcap("w").alias("name"), F.lit("known").alias("company"),
        *[F.lit(None).cast("string").alias(c) for c in ("region", "size", "website", "note", "released_at", "created_at", "is_new", "verification")],
    )
    records = words("conversations", "conv_id").select(
        F.struct("first", "w").alias("pos"), F.col("w").alias("name"), F.concat(F.lit("id "), "w").alias("model_id"),
        F.lit(3_000_000_000).alias("params"), F.lit("2024-01-12").alias("release_date"), F.lit("").alias("announcement_date"),
    )
    return docs.drop("doc_id", "published"), replies, catalog, records


_MENTIONS = f"""
{ARTICLES_SQL},
kept as (select * from (select *, row_number() over (partition by body order by file) as rn from articles where date_int between 20240103 and 20240110) where rn = 1),
m as (select file, seq, title, published, unnest(regexp_extract_all(body, '[A-Z][a-z]{{4,}}')) as name,
  generate_subscripts(regexp_extract_all(body, '[A-Z][a-z]{{4,}}'), 1) as pos from kept),
known as (select distinct lower(w) as w from (select unnest(regexp_extract_all(text, '[A-Z][a-z]{{4,}}')) as w from benchmark)),
keys as (select distinct lower(name) as k from m),
tracked as (select k from keys where exists (select 1 from known where contains(k, w) or contains(w, k))),
t as (select m.*, lower(name) as k, lower(name) in (select k from tracked) as tracked from m)"""


@check(
    "mention_run",
    f"""
    with {_MENTIONS},
    f as (select * from (select *, row_number() over (partition by k order by file, pos) as rn from t where not tracked) where rn = 1),
    rec as (select lower(w) as w, min(conv_id) as first from (select conv_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{{4,}}')) as w from conversations) group by 1),
    idx as (select w as key, w, first, 0 as which from rec union all select 'id' || w, w, first, 1 from rec),
    o as (select *, row_number() over (order by first, w, which) as place from idx),
    hit as (select k, arg_min(w, case when key = k then -1 else place end) as w from f join o on contains(k, key) or contains(key, k) group by k),
    done as (select f.*, h.w as rec, case when length(name) > 9 then '2024-01-09' when h.w is not null then '2024-01-12' else '' end as day
      from f left join hit h on f.k = h.k)
    select name, published as company, case when rec is not null then '3B' else '' end as size,
      coalesce('http://example.com/models/id ' || rec, '') as website, day as released_at,
      case when rec is not null then 'cross-verified' else 'auto-extracted' end as verification, 'insert' as change
    from done where day = '' or day between '2024-01-03' and '2024-01-10'
    union all
    select upper(w[1:1]) || w[2:], 'known', null, null, null, null, '' from known
    """,
)
def mention_run(spark, sf):
    run = run_mentions(*_mention_inputs(spark, sf), 20240103, 20240110, "2024-01-31", BASE_URL)
    return run.catalog.select("name", "company", "size", "website", "released_at", "verification", "change")


@check(
    "mention_run_fill",
    f"""
    with {_MENTIONS},
    f as (select * from (select *, row_number() over (partition by k order by file, pos) as rn from t
      where not tracked or k in (select w from known)) where rn = 1),
    rec as (select lower(w) as w, min(conv_id) as first from (select conv_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{{4,}}')) as w from conversations) group by 1),
    idx as (select w as key, w, first, 0 as which from rec union all select 'id' || w, w, first, 1 from rec),
    o as (select *, row_number() over (order by first, w, which) as place from idx),
    hit as (select k, arg_min(w, case when key = k then -1 else place end) as w from f join o on contains(k, key) or contains(key, k) group by k),
    done as (select f.*, h.w as rec, case when length(name) > 9 then '2024-01-09' when h.w is not null then '2024-01-12' else '' end as day
      from f left join hit h on f.k = h.k),
    used as (select * from done where day = '' or day between '2024-01-03' and '2024-01-10')
    select name, published as company, case when rec is not null then '3B' else '' end as size,
      coalesce('http://example.com/models/id ' || rec, '') as website, day as released_at, 'insert' as change
    from used where k not in (select w from known)
    union all
    select upper(known.w[1:1]) || known.w[2:], 'known', case when rec is not null then '3B' end, 'http://example.com/models/id ' || rec, nullif(day, ''),
      concat_ws(',', case when rec is not null then 'size' end, case when rec is not null then 'website' end, case when day <> '' then 'released_at' end)
    from known left join used on used.k = known.w
    """,
)
def mention_run_fill(spark, sf):
    """The same run, with the rows of tracked names filled."""
    run = run_mentions(*_mention_inputs(spark, sf), 20240103, 20240110, "2024-01-31", BASE_URL, fill_tracked=True)
    return run.catalog.select("name", "company", "size", "website", "released_at", "change")


@check(
    "mention_run_articles",
    f"""
    with {_MENTIONS},
    l as (select file, string_agg(name, chr(10) order by pos) as mentioned,
      coalesce(string_agg(name, chr(10) order by pos) filter (not tracked), '均已追踪') as untracked from t group by file)
    select kept.file, seq, title, coalesce(mentioned, '无明确新模型') as mentioned, coalesce(untracked, '') as untracked
    from kept left join l on kept.file = l.file
    """,
)
def mention_run_articles(spark, sf):
    run = run_mentions(*_mention_inputs(spark, sf), 20240103, 20240110, "2024-01-31", BASE_URL)
    return run.articles


@check(
    "articles_in_window",
    f"""with {ARTICLES_SQL} select file, date_int from (select *, row_number() over (partition by body order by file) as rn
      from articles where date_int between 20240105 and 20240118) where rn = 1""",
)
def article_window(spark, sf):
    return articles_in_window(articles(spark, sf), 20240105, 20240118).select("file", "date_int")


@check(
    "review_run",
    f"with {_REVIEWED} select row_id, company, size, note, verification from applied where action <> 'dropped'",
)
def review_run(spark, sf):
    """The catalog after the review; sure removals are gone."""
    run = V.review_run(reviewed_rows(spark, sf), verdicts(spark, sf))
    return run.catalog.select("row_id", "company", "size", "note", "verification")
