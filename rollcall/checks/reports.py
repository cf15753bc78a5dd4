from pyspark.sql import functions as F

from rollcall.checks.base import CATALOG_SQL, catalog, check, table
from rollcall.functions import dates as D
from rollcall.operators import rank as K
from rollcall.operators import stats as A
from rollcall.plans import reports as P


@check(
    "dim_counts",
    f"""
    with {CATALOG_SQL},
    u as (select 'company' as dim, trim(company) as value, is_new = 'New' as new from catalog
      union all select 'region', region, is_new = 'New' from catalog
      union all select 'openness', openness, is_new = 'New' from catalog
      union all select 'reasoning', reasoning, is_new = 'New' from catalog
      union all select 'type', type, is_new = 'New' from catalog)
    select dim, value, count(*) as n from u where value is not null group by all
    union all select 'new_' || dim, value, count(*) from u where value is not null and new group by all
    """,
)
def dim_counts(spark, sf):
    new = F.coalesce(F.col("is_new") == "New", F.lit(False))
    return A.dim_counts(catalog(spark, sf), ["company", "region", "openness", "reasoning", "type"], new)


@check(
    "org_stats",
    """
    with s as (select c_mktsegment as organization, count(*) as total, count(*) filter (o_orderstatus = 'O') as open,
      count(*) filter (o_orderdate >= timestamp '2001-03-01') as recent from orders join customer on o_custkey = c_custkey group by 1)
    select row_number() over (order by total desc, organization) as rank, * from s order by total desc, organization limit 25
    """,
)
def org_stats(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    recent = D.recent(F.date_format("o_orderdate", "yyyy-MM-dd"), "2001-06-01", 3)
    stats = A.org_stats(
        rows.withColumnRenamed("c_mktsegment", "organization"), "organization", F.col("o_orderstatus") == "O", recent
    )
    return K.top_n(stats, [F.col("total").desc(), F.col("organization")], 25)


@check(
    "org_categories",
    """select user_id, count(*) as total, string_agg(distinct event_type, ', ' order by event_type) as categories from events group by user_id""",
)
def org_categories(spark, sf):
    rows = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_type")
    done = A.org_categories(rows, "user_id", "event_type")
    return done.withColumn("user_id", F.col("user_id").cast("bigint"))


@check(
    "kpis",
    f"""
    with {CATALOG_SQL}
    select count(*) as total, count(*) filter (is_new = 'New') as new, round(count(*) filter (is_new = 'New') / count(*) * 100, 6) as new_pct,
      count(*) filter (region = '国内') as domestic, count(*) - count(*) filter (region = '国内') as foreign,
      count(*) filter (openness = '开源') as open, count(*) filter (openness = '闭源') as closed from catalog
    """,
)
def kpis(spark, sf):
    return A.kpis(catalog(spark, sf), new=F.col("is_new") == "New").withColumn("new_pct", F.round("new_pct", 6))


@check("source_counts", "select source, count(*) as n from documents group by source")
def source_counts(spark, sf):
    return A.source_counts(table(spark, sf, "documents", spread=True), "source")


def arena(spark, sf):
    """All events as arena entries: the type is the category, the first day digit the subcategory."""
    played = F.when(F.col("event_type") != "error", F.col("user_id"))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("pos"),
        F.col("event_type").alias("category"),
        F.date_format("ts", "E").alias("subcategory"),
        F.concat(F.lit("e"), "event_id").alias("model_id"),
        F.when(F.col("value") > 1, F.concat(F.lit("Model "), "event_id")).alias("model_name"),
        F.concat(F.lit("org"), "user_id").alias("organization"),
        F.when(F.col("value") > 2, F.col("event_id") / 2).alias("conservative_rating"),
        played.alias("matches_played"),
        (F.col("user_id") * 0.5).alias("win_rate"),
        (F.col("user_id") * 0.25).alias("avg_generation_price"),
        (F.col("value") > 10).alias("is_open_source"),
    )


ARENA_SQL = """
arena as (
  select event_id as pos, event_type as category, strftime(ts, '%a') as subcategory, 'e' || event_id as model_id,
    case when value > 1 then 'Model ' || event_id end as model_name, 'org' || user_id as organization,
    case when value > 2 then event_id / 2 end as rating, case when event_type <> 'error' then user_id end as matches,
    user_id * 0.5 as win_rate, user_id * 0.25 as price, value > 10 as open
  from events)"""


@check(
    "arena_activity",
    f"""with {ARENA_SQL} select category, subcategory, count(*) as total, count(*) filter (coalesce(matches, 0) > 0) as active,
      count(*) filter (coalesce(matches, 0) <= 0) as inactive from arena group by all""",
)
def arena_activity(spark, sf):
    return A.arena_activity(arena(spark, sf))


@check(
    "digest_groups",
    f"with {CATALOG_SQL} select coalesce(company, '未知') as company, count(*) as n from catalog group by 1",
)
def digest_groups(spark, sf):
    return A.digest_groups(catalog(spark, sf))


def flat(tables):
    """Metrics as text, ordered by name, so that any engine can compare them."""
    pairs = F.transform(
        F.array_sort(F.map_entries("metrics")),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))),
    )
    return tables.select("section", "rank", "key", F.array_join(pairs, "; ").alias("metrics"))


@check(
    "arena_tables",
    f"""
    with {ARENA_SQL},
    s as (select category, subcategory, count(*) as total, count(*) filter (coalesce(matches, 0) > 0) as active from arena group by all),
    r as (select *, row_number() over (partition by category, subcategory order by coalesce(rating, 0) desc, pos) as rn from arena where coalesce(matches, 0) > 0),
    o as (select organization, count(*) as total, string_agg(distinct category, ', ' order by category) as cats, min(pos) as f from arena group by 1),
    t as (select *, row_number() over (order by total desc, f) as rn from o)
    select 'overview' as section, cast(null as bigint) as rank, category || '/' || subcategory as key,
      'active=' || active || '; inactive=' || (total - active) || '; more=' || greatest(active - 30, 0) || '; total=' || total as metrics from s
    union all
    select 'top/' || category || '/' || subcategory, rn, coalesce(model_name, model_id),
      'matches=' || matches || '; open=' || open || '; organization=' || organization || '; price=' || printf('$%.2f', price)
      || '; rating=' || coalesce(cast(cast(round_even(rating, 0) as bigint) as varchar), '—') || '; win_rate=' || printf('%.1f%%', win_rate)
    from r where rn <= 30
    union all
    select 'organizations', rn, organization, 'categories=' || cats || '; total=' || total from t where rn <= 20
    """,
)
def arena_tables(spark, sf):
    return flat(P.arena_tables(arena(spark, sf)))


def records(spark, sf):
    """All parts as open leaderboard records of two sources, as they are read from pages.

    The first source holds every third part twice; only the later record counts.
    The second one has the open flag of all types but one.
    """
    size, price, key = F.col("p_size"), F.col("p_retailprice"), F.col("p_partkey").cast("string")
    fields = {
        "name": F.concat_ws(" ", "p_name", "p_partkey"),
        "organization": F.col("p_brand"),
        "params": F.when(size > 5, size.cast("bigint") * 1_000_000_000),
        "announcement_date": F.when(size > 10, F.concat(F.lit("2024-0"), F.floor(size / 8 + 1).cast("string"), F.lit("-15"))),
        "release_date": F.when(size <= 5, "2024-06-30").when(size <= 8, "bad"),
        "gpqa_score": F.when(F.col("p_type") != "SMALL", (size * 4) / 256),
        "swe_bench_verified_score": F.when(size > 20, size / 64),
        "hle_score": price.cast("bigint") % 100 / 1.0,
        "context": F.when(size > 30, price.cast("bigint") * 100),
        "input_price": size / 4,
        "license": F.when(F.col("p_type") == "PROMO", "mit"),
        "is_moe": F.when(size > 40, "true").when(size > 35, "false"),
    }
    pairs = lambda kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v.cast("string"))])
    part = table(spark, sf, "part", spread=True)
    row = lambda df, prio, step, kv: df.select(
        F.lit(prio).alias("_prio"), (F.col("p_partkey") * 10 + step).alias("pos"), pairs({"model_id": key} | kv).alias("record")
    )
    full = row(part, 0, 1, fields)
    early = row(part.filter("p_size % 3 = 0"), 0, 0, {"name": F.lit("old"), "aime_2025_score": F.lit("0.5"), "license": F.lit("mit")})
    flags = row(
        part.filter("p_type <> 'PROMO'"), 1, 2,
        {"is_open_source": F.when(F.col("p_type") != "LARGE", "true").otherwise("false"), "name": F.lit("other name")},
    )
    return P.leaderboard_records(full.unionByName(early).unionByName(flags), ["llm", "ai"])


@check(
    "leaderboard_tables",
    """
    with r as (
      select p_partkey as pos, p_name || ' ' || p_partkey as name, p_brand as org, p_size as s, p_type,
        case when p_size > 5 then p_size || 'B' else '—' end as params,
        case when p_size > 10 then '2024-0' || cast(floor(p_size / 8 + 1) as bigint) || '-15' when p_size <= 5 then '2024-06-30' when p_size <= 8 then 'bad' else '' end as day,
        case when p_type <> 'SMALL' then p_size * 4 / 256 end as gpqa, case when p_size > 20 then p_size / 64 end as swe,
        cast(floor(p_retailprice) as bigint) % 100 / 1.0 as hle, case when p_size > 30 then cast(floor(p_retailprice) as bigint) * 100 end as context,
        case when p_type = 'PROMO' then 'mit' end as license, p_type <> 'LARGE' as open
      from part),
    q as (select count(*) as n, count(*) + count(*) filter (p_size % 3 = 0) as held, count(*) filter (p_type <> 'PROMO') as flags, count(*) filter (p_size > 35) as moe,
      count(*) filter (p_type <> 'LARGE') as opened from part),
    x as (select *, day <> 'bad' and day >= '2024-03-30' as recent,
      coalesce(printf('%.1f%%', round_even(gpqa * 100, 1)), '—') as g, coalesce(printf('%.1f%%', round_even(swe * 100, 1)), '—') as w,
      case when hle <= 1 then printf('%.1f%%', hle * 100) else printf('%.1f%%', hle) end as h from r),
    o as (select org, count(*) as total, count(*) filter (open) as open, count(*) filter (recent) as recent, min(pos) as f from x group by org)
    select 'recent' as section, row_number() over (order by day desc, pos) as rank, name as key,
      'aime_2025_score=—; context=' || coalesce(format('{:,}', context), '—') || '; date=' || day || '; gpqa_score=' || g || '; hle_score=' || h
      || '; input_price=$' || (s / 4) || '; open=' || open || '; organization=' || org || '; output_price=—; params=' || params || '; swe_bench_verified_score=' || w as metrics
    from x where recent
    union all
    select * from (select 'open_top', row_number() over (order by gpqa desc, pos) as rn, name, 'aime_2025_score=—; gpqa_score=' || g || '; hle_score=' || h || '; license=' || coalesce(license, '—') || '; moe=' || (s > 40)
      || '; organization=' || org || '; params=' || params || '; swe_bench_verified_score=' || w from x where open and coalesce(gpqa, 0) <> 0) where rn <= 20
    union all
    select * from (select 'organizations', row_number() over (order by total desc, f) as rn, org, 'open=' || open || '; recent=' || recent || '; total=' || total from o) where rn <= 25
    union all
    select 'coverage', null, f, 'filled=' || n || '; pct=' || cast(round_even(n / t * 100, 0) as bigint) from (
      select count(*) as t, [{'f': 'gpqa_score', 'n': count(gpqa)}, {'f': 'swe_bench_verified_score', 'n': count(swe)}, {'f': 'hle_score', 'n': count(hle)},
        {'f': 'aime_2025_score', 'n': 0}, {'f': 'params', 'n': count(*) filter (s > 5)}, {'f': 'context', 'n': count(context)}, {'f': 'input_price', 'n': count(s)},
        {'f': 'license', 'n': count(license)}, {'f': 'is_moe', 'n': count(*) filter (s > 35)}, {'f': 'multimodal', 'n': 0}] as l from x), unnest(l) u(z), lateral (select z.f as f, z.n as n) zz
    union all select 'open_total', null, 'all', 'n=' || opened || '; total=' || n from q
    union all select 'sources', null, 'llm', 'records=' || held from q
    union all select 'sources', null, 'ai', 'records=' || flags from q
    """,
)
def leaderboard_tables(spark, sf):
    return flat(P.leaderboard_tables(records(spark, sf), "2024-06-30", 3))


@check(
    "update_tables",
    f"""
    with {CATALOG_SQL},
    u as (select 'company' as dim, company as value, row_id, is_new from catalog union all select 'type', type, row_id, is_new from catalog
      union all select 'region', region, row_id, is_new from catalog union all select 'openness', openness, row_id, is_new from catalog
      union all select 'reasoning', reasoning, row_id, is_new from catalog
      union all select 'new_company', company, row_id, is_new from catalog where is_new = 'New'
      union all select 'new_type', type, row_id, is_new from catalog where is_new = 'New'),
    c as (select dim, value, count(*) as n, min(row_id) as f from u where value is not null group by all),
    m as (select *, max(n) over (partition by dim) as top, row_number() over (partition by dim order by n desc, f) as rn from c),
    cov as (
      select 'name' as field, count(name) as filled from catalog union all select 'company', count(company) from catalog
      union all select 'region', count(region) from catalog union all select 'openness', count(openness) from catalog
      union all select 'size', count(size) from catalog union all select 'type', count(type) from catalog
      union all select 'reasoning', count(reasoning) from catalog union all select 'task_type', count(task_type) from catalog
      union all select 'website', count(website) from catalog union all select 'note', count(note) from catalog)
    select dim as section, case when dim in ('company', 'new_company') then rn end as rank, value as key,
      'bar=' || cast(floor(n / top * 30) as bigint) || '; n=' || n as metrics
    from m where dim not in ('company', 'new_company') or rn <= case dim when 'company' then 15 else 10 end
    union all
    select 'coverage', null, field, 'filled=' || filled || '; grade=' || case when filled / t * 100 >= 90 then 'ok' when filled / t * 100 >= 50 then 'warn' else 'fail' end || '; total=' || t
    from cov, (select count(*) as t from catalog)
    union all
    select 'overview', null, 'all', 'new=' || count(*) filter (is_new = 'New') || '; new_pct=' || printf('%.1f', round_even(count(*) filter (is_new = 'New') / count(*) * 100, 1)) || '; total=' || count(*) from catalog
    union all select 'overview', null, 'before', 'total=' || count(*) from customer where c_acctbal < 8000
    """,
)
def update_tables(spark, sf):
    rows = catalog(spark, sf)
    return flat(P.update_tables(rows, rows.filter("balance < 8000")))


@check(
    "digest_rows",
    f"""
    with {CATALOG_SQL},
    r as (select *, case when trim(coalesce(note, '')) = 'nan' then '' else trim(coalesce(note, '')) end as n,
        case when type like '%1' then '高' when type like '%2' then '低' else '中' end as level
      from catalog where released_at between '2024-01-05' and '2024-01-20'),
    t as (select *, lower(trim(coalesce(is_new, ''))) in ('new', '是') as fresh, case when level = '高' then 'why ' || type when n = '' then '' else n end as why from r),
    g as (select coalesce(company, '未知') as label, count(*) as size_of from r group by 1)
    select 'overview' as section, cast(null as bigint) as rank, 'all' as key, 'closed=' || count(*) filter (openness = '闭源') || '; domestic=' || count(*) filter (region = '国内')
      || '; foreign=' || (count(*) - count(*) filter (region = '国内')) || '; new=' || count(*) filter (fresh) || '; open=' || count(*) filter (openness = '开源') || '; total=' || count(*) as metrics from t
    union all
    select 'new_' || case level when '高' then 'high' when '低' then 'low' else 'medium' end, null, name,
      'company=' || coalesce(company, '') || '; reason=' || case when level = '低' then '' else why end || '; tags=' || concat_ws(' · ', type, size) from t where fresh
    union all
    select 'company', null, label, 'group_size=' || size_of || '; info=' || concat_ws(' · ', type, size, openness) || '; name=' || name || '; note=' || n
    from t join g on coalesce(t.company, '未知') = g.label
    """,
)
def digest_rows(spark, sf):
    rows = catalog(spark, sf)
    plain = F.coalesce(F.nullif(F.trim("note"), F.lit("nan")), F.lit(""))
    tag = F.when(F.col("type").endswith("1"), F.concat(F.lit(" [重要性:高|why "), "type", F.lit("]"))).when(F.col("type").endswith("2"), " [重要性:低]").otherwise("")
    return flat(P.digest_rows(rows.withColumn("note", F.concat(plain, tag)), 20240105, 20240120))


@check(
    "acceptance_tables",
    f"""
    with {CATALOG_SQL}, n as (select * from catalog where balance >= 0), o as (select * from catalog where balance < 8000),
    d as (select count(*) filter (balance >= 0) as new_total, count(*) filter (balance < 8000) as old_total, count(*) filter (balance >= 8000) as added,
      count(*) filter (balance >= 0 and balance < 8000) as kept, count(*) filter (balance < 0) as missing from catalog),
    cov as (
      select 'name' as field, count(*) filter (trim(coalesce(name, '')) <> '') as filled, count(*) filter (trim(coalesce(name, '')) not in ('', 'nan')) as good from n
      union all select 'company', count(*) filter (trim(coalesce(company, '')) <> ''), count(*) filter (trim(coalesce(company, '')) not in ('', 'nan')) from n
      union all select 'note', count(*) filter (trim(coalesce(note, '')) <> ''), count(*) filter (trim(coalesce(note, '')) not in ('', 'nan')) from n
      union all select 'released_at', count(*) filter (trim(coalesce(released_at, '')) <> ''), count(*) filter (trim(coalesce(released_at, '')) not in ('', 'nan')) from n
      union all select 'is_new', count(*) filter (trim(coalesce(is_new, '')) <> ''), 0 from n),
    c as (select count(*) as t from n)
    select 'diff' as section, cast(null as bigint) as rank, 'all' as key, 'added=' || added || '; kept=' || kept || '; missing=' || missing || '; new_total=' || new_total || '; old_total=' || old_total as metrics from d
    union all select 'rows', null, 'before', 'n=' || count(*) from o
    union all select 'rows', null, 'after', 'columns=5; n=' || count(*) from n
    union all select 'coverage', null, field, 'filled=' || filled || '; pct=' || cast(floor(filled * 100 / t) as bigint) from cov, c
    union all select 'required', null, field, 'filled=' || good || '; grade=' || case when good = t then 'ok' when good / t >= 0.8 then 'warn' else 'fail' end from cov, c where field in ('company', 'note', 'released_at')
    union all select 'check', null, 'updated_not_empty', 'passed=' || (new_total > 0) || '; value=' || new_total from d
    union all select 'check', null, 'names_grew', 'passed=' || (new_total > old_total) || '; value=' || (new_total - old_total) from d
    union all select 'check', null, 'nothing_missing', 'passed=' || (missing = 0) || '; value=' || missing from d
    """,
)
def acceptance_tables(spark, sf):
    rows = catalog(spark, sf)
    keep = ["name", "company", "note", "released_at", "is_new"]
    return flat(P.acceptance_tables(rows.filter("balance >= 0").select(keep), rows.filter("balance < 8000").select(keep)))
