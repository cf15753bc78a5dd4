from pyspark.sql import functions as F

from rollcall.checks.base import CATALOG_SQL, catalog, check, table
from rollcall.functions import dates as D
from rollcall.functions import labels as L
from rollcall.functions import text as X


@check(
    "key_forms",
    r"""
    with raw as (
      select p_partkey, chr(9) || ' ' || upper(p_name) || '  ' || p_brand || '-v_1.0 (' || p_type || ') （内测）' || chr(10) as n
      from part)
    select p_partkey,
      lower(regexp_replace(n, '^\s+|\s+$', '', 'g')) as fold,
      regexp_replace(n, '^\s+|\s+$', '', 'g') as exact,
      regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(n, '^\s+|\s+$', '', 'g')),
        '\s*[(（].*?[)）]', '', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') as plain,
      regexp_replace(regexp_replace(lower(n), '[\s_.\-]+', '', 'g'), '[(（].*?[)）]', '', 'g') as loose,
      translate(lower(regexp_replace(n, '^\s+|\s+$', '', 'g')), '-_ ', '') as manual,
      regexp_replace(replace(n, chr(10), ' '), '^\s+|\s+$', '', 'g') as clean
    from raw
    """,
)
def key_forms(spark, sf):
    name = F.concat(
        F.lit("\t "), F.upper("p_name"), F.lit("  "), "p_brand", F.lit("-v_1.0 ("), "p_type", F.lit(") （内测）\n")
    )
    df = table(spark, sf, "part").select("p_partkey", name.alias("n"))
    return df.select(
        "p_partkey", X.fold_key("n").alias("fold"), X.exact_key("n").alias("exact"),
        X.plain_key("n").alias("plain"), X.loose_key("n").alias("loose"),
        X.manual_key("n").alias("manual"), X.clean_name("n").alias("clean"),
    )


_SIZE_SQL = """
  case when p is null or p = 0 then ''
       when p >= 1000000000000 then cast(cast(round_even(p / 1000000000000.0, 0) as bigint) as varchar) || 'T'
       when p >= 1000000000 then cast(cast(round_even(p / 1000000000.0, 0) as bigint) as varchar) || 'B'
       when p >= 1000000 then cast(cast(round_even(p / 1000000.0, 0) as bigint) as varchar) || 'M'
       else cast(p as varchar) end"""


@check(
    "size_labels",
    f"""
    with s as (
      select o_orderkey, case when o_orderpriority = '1-URGENT' then null when o_orderpriority = '2-HIGH' then 0
        when o_orderstatus = 'F' then cast(floor(o_totalprice) as bigint) * 10
        when o_orderstatus = 'O' then cast(floor(o_totalprice) as bigint) * 500000
        else cast(floor(o_totalprice) as bigint) * 50000000 end as p
      from orders)
    select o_orderkey, {_SIZE_SQL} as label, coalesce(nullif({_SIZE_SQL}, ''), '—') as dashed,
      case when p >= 1000000 then {_SIZE_SQL} else '' end as from_million
    from s
    """,
)
def size_labels(spark, sf):
    whole = F.floor("o_totalprice")
    p = (
        F.when(F.col("o_orderpriority") == "1-URGENT", None)
        .when(F.col("o_orderpriority") == "2-HIGH", 0)
        .when(F.col("o_orderstatus") == "F", whole * 10)
        .when(F.col("o_orderstatus") == "O", whole * 500000)
        .otherwise(whole * 50000000)
    )
    df = table(spark, sf, "orders").select("o_orderkey", p.alias("p"))
    return df.select(
        "o_orderkey", L.size_label("p").alias("label"), L.size_or_dash("p").alias("dashed"),
        L.size_from_million("p").alias("from_million"),
    )


@check(
    "region_openness",
    """
    select s_suppkey,
      case when r_name = 'ASIA' or n_name like '%1%' then '国内' else '国外' end as region,
      case when s_acctbal >= 5000 then '开源' when s_acctbal >= 0 then '闭源' else '未知' end as openness,
      case when s_acctbal >= 5000 then s_acctbal >= 7000
           else s_acctbal >= 0 and s_acctbal < 3000 end as is_open
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    """,
)
def region_openness(spark, sf):
    from rollcall.checks.base import geography

    bal = F.col("s_acctbal")
    df = table(spark, sf, "supplier").join(geography(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
    org = F.when(F.col("n_name").contains("1"), F.concat(F.lit("Deep-Seek "), "n_name")).otherwise(F.col("n_name"))
    country = F.when(F.col("r_name") == "ASIA", "cn").otherwise(F.col("r_name"))
    flag = F.when(bal >= 5000, True).when(bal >= 0, False)
    # the key is there for balances from 5000 on, with null below 7000
    record = F.when(
        bal >= 5000, F.create_map(F.lit("is_open_source"), F.when(bal >= 7000, "true"), F.lit("license"), F.lit("mit"))
    ).otherwise(
        F.create_map(F.lit("license"), F.when(bal < 0, "").when(bal < 3000, "mit").otherwise("proprietary"))
    )
    return df.select(
        "s_suppkey", L.region(org, country).alias("region"), L.openness(flag).alias("openness"),
        L.is_open_record(record).alias("is_open"),
    )


@check(
    "type_reasoning",
    """
    select p_partkey,
      case when p_name like '%code%' then '代码' when p_type = 'PROMO' or p_name like '%tts%' then '语音'
           when p_size > 40 then '多模态'
           when p_type = 'LARGE' or p_retailprice >= 1000 then '基座' else '领域' end as type,
      case when p_brand like '%1%' or p_size > 45 then 'thinking' else 'non-thinking' end as reasoning,
      case when p_size > 45 then 'thinking' else 'non-thinking' end as reasoning_words
    from part
    """,
)
def type_reasoning(spark, sf):
    name = F.concat_ws(" ", "p_name", F.when(F.col("p_type") == "PROMO", "Voice"))
    brand_id = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("o"))
    index = F.col("p_size").cast("double") - 5
    params = F.floor(F.col("p_retailprice") * 1_000_000)
    return table(spark, sf, "part").select(
        "p_partkey",
        L.entity_type(
            name, F.lit("x"), L.is_multimodal(F.when(F.col("p_size") > 40, '["text","image"]').otherwise("[]")),
            F.col("p_type") == "LARGE", params,
        ).alias("type"),
        L.reasoning(F.lit("x"), F.when(brand_id.contains("1"), F.concat(F.lit("zo1"), brand_id)), index).alias("reasoning"),
        L.reasoning(F.lit("x"), F.concat(F.lit("zo1"), brand_id), index, word_boundary=True).alias("reasoning_words"),
    )


@check(
    "note_labels",
    """
    select p_partkey, array_to_string(list_filter([
        case when p_type = 'LARGE' then 'MoE架构；' || p_size || 'B参数' end,
        case when p_retailprice >= 1000 then cast(floor(p_retailprice / 10) as bigint) || 'k上下文' end,
        case when p_size > 40 then '统一text+image' end,
        case when p_size >= 45 then '顶级推理能力' when p_size >= 40 then '强推理能力' end,
        case when p_size >= 35 then '顶级编码能力' when p_size >= 25 then '强编码能力' end,
        case when p_size <= 1 then '低成本' when p_size >= 20 then '高端定价' end,
        case when p_type = 'PROMO' then 'Apache 2.0' when p_type = 'SMALL' then 'My Own License' end
      ], lambda x: x is not null), '；') as note
    from part
    """,
)
def note_labels(spark, sf):
    size = F.col("p_size")
    lic = F.when(F.col("p_type") == "PROMO", "apache_2_0").when(F.col("p_type") == "SMALL", "my_own_license").otherwise("proprietary")
    note = L.record_note(
        F.col("p_type") == "LARGE",
        size.cast("bigint") * 1_000_000_000,
        F.col("p_retailprice") * 100,
        F.when(size > 40, F.array(F.lit("text"), F.lit(""), F.lit("image"))),
        size / 50, size * 2.0, size / 2, (size / 2).cast("string"), lic,
    )
    return table(spark, sf, "part").select("p_partkey", note.alias("note"))


@check(
    "score_texts",
    """
    select event_id,
      case when event_type = 'error' then '—' else printf('%.1f%%', user_id * 0.5) end as score,
      case when event_type = 'error' then '—' else cast(cast(round_even(user_id * 0.5, 0) as bigint) as varchar) end as rating,
      case when event_type = 'error' then '—' else printf('%.1f%%', user_id * 0.5) end as win_rate,
      case when event_type = 'error' or user_id = 0 then '—' else printf('$%.2f', user_id * 0.25) end as price,
      case when user_id = 0 then '—' else format('{:,}', user_id * 1000) end as window
    from events
    """,
)
def score_texts(spark, sf):
    x = F.when(F.col("event_type") != "error", F.col("user_id"))
    fraction = F.when(x <= 2, x * 0.005).otherwise(x * 0.5)
    return table(spark, sf, "events").select(
        "event_id", L.score_text(fraction).alias("score"), L.rating_text(x * 0.5).alias("rating"),
        L.win_rate_text(x * 0.5).alias("win_rate"), L.price_text(x * 0.25).alias("price"),
        L.thousands(F.col("user_id") * 1000).alias("window"),
    )


@check(
    "date_forms",
    """
    select o_orderkey,
      case o_orderstatus when 'F' then cast(strftime(o_orderdate, '%Y%m%d') as integer)
        when 'O' then cast(strftime(o_orderdate, '%Y%m%d') as integer)
        else cast(strftime(o_orderdate, '%Y%m') as integer) end as day,
      strftime(o_orderdate, '%Y-%m-%d') as dashed, strftime(o_orderdate, '%Y.%m.%d') as dotted,
      strftime(o_orderdate, '%Y.%m.%d') || ' ~ ' || strftime(o_orderdate, '%Y.%m.%d') as range,
      case when o_orderstatus = 'F' then 0 else cast(strftime(o_orderdate, '%Y%m%d') as integer) end as in_title
    from orders
    """,
)
def date_forms(spark, sf):
    d = F.col("o_orderdate")
    compact = F.date_format(d, "yyyyMMdd")
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, " yyyy/MM/dd'T'HH:mm"))
        .otherwise(F.date_format(d, "yyyy-MM"))
    )
    title = F.when(F.col("o_orderstatus") == "F", "no date 123").otherwise(F.concat(F.lit("news "), compact, F.lit(" 1")))
    return table(spark, sf, "orders").select(
        "o_orderkey", D.date_int(raw).alias("day"), D.dashed(compact).alias("dashed"), D.dotted(compact).alias("dotted"),
        D.range_label(compact, compact).alias("range"), D.title_date(title).alias("in_title"),
    )


@check(
    "title_date",
    """
    select o_orderkey, case when o_orderpriority = '5-LOW' then 0
      else cast(strftime(o_orderdate, '%Y%m%d') as integer) end as date_int
    from orders
    """,
)
def title_date(spark, sf):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    title = F.when(F.col("o_orderpriority") == "5-LOW", "weekly").otherwise(F.concat("o_orderpriority", F.lit(" "), day, F.lit("x")))
    return table(spark, sf, "orders").select("o_orderkey", D.title_date(title).alias("date_int"))


@check(
    "importance_tag",
    """
    select doc_id, case when toxic = 1 then '低' when quality = 1 then '高' else '中' end as level,
      case when toxic = 1 then '' when quality = 1 then 'reason ' || doc_id else '' end as reason,
      'text ' || doc_id as note,
      case when toxic = 1 then 'text ' || doc_id || '[重要性：低]'
        when quality = 1 then 'text ' || doc_id || ' [重要性:高| reason ' || doc_id || ']'
        else 'text ' || doc_id || ' [重要性:中|later]' end as tagged
    from labels
    """,
)
def importance_tag(spark, sf):
    base = F.concat(F.lit("text "), "doc_id")
    note = (
        F.when(F.col("toxic") == 1, F.concat(base, F.lit("[重要性：低]")))
        .when(F.col("quality") == 1, F.concat(base, F.lit(" [重要性:高| reason "), "doc_id", F.lit("]")))
        .otherwise(base)
    )
    df = table(spark, sf, "labels").select("doc_id", note.alias("n"))
    return df.select(
        "doc_id", X.importance_level("n").alias("level"), X.importance_reason("n").alias("reason"),
        X.without_importance("n").alias("note"),
        X.with_importance("n", F.lit("中"), F.lit("later")).alias("tagged"),
    )


@check(
    "product_filter",
    """
    select p_partkey, p_size <= 20 as generic from part
    """,
)
def product_filter(spark, sf):
    size = F.col("p_size")
    name = (
        F.when(size <= 10, " ChatGPT ").when(size <= 20, "Deep Rese")
        .when(size <= 30, F.concat(F.lit("Kimi K"), "p_partkey")).otherwise(F.col("p_name"))
    )
    return table(spark, sf, "part").select("p_partkey", X.is_product_name(name).alias("generic"))


@check(
    "sparse_records",
    f"""
    with {CATALOG_SQL}
    select row_id, '{{"name":"' || name || '"' || coalesce(',"company":"' || company || '"', '')
      || coalesce(',"size":"' || size || '"', '')
      || case when trim(coalesce(note, '')) in ('', 'nan') then '' else ',"note":"' || note || '"' end || '}}' as payload
    from catalog
    """,
)
def sparse_records(spark, sf):
    return catalog(spark, sf).select("row_id", X.sparse_json(["name", "company", "size", "note"]).alias("payload"))


@check(
    "dict_contains",
    r"""
    select doc_id, regexp_matches(text, 'ention|ierung|miento') as any_word,
      regexp_matches(lower(text), '(^|[^\pL\pM\pN_])(the|les|der)([^\pL\pM\pN_]|$)') as whole_word
    from documents
    """,
)
def dict_contains(spark, sf):
    return table(spark, sf, "documents", spread=True).select(
        "doc_id", X.any_contains("text", ["ention", "ierung", "miento"]).alias("any_word"),
        X.any_word(F.lower("text"), ["the", "les", "der"]).alias("whole_word"),
    )


@check(
    "doc_summary",
    r"""
    with s as (select doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)),
        lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 10)[1:3], '；') as s from documents)
    select doc_id, case when length(s) > 150 then substr(s, 1, 150) || '…' else s end as summary from s
    """,
)
def doc_summary(spark, sf):
    return table(spark, sf, "documents", spread=True).select("doc_id", X.summary("text").alias("summary"))


@check(
    "clip_texts",
    """
    select doc_id, case when length(text) > 80 then substr(text, 1, 80) || '...' else text end as short,
      case when length(text) > 8000 then substr(text, 1, 8000) else text end as request
    from documents
    """,
)
def clip_texts(spark, sf):
    return table(spark, sf, "documents", spread=True).select(
        "doc_id", X.clip("text", 80, "...").alias("short"), X.clip("text", 8000, "").alias("request")
    )
