from pyspark.sql import functions as F

from rollcall.checks.base import check, names_in, table
from rollcall.operators import extract as X
from rollcall.operators import rawtext as R
from rollcall.operators.stats import mention_lists as lists


def _script(*parts):
    """A page script that pushes the given text, quotes escaped as pages have them."""
    text = F.concat(*parts)
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('<script>self.__next_f.push([1,"'), escaped, F.lit('"])</script>'))


@check(
    "embedded_payload",
    r"""
    with host as (select page_id, url, regexp_extract(url, 'https?://([^/]+)/', 1) as host from pages)
    select page_id, cast(0 as bigint) as pos, 'p' || page_id as model_id, 'a ] of "' || host || '"' as name, url from host
    union all
    select page_id, 1, 'q' || page_id, host, null from host
    """,
)
def embedded_payload(spark, sf):
    """Whole pages with an array pushed in two chunks after a second, less wanted one."""
    host = F.regexp_extract("url", "https?://([^/]+)/", 1)
    first = [
        F.lit('1:{"recentUpdates":[{"model_id":"no"}],"initialData":[{"model_id":"p'), F.col("page_id"),
        F.lit('","name":"a ] of \\"'), host, F.lit('\\"","url":"'), F.col("url"), F.lit('"},{"model'),
    ]
    second = [F.lit('_id":"q'), F.col("page_id"), F.lit('","name":"'), host, F.lit('"}],"more":[1]}')]
    html = F.concat("html", _script(*first), F.lit("<p>"), _script(*second), F.lit("</body>"))
    pages = table(spark, sf, "pages", spread=True).withColumn("full", html)
    r = F.col("record")
    return X.extract_embedded(pages, "page_id", "full").select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), r["model_id"].alias("model_id"),
        r["name"].alias("name"), r["url"].alias("url"),
    )


@check(
    "payload_recovery",
    """
    select event_id, 'a' || event_id as model_id, regexp_extract(props, '"k": ([0-9]+)', 1) as k from events
    where event_type <> 'error'
    union all
    select event_id, 'b' || event_id, event_type from events where event_type in ('view', 'click')
    """,
)
def payload_recovery(spark, sf):
    """Arrays broken in the middle or cut short; the readable objects come back."""
    props = F.regexp_replace("props", r"[{}\s]", "")
    a = F.concat(F.lit('{"model_id":"a'), F.col("event_id"), F.lit('",'), props, F.lit("}"))
    b = F.concat(F.lit('{"model_id":"b'), F.col("event_id"), F.lit('","k":"'), F.col("event_type"), F.lit('"}'))
    outside = F.lit('],"other":[{"model_id":"z","k":1}]')
    kind = F.col("event_type")
    array = (
        F.when(kind == "error", F.lit("[oops"))
        .when(kind == "view", F.concat(F.lit("["), a, F.lit(",{oops},"), b, outside))
        .when(kind == "click", F.concat(F.lit("["), a, F.lit(",,"), b))
        .otherwise(F.concat(F.lit("["), a, F.lit(",{oops}"), outside))
    )
    html = _script(F.lit('{"initialData":'), array)
    pages = table(spark, sf, "events", spread=True).select("event_id", html.alias("html"))
    r = F.col("record")
    return X.extract_embedded(pages, "event_id").select(
        "event_id", r["model_id"].alias("model_id"), r["k"].alias("k")
    )


def _replies(spark, sf):
    """One reply per turn: its text around an array, the name under varying keys."""
    talk = table(spark, sf, "conversations", spread=True)
    key = F.when(F.col("role") == "user", "name").when(F.col("role") == "system", "modelName").otherwise("model_name")
    item = F.concat(
        F.lit('{"'), key, F.lit('": "'), F.col("role"), F.lit(" "), F.col("turn"), F.lit('", "size": "'),
        F.col("turn"), F.lit('B"}'),
    )
    content = F.concat(
        F.lit("Here it is: ["), item, F.lit(', "noise", 7, {"company": "nameless"}, {"name": "conv '), "conv_id",
        F.lit('"}]\n'), F.translate("text", "[]", "()"),
    )
    message = F.struct(F.struct(content.alias("content")).alias("message"))
    response = (
        F.when(F.col("role") == "user", F.to_json(F.struct(F.array(message).alias("choices"))))
        .when(F.col("role") == "system", F.to_json(F.struct(F.struct(content.alias("text")).alias("output"))))
        .otherwise(F.to_json(F.struct(F.lit(None).cast("string").alias("id"), F.array(F.struct(content.alias("text"))).alias("choices"))))
    )
    return talk.select("conv_id", "turn", "role", response.alias("response"))


@check(
    "reply_ingest",
    """
    select conv_id, turn, cast(0 as bigint) as pos, role || ' ' || turn as model_name, turn || 'B' as size from conversations
    union all select conv_id, turn, 2, 'conv ' || conv_id, '' from conversations
    """,
)
def reply_ingest(spark, sf):
    rows = _replies(spark, sf).select("conv_id", "turn", X.reply_content("response").alias("content"))
    found = X.ingest_replies(rows, ["conv_id", "turn"], "content")
    return found.select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "model_name", "size")


@check(
    "reply_lookalikes",
    """
    select conv_id, turn, cast(0 as bigint) as pos, role || ' ' || turn as model_name, turn || 'B' as size from conversations
    union all select conv_id, turn, 1, 'after', '{"model_name":"in"}' from conversations
    """,
)
def reply_lookalikes(spark, sf):
    """Texts that look like objects beside objects that repeat a key."""
    content = F.concat(
        F.lit('Found: ["{\\"model_name\\":\\"ghost\\"}", {"model_name":"first","size":"0B","model_name":"'),
        "role", F.lit(" "), "turn", F.lit('","size":"'), "turn",
        F.lit('B"}, ["{"], "{}", {"name":"other","model_name":"after","size":"{\\"model_name\\":\\"in\\"}"}] done'),
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", content.alias("content"))
    found = X.ingest_replies(rows, ["conv_id", "turn"], "content")
    return found.select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "model_name", "size")


@check(
    "mention_lists",
    r"""
    with m as (
      select doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{4,}')) as name,
        generate_subscripts(regexp_extract_all(text, '[A-Z][a-z]{4,}'), 1) as pos
      from documents),
    flagged as (select *, length(name) > 8 as tracked from m),
    lists as (
      select doc_id, string_agg(name, chr(10) order by pos) as mentioned,
        coalesce(string_agg(name, chr(10) order by pos) filter (not tracked), '均已追踪') as untracked
      from flagged group by doc_id)
    select d.doc_id, coalesce(l.mentioned, '无明确新模型') as mentioned,
      case when l.doc_id is null then '' else l.untracked end as untracked
    from documents d left join lists l on d.doc_id = l.doc_id
    """,
)
def mention_lists(spark, sf):
    docs = table(spark, sf, "documents", spread=True).select("doc_id", "text")
    m = docs.select("doc_id", F.posexplode(names_in("text")).alias("pos", "model_name")).withColumn(
        "tracked", F.length("model_name") > 8
    )
    return lists(docs.select("doc_id"), m, "doc_id")


@check(
    "rank_blocks",
    """
    select p_partkey, cast(0 as bigint) as line, cast(p_size as bigint) as rank, p_name as model, p_brand as company,
      p_type as code_arena, cast(p_size as varchar) as chat_arena, case when p_size > 25 then '' else '—' end as gpqa,
      case when p_size > 25 then 'x' else '—' end as swe_bench, 'Proprietary (' || p_type || ')' as license
    from part
    union all
    select p_partkey, 8, cast(p_partkey as bigint), upper(p_name), p_brand, '12', '—', '—', '—', '' from part
    """,
)
def rank_blocks(spark, sf):
    """Two blocks per file; the data line of the second is a bare number."""
    data = F.concat_ws("\t", "p_type", F.col("p_size").cast("string"))
    data = F.when(F.col("p_size") > 25, F.concat(data, F.lit("\t\tx"))).otherwise(data)
    text = F.concat_ws(
        "\n", F.col("p_size").cast("string"), "p_brand", F.concat(F.lit(" "), "p_name"), "p_brand", data, F.lit("per month"),
        F.concat(F.lit(" Proprietary ("), "p_type", F.lit(")")), F.lit("end"),
        F.col("p_partkey").cast("string"), "p_brand", F.upper("p_name"), "p_brand", F.lit("12"), F.lit("end"),
    )
    files = table(spark, sf, "part", spread=True).select("p_partkey", text.alias("text"))
    return R.parse_rank_blocks(files, "seven", "p_partkey").select(
        "p_partkey", F.col("line").cast("bigint").alias("line"), "rank", "model", "company", "code_arena", "chat_arena",
        "gpqa", "swe_bench", "license",
    )


@check(
    "rank_blocks_short",
    """
    select 'three' as layout, p_partkey, p_name as model, p_type as score, cast(p_size as varchar) as second, 'Open Source' as license from part
    union all select 'two', p_partkey, p_name, p_type, cast(p_size as varchar), 'Open Source' from part
    """,
)
def rank_blocks_short(spark, sf):
    text = F.concat_ws(
        "\n", F.lit("Rank\tModel"), F.lit("1"), "p_brand", "p_name", "p_brand",
        F.concat_ws("\t", "p_type", F.col("p_size").cast("string")), F.lit("Open Source"),
    )
    files = table(spark, sf, "part", spread=True).select("p_partkey", text.alias("text"))
    three = R.parse_rank_blocks(files, "three", "p_partkey").select(
        F.lit("three").alias("layout"), "p_partkey", "model", F.col("image_gen").alias("score"),
        F.col("image_edit").alias("second"), "license",
    )
    two = R.parse_rank_blocks(files, "two", "p_partkey").select(
        F.lit("two").alias("layout"), "p_partkey", "model", "score", F.col("price").alias("second"), "license",
    )
    return three.unionByName(two)


@check(
    "logo_blocks",
    """
    select c_custkey, c_name as model,
      case c_mktsegment when 'BUILDING' then '美国' when 'MACHINERY' then '中国' else '' end as country,
      case when c_acctbal < 0 then 'Closed' else 'Open' end as license, '128.5k' as context,
      '$' || c_nationkey as input_price, case when c_acctbal < 5000 then '' else '$9' end as output_price,
      '55 c/s' as speed, '1234' as code_arena, '1%' as gpqa, '2%' as aime, '3%' as swe_bench,
      case when c_acctbal < 5000 then '' else '5%' end as mmmlu, (c_nationkey + 1) || '.5' as params,
      'Apr. 2025' as released, c_mktsegment as company
    from customer
    union all
    select c_custkey, 'second ' || c_name, '', 'Closed', '', '', '', '', '', '', '', '', '', '', '', '' from customer
    """,
)
def logo_blocks(spark, sf):
    """Two blocks per file; the second has nothing but its name and licence."""
    rich = F.col("c_acctbal") >= 5000
    flag = F.when(F.col("c_mktsegment") == "BUILDING", "🇺🇸").when(F.col("c_mktsegment") == "MACHINERY", "🇨🇳").otherwise("")
    scores = F.when(rich, "1%\t2%\t3%\t4%\t5%").otherwise("1%\t2%\t3%")
    prices = F.concat(F.lit("$"), F.col("c_nationkey"), F.when(rich, "\t$9").otherwise(""))
    text = F.concat_ws(
        "\n", F.lit("Model"), F.concat("c_mktsegment", F.lit(" logo")), F.col("c_name"),
        F.concat(flag, F.lit("\t"), F.when(F.col("c_acctbal") < 0, "Closed").otherwise("Open"), F.lit("\t128.5k\t1234")),
        F.concat(prices, F.lit("\t55 c/s")), F.concat(scores, F.lit("\t"), F.col("c_nationkey") + 1, F.lit(".5")),
        F.lit("Apr. 2025"), F.col("c_mktsegment"),
        F.lit("x logo"), F.concat(F.lit("second "), "c_name"), F.lit("Closed"),
    )
    files = table(spark, sf, "customer", spread=True).select("c_custkey", text.alias("text"))
    return R.parse_logo_blocks(files, "c_custkey").drop("line")


@check(
    "timeline_fill",
    """
    select o_orderkey, strftime(o_orderdate, '%b %-d, %Y') as date, 'model ' || o_orderkey as model,
      o_orderpriority as company, 'Release' as release_type,
      case when o_orderstatus = 'P' then '' else 'Proprietary' end as license,
      case when o_orderstatus = 'F' then '0.75' else '' end as gpqa from orders
    union all
    select o_orderkey, strftime(o_orderdate, '%b %-d, %Y'), 'next ' || o_orderkey, o_orderstatus, 'Turbo', 'Open Source', '' from orders
    union all
    select o_orderkey, 'Jan 1, 1990', 'last ' || o_orderkey, 'Old Co', 'Mini', 'Open Source', '88.5' from orders
    """,
)
def timeline_fill(spark, sf):
    """Three blocks under two dates; the score line of the first one is optional."""
    day = F.date_format("o_orderdate", "MMM d, yyyy")
    key = F.col("o_orderkey").cast("string")
    score = F.when(F.col("o_orderstatus") == "F", "GPQA: 0.75")
    lic = F.when(F.col("o_orderstatus") == "P", "Some terms").otherwise("Proprietary")
    block = lambda company, model, kind, licence: [company, model, F.lit(kind), licence, company, F.lit("•"), F.lit("2w ago")]
    text = F.concat_ws(
        "\n", F.lit("Version Timeline"), F.lit("OldOld"), day, F.lit("· 2 releases"),
        *block(F.col("o_orderpriority"), F.concat(F.lit("model "), key), "Release", lic), score,
        *block(F.col("o_orderstatus"), F.concat(F.lit("next "), key), "Turbo", F.lit("Open Source")),
        F.lit("Jan 1, 1990"), F.lit("· 1 release"),
        *block(F.lit("Old Co"), F.concat(F.lit("last "), key), "Mini", F.lit("Open Source")), F.lit("GPQA: 88.5"),
    )
    files = table(spark, sf, "orders", spread=True).select("o_orderkey", text.alias("text"))
    return R.parse_timeline(files, "o_orderkey").drop("line")


_HEADS = {
    "en": "Code Arena\nChat Arena\n1\n",
    "fr": "Rank\tModel TTS\n1\n",
    "de": "Version Timeline\n",
    "es": "logo\nReleased\n",
}


@check(
    "classify_docs",
    r"""
    select doc_id, case when source in ('src1', 'src2') then case lang when 'fr' then 'video' when 'de' then 'timeline' when 'es' then 'logo' end
      else case lang when 'en' then 'code_chat' when 'fr' then 'tts' when 'de' then 'timeline' when 'es' then 'logo' end end as kind
    from documents
    """,
)
def classify_docs(spark, sf):
    """Whole documents behind a head by language; two sources lack the rank line or the vendor."""
    lang = F.col("lang")
    head = F.when(lang == "en", _HEADS["en"]).when(lang == "fr", _HEADS["fr"]).when(lang == "de", _HEADS["de"]).otherwise(_HEADS["es"])
    plain = F.col("source").isin("src1", "src2")
    head = F.when(plain & (lang == "en"), "Code Arena\nChat Arena\n").when(~plain & (lang == "fr"), F.concat(head, F.lit("Deepgram "))).otherwise(head)
    files = table(spark, sf, "documents", spread=True).select("doc_id", F.concat(head, F.col("text")).alias("text"))
    return R.classify_raw(files).select("doc_id", "kind")


@check(
    "mine_lines",
    r"""
    with l as (
      select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')),
        lambda x: length(x) > 2 and length(x) < 50 and not regexp_matches(x, '^\d+$')
          and not regexp_matches(x, 'logo|!\[|http') and not regexp_matches(x, 'Rank|Model|Organization')
          and length(x) - length(replace(x, '%', '')) <= 2 and length(x) - length(replace(x, '$', '')) <= 2
          and length(x) - length(replace(x, chr(9), '')) <= 3 and not starts_with(x, '-')) as n
      from documents)
    select doc_id, array_to_string(n[1:30], chr(10)) as names, cast(len(n) as bigint) as total from l where len(n) > 0
    """,
)
def mine_lines(spark, sf):
    found = R.mine_names(table(spark, sf, "documents", spread=True), "doc_id")
    return found.select("doc_id", F.array_join("names", "\n").alias("names"), "total")


_RAW_NAMES = """list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')),
        lambda x: length(x) > 2 and length(x) < 50 and not regexp_matches(x, '^\\d+$')
          and not regexp_matches(x, 'logo|!\\[|http') and not regexp_matches(x, 'Rank|Model|Organization')
          and length(x) - length(replace(x, '%', '')) <= 2 and length(x) - length(replace(x, '$', '')) <= 2
          and length(x) - length(replace(x, chr(9), '')) <= 3 and not starts_with(x, '-'))"""


@check(
    "rawtext_run",
    f"""
    with n as (select doc_id, {_RAW_NAMES} as names from documents)
    select 'part' || p_partkey as file, 'code_chat' as kind, cast(2 as bigint) as line, p_name as model, p_brand as company,
      cast(null as varchar) as date, p_type as code_arena, 'Open Source' as license, cast(null as varchar) as mined from part
    union all
    select 'order' || o_orderkey, 'timeline', 2, 'model ' || o_orderkey, o_orderpriority, 'Jan 1, 1990', null, 'Proprietary', null from orders
    union all
    select 'customer' || c_custkey, 'logo', 1, c_name, c_mktsegment, null, '', 'Open', null from customer
    union all
    select 'doc' || doc_id, 'mined', null, null, null, null, null, null, array_to_string(names[1:30], chr(10)) from n where len(names) > 0
    """,
)
def rawtext_run(spark, sf):
    """Files of three classes, the logo block of fifteen lines, and plain documents."""
    part = table(spark, sf, "part").select(
        F.concat(F.lit("part"), "p_partkey").alias("file"),
        F.concat_ws("\n", F.lit("Code Arena"), F.lit("Chat Arena"), F.lit("1"), "p_brand", "p_name", "p_brand",
                    F.concat("p_type", F.lit("\t9")), F.lit("Open Source")).alias("text"),
    )
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("order"), "o_orderkey").alias("file"),
        F.concat_ws("\n", F.lit("Version Timeline"), F.lit("Jan 1, 1990"), "o_orderpriority", F.concat(F.lit("model "), "o_orderkey"),
                    F.lit("Release"), F.lit("Proprietary"), "o_orderpriority", F.lit("•"), F.lit("2w ago")).alias("text"),
    )
    customers = table(spark, sf, "customer").select(
        F.concat(F.lit("customer"), "c_custkey").alias("file"),
        F.concat_ws("\n", F.lit("Organization"), F.lit("x logo"), "c_name", F.lit("Open"), *[F.lit(f"{i}%") for i in range(1, 12)],
                    F.lit("Apr. 2025"), "c_mktsegment").alias("text"),
    )
    docs = table(spark, sf, "documents").select(F.concat(F.lit("doc"), "doc_id").alias("file"), "text")
    files = part.unionByName(orders).unionByName(customers).unionByName(docs)
    return R.parse_raw(files).select("file", "kind", "line", "model", "company", "date", "code_arena", "license", "mined")
