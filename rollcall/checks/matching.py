from pyspark.sql import functions as F

from rollcall.checks.base import CATALOG_SQL, catalog, check, geography, names_in, table
from rollcall.operators import dictionary as D
from rollcall.operators import enrich as E
from rollcall.operators import match as M
from rollcall.operators.rows import let
from rollcall.session import materialize

BASE_URL = "http://example.com/models"


@check(
    "cross_verify_exact",
    """
    select o_orderkey, case when o_orderstatus = 'F' then '7B' when c_acctbal >= 10 then cast(cast(round_even(floor(c_acctbal) / 10.0, 0) as bigint) as varchar) || 'B'
        when c_acctbal >= 1 then cast(cast(floor(c_acctbal) as bigint) as varchar) || '00M' else '' end as size,
      case when o_orderstatus = 'O' then '2024-01-01' when c_acctbal < 2000 then c_mktsegment when c_acctbal < 5000 then 'announced' else '' end as release_date,
      'http://example.com/models/c' || c_custkey as website, 'checked' as verified_by
    from orders join customer on o_custkey = c_custkey
    """,
)
def cross_verify_exact(spark, sf):
    """Every order mentions its customer in another spelling."""
    customers = table(spark, sf, "customer")
    mentions = table(spark, sf, "orders", spread=True).join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.replace(F.upper("c_name"), F.lit("#"), F.lit(" _#-")).alias("model_name"),
        F.when(F.col("o_orderstatus") == "F", "7B").otherwise("").alias("size"),
        F.when(F.col("o_orderstatus") == "O", "2024-01-01").otherwise("").alias("release_date"),
        F.lit("").alias("website"),
    )
    whole = F.floor("c_acctbal")
    records = customers.select(
        F.col("c_custkey").alias("pos"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), "c_custkey").alias("model_id"),
        F.when(whole > 0, whole * 100_000_000).alias("params"),
        F.when(F.col("c_acctbal") < 2000, F.col("c_mktsegment")).otherwise("").alias("release_date"),
        F.when(F.col("c_acctbal") < 5000, "announced").alias("announcement_date"),
    )
    found = M.cross_verify(mentions, records, BASE_URL, "checked")
    return found.select("o_orderkey", "size", "release_date", "website", "verified_by")


@check(
    "containment_match",
    """
    select doc_id, min(item_id) as item_id from documents d join benchmark b on contains(d.text, b.text)
    where length(b.text) > 4 group by doc_id
    """,
)
def containment_match(spark, sf):
    """First passage that each whole document contains."""
    pairs = M.passages_in_texts(table(spark, sf, "documents", spread=True), table(spark, sf, "benchmark"), "doc_id", "item_id")
    return pairs.groupBy("doc_id").agg(F.min("item_id").alias("item_id"))


@check(
    "containment_pairs",
    "select doc_id, item_id from documents d join benchmark b on contains(d.text, b.text) where length(b.text) > 4",
)
def containment_pairs(spark, sf):
    return M.passages_in_texts(
        table(spark, sf, "documents", spread=True), table(spark, sf, "benchmark"), "doc_id", "item_id"
    )


def _words(spark, sf, name, column):
    """Distinct capitalised words of whole texts, lower case, with their first row."""
    keys = {"benchmark": "item_id", "conversations": "conv_id", "documents": "doc_id"}
    words = table(spark, sf, name).select(keys[name], F.explode(names_in(column)).alias("w"))
    return words.groupBy(F.lower("w").alias("word")).agg(F.min(keys[name]).alias("first"))


_WORDS = """
docs as (select lower(w) as word, min(doc_id) as first from (select doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{4,}')) as w from documents) group by 1),
bench as (select lower(w) as word, min(item_id) as first from (select item_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{4,}')) as w from benchmark) group by 1)"""


@check(
    "name_containment",
    f"""
    with {_WORDS},
    hits as (select docs.word as key, bench.word as index_key, bench.first * 1000000 + dense_rank() over (order by bench.word) as p
      from docs join bench on contains(docs.word, bench.word) or contains(bench.word, docs.word))
    select key, arg_min(index_key, p) as index_key from hits group by key
    """,
)
def name_containment(spark, sf):
    """Words of all documents against words of all passages, either way round."""
    index = _words(spark, sf, "benchmark", "text").select(
        F.col("word").alias("index_key"), F.struct("first", "word").alias("index_pos")
    )
    keys = _words(spark, sf, "documents", "text").select(F.col("word").alias("key"))
    return M.containment_match(keys, index).select("key", "index_key")


_ANY_WORDS = """
docs as (select distinct lower(w) as word from (select unnest(regexp_extract_all(text, '[A-Z][a-z]*')) as w from documents)),
bench as (select distinct lower(w) as word from (select unnest(regexp_extract_all(text, '[A-Z][a-z]*')) as w from benchmark))"""


@check(
    "short_name_containment",
    f"""
    with {_ANY_WORDS}
    select docs.word as long, bench.word as short from docs join bench on contains(docs.word, bench.word)
    where length(docs.word) > 4 and length(bench.word) > 4
    """,
)
def short_name_containment(spark, sf):
    """Words of any length, one letter included; those of up to four letters match nothing."""
    words = lambda t, name: table(spark, sf, t).select(
        F.explode(F.regexp_extract_all("text", F.lit("([A-Z][a-z]*)"), 1)).alias("w")
    ).select(F.lower("w").alias(name)).distinct()
    return M.contained_names(words("documents", "long"), words("benchmark", "short"))


@check(
    "short_passages",
    """
    with p as (select item_id, n, array_to_string(string_split(text, ' ')[1:n], ' ') as text from benchmark, generate_series(1, 4) as g(n))
    select doc_id, item_id * 10 + n as passage from documents d join p on contains(d.text, p.text) where length(p.text) > 4
    """,
)
def short_passages(spark, sf):
    """The first one to four words of every passage in whole documents."""
    words = F.split("text", " ")
    starts = table(spark, sf, "benchmark").select(
        "item_id", words.alias("_w"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("n")
    ).select(
        (F.col("item_id") * 10 + F.col("n")).alias("passage"), F.array_join(F.slice("_w", F.lit(1), F.col("n")), " ").alias("text")
    )
    return M.passages_in_texts(table(spark, sf, "documents", spread=True), starts, "doc_id", "passage")


@check(
    "tracked_split",
    f"""
    with {_WORDS}
    select docs.word as model_name, docs.word in (select word from bench)
      or exists (select 1 from bench where contains(docs.word, bench.word) or contains(bench.word, docs.word)) as tracked
    from docs
    """,
)
def tracked_split(spark, sf):
    mentions = _words(spark, sf, "documents", "text").select(F.col("word").alias("model_name"))
    known = _words(spark, sf, "benchmark", "text").select(F.upper("word").alias("name"))
    return M.split_tracked(mentions, known)


@check(
    "tracked_documents",
    "select doc_id, exists (select 1 from benchmark b where contains(d.text, b.text)) as tracked from documents d",
)
def tracked_documents(spark, sf):
    docs = table(spark, sf, "documents", spread=True).select("doc_id", "text")
    pairs = M.passages_in_texts(docs, table(spark, sf, "benchmark"), "doc_id", "item_id")
    return M.containment_flag(docs, pairs, "doc_id").select("doc_id", "tracked")


@check(
    "cross_verify_containment",
    f"""
    with {_WORDS},
    hits as (select docs.word as key, bench.word as name, docs.word = bench.word as same, bench.first * 1000000 + dense_rank() over (order by bench.word) as p
      from docs join bench on contains(docs.word, bench.word) or contains(bench.word, docs.word)),
    best as (select key, arg_min(name, case when same then -1 else p end) as name from hits group by key)
    select docs.word as model_name, coalesce('http://example.com/models/' || best.name, '') as website
    from docs left join best on docs.word = best.key
    """,
)
def cross_verify_containment(spark, sf):
    """An equal key first, else the first record that contains the name or is in it."""
    mentions = _words(spark, sf, "documents", "text").select(
        F.col("word").alias("model_name"), *[F.lit("").alias(c) for c in ("size", "release_date", "website")]
    )
    records = _words(spark, sf, "benchmark", "text").select(
        F.struct("first", "word").alias("pos"), F.col("word").alias("name"), F.col("word").alias("model_id"),
        F.lit(None).cast("bigint").alias("params"),
        *[F.lit("").alias(c) for c in ("release_date", "announcement_date")],
    )
    return M.cross_verify(mentions, records, BASE_URL).select("model_name", "website")


@check(
    "anti_dedupe",
    """
    select c_name as name, min(o_orderkey) as o_orderkey from orders join customer on o_custkey = c_custkey
    where c_acctbal < 4000 group by c_name
    """,
)
def anti_dedupe(spark, sf):
    """First order of every customer that the catalog does not hold yet."""
    customers = table(spark, sf, "customer")
    rows = table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("name"), "o_orderkey"
    )
    known = customers.filter("c_acctbal >= 4000").select(F.concat(F.lit(" "), F.upper("c_name")).alias("name"))
    return M.new_only(rows, known, ["o_orderkey"])


_ENRICHED = """
    with rows as (
      select s_suppkey as row_id, s_name, n_name, case when s_acctbal < 7000 then '开源' else '闭源' end as openness,
        case when s_acctbal < 1000 then '1B' else '' end as size
      from supplier join nation on s_nationkey = n_nationkey),
    hit as (
      select *, case when openness <> '开源' or n_name like '%9' then null
        when n_name like '%2%' then lower(replace(n_name, '_', '-')) || '/' || s_name
        else s_name end as id,
        n_name not like '%2%' and n_name like '%1%' as login from rows)
    select row_id, case when id is null or login or size <> '' then size
        else (row_id + 1) || 'B' end as size,
      case when id is null then 'seen' when login then 'seen · registry login required(' || id || ')'
        else 'registry verified(' || id || ') · 参数量=' || (row_id + 1) || 'B · mit · text' end as verification
    from hit
    """


def _enriched(spark, sf, early_stop):
    rows = table(spark, sf, "supplier").join(geography(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("company", F.replace("n_name", F.lit("_"), F.lit(" ")))
    catalog_rows = rows.select(
        F.col("s_suppkey").alias("row_id"), F.col("s_name").alias("name"), "company",
        F.when(F.col("s_acctbal") < 7000, "开源").otherwise("闭源").alias("openness"),
        F.when(F.col("s_acctbal") < 1000, "1B").otherwise("").alias("size"),
        F.lit("seen").alias("verification"),
    )
    two = F.col("n_name").contains("2")
    owner = F.lower(F.replace("n_name", F.lit("_"), F.lit("-")))
    entries = rows.filter(~F.col("n_name").endswith("9")).select(
        F.when(two, F.concat(owner, F.lit("/"), "s_name")).otherwise(F.col("s_name")).alias("repo_id"),
        ((F.col("s_suppkey") + 1) * 1_000_000_000).alias("params_total"),
        F.array(F.lit("x"), F.lit("license:mit")).alias("tags"),
        F.lit("text").alias("pipeline_tag"),
        (~two & F.col("n_name").contains("1")).alias("login_required"),
    )
    # the registry also holds every supplier of the second group under its bare name, which comes later
    later = entries.filter(F.col("repo_id").contains("/")).withColumns(
        {"repo_id": F.get(F.split("repo_id", "/"), F.lit(1)), "login_required": F.lit(True)}
    )
    done = E.enrich_by_candidates(catalog_rows, entries.unionByName(later), early_stop=early_stop)
    return done.select("row_id", "size", "verification")


@check("candidate_enrich", _ENRICHED)
def candidate_enrich(spark, sf):
    """Suppliers registered under company/name, under the bare name, or not at all."""
    return _enriched(spark, sf, False)


@check("candidate_rounds", _ENRICHED)
def candidate_rounds(spark, sf):
    """The same in rounds, each for the rows that are still open."""
    return _enriched(spark, sf, True)


@check(
    "unmatched_names",
    f"""
    with {CATALOG_SQL}
    select row_id from catalog where balance < 0
    """,
)
def unmatched_names(spark, sf):
    """Catalog names that no record holds under any loose spelling."""
    rows = catalog(spark, sf)
    records = rows.filter("balance >= 0").select(
        F.col("row_id").alias("pos"), F.upper("name").alias("name"), F.lit("none").alias("model_id"), "balance"
    )
    index = M.loose_index(records, ["name"], "pos", ["balance"])
    return M.match_records(rows.select("row_id", "name"), "name", index).filter("matched is null").select("row_id")


_ENTRIES = r"""
entries as (
  select distinct unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) as word
  from (select string_split(html, ' ') as w from pages)
  union
  select distinct lower(unnest(regexp_extract_all(text, '[A-Z][a-z]{2,}'))) from documents
)"""


@check(
    "dictionary_table",
    f"""
    with {_ENTRIES},
    kept as (select word from entries where length(word) between 3 and 24 and trim(word) <> ''),
    turns as (select conv_id || '/' || turn as turn_id, text from conversations),
    hits as (select turn_id, count(*) as n from turns join kept on contains(text, word) group by turn_id)
    select t.turn_id, h.n is not null as matched, coalesce(h.n, 0) as n from turns t left join hits h on t.turn_id = h.turn_id
    """,
)
def dictionary_table(spark, sf):
    """Word pairs of all pages and words of all documents, looked for anywhere in all turns."""
    next_to = lambda w: F.zip_with(
        F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b)
    )
    pairs = let(F.split("html", " ", -1), next_to)
    words = F.transform(F.regexp_extract_all("text", F.lit("([A-Z][a-z]{2,})"), 1), F.lower)
    entries = (
        table(spark, sf, "pages").select(F.explode(pairs).alias("word"))
        .unionByName(table(spark, sf, "documents").select(F.explode(words).alias("word")))
        .filter(F.length("word").between(3, 24))
    )
    turns = table(spark, sf, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("turn_id"), "text")
    hits = materialize(D.dictionary_hits(turns, entries, "turn_id"), "hits")
    counts = hits.groupBy(F.col("turn_id").alias("_id")).agg(F.count("*").alias("n"))
    return D.flag_hits(turns, hits, "turn_id").join(counts, F.col("turn_id") == F.col("_id"), "left").select(
        "turn_id", "matched", F.coalesce("n", F.lit(0)).alias("n")
    )
