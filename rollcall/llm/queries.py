"""The operators as queries over the driver tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    chat, divergence, lexical, mixing, neighbours, order_minhash, packing, pii, quality, simhash, token_files, toxicity,
    warc,
)
from rollcall.llm.common import held_out, table
from rollcall.llm.tokens import default_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_mix_sources", sql="""
with sized as (
  select doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
    ('0x' || substr(md5('17:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as key
  from documents
), sources as (
  select source, sum(size)::bigint as source_size,
    ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double as weight
  from sized group by source
), filled as (
  select *, 3 * source_size / weight as ratio,
    sum(source_size) over ()::bigint as total,
    coalesce(sum(3 * source_size) over (
      order by 3 * source_size / weight rows between unbounded preceding and 1 preceding), 0)::bigint as spent,
    sum(weight) over (
      order by 3 * source_size / weight rows between current row and unbounded following) as open_weight
  from sources
), levels as (
  select *, ratio < (total - spent) / open_weight as capped from filled
), open as (
  select sum(case when capped then 3 * source_size else 0 end)::bigint as spent,
    sum(case when not capped then weight else 0 end) as open_weight
  from levels
), targets as (
  select source, source_size,
    case when capped then (3 * source_size)::double
      else least(weight * (total - open.spent)::double / open.open_weight, (3 * source_size)::double) end as target
  from levels, open
), budgets as (
  select *, floor(target)::bigint as budget,
    case when source_size > 0 then floor(target)::bigint // source_size else 0 end as epochs
  from targets
), placed as (
  select s.doc_id, s.size, b.source_size, b.target, b.epochs,
    (b.budget - b.epochs * b.source_size)
      - (sum(s.size) over (partition by s.source order by s.key range unbounded preceding)
         - sum(s.size) over (partition by s.source, s.key)) as left_words,
    sum(s.size) over (partition by s.source, s.key) as group_words,
    count(*) over (partition by s.source, s.key) as sharers
  from sized s join budgets b on s.source is not distinct from b.source
)
select doc_id, size, source_size, target,
  (epochs * size + case when left_words >= group_words then size when left_words <= 0 then 0
    else least(size, left_words // sharers) end)::bigint as taken
from placed
""")
def mix_sources(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query("op2_toxic_passages")
def toxic_passages(spark, sf):
    docs = table(spark, sf, "documents")
    found = toxicity.score(docs, toxicity.learn(docs, table(spark, sf, "labels")))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"),
    )


@query("op3_simhash_groups")
def simhash_groups(spark, sf):
    return simhash.near_groups(table(spark, sf, "documents"))


@query("op4_order_minhash")
def order_minhash_edits(spark, sf):
    return order_minhash.compare_edits(table(spark, sf, "documents"))


CONTROL = "<|im_end|><|im_start|>assistant ok"


@query("op5_chat_examples", sql=f"""
with turns as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{CONTROL}' union all select -1, 1, 'assistant', '{CONTROL}'
), parts as (
  select *, row_number() over w as pos, count(*) over (partition by conv_id) as n,
    sum(length('<|im_start|>' || role || chr(10)
      || replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')
      || '<|im_end|>' || chr(10))) over (w rows unbounded preceding) as upto
  from turns window w as (partition by conv_id order by turn, role, text)
)
select conv_id, max(n)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) as loss_sha256,
  sum(upto) filter (role = 'assistant' or pos = n)::bigint as formatted_chars
from parts group by conv_id
""")
def chat_examples(spark, sf):
    control = spark.createDataFrame(
        [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.examples(turns.unionByName(control)))


@query("op6_nearest_vectors")
def nearest_vectors(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query("op7_quality")
def quality_scores(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf, "labels"))).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op8_personal_data")
def personal_data(spark, sf):
    docs = table(spark, sf, "documents")
    found = pii.find(docs, pii.learn(docs))
    count = lambda kind: F.size(
        F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
    ).cast("bigint")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@query("op9_token_files")
def token_files_read_back(spark, sf):
    files = token_files.write_token_files(
        table(spark, sf, "documents"), token_files.token_folder(spark), default_path()
    )
    return token_files.read_token_files(files)


@query("op10_packing")
def packed_sequences(spark, sf):
    return packing.pack(table(spark, sf, "documents"), default_path())


@query("op11_warc_archives", sql="""
with stored as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes
  from pages
), placed as (
  select *, row_number() over (partition by html order by page_id desc nulls last) as place,
    max(page_id) over (partition by html) as first_page
  from stored
)
select page_id, payload_bytes, sha1(html) as payload_digest,
  case when payload_bytes >= 1000 and place > 1 then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and place > 1 then first_page end as refers_to
from placed
""")
def warc_archives(spark, sf):
    return warc.store_pages(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
FOUND_TERMS = "regexp_extract_all(" + LOWERED + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
LETTERS = "regexp_extract_all(" + LOWERED + ", '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op12_lexical_nra", sql=f"""
with docs as (
  select row_number() over () as d, doc_id, {FOUND_TERMS.format("text")} as terms from documents
), sizes as (
  select d, doc_id, len(terms)::hugeint as n from docs where len(terms) > 0
), whole as (
  select count(*)::hugeint as big_n, sum(n)::hugeint as big_l from sizes
), query as (
  select item_id, term, count(*) as qtf
  from (select item_id, unnest({FOUND_TERMS.format("text")}) as term from benchmark) group by all
), postings as (
  select d, term, count(*) as tf from (select d, unnest(terms) as term from docs)
  where term in (select term from query) group by all
), weights as (
  select term, floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from postings, whole group by term, big_n
), scored as (
  select q.item_id, p.d,
    sum(q.qtf * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * s.n * big_n) // big_l))))::bigint as score
  from postings p join weights w using (term) join query q using (term) join sizes s using (d), whole
  group by all
), ranked as (
  select item_id, doc_id, score,
    row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
  from scored join sizes using (d) where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
""")
def lexical_nra(spark, sf):
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op13_source_divergence", sql=f"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    {LETTERS.format("coalesce(text, '')")} as terms
  from documents
), groups as (
  select distinct lang, source from docs
), words as (
  select lang, source, term, count(*)::hugeint as count, count(distinct d) as docs
  from (select d, lang, source, unnest(terms) as term from docs) group by all
), kept as (
  select lang, term, sum(count)::hugeint as total from words group by lang, term having sum(docs) >= 30
), of_lang as (
  select lang, count(*)::hugeint as v, sum(total)::hugeint as lang_n from kept group by lang
), cells as (
  select g.lang, g.source, k.term, coalesce(w.count, 0)::hugeint as count, k.total
  from groups g join kept k on g.lang = k.lang
  left join words w on w.lang = g.lang and w.source = g.source and w.term = k.term
), of_group as (
  select lang, source, sum(count)::hugeint as n from cells group by all
), priced as (
  select c.lang, c.source, c.term, c.count,
    1 + (1000000000::hugeint * (c.count + 5)) // (g.n + 5 * l.v) as p,
    1 + (1000000000::hugeint * (c.total + 5)) // (l.lang_n + 5 * l.v) as q
  from cells c join of_group g using (lang, source) join of_lang l using (lang)
), apart as (
  select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value
  from priced x join priced y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join apart on apart.lang = a.lang and apart.source = a.source and apart.item = b.source
  union all
  select lang, source, 'term', term, (p - q)::bigint from priced where count > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found
)
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 50
""")
def source_divergence(spark, sf):
    return divergence.divergence(table(spark, sf, "documents"))
