"""Records out of page scripts and model replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions.text import as_col
from rollcall.operators.jsontext import MAP, object_texts, records_of
from rollcall.operators.rows import let, posexplode_rows


def payload_text(html: Column | str) -> Column:
    """All pushed script chunks of a page, joined and unescaped."""
    joined = F.array_join(F.regexp_extract_all(as_col(html), F.lit(S.PAYLOAD_CHUNK), 1), "")
    quoted = F.replace(joined, F.lit('\\"'), F.lit('"'))
    return F.replace(quoted, F.lit("\\\\"), F.lit("\\"))


def _from(text: Column, at: Column) -> Column:
    """Text from a 1-based position on; null when there is no position."""
    return F.substring(text, at, F.length(text))


def _balanced(text: Column) -> Column:
    """Up to the bracket that closes the first one; everything when none does."""
    chars = F.split(text, "")
    state = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("i"), F.lit(0).alias("end"))

    def step(s: Column, c: Column) -> Column:
        depth = s["depth"] + F.when(c == "[", 1).when(c == "]", -1).otherwise(0)
        i = s["i"] + 1
        closed = (s["end"] == 0) & (c == "]") & (depth == 0)
        return F.struct(depth.alias("depth"), i.alias("i"), F.when(closed, i).otherwise(s["end"]).alias("end"))

    end = F.aggregate(chars, state, step)["end"]
    return F.when(end > 0, F.left(text, end)).otherwise(text)


def recover_objects(text: Column, pattern: str = S.PAYLOAD_OBJECT) -> Column:
    """Flat objects of a broken array that parse on their own; null when none does."""
    pieces = F.regexp_extract_all(text, F.lit(pattern), 0)
    parsed = F.filter(
        F.transform(pieces, lambda p: F.from_json(p, MAP)), lambda m: m.isNotNull() & (F.size(m) > 0)
    )
    return F.when(F.size(parsed) > 0, parsed)


def extract_embedded(pages: DataFrame, page: str, html: str = "html", keys: list[str] = S.PAYLOAD_KEYS) -> DataFrame:
    """One row per embedded record: page, position in the array, open record.

    The order of the keys decides which array is read, not their place in the
    text. The JSON reader stops after the first value, so brackets need no
    counting; only a page whose array does not parse is scanned for its end,
    and gives its readable objects.
    """
    wanted = F.coalesce(*[F.nullif(F.instr("_payload", f'"{k}":'), F.lit(0)) for k in keys])
    bracket = F.nullif(F.instr("_tail", "["), F.lit(0))
    # one column per step, so that no step is evaluated again inside a later one
    arrays = (
        pages.select(page, payload_text(html).alias("_payload"))
        .withColumn("_tail", _from(F.col("_payload"), wanted))
        .withColumn("_array", _from(F.col("_tail"), bracket))
        .withColumn("_parsed", F.from_json("_array", S.RECORDS))
    )
    broken = F.when(F.col("_parsed").isNull(), recover_objects(_balanced(F.col("_array"))))
    found = arrays.select(page, F.coalesce("_parsed", broken).alias("_records"))
    return posexplode_rows(found, "_records", "pos", "record")


def reply_content(response: Column | str) -> Column:
    """Text of a model reply from any of the known response shapes."""
    raw = as_col(response)
    at = lambda path: F.nullif(F.get_json_object(raw, path), F.lit(""))
    plain = F.get_json_object(raw, "$.output")
    return F.coalesce(
        at("$.choices[0].message.content"),
        at("$.choices[0].text"),
        at("$.output.text"),
        at("$.output.content"),
        F.when(~F.ltrim(plain).rlike(r"^[\[{]"), F.nullif(plain, F.lit(""))),
    )


def array_objects(array: Column) -> Column:
    """The objects among the elements of a JSON array, as open records; null for no array.

    A text that looks like an object is none: only where one may stand, quotes and
    brackets are followed through the array. Of a key that is said twice the last
    value counts.
    """

    def objects(whole: Column) -> Column:
        items = F.from_json(whole, "array<string>")
        lookalike = whole.rlike(r'"(?:\{|\\u007[bB])')
        texts = F.when(lookalike, object_texts(whole)).otherwise(F.filter(items, lambda s: s.startswith("{")))
        return F.when(items.isNotNull(), records_of(texts))

    return let(array, objects)


def reply_objects(content: Column | str) -> Column:
    """Objects of the array a reply holds between its first ``[`` and last ``]``."""
    array = F.nullif(F.regexp_extract(as_col(content), r"(?s)\[.*\]", 0), F.lit(""))
    return array_objects(array)


def entity_name(record: Column, keys: list[str] = S.REPLY_NAME_KEYS) -> Column:
    """Name under the first key that is present, even if its value is empty."""
    chain = F
    for k in keys:
        chain = chain.when(F.map_contains_key(record, k), record[k])
    return chain.otherwise(None)


def ingest_replies(replies: DataFrame, keep: list[str], content: Column | str) -> DataFrame:
    """Mentions out of reply texts, with their position in the reply; nameless out."""
    m = F.col("record")
    objects = replies.select(*keep, reply_objects(content).alias("_o"))
    rows = posexplode_rows(objects, "_o", "pos", "record")
    return (
        rows.withColumn("model_name", entity_name(m))
        .filter(F.coalesce(F.col("model_name"), F.lit("")) != "")
        .select(
            *keep, "pos", "model_name",
            *[F.coalesce(m[f], F.lit("")).alias(f) for f in S.MENTION_FIELDS if f != "model_name"],
        )
    )
