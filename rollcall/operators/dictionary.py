"""Which entries of a dictionary table occur in which texts, as any part of them.

Texts and entries are cut at single spaces. An entry without a space lies inside one unit of
a text; of an entry with spaces the first unit ends a unit of the text, the last begins one,
and those between are units of it. So entries meet the distinct units of all texts, not the texts: a run
index over the entries finds the units that hold an entry, and only these units are
looked for among the texts again. An entry with one space is an end of a unit and a beginning
of the next one; those that some entry has are put together for each two neighbours of a
text, and looked up whole. Entries with more spaces come in through their rarest
unit, and ``contains`` decides on those.

Nothing of the dictionary stands in the plan, whatever its size; blank and null entries and
null texts match nothing; entries said twice count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import strip
from rollcall.operators.bitmap import bitmap_of, join_keys, may_be_in
from rollcall.operators.match import contained_names
from rollcall.operators.rows import explode_rows
from rollcall.session import broadcast_if_small, materialize

STRETCH = 256  # units longer than this and the longest entry are looked at in overlapping stretches
WORTH = 3  # ends of units shorter than this find an entry only if nothing longer does


def _units(texts: DataFrame, text_id: str, text: str) -> DataFrame:
    """Every distinct unit of every text."""
    units = F.array_distinct(F.split(F.col(text), " ", -1))
    return explode_rows(texts.select(text_id, units.alias("_u")), "_u", "unit").filter(F.col("unit") != "")


def _stretches(unit: Column, longest: int) -> Column:
    starts = F.sequence(F.lit(1), F.length(unit), F.lit(STRETCH))
    cut = F.transform(starts, lambda i: F.substr(unit, i, F.lit(STRETCH + longest)))
    return F.when(F.length(unit) <= STRETCH + longest, F.array(unit)).otherwise(cut)


def _inside_units(vocabulary: DataFrame, entries: DataFrame) -> DataFrame:
    """(unit, word) of the entries without a space and the units that hold them."""
    words = entries.filter(~F.col("word").contains(" ")).select("word")
    longest = words.agg(F.max(F.length("word"))).first()[0]
    if longest is None:
        return vocabulary.select("unit", F.col("unit").alias("word")).limit(0)
    parts = explode_rows(vocabulary.select("unit", _stretches(F.col("unit"), longest).alias("_s")), "_s", "long")
    pairs = contained_names(parts.select("long"), words.withColumnRenamed("word", "short"), min_len=1)
    return parts.join(broadcast_if_small(pairs, "inside-units"), "long").select("unit", F.col("short").alias("word")).distinct()


def _anchor_units(vocabulary: DataFrame, entries: DataFrame) -> DataFrame:
    """(unit, word) of the entries with several spaces and the units one of which any text holds that has the entry.

    Of an entry's units the one counts that the fewest texts have.
    """
    spaced = entries.select("word", F.split("word", " ", -1).alias("_u")).filter(F.size("_u") > 2)
    last = F.size("_u") - 1
    parts = materialize(
        spaced.select("word", last.alias("_last"), F.posexplode("_u").alias("_pos", "part"))
        .filter(F.col("part") != "")
        .withColumn("role", F.when(F.col("_pos") == 0, "end").when(F.col("_pos") == F.col("_last"), "start").otherwise("whole"))
        .withColumn("_worth", (F.col("role") == "whole") | (F.length("part") >= WORTH)),
        "entry-units",
    )
    some = parts.groupBy(F.col("word").alias("_word")).agg(F.max("_worth").alias("_any"))
    parts = parts.join(some, F.col("word") == F.col("_word")).filter(F.col("_worth") | ~F.col("_any")).select("word", "role", "part")
    lengths = parts.filter("role <> 'whole'").groupBy("role").agg(F.collect_set(F.length("part")).alias("n"))
    sizes = dict(lengths.collect())  # at most one number for each length of a unit

    def ends(role: str, cut) -> Column:
        wanted = F.array(*[F.lit(n) for n in sorted(sizes.get(role, []))]).cast("array<int>")
        fitting = F.filter(wanted, lambda n: n <= F.length("unit"))
        return F.transform(fitting, lambda n: F.struct(F.lit(role).alias("role"), cut(n).alias("part")))

    whole = F.array(F.struct(F.lit("whole").alias("role"), F.col("unit").alias("part")))
    keys = F.concat(
        whole, ends("end", lambda n: F.right("unit", n)), ends("start", lambda n: F.left("unit", n))
    )
    keyed = explode_rows(vocabulary.select("unit", "texts", keys.alias("_k")), "_k", "key")
    wanted = materialize(parts.select("word", F.struct("role", "part").alias("key")), "entry-keys")
    rarity = keyed.join(broadcast_if_small(wanted.select("key").distinct(), "keys"), "key").groupBy("key").agg(
        F.sum("texts").alias("texts")
    )
    rarest = wanted.join(rarity, "key").groupBy("word").agg(F.min_by("key", F.struct("texts", "key")).alias("key"))
    return keyed.select("unit", "key").join(broadcast_if_small(rarest, "rarest"), "key").select("unit", "word")


def _may_be(rows: DataFrame, pieces: DataFrame, piece: str, label: str) -> DataFrame:
    """The rows whose piece may be one of the distinct pieces, by their bitmap."""
    table = materialize(pieces.select(piece).distinct(), label)
    words, bits = bitmap_of(table, piece, table.count())
    return rows.filter(may_be_in(F.col(piece), materialize(words, f"{label}-bitmap"), bits))


def _pair_hits(texts: DataFrame, entries: DataFrame, text_id: str, text: str) -> DataFrame:
    """(``text_id``, ``word``) of the entries with one space, once for each row of the texts that holds it.

    Ends and beginnings that no entry has go before they are put together, and what is no
    entry goes before it leaves its task.
    """
    paired = entries.select("word", F.split("word", " ", -1).alias("_u")).filter(F.size("_u") == 2)
    paired = paired.select("word", F.get("_u", F.lit(0)).alias("end"), F.get("_u", F.lit(1)).alias("start"))
    sizes = paired.agg(F.collect_set(F.length("end")), F.collect_set(F.length("start"))).first()  # one for each length
    if not sizes[0]:
        return texts.select(text_id, F.lit("").alias("word")).limit(0)

    def pieces(of: str, lengths: list[int], cut) -> Column:
        wanted = F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>")
        return F.transform(F.filter(wanted, lambda n: n <= F.length(of)), cut)

    split = F.split(F.col(text), " ", -1).alias("_u")
    units = texts.select(text_id, F.monotonically_increasing_id().alias("_row"), split).filter(F.size("_u") > 1)
    one, other = F.slice("_u", F.lit(1), F.size("_u") - 1), F.slice("_u", F.lit(2), F.size("_u") - 1)
    near = F.array_distinct(F.zip_with(one, other, lambda a, b: F.struct(a.alias("x"), b.alias("y"))))
    rows = explode_rows(units.select(text_id, "_row", near.alias("_p")), "_p", "_n").select(text_id, "_row", "_n.x", "_n.y")
    ends = rows.select(text_id, "_row", "y", pieces("x", sizes[0], lambda n: F.right("x", n)).alias("_e"))
    rows = _may_be(explode_rows(ends, "_e", "end"), paired, "end", "pair-ends")
    starts = rows.select(text_id, "_row", "end", pieces("y", sizes[1], lambda n: F.left("y", n)).alias("_s"))
    rows = _may_be(explode_rows(starts, "_s", "start"), paired, "start", "pair-starts")
    whole = rows.select(text_id, "_row", F.concat_ws(" ", "end", "start").alias("word"))
    held = join_keys(whole, paired.select("word"), "word", "pair-words").select("_row", text_id, "word").distinct()
    return held.select(text_id, "word")


def dictionary_hits(
    texts: DataFrame, dictionary: DataFrame, text_id: str, text: str = "text", word: str = "word"
) -> DataFrame:
    """(``text_id``, ``word``), distinct where ``text_id`` is unique: all entries that a text contains.

    Rows that share an id give its entries with spaces once each.
    """
    entries = materialize(
        dictionary.select(F.col(word).alias("word")).filter(strip("word") != "").distinct(), "entries"
    )
    units = _units(texts, text_id, text)
    vocabulary = materialize(units.groupBy("unit").agg(F.count("*").alias("texts")), "units")
    sure = join_keys(units, _inside_units(vocabulary, entries), "unit", "held-units").select(text_id, "word")
    likely = join_keys(units, _anchor_units(vocabulary, entries), "unit", "anchor-units").select(text_id, "word").distinct()
    held = (
        texts.select(text_id, F.col(text).alias("_whole"))
        .join(broadcast_if_small(likely, "candidates"), text_id)
        .filter(F.col("_whole").contains(F.col("word")))
        .select(text_id, "word")
    )
    return sure.distinct().unionByName(held).unionByName(_pair_hits(texts, entries, text_id, text))


def matches_any(
    texts: DataFrame, dictionary: DataFrame, text_id: str, text: str = "text", word: str = "word", flag: str = "matched"
) -> DataFrame:
    """The texts with a flag: whether they contain any entry. ``text_id`` is unique."""
    return flag_hits(texts, dictionary_hits(texts, dictionary, text_id, text, word), text_id, flag)


def flag_hits(texts: DataFrame, hits: DataFrame, text_id: str, flag: str = "matched") -> DataFrame:
    """The texts with a flag: whether they stand among the hits of :func:`dictionary_hits`."""
    some = hits.select(F.col(text_id).alias("_id")).distinct().withColumn("_hit", F.lit(True))
    marked = broadcast_if_small(some, "matched")
    return texts.join(marked, F.col(text_id) == F.col("_id"), "left").withColumn(
        flag, F.coalesce("_hit", F.lit(False))
    ).drop("_id", "_hit")
