"""Matching mentions to known entities: exact, loose and containment keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import labels
from rollcall.functions.text import blank_to_null, fold_key, loose_key, plain_key, strip
from rollcall.operators.bitmap import join_keys
from rollcall.operators.dedupe import drop_blank, first_wins
from rollcall.operators.rows import explode_rows
from rollcall.session import broadcast_if_small, materialize

MIN_LEN = 5  # containment needs more than four characters on both sides


def _pieces(df: DataFrame, key: str, units: Column, n: int) -> DataFrame:
    """One row per key and run of n units, as ``(key, piece)`` hashes; runs may repeat.

    The hashed units are a column of their own, so the text is split once per
    row and not once per run; the work is linear in the length of the text.
    """
    cut = df.select(key, F.transform(units, lambda u: F.xxhash64(u)).alias("_u"))
    starts = F.when(F.size("_u") >= n, F.sequence(F.lit(0), F.size("_u") - n))
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.get("_u", i + k) for k in range(n)]))
    return explode_rows(cut.select(key, runs.alias("_r")), "_r", "piece")


def _grams(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    return _pieces(df, key, F.filter(F.split(text, ""), lambda c: c != ""), n)


SIZES = (1, 2, 3, 4, 5, 8, 12, 18, 27, 40, 60, 90, 135, 200)


def _size_of(text: str, min_len: int) -> Column:
    """Length of the run an entry is looked up by: at least two thirds of a name."""
    size = F.lit(min_len)
    for n in SIZES:
        size = F.when(F.length(text) >= max(n, min_len), max(n, min_len)).otherwise(size)
    return size


def _name_runs(df: DataFrame, key: str, text: str, sizes: Column, side: Column | None = None) -> DataFrame:
    """All character runs of a short text, in each of the sizes, as ``(key, piece)`` hashes.

    Runs of different ``side`` have different hashes.
    """
    more = [] if side is None else [side]
    runs = F.flatten(F.transform(
        F.filter(sizes, lambda n: F.length(text) >= n),
        lambda n: F.transform(
            F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.xxhash64(F.substr(F.col(text), i, n), *more)
        ),
    ))
    return explode_rows(df.select(F.col(key), runs.alias("_r")), "_r", "piece")


def _word_runs(df: DataFrame, key: str, text: str, n: int, inner: bool = False) -> DataFrame:
    """Runs of n words; ``inner`` leaves out the first and the last word."""
    words = F.split(text, r"\s+")
    if inner:
        df = df.select(key, words.alias("_w"))
        words = F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 2, F.lit(0)))
    return _pieces(df, key, words, n)


def _rarest(pieces: DataFrame, key: str) -> DataFrame:
    """Per key, the piece that the fewest keys share.

    Openings or phrases common to very many entries are never the anchor of an
    entry that has anything of its own, so no join group below grows with them.
    """
    freq = pieces.groupBy("piece").agg(F.count("*").alias("_freq"))
    return (
        pieces.join(freq, "piece")
        .groupBy(key)
        .agg(F.min_by("piece", F.struct("_freq", "piece")).alias("piece"))
    )


def _hold(pieces: DataFrame, anchors: DataFrame, key: str, entry: str) -> DataFrame:
    """Distinct (key, entry) pairs whose pieces meet.

    There is one anchor row per entry but a piece for every few characters of
    text: when the anchors are small the pieces never leave their task, and when
    they are not, only pieces the anchors' bitmap lets through do.
    """
    return join_keys(pieces, anchors, "piece", "anchors").select(key, entry).distinct()


def contained_names(longs: DataFrame, shorts: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """Distinct (long, short) name pairs where ``long`` contains ``short``.

    Inputs are one-column frames ``long`` and ``short`` of short texts.
    """
    pairs = name_candidates(longs, shorts, min_len)
    return pairs.filter(F.col("long").contains(F.col("short")))


def name_candidates(longs: DataFrame, shorts: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """Distinct (long, short) pairs among which all contained names are.

    A short name is found through its rarest character run: whatever contains the
    name contains that run, so the equi-join loses nothing.
    The run grows with the name and is most of it, so names built alike don't
    meet, however many there are.
    """
    longs = longs.filter(F.length("long") >= min_len).distinct()
    shorts = shorts.filter(F.length("short") >= min_len).distinct()
    shorts = materialize(shorts.withColumn("_n", _size_of("short", min_len)), "short-names")
    sizes = sorted(r["_n"] for r in shorts.select("_n").distinct().collect())  # at most one for each of SIZES
    anchors = _rarest(_name_runs(shorts, "short", "short", F.array("_n")), "short")
    wanted = F.array(*[F.lit(n) for n in sizes]).cast("array<int>")
    return _hold(_name_runs(longs, "long", "long", wanted), anchors, "long", "short")


def _either_way(keys: DataFrame, index: DataFrame, min_len: int) -> DataFrame:
    """Distinct (key, index_key) pairs of which one contains the other.

    Both directions are one search: each name is looked up by its rarest run among the runs
    of the other side's names.
    """
    names = keys.select(F.lit(True).alias("is_key"), F.col("key").alias("name")).unionByName(
        index.select(F.lit(False).alias("is_key"), F.col("index_key").alias("name"))
    )
    names = names.withColumns({"_n": _size_of("name", min_len), "entry": F.struct("is_key", "name")})
    sizes = sorted(r["_n"] for r in names.select("_n").distinct().collect())  # at most one for each of SIZES
    wanted = F.array(*[F.lit(n) for n in sizes]).cast("array<int>")
    anchors = _rarest(_name_runs(names, "entry", "name", F.array("_n"), F.col("is_key")), "entry")
    runs = _name_runs(names.withColumnRenamed("name", "long"), "long", "long", wanted, ~F.col("is_key"))
    short, long = F.col("entry")["name"], F.col("long")
    found = _hold(runs, anchors, "long", "entry").filter(long.contains(short))
    is_key = F.col("entry")["is_key"]
    return found.select(
        F.when(is_key, short).otherwise(long).alias("key"), F.when(is_key, long).otherwise(short).alias("index_key")
    )


def containment_match(left: DataFrame, index: DataFrame, min_len: int = MIN_LEN, written: bool = False) -> DataFrame:
    """First index entry, by position, that contains a left key or is contained in it.

    ``left`` has ``key``; ``index`` has ``index_key`` (unique) and ``index_pos``.
    Returns ``key, index_key, index_pos``. Both directions are joined through
    grams, and the winner is a partial aggregate, so neither a name contained in
    a large part of the index nor its mirror image gathers in one task.
    ``written`` says that both sides are read from tables and cheap to read again.
    """
    keys = left.select("key").distinct().filter(F.length("key") >= min_len)
    index = index.select("index_key", "index_pos").filter(F.length("index_key") >= min_len)
    if not written:  # both sides are read several times below
        keys, index = materialize(keys, "keys"), materialize(index, "index")
    if keys.isEmpty():
        return index.select(F.col("index_key").alias("key"), "index_key", "index_pos").filter(F.lit(False))
    return (
        _either_way(keys, index, min_len)
        .join(index, "index_key")
        .groupBy("key")
        .agg(F.min_by(F.struct("index_key", "index_pos"), "index_pos").alias("_hit"))
        .select("key", "_hit.index_key", "_hit.index_pos")
    )


def passages_in_texts(
    texts: DataFrame, passages: DataFrame, text_id: str, passage_id: str,
    text: str = "text", passage: str = "text", run: int = 3, min_len: int = MIN_LEN,
) -> DataFrame:
    """All (text, passage) id pairs where the whole text contains the passage.

    Every word of a passage but its first and last is a whole word of any text
    that contains it. The passage's rarest run of ``run`` such words is looked
    up among the runs of all texts, and ``contains`` decides on the candidates.
    Passages with fewer words are looked for among the distinct units of all texts
    (:func:`dictionary.dictionary_hits`), blank ones through character runs.
    Equal passages are matched once.
    """
    entries = passages.select(passage_id, F.col(passage).alias("_text"), F.xxhash64(passage).alias("_hash"))
    entries = entries.filter(F.length("_text") >= min_len)
    unique = first_wins(entries, ["_hash", "_text"], [passage_id]).withColumnRenamed(passage_id, "_uid")
    anchors = _rarest(_word_runs(unique, "_uid", "_text", run, inner=True), "_uid")
    found = _hold(_word_runs(texts, text_id, text, run), anchors, text_id, "_uid")
    short = unique.filter(F.size(F.split("_text", r"\s+")) < run + 2)
    sure = None
    worded = short.filter(strip("_text") != "")
    if not worded.isEmpty():
        from rollcall.operators.dictionary import dictionary_hits  # which imports this module

        hits = dictionary_hits(texts, worded, text_id, text, "_text")
        sure = hits.join(broadcast_if_small(worded.select("_uid", F.col("_text").alias("word")), "short"), "word").select(text_id, "_uid")
    short = short.filter(strip("_text") == "")
    if not short.isEmpty():
        anchors = _rarest(_grams(short, "_uid", "_text", min_len), "_uid")
        found = found.unionByName(_hold(_grams(texts, text_id, text, min_len), anchors, text_id, "_uid"))
    # candidates with their passage; the texts are read again but not shuffled for a few pairs
    pairs = broadcast_if_small(found.join(unique.select("_uid", "_text"), "_uid"), "candidates")
    held = (
        texts.select(text_id, F.col(text).alias("_whole"))
        .join(pairs, text_id)
        .filter(F.col("_whole").contains(F.col("_text")))
        .select(text_id, "_uid")
    )
    held = held if sure is None else held.unionByName(sure)
    copies = entries.join(unique, ["_hash", "_text"]).select(passage_id, "_uid")
    return held.join(copies, "_uid").select(text_id, passage_id)


def loose_index(records: DataFrame, names: list[str], pos: str, payload: list[str]) -> DataFrame:
    """Records by loose key of any of their names.

    A key seen more than once keeps its first position and its last record.
    """
    keyed = records.select(
        pos, *payload, F.posexplode_outer(F.array(*[loose_key(n) for n in names])).alias("_k", "index_key")
    ).filter(F.coalesce(F.col("index_key"), F.lit("")) != "")
    place = F.struct(pos, "_k")
    return keyed.groupBy("index_key").agg(
        F.min(place).alias("index_pos"), F.max_by(F.struct(*payload), place).alias("index_record")
    )


def match_records(mentions: DataFrame, name: str, index: DataFrame) -> DataFrame:
    """Attach the index record by exact loose key, else by containment; null when none.

    Only distinct keys are matched; the mentions are joined once at the end.
    """
    keyed = mentions.withColumn("key", loose_key(name))
    index = materialize(index, "records")
    records = index.select("index_key", F.col("index_record").alias("matched"))
    keys = keyed.select("key").distinct().join(
        records.withColumnRenamed("index_key", "key"), "key", "left"
    )
    keys = materialize(keys, "matched")
    missed = keys.filter(F.col("matched").isNull()).select("key")
    close = containment_match(missed, index, written=True).join(records, "index_key").select("key", "matched")
    found = broadcast_if_small(keys.filter(F.col("matched").isNotNull()).unionByName(close), "found")
    return keyed.join(found, "key", "left").drop("key")


def cross_verify(
    mentions: DataFrame,
    records: DataFrame,
    base_url: str,
    verified_by: str = "cross-verified",
    pos: str = "pos",
    date_order: tuple[str, str] = ("release_date", "announcement_date"),
) -> DataFrame:
    """Fill empty size, date and website of mentions from matching records."""
    payload = ["model_id", "params", "release_date", "announcement_date"]
    index = loose_index(records, ["name", "model_id"], pos, payload)
    m = match_records(mentions, "model_name", index)
    r = F.col("matched")
    dates = F.coalesce(*[blank_to_null(r[d]) for d in date_order])
    keep = lambda c, new: F.coalesce(F.nullif(F.col(c), F.lit("")), F.nullif(new, F.lit("")), F.col(c))
    return m.withColumns(
        {
            "size": keep("size", labels.size_from_million(r["params"])),
            "release_date": keep("release_date", dates),
            "website": keep("website", labels.detail_url(base_url, r["model_id"])),
            "verified_by": F.when(r.isNotNull(), F.lit(verified_by)),
        }
    ).drop("matched")


def split_tracked(mentions: DataFrame, catalog: DataFrame, name: str = "model_name", known: str = "name") -> DataFrame:
    """Flag every mention as tracked when its key is known or contained either way."""
    names = catalog.select(plain_key(known).alias("index_key")).distinct()
    names = materialize(drop_blank(names, F.col("index_key")), "names")
    keyed = mentions.withColumn("key", plain_key(name))
    exact = names.select(F.col("index_key").alias("key"), F.lit(True).alias("_exact"))
    keys = materialize(keyed.select("key").distinct().join(exact, "key", "left"), "tracked")
    missed = keys.filter(F.col("_exact").isNull()).select("key")
    # any partner will do, so all entries share one position
    close = containment_match(missed, names.withColumn("index_pos", F.lit(0)), written=True).select("key")
    # a key is in one of the two only
    found = keys.filter("_exact").select("key").unionByName(close).withColumn("_hit", F.lit(True))
    found = broadcast_if_small(found, "found")
    return (
        keyed.join(found, "key", "left")
        .withColumn("tracked", F.coalesce("_hit", F.lit(False)))
        .drop("key", "_hit")
    )


def new_only(rows: DataFrame, catalog: DataFrame, order: list[str], name: str = "name") -> DataFrame:
    """First row of every unknown name; blank names out."""
    keyed = drop_blank(rows.withColumn("_key", fold_key(name)), F.col("_key"))
    # distinct first, so that a name many rows share is no hot key of the join
    known = catalog.select(fold_key(name).alias("_key")).distinct()
    return first_wins(keyed, ["_key"], order).join(known, "_key", "left_anti").drop("_key")


def containment_flag(texts: DataFrame, hits: DataFrame, text_id: str) -> DataFrame:
    """Texts with a ``tracked`` flag from the pairs of :func:`passages_in_texts`."""
    some = hits.select(text_id).distinct().withColumn("_hit", F.lit(True))
    return texts.join(some, text_id, "left").withColumn(
        "tracked", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


