"""One large JSON array read by many tasks.

A file is cut after every ``}`` by the text reader itself, so each task reads a stretch of it and none
the whole. Whether a piece begins inside a string, and how deep, depends on all pieces
before it; what a piece does to that is known without them (``jsontext.lexed``). Sums within a stretch,
for both ways it may begin, and then over the stretches, one row for each, give
every piece its state, and the pieces of one object have the same count of finished objects before
them.

Bounds: no task holds more than a stretch, which has a bounded number of pieces, or one object. The text is shuffled twice, by
stretch and by object, whatever the length of the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.operators.jsontext import depth_of_records, lexed, own_text, record
from rollcall.session import broadcast_if_small, materialize

_STRETCH = ["path", "stretch"]
STRETCH_BITS = 17  # a stretch has at most so many pieces, as a power of two


def read_pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces of the files with their place, written out: path, file, stretch, id, text and what they do."""
    rows = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"), F.col("_metadata.file_size").alias("_size"),
        # grows along the rows of a block, which one task reads from its start
        F.monotonically_increasing_id().alias("id"), F.concat("value", F.lit("}")).alias("text"),
    )
    # a block is cut again, since a window holds a stretch in memory, and a block has the reader's size
    rows = rows.withColumn("stretch", F.struct("_block", F.shiftright("id", STRETCH_BITS).alias("_run"))).drop("_block")
    return materialize(rows.withColumn("_l", lexed(F.col("text"))).select("*", "_l.*").drop("_l"), "json-pieces")


def _within(pieces: DataFrame) -> DataFrame:
    """State after each piece, counted from the start of its stretch, for both ways that may be.

    ``turned``: 1 if inside a string has changed; ``deeper0`` and ``deeper1``: depth won if the stretch
    begins outside or inside a string.
    """
    upto = Window.partitionBy(*_STRETCH).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    turned = pieces.withColumn("turned", F.sum("turn").over(upto) % 2)
    began = (F.col("turned") + F.col("turn")) % 2
    step = lambda start: F.when(began == start, F.col("out")).otherwise(F.col("in"))
    return turned.withColumns({f"deeper{s}": F.sum(step(s)).over(upto) for s in (0, 1)})


def _closed(states: DataFrame) -> DataFrame:
    """``done``: whether the piece ends a record, the state at the start of its stretch being known."""
    inside = (F.col("turned") + F.col("begins")) % 2
    depth = F.col("depth") + F.when(F.col("begins") == 0, F.col("deeper0")).otherwise(F.col("deeper1"))
    return states.withColumn("done", (inside == 0) & (depth == F.col("level")) & ~F.col("open_end"))


def _stretches(pieces: DataFrame) -> DataFrame:
    """A row for each stretch with the state it begins in, and the records finished before it."""
    light = materialize(_within(pieces.drop("text", "file")), "json-states")
    earlier = Window.partitionBy("path").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    # the file's last piece has no brace of its own unless the file ends with one
    heads = pieces.groupBy(*_STRETCH).agg(
        F.min_by(depth_of_records(F.col("text")), "id").alias("_level"), F.sum(F.octet_length("text")).alias("_bytes"),
        F.max("_size").alias("_size"), F.max("id").alias("_last"),
    )
    ends = light.groupBy(*_STRETCH).agg(
        F.max_by("turned", "id").alias("_turned"), F.max_by("deeper0", "id").alias("_d0"), F.max_by("deeper1", "id").alias("_d1")
    )
    known = (
        ends.join(heads, _STRETCH)
        .withColumn("begins", before("_turned") % 2)
        .withColumn("depth", before(F.when(F.col("begins") == 0, F.col("_d0")).otherwise(F.col("_d1"))))
        .withColumn("level", F.min_by("_level", "stretch").over(whole))
        .withColumn("_open", F.sum("_bytes").over(whole) > F.col("_size"))
        .withColumn("_open", F.col("_open") & (F.col("stretch") == F.max("stretch").over(whole)))
        .select(*_STRETCH, "begins", "depth", "level", F.when(F.col("_open"), F.col("_last")).alias("open_id"))
    )
    known = materialize(known, "json-stretches")
    counted = _closed(_begun(light, known)).groupBy(*_STRETCH).agg(F.count_if("done").alias("_n"))
    return known.join(counted, _STRETCH).withColumn("finished", before("_n")).drop("_n")


def _begun(pieces: DataFrame, stretches: DataFrame) -> DataFrame:
    joined = pieces.join(broadcast_if_small(stretches, "json-begins"), _STRETCH)
    return joined.withColumn("open_end", F.coalesce(F.col("id") == F.col("open_id"), F.lit(False)))


def read_large_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of JSON arrays, or of objects after each other: ``path``, ``file``, ``pos``, ``record``.

    As :func:`readers.read_records` gives them for files of any size, with ``pos`` the count of whole
    objects before. An object that can't be read is left out and keeps its number; one that the
    file cuts off is no object.
    """
    pieces = read_pieces(spark, path)
    states = _closed(_begun(_within(pieces), _stretches(pieces)))
    ahead = Window.partitionBy(*_STRETCH).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    numbered = states.withColumn(
        "pos", F.col("finished") + F.coalesce(F.sum(F.col("done").cast("bigint")).over(ahead), F.lit(0))
    )
    runs = numbered.groupBy("path", "file", "pos").agg(
        F.array_sort(F.collect_list(F.struct("stretch", "id", "text"))).alias("_p"), F.bool_or("done").alias("_done")
    )
    text = F.array_join(F.transform("_p", lambda p: p["text"]), "")
    found = runs.filter("_done").select("path", "file", "pos", record(own_text(text)).alias("record"))
    return found.filter(F.col("record").isNotNull())
