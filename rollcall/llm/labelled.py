"""Labelled texts to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import held_out
from rollcall.session import broadcast_if_small


def _texts(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"), *more
    )


def training_ids(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``_id``, ``_text`` (its hash) and ``_label`` (0 to 1) of one document for each distinct labelled text.

    Rows of the held-out fold, without an id or without a label are not used.
    Copies of a text count once, with the mean of their labels. ``_rows`` tells how many
    documents have the id and the text.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("_doc")).agg(F.avg(F.col(label).cast("double")).alias("_y"))
    )
    return (
        _texts(docs).join(broadcast_if_small(known, "labels"), F.col("_id") == F.col("_doc"))
        .groupBy("_text", "_id").agg(F.count("*").alias("_n"), F.sum("_y").alias("_sum"))
        .groupBy("_text").agg(
            F.min(F.struct("_id", "_n")).alias("_first"), (F.sum("_sum") / F.sum("_n")).alias("_label")
        )
        .select(F.col("_first._id").alias("_id"), "_text", "_label", F.col("_first._n").alias("_rows"))
    )


def training_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The texts of the chosen documents with their labels: columns text, label.

    A row is told by its id and text, so an id with many texts gives those that were chosen,
    each once however often the row repeats.
    """
    chosen = broadcast_if_small(
        chosen.select(F.col("_id").alias("_i"), F.col("_text").alias("_t"), F.col("_label").alias("label"), "_rows"), "training"
    )
    rows = _texts(docs, F.coalesce("text", F.lit("")).alias("text"))
    found = rows.join(chosen, (F.col("_id") == F.col("_i")) & (F.col("_text") == F.col("_t")))
    if not chosen.filter("_rows > 1").isEmpty():
        found = found.dropDuplicates(["_text"])
    return found.select("text", "label")
