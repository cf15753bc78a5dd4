"""Mentions: articles and model replies to catalog updates."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import in_window
from rollcall.functions.text import plain_key
from rollcall.operators.dedupe import dedupe_bodies, first_mention
from rollcall.operators.extract import ingest_replies, reply_content
from rollcall.operators.match import cross_verify, split_tracked
from rollcall.operators.stats import mention_lists
from rollcall.operators.upsert import upsert_fill, usable_mentions
from rollcall.session import broadcast_if_small, materialize


class MentionRun:
    """Mentioned and untracked names per article, every mention with its tracked flag, and the
    catalog after the upsert with the change per row, which is made when it is first asked for."""

    def __init__(self, articles: DataFrame, mentions: DataFrame, upserted: Callable[[], DataFrame]):
        self.articles, self.mentions, self._upserted = articles, mentions, upserted

    @cached_property
    def catalog(self) -> DataFrame:
        return self._upserted()


def articles_in_window(articles: DataFrame, since: int | None, until: int | None) -> DataFrame:
    """Articles dated in the window, equal bodies once. Undated ones are out as soon as a bound is set."""
    day = F.nullif(F.col("date_int"), F.lit(0))
    return dedupe_bodies(in_window(articles, day, since, until, keep_unknown=False))


def mention_run(
    articles: DataFrame,
    replies: DataFrame,
    catalog: DataFrame,
    records: DataFrame,
    since: int | None,
    until: int | None,
    created_at: str,
    base_url: str,
    date_fallback: bool = False,
    fill_tracked: bool = False,
) -> MentionRun:
    """``replies`` has ``file`` and the raw ``response`` of the model for that article.

    Untracked names become new rows. With ``fill_tracked`` mentions of an entity
    under its own name fill that row's blank cells as well.
    """
    # the bodies are hashed once; from here on only names and dates are needed
    kept = materialize(
        articles_in_window(articles, since, until).select("file", "seq", "title", "date_int"), "kept"
    )
    answered = kept.join(replies.select("file", "response"), "file")
    heads = ["file", "seq", F.col("title").alias("source_article"), F.col("date_int").alias("source_date")]
    found = ingest_replies(
        answered.select(*heads, reply_content("response").alias("content")),
        ["file", "seq", "source_article", "source_date"], "content",
    )
    # parsed replies and split mentions feed several results each
    mentions = materialize(split_tracked(materialize(found, "replies"), catalog), "mentions")
    lists = mention_lists(kept.select("file", "seq", "title"), mentions, "file")

    def upserted() -> DataFrame:
        chosen = mentions.filter(~F.col("tracked"))
        if fill_tracked:
            names = broadcast_if_small(catalog.select(plain_key("name").alias("_known")).distinct(), "names")
            own = mentions.filter("tracked").join(names, plain_key("model_name") == F.col("_known"), "left_semi")
            chosen = chosen.unionByName(own)
        first = first_mention(chosen, plain_key("model_name"), ["file", "pos"])
        checked = cross_verify(first.drop("mention_key"), records, base_url)
        usable = usable_mentions(checked, ["file", "pos"], since, until, date_fallback)
        return upsert_fill(catalog, usable, created_at=created_at)

    return MentionRun(lists, mentions, upserted)
