"""Faults of the third review: one test or two for each."""

import json

import pytest
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall import session
from rollcall.checks import base, incremental
from rollcall.checks.jobs import _mention_inputs
from rollcall.functions import labels
from rollcall.operators import enrich, match, rawtext
from rollcall.plans import mentions, reports
from rollcall.sources import parts, splits


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_the_driver_builds_counts_for_a_broadcast(spark):
    rows = spark.range(700_000).select(F.lpad(F.col("id").cast("string"), 40, "x").alias("key"))
    assert not session.measured(rows, "keys")[2]  # 28 MB of text, twice that as a table with its keys


def test_what_is_not_small_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    rows = spark.range(50).withColumnRenamed("id", "key")
    joined = rows.join(session.broadcast_if_small(rows, "keys"), "key")
    assert "BroadcastHashJoin" not in plan_of(joined) and joined.count() == 50


def test_raw_files_are_joined_without_a_broadcast_of_their_names(spark):
    texts = [("a", "Code Arena\nChat Arena\n1\nc\nm\nc\nx\t9\nOpen Source"), ("b", "Version Timeline\nno block"), ("c", "a name\nof a line"), ("d", None)]
    found = rawtext.parse_raw(spark.createDataFrame(texts, "file string, text string"))
    assert "BroadcastHashJoin" not in plan_of(found)
    assert sorted((r["file"], r["kind"], r["model"]) for r in found.collect()) == [("a", "code_chat", "m"), ("b", "mined", None), ("c", "mined", None)]


@pytest.mark.parametrize("early_stop", [False, True])
def test_a_registry_that_repeats_an_id_gives_one_row(spark, early_stop):
    rows = spark.createDataFrame([(1, "m", "c", S.OPEN, "", "")], "row_id int, name string, company string, openness string, size string, verification string")
    entries = [("m", n * 10**9, ["license:mit"], "text", False) for n in (3, 2, 3)]
    registry = spark.createDataFrame(entries, "repo_id string, params_total bigint, tags array<string>, pipeline_tag string, login_required boolean")
    got = enrich.enrich_by_candidates(rows, registry.repartition(3), early_stop=early_stop).collect()
    assert [r["size"] for r in got] == ["2B"]


def test_sizes_of_a_thousand_billions_and_more(spark):
    got = spark.createDataFrame([(999 * 10**9,), (10**12,)], "n bigint").select(labels.size_label("n")).collect()
    assert [r[0] for r in got] == ["999B", "1T"]


def test_tables_of_a_leaderboard_read_the_records_once(spark, tmp_path):
    rows = [(1, "a", "o", "2024-06-01", None, True, 0.5, 8), (2, "b", "o", None, None, False, None, None)]
    path = f"{tmp_path}/records"
    spark.createDataFrame(rows, "pos int, name string, organization string, announcement_date string, release_date string, is_open boolean, gpqa_score double, context bigint").write.parquet(path)
    tables = reports.leaderboard_tables(spark.read.parquet(path), "2024-06-30")
    assert not [f for f in tables.inputFiles() if f"{tmp_path}/records" in f]
    assert {(r["section"], r["key"]) for r in tables.collect()} >= {("recent", "a"), ("open_top", "a"), ("organizations", "o")}


def test_long_splits_are_spread_by_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(base, "SPLIT_ROWS", 50)
    spark.range(500).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spread = base.table(spark, str(tmp_path), "part", spread=True)
    assert spread.rdd.getNumPartitions() == 10 and spread.distinct().count() == 500


def test_blocks_are_cut_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(splits, "STRETCH_BITS", 3)
    rows = [{"id": str(i), "t": '}{"[' * (i % 3), "in": {"n": [i]}} for i in range(100)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    pieces = splits.read_pieces(spark, str(tmp_path))
    assert pieces.groupBy("path", "stretch").count().agg(F.max("count")).first()[0] <= 8
    found = splits.read_large_records(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r["record"]["id"] for r in found] == [r["id"] for r in rows] and [r["pos"] for r in found] == list(range(100))


def test_parts_do_not_grow_in_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "MOST_PARTS", 20)
    path = f"{tmp_path}/parts"
    rows = spark.range(1000).select(F.col("id").alias("row_id"), F.lit("old").alias("v"))
    parts.write_parts(rows, path, part_rows=1)
    assert len(parts._stored_parts(spark, path)) <= 20
    changed = spark.createDataFrame([(3, "new"), (1500, "new")], "row_id bigint, v string")
    update = parts.upsert_parts(spark, path, changed, part_rows=1, removed=rows.filter("row_id = 7"))
    assert update.parts == [0, 1500 // 64]
    got = {r["row_id"]: r["v"] for r in parts.read_parts(spark, path).collect()}
    assert got == {i: "old" for i in range(1000) if i != 7} | {3: "new", 1500: "new"}
    parts.write_parts(rows.filter("row_id < 5"), path, part_rows=1)  # other parts, and none of the old ones
    assert sorted(r["row_id"] for r in parts.read_parts(spark, path).collect()) == [0, 1, 2, 3, 4]


def test_short_passages_need_no_character_runs(spark, monkeypatch):
    monkeypatch.setattr(match, "_grams", None)
    texts = {1: "xalpha beta gammay", 2: "alpha  beta", 3: "a\talpha beta\n", 4: "alphabet", 5: "one two three four five six"}
    passages = {10: "alpha beta", 11: "alpha", 12: "beta gamma", 13: "alpha  beta", 14: "two three four five six", 15: "alpha"}
    got = match.passages_in_texts(
        spark.createDataFrame(list(texts.items()), "doc int, text string"),
        spark.createDataFrame(list(passages.items()), "item int, text string"), "doc", "item",
    )
    assert sorted(tuple(r) for r in got.collect()) == sorted((d, i) for d, t in texts.items() for i, p in passages.items() if p in t)


def test_blank_passages_are_found(spark):
    got = match.passages_in_texts(
        spark.createDataFrame([(1, "a      b"), (2, "a b")], "doc int, text string"),
        spark.createDataFrame([(10, "     ")], "item int, text string"), "doc", "item",
    )
    assert [tuple(r) for r in got.collect()] == [(1, 10)]


def test_an_arrival_of_many_files_is_one_batch(spark, monkeypatch):
    monkeypatch.setattr(incremental, "ARRIVAL_ROWS", 100)
    rows = incremental.arrivals_stored(spark, "/root/testdata/sf0.001")
    sf = "/root/testdata/sf0.001"
    customers = spark.read.parquet(f"{sf}/customer.parquet").filter("c_acctbal < 8000")
    ordered = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_custkey").alias("c_custkey")).distinct()
    want = customers.join(ordered, "c_custkey").select("c_name").distinct().count()
    assert [r["stored"] for r in rows.collect()] == [1] * want


def test_article_lists_need_no_catalog(spark, monkeypatch):
    monkeypatch.setattr(mentions, "cross_verify", None)
    docs, replies, catalog, records = _mention_inputs(spark, "/root/testdata/sf0.001")
    run = mentions.mention_run(docs, replies, catalog, records, 20240103, 20240110, "2024-01-31", "http://example.com")
    assert run.articles.count() > 0
    with pytest.raises(TypeError):
        run.catalog  # made when it is asked for
