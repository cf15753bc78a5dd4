import json
import os

from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.session import broadcast_if_small, materialize, shared_dir
from rollcall.sources import readers as R
from rollcall.sources import writers as W


def test_articles(spark, tmp_path):
    rule = "=" * 80
    body = "x" * 50
    made = {
        "01.txt": f"标题: 速递 标题: 20260416 \n链接: http://a\n序号: 7\n序号: x\n{rule}\n\n  {body}\n序号: 9\n",
        "02.txt": f"标题: no date\n序号: x\n{rule}\n{body}",
        "03.txt": f"标题: short 20260416\n{rule}\n{'x' * 49}  ",
        "04.txt": f"标题: no rule 20260416\n{body}",
    }
    for name, text in made.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = {r["file"]: r for r in R.read_articles(spark, str(tmp_path)).collect()}
    assert set(got) == {"01.txt", "02.txt"}
    a = got["01.txt"]
    assert (a["seq"], a["title"], a["link"], a["date_int"]) == (7, "速递 标题: 20260416", "http://a", 20260416)
    assert a["body"] == body + "\n序号: 9"
    assert (got["02.txt"]["seq"], got["02.txt"]["date_int"], got["02.txt"]["link"]) == (0, 0, "")


def test_records_and_arena(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.json").write_text('[{"model_id": "a", "n": 1.5, "f": null, "l": ["x"]}, {"model_id": "b"}]')
    got = R.read_records(spark, str(tmp_path / "r")).orderBy("pos").collect()
    assert [r["record"] for r in got] == [{"model_id": "a", "n": "1.5", "f": None, "l": '["x"]'}, {"model_id": "b"}]
    arena = tmp_path / "arena"
    arena.mkdir()
    entry = {"model_id": "m", "matches_played": 3, "win_rate": 50, "extra": {}}
    shapes = {"list": [entry, entry], "wrap": {"leaderboard": [entry]}, "other": {"rows": [entry]}, "empty": []}
    for k, v in shapes.items():
        (arena / k).write_text(json.dumps(v))
    (arena / "bad").write_text("{oops")
    tags = spark.createDataFrame([(k, "cat", k) for k in [*shapes, "bad"]], "file string, category string, subcategory string")
    got = R.read_arena(spark, str(arena), tags)
    assert {r["subcategory"]: r["count"] for r in got.groupBy("subcategory").count().collect()} == {"list": 2, "wrap": 1}
    assert got.columns == ["category", "subcategory", *S.ARENA.fieldNames()]


def test_pages(spark, tmp_path):
    for d, names in (("new", ["a", "b"]), ("old", ["b", "c"])):
        (tmp_path / d).mkdir()
        for n in names:
            (tmp_path / d / n).write_text(f"{d} {n}")
    got = R.read_pages(spark, str(tmp_path / "new"), str(tmp_path / "old"))
    assert {r["page"]: (r["html"], r["origin"]) for r in got.collect()} == {
        "a": ("new a", "fresh"), "b": ("new b", "fresh"), "c": ("old c", "cached"),
    }


def test_catalog_snapshots(spark, tmp_path):
    table = str(tmp_path / "catalog")
    rows = lambda *names: spark.createDataFrame([(n, "c") for n in names], "name string, company string")
    W.roll_snapshot(rows("a"), table, "2024-01-01")
    W.roll_snapshot(rows("a", "b"), table, "2024-01-02")
    W.roll_snapshot(rows("x"), table, "2024-01-02")
    names = lambda df: sorted(r["name"] for r in df.collect())
    assert names(R.read_catalog(spark, table, "2024-01-01", ["name"])) == ["a"]
    assert names(R.read_catalog(spark, table, "2024-01-02", ["name"])) == ["x"]
    assert names(W.previous_snapshot(spark, table, "2024-01-02")) == ["a"]
    plan = R.read_catalog(spark, table, "2024-01-01", ["name"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "ReadSchema: struct<name:string>" in plan
    csv = str(tmp_path / "c.csv")
    with open(csv, "w") as f:
        f.write(",".join(S.CATALOG_COLUMNS) + "\n" + ",".join(["n"] + [""] * 15) + "\n")
    assert R.read_catalog(spark, csv).first()["name"] == "n"


def test_append_and_index(spark):
    old = spark.createDataFrame([("a", "x")], "name string, other string")
    new = spark.createDataFrame([("c", "b")], "company string, name string")
    both = W.append_catalog(old, new)
    assert both.columns == S.CATALOG_COLUMNS
    assert {(r["name"], r["company"]) for r in both.collect()} == {("a", None), ("b", "c")}
    index = spark.createDataFrame([(5, "t1"), (9, None)], "seq long, title string")
    schema = "pos long, title string, body string, link string, published string"
    fresh = [(3, "t3", None, "l", "2024"), (1, "t1", "b", "l", ""), (2, "t2", "long enough line", "l", "20240102")]
    got = W.sync_article_index(index, spark.createDataFrame(fresh, schema), "pos").orderBy("seq").collect()
    assert [(r["seq"], r["title"], r["summary"], r["published"]) for r in got] == [
        (10, "t2", "long enough line", "2024.01.02"), (11, "t3", "", "2024"),
    ]
    assert got[0].asDict().keys() == set(S.ARTICLE_INDEX.fieldNames())
    first = W.sync_article_index(index.limit(0), spark.createDataFrame(fresh[:1], schema), "pos").first()
    assert first["seq"] == 1


def test_new_articles(spark):
    schema = "pos int, seq int, title string, body string"
    data = [(1, 1, "A/b?\nrest", "text"), (2, 2, "B", "[爬取失败] x"), (3, 3, "C", None), (4, 12, "D", "text"), (5, 123, "E", "t"),
            (6, 4, "F", "t"), (7, 5, None, "none")]
    data += [(10 + i, 7, t, f"body {i}") for i, t in enumerate(["GPT: 4", "GPT 4", "GPT: 4", "GPT 4\nsecond", "x" * 80 + "a", "x" * 80 + "b"])]
    stored = spark.createDataFrame([(4, "F"), (4, "F"), (9, None)], "seq int, title string")
    for parts in (1, 5):
        got = W.new_articles(spark.createDataFrame(data, schema).repartition(parts), stored, "pos").collect()
        assert sorted(r["article_key"] for r in got if r["pos"] < 7) == ["01_Ab", "123_E", "12_D"]
        assert sorted(r["pos"] for r in got) == [1, 4, 5, 7, 10, 11, 13, 14, 15]


def test_new_articles_keep_bodies_in_place(spark):
    rows = spark.createDataFrame([(1, 1, "a", "body")], "pos int, seq int, title string, body string")
    plan = W.new_articles(rows, rows.limit(0), "pos")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_damaged_record_files(spark):
    files = spark.createDataFrame(
        [("whole", '[{"a":"1"},{"b":"x"}]'), ("cut", '[{"a":"1"},{"b":"2"},{"c":'), ("mixed", '[{"a":"1"}, 5, "{}", {"b":null}]'), ("none", "oops")],
        "file string, text string",
    )
    got = sorted((r["file"], r["pos"], r["record"]) for r in R.parse_records(files).collect())
    assert got == [("cut", 0, {"a": "1"}), ("cut", 1, {"b": "2"}), ("mixed", 0, {"a": "1"}), ("mixed", 1, {"b": None}),
                   ("whole", 0, {"a": "1"}), ("whole", 1, {"b": "x"})]
    assert sorted(map(tuple, R.damaged_files(files).collect())) == [("cut", 2), ("mixed", 2), ("none", 0)]


def test_shared_folder(spark, shared):
    assert shared_dir(spark) == shared
    before = len(os.listdir(shared))
    df = materialize(spark.range(5).withColumn("s", F.lit("x")), "t")
    assert df.count() == 5 and len(os.listdir(shared)) == before + 1
    small = broadcast_if_small(spark.range(10), "s")
    plan = spark.range(100).join(small, "id")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_large_side_is_not_broadcast(spark, monkeypatch):
    import rollcall.session as session

    monkeypatch.setattr(session, "BROADCAST_ROWS", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = session.broadcast_if_small(spark.range(10), "s")
        plan = spark.range(100).join(large, "id")._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "out")
    W.write_records(spark.createDataFrame([("a", None), ("b", "x")], "name string, size string"), path)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ['{"name":"a"}', '{"name":"b","size":"x"}']
