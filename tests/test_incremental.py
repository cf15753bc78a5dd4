"""Merge states, kept counts, parts and arrivals against doing the whole anew."""

import random
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from rollcall.operators import enrich
from rollcall.operators import maintain as K
from rollcall.operators import merge as M
from rollcall.operators import merge_state as MS
from rollcall.operators import stats
from rollcall.session import scratch_path
from rollcall.sources import parts as P
from rollcall.streaming import arrivals as A

TAGS = ["a", "b", "c"]
STACKED = "id string, _prio int, pos bigint, text string, size double, day string"
FIELDS = ["text", "size", "day"]


def text_rows(df):
    return sorted(map(str, df.collect()))


def some_records(rng, n):
    return [
        (
            rng.choice(["x", "y", "z", "w", "", None]), rng.randrange(4), i, rng.choice([None, "$undefined", f"t{i}", "a"]),
            rng.choice([None, float(i)]), rng.choice([None, f"d{i}"]),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("base", ["first", "last"])
def test_batches_in_any_order_equal_one_merge(spark, base):
    rng = random.Random(3)
    rows = some_records(rng, 80)
    frame = lambda part: spark.createDataFrame(part, STACKED)
    want = text_rows(M.merge_records(frame(rows), TAGS, "id", FIELDS, base=base))
    for _ in range(2):
        rng.shuffle(rows)
        cuts = sorted(rng.sample(range(len(rows)), 3))
        parts = [rows[i:j] for i, j in zip([0, *cuts], [*cuts, len(rows)])]
        states = [MS.batch_state(frame(p), TAGS, "id", FIELDS, base=base) for p in parts]
        one_by_one = states[0]
        for s in states[1:]:
            one_by_one = MS.combine_states(one_by_one, s)
        tree = MS.combine_states(MS.combine_states(states[3], states[1]), MS.combine_states(states[2], states[0]))
        for state in (one_by_one, tree, MS.combine_states(*states)):
            assert text_rows(MS.state_rows(state, TAGS)) == want
    # what a second merge of a batch may not change: values and first places
    again = MS.state_rows(MS.combine_states(*states, states[0]), TAGS)
    once = MS.state_rows(MS.combine_states(*states), TAGS)
    assert text_rows(again.drop("sources")) == text_rows(once.drop("sources"))


ROW = "row_id bigint, org string, kind string, is_open boolean, size string"


def some_row(rng, i):
    return (i, rng.choice(["o1", "o2", None]), rng.choice([" k1", "k2", None]), rng.random() < 0.5, rng.choice([None, "", "7B", "nan"]))


def test_counts_follow_ten_updates(spark):
    rng = random.Random(9)
    rows = {i: some_row(rng, i) for i in range(300)}
    path = scratch_path(spark, "parts")
    P.write_parts(spark.createDataFrame(list(rows.values()), ROW), path, part_rows=25)
    is_open, recent = F.col("is_open"), F.col("size") == "7B"
    columns = ["org", "size"]

    def counted(df):
        cover = stats.coverage(df, columns, "text_not_nan").select("field", "filled", "total").collect()
        whole = [(None, cover[0]["total"])] + [(r["field"], r["filled"]) for r in cover]
        return {
            "dims": stats.dim_counts(df, ["org", "kind"], is_open),
            "orgs": stats.org_stats(df, "org", is_open, recent),
            "kinds": df.groupBy(F.coalesce("org", F.lit("unknown")).alias("org"), "kind").agg(F.count("*").alias("n")),
            "cover": spark.createDataFrame(whole, "field string, filled bigint"),
        }

    kept = counted(P.read_parts(spark, path))
    kept = {k: spark.createDataFrame(df.collect(), df.schema) for k, df in kept.items()}
    for step in range(10):
        ids = rng.sample(range(330), 4)
        new = [some_row(rng, i) for i in ids]
        gone = rng.sample(sorted(set(rows) - set(ids)), 2)
        before = {f: f.stat().st_mtime_ns for f in _files(path)}
        update = P.upsert_parts(
            spark, path, spark.createDataFrame(new, ROW), part_rows=25,
            removed=spark.createDataFrame([(i,) for i in gone], "row_id bigint"),
        )
        rows.update({r[0]: r for r in new})
        for i in gone:
            rows.pop(i)
        assert len(update.parts) <= 8
        kept_files = {f for f in before if int(f.parent.name.split("=")[1]) not in update.parts}
        assert kept_files <= set(_files(path)) and all(f.stat().st_mtime_ns == before[f] for f in kept_files)
        assert sorted(map(tuple, P.read_parts(spark, path).select("row_id").collect())) == [(i,) for i in sorted(rows)]
        change = {
            "dims": (K.dim_changes(update.deltas, ["org", "kind"], is_open), ["dim", "value"], ["n"]),
            "orgs": (K.org_changes(update.deltas, "org", is_open, recent), ["org"], ["total", "open", "recent"]),
            "kinds": (K.category_changes(update.deltas, "org", "kind"), ["org", "kind"], ["n"]),
            "cover": (K.coverage_changes(update.deltas, columns, "text_not_nan"), ["field"], ["filled"]),
        }
        for k, (delta, keys, numbers) in change.items():
            now = K.add_up(kept[k], delta, keys, numbers)
            kept[k] = spark.createDataFrame(now.collect(), now.schema)
        if step in (4, 9):
            whole = spark.createDataFrame(list(rows.values()), ROW)
            for k, df in counted(whole).items():
                assert text_rows(kept[k].select(*df.columns)) == text_rows(df.filter("filled <> 0") if k == "cover" else df), k
            table = K.coverage_table(kept["cover"], columns)
            assert text_rows(table) == text_rows(stats.coverage(whole, columns, "text_not_nan"))
            lists = K.category_lists(kept["kinds"], "org", "kind")
            assert text_rows(lists) == text_rows(stats.org_categories(whole, "org", "kind"))


def _files(path):
    from pathlib import Path

    return sorted(Path(path.replace("file:", "")).glob("_part=*/*.parquet"))


def test_an_update_said_twice_changes_nothing_more(spark):
    rows = spark.createDataFrame([(i, "o", "k", True, None) for i in range(100)], ROW)
    path = scratch_path(spark, "parts")
    P.write_parts(rows, path, part_rows=10)
    change = spark.createDataFrame([(5, "new", None, False, "x"), (205, "new", None, False, "x")], ROW)
    gone = spark.createDataFrame([(i,) for i in range(30, 40)], "row_id bigint")
    for _ in range(2):
        assert P.upsert_parts(spark, path, change, part_rows=10, removed=gone).parts == [0, 3, 20]
        got = {r["row_id"]: r["org"] for r in P.read_parts(spark, path).collect()}
        assert set(got) == set(range(100)) - set(range(30, 40)) | {205} and got[5] == got[205] == "new"


def test_row_deltas_of_whole_snapshots(spark):
    schema = "id int, v string"
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], schema)
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (4, None), (4, None)], schema)
    got = {tuple(r) for r in K.row_deltas(new, old).collect()}
    assert got == {(1, "a", -1), (3, "c", -1), (3, "d", 1), (4, None, 2)}


def write(spark, folder, rows):
    spark.createDataFrame(rows, "name string, pos bigint").coalesce(1).write.mode("append").parquet(folder)


def test_a_broken_batch_is_repeated_and_each_row_stored_once(spark):
    base = scratch_path(spark, "arrivals")
    schema = spark.createDataFrame([], "name string, pos bigint").schema
    known = spark.createDataFrame([("Known",)], "name string")
    folder, table, checkpoint = f"{base}/in", f"{base}/stored", f"{base}/checkpoint"
    run = lambda each=None: A.run_arrivals(
        spark, folder, schema, table, checkpoint, ["pos"], known=known, files_a_batch=1, each=each
    )
    stored = lambda: sorted((r["name"], r["pos"]) for r in A.stored_rows(spark, table, schema).collect())
    write(spark, folder, [("x", 1), (" X ", 0), ("known", 2), ("", 3), (None, 4), ("y", 5)])
    run()
    assert stored() == [(" X ", 0), ("y", 5)]
    write(spark, folder, [("y", 6), ("z", 7), ("z", 8)])

    def killed(batch, number):
        A.store_new(batch, number, table, ["pos"], known=known)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        run(killed)
    run()
    assert stored() == [(" X ", 0), ("y", 5), ("z", 7)]
    run()  # nothing new
    write(spark, folder, [("w", 9)])
    run()
    assert stored() == [(" X ", 0), ("w", 9), ("y", 5), ("z", 7)]
    assert A.stored_rows(spark, f"{base}/none-{uuid4().hex}", schema).count() == 0


def test_rounds_ask_less_each_time(spark, monkeypatch):
    rng = random.Random(4)
    ids = [(i, [f"r{rng.randrange(60)}" for _ in range(rng.randrange(7))]) for i in range(200)]
    registry = spark.createDataFrame([(f"r{i}", i) for i in range(40)], "repo_id string, n int")
    asked = []
    measure = enrich.broadcast_if_small

    def watched(df, label):
        if label == "asked":
            asked.append(df.count())
        return measure(df, label)

    monkeypatch.setattr(enrich, "broadcast_if_small", watched)
    hits = enrich.hits_in_rounds(spark.createDataFrame(ids, "row_id int, _ids array<string>"), registry, "row_id")
    known = {f"r{i}" for i in range(40)}
    want = {i: next(c for c in row if c in known) for i, row in ids if known & set(row)}
    assert {r["row_id"]: r["_hit"]["repo_id"] for r in hits.collect()} == want
    assert asked == sorted(asked, reverse=True) and sum(asked) < sum(len(row) for _, row in ids)
    none = spark.createDataFrame([], "row_id int, _ids array<string>")
    assert enrich.hits_in_rounds(none, registry, "row_id").count() == 0
