"""One array over many splits, wherever they fall."""

import json
import random

import pytest

from rollcall.sources import readers as R
from rollcall.sources.splits import read_large_records
from tests.test_jsontext import by_hand, flat, some_array


def test_any_split_gives_the_same_records(spark, tmp_path):
    rng = random.Random(12)
    texts = {
        "a.json": some_array(rng, 9), "b.json": some_array(rng, 40)[:-30], "c.json": '{"a":1}\n{"b":{"c":"}{"}}',
        "d.json": '[{"x":"\\\\"},{"y":"\\"}"},{"z":"{[\\\\\\""}, "{}", [{"w":1}], {"v":{"u":[{}]}}]', "e.json": "", "f.json": "[]",
        "g.json": '[{"cut":1},{"off":{"in":2}', "h.json": '{"a":1}{"a":2', "i.json": "no records } here",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want = {name: [flat(json.loads(o)) for o in by_hand(text)] for name, text in texts.items()}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for size in (1, 7, 200):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            few = {1: ["g.json", "h.json"], 7: ["c.json", "d.json"]}.get(size, texts)
            names = [str(tmp_path / n) for n in few]
            got = {}
            for r in sorted(read_large_records(spark, names).collect(), key=lambda r: r["pos"]):
                got.setdefault(r["file"], []).append((r["pos"], r["record"]))
            for name in {n.rsplit("/", 1)[1] for n in names}:
                found = got.get(name, [])
                assert [p for p, _ in found] == list(range(len(want[name]))), (name, size)
                assert [{k: _plain(v) for k, v in r.items()} for _, r in found] == [
                    {k: _plain(v) for k, v in r.items()} for r in want[name]
                ], (name, size)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def _plain(v):
    try:
        return json.loads(v)
    except (TypeError, ValueError):
        return v


def test_a_large_array_is_many_tasks_work(spark, tmp_path):
    path = tmp_path / "large.json"
    with open(path, "w") as out:
        out.write("[")
        for i in range(20_000):
            out.write(("," if i else "") + json.dumps({"id": i, "t": "}{" * (i % 7) + '"\\' * (i % 3), "in": {"k": [i]}}))
        out.write("]")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 10
        split = read_large_records(spark, str(path))
        whole = R.read_records(spark, str(path))
        rows = lambda df: sorted((r["pos"], sorted(r["record"].items())) for r in df.collect())
        assert rows(split) == rows(whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep[0])
        spark.conf.set("spark.sql.files.openCostInBytes", keep[1])
