"""Objects out of whole, cut and broken JSON text, against a reader that goes sign by sign."""

import json
import random

from pyspark.sql import functions as F

from rollcall.operators import extract as X
from rollcall.operators import jsontext as J
from rollcall.sources import readers as R

SIGNS = ['"', "\\", "{", "}", "[", "]", ",", ":", "é", "\n", " ", "a", "漢", "😀", " "]


def some_value(rng, depth):
    kind = rng.randrange(7 if depth else 4)
    if kind == 0:
        return rng.choice([None, True, 5, -1.5])
    if kind < 4:
        return "".join(rng.choices(SIGNS, k=rng.randrange(6)))
    if kind == 4:
        return [some_value(rng, depth - 1) for _ in range(rng.randrange(3))]
    return {f"k{i}": some_value(rng, depth - 1) for i in range(rng.randrange(4))}


def some_array(rng, n):
    values = [some_value(rng, 3) if rng.random() < 0.3 else {"id": i, "v": some_value(rng, 2)} for i in range(n)]
    return json.dumps(values, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))


def by_hand(text):
    """Objects that begin and end at depth 1 of an array, or at depth 0 without one."""
    base = 1 if text.lstrip(" \n\r\t").startswith("[") else 0
    depth, inside, escaped, start, found = 0, False, False, None, []
    for i, c in enumerate(text):
        if escaped:
            escaped = False
        elif c == "\\":
            escaped = True
        elif c == '"':
            inside = not inside
        elif not inside and c in "{[":
            if c == "{" and depth == base:
                start = i
            depth += 1
        elif not inside and c in "}]":
            depth -= 1
            if c == "}" and depth == base:
                found.append(text[start : i + 1])
    return found


def flat(record):
    text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
    return {k: text(v) for k, v in record.items()}


def loads(v):
    try:
        return json.loads(v)
    except (TypeError, ValueError):
        return v


def test_objects_of_cut_arrays(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(120):
        text = some_array(rng, rng.randrange(8))
        texts += [text, text[: rng.randrange(len(text) + 1)]]
    texts += ["", "[]", "{}", "}", "[}", '["{}"]', "no array", '{"a":1}{"b":{"c":2}} {"d"', some_array(rng, 900)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r["o"] for r in df.select("i", J.object_texts(F.col("text")).alias("o")).collect()}
    for i, text in enumerate(texts):
        assert [json.loads(o) for o in got[i]] == [json.loads(o) for o in by_hand(text)], text


def test_records_take_the_last_of_a_repeated_key(spark):
    df = spark.createDataFrame([('{"a":1,"b":{"x":1,"x":2},"a":null,"a":"3"}',), ("{}",), ("oops",), (None,)], "t string")
    got = [r[0] for r in df.select(J.record(F.col("t"))).collect()]
    assert got == [{"a": "3", "b": '{"x":1,"x":2}'}, {}, None, None]


def test_files_and_replies(spark):
    files = {
        "whole": '[{"x":{"y":1}},{"x":2}]', "cut": '[{"x":{"y":1}},{"x":2},{"x":{"z":3}', "twice": '[{"x":1,"x":5}]',
        "mixed": '[[{"x":0}],"{}",{"x":[{"w":1}]}]', "lines": '{"x":1}\n{"x":2}', "not": "nothing", "null": None,
    }
    df = spark.createDataFrame(list(files.items()), "file string, text string")
    got = {}
    for r in R.parse_records(df).orderBy("file", "pos").collect():
        got.setdefault(r["file"], []).append(r["record"]["x"])
    assert got == {
        "whole": ['{"y":1}', "2"], "cut": ['{"y":1}', "2"], "twice": ["5"], "mixed": ['[{"w":1}]'], "lines": ["1", "2"],
    }
    reply = 'x ["{\\"name\\":\\"ghost\\"}", "\\u007b\\"name\\":\\"ghost\\"}", {"name":"real","name":"real2"}, {"name": "b"}] y'
    df = spark.createDataFrame([(reply,), ("no array",), ('[{"name":"a"},]',)], "c string")
    got = [r[0] for r in df.select(X.reply_objects("c")).collect()]
    assert got == [[{"name": "real2"}, {"name": "b"}], None, None]
