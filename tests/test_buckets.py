"""Snapshots in buckets: same rows as without, and no exchange above their scans."""

import re
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

import rollcall.session as session
from rollcall.functions.text import plain_key
from rollcall.operators import snapshots as D
from rollcall.operators import upsert as U
from rollcall.session import scratch_path
from rollcall.sources import buckets as B
from rollcall.sources import writers as W

CATALOG = (
    "row_id bigint, name string, company string, size string, released_at string, created_at string, is_new string, verification string"
)
INCOMING = "_key string, model_name string, company string, size string, release_date string"
FIELDS = {"company": "company", "size": "size"}


def rows_of(df):
    return sorted(map(str, df.collect()))


def moved_scans(df, table):
    """Exchanges that stand above a scan of the table, in the plan as it was made."""
    lines = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    lines = [x for x in lines.split("\n") if re.match(r"[ :]*[+:]- ", x)]  # names may hold line ends
    depth = lambda line: len(re.match(r"[ :]*[+:]- ", line).group())
    found = []
    for i, line in enumerate(lines):
        if not re.search(r"(?<!Broadcast)Exchange ", line):
            continue
        for below in lines[i + 1 :]:
            if below and depth(below) <= depth(line):
                break
            if table in below:
                found.append(line.strip())
    return found


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def catalog(spark, n, first=0):
    rows = [
        (i, None if i % 11 == 0 else f" Name {i % (n - 7)} ", None if i % 3 else "co", "", "2024-01-01", "x", None, "v")
        for i in range(first, first + n)
    ]
    return spark.createDataFrame(rows, CATALOG)


def test_diff_equals_the_shuffled_one(spark, no_aqe):
    old, new = catalog(spark, 120), catalog(spark, 150, 30)
    names = [f"t_{uuid4().hex}" for _ in range(2)]
    stored = [B.write_buckets(df, n, scratch_path(spark, "b"), buckets=8) for df, n in zip((new, old), names)]
    diff = D.diff_buckets(*stored)
    assert rows_of(diff) == rows_of(D.diff_snapshots(new, old))
    for n in names:
        assert not moved_scans(diff, n) and moved_scans(D.diff_snapshots(*stored), n)


@pytest.mark.parametrize("limit", [session.BROADCAST_ROWS, 0])
def test_upsert_equals_the_shuffled_one(spark, no_aqe, monkeypatch, limit):
    monkeypatch.setattr(session, "BROADCAST_ROWS", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if limit else "-1")
    rows = catalog(spark, 200)
    incoming = spark.createDataFrame(
        [(f"name {i}", f"Name {i}", f"c{i}", "9B" if i % 2 else " ", "2024-02-02") for i in range(0, 400, 3)], INCOMING
    )
    table = f"t_{uuid4().hex}"
    stored = B.write_buckets(rows, table, scratch_path(spark, "b"), plain_key("name"), buckets=8)
    done = U.upsert_buckets(stored, incoming, FIELDS, "today")
    want = U.upsert_fill(rows, incoming, FIELDS, "today")
    assert rows_of(done.select(*want.columns)) == rows_of(want)
    assert not moved_scans(done, table)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_later_session_opens_the_buckets(spark):
    rows, path, name = catalog(spark, 50), scratch_path(spark, "b"), f"t_{uuid4().hex}"
    B.write_buckets(rows, name, path, buckets=4)
    again = B.open_buckets(spark, f"{name}_again", path, rows.schema, buckets=4)
    assert rows_of(again.drop("_key").select(*rows.columns)) == rows_of(rows)
    assert again.filter(~B.has_key()).count() == rows.filter(F.col("name").isNull()).count()


def test_dates_come_from_the_folders(spark, tmp_path):
    rows, table = catalog(spark, 3), str(tmp_path / "t")
    for day in ("2024-01-01", "2024-01-15", "2024-01-08"):
        W.roll_snapshot(rows.withColumn("name", F.lit(day)), table, day)
    assert W.snapshot_dates(spark, table) == ["2024-01-01", "2024-01-08", "2024-01-15"]
    names = lambda before: {r["name"] for r in W.previous_snapshot(spark, table, before).collect()}
    assert names("2024-01-15") == {"2024-01-08"} and names("2024-01-01") == set()
    assert names("2025") == {"2024-01-15"}
