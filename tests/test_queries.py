"""Every registered query against its SQL, and rules for its plan."""

import os
import re
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
from rollcall import checks  # noqa: E402
from tools.verify import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = checks.QUERIES, checks.ORACLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


@pytest.fixture
def plans(monkeypatch):
    """Plans of all written sub-results, beside the one of the query itself."""
    import rollcall.session as session

    seen, write = [], session.materialize

    def watched(df, label):
        seen.append(df._jdf.queryExecution().toString())
        return write(df, label)

    for module in [m for n, m in sys.modules.items() if n.startswith("rollcall.") and getattr(m, "materialize", None) is write]:
        monkeypatch.setattr(module, "materialize", watched)
    return seen


def rows_in_one_task(plan):
    """Windows without a partition key whose input is neither an aggregate nor cut by a limit."""
    lines = plan[plan.find("== Physical Plan ==") :].split("\n")
    found = []
    for at, line in enumerate(lines):
        keyless = re.search(r" Window \[.*\), [^\[]*\[", line) is None and re.search(r" Window \[.*AS \w+#\d+L?\], \[[^\]]*\]$", line)
        below = lines[at + 1 : at + 12]
        if keyless and not any(re.search("Aggregate|TakeOrdered|Limit", x) for x in below):
            found.append(line.strip())
    return found


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, plans, name):
    df = QUERIES[name](spark, SF)
    for plan in [*plans, df._jdf.queryExecution().toString()]:
        for node in BANNED:
            assert node not in plan
        assert not rows_in_one_task(plan)
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    want = rows_of(columns, cur.fetchall())
    assert rows_of(df.columns, df.collect()) == want


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
