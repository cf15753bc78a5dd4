"""Every operator as a query over the driver tables, with its SQL counterpart.

The tables have no catalog of their own, so each query renders the operator's
input from whole tables first: snapshots and sources are value ranges of a
table, raw texts and pages are composed from its rows and parsed back.
"""

from rollcall.checks.base import ORACLE, QUERIES  # noqa: F401
from rollcall.checks import (  # noqa: F401
    columns, extraction, filters, incremental, jobs, matching, merging, quality, reports, sources, upserts,
)
