"""Every operator as a query over the test tables, most with SQL that gives the same rows."""

from __future__ import annotations

from drover.registry import changes, jobs, joins, rows
from drover.registry.base import Query

ALL: dict[str, Query] = {
    **rows.QUERIES,
    **joins.QUERIES,
    **changes.QUERIES,
    **jobs.QUERIES,
}
