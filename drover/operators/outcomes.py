"""What a change does to a target, row by row, told from the target's own rows.

Each function returns the incoming rows with `RESULTS_*` columns. A row succeeds
if its key suits the operation and it breaks no rule; of rows that share a key
none does, because it would be unclear which one counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.operators import dml
from drover.operators.ordering import col, fresh
from drover.operators.quality import REASONS, tag_rejects
from drover.operators.reconcile import match_grouped, with_keys, without_keys
from drover.operators.submit import OPERATIONS, RESULT_PREFIX, SUCCESS
from drover.session import stage_counted

ERRORS = RESULT_PREFIX + "errors"


class Applied(NamedTuple):
    """Stored outcomes of every row, the target's next rows, and how many rows passed, failed and were created."""

    results: DataFrame
    state: DataFrame
    totals: dict[str, int]


def outcomes(
    operation: str,
    rows: DataFrame,
    target: DataFrame,
    key: str,
    rules: Sequence[Column] = (),
) -> DataFrame:
    """The rows with success, id, created and errors; `rules` are those of `quality.row_reasons`.

    An insert fails for a key that the target holds, an update or delete for one
    that it lacks; an upsert takes both and says which rows it created.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation: {operation}")
    listed, repeats, known = (fresh([*rows.columns, REASONS], n) for n in ("_listed", "_repeats", "_known"))
    found = _found_keys(rows, target, key, listed, repeats, known)
    flagged = rows.join(found, match_grouped([key], [listed]), "left").drop(listed)
    reasons = [*rules, F.when(col(key).isNull(), f"null:{key}"), F.when(col(repeats), "duplicate_key")]
    if operation == "insert":
        reasons.append(F.when(col(known), "key_exists"))
    elif operation != "upsert":
        reasons.append(F.when(col(key).isNotNull() & col(known).isNull(), "unknown_key"))
    tagged = tag_rejects(flagged, reasons)
    passed = F.size(REASONS) == 0
    created = {"insert": passed, "upsert": passed & col(known).isNull()}.get(operation, F.lit(False))
    return tagged.select(
        *[col(c) for c in rows.columns],
        passed.alias(SUCCESS),
        F.when(passed, col(key).cast("string")).alias(RESULT_PREFIX + "id"),
        created.alias(RESULT_PREFIX + "created"),
        F.when(~passed, F.array_join(F.array_sort(REASONS), ";")).alias(ERRORS),
    )


def _found_keys(
    rows: DataFrame, target: DataFrame, key: str, listed: str, repeats: str, known: str
) -> DataFrame:
    """Each key of the rows once, with whether it repeats there and whether the target holds it (else NULL).

    Both are told in one shuffle of the two sides' keys, folded before it.
    """
    asked = rows.select(col(key).alias(listed))
    held = target.select(col(key).alias(listed))
    if held.schema[listed].dataType != asked.schema[listed].dataType:
        # Keys of other types are compared as the join does it.
        held = with_keys(asked.distinct(), target, listed, key)
    n = fresh([listed, repeats, known], "_n")
    sides = asked.select(listed, F.lit(1).alias(n), F.lit(None).cast("boolean").alias(known)).unionByName(
        held.select(listed, F.lit(0).alias(n), F.lit(True).alias(known))
    )
    counted = sides.filter(col(listed).isNotNull()).groupBy(listed).agg(
        F.sum(n).alias(n), F.max(known).alias(known)
    )
    return counted.filter(col(n) > 0).select(listed, (col(n) > 1).alias(repeats), known)


def perform(
    operation: str,
    target: DataFrame,
    rows: DataFrame,
    key: str,
    rules: Sequence[Column] = (),
) -> Applied:
    """Outcomes of all rows, stored, and the target after the rows that succeeded.

    The totals are counted by the tasks that store the outcomes.
    """
    results, totals = stage_counted(
        outcomes(operation, rows, target, key, rules),
        f"{operation}-results",
        passed=col(SUCCESS),
        failed=~col(SUCCESS),
        created=col(RESULT_PREFIX + "created"),
    )
    accepted = results.filter(SUCCESS).select(*[col(c) for c in rows.columns])
    if operation == "insert":
        state = dml.append_rows(target, accepted)
    elif operation == "upsert":
        state = dml.upsert(target, accepted, key).drop(dml.CREATED)
    elif operation == "update":
        changed = [c for c in rows.columns if c != key]
        state = dml.keyed_update(target, accepted, key, changed, order_by=key)
    else:
        # No key is accepted twice.
        state = without_keys(target, accepted, key, unique=True)
    return Applied(results, state, totals)
