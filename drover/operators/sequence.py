"""Sequence numbers over runs of equal group values and inside groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from drover.operators.chunks import ROWS_PER_CHUNK, names
from drover.operators.scans import number_rows


def number_runs(
    df: DataFrame,
    group_by: str | Sequence[str],
    order_by: str | Sequence[str],
    name: str,
    changing: str | Sequence[str] | None = None,
    base: int = 10,
    step: int = 10,
    hold: bool = False,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Number rows along `order_by`, starting again at `base` on each new run.

    Without `changing`, a run is a stretch of rows with equal group values.
    With it, a row goes on by `step` only if the group stays the same and the
    changing values differ from the row before; otherwise it is back at `base`.
    `hold` keeps the number, in place of restarting, while the changing values
    stay the same. NULL equals NULL in all comparisons.
    """
    if hold and changing is None:
        raise ValueError("hold needs changing columns")
    return number_rows(
        df,
        names(group_by),
        order_by,
        name,
        names(changing) if changing is not None else (),
        base,
        step,
        hold,
        rows_per_chunk,
    )


def number_groups(
    df: DataFrame,
    group_by: str | Sequence[str],
    order_by: str | Sequence[str],
    name: str,
    base: int = 10,
    step: int = 10,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Sort by group and `order_by`, then number each group from `base` by `step`."""
    group, order = names(group_by), names(order_by)
    return number_rows(df, group, group + order, name, (), base, step, rows_per_chunk=rows_per_chunk)
