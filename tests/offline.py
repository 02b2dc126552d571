"""A submitter for tests that checks rows in place of a remote service."""

import sys
from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from drover.operators.submit import OPERATIONS, Submitter

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def offline_submitter(
    id_column: str,
    required: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
    refuse: tuple[str, Sequence] | None = None,
    operation: str = "insert",
) -> Submitter:
    """A submitter that checks rows in place of a remote service.

    It fails rows that lack the id or a required column, hold text over a
    maximum length or a refused value, and echoes the id of the others.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation: {operation}")
    needed = tuple(dict.fromkeys([id_column, *required]))
    limits = dict(max_length or {})

    def check(batch: pa.Table) -> pa.Table:
        error = pa.nulls(batch.num_rows, pa.string())

        def note(broken, text):
            nonlocal error
            found = pc.and_(pc.fill_null(broken, False), pc.is_null(error))
            error = pc.if_else(found, text, error)

        for name in needed:
            note(pc.is_null(batch.column(name).combine_chunks()), f"REQUIRED_FIELD_MISSING: {name}")
        for name, limit in limits.items():
            length = pc.utf8_length(batch.column(name).combine_chunks())
            note(pc.greater(length, limit), f"STRING_TOO_LONG: {name}")
        if refuse is not None:
            name, values = refuse
            column = batch.column(name).combine_chunks()
            note(pc.is_in(column, pa.array(values, column.type)), f"REFUSED: {name}")
        passed = pc.is_null(error)
        ids = batch.column(id_column).combine_chunks().cast(pa.string())
        return pa.table(
            {
                "success": passed,
                "id": pc.if_else(passed, ids, pa.scalar(None, pa.string())),
                "created": pc.and_(passed, operation == "insert"),
                "errors": error,
            }
        )

    return check
