"""Updates, upserts and deletes as functions from a table's rows to its next rows.

Plain file tables refuse UPDATE and DELETE, so each operator returns the whole
next state for `drover.sinks.tables.publish` to commit. Table operators compare
keys as SQL does (NULL matches nothing); document operators match NULL to NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.operators.ordering import all_of, col, fresh, names, rank_in_group
from drover.operators.reconcile import (
    CardinalityError,
    last_per_key,
    match_grouped,
    null_safe,
    repeated_keys,
    without_keys,
)

CREATED = "RESULTS_created"


def _last_changes(changes: DataFrame, key: str, columns: Sequence[str], order_by) -> DataFrame:
    """One row of changes per key: the last in `order_by`, or the only one if none is given."""
    if order_by is not None:
        return last_per_key(changes, key, order_by, columns)
    repeated = repeated_keys(changes, key).limit(1).collect()
    if repeated:
        raise CardinalityError(f"changes repeat a key, so they need order_by: {repeated[0]}")
    return changes.select(col(key), *[col(c) for c in columns])


def keyed_update(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    columns: Sequence[str],
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Set `columns` of every target row whose key is in `changes`.

    A NULL in `changes` overwrites. Keys without a target row do nothing. If a
    key comes several times its last row in `order_by` wins.
    """
    _require_columns(target, [key, *columns])
    present = changes.filter(col(key).isNotNull())
    return _overwrite(target, _last_changes(present, key, columns, order_by), key, columns)


def _require_columns(target: DataFrame, columns: Sequence[str]) -> None:
    unknown = [c for c in columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")


def _overwrite(
    target: DataFrame, latest: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """`latest` holds each key once."""
    incoming = latest.select(
        col(key).alias("_key"),
        F.lit(True).alias("_found"),
        *[col(c).alias(f"_new{i}") for i, c in enumerate(columns)],
    )
    joined = target.join(incoming, match_grouped([key], ["_key"]), "left")
    return joined.select(
        *[
            F.when(F.col("_found"), F.col(f"_new{columns.index(f.name)}").cast(f.dataType))
            .otherwise(col(f.name))
            .alias(f.name)
            if f.name in columns
            else col(f.name)
            for f in target.schema.fields
        ]
    )


def update_first_document(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    target_order: str | Sequence[str],
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Set all columns of `changes` but the key on the first target document of each key.

    `target_order` is unique within a key and says which document is first.
    Columns that the target lacks are added. A NULL key finds the first
    document without one.
    """
    order = names(target_order)
    fields = [c for c in changes.columns if c != key]
    latest = _last_changes(changes, key, fields, order_by)
    firsts = target.groupBy(col(key).alias("_key")).agg(
        F.min(F.struct(*[col(c) for c in order])).alias("_first")
    )
    # The join key holds the position, so copies of a hot key spread out.
    incoming = latest.join(firsts, col(key).eqNullSafe(F.col("_key")), "inner").select(
        "_key",
        *[F.col("_first").getField(c).alias(f"_at{i}") for i, c in enumerate(order)],
        F.lit(True).alias("_found"),
        *[col(c).alias(f"_new{i}") for i, c in enumerate(fields)],
    )
    first_row = null_safe([key, *order], ["_key", *[f"_at{i}" for i in range(len(order))]])
    joined = target.join(incoming, first_row, "left")

    def value(name: str):
        if name not in fields:
            return col(name)
        new = F.col(f"_new{fields.index(name)}")
        old = col(name) if name in target.columns else F.lit(None)
        return F.when(F.col("_found"), new).otherwise(old).alias(name)

    added = [c for c in fields if c not in target.columns]
    return joined.select(*[value(c) for c in [*target.columns, *added]])


def delete_keys(target: DataFrame, keys: DataFrame, on: str, keys_on: str | None = None) -> DataFrame:
    """Drop rows whose key is listed; rows with a NULL key stay."""
    return without_keys(target, keys, on, keys_on)


def delete_where(target: DataFrame, field: str, value) -> DataFrame:
    """Drop documents whose field equals `value`; None means missing."""
    return target.filter(~col(field).eqNullSafe(F.lit(value)))


def delete_documents(
    target: DataFrame, keys: DataFrame, on: str, keys_on: str | None = None
) -> DataFrame:
    """Drop all documents whose key is listed, NULL included."""
    return without_keys(target, keys, on, keys_on, nulls_match=True)


def delete_one_each(
    target: DataFrame,
    keys: DataFrame,
    on: str,
    target_order: str | Sequence[str],
    keys_on: str | None = None,
    **chunking,
) -> DataFrame:
    """Each row of `keys` drops one document: a key listed n times drops its first n."""
    key, count = (fresh([*target.columns, on], n) for n in ("_key", "_n"))
    listed = keys.groupBy(col(keys_on or on).alias(key)).agg(F.count(F.lit(1)).alias(count))
    # Only rows that were hit are ranked, and stored for it; the others go through.
    hit = target.join(listed, match_grouped([on], [key], nulls_match=True), "inner").drop(key)
    rank = fresh(hit.columns, "_rank")
    survivors = rank_in_group(hit, on, target_order, rank, **chunking).filter(col(rank) > col(count))
    untouched = without_keys(target, keys, on, keys_on, nulls_match=True)
    kept = [col(c) for c in target.columns]
    return untouched.select(*kept).unionByName(survivors.select(*kept))


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    external_id: str,
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Update rows whose external id is known, insert the others.

    The result has the target's columns and `RESULTS_created`: true for
    inserted rows, false for updated ones, NULL for rows not touched. Rows
    without an external id are inserted as they are.
    """
    # Columns that are there for the order alone don't reach the target.
    ordering = [] if order_by is None else names(order_by)
    fields = [
        c for c in incoming.columns
        if c != external_id and (c in target.columns or c not in ordering)
    ]
    _require_columns(target, [external_id, *fields])
    named = incoming.filter(col(external_id).isNotNull())
    latest = _last_changes(named, external_id, fields, order_by)
    updated = _overwrite(
        target.withColumn(CREATED, F.lit(None).cast("boolean")),
        latest.withColumn(CREATED, F.lit(False)),
        external_id,
        [*fields, CREATED],
    )
    created = without_keys(latest, target, external_id).unionByName(
        incoming.filter(col(external_id).isNull()).select(*[col(c) for c in latest.columns])
    )
    return updated.unionByName(
        created.withColumn(CREATED, F.lit(True)), allowMissingColumns=True
    )


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Next state after an insert, aligned by name; both sides have the same columns."""
    _require_columns(target, rows.columns)
    return target.unionByName(rows.select(*[col(c) for c in target.columns]))


def matched_updates(
    target: DataFrame,
    source: DataFrame,
    target_on: Sequence[str],
    source_on: Sequence[str],
    id_column: str,
    values: dict[str, object],
) -> DataFrame:
    """Ids of target rows that the source also holds, each with the constants to set."""
    matched = target.join(
        source.select(*[col(k).alias(f"_s{i}") for i, k in enumerate(source_on)]),
        all_of([col(k).eqNullSafe(F.col(f"_s{i}")) for i, k in enumerate(target_on)]),
        "inner",
    )
    return matched.select(col(id_column), *[F.lit(v).alias(c) for c, v in values.items()])
