"""Inserts, updates and purges on the target: from frames to the rows that are sent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.functions.scalars import cast_columns
from drover.operators.dml import matched_updates
from drover.operators.ordering import col
from drover.operators.outcomes import Applied, perform
from drover.operators.reconcile import filter_by_lookup, net_new
from drover.operators.reshape import add_literals, discard, keep, rename, slice_rows
from drover.operators.submit import BATCH_SIZE, Outcome, Submitter, run_dml
from drover.schemas import ACCOUNT_FIELDS, ACCOUNT_WHOLE_NUMBERS, MIGRATED_FLAG
from drover.session import stage


def new_records(
    staged: DataFrame,
    migrated: DataFrame,
    staged_key: str,
    migrated_key: str,
    fields: Mapping[str, str],
    whole_numbers: Sequence[str] = (),
    flag: str = MIGRATED_FLAG,
) -> DataFrame:
    """Staged rows the target lacks, under the target's field names and flagged as migrated."""
    fresh = net_new(staged, migrated, staged_key, migrated_key)
    whole = cast_columns(fresh, {c: "bigint" for c in whole_numbers})
    return add_literals(rename(keep(whole, list(fields)), fields), {flag: True})


def insert_new_accounts(
    staged: DataFrame,
    target_accounts: DataFrame,
    submitter: Submitter,
    output: str,
    run_id: str,
    batch_size: int = BATCH_SIZE,
) -> Outcome | None:
    """Send the accounts that are staged but not yet among the migrated target accounts."""
    key = ACCOUNT_FIELDS["account_number_external_id"]
    # Keys are compared as they are on both sides.
    migrated = target_accounts.filter(col(MIGRATED_FLAG)).select(col(key))
    records = new_records(
        staged,
        migrated,
        "account_number_external_id",
        key,
        ACCOUNT_FIELDS,
        ACCOUNT_WHOLE_NUMBERS,
    )
    # Batching passes over the rows several times, so write the diff once.
    return run_dml(
        stage(records, "net-new"), submitter, "insert", key, output, run_id, batch_size
    )


@dataclass(frozen=True)
class Purge:
    """Rows of `table` to delete: those whose flag, or whose ancestor's flag, is set.

    `path` lists hops (foreign key, parent table) from the table up.
    """

    table: str
    path: tuple[tuple[str, str], ...] = ()


# Where each target object finds its migrated flag.
PURGES = (
    Purge("accounts"),
    Purge("contacts", (("AccountId", "accounts"),)),
    Purge("opportunities", (("AccountId", "accounts"),)),
    Purge("quotes"),
    Purge("quote_lines"),
    Purge("orders", (("QuoteId", "quotes"),)),
    Purge("order_lines"),
    Purge("contracts", (("OrderId", "orders"), ("QuoteId", "quotes"))),
    Purge(
        "subscriptions",
        (("ContractId", "contracts"), ("OrderId", "orders"), ("QuoteId", "quotes")),
    ),
)


def rows_to_purge(
    tables: Mapping[str, DataFrame],
    purge: Purge,
    flag: Column | None = None,
    id_column: str = "Id",
) -> DataFrame:
    """Ids that one purge deletes."""
    wanted = flag if flag is not None else col(MIGRATED_FLAG)
    rows = tables[purge.table]
    if purge.path:
        hops = [(fk, tables[parent], id_column) for fk, parent in purge.path]
        rows = filter_by_lookup(rows, hops, wanted)
    else:
        rows = rows.filter(wanted)
    return rows.select(col(id_column))


def _selected(
    tables: Mapping[str, DataFrame], purges: Sequence[Purge], id_column: str = "Id"
) -> dict[str, DataFrame]:
    """Stored ids of every purge.

    Rows whose parent is purged for the same ancestor's flag are found by the parent's stored ids.
    """
    selected: dict[str, DataFrame] = {}
    stored: dict[Purge, DataFrame] = {}
    for purge in purges:
        above = None
        if purge.path:
            fk, parent = purge.path[0]
            above = stored.get(Purge(parent, purge.path[1:]))
        if above is None:
            wanted = rows_to_purge(tables, purge, id_column=id_column)
        else:
            found = filter_by_lookup(tables[purge.table], [(fk, above, id_column)], F.lit(True))
            wanted = found.select(col(id_column))
        stored[purge] = selected[purge.table] = stage(wanted, f"purge-{purge.table}")
    return selected


def purge_all(
    tables: Mapping[str, DataFrame],
    submitter: Submitter,
    output: str,
    run_id: str,
    purges: Sequence[Purge] = PURGES,
) -> dict[str, Outcome | None]:
    """Select the rows of every purge first, then delete them object by object, children last
    in the list going first."""
    selected = _selected(tables, purges)
    return {
        p.table: run_dml(
            selected[p.table], submitter, "delete", "Id", f"{output}/{p.table}", run_id
        )
        for p in reversed(purges)
    }


def slice_to_insert(
    df: DataFrame,
    order_by: str | Sequence[str],
    start: int,
    count: int,
    drop: Sequence[str] = ("IsActive", "CreatedDate"),
    names: Mapping[str, str] | None = None,
    flag: str = MIGRATED_FLAG,
) -> DataFrame:
    """A slice of a file in target field names, flagged as migrated."""
    shaped = rename(
        discard(df, drop), names if names is not None else {"AmountPaid": "Amount_Paid__c"}
    )
    return add_literals(slice_rows(shaped, order_by, start, count), {flag: True})


def slice_to_update(
    target: DataFrame,
    df: DataFrame,
    key: str,
    order_by: str | Sequence[str],
    start: int,
    count: int,
    values: Mapping[str, object],
    id_column: str = "Id",
) -> DataFrame:
    """Target ids of a slice of a file, each with the constants to set."""
    chosen = slice_rows(df, order_by, start, count)
    ids = target.select(col(id_column), col(key))
    return matched_updates(ids, chosen, [key], [key], id_column, dict(values))


def created_by(
    rows: DataFrame,
    users: DataFrame,
    name: str,
    creator: str = "CreatedById",
    id_column: str = "Id",
) -> DataFrame:
    """Ids of the rows that the named user created."""
    found = filter_by_lookup(rows, [(creator, users, id_column)], F.col("Name") == name)
    return found.select(col(id_column))


def purge_states(
    tables: Mapping[str, DataFrame], purges: Sequence[Purge] = PURGES, id_column: str = "Id"
) -> dict[str, Applied]:
    """Outcomes of every purge and what is left of each object.

    All rows are selected, and stored, before the first delete.
    """
    selected = _selected(tables, purges, id_column)
    return {
        p.table: perform("delete", tables[p.table], selected[p.table], id_column)
        for p in reversed(purges)
    }


def account_inserts(staged: DataFrame, target_accounts: DataFrame, **mapping) -> Applied:
    """The target's accounts after the staged ones that it lacks were inserted, and their outcomes.

    `mapping` is that of `new_records`: migrated_key, staged_key, fields, whole_numbers.
    """
    key = mapping["fields"][mapping["staged_key"]]
    migrated = target_accounts.filter(col(MIGRATED_FLAG)).select(col(mapping["migrated_key"]))
    fresh_rows = stage(new_records(staged, migrated, **mapping), "net-new")
    return perform("insert", target_accounts, fresh_rows, key)
