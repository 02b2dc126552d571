"""Build the child files of the accounts: contacts, contracts and contract lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.functions.scalars import concat_blank, prefixed, year_end_after
from drover.operators.ordering import col, names
from drover.operators.reconcile import attach_parent
from drover.operators.reshape import discard, renumber, union_all
from drover.session import stage


def children_with_parent(
    parent: DataFrame, parts: Sequence[DataFrame], parent_key: str, on: str = "id"
) -> DataFrame:
    """Give each part's rows the key of the parent with the same row id, and stack the parts."""
    # One join over the stacked parts in place of one join per part.
    return discard(attach_parent(union_all(parts), parent, on, [parent_key]), [on])


def contacts_with_accounts(accounts: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    return children_with_parent(accounts, parts, "account_number_external_id")


def contracts_with_accounts(accounts: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """Contracts with their account and the end of their first year."""
    contracts = children_with_parent(accounts, parts, "account_number_external_id")
    return with_end_date(contracts.withColumn("start_date", F.to_date("start_date")))


def with_end_date(contracts: DataFrame) -> DataFrame:
    return contracts.withColumn("end_date", year_end_after(F.col("start_date")))


def contract_lines(
    accounts: DataFrame,
    contracts: DataFrame,
    generators: DataFrame,
    installations: DataFrame,
    service_levels: DataFrame,
    contract_order: str | Sequence[str] = "contract_number",
    line_order: str | Sequence[str] = "contract_line_number",
) -> DataFrame:
    """Three lines per contract: a generator, an installation and a service level.

    The i-th row of each line frame belongs to the i-th contract in the given
    orders. Service levels name the account's `sla`.
    """
    wanted = ["account_number_external_id", "contract_number", *names(contract_order)]
    # Numbering passes over its input several times, and all three kinds join what it gives.
    chosen = stage(contracts.select(*dict.fromkeys(wanted)), "contracts")
    numbered = stage(renumber(chosen, contract_order), "numbered-contracts")

    def lines(kind: DataFrame) -> DataFrame:
        return renumber(kind, line_order).join(
            numbered.select("id", "account_number_external_id", "contract_number"), "id", "inner"
        )

    def product(df: DataFrame, text: Column) -> DataFrame:
        return df.select(
            "contract_line_number", "contract_number", text.alias("product")
        )

    levels = lines(service_levels).join(
        accounts.select("account_number_external_id", "sla"), "account_number_external_id", "inner"
    )
    return union_all(
        [
            product(lines(generators), concat_blank(col("gen_type"), col("gen_type_capacity"))),
            product(lines(installations), prefixed("install - ", col("installation"))),
            product(levels, prefixed("sla - ", col("sla"))),
        ]
    ).withColumn("quantity", F.lit(1))
