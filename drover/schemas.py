"""The four entity tables with their keys, required columns and text lengths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """A table as its writers must leave it. `columns` maps names to SQL types."""

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()

    @property
    def required(self) -> tuple[str, ...]:
        """Key and not-null columns in table order."""
        wanted = set(self.key) | set(self.not_null)
        return tuple(c for c in self.columns if c in wanted)

    @property
    def schema(self) -> T.StructType:
        """Schema for frames: lengths are checked by `quality`, so text is plain string."""
        return T.StructType.fromDDL(
            ", ".join(
                f"`{c}` {'string' if t.startswith('varchar') else t}"
                for c, t in self.columns.items()
            )
        )

    def ddl(self) -> str:
        return ", ".join(f"`{c}` {t}" for c, t in self.columns.items())


# The column names, types, keys and not-null rules of the four tables.
ACCOUNTS = TableSpec(
    "accounts",
    {
        "phone": "varchar(12)",
        "company_name": "varchar(200)",
        "industry": "varchar(200)",
        "annual_revenue": "decimal(16,2)",
        "account_number_external_id": "varchar(36)",
        "number_of_locations": "int",
        "number_of_employees": "int",
        "sla": "varchar(20)",
        "sla_serial_number": "int",
    },
    key=("account_number_external_id",),
)

CONTACTS = TableSpec(
    "contacts",
    {
        "account_number_external_id": "varchar(36)",
        "first_name": "varchar(200)",
        "last_name": "varchar(200)",
        "email": "varchar(200)",
        "title": "varchar(200)",
        "department": "varchar(200)",
        "languages": "varchar(200)",
    },
    key=("first_name", "last_name"),
    not_null=("email", "title", "department", "languages"),
)

CONTRACTS = TableSpec(
    "contracts",
    {
        "account_number_external_id": "varchar(36)",
        "contract_number": "varchar(36)",
        "start_date": "date",
        "end_date": "date",
    },
    key=("contract_number",),
    not_null=("account_number_external_id", "start_date", "end_date"),
)

CONTRACT_LINES = TableSpec(
    "contract_lines",
    {
        "contract_line_number": "varchar(36)",
        "contract_number": "varchar(36)",
        "product": "varchar(50)",
        "quantity": "int",
    },
    key=("contract_line_number",),
    not_null=("contract_number", "product", "quantity"),
)

SOURCE_TABLES = {t.name: t for t in (ACCOUNTS, CONTACTS, CONTRACTS, CONTRACT_LINES)}


def staging(spec: TableSpec) -> TableSpec:
    """The staging twin of a source table; staged accounts allow no NULL at all."""
    not_null = tuple(spec.columns) if spec.name == "accounts" else spec.not_null
    return TableSpec(f"stg_{spec.name}", spec.columns, spec.key, not_null)


STAGING_TABLES = {name: staging(spec) for name, spec in SOURCE_TABLES.items()}

# Account columns and the field names of the target object.
ACCOUNT_FIELDS = {
    "phone": "Phone",
    "company_name": "Name",
    "industry": "Industry",
    "annual_revenue": "AnnualRevenue",
    "account_number_external_id": "Account_Number_External_ID__c",
    "number_of_locations": "NumberofLocations__c",
    "number_of_employees": "NumberOfEmployees",
    "sla": "SLA__c",
    "sla_serial_number": "SLASerialNumber__c",
}
ACCOUNT_WHOLE_NUMBERS = (
    "number_of_locations",
    "sla_serial_number",
    "number_of_employees",
    "annual_revenue",
)
MIGRATED_FLAG = "Migrated_Record__c"
