"""Key, not-null, length and range checks made before a write."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.operators.ordering import col, fresh, names
from drover.operators.reconcile import match_grouped, repeated_keys
from drover.schemas import TableSpec
from drover.session import stage_counted

REASONS = "reject_reasons"


class Checked(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


class Settled(NamedTuple):
    """Stored parts, and the rows in each as counted when they were stored."""

    accepted: DataFrame
    rejected: DataFrame
    n_accepted: int
    n_rejected: int


class ConstraintError(ValueError):
    """A frame breaks a rule of the table it is written to."""


def row_reasons(
    not_null: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
    fits: Mapping[str, str] | None = None,
) -> list[Column]:
    """One column per rule: the reason's name if the row breaks it, else NULL."""
    rules = [F.when(col(c).isNull(), f"null:{c}") for c in not_null]
    rules += [
        F.when(F.char_length(col(c)) > n, f"length:{c}") for c, n in (max_length or {}).items()
    ]
    rules += [
        F.when(col(c).isNotNull() & col(c).try_cast(t).isNull(), f"range:{c}")
        for c, t in (fits or {}).items()
    ]
    return rules


def spec_reasons(spec: TableSpec) -> list[Column]:
    lengths = {
        c: int(found.group(1))
        for c, t in spec.columns.items()
        if (found := re.fullmatch(r"varchar\((\d+)\)", t))
    }
    fits = {c: t for c, t in spec.columns.items() if c not in lengths}
    return row_reasons(spec.required, lengths, fits)


def tag_rejects(
    df: DataFrame,
    rules: Sequence[Column],
    key: str | Sequence[str] | None = None,
    target: DataFrame | None = None,
) -> DataFrame:
    """Add `reject_reasons`, an array that is empty for good rows.

    With `key`, every row of a key that repeats within the frame is tagged
    `duplicate_key`, and one whose key is already in `target` `key_exists`.
    Rows with a NULL key are left to the not-null rules.
    """
    reasons = list(rules)
    kept = [col(c) for c in df.columns]
    tagged = df
    if key is not None:
        keys = names(key)
        # The frames joined here hold one row per key, and few keys repeat.
        repeats = fresh(df.columns, "_repeats")
        tagged = _flag(tagged, repeated_keys(df, keys), keys, repeats)
        reasons.append(F.when(col(repeats), "duplicate_key"))
        if target is not None:
            exists = fresh(tagged.columns, "_exists")
            tagged = _flag(tagged, target.select(*[col(k) for k in keys]).distinct(), keys, exists)
            reasons.append(F.when(col(exists), "key_exists"))
    return tagged.select(*kept, F.array_compact(F.array(*reasons)).alias(REASONS))


def _flag(df: DataFrame, keys: DataFrame, on: list[str], flag: str) -> DataFrame:
    aliases = [fresh(df.columns, f"{flag}{i}") for i in range(len(on))]
    listed = keys.select(*[col(k).alias(a) for k, a in zip(on, aliases)], F.lit(True).alias(flag))
    return df.join(listed, match_grouped(on, aliases), "left").drop(*aliases)


def check_rows(
    df: DataFrame, spec: TableSpec, target: DataFrame | None = None, settle: bool = False
) -> Checked:
    """Split into rows the table takes, cast to its types, and rows it does not, with reasons.

    `settle` writes the checked rows once, so that using both parts does not
    check twice and a later change of the target does not change the outcome.
    Columns that the table lacks raise.
    """
    if settle:
        return Checked(*settled_rows(df, spec, target)[:2])
    return _parts(_tagged(df, spec, target), spec)


def settled_rows(df: DataFrame, spec: TableSpec, target: DataFrame | None = None) -> Settled:
    """`check_rows` with `settle`, and the counts that the write took along."""
    passed = F.size(REASONS) == 0
    tagged, counts = stage_counted(
        _tagged(df, spec, target), f"checked-{spec.name}", accepted=passed, rejected=~passed
    )
    return Settled(*_parts(tagged, spec), counts["accepted"], counts["rejected"])


def _tagged(df: DataFrame, spec: TableSpec, target: DataFrame | None) -> DataFrame:
    unknown = [c for c in df.columns if c not in spec.columns]
    if unknown:
        raise ConstraintError(f"{spec.name} has no columns {unknown}")
    aligned = df.select(*[col(c) for c in spec.columns])
    return tag_rejects(aligned, spec_reasons(spec), spec.key, target)


def _parts(tagged: DataFrame, spec: TableSpec) -> Checked:
    good = tagged.filter(F.size(REASONS) == 0)
    typed = good.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])
    return Checked(typed, tagged.filter(F.size(REASONS) > 0))


def require_valid(df: DataFrame, spec: TableSpec, target: DataFrame | None = None) -> DataFrame:
    """The typed rows, or `ConstraintError` if any row breaks a rule."""
    return required_valid(df, spec, target).accepted


def required_valid(df: DataFrame, spec: TableSpec, target: DataFrame | None = None) -> Settled:
    """`require_valid` with counts; rejected rows are read for examples only if there are any."""
    found = settled_rows(df, spec, target)
    if found.n_rejected:
        sample = found.rejected.select(*[col(k) for k in spec.key], REASONS).limit(5).collect()
        raise ConstraintError(
            f"{spec.name}: {found.n_rejected} rows, e.g. {[r.asDict() for r in sample]}"
        )
    return found
