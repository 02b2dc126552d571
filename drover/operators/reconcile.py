"""Joins that tell where a row came from, diffs, lookup filters and key checks.

Keys match null-safely: a NULL key finds a NULL key. Spark can split a hot key
of either side in an inner join and of the probed side in an anti join, but
not in a full outer join. So a sketch of both sides finds the heavy keys
first: their rows are dealt to many tasks in an inner join, and all others go
through one outer join. Diffs, and merges on keys that can't be hashed alike, are
put together from an inner join and anti joins against distinct keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.operators import heavy
from drover.operators.ordering import all_of, col, fresh, names

PROVENANCE = "_merge"

Keys = str | Sequence[str]


class Diff(NamedTuple):
    both: DataFrame
    left_only: DataFrame
    right_only: DataFrame


class CardinalityError(ValueError):
    """A side that should be unique on its keys is not."""


class _Layout:
    """The two sides of a join and the names of its output columns.

    Keys of one name fall together, other clashes get suffixes. The sides are
    told apart by alias rather than renamed, so that the joins of one merge have
    like inputs and can share their shuffles.
    """

    def __init__(self, left, right, left_on, right_on, suffixes):
        self.left, self.right = left.alias("_l"), right.alias("_r")
        self.on = {"left": names(left_on), "right": names(right_on)}
        if len(self.on["left"]) != len(self.on["right"]):
            raise ValueError("key lists differ in length")
        self.shared = {a for a, b in zip(self.on["left"], self.on["right"]) if a == b}
        clash = (set(left.columns) & set(right.columns)) - self.shared

        def renamed(df, suffix):
            return [(f, f.name + suffix if f.name in clash else f.name) for f in df.schema.fields]

        self.left_out = renamed(left, suffixes[0])
        self.right_out = [
            (f, out) for f, out in renamed(right, suffixes[1]) if f.name not in self.shared
        ]
        out = [name for _, name in [*self.left_out, *self.right_out]]
        twice = sorted({name for name in out if out.count(name) > 1})
        if twice:
            raise ValueError(f"columns would come twice: {twice}")

    def value(self, side: str, name: str) -> Column:
        return F.col(f"_{side[0]}." + "`" + name.replace("`", "``") + "`")

    def condition(self) -> Column:
        pairs = zip(self.on["left"], self.on["right"])
        return all_of(
            [self.value("left", a).eqNullSafe(self.value("right", b)) for a, b in pairs]
        )

    def select(
        self, joined: DataFrame, sides: Sequence[str], provenance: str | Column | None
    ) -> DataFrame:
        """Output columns of a join; a side that is not in `sides` is NULL."""
        if provenance is not None:
            taken = [name for _, name in [*self.left_out, *self.right_out] if name == PROVENANCE]
            if taken:
                raise ValueError(f"a side has a column {PROVENANCE}; rename it or pass indicator=False")
        chosen = []
        for side, fields in (("left", self.left_out), ("right", self.right_out)):
            for field, out in fields:
                found = [side] if side in sides else []
                if field.name in self.shared:
                    found = list(sides)
                values = [self.value(s, field.name) for s in found]
                if not values:
                    chosen.append(F.lit(None).cast(field.dataType).alias(out))
                else:
                    value = values[0] if len(values) == 1 else F.coalesce(*values)
                    chosen.append(value.alias(out))
        if provenance is not None:
            tag = F.lit(provenance) if isinstance(provenance, str) else provenance
            chosen.append(tag.alias(PROVENANCE))
        return joined.select(*chosen)

    def both(self, provenance: str | None) -> DataFrame:
        joined = self.left.join(self.right, self.condition(), "inner")
        return self.select(joined, ("left", "right"), provenance)

    def only(self, side: str, provenance: str | None, other_is_unique: bool = False) -> DataFrame:
        """Rows of one side whose key the other side lacks."""
        mine, other, other_side = (
            (self.left, self.right, "right")
            if side == "left"
            else (self.right, self.left, "left")
        )
        keys = other.select(*[self.value(other_side, k) for k in self.on[other_side]])
        if not other_is_unique:
            keys = keys.distinct()
        joined = mine.join(keys.alias(f"_{other_side[0]}"), self.condition(), "left_anti")
        return self.select(joined, (side,), provenance)

    def kept(self, side: str, provenance: bool) -> DataFrame:
        """All rows of one side beside their match on the other, which is unique."""
        mine, other, other_alias = (
            (self.left, self.right, "_r") if side == "left" else (self.right, self.left, "_l")
        )
        marked = other.withColumn("_found", F.lit(True)).alias(other_alias)
        joined = mine.join(marked, self.condition(), "left")
        tag = F.when(F.col(f"{other_alias}._found"), "both").otherwise(f"{side}_only")
        return self.select(joined, ("left", "right"), tag if provenance else None)


    def keys(self, side: str) -> list[Column]:
        return [self.value(side, k) for k in self.on[side]]

    def rest(self, left: DataFrame, right: DataFrame, how: str, provenance: bool) -> DataFrame:
        """One plain outer join of rows of the two sides."""
        found = fresh([*left.columns, *right.columns], "_found")
        sides = [df.withColumn(found, F.lit(True)).alias(a) for df, a in ((left, "_l"), (right, "_r"))]
        joined = sides[0].join(sides[1], self.condition(), "full" if how == "outer" else how)
        tag = (
            F.when(F.col(f"_l.{found}").isNull(), "right_only")
            .when(F.col(f"_r.{found}").isNull(), "left_only")
            .otherwise("both")
        )
        return self.select(joined, ("left", "right"), tag if provenance else None)

    def outer(self, how: str, provenance: bool, least_rows: int) -> DataFrame:
        """A left, right or full join: heavy keys dealt to many tasks, one plain join of all others."""
        counts = {s: heavy.heavy_keys(df, self.keys(s), least_rows=least_rows) for s, df in self.sides()}
        found = counts["left"] | counts["right"]
        if not found:
            return self.rest(self.left, self.right, how, provenance)
        key = {s: heavy.key_hash(self.keys(s)) for s in ("left", "right")}
        cut = {s: heavy.split(df, key[s], found) for s, df in self.sides()}
        merged = self.rest(cut["left"][1], cut["right"][1], how, provenance)

        salted = heavy.salted(
            cut["left"][0], cut["right"][0], key["left"], key["right"], counts["left"], counts["right"]
        )
        meet = self.condition() & F.expr("_l._a = _r._a AND _l._b = _r._b")
        both = self.select(
            salted[0].join(salted[1], meet, "inner"), ("left", "right"), "both" if provenance else None
        )
        merged = merged.unionByName(both)
        for side, other in (("left", "right"), ("right", "left")):
            if how in (side, "outer"):
                # Distinct heavy keys: at most as many as the sketch may find, so they can be sent to all.
                listed = cut[other][0].select(*self.keys(other)).distinct().alias(f"_{other[0]}")
                alone = cut[side][0].join(F.broadcast(listed), self.condition(), "left_anti")
                merged = merged.unionByName(
                    self.select(alone, (side,), f"{side}_only" if provenance else None)
                )
        return merged

    def sides(self) -> tuple[tuple[str, DataFrame], tuple[str, DataFrame]]:
        return ("left", self.left), ("right", self.right)


def null_safe(left_on: Sequence[str], right_on: Sequence[str]) -> Column:
    return all_of([col(a).eqNullSafe(col(b)) for a, b in zip(left_on, right_on)])


def match_grouped(
    left_on: Sequence[str], right_on: Sequence[str], nulls_match: bool = False
) -> Column:
    """Key condition for a join with a right side that was grouped by its keys.

    Compares the keys as structs (in which NULL equals NULL). Spark then does
    not take the grouped, short side as already laid out for the join, and
    shuffles it once more; only joins between two plain shuffles get their hot
    keys split at run time.
    """
    sides = [
        F.struct(*[col(c).alias(f"k{i}") for i, c in enumerate(on)]) for on in (left_on, right_on)
    ]
    same = sides[0] == sides[1]
    if nulls_match:
        return same
    return same & all_of([col(c).isNotNull() for c in left_on])


def merge(
    left: DataFrame,
    right: DataFrame,
    left_on: Keys = (),
    right_on: Keys = (),
    how: str = "inner",
    suffixes: tuple[str, str] = ("_left", "_right"),
    indicator: bool = True,
    validate: str | None = None,
    least_heavy: int = heavy.LEAST_ROWS,
) -> DataFrame:
    """Equi-join on paired keys, with `_merge` saying which side a row was found in.

    `how` is inner, left, right or outer. `validate` takes '1:1', '1:m',
    'm:1' or 'm:m' and raises `CardinalityError` if a "1" side repeats a key;
    it also lets a left or right join go as one plain join, and an outer join as
    two. Without it a sketch of each side's keys is taken first. Keys with less than
    `least_heavy` rows aren't split, so that small frames join in one piece.
    """
    layout = _Layout(left, right, left_on, right_on, suffixes)
    left_is_unique = right_is_unique = False
    if validate is not None:
        left_is_unique, right_is_unique = check_cardinality(
            left, right, left_on, right_on, validate
        )

    def tag(value):
        return value if indicator else None

    if how == "inner":
        return layout.both(tag("both"))
    if how == "left" and right_is_unique:
        return layout.kept("left", indicator)
    if how == "right" and left_is_unique:
        return layout.kept("right", indicator)

    parts = {"left": ("left",), "right": ("right",), "outer": ("left", "right")}
    if how not in parts:
        raise ValueError(f"unknown join: {how}")
    if not (left_is_unique or right_is_unique) and heavy.hashable(
        left, right, layout.on["left"], layout.on["right"]
    ):
        return layout.outer(how, indicator, least_heavy)
    other_is_unique = {"left": right_is_unique, "right": left_is_unique}
    if how == "outer" and (left_is_unique or right_is_unique):
        # One join keeps all rows of one side; only the other side's rest is missing.
        side, rest = ("left", "right") if right_is_unique else ("right", "left")
        return layout.kept(side, indicator).unionByName(
            layout.only(rest, tag(f"{rest}_only"), other_is_unique[rest])
        )
    merged = layout.both(tag("both"))
    for side in parts[how]:
        merged = merged.unionByName(layout.only(side, tag(f"{side}_only"), other_is_unique[side]))
    return merged


def diff(
    left: DataFrame,
    right: DataFrame,
    left_on: Keys,
    right_on: Keys,
    suffixes: tuple[str, str] = ("_left", "_right"),
    validate: str | None = None,
    drop_provenance: bool = False,
) -> Diff:
    """Rows in both frames, in the left only and in the right only; each part is its own plan."""
    layout = _Layout(left, right, left_on, right_on, suffixes)
    left_is_unique = right_is_unique = False
    if validate is not None:
        left_is_unique, right_is_unique = check_cardinality(
            left, right, left_on, right_on, validate
        )

    def tag(value):
        return None if drop_provenance else value

    return Diff(
        layout.both(tag("both")),
        layout.only("left", tag("left_only"), right_is_unique),
        layout.only("right", tag("right_only"), left_is_unique),
    )


def only_part(merged: DataFrame, part: str) -> DataFrame:
    """Rows of a merged frame by provenance: both, left_only or right_only."""
    return merged.filter(F.col(PROVENANCE) == part)


def net_new(
    source: DataFrame, target: DataFrame, source_on: Keys, target_on: Keys
) -> DataFrame:
    """Source rows whose key the target lacks."""
    return without_keys(source, target, source_on, target_on, nulls_match=True)


def _match(df, keys, on, keys_on, nulls_match, unique, how) -> DataFrame:
    aliases = [f"_k{i}" for i in range(len(names(on)))]
    listed = keys.select(*[col(k).alias(a) for k, a in zip(names(keys_on or on), aliases)])
    if not unique:
        return df.join(listed.distinct(), match_grouped(names(on), aliases, nulls_match), how)
    if nulls_match:
        return df.join(listed, null_safe(names(on), aliases), how)
    return df.join(listed, all_of([col(a) == F.col(b) for a, b in zip(names(on), aliases)]), how)


def with_keys(
    df: DataFrame,
    keys: DataFrame,
    on: Keys,
    keys_on: Keys | None = None,
    nulls_match: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Rows whose key is in the key frame; by default NULL is in no list.

    `unique` says that the key frame repeats no key, which saves the step that
    folds repeated keys before they are shuffled. Leave it off for grouped frames.
    """
    return _match(df, keys, on, keys_on, nulls_match, unique, "left_semi")


def without_keys(
    df: DataFrame,
    keys: DataFrame,
    on: Keys,
    keys_on: Keys | None = None,
    nulls_match: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Rows whose key is not in the key frame; by default rows with a NULL key stay."""
    return _match(df, keys, on, keys_on, nulls_match, unique, "left_anti")


def filter_by_lookup(
    child: DataFrame,
    path: Sequence[tuple[str, DataFrame, str]],
    predicate: Column | Callable[[DataFrame], Column],
) -> DataFrame:
    """Child rows whose ancestor meets `predicate`.

    `path` lists hops (foreign key, parent frame, unique parent key) from the
    child up. The filter starts at the far end and comes down by semi joins, so
    each hop moves only keys that are still wanted.
    """
    _, top, key = path[-1]
    wanted = top.filter(predicate(top) if callable(predicate) else predicate)
    hops = list(path)
    for (fk, _, key), (_, below, _) in zip(reversed(hops[1:]), reversed(hops[:-1])):
        wanted = with_keys(below, wanted, fk, key, unique=True)
    fk, _, key = hops[0]
    return with_keys(child, wanted, fk, key, unique=True)


def visible(df: DataFrame, deleted_flag: str, include_deleted: bool = False) -> DataFrame:
    """Leave out soft-deleted rows unless asked for; a NULL flag counts as not deleted."""
    if include_deleted:
        return df
    return df.filter(~F.coalesce(col(deleted_flag), F.lit(False)))


def key_counts(df: DataFrame, on: Keys) -> DataFrame:
    return df.groupBy(*[col(k) for k in names(on)]).agg(F.count(F.lit(1)).alias("n_rows"))


def repeated_keys(df: DataFrame, on: Keys) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return key_counts(df, on).filter(F.col("n_rows") > 1)


def check_cardinality(
    left: DataFrame, right: DataFrame, left_on: Keys, right_on: Keys, validate: str
) -> tuple[bool, bool]:
    """Raise if a side that `validate` calls "1" repeats a key; return which sides are unique."""
    spelled = {"one_to_one": "1:1", "one_to_many": "1:m", "many_to_one": "m:1", "many_to_many": "m:m"}
    left_many, _, right_many = spelled.get(validate, validate).partition(":")
    if left_many not in ("1", "m") or right_many not in ("1", "m"):
        raise ValueError(f"unknown cardinality: {validate}")
    for side, df, on, many in (("left", left, left_on, left_many), ("right", right, right_on, right_many)):
        if many == "1":
            sample = repeated_keys(df, on).limit(5).collect()
            if sample:
                raise CardinalityError(f"{side} keys repeat, e.g. {[r.asDict() for r in sample]}")
    return left_many == "1", right_many == "1"


def first_per_key(
    df: DataFrame, on: Keys, order_by: Keys, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the first in `order_by`; pre-aggregated before the shuffle."""
    return _one_per_key(df, on, order_by, columns, F.min_by)


def last_per_key(
    df: DataFrame, on: Keys, order_by: Keys, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the last in `order_by`; pre-aggregated before the shuffle."""
    return _one_per_key(df, on, order_by, columns, F.max_by)


def _one_per_key(df, on, order_by, columns, pick) -> DataFrame:
    keys = names(on)
    wanted = df.columns if columns is None else [*keys, *[c for c in columns if c not in keys]]
    rest = [c for c in wanted if c not in keys]
    if not rest:
        return df.select(*[col(k) for k in keys]).distinct()
    order = F.struct(*[col(c) for c in names(order_by)])
    picked = pick(F.struct(*[col(c) for c in rest]), order).alias("_row")
    grouped = df.groupBy(*[col(k) for k in keys]).agg(picked)
    return grouped.select(
        *[col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in wanted]
    )


def attach_parent(
    child: DataFrame, parent: DataFrame, on: str, attributes: Sequence[str]
) -> DataFrame:
    """Add columns of the parent that shares the row id; children without a parent drop out."""
    return child.join(parent.select(col(on), *[col(a) for a in attributes]), on, "inner")
