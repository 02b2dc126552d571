"""Keys that hold many rows of a frame, found by a sketch, and joins that deal their rows to many tasks."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts into which a heavy key is dealt at most, and of a frame that make a key heavy.
MOST_PARTS = 10_000
#: Rows that one task takes without further ado.
LEAST_ROWS = 100_000

#: Types whose equal values have equal hashes; of other keys no heavy ones are found.
_HASHED = (
    T.IntegralType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType,
    T.TimestampNTZType, T.DecimalType,
)


def hashable(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> bool:
    """Whether keys of both sides have the same types, and equal keys equal hashes."""
    for a, b in zip(left_on, right_on):
        kind = left.schema[a].dataType
        if kind != right.schema[b].dataType or not isinstance(kind, _HASHED):
            return False
        if isinstance(kind, T.StringType) and kind != T.StringType():
            return False  # a collation may hold different texts for equal
    return bool(left_on)


def key_hash(keys: Sequence[Column]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(
    df: DataFrame, keys: Sequence[Column], parts: int | None = None, least_rows: int = LEAST_ROWS
) -> dict[int, int]:
    """Hashes of the keys that hold a part in `parts` of all rows, with the tasks that each should get.

    `parts` is the number of shuffle partitions, at most MOST_PARTS, unless
    given. A frequent-items sketch of eight times as many counters goes over the
    keys alone, merged from task to task: no key with that many rows is
    missed, and its count is at most half a part too large. Keys with fewer
    than `least_rows` rows are never heavy. At most twice `parts` hashes
    reach the driver. An empty frame has none; a NULL key is a key.
    """
    if parts is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, MOST_PARTS))
    found = (
        df.select(key_hash(keys).alias("h"))
        .agg(F.expr(f"approx_top_k(h, {2 * parts}, {8 * parts})").alias("top"), F.count(F.lit(1)).alias("n"))
        .first()
    )
    least = max(found["n"] / parts, least_rows)
    return {
        top["item"]: max(2, ceil(top["count"] / least))
        for top in found["top"] or []
        if top["count"] >= least
    }


def split(df: DataFrame, key: Column, heavy: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """The rows with heavy keys, and all others."""
    chosen = key.isin(*heavy)
    return df.filter(chosen), df.filter(~chosen)


def _tasks(key: Column, tasks: dict[int, int]) -> Column:
    table = F.create_map(*(F.lit(x) for pair in tasks.items() for x in pair))
    return F.coalesce(F.element_at(table, key), F.lit(1))


def _row_hash(df: DataFrame, alias: str) -> Column:
    """Hash of the columns that can be hashed; a repeated row has it again, also in a repeated task."""
    plain = [f.name for f in df.schema.fields if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    return F.xxhash64(*(F.col(f"{alias}." + "`" + n.replace("`", "``") + "`") for n in plain))


def salted(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    left_heavy: dict[int, int],
    right_heavy: dict[int, int],
) -> tuple[DataFrame, DataFrame]:
    """Both sides, aliased `_l` and `_r`, with columns `_a` and `_b` that must be equal as well in a join.

    Of a key that is heavy on the left, the left rows are dealt to tasks by a
    hash of the row, and the right rows go to each of those, and the other way
    round; if it is heavy on both sides, the tasks form a grid. Each pair of
    rows meets once.
    """
    sides = []
    for df, alias, key, own, other in (
        (left, "_l", left_key, left_heavy, right_heavy),
        (right, "_r", right_key, right_heavy, left_heavy),
    ):
        dealt = F.pmod(_row_hash(df, alias), _tasks(key, own).cast("long")).cast("int")
        copies = F.explode(F.sequence(F.lit(0), _tasks(key, other) - 1))
        names = ("_a", "_b") if alias == "_l" else ("_b", "_a")
        sides.append(
            df.alias(alias).select(f"{alias}.*", dealt.alias(names[0]), copies.alias(names[1])).alias(alias)
        )
    return sides[0], sides[1]
