"""Column expressions: casts, blanks, dates, text. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.operators.ordering import col

# Type names accepted in cast lists, and the tokens read as "no value".
TYPE_NAMES = {
    "int": "bigint",
    "int64": "bigint",
    "str": "string",
    "object": "string",
    "float": "double",
    "float64": "double",
    "bool": "boolean",
}
NULL_TOKENS = ("NaT", "", " ")
RUN_ID_FORMAT = "yyyy-MM-dd__HH-mm-ss"


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast the named columns; others pass through.

    Accepts the short names of `TYPE_NAMES` or any Spark type. `'date'` leaves
    a column as it is. Missing values stay NULL. With `strict` a value that
    does not fit raises, else it becomes NULL.
    """
    unknown = [name for name in types if name not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")

    def one(name: str) -> Column:
        wanted = types.get(name)
        if wanted is None or wanted == "date":
            return col(name)
        wanted = TYPE_NAMES.get(wanted, wanted)
        return (col(name).cast(wanted) if strict else col(name).try_cast(wanted)).alias(name)

    return df.select(*[one(name) for name in df.columns])


def cast_by_position(df: DataFrame, types: Sequence[str], strict: bool = True) -> DataFrame:
    """Cast the first `len(types)` columns in order; further columns pass through."""
    if len(types) > len(df.columns):
        raise ValueError(f"{len(types)} types for {len(df.columns)} columns")
    return cast_columns(df, dict(zip(df.columns, types)), strict)


def align_key_types(
    left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Cast paired key columns to string wherever their types differ."""
    pairs = [
        (lk, rk)
        for lk, rk in zip(left_on, right_on)
        if left.schema[lk].dataType != right.schema[rk].dataType
    ]
    return (
        cast_columns(left, {lk: "string" for lk, _ in pairs}),
        cast_columns(right, {rk: "string" for _, rk in pairs}),
    )


def fill_blank(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL -> '' in string columns. Numbers and dates keep NULL for the not-null check."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        *[
            F.coalesce(col(f.name), F.lit("")).alias(f.name)
            if f.name in chosen and isinstance(f.dataType, T.StringType)
            else col(f.name)
            for f in df.schema.fields
        ]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every float and double column."""
    return df.select(
        *[
            F.when(~F.isnan(col(f.name)), col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.FloatType, T.DoubleType))
            else col(f.name)
            for f in df.schema.fields
        ]
    )


def tokens_to_null(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def iso_date(c: Column, pattern: str = "M/d/yyyy", strict: bool = True) -> Column:
    """Date text -> 'yyyy-MM-dd'. Blank text gives NULL; bad text raises, or gives NULL if `strict` is off."""
    text = tokens_to_null(c)
    day = F.to_date(text, pattern) if strict else F.try_to_date(text, pattern)
    return F.date_format(day, "yyyy-MM-dd")


def iso_date_columns(
    df: DataFrame, columns: str | Sequence[str], pattern: str = "M/d/yyyy", strict: bool = True
) -> DataFrame:
    for name in [columns] if isinstance(columns, str) else columns:
        df = df.withColumn(name, iso_date(col(name), pattern, strict))
    return df


# Date layouts tried in turn when none is given.
DATE_PATTERNS = ("yyyy-MM-dd", "M/d/yyyy", "yyyy/M/d", "d-MMM-yyyy", "yyyyMMdd")


def parse_date(
    c: Column, patterns: Sequence[str] = DATE_PATTERNS, strict: bool = True
) -> Column:
    """First layout that fits. If none does, the text raises, or gives NULL if `strict` is off."""
    found = F.coalesce(*[F.try_to_date(c, pattern) for pattern in patterns])
    if not strict:
        return found
    bad = F.raise_error(F.concat(F.lit("not a date: "), c)).cast("date")
    return F.when(found.isNull() & c.isNotNull(), bad).otherwise(found)


def split_dates(
    df: DataFrame, column: str, patterns: Sequence[str] = DATE_PATTERNS
) -> tuple[DataFrame, DataFrame]:
    """Rows whose text is missing or a date, with the date in its place, and the other rows as they are."""
    day = parse_date(col(column), patterns, strict=False)
    bad = col(column).isNotNull() & day.isNull()
    return df.filter(~bad).withColumn(column, day), df.filter(bad)


def drop_time(c: Column) -> Column:
    return F.to_date(c)


def year_end_after(c: Column) -> Column:
    """The last day of the year that starts on `c`: plus one year, minus one day."""
    return F.date_sub(F.add_months(c, 12), 1)


def concat_blank(first: Column, second: Column, sep: str = "-") -> Column:
    """Join two texts; a missing side is blank and the separator stays."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(sep), F.coalesce(second, F.lit("")))


def prefixed(prefix: str, c: Column) -> Column:
    """Literal before a text; missing stays missing."""
    return F.concat(F.lit(prefix), c)


def json_record(df: DataFrame, name: str = "record") -> DataFrame:
    """One JSON object per row; NULL fields are kept as null."""
    record = F.to_json(F.struct(*[col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(record.alias(name))


def run_id() -> Column:
    return F.date_format(F.current_timestamp(), RUN_ID_FORMAT)


# Printable ASCII, the same without the backslash, and the short escapes.
PRINTABLE = " -~"
PLAIN = r" -\[\]-~"
SHORT_ESCAPES = {"\\": "\\\\", "\t": "\\t", "\n": "\\n", "\r": "\\r"}
# With more kinds of special characters than this, a text is cut into pieces.
FEW_KINDS = 32


#: NULL in a text that `to_one_line` made; no other text becomes this one.
NULL_MARK = "\\N"


def to_one_line(value: Column) -> Column:
    """Any text, NULL included, as one without line breaks; `from_one_line` gives it back."""
    for found, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        value = F.replace(value, F.lit(found), F.lit(escaped))
    return F.coalesce(value, F.lit(NULL_MARK))


def from_one_line(value: Column) -> Column:
    """The text that `to_one_line` was given."""

    def breaks(part: Column) -> Column:
        for escaped, plain in (("\\n", "\n"), ("\\r", "\r")):
            part = F.replace(part, F.lit(escaped), F.lit(plain))
        return part

    # Pairs of backslashes are taken from the left, so what follows one is no escape.
    whole = F.array_join(F.transform(F.split(value, r"\\\\"), breaks), "\\")
    return F.when(value != NULL_MARK, F.when(F.contains(value, F.lit("\\")), whole).otherwise(value))


def escape_text(c: Column) -> Column:
    """Backslash escapes for all but printable ASCII.

    Most texts hold few kinds of special characters, and each kind is replaced
    in one go. Others are cut into plain runs and single special characters,
    so that the work stays in proportion to the length of the text.
    """
    kinds = F.array_distinct(F.regexp_extract_all(c, F.lit(f"[^{PRINTABLE}]"), F.lit(0)))
    pieces = F.regexp_extract_all(c, F.lit(f"(?s)[{PLAIN}]+|."), F.lit(0))

    def replaced(found: Column) -> Column:
        # The backslash goes first, because the other escapes bring in new ones.
        text = F.replace(c, F.lit("\\"), F.lit(SHORT_ESCAPES["\\"]))
        return F.aggregate(found, text, lambda t, kind: F.replace(t, kind, _escape_char(kind)))

    def choose(found: Column) -> Column:
        cut = F.array_join(F.transform(pieces, _escape_piece), "")
        return F.when(F.size(found) <= FEW_KINDS, replaced(found)).otherwise(cut)

    return F.transform(F.array(kinds), choose)[0]


def _escape_piece(piece: Column) -> Column:
    code = F.ascii(piece)
    plain = (code >= 0x20) & (code < 0x7F) & (code != ord("\\"))
    return F.when(plain, piece).otherwise(_escape_char(piece))


def _escape_char(char: Column) -> Column:
    code = F.ascii(char)

    def digits(width: int) -> Column:
        return F.lpad(F.lower(F.hex(code)), width, "0")

    short = F.lit(None)
    for raw, text in SHORT_ESCAPES.items():
        short = F.when(code == ord(raw), F.lit(text)).otherwise(short)
    return F.coalesce(
        short,
        F.when(code < 0x100, F.concat(F.lit("\\x"), digits(2)))
        .when(code < 0x10000, F.concat(F.lit("\\u"), digits(4)))
        .otherwise(F.concat(F.lit("\\U"), digits(8))),
    )


def escape_columns(df: DataFrame) -> DataFrame:
    """`escape_text` on every string column."""
    return df.select(
        *[
            escape_text(col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else col(f.name)
            for f in df.schema.fields
        ]
    )


def sql_quote(c: Column) -> Column:
    """A SQL string literal of the value, quotes doubled."""
    return F.concat(F.lit("'"), F.replace(c.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
