"""Tables laid out by key range, of which a change rewrites only the ranges that hold its keys.

A table is a folder in the warehouse:

    _ranged/<name>/data/<write>/_range=<n>/    files of one range, never changed
    _ranged/<name>/manifest/<version>.json     the ranges that make up a version

A change reads the ranges whose bounds its keys fall into, writes their next rows aside,
and commits by a manifest that names the new folders and all the old ones it
left alone. Readers hold a version, so they see all of a change or nothing of it. Two
changes that start from the same version can't both commit: the second one raises
`ConflictError` and leaves the table as it was.

A range holds about `rows_per_range` rows, sorted by key, and is split when it
has twice as many. The rows of one hot key may fill several ranges. The driver
holds one manifest entry for each range, as it holds file names of any table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.operators import dml
from drover.operators.ordering import col, rank_in_group
from drover.operators.reconcile import CardinalityError, repeated_keys

ROWS_PER_RANGE = 1_000_000
#: Ranges and rows that one task writes: small ranges share a task, whose start costs more than they do.
RANGES_PER_TASK = 50
ROWS_PER_TASK = 1_000_000
RANGE = "_range"
FOLDER = "_folder"
END = "end"


class ConflictError(RuntimeError):
    """Another change was committed after this one had started."""


@dataclass(frozen=True)
class Range:
    """One range: its folder below `data`, its rows, and its bounds as JSON texts, NULL keys left out."""

    folder: str
    rows: int
    low: object = None
    high: object = None


@dataclass(frozen=True)
class Version:
    number: int
    key: str
    schema: str
    rows_per_range: int
    ranges: tuple[Range, ...]

    @property
    def rows(self) -> int:
        return sum(r.rows for r in self.ranges)


class RangedTable:
    def __init__(self, spark: SparkSession, name: str):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        self.spark, self.name, self.root = spark, name, f"{warehouse}/_ranged/{name}"

    # Versions

    def _files(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, system = self._files(folder)
        return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []

    def exists(self) -> bool:
        return bool(self._names("manifest"))

    def version(self, number: int | None = None) -> Version:
        """A version of the table, by default the last that was committed."""
        found = [int(n.removesuffix(".json")) for n in self._names("manifest") if n.endswith(".json")]
        wanted = sorted(found, reverse=True) if number is None else [number]
        for each in wanted:
            lines = self.spark.read.text(f"{self.root}/manifest/{each:012d}.json").collect() if each in found else []
            texts = {r.value for r in lines}
            # One that is still being written has no end.
            if END in texts:
                entries = [json.loads(t) for t in texts if t != END]
                head = next(e for e in entries if "schema" in e)
                ranges = sorted((e for e in entries if "folder" in e), key=lambda e: e.pop("place"))
                return Version(each, ranges=tuple(Range(**e) for e in ranges), **head)
        raise ValueError(f"{self.name} has no version {'' if number is None else number}")

    def _commit(self, version: Version) -> Version:
        head = {"key": version.key, "schema": version.schema, "rows_per_range": version.rows_per_range}
        lines = [json.dumps(head)]
        lines += [json.dumps({"place": k, **asdict(r)}) for k, r in enumerate(version.ranges)]
        path, system = self._files(f"manifest/{version.number:012d}.json")
        try:
            out = system.create(path, False)
        except Exception as error:  # Spark gives Java's errors in several classes
            if "exists" not in str(error) and "AlreadyExists" not in str(error):
                raise
            raise ConflictError(f"{self.name} has version {version.number} already") from error
        try:
            out.write("\n".join([*lines, END, ""]).encode())
        finally:
            out.close()
        return version

    # Reading

    def read(self, version: Version | None = None) -> DataFrame:
        """All rows of a version, by default the last."""
        version = version or self.version()
        return self._of(version, version.ranges)

    def _of(self, version: Version, ranges: Sequence[Range]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(version.schema))
        if not ranges:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/data/{r.folder}" for r in ranges))

    # Writing

    def create(self, df: DataFrame, key: str, rows_per_range: int = ROWS_PER_RANGE) -> Version:
        """Make the table anew from `df`; it must not exist."""
        if self.exists():
            raise ValueError(f"{self.name} exists")
        if any(c.lower() in (RANGE, FOLDER) for c in df.columns):
            raise ValueError(f"columns must not be called {RANGE} or {FOLDER}")
        schema = json.dumps(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]).jsonValue())
        version = Version(0, key, schema, rows_per_range, ())
        ranges = max(1, -(-df.count() // rows_per_range))
        dealt = self._dealt(df, key, ranges, rows_per_range)
        return self._commit(replace(version, ranges=self._in_order(self._write(dealt, key, version))))

    @staticmethod
    def _tasks(ranges: int, rows_per_range: int) -> int:
        """Tasks that write so many ranges, each some of them or at least one."""
        together = max(1, min(RANGES_PER_TASK, ROWS_PER_TASK // rows_per_range))
        return max(1, -(-ranges // together))

    @classmethod
    def _dealt(cls, df: DataFrame, key: str, ranges: int, rows_per_range: int) -> DataFrame:
        """The rows with their RANGE, some ranges to a task, which cuts them by the place of its sorted rows."""
        # The rows of a hot key are told apart by their hash.
        order = [col(key), F.xxhash64(*map(col, df.columns))]
        tasks = cls._tasks(ranges, rows_per_range)
        dealt = df.repartitionByRange(tasks, *order) if tasks > 1 else df.repartition(1)
        if tasks == ranges:
            return dealt.withColumn(RANGE, F.spark_partition_id().cast("long"))
        numbered = dealt.sortWithinPartitions(*order)
        # The upper bits number the partition, the lower 33 its rows.
        place = F.monotonically_increasing_id()
        inside = F.floor(place.bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(rows_per_range))
        return numbered.withColumn(RANGE, F.shiftright(place, 33) * F.lit(1 << 33) + inside)

    def _write(self, rows: DataFrame, key: str, version: Version, then: Sequence[str] = ()) -> list[Range]:
        """Write rows by RANGE (and `then`) and describe what was written."""
        write = uuid.uuid4().hex
        by = [RANGE, *then]
        path = f"{self.root}/data/{write}"
        ordered = rows.sortWithinPartitions(*map(col, by), col(key))
        ordered.write.partitionBy(*by).parquet(path)
        schema = T.StructType.fromJson(json.loads(version.schema))
        layout = T.StructType([*schema.fields, *(T.StructField(b, T.LongType()) for b in by)])
        found = self.spark.read.schema(layout).parquet(path).groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"),
            F.to_json(F.struct(F.min(col(key)).alias("low"), F.max(col(key)).alias("high"))).alias("bounds"),
        )
        # One row for each range.
        return [
            Range("/".join([write, *(f"{b}={r[b]}" for b in by)]), r["rows"], **json.loads(r["bounds"]))
            for r in found.collect()
        ]

    def _in_order(self, ranges: Sequence[Range]) -> tuple[Range, ...]:
        def place(r: Range):
            return r.low is not None, 0 if r.low is None else r.low, 0 if r.high is None else r.high

        return tuple(sorted(ranges, key=place))

    # Changes

    @staticmethod
    def _below(bounds: Sequence, key: Column, kind: str, strict: bool) -> Column:
        """How many of the sorted bounds are less than the key (or equal, unless strict), by halving."""
        known = F.from_json(F.lit(json.dumps(list(bounds))), f"array<{kind}>")
        steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

        def step(at: Column, width: Column) -> Column:
            bound = F.get(known, at + width - 1)
            return F.when(bound < key if strict else bound <= key, at + width).otherwise(at)

        return F.reduce(F.array(*map(F.lit, steps)), F.lit(0), step)

    def _bounded(self, version: Version) -> list[Range]:
        return [r for r in version.ranges if r.low is not None]

    def touched(self, keys: DataFrame, on: str, version: Version | None = None, new: bool = False) -> list[Range]:
        """The ranges that may hold a key of `keys`, and with `new` also those that a new key goes to."""
        version = version or self.version()
        ranges = self._bounded(version)
        if not ranges:
            return []
        kind = T.StructType.fromJson(json.loads(version.schema))[version.key].dataType.simpleString()
        key = col(on).cast(kind)
        first = self._below([r.high for r in ranges], key, kind, strict=True)
        last = self._below([r.low for r in ranges], key, kind, strict=False) - 1
        if new:
            last = F.greatest(last, F.lit(0))
            first = F.least(first, last)
        places = keys.where(key.isNotNull()).select(first.alias("first"), last.alias("last")).distinct()
        spread = places.where("first <= last").select(F.explode(F.sequence("first", "last")).alias("place"))
        # At most one number for each range.
        return [ranges[r["place"]] for r in sorted(spread.distinct().collect())]

    def _change(
        self, keys: DataFrame, on: str, apply: Callable[[DataFrame], DataFrame], new: bool = False, start: Version | None = None
    ) -> Version:
        """Commit `apply`, which gets the rows of the touched ranges with their FOLDER and gives their next rows.

        Rows without FOLDER are new and go to the range of their key.
        """
        version = start or self.version()
        key = version.key
        hit = self.touched(keys, on, version, new)
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/data/(.+)/[^/]+$", 1)
        if hit:
            old = self._of(version, hit).select("*", folder.alias(FOLDER))
        else:
            old = self._of(version, []).withColumn(FOLDER, F.lit("").cast("string"))
        # New keys of an empty table, and NULL ones, make a range of their own.
        place = {r.folder: k for k, r in enumerate(hit)}
        number = self._looked_up(place, col(FOLDER))
        if new and hit:
            kind = T.StructType.fromJson(json.loads(version.schema))[key].dataType.simpleString()
            # The last range at or below the key, of all ranges; it is among the touched ones.
            ranges = self._bounded(version)
            numbers = F.from_json(F.lit(json.dumps([place.get(r.folder) for r in ranges])), "array<int>")
            at = F.greatest(self._below([r.low for r in ranges], col(key), kind, strict=False) - 1, F.lit(0))
            number = F.coalesce(number, F.when(col(key).isNotNull() & col(FOLDER).isNull(), F.get(numbers, at)))
        number = F.coalesce(number, F.lit(len(hit)))
        columns = [f["name"] for f in json.loads(version.schema)["fields"]]
        after = apply(old).withColumn(RANGE, number.cast("long")).select(*map(col, columns), RANGE)
        # A given number of tasks, because few bytes may be many files.
        tasks = self._tasks(len(hit) + 1, version.rows_per_range)
        written = self._write(after.repartition(tasks, RANGE), key, version)
        written = self._split(written, key, version)
        gone = set(place)
        kept = [r for r in version.ranges if r.folder not in gone]
        return self._commit(
            replace(version, number=version.number + 1, ranges=self._in_order([*kept, *written]))
        )

    def _looked_up(self, place: dict[str, int], folder: Column) -> Column:
        """The number of a folder, NULL if it has none, by halving the sorted folders: a map would be gone through row by row."""
        if not place:
            return F.lit(None).cast("int")
        # Spark compares texts by their bytes.
        folders = sorted(place, key=str.encode)
        known = F.from_json(F.lit(json.dumps(folders)), "array<string>")
        numbers = F.from_json(F.lit(json.dumps([place[f] for f in folders])), "array<int>")
        at = self._below(folders, folder, "string", strict=False) - 1
        return F.when(F.get(known, at) == folder, F.get(numbers, at))

    def _split(self, written: list[Range], key: str, version: Version) -> list[Range]:
        """Deal ranges with more than twice the wanted rows to several."""
        large = [r for r in written if r.rows > 2 * version.rows_per_range]
        if not large:
            return written
        folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/{RANGE}=(\d+)/[^/]+$", 1)
        rows = self._of(version, large).select("*", folder.cast("long").alias(RANGE))
        ranked = rank_in_group(rows, RANGE, key, "_rank")
        piece = F.expr(f"(_rank - 1) DIV {version.rows_per_range}")
        dealt = ranked.withColumn("_piece", piece).drop("_rank")
        pieces = sum(-(-r.rows // version.rows_per_range) for r in large)
        dealt = dealt.repartition(self._tasks(pieces, version.rows_per_range), RANGE, "_piece")
        return [r for r in written if r not in large] + self._write(dealt, key, version, ["_piece"])

    def update(
        self, changes: DataFrame, columns: Sequence[str], order_by: str | Sequence[str] | None = None, start: Version | None = None
    ) -> Version:
        """Set columns of the rows whose key is in `changes` (`dml.keyed_update`)."""
        key = (start or self.version()).key
        return self._change(
            changes, key, lambda old: dml.keyed_update(old, changes, key, columns, order_by), start=start
        )

    def delete(self, keys: DataFrame, on: str | None = None, start: Version | None = None) -> Version:
        """Drop the rows whose key is listed (`dml.delete_keys`)."""
        key = (start or self.version()).key
        return self._change(
            keys, on or key, lambda old: dml.delete_keys(old, keys, key, on or key), start=start
        )

    def upsert(
        self, incoming: DataFrame, order_by: str | Sequence[str] | None = None, start: Version | None = None
    ) -> Version:
        """Update rows whose key is known and insert the others (`dml.upsert`)."""
        key = (start or self.version()).key
        return self._change(
            incoming, key, lambda old: dml.upsert(old, incoming, key, order_by).drop(dml.CREATED), new=True, start=start
        )

    def append(self, rows: DataFrame, start: Version | None = None) -> Version:
        """Insert rows; keys that are there already, or twice among the new rows, raise."""
        version = start or self.version()
        key = version.key

        def apply(old: DataFrame) -> DataFrame:
            twice = old.select(col(key)).unionByName(rows.select(col(key))).where(col(key).isNotNull())
            found = repeated_keys(twice, key).limit(1).collect()
            if found:
                raise CardinalityError(f"the key is there already: {found[0]}")
            return old.unionByName(rows, allowMissingColumns=True)

        return self._change(rows, key, apply, new=True, start=version)

    # Care

    def remove_superseded(self) -> int:
        """Delete folders and manifests that the last version doesn't need; returns how many folders."""
        version = self.version()
        needed = {r.folder for r in version.ranges}
        writes = {f.partition("/")[0] for f in needed}
        removed = 0
        for write in self._names("data"):
            if write not in writes:
                removed += self._remove(f"data/{write}")
                continue
            for part in self._names(f"data/{write}"):
                inner = [f"{write}/{part}/{p}" for p in self._names(f"data/{write}/{part}") if p.startswith("_piece=")]
                for folder in inner or [f"{write}/{part}"]:
                    if part.startswith(RANGE) and folder not in needed:
                        removed += self._remove(f"data/{folder}")
        for manifest in self._names("manifest"):
            if manifest < f"{version.number:012d}.json":
                self._remove(f"manifest/{manifest}")
        return removed

    def _remove(self, folder: str) -> int:
        path, system = self._files(folder)
        return int(system.delete(path, True))

    def drop(self) -> None:
        self._remove("")
