"""Objects that a service hands out page by page, read in parallel with filters sent along.

A `PageService` says how many pages there are and fetches one of them, with the
rows that some simple conditions leave. `read_paged` makes it a DataFrame: each
task fetches a range of pages, and filters on plain columns go to
the service, so that rows nobody asked for don't travel. What the service
can't filter, Spark filters afterwards. A lost task fetches its pages again.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from drover.operators.ordering import col
from drover.operators.reshape import flatten

# Workers get these classes with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "object_pages"
PAGES_PER_TASK = 50
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass(frozen=True)
class Condition:
    """`column` `op` `value`; op is one of =, <=>, in, <, <=, >, >=, null. `wanted` False turns it round."""

    column: str
    op: str
    value: object = None
    wanted: bool = True


class PageService(Protocol):
    """What a service must be able to do. Pages keep their numbers and rows while they are read."""

    def pages(self) -> int:
        """How many pages there are."""

    def fetch(self, page: int, conditions: Sequence[Condition]) -> list[dict]:
        """Records of a page, from 0, that meet all conditions."""

    def understands(self, condition: Condition) -> bool:
        """Whether `fetch` can apply the condition."""


class ObjectPages:
    """Reads page ranges of a service; built by `read_paged`."""

    def __init__(self, service: PageService, schema: T.StructType, pages_per_task: int):
        self.service, self.schema, self.pages_per_task = service, schema, pages_per_task

    def source(self) -> type[ds.DataSource]:
        service, schema, per_task = self.service, self.schema, self.pages_per_task
        arrow = to_arrow_schema(schema)
        plain = {
            f.name for f in schema.fields
            if isinstance(f.dataType, (T.BooleanType, T.StringType, T.IntegralType, T.DateType, T.DecimalType))
        }

        class PageReader(ds.DataSourceReader):
            def __init__(self):
                self.conditions: list[Condition] = []

            def pushFilters(self, filters):
                for each in filters:
                    condition = _condition(each)
                    if condition and condition.column in plain and service.understands(condition):
                        self.conditions.append(condition)
                    else:
                        yield each

            def partitions(self):
                total = service.pages()
                starts = range(0, total, per_task)
                return [ds.InputPartition((s, min(s + per_task, total))) for s in starts]

            def read(self, partition) -> Iterator[pa.RecordBatch]:
                for page in range(*(partition.value if partition is not None else (0, 0))):
                    records = service.fetch(page, self.conditions)
                    if records:
                        yield from pa.Table.from_pylist(records, arrow).to_batches()

        class PageSource(ds.DataSource):
            @classmethod
            def name(cls):
                return FORMAT

            def schema(self):
                return schema

            def reader(self, schema):
                return PageReader()

        return PageSource


_COMPARED = {
    ds.EqualTo: "=",
    ds.EqualNullSafe: "<=>",
    ds.LessThan: "<",
    ds.LessThanOrEqual: "<=",
    ds.GreaterThan: ">",
    ds.GreaterThanOrEqual: ">=",
    ds.In: "in",
}


def _condition(each: ds.Filter) -> Condition | None:
    """A filter as a condition on one plain column."""
    if isinstance(each, ds.Not):
        inner = _condition(each.child)
        return inner and Condition(inner.column, inner.op, inner.value, not inner.wanted)
    if len(getattr(each, "attribute", ())) != 1:
        return None
    if isinstance(each, ds.IsNull):
        return Condition(each.attribute[0], "null")
    if isinstance(each, ds.IsNotNull):
        return Condition(each.attribute[0], "null", wanted=False)
    op = _COMPARED.get(type(each))
    return op and Condition(each.attribute[0], op, each.value)


def read_paged(
    spark: SparkSession,
    service: PageService,
    schema: T.StructType | str,
    deleted_flag: str = "IsDeleted",
    include_deleted: bool = False,
    pages_per_task: int = PAGES_PER_TASK,
    flat: bool = True,
) -> DataFrame:
    """Records of all pages, one task for `pages_per_task` pages.

    `schema` names what is wanted of a record; nested lookups become columns
    named `Parent.Field` unless `flat` is off. Fields that a record lacks are
    NULL, others are dropped. Soft-deleted records are left out unless asked
    for; a NULL flag counts as not deleted. Filters on text, whole-number, decimal,
    date and boolean columns of the frame go to the service if it understands them.
    Turns Python filter push-down on for the session.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if pages_per_task < 1:
        raise ValueError("a task reads at least one page")
    spark.conf.set(PUSHDOWN, True)
    spark.dataSource.register(ObjectPages(service, schema, pages_per_task).source())
    df = spark.read.format(FORMAT).load()
    if deleted_flag in df.columns and not include_deleted:
        # Two simple filters, which can be sent, in place of one that can't.
        df = df.filter(~col(deleted_flag).eqNullSafe(F.lit(True)))
    return flatten(df) if flat else df


@dataclass(frozen=True)
class PageFolder:
    """Pages as files of JSON objects, each with a `records` array, below `folder`/page=<number>.

    Stands for a service that keeps its answers in a shared folder; a page may have several files.
    """

    folder: str
    records: str = "records"

    def _at(self, below: str = "") -> tuple[fs.FileSystem, str]:
        if self.folder.startswith("file:"):
            system, path = fs.LocalFileSystem(), "/" + self.folder[5:].lstrip("/")
        elif "://" not in self.folder:
            system, path = fs.LocalFileSystem(), self.folder
        else:
            system, path = fs.FileSystem.from_uri(self.folder.replace("s3a://", "s3://", 1))
        return system, f"{path}/{below}".rstrip("/")

    def pages(self) -> int:
        system, path = self._at()
        found = [f.base_name for f in system.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("page=")]
        return 1 + max((int(name[5:]) for name in found), default=-1)

    def put(self, page: int, text: str) -> None:
        """Store a page as one file, which readers see whole or not at all."""
        system, path = self._at(f"page={page}")
        system.create_dir(path, recursive=True)
        aside = f"{path}/.{uuid.uuid4().hex}"
        with system.open_output_stream(aside) as stream:
            stream.write(text.encode() + b"\n")
        system.move(aside, f"{path}/page.json")

    def understands(self, condition: Condition) -> bool:
        """JSON holds texts, whole numbers and booleans as such; dates and decimals are left to Spark."""
        values = condition.value if isinstance(condition.value, (list, tuple)) else [condition.value]
        return all(v is None or isinstance(v, (str, int, bool)) for v in values)

    def fetch(self, page: int, conditions: Sequence[Condition]) -> list[dict]:
        system, path = self._at(f"page={page}")
        found: list[dict] = []
        for file in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if file.type == fs.FileType.File and not file.base_name.startswith((".", "_")):
                with system.open_input_stream(file.path) as stream:
                    for line in stream.read().splitlines():
                        found += json.loads(line)[self.records]
        return [r for r in found if all(meets(r.get(c.column), c) for c in conditions)]


def store_pages(pages: DataFrame, folder: str) -> None:
    """Store each row as the JSON object of its `page`, the way `PageFolder` reads them; `page` is unique.

    The tasks write by the file system that the pages are read by. Spark's writer has a
    folder and a commit for each of so many small files, and its driver moves them one by one.
    A repeated task puts the same pages in place again.
    """
    service = PageFolder(folder)
    service._at()[0].create_dir(service._at()[1], recursive=True)
    body = F.to_json(F.struct(*[col(c) for c in pages.columns if c != "page"]))

    def store(rows: Iterator[Row]) -> None:
        for page, text in rows:
            service.put(page, text)

    pages.select("page", body.alias("body")).foreachPartition(store)


def meets(value: object, condition: Condition) -> bool:
    """Whether a record's value meets a condition, as in SQL: unknown is no."""
    op, other = condition.op, condition.value
    if op == "null":
        return (value is None) == condition.wanted
    if op == "<=>":
        return (value == other) == condition.wanted
    if value is None or other is None:
        return False
    if op == "in":
        if value in other:
            return condition.wanted
        return not condition.wanted and None not in other
    met = {
        "=": lambda: value == other,
        "<": lambda: value < other,
        "<=": lambda: value <= other,
        ">": lambda: value > other,
        ">=": lambda: value >= other,
    }[op]()
    return met == condition.wanted
