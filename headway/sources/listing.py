"""Listing of stored snapshots, as a source of its own."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from headway.schemas import FILE_LISTING

FORMAT = "headway_listing"
DAY_LISTING = T.StructType(FILE_LISTING.fields + [T.StructField("day", T.StringType())])

_ROWS = 10_000
_ARROW = pa.schema(
    [
        ("filename", pa.string()),
        ("size", pa.int64()),
        ("modified", pa.timestamp("us", "UTC")),
        ("day", pa.string()),
    ]
)


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _children(path: str) -> list[fs.FileInfo]:
    system, base = _opened(path)
    return system.get_file_info(fs.FileSelector(base, allow_not_found=True))


class ListingReader(DataSourceReader):
    """One partition for each folder; a day that the query names is the only one opened."""

    def __init__(self, path: str, pattern: str, by_day: bool) -> None:
        self.path, self.pattern, self.by_day = path, pattern, by_day
        self.days: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for asked in filters:
            if isinstance(asked, (EqualTo, In)) and asked.attribute == ("day",):
                values = {asked.value} if isinstance(asked, EqualTo) else set(asked.value)
                self.days = values if self.days is None else self.days & values
            else:
                yield asked

    def partitions(self) -> Sequence[InputPartition]:
        if not self.by_day:
            return [InputPartition("")]
        if self.days is not None:
            return [InputPartition(day) for day in sorted(self.days)] or [InputPartition(None)]
        found = [""]
        for _ in range(3):  # year, month, day
            found = [
                f"{above}/{info.base_name}".strip("/")
                for above in found
                for info in _children(f"{self.path}/{above}")
                if info.type == fs.FileType.Directory
            ]
        return [InputPartition(day) for day in sorted(found)] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        day = partition.value
        if day is None:
            return
        files = [
            info
            for info in _children(f"{self.path}/{day}".rstrip("/"))
            if info.type == fs.FileType.File and fnmatchcase(info.base_name, self.pattern)
        ]
        for start in range(0, len(files), _ROWS):
            some = files[start : start + _ROWS]
            columns = (
                [info.base_name for info in some],
                [info.size for info in some],
                [info.mtime for info in some],
                [day or None] * len(some),
            )
            arrays = [pa.array(c, kind) for c, kind in zip(columns, _ARROW.types)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


class Listing(DataSource):
    """Files of a folder: options ``path``, ``pattern`` and ``by_day``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return DAY_LISTING

    def reader(self, schema: T.StructType) -> ListingReader:
        options = self.options
        return ListingReader(options["path"].rstrip("/"), options["pattern"], options["by_day"] == "true")


def _listing(spark: SparkSession, path: str, pattern: str, by_day: bool) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Listing)
    options = {"path": path, "pattern": pattern, "by_day": str(by_day).lower()}
    return spark.read.format(FORMAT).options(**options).load()


def list_snapshots(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Name, size and modification time of each file of a folder, and not of those below it.

    Files of length 0 are listed like any other.  No file is opened.  A folder that does not
    exist gives no rows.  ``path`` is a local folder or a URI that Arrow's file systems know.
    """
    return _listing(spark, path, pattern, by_day=False).drop("day")


def list_days(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """The files of all day folders, three levels below ``path``, with ``day``: that folder.

    Each day is listed by a task of its own.  A filter on ``day`` (equal to a value, or one
    of several) is pushed down: no other folder is looked into, not even by the driver.
    """
    return _listing(spark, path, pattern, by_day=True)
