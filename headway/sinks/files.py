"""Single files, one per row, written by the tasks that hold the rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "headway_files"

# Tasks are sent rows of this many bytes at once; a file may be larger than that.
BATCH_BYTES = "8m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@dataclass
class Written(WriterCommitMessage):
    """What a task has written; its files are in place already."""

    files: int
    size: int


class FileWriter(DataSourceArrowWriter):
    """Rows to files: ``filename``, which may have folders, and ``content``.

    A file appears whole or not at all, at a name that follows from the row alone.  So a task
    that is run again, or twice at once, writes the same bytes to the same places, and there
    is nothing to move or undo when the job commits or fails.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import uuid

        system, base = fs.FileSystem.from_uri(self.path.replace("s3a://", "s3://", 1))
        local = isinstance(system, fs.LocalFileSystem)
        files = size = 0
        batch = names = contents = content = None
        made: set[str] = set()
        for batch in iterator:
            names, contents = batch.column("filename"), batch.column("content")
            for at in range(batch.num_rows):
                name, content = names[at].as_py(), contents[at].as_py() or b""
                if not name:
                    raise ValueError("a row has no filename")
                target = f"{base}/{name}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                # An object store shows a file once it is closed; a file system needs a rename.
                place = f"{folder}/.{uuid.uuid4().hex}" if local else target
                with system.open_output_stream(place) as out:
                    out.write(content)
                if local:
                    system.move(place, target)
                files, size = files + 1, size + len(content)
        # The worker lives on for other tasks.
        del batch, names, contents, content
        pa.default_memory_pool().release_unused()
        return Written(files, size)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing to do: the files are where they belong."""

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Whole files of ended tasks stay; the next run writes the same ones."""


class FileSink(DataSource):
    """The format that :func:`write_files` writes; option ``path`` names the folder."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: object, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"].rstrip("/"))


def write_files(files: DataFrame, path: str) -> None:
    """Write ``filename`` and ``content`` of every row as a file below ``path``.

    ``path`` is a local folder that all executors share or a URI that Arrow's file systems
    know.  Null content gives a file of length 0; a null or empty name is an error.  Names
    that occur twice keep one of their contents.  Files that are there already stay unless
    a row has their name.  Nothing is shuffled, and the driver sees counts only.  Every Python
    step of the plan takes batches of ``BATCH_BYTES``, as several of them hold one at a time.
    """
    spark = files.sparkSession
    spark.dataSource.register(FileSink)
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    try:
        files.select("filename", "content").write.format(FORMAT).mode("append").option("path", path).save()
    finally:
        spark.conf.set(_BATCH_SETTING, before)
