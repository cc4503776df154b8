"""A queue's dump as a stream of its own: files of messages, read so many messages a micro-batch.

A dump is a folder of Parquet files with a binary column ``value``, added in the order of their names and never changed. An
offset is a file's name and a number of its rows, so a stream goes on in the middle of a file after a restart. Only names and
row counts are looked at where the stream is planned; the messages are read by the tasks. Paths are those pyarrow can open.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Messages of a micro-batch, and of one task in it.
LIMIT, TASK = 10, 10_000


class Stretch(InputPartition):
    """Rows of one file."""

    def __init__(self, name: str, first: int, end: int):
        self.name, self.first, self.end = name, first, end


class QueueDump(DataSource):
    """``spark.readStream.format("queue_dump").option("path", folder).option("limit", messages)``."""

    @classmethod
    def name(cls) -> str:
        return "queue_dump"

    def schema(self) -> str:
        return "value binary"

    def streamReader(self, schema: StructType) -> DumpReader:
        limit = int(self.options.get("limit", LIMIT))
        if limit < 1 or not self.options.get("path"):
            raise ValueError("a queue dump needs a path and a limit of at least one message")
        return DumpReader(self.options["path"], limit)


class DumpReader(DataSourceStreamReader):
    def __init__(self, path: str, limit: int):
        self.path, self.limit = path, limit
        self.reached: dict | None = None
        self.rows: dict[str, int] = {}  # of files seen; they never change

    def _files(self) -> list[str]:
        files, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._")

    def _open(self, name: str) -> pq.ParquetFile:
        files, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        return pq.ParquetFile(f"{root}/{name}", filesystem=files)

    def _many(self, name: str) -> int:
        if name not in self.rows:
            with self._open(name) as opened:
                self.rows[name] = opened.metadata.num_rows
        return self.rows[name]

    def _between(self, start: dict, names: list[str]) -> Iterator[tuple[str, int, int]]:
        """Names, first rows and row counts of what follows an offset."""
        for name in names:
            first = start["row"] if name == start["file"] else 0
            if name >= start["file"] and first < self._many(name):
                yield name, first, self._many(name)

    def initialOffset(self) -> dict:
        return {"file": "", "row": 0}

    def latestOffset(self) -> dict:
        """The offset so many messages on, or where the dump ends."""
        at = self.reached or self.initialOffset()
        left = self.limit
        for name, first, many in self._between(at, self._files()):
            taken = min(left, many - first)
            at, left = {"file": name, "row": first + taken}, left - taken
            if not left:
                break
        self.reached = at
        return at

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        # after a restart the last micro-batch is planned first: the stream goes on behind it
        self.reached = self.reached or end
        out = []
        for name, first, many in self._between(start, [n for n in self._files() if n <= end["file"]]):
            stop = end["row"] if name == end["file"] else many
            out += [Stretch(name, at, min(at + TASK, stop)) for at in range(first, stop, TASK)]
        return out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        at = 0
        with self._open(partition.name) as opened:
            for group in range(opened.num_row_groups):
                many = opened.metadata.row_group(group).num_rows
                if at < partition.end and at + many > partition.first:
                    values = opened.read_row_group(group, columns=["value"]).column("value").combine_chunks()
                    first = max(partition.first - at, 0)
                    yield pa.RecordBatch.from_arrays([values.slice(first, min(partition.end - at, many) - first).cast(pa.binary())], ["value"])
                at += many

    def commit(self, end: dict) -> None:
        """Nothing is deleted: offsets are kept by the stream's checkpoint."""
