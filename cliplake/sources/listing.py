"""A Spark data source that lists files: folders are dealt to tasks, which list them.

File names never pass through the driver; it lists only the upper folders, to deal them out.  Empty
files are listed like all others, and no file is opened.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "file_listing"
SCHEMA = "path string, length bigint, modificationTime timestamp"
#: Folders after which the driver stops looking for further ones to deal out.
FOLDERS = 256
#: Rows of a batch.
ROWS = 10_000


@dataclass
class Folder(InputPartition):
    """A folder to list, with or without those below it."""

    uri: str
    deep: bool


class FileListing(DataSource):
    """Options: ``folders`` (a JSON list of URIs or paths), ``recursive`` (true or false)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        folders = json.loads(self.options.get("folders", "[]"))
        return ListingReader(folders, self.options.get("recursive", "false") == "true")


def _opened(uri: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what stands before the path in names of files."""
    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", uri), "file:"
    system, path = fs.FileSystem.from_uri(uri)
    return system, path, uri.removesuffix("/")[: -len(path)] if uri.removesuffix("/").endswith(path) else ""


def _seen(info: fs.FileInfo) -> bool:
    """Names that begin with a dot or an underscore are not data, as in all of Spark's sources."""
    return not info.base_name.startswith((".", "_"))


class ListingReader(DataSourceReader):
    def __init__(self, folders: list[str], recursive: bool) -> None:
        self.folders, self.recursive = folders, recursive

    def partitions(self) -> list[InputPartition]:
        """One for every folder; of deep trees the upper folders alone, and the trees below them."""
        if not self.recursive:
            return [Folder(uri, False) for uri in self.folders]
        waiting, dealt = deque(self.folders), []
        while waiting and len(waiting) + len(dealt) < FOLDERS:
            uri = waiting.popleft()
            system, path, before = _opened(uri)
            below = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
            dealt.append(Folder(uri, False))
            waiting.extend(before + info.path for info in below if info.type == fs.FileType.Directory and _seen(info))
        return dealt + [Folder(uri, True) for uri in waiting]

    def read(self, partition: Folder | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no folder at all
            return
        system, path, before = _opened(partition.uri)
        waiting = deque([path])
        while waiting:
            found = system.get_file_info(fs.FileSelector(waiting.popleft(), allow_not_found=True))
            files = [info for info in found if info.type == fs.FileType.File and _seen(info)]
            if partition.deep:
                waiting.extend(info.path for info in found if info.type == fs.FileType.Directory and _seen(info))
            for at in range(0, len(files), ROWS):
                some = files[at : at + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([before + info.path for info in some]),
                        pa.array([info.size for info in some], pa.int64()),
                        pa.array([info.mtime for info in some], pa.timestamp("us", "UTC")),
                    ],
                    ["path", "length", "modificationTime"],
                )


def listed(spark: SparkSession, folders: list[str], recursive: bool = False) -> DataFrame:
    """Path, length and time of all files in the folders; folders that are not there add nothing.

    A path is repeated when folders overlap.
    """
    spark.dataSource.register(FileListing)
    reader = spark.read.format(NAME).option("folders", json.dumps(folders))
    return reader.option("recursive", "true" if recursive else "false").load()
