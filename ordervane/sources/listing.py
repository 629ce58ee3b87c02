"""Listing of lake files by executors, as a data source with a partition per folder.

Spark's own readers list all files on the driver before they start. Here the driver looks at
the upper folders only, until there are ``FOLDERS`` of them, and each task lists what lies below one
of these. Works for file systems that executors reach through Arrow (local and mounted folders, S3, GCS, HDFS).
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Upper folders that the driver looks for; each becomes a partition.
FOLDERS = 64
SCHEMA = "name string, size bigint, last_modified timestamp"
# Spark's names of stores, and Arrow's.
SCHEMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "gs": "gs", "hdfs": "hdfs"}


def can_list(path: str) -> bool:
    return urlsplit(path).scheme in SCHEMES


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    parts = urlsplit(path)
    kind = SCHEMES[parts.scheme]
    if kind == "file":
        return fs.LocalFileSystem(), parts.path.rstrip("/") or "/"
    return fs.FileSystem.from_uri(f"{kind}://{parts.netloc}{parts.path.rstrip('/')}")


def _shown(name: str) -> bool:
    """Whether readers see a file or folder of this name; others belong to writers."""
    return not name.startswith(("_", "."))


class _Folder(InputPartition):
    def __init__(self, path: str, deep: bool):
        super().__init__(path)
        self.deep = deep


class _Reader(DataSourceReader):
    def __init__(self, root: str, prefix: str):
        self.root = root.rstrip("/")
        self.prefix = prefix.strip("/")

    def partitions(self) -> list[InputPartition]:
        store, root = _store(self.root)
        top = f"{root}/{self.prefix}".rstrip("/")
        if store.get_file_info(top).type != fs.FileType.Directory:
            return [_Folder(top, False)]
        shallow, level = [], [top]
        while level and len(level) + len(shallow) < FOLDERS:
            shallow += level
            level = [f.path for folder in level for f in store.get_file_info(fs.FileSelector(folder))
                     if f.type == fs.FileType.Directory and _shown(f.base_name)]
        return [_Folder(f, False) for f in shallow] + [_Folder(f, True) for f in level]

    def read(self, partition: _Folder) -> Iterator[pa.RecordBatch]:
        store, root = _store(self.root)
        selected = fs.FileSelector(partition.value, recursive=partition.deep, allow_not_found=True)
        top = len(partition.value.rstrip("/")) + 1
        found = [f for f in store.get_file_info(selected)
                 if f.type == fs.FileType.File and all(map(_shown, f.path[top:].split("/")))]
        names = [f.path[len(root.rstrip("/")) + 1:] for f in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([f.size for f in found], pa.int64()),
             pa.array([f.mtime for f in found], pa.timestamp("us", tz="UTC"))], ["name", "size", "last_modified"])


class LakeListing(DataSource):
    """Options: ``root``, to which names are relative, and ``prefix``."""

    @classmethod
    def name(cls) -> str:
        return "lake_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["root"], self.options.get("prefix", ""))
