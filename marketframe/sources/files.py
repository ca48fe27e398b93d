"""A data source for folders of very many small files: listed and read inside tasks.

The driver knows folders only.  It cuts the root folder, and with ``recursive`` each folder directly below it, into
``slices``; a task lists one folder and takes the files whose names fall into its slice by their hash.  So no list of
files exists on the driver, and files of zero bytes, which Spark's own readers skip, are noticed where they are read.

    spark.dataSource.register(SmallFiles)
    spark.read.format("small_files").option("glob", "*.json").load("s3://bucket/statements")

Columns: ``source_file`` (the path below the root) and ``raw`` (the text; bytes that are not UTF-8 become U+FFFD).
With the option ``first_line`` the text ends before the first line break, and no more of the file is read.
Stores are those that ``pyarrow.fs`` reaches: local and mounted folders, S3, HDFS, GCS.  Files and folders whose names
begin with ``_`` or ``.`` are passed over, as Spark does.
"""

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase
from zlib import crc32

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# travels to the executors by value: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "source_file string, raw string"
SLICES = 32
#: Text handed to Spark at a time, about, and files at most.
BATCH_BYTES = 8 << 20
BATCH_FILES = 1_000
HEAD_BYTES = 64 << 10


@dataclass
class Slice(InputPartition):
    """Files of one folder whose names fall into one slice; ``deep`` takes those in its sub-folders as well."""

    folder: str
    deep: bool
    number: int
    of: int


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, and the path within it."""
    scheme, colon, rest = path.partition(":")
    if scheme == "file" and colon:
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


def first_line(stream: pa.NativeFile) -> bytes:
    """What comes before the first line break, without a byte order mark."""
    parts = []
    while part := stream.read(HEAD_BYTES):
        line, *more = re.split(rb"[\r\n]", part, maxsplit=1)
        parts.append(line)
        if more:
            break
    return b"".join(parts).removeprefix(b"\xef\xbb\xbf")


def visible(path: str) -> bool:
    return path.rpartition("/")[2][:1] not in ("_", ".")


class SmallFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "small_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "SmallFilesReader":
        return SmallFilesReader(self.options)


class SmallFilesReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/") or "/"
        self.glob = options.get("glob", "*")
        self.recursive = str(options.get("recursive", "false")).lower() == "true"
        self.slices = int(options.get("slices", SLICES))
        self.first_line = str(options.get("first_line", "false")).lower() == "true"

    def partitions(self) -> list[Slice]:
        """One slice after the other of the root, then of each folder below it."""
        store, root = open_store(self.path)
        if store.get_file_info(root).type != fs.FileType.Directory:
            raise FileNotFoundError(f"{self.path} is no folder")
        folders = [(root, False)]
        if self.recursive:
            below = store.get_file_info(fs.FileSelector(root))
            folders += sorted((f.path, True) for f in below if f.type == fs.FileType.Directory and visible(f.path))
        each = max(1, self.slices // len(folders))
        return [Slice(folder, deep, i, each) for folder, deep in folders for i in range(each)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        store, root = open_store(self.path)
        names, texts, held = [], [], 0
        for path in self._files(store, partition.folder, partition.deep):
            name = path[len(root) :].lstrip("/")
            if crc32(name.encode()) % partition.of != partition.number:
                continue
            with store.open_input_stream(path) as stream:
                text = first_line(stream) if self.first_line else stream.read()
            names.append(name)
            texts.append(text.decode("utf-8", "replace"))
            held += len(text)
            if held > BATCH_BYTES or len(names) >= BATCH_FILES:
                yield self._batch(names, texts)
                names, texts, held = [], [], 0
        if names:
            yield self._batch(names, texts)

    def _files(self, store: fs.FileSystem, folder: str, deep: bool) -> Iterator[str]:
        below = []
        for info in store.get_file_info(fs.FileSelector(folder)):
            if not visible(info.path):
                continue
            if info.type == fs.FileType.File and fnmatchcase(info.base_name, self.glob):
                yield info.path
            elif info.type == fs.FileType.Directory and deep:
                below.append(info.path)
        for path in below:
            yield from self._files(store, path, deep)

    @staticmethod
    def _batch(names: list[str], texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["source_file", "raw"])
