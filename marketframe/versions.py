"""Tables published in two phases: data folders first, then one small pointer file.

A store is a folder of tables.  A run writes its rows below ``<table>/<partitions>/version=<run>``, which no reader
looks at yet, and then publishes: a new file in ``_versions`` lists the folders that make up every table from now on.
Folders that a run doesn't touch are listed again, not copied.  A reader resolves the newest complete list once, so it
sees one version of all tables as a whole, whatever a run does meanwhile; a run that dies before it publishes leaves
folders that nobody lists.

The lists have a line per folder and table schema: partitions of a table are timeframes by years, a few hundred.  They
are made by one exclusive create each, so of two runs that started from the same version the second one fails.
"""

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTS = "_versions"
END = "end"


class Superseded(RuntimeError):
    """Another run has published since this one began."""


@dataclass(frozen=True)
class Version:
    """What a store consists of: per table its folders, relative to the store, and its schema."""

    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)

    def partitions(self, table: str) -> dict[str, list[str]]:
        """The table's folders by partition."""
        found: dict[str, list[str]] = {}
        for folder in self.folders.get(table, []):
            found.setdefault(partition_of(folder), []).append(folder)
        return found


def partition_of(folder: str) -> str:
    return folder.rpartition("/")[0]


def new_run() -> str:
    return f"run-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path: any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, path: str) -> list[int]:
    files, where = _files(spark, f"{path}/{LISTS}")
    names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _read_list(spark: SparkSession, path: str, number: int) -> Version | None:
    files, where = _files(spark, f"{path}/{LISTS}/{number:010d}")
    stream = files.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    lines = text.split("\n")
    if lines[-1] != END:
        return None  # still being written, or cut off
    version = Version(number)
    for entry in map(json.loads, lines[:-1]):
        version.schemas[entry["table"]] = entry["schema"]
        version.folders[entry["table"]] = entry["folders"]
    return version


def current(spark: SparkSession, path: str) -> Version:
    """The newest version; one without tables if nothing was published yet."""
    for number in _numbers(spark, path):
        if version := _read_list(spark, path, number):
            return version
    return Version()


def read_folders(spark: SparkSession, path: str, version: Version, table: str, folders: Iterable[str] | None = None) -> DataFrame | None:
    """The rows of a table, or of some of its folders; None if the version has no such rows."""
    folders = version.folders.get(table, []) if folders is None else list(folders)
    if not folders:
        return None
    schema = T.StructType.fromJson(json.loads(version.schemas[table]))
    places: dict[str, list[str]] = {}  # a table may list folders that were written beside those of another one
    for f in folders:
        places.setdefault(f.partition("/")[0], []).append(f"{path}/{f}")
    read = [spark.read.schema(schema).option("basePath", f"{path}/{place}").parquet(*paths) for place, paths in places.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)


def write_folders(rows: DataFrame, path: str, table: str, partitions: Iterable[str], run: str) -> list[str]:
    """Write rows into folders of this run, which may have some already; returns the run's folders of the table."""
    spark, partitions = rows.sparkSession, list(partitions)
    writer = rows.withColumn("version", F.lit(run)).write.mode("append").partitionBy(*partitions, "version")
    writer.option("compression", "zstd").parquet(f"{path}/{table}")
    files, where = _files(spark, f"{path}/{table}" + "/*" * len(partitions) + f"/version={run}")
    depth = len(partitions) + 2
    return sorted("/".join(s.getPath().toString().split("/")[-depth:]) for s in files.globStatus(where) or [])


def merged_schema(version: Version, table: str, rows: DataFrame) -> str:
    """The table's schema with the columns that ``rows`` adds."""
    known = T.StructType.fromJson(json.loads(version.schemas[table])) if table in version.schemas else T.StructType()
    added = [T.StructField(f.name, f.dataType) for f in rows.schema if f.name not in known.names]
    return T.StructType([*known.fields, *added]).json()


def publish(spark: SparkSession, path: str, based_on: Version, folders: dict[str, list[str]], schemas: dict[str, str]) -> Version:
    """Make these tables the newest version; tables that are not named stay as they are."""
    tables, known = {**based_on.folders, **folders}, {**based_on.schemas, **schemas}
    lines = [json.dumps({"table": t, "schema": known[t], "folders": f}) for t, f in tables.items()]
    numbers = _numbers(spark, path)
    if current(spark, path).number != based_on.number:
        raise Superseded(f"{path} has changed since version {based_on.number} was read")
    number = max([based_on.number, *numbers]) + 1  # beyond lists that were cut off
    files, where = _files(spark, f"{path}/{LISTS}/{number:010d}")
    try:
        stream = files.create(where, False)
    except Py4JJavaError as error:
        if files.exists(where):
            raise Superseded(f"another run is publishing version {number} of {path}") from error
        raise
    try:
        stream.write(bytearray("\n".join([*lines, END]).encode()))
    finally:
        stream.close()
    return Version(number, tables, known)


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the folders that none of the newest ``keep`` versions list, and the older lists; returns the folders deleted.

    Only folders that an older list names are looked at, so a run under way loses nothing.
    """
    numbers = _numbers(spark, path)
    newest = [v for n in numbers if (v := _read_list(spark, path, n))][:keep]
    older = [n for n in numbers if newest and n < newest[-1].number]
    used = {f for v in newest for fs in v.folders.values() for f in fs}
    gone = {f for n in older if (v := _read_list(spark, path, n)) for fs in v.folders.values() for f in fs} - used
    delete(spark, path, [*sorted(gone), *[f"{LISTS}/{n:010d}" for n in older]])
    return len(gone)


def delete(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    """Delete folders or files of a store, such as folders of this run that it will not publish."""
    for name in names:
        files, where = _files(spark, f"{path}/{name}")
        files.delete(where, True)
