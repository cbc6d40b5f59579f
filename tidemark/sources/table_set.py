"""Sets of tables that change together: one manifest names the folder of every table, and readers open one manifest.

root/
  _sets/set=000007.json     {"tables": {"customers": "customers/part-of=3f2c…", …}, "notes": {}}
  customers/part-of=3f2c…   Parquet files, written before the manifest that names them
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.sources.tables import open_path

FOLDER = "_sets"


class SetConflict(RuntimeError):
    """Another writer has published a set since this one began."""


@dataclass(frozen=True)
class TableSet:
    """A published set: its number, the folder of each table below the root, and notes. Number 0 has no tables."""

    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


def _manifest(number: int) -> str:
    return f"set={number:06d}.json"


def set_numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the sets that can be opened, ascending."""
    folder, system = open_path(spark, root, FOLDER)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(n[4:-5]) for n in names if n.startswith("set=") and n.endswith(".json"))


def read_set(spark: SparkSession, root: str, number: int | None = None) -> TableSet:
    """The set with that number, or the newest one (number 0 if there is none)."""
    known = set_numbers(spark, root)
    if number is None:
        if not known:
            return TableSet()
        number = known[-1]
    elif number not in known:
        raise FileNotFoundError(f"no set {number} under {root}")
    path, system = open_path(spark, root, FOLDER, _manifest(number))
    stream = system.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    return TableSet(number, found["tables"], found["notes"])


def read_tables(
    spark: SparkSession, root: str, schemas: dict[str, T.StructType], of: TableSet | None = None
) -> dict[str, DataFrame]:
    """The tables of one set, all of the same one however long the reader takes and whatever is published meanwhile."""
    of = read_set(spark, root) if of is None else of
    missing = sorted(set(schemas) - set(of.folders))
    if missing:
        raise FileNotFoundError(f"set {of.number} under {root} has no {', '.join(missing)}")
    return {name: spark.read.schema(schema).parquet(f"{root}/{of.folders[name]}") for name, schema in schemas.items()}


def _link(spark: SparkSession, system: JavaObject, draft: JavaObject, place: JavaObject) -> None:
    """Give a local file a second name, which fails if that name is taken."""
    java = spark.sparkContext._jvm.java
    old, new = (java.io.File(path.toUri().getPath()).toPath() for path in (draft, place))
    java.nio.file.Files.createLink(new, old)


def _rename(spark: SparkSession, system: JavaObject, draft: JavaObject, place: JavaObject) -> None:
    """Rename a file, which fails if the new name is taken."""
    context, hadoop = spark.sparkContext, spark.sparkContext._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = context._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    files = hadoop.FileContext.getFileContext(system.getUri(), context._jsc.hadoopConfiguration())
    files.rename(draft, place, options)


def _create_once(spark: SparkSession, root: str, name: str, text: str) -> bool:
    """Put a whole file in its place unless there is one; whether it was put.

    The text is written beside it first, so that no reader meets half of it. The last step is one call of the file
    system: a rename that refuses to replace, or, on a local disk, a link, whose rename would replace.
    """
    draft, system = open_path(spark, root, FOLDER, f".draft-{uuid.uuid4().hex}")
    place, _ = open_path(spark, root, FOLDER, name)
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move = _link if system.getUri().getScheme() == "file" else _rename
    try:
        move(spark, system, draft, place)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(draft, False)
    return True


class SetWriter:
    """Tables written for the set after `before`; see `replacing`."""

    def __init__(self, spark: SparkSession, root: str, before: TableSet | None = None) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.before = read_set(spark, root) if before is None else before
        self.folders: dict[str, str] = {}
        self.notes = dict(self.before.notes)

    def place(self, name: str) -> str:
        """Path of a folder that the next set will name, for the caller to fill."""
        if name in self.folders:
            raise ValueError(f"{name} is written already")
        self.folders[name] = f"{name}/part-of={uuid.uuid4().hex}"
        return f"{self.root}/{self.folders[name]}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table of the next set, which no reader sees yet, and read it back."""
        path = self.place(name)
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self) -> TableSet:
        """Make the next set: what was written, and the former folders of all other tables."""
        after = TableSet(self.before.number + 1, {**self.before.folders, **self.folders}, self.notes)
        text = json.dumps({"tables": after.folders, "notes": after.notes}, indent=1, sort_keys=True)
        if not _create_once(self.spark, self.root, _manifest(after.number), text):
            raise SetConflict(f"set {after.number} under {self.root} was published by another writer")
        return after

    def discard(self) -> None:
        """Delete what was written."""
        for folder in self.folders.values():
            path, system = open_path(self.spark, self.root, folder)
            system.delete(path, True)
            if system.exists(path.getParent()) and not len(system.listStatus(path.getParent())):
                system.delete(path.getParent(), False)


@contextmanager
def replacing(spark: SparkSession, root: str, before: TableSet | None = None) -> Iterator[SetWriter]:
    """Write tables inside the block and publish them all at once at its end.

    `before` is the set that the new tables were made from, by default the newest one when the block begins. An error inside the block, or another writer who has published since (`SetConflict`), leaves the newest set as it is
    and nothing of what was written. A reader sees either the former set or the next, and the former can still be read.
    The root needs a file system that renames in one step and refuses to replace, as HDFS does, or a local disk.
    """
    writer = SetWriter(spark, root, before)
    try:
        yield writer
        writer.publish()
    except BaseException:
        writer.discard()
        raise


def replace_tables(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], before: TableSet | None = None
) -> TableSet:
    """Publish these tables as the next set; tables that are not named stay as they are."""
    with replacing(spark, root, before) as writer:
        for name, df in tables.items():
            writer.write(name, df)
    return read_set(spark, root, writer.before.number + 1)


def expire_sets(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Delete all but the last `keep` sets and the folders that only they name; returns their numbers.

    Folders of writers at work are named by no manifest and stay. Readers of an expired set fail.
    """
    if keep < 1:
        raise ValueError("the newest set is always kept")
    numbers = set_numbers(spark, root)
    old, kept = numbers[:-keep], numbers[-keep:]
    folders = [set(read_set(spark, root, n).folders.values()) for n in old]
    used = set().union(*[read_set(spark, root, n).folders.values() for n in kept])
    for n in old:  # manifests first, so that no set can be opened whose tables are going
        path, system = open_path(spark, root, FOLDER, _manifest(n))
        system.delete(path, False)
    for folder in sorted(set().union(*folders) - used):
        path, system = open_path(spark, root, folder)
        system.delete(path, True)
    return old
