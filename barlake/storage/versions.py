"""Which files make up a table now.

A write goes to a version folder of its own below the table, ``version=<n>-<id>``, with one folder
per storage partition it replaces.  One small file, the pointer, then names for every storage partition the
version folder that holds it, and is put in the place of the old pointer by one rename.  So readers see all
of a write or nothing of it; a frame read before keeps its files, because what a write replaces is
deleted only with the next write.  There is one writer at a time: a pointer that has moved on since the
write began is refused.  Nothing else is kept: no log of changes and no older states to travel to."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

POINTER = "_current.json"
VERSION = "version"


class Moved(RuntimeError):
    """Somebody else wrote the table meanwhile."""


@dataclass(frozen=True)
class Snapshot:
    """``folders``: storage partition folder (``trade_month=2024-01``) to version folder.
    ``sizes``: its bytes.  ``replaced``: folders of the state before, still there for its readers."""

    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)
    replaced: tuple[str, ...] = ()

    def paths(self, root: str) -> list[str]:
        return [f"{root.rstrip('/')}/{version}/{partition}" for partition, version in sorted(self.folders.items())]


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its terms."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _files(spark, path)
    return fs.exists(location)


def size_of(spark: SparkSession, path: str) -> int:
    fs, location = _files(spark, path)
    return fs.getContentSummary(location).getLength()


def _subfolders(spark: SparkSession, path: str) -> list[str]:
    fs, location = _files(spark, path)
    found = fs.listStatus(location) if fs.exists(location) else []
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def current(spark: SparkSession, path: str) -> Snapshot | None:
    """The table's state; None for a plain folder of Parquet files, or for nothing."""
    fs, location = _files(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(location):
        return None
    stream = fs.open(location)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot(**{k: tuple(v) if k == "replaced" else v for k, v in json.loads(text).items()})


def move(spark: SparkSession, old: str, new: str) -> None:
    fs, location = _files(spark, old)
    if not fs.rename(location, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not rename {old} to {new}")


def _point(spark: SparkSession, path: str, snapshot: Snapshot) -> None:
    """Put the pointer in place: written apart, then renamed over the old one."""
    jvm, root = spark._jvm, path.rstrip("/")
    fs, fresh = _files(spark, f"{root}/_pointer-{uuid.uuid4().hex}")
    stream = fs.create(fresh, True)
    stream.write(bytearray(json.dumps(vars(snapshot)).encode()))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    place = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, place, options)


def create(spark: SparkSession, path: str) -> None:
    """An empty table, where there is nothing yet."""
    if not exists(spark, path):
        _point(spark, path, Snapshot())


def version_folder(before: Snapshot) -> str:
    return f"{VERSION}={before.number + 1:08d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, path: str, before: Snapshot, version: str) -> Snapshot:
    """Make the storage partitions in the folder ``version`` the current ones.

    Deletes what the state before ``before`` still held."""
    root = path.rstrip("/")
    now = current(spark, path)
    if now is not None and now.number != before.number:
        raise Moved(f"{path}: written by somebody else since version {before.number}")
    written = [name for name in _subfolders(spark, f"{root}/{version}") if "=" in name]
    sizes = {name: size_of(spark, f"{root}/{version}/{name}") for name in written}
    replaced = tuple(f"{before.folders[name]}/{name}" for name in written if name in before.folders)
    folders = {**before.folders, **dict.fromkeys(written, version)}
    after = Snapshot(before.number + 1, folders, {**before.sizes, **sizes}, replaced)
    _point(spark, path, after)
    _delete(spark, root, before.replaced, after)
    return after


def _delete(spark: SparkSession, root: str, folders: tuple[str, ...], after: Snapshot) -> None:
    """Delete partition folders, and version folders that hold none any more."""
    for folder in folders:
        fs, location = _files(spark, f"{root}/{folder}")
        fs.delete(location, True)
    held = {*after.folders.values(), *(name.split("/")[0] for name in after.replaced)}
    for version in {name.split("/")[0] for name in folders} - held:
        fs, location = _files(spark, f"{root}/{version}")
        fs.delete(location, True)
