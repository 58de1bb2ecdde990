"""Files below a folder as rows, listed and read by tasks.

Spark's file index holds every name on the driver, and its readers take a few
small files a task.  Here the driver knows the folder only: one task lists what
stands in it, tasks walk its subfolders, and the names are dealt out by hash
before a byte is read.  That goes by Arrow's file systems; where those don't
reach, :func:`listed` is None and Spark's readers are left.  (Those leave empty
files out, which are rows here.)
"""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.sinks.committed import entries, file_system, read_bytes

#: Names, or bytes of files, that a task gives at a time.
NAMES, BATCH_BYTES = 10_000, 8_000_000
_FOUND = "place string, folder boolean, micros long, length long"
_KINDS = pa.schema([("place", pa.string()), ("folder", pa.bool_()), ("micros", pa.int64()), ("length", pa.int64())])
#: What Spark's patterns have beyond fnmatch's, and what makes a path a pattern.
_BEYOND, _PATTERN = ("{", "\\", "[^"), "*?[{"


def hidden(name: str) -> bool:
    """Names that Spark's readers pass over, too."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _batches(rows: Iterator[tuple[str, bool, int, int]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[str, bool, int, int]] = []
    for row in rows:
        held.append(row)
        if len(held) == NAMES:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), _KINDS.types, strict=True)], schema=_KINDS)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), _KINDS.types, strict=True)], schema=_KINDS)


def listed(spark: SparkSession, path: str, glob: str = "*", deep: bool = True) -> DataFrame | None:
    """path, modified, length of the files below a folder whose names match, hidden ones left out; None where Arrow doesn't reach.

    ``deep`` goes into subfolders.
    """
    if any(x in glob for x in _BEYOND) or any(x in path for x in _PATTERN):
        return None
    try:
        system, top = file_system(path)
        top = os.path.abspath(top) if isinstance(system, afs.LocalFileSystem) else top.rstrip("/")
        kind = system.get_file_info(top).type
    except (OSError, ValueError, NotImplementedError):
        return None
    if kind != afs.FileType.Directory:
        return None  # one file, or none: Spark says so
    uri = f"file:{top}" if isinstance(system, afs.LocalFileSystem) else path.rstrip("/")

    def first(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((f"/{name}", *rest) for name, *rest in entries(*file_system(uri)) if not hidden(name))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = file_system(uri)

        def files() -> Iterator[tuple[str, bool, int, int]]:
            for batch in batches:
                for row in map(tuple, zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                    if not row[1]:
                        yield row
                        continue
                    folders = [row[0]] if deep else []
                    while folders:
                        folder = folders.pop()
                        for name, is_folder, *rest in entries(own, at + folder):
                            if hidden(name):
                                continue
                            if is_folder:
                                folders.append(f"{folder}/{name}")
                            else:
                                yield f"{folder}/{name}", False, *rest

        yield from _batches(x for x in files() if fnmatch.fnmatchcase(x[0].rpartition("/")[2], glob))

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = spark.range(1, numPartitions=1).mapInArrow(first, _FOUND).repartition(tasks, "place").mapInArrow(walk, _FOUND)
    return found.select(F.concat(F.lit(uri), "place").alias("path"), F.timestamp_micros("micros").alias("modified"), "length")


def contents(found: DataFrame) -> DataFrame:
    """path, modified, length and content of listed files: one task reads many, some megabytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, size = 0, [], 0
            for at, path in enumerate(batch.column("path").to_pylist()):
                held.append(read_bytes(path))
                size += len(held[-1])
                if size >= BATCH_BYTES or at + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([*batch.slice(start, len(held)).columns, pa.array(held, pa.binary())], [*batch.schema.names, "content"])
                    start, held, size = at + 1, [], 0

    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(tasks, "path").mapInArrow(run, "path string, modified timestamp, length long, content binary")
