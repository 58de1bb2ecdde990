"""Named files as a sink that commits: a Python data source whose files appear together or not at all.

Tasks write below a staging folder of their attempt on the target's own file
system; when every task has succeeded a second job moves the files to their
names, a task for each staging folder, so that the driver holds and moves none
of them.  (Saved without :func:`write_named`, the driver moves them.)  A failed
job, and every attempt but the one that counts, leaves nothing.  Any file system
that Arrow can open by its URI will do; a path without a scheme is local.
"""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as afs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "named_files"
#: Staging folders that the driver empties at once.
MOVES = 32
#: In a staging folder, the names of the folders of the attempts that count.
WRITTEN = "written"


def file_system(uri: str) -> tuple[afs.FileSystem, str]:
    """The file system of a URI and the path in it."""
    if uri.startswith("file:"):
        return afs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return afs.FileSystem.from_uri(uri) if "://" in uri else (afs.LocalFileSystem(), uri)


def read_bytes(uri: str) -> bytes:
    """A whole file, read where it is needed."""
    system, path = file_system(uri)
    with system.open_input_file(path) as f:
        return f.read()


def entries(system: afs.FileSystem, at: str) -> Iterator[tuple[str, bool, int, int]]:
    """name, whether a folder, time in microseconds and length of what stands in a folder; a local one is not held as a whole."""
    if isinstance(system, afs.LocalFileSystem):
        with os.scandir(at) as found:
            for x in found:
                info = x.stat()
                yield x.name, x.is_dir(), info.st_mtime_ns // 1_000_000 * 1000, info.st_size
        return
    for x in system.get_file_info(afs.FileSelector(at)):
        yield x.base_name, x.type == afs.FileType.Directory, (x.mtime_ns or 0) // 1_000_000 * 1000, x.size or 0


@dataclass
class Staged(WriterCommitMessage):
    """What a task wrote: its staging folder and the number of files."""

    folder: str
    files: int


class NamedFiles(DataSource):
    """``format("named_files").save(uri)`` of rows (name, content): a file each, its name relative to the target."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:  # noqa: ANN001
        return NamedFilesWriter(self.options["path"], self.options.get("job") or uuid.uuid4().hex, self.options.get("stay") == "true")


def move_all(system: afs.FileSystem, folder: str, root: str) -> int:
    """Move the files of a staging folder to their names below ``root`` and drop it; what an earlier attempt moved is there no more."""
    if system.get_file_info(folder).type != afs.FileType.Directory:
        return 0
    count, folders = 0, [""]
    while folders:
        at = folders.pop()
        made = not at
        for name, is_folder, *_ in entries(system, folder + at):
            if is_folder:
                folders.append(f"{at}/{name}")
                continue
            if not made:
                system.create_dir(root + at, recursive=True)
                made = True
            system.move(f"{folder}{at}/{name}", f"{root}{at}/{name}")
            count += 1
    system.delete_dir(folder)
    return count


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, uri: str, job: str, stay: bool = False):
        self.uri, self.job, self.stay = uri.rstrip("/"), job, stay

    def _staging(self) -> tuple[afs.FileSystem, str, str]:
        system, root = file_system(self.uri)
        return system, root, f"{root}/_staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, _, staging = self._staging()
        task, count, made = TaskContext.get(), 0, set()
        own = f"{staging}/{task.partitionId()}-{task.taskAttemptId()}"
        for batch in iterator:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                if name is None or not content.is_valid:
                    continue
                if name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"not a name below the target: {name}")
                path = f"{own}/{name}"
                if (folder := posixpath.dirname(path)) not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(path) as f:
                    f.write(content.as_buffer())
                count += 1
        return Staged(own, count)

    def commit(self, messages: list[Staged | None]) -> None:
        system, root, staging = self._staging()
        system.create_dir(root, recursive=True)
        written = [m.folder for m in messages if m is not None and m.files]
        if self.stay:  # whoever saves moves
            system.create_dir(staging, recursive=True)
            with system.open_output_stream(f"{staging}/{WRITTEN}") as f:
                f.write("\n".join(written).encode())
            return
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda folder: move_all(system, folder, root), written))
        self._drop(system, staging)

    def abort(self, messages: list[Staged | None]) -> None:
        system, _, staging = self._staging()
        self._drop(system, staging)

    @staticmethod
    def _drop(system: afs.FileSystem, staging: str) -> None:
        if system.get_file_info(staging).type == afs.FileType.Directory:
            system.delete_dir(staging)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share; of this machine where a local session sets none."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = f"file://{tempfile.gettempdir()}/quireflow-shared"
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedFiles)


def write_named(rows: DataFrame, folder: str) -> None:
    """Every row (name, content: text or bytes) as a file below ``folder``, all or none; nulls are no files."""
    spark, job = rows.sparkSession, uuid.uuid4().hex
    register(spark)
    own = rows.select("name", F.col("content").cast("binary").alias("content")).filter("name is not null and content is not null")
    own.write.format(FORMAT).option("job", job).option("stay", "true").mode("append").save(folder)
    writer = NamedFilesWriter(folder, job)
    system, root, staging = writer._staging()
    try:
        with system.open_input_file(f"{staging}/{WRITTEN}") as f:
            written = f.read().decode().split("\n")
        _move_by_tasks(spark, folder.rstrip("/"), root, [x for x in written if x])
    finally:
        writer._drop(system, staging)


def _move_by_tasks(spark: SparkSession, uri: str, root: str, written: list[str]) -> None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(uri)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([move_all(system, written[at], root) for at in batch.column("id").to_pylist()], pa.int64())], ["moved"])

    if written:
        spark.range(len(written), numPartitions=len(written)).mapInArrow(run, "moved long").agg(F.sum("moved")).collect()
