"""Tables of a run in a folder: each stage is written once, and a run that was cut short goes on where it stopped."""

from __future__ import annotations

import dataclasses
import hashlib
import json

from pyarrow.fs import FileType
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.config import Settings
from quireflow.sinks.committed import file_system, shared_folder


def fingerprint(docs: DataFrame, settings: Settings, ready: dict[str, bool]) -> str:
    """What a run's tables depend on: its documents, its settings, and which components there are.

    Documents count by path, length and time of change where the table has
    them, else by their bytes.  Code behind the components is not seen.
    """
    known = ["path", "length", "modified"]
    of = known if set(known) <= set(docs.columns) else ["path", "content"]
    row = docs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("session_id", *of).cast("decimal(38, 0)")).alias("h")).first()
    own = json.dumps([row.n, str(row.h), dataclasses.asdict(settings), ready], sort_keys=True)
    return hashlib.sha256(own.encode()).hexdigest()


class Store:
    """Tables by name below a folder, each with a note of the fingerprint it was written for.

    The note follows the table, so one without it is not whole and is written
    anew; one of another fingerprint is replaced.  A store of the ``last`` stage
    alone drops tables that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, folder: str | None, mark: str, last: bool = False):
        if last and folder:
            raise ValueError("a named store keeps its tables, from which a run goes on")
        self.last, self.written = last, []
        self.spark, self.folder, self.mark = spark, (folder or shared_folder(spark, "run")).rstrip("/"), mark
        self.reused: list[str] = []
        self.there = self._finished() if folder else set()

    def _finished(self) -> set[str]:
        """Names of the tables that are whole and of this run's fingerprint."""
        try:
            notes = self.spark.read.schema("value string").text(f"{self.folder}/finished")
            return {r.value.split(" ")[0] for r in notes.collect() if r.value.split(" ")[1:] == [self.mark]}
        except AnalysisException:  # no such folder
            return set()

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table; where it is there already nothing of ``df`` runs."""
        path = f"{self.folder}/{name}"
        if name in self.there:
            self.reused.append(name)
        else:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
            self.written.append(name)
            self.spark.range(1, numPartitions=1).select(F.lit(f"{name} {self.mark}")).write.mode("append").text(f"{self.folder}/finished")
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables, or folders beside them, that nothing reads any more, where only the last stage is wanted."""
        for name in names if self.last else ():
            system, at = file_system(f"{self.folder}/{name}")
            if system.get_file_info(at).type == FileType.Directory:
                system.delete_dir(at)
            if name in self.written:
                self.written.remove(name)
