"""Extension: a watched folder of documents as a stream of page rows.

All transformations of a file are stateless, so the stream uses the batch
functions unchanged; what needs a file's pages together runs per micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quireflow.functions.names import session_id


def watch_files(spark: SparkSession, path: str, glob: str = "*", files_per_trigger: int = 100) -> DataFrame:
    """A stream of new files: session_id, path, content, modified, length."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    df = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).load(path)
    return df.select(session_id(df.path, df.modificationTime).alias("session_id"), "path", "content", df.modificationTime.alias("modified"), "length")


def run_batches(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Apply a batch stage to every micro-batch and append its rows; each batch has a folder of its own, so a retry replaces it."""

    def one(df: DataFrame, batch: int) -> None:
        stage(df).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
