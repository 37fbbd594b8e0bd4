"""Process only the files that arrived since the last run."""

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from lodgewise.operators.records import with_content_id
from lodgewise.schema import raw_schema


def stream_feed(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True,
                pattern: str = "*.json", files_per_batch: int | None = None) -> DataFrame:
    """JSON files of a folder as a stream, with source file and `row_id`."""
    reader = spark.readStream.schema(schema or raw_schema()).option("multiLine", multi_line).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.json(path).select("*", F.col("_metadata.file_path").alias("source_file"))
    return with_content_id(rows, "source_file")


class _Counter(StreamingQueryListener):
    """Rows that a query has read, over all its batches (its own history keeps the last ones only)."""

    def __init__(self):
        self.by_run, self.ended, self.run, self.done = {}, set(), None, threading.Event()

    @property
    def rows(self) -> int:
        return self.by_run.get(self.run, 0)

    def follow(self, run: str) -> None:
        self.run = run
        if run in self.ended:
            self.done.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.by_run[run] = self.by_run.get(run, 0) + event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))
        if str(event.runId) == self.run:
            self.done.set()


def run_available(rows: DataFrame, out: str, bookmark: str, partition_by=(), transform: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Append what is new to a Parquet table, remember it under `bookmark`, and stop. Gives the rows read.

    The bookmark is a streaming checkpoint: a rerun reads no file twice, and a run that failed half
    way takes up its batch again without writing it twice.
    """
    new = transform(rows) if transform else rows
    writer = new.writeStream.format("parquet").option("checkpointLocation", bookmark).option("path", out)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    counter = _Counter()
    rows.sparkSession.streams.addListener(counter)
    try:
        query = writer.outputMode("append").trigger(availableNow=True).start()
        counter.follow(str(query.runId))
        query.awaitTermination()
        counter.done.wait(60)
    finally:
        rows.sparkSession.streams.removeListener(counter)
    return counter.rows
