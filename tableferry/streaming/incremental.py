"""Resumable table copy with Structured Streaming (the legacy commit interval, W3/JOB4).

The legacy loader commits every 50 pages so that a long copy keeps its progress. Here
the unit of commit is a micro-batch: the file source reads the table's files a bounded
amount at a time (``maxFilesPerTrigger`` / ``maxBytesPerTrigger``), the parquet sink
commits each micro-batch atomically, and the checkpoint (below the shared folder)
records which files are done. A job that dies — driver or executors — restarts from
its last committed micro-batch; rerunning a finished copy adds nothing (exactly once).

``trigger(availableNow=True)`` processes everything present and stops, so the same
code serves a one-off transfer and a scheduled incremental one (new files only).
"""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tableferry.functions import typemap


def stream_copy(
    spark: SparkSession,
    source_dir: str,
    file_glob: str,
    schema: T.StructType,
    target_path: str,
    checkpoint: str,
    target_types: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Copy the files of one table (``file_glob`` inside ``source_dir``) to ``target_path``.

    Values are conformed to ``target_types`` with a strict cast (a value that does not
    fit fails the micro-batch, which then commits nothing). Returns the commit log: one
    row per micro-batch (batch_id, n_rows, started, elapsed_ms); :func:`throughput` makes the progress report of it."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    stream = reader.parquet(source_dir)
    if target_types:
        stream = stream.select(
            *[
                typemap.to_target(stream[c], target_types[c], strict=True).alias(c)
                if c in target_types else stream[c]
                for c in stream.columns
            ]
        )
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        query = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(target_path)
        )
        query.awaitTermination()
        log.wait_for(str(query.runId))
    finally:
        spark.streams.removeListener(log)
    return batch_log(spark, log.rows(str(query.runId)))


LOG_SCHEMA = "batch_id long, n_rows long, started timestamp, elapsed_ms long"


class BatchLog(StreamingQueryListener):
    """Every micro-batch of the queries of a session as a row: its number, rows, start and duration. Unlike a query's own
    recent progress it keeps all batches, and copies that run side by side change no setting of the session."""

    def __init__(self) -> None:
        self._rows: dict[str, list[tuple]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).astimezone(timezone.utc)
        with self._lock:
            self._rows.setdefault(str(p.runId), []).append((int(p.batchId), int(p.numInputRows), started, int(p.durationMs.get("triggerExecution", 0))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait_for(self, run: str, seconds: float = 60) -> None:
        """Until the end of a run was reported: events come a little after the query has ended."""
        if not self._end(run).wait(seconds):
            raise TimeoutError(f"no end of run {run} was reported")

    def rows(self, run: str) -> list[tuple]:
        with self._lock:
            return sorted(r for r in self._rows.get(run, []) if r[1] or r[3])


def batch_log(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, LOG_SCHEMA)


def throughput(log: DataFrame, total_rows: int) -> DataFrame:
    """A5 at run time: per micro-batch the rows so far, their percent of ``total_rows`` (at most 100), the milliseconds from the
    first start to the batch's end, and rows a second over that time (0 where it is 0)."""
    before = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)  # a row for each micro-batch
    begin = log.agg(F.min("started")).scalar()
    passed = (F.unix_millis("started") - F.unix_millis(begin) + F.col("elapsed_ms")).cast("long")
    done = F.sum("n_rows").over(before)
    return log.select(
        "batch_id", "n_rows", done.alias("rows_done"),
        F.least(F.lit(100.0), F.when(F.lit(total_rows) > 0, 100.0 * done / F.lit(total_rows)).otherwise(100.0)).alias("percent"),
        passed.alias("passed_ms"),
        F.when(passed > 0, F.round(1000.0 * done / passed, 1)).otherwise(0.0).alias("rows_per_second"),
    )
