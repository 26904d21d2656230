"""Counters of a stream, batch by batch, by a query listener.

Spark tells the listener of every batch, however many there are, so nothing is
polled and nothing can be missed. A batch's row is stored under its number: a batch
that runs again after a crash replaces its row, and totals cover all runs of the
stream.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from wharfline.streaming.match import stream_match
from wharfline.workdir import exists

COUNTERS = ("n_lines", "n_processed", "n_errors", "n_matches")
_SCHEMA = "query string, batch bigint, " + ", ".join(f"{c} bigint" for c in COUNTERS)


class BatchCounts(StreamingQueryListener):
    """Stores one row per batch of the queries it hears of below ``table``."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table.rstrip("/")
        self._ended: dict[str, threading.Event] = {}
        self.failed: list[str] = []

    def _end_of(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = {name: value for row in p.observedMetrics.values() for name, value in row.asDict().items()}
        if not counts:
            return  # a trigger without a batch
        try:
            row = [(str(p.id), p.batchId, *(int(counts.get(c) or 0) for c in COUNTERS))]
            out = f"{self.table}/batch-{p.batchId}"
            self.spark.createDataFrame(row, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(out)
        except Exception as e:  # noqa: BLE001 - an exception here would be lost in the listener's thread
            self.failed.append(f"batch {p.batchId}: {type(e).__name__}: {e}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until everything about an ended query has been heard and stored."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the end of query {query.runId} was not announced within {seconds} s")
        if self.failed:
            raise RuntimeError("; ".join(self.failed))


def batch_rows(spark: SparkSession, table: str) -> DataFrame:
    """query, batch and the counters of each batch stored so far."""
    if not exists(spark, table):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).option("recursiveFileLookup", "true").parquet(table)


def totals(batches: DataFrame) -> DataFrame:
    """One row: the counters over all batches."""
    return batches.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])


def counted_match(spark: SparkSession, data_dir: str, keys: DataFrame, out_dir: str, state_dir: str, **options) -> DataFrame:
    """Run :func:`stream_match` to its end and return :func:`batch_rows`, kept in ``state_dir``."""
    table = f"{state_dir.rstrip('/')}-progress"
    listener = BatchCounts(spark, table)
    spark.streams.addListener(listener)
    try:
        query = stream_match(spark, data_dir, keys, out_dir, state_dir, **options)
        query.awaitTermination()
        listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    return batch_rows(spark, table)
