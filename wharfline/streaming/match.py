"""Matching a growing folder of line files against a fixed key list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wharfline.functions.text import is_blank, is_decodable
from wharfline.operators.lookup import fits_broadcast, salted_join, unique_keys
from wharfline.sources.lines import data_lines, refuse_hidden
from wharfline.workdir import ensure_checkpoint_dir

LINES_METRICS, MATCH_METRICS = "lines", "matches"


def matched_stream(
    lines: DataFrame,
    keys: DataFrame,
    max_broadcast_bytes: int | None = None,
    salts: int = 16,
) -> DataFrame:
    """Streaming lines (``value``) whose first field is in ``keys`` (``k``).

    The key list is stored once, so no micro-batch derives it again. Beyond
    the broadcast bound every key is repeated ``salts`` times and the lines
    of a hot key spread over as many tasks. Needs no state and no watermark.
    """
    ensure_checkpoint_dir(keys.sparkSession)
    stored = unique_keys(keys.select("k"), ["k"]).checkpoint()
    observed = lines.observe(
        LINES_METRICS,
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(is_decodable("value") & ~is_blank("value")).alias("n_processed"),
        F.count_if(~is_decodable("value")).alias("n_errors"),
    )
    probe = data_lines(observed)
    if fits_broadcast(stored, max_broadcast_bytes):
        found = probe.join(F.broadcast(stored), "k", "left_semi")
    else:
        found = salted_join(probe, stored, ["k"], "left_semi", salts=salts)
    return found.select("value").observe(MATCH_METRICS, F.count(F.lit(1)).alias("n_matches"))


def stream_match(
    spark: SparkSession,
    data_dir: str,
    keys: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    files_per_batch: int | None = None,
    continuous_every: str | None = None,
    max_broadcast_bytes: int | None = None,
) -> StreamingQuery:
    """Start the match: text files in, text files out, each input file once.

    It takes what is there and ends, unless ``continuous_every`` (such as
    ``'1 minute'``) keeps it running. Restart it with the same
    ``checkpoint_dir`` to go on with new files.
    """
    refuse_hidden(spark, data_dir)
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    matches = matched_stream(reader.load(data_dir), keys, max_broadcast_bytes)
    writer = (
        matches.writeStream.format("text")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
    )
    if continuous_every:
        return writer.trigger(processingTime=continuous_every).start()
    return writer.trigger(availableNow=True).start()


def stream_counts(query: StreamingQuery) -> dict[str, int]:
    """Counters over all batches of this run of the query.

    Spark keeps a limited number of progress reports
    (``spark.sql.streaming.numRecentProgressUpdates``). For longer runs, and over
    restarts, use ``progress.counted_match``; here a run whose first reports may be
    gone raises.
    """
    reports = query.recentProgress
    limit = int(query_session().conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(reports) >= limit - 1:  # one less may be kept
        raise LostProgress(f"the query has made {limit} reports or more, the first may be gone; use counted_match")
    return _total(reports)


class LostProgress(RuntimeError):
    """Some of a stream's progress reports are no longer there."""


def query_session() -> SparkSession:
    session = SparkSession.getActiveSession()
    assert session is not None
    return session


def _total(reports) -> dict[str, int]:
    total = {"n_lines": 0, "n_processed": 0, "n_errors": 0, "n_matches": 0}
    for progress in reports:
        for row in progress.observedMetrics.values():
            for name, value in row.asDict().items():
                total[name] += value
    return total


def stream_rates(query: StreamingQuery) -> list[tuple[int, float]]:
    """(batch, rows per second) as Spark measured them."""
    return [(p.batchId, p.processedRowsPerSecond) for p in query.recentProgress]
