"""What to move, what to skip, and what came of it.

A source inventory has ``path`` (relative) and ``size``, a destination
inventory ``key`` and ``size``; outcomes have ``src, dst, status, bytes,
error``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.functions import paths as P
from wharfline.operators.lookup import lookup_join

# Fixed values.
UPLOADED, SKIPPED, ERROR = "uploaded", "skipped", "error"
DONE_KEY, DONE_VALUE = "Decompressed", "True"


def visible_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Without hidden files and everything below hidden folders."""
    return files.filter(~P.is_hidden(path))


def gz_twins(files: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Drops ``x`` where ``x.gz`` is there too; the compressed file wins."""
    packed = files.filter(P.is_gz("path")).select(F.col("path").alias("_twin"))
    # A .gz row looks up a name that no .gz file has, and a distinct one, so
    # these rows spread evenly and all stay.
    twin = F.when(P.is_gz("path"), F.concat("path", F.lit("/"))).otherwise(
        F.concat("path", F.lit(P.GZ))
    )
    return lookup_join(
        files.withColumn("_twin", twin), packed, "_twin", "left_anti", max_broadcast_bytes
    ).select(*files.columns)


def sync_plan(
    files: DataFrame,
    present: DataFrame,
    prefix: str = "",
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """path, size, dst, action, compressed_source, shown for each source file.

    A ``.gz`` file is skipped when its unpacked target is there, whatever its
    size; a plain file only when the target has the same size. One join
    answers both questions for all files.
    """
    wanted = files.withColumns(
        {
            "dst": P.target_key(P.drop_gz_suffix("path"), prefix),
            "compressed_source": P.is_gz("path"),
        }
    )
    there = present.select(F.col("key").alias("dst"), F.col("size").alias("dst_size"))
    joined = lookup_join(wanted, there, "dst", "left", max_broadcast_bytes)
    skip = F.col("dst_size").isNotNull() & (
        F.col("compressed_source") | (F.col("dst_size") == F.col("size"))
    )
    return joined.select(
        *files.columns,
        "dst",
        F.when(skip, F.lit(SKIPPED)).otherwise(F.lit(UPLOADED)).alias("action"),
        F.when(F.col("compressed_source"), F.lit("yes")).alias("compressed_source"),
        P.display_name("path").alias("shown"),
    )


def done_keys(ledger: DataFrame) -> DataFrame:
    return ledger.filter(
        (F.col("tag_key") == DONE_KEY) & (F.col("tag_value") == DONE_VALUE)
    ).select("key")


def ledger_pending(
    files: DataFrame, ledger: DataFrame, max_broadcast_bytes: int | None = None
) -> DataFrame:
    """Files whose ``key`` the ledger does not mark as done."""
    return lookup_join(files, done_keys(ledger), "key", "left_anti", max_broadcast_bytes)


def reconcile_sizes(
    expected: DataFrame, present: DataFrame, max_broadcast_bytes: int | None = None
) -> DataFrame:
    """src, dst, size, dst_size, check: verified, mismatch or missing."""
    there = present.select(F.col("key").alias("dst"), F.col("size").alias("dst_size"))
    joined = lookup_join(expected.select("src", "dst", "size"), there, "dst", "left", max_broadcast_bytes)
    check = (
        F.when(F.col("dst_size").isNull(), F.lit("missing"))
        .when(F.col("dst_size") == F.col("size"), F.lit("verified"))
        .otherwise(F.lit("mismatch"))
    )
    return joined.select("src", "dst", "size", "dst_size", check.alias("check"))


def _n(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """One row: n_total, n_uploaded, n_skipped, n_errors. A status that is
    neither skipped nor error counts as uploaded."""
    s = F.col("status")
    return outcomes.agg(
        F.count(F.lit(1)).alias("n_total"),
        _n(~s.isin(SKIPPED, ERROR), "n_uploaded"),
        _n(s == SKIPPED, "n_skipped"),
        _n(s == ERROR, "n_errors"),
    )


def completed(
    plan: DataFrame, outcomes: DataFrame, max_broadcast_bytes: int | None = None
) -> DataFrame:
    """One row: n_done of n_total planned rows, as after an interruption."""
    got = outcomes.select("dst", F.lit(1).alias("_got"))
    joined = lookup_join(plan.select("dst"), got, "dst", "left", max_broadcast_bytes)
    return joined.agg(F.count("_got").alias("n_done"), F.count(F.lit(1)).alias("n_total"))


def copy_volume(outcomes: DataFrame, by: str) -> DataFrame:
    """Bytes per group and their share of all bytes in percent.

    The total is a scalar subquery: no cross join and no single-task window.
    """
    total = outcomes.agg(F.sum("bytes").alias("total")).scalar()
    per = outcomes.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("n_bytes")
    )
    share = F.coalesce(F.try_divide(F.col("n_bytes") * 100.0, total), F.lit(100.0))
    return per.withColumn("pct", F.round(share, 1))


def copy_rate(outcomes: DataFrame) -> DataFrame:
    """One row: n_bytes, seconds from first start to last end, mb_per_s (null
    for no elapsed time), and the byte count as text."""
    seconds = F.unix_micros(F.max("ended")) - F.unix_micros(F.min("started"))
    return outcomes.agg(
        F.sum("bytes").alias("n_bytes"), (seconds / F.lit(1e6)).alias("seconds")
    ).select(
        "n_bytes",
        "seconds",
        F.try_divide(F.col("n_bytes") / F.lit(1024.0 * 1024.0), F.col("seconds")).alias("mb_per_s"),
        F.format_number("n_bytes", 0).alias("n_bytes_text"),
    )
