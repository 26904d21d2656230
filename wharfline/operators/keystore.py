"""A key list stored once, for many probe files.

The list is unique and lies in buckets of its keys. A probe is shuffled into as
many parts and meets the stored list where it lies: the list itself is never
shuffled again, whatever the number of probes. Lists that fit a broadcast need
none of this; ``match_lines`` broadcasts them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.operators.lookup import HOT_ROWS, hot_keys, measure, unique_keys
from wharfline.sources.bucketed import open_buckets, write_buckets
from wharfline.workdir import ensure_checkpoint_dir, new_dir

BUCKET_BYTES = 128 * 1024 * 1024
SAMPLE = 0.01


def build_key_store(keys: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Store the keys in ``k`` below ``path``; buckets hold about BUCKET_BYTES of keys unless told."""
    stored = new_dir(keys.sparkSession, "keys")
    # written once: it is measured, then dealt to buckets
    unique_keys(keys.select("k"), ["k"]).write.parquet(stored)
    unique = keys.sparkSession.read.schema("k string").parquet(stored)
    n = buckets or max(1, math.ceil(measure(unique).relation_bytes / BUCKET_BYTES))
    return write_buckets(unique, path, ["k"], n)


def open_key_store(spark: SparkSession, path: str) -> DataFrame:
    return open_buckets(spark, path)


def match_stored(probe: DataFrame, store: DataFrame, hot_rows: int = HOT_ROWS, sample: float = SAMPLE) -> DataFrame:
    """Probe rows whose ``k`` is in the store; repeated rows stay.

    A sample of the probe tells which keys are likely to have more than
    ``hot_rows`` rows. These few keys are looked up first and their rows
    filtered by a broadcast; the rest is shuffled by key. What the sample misses
    only costs time.
    """
    ensure_checkpoint_dir(probe.sparkSession)
    drawn = probe.select("k").sample(sample, 7) if sample < 1 else probe.select("k")
    hot = hot_keys(drawn, ["k"], max(1, int(hot_rows * sample))).select("k").checkpoint()
    if hot.isEmpty():
        return probe.join(store.hint("merge"), "k", "left_semi")
    # at most (rows / hot_rows) keys, however the data looks
    listed = store.join(F.broadcast(hot), "k", "left_semi").checkpoint()
    cold = probe.join(F.broadcast(hot), "k", "left_anti").join(store.hint("merge"), "k", "left_semi")
    return probe.join(F.broadcast(listed), "k", "left_semi").unionByName(cold)
