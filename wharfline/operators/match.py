"""Matching data lines against a key list.

``probe`` is a DataFrame with the key in ``k`` (see ``data_lines``), ``keys``
one with the key in ``k`` (see ``key_lines``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.functions.text import first_field_key, is_blank, is_decodable
from wharfline.operators.lookup import fits_broadcast, lookup_join, unique_keys


def match_lines(
    probe: DataFrame, keys: DataFrame, max_broadcast_bytes: int | None = None
) -> DataFrame:
    """Probe rows whose key is in the list. Repeated probe rows stay, repeated
    keys change nothing, and '' matches ''."""
    return lookup_join(probe, keys.select("k"), "k", "left_semi", max_broadcast_bytes)


def first_matches(matches: DataFrame, n: int = 10, pos: str = "pos") -> DataFrame:
    return matches.orderBy(pos).limit(n)


def match_counts(
    lines: DataFrame,
    keys: DataFrame,
    key: Column | None = None,
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """One row: n_processed, n_matches, n_errors, n_keys.

    ``lines`` are raw lines in ``value``; they are read once. Where the key
    list is too big to broadcast, lines are counted per key before they meet
    it, so a hot key is a single row by then.
    """
    bad = ~is_decodable("value")
    k = first_field_key("value") if key is None else key
    tagged = lines.filter(bad | ~is_blank("value")).select(
        F.when(~bad, k).alias("k"), (~bad).cast("int").alias("data"), bad.cast("int").alias("bad")
    )
    listed = unique_keys(keys.select("k"), ["k"]).withColumn("listed", F.lit(1))
    if fits_broadcast(keys.select("k"), max_broadcast_bytes):
        counted = tagged.join(F.broadcast(listed), "k", "left")
    else:
        per_key = tagged.groupBy("k").agg(F.sum("data").alias("data"), F.sum("bad").alias("bad"))
        counted = per_key.join(listed, "k", "left")

    def total(n: Column) -> Column:
        return F.coalesce(F.sum(n), F.lit(0)).cast("bigint")

    n_keys = keys.agg(F.count_distinct("k").alias("n_keys")).scalar()
    return counted.agg(
        total(F.col("data")).alias("n_processed"),
        total(F.when(F.col("listed") == 1, F.col("data"))).alias("n_matches"),
        total(F.col("bad")).alias("n_errors"),
    ).withColumn("n_keys", n_keys)
