"""Samples and checks that explain a match result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wharfline.functions.text import key_variants as spellings
from wharfline.functions.text import preview
from wharfline.operators.lookup import fits_broadcast, lookup_join
from wharfline.workdir import ensure_checkpoint_dir

# How many rows each sample shows.
SAMPLE_LINES = 5
SAMPLE_KEYS = 10
SAMPLE_MEMBERS = 3


def flag_members(sample: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds ``in_list`` to a sample of a few rows.

    The sample is what gets broadcast: the key list is read once and only the
    keys that occur in the sample go on. It is used twice, so it is stored
    first; otherwise the data would be read twice for it.
    """
    ensure_checkpoint_dir(sample.sparkSession)
    sample = sample.checkpoint()
    hits = (
        keys.select("k")
        .join(F.broadcast(sample.select("k").distinct()), "k", "left_semi")
        .distinct()
        .withColumn("in_list", F.lit(True))
    )
    return sample.join(F.broadcast(hits), "k", "left").withColumn(
        "in_list", F.coalesce("in_list", F.lit(False))
    )


def sample_lines(probe: DataFrame, keys: DataFrame, n: int = SAMPLE_LINES) -> DataFrame:
    """The first ``n`` data lines: pos, shown, k, in_list (null for key '')."""
    head = probe.orderBy("pos").limit(n).select("pos", preview("value").alias("shown"), "k")
    return flag_members(head, keys).select(
        "pos", "shown", "k", F.when(F.col("k") != "", F.col("in_list")).alias("in_list")
    )


def sample_keys(probe: DataFrame, keys: DataFrame, n: int = SAMPLE_KEYS) -> DataFrame:
    """The first ``n`` distinct non-empty keys in input order: ord, k, in_list."""
    first = (
        probe.filter(F.col("k") != "")
        .groupBy("k")
        .agg(F.min("pos").alias("pos"))
        .orderBy("pos")
        .limit(n)
    )
    # At most n rows are left, so one task numbers them.
    ordered = first.withColumn("ord", F.row_number().over(W.orderBy("pos")).cast("bigint"))
    return flag_members(ordered.select("ord", "k"), keys).select("ord", "k", "in_list")


def sample_members(keys: DataFrame, n: int = SAMPLE_MEMBERS) -> DataFrame:
    """The ``n`` smallest keys of the list, for comparison by eye."""
    return keys.select("k").distinct().orderBy("k").limit(n)


def key_variants(
    probe: DataFrame, keys: DataFrame, max_broadcast_bytes: int | None = None
) -> DataFrame:
    """For each distinct probe key the first spelling that is in the list.

    k, rule (0-based position of the spelling, null if none), found_as. The
    spellings of a few keys are broadcast to the list, which is then read once and
    not shuffled; those of many keys look the list up.
    """
    ensure_checkpoint_dir(probe.sparkSession)
    tried = probe.select("k").distinct().select(
        "k", F.posexplode(F.array(*spellings("k"))).alias("rule", "variant")
    ).checkpoint()
    listed = keys.select(F.col("k").alias("variant"))
    wanted = tried.select("variant").distinct()
    if fits_broadcast(wanted, max_broadcast_bytes):
        listed = listed.join(F.broadcast(wanted), "variant", "left_semi").distinct()
    listed = listed.withColumn("listed", F.lit(1))
    looked_up = lookup_join(tried, listed, "variant", "left", max_broadcast_bytes)
    hit = F.when(F.col("listed") == 1, F.struct("rule", "variant"))
    return (
        looked_up.groupBy("k")
        .agg(F.min(hit).alias("hit"))
        .select("k", F.col("hit.rule").alias("rule"), F.col("hit.variant").alias("found_as"))
    )


def key_overlap(columns: dict[str, DataFrame], pairs: list[tuple[str, str]]) -> DataFrame:
    """How many distinct keys two columns share, for each named pair.

    ``columns`` maps a label to a DataFrame with the key in ``k``. Both
    columns of a pair are stacked and combined before one shuffle; there is no
    join, and a value that fills a column is a single row by then. Keys of one
    type are compared as they are, others as text.
    """
    return reduce(DataFrame.unionByName, [_overlap(columns, a, b) for a, b in pairs])


def _overlap(columns: dict[str, DataFrame], a: str, b: str) -> DataFrame:
    types = {columns[label].schema["k"].dataType.simpleString() for label in (a, b)}
    kind = types.pop() if len(types) == 1 else "string"

    def side(label: str, left: int) -> DataFrame:
        k = F.col("k").cast(kind)
        return columns[label].select(k.alias("k"), F.lit(left).alias("l"), F.lit(1 - left).alias("r"))

    per_key = (
        side(a, 1)
        .unionByName(side(b, 0))
        .filter(F.col("k").isNotNull())
        .groupBy("k")
        .agg(F.max("l").alias("l"), F.max("r").alias("r"))
    )
    return per_key.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("n_left"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("n_right"),
        F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("n_common"),
    ).select(F.lit(a).alias("left_col"), F.lit(b).alias("right_col"), "n_left", "n_right", "n_common")


def key_catalog(overlap: DataFrame) -> DataFrame:
    """A note per column pair: 'match' with the shared part, or 'no match'."""
    share = F.round(F.col("n_common") * 100.0 / F.least("n_left", "n_right"), 1)
    return overlap.select(
        "left_col",
        "right_col",
        F.when(F.col("n_common") > 0, F.lit("match")).otherwise(F.lit("no match")).alias("note"),
        F.when(F.least("n_left", "n_right") > 0, share).otherwise(F.lit(0.0)).alias("pct_common"),
    )
