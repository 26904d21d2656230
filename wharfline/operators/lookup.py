"""Joins that look rows up in a set of keys.

The looked-up side is made unique, then measured. Within a byte bound it is
broadcast and the other side is neither shuffled nor sorted, so no key can be
hot. Beyond the bound both sides are shuffled, and a hot key on the left is
split: by AQE where its skew handling is on, by salting its rows otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.workdir import ensure_checkpoint_dir

# A hashed relation holds every key twice, with row headers and map slots.
ROW_OVERHEAD_BYTES = 112
# Share of the smaller of driver and executor memory that a broadcast may take.
MEMORY_SHARE = 8
MAX_BROADCAST_BYTES = 4 * 1024**3
HOT_ROWS = 5_000_000
NULL_SALTS = 4096
SALT_SEED = 17


@dataclass(frozen=True)
class Extent:
    """Measured size of a DataFrame."""

    rows: int
    data_bytes: int

    @property
    def relation_bytes(self) -> int:
        return 2 * self.data_bytes + self.rows * ROW_OVERHEAD_BYTES


def measure(df: DataFrame) -> Extent:
    """Row count and bytes of the values as text; one pass, one row back."""
    width: Column = F.lit(0)
    for f in df.schema.fields:
        text = F.col(f"`{f.name}`").cast("string")
        width = width + F.coalesce(F.octet_length(text), F.lit(0))
    got = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width.cast("bigint")).alias("data")).first()
    return Extent(got["rows"], got["data"] or 0)


def memory_bytes(text: str) -> int:
    """A memory setting such as ``8g``; a bare number is in MiB."""
    text = text.strip().lower().removesuffix("b")
    power = {"k": 1, "m": 2, "g": 3, "t": 4}
    if text[-1:] in power:
        return int(text[:-1]) * 1024 ** power[text[-1]]
    return int(text) * 1024**2


def result_bytes(text: str) -> int:
    """``spark.driver.maxResultSize``, where a bare number is in bytes and 0 means no limit."""
    return int(text) if text.strip().isdigit() else memory_bytes(text)


def broadcast_bound(spark: SparkSession) -> int:
    """Bytes a broadcast may take in this session."""
    conf = spark.sparkContext.getConf()
    memory = [memory_bytes(conf.get("spark.driver.memory", "1g"))]
    if not conf.get("spark.master", "").startswith("local"):
        memory.append(memory_bytes(conf.get("spark.executor.memory", "1g")))
    bound = min(min(memory) // MEMORY_SHARE, MAX_BROADCAST_BYTES)
    # the broadcast side is collected, and rows take more than their values
    results = result_bytes(conf.get("spark.driver.maxResultSize", "1g"))
    return min(bound, results // 2) if results else bound


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether ``df``, measured, is within the bound (the session's if none)."""
    bound = broadcast_bound(df.sparkSession) if max_bytes is None else max_bytes
    return measure(df).relation_bytes <= bound


def unique_keys(keys: DataFrame, on: list[str]) -> DataFrame:
    """One row per key. Extra columns keep their greatest value, so the result
    does not depend on the order of duplicates."""
    extra = [c for c in keys.columns if c not in on]
    if not extra:
        return keys.select(*on).distinct()
    return keys.groupBy(*on).agg(*[F.max(c).alias(c) for c in extra])


def aqe_splits_skew(spark: SparkSession) -> bool:
    def on(name: str) -> bool:
        return spark.conf.get(name, "true").lower() == "true"

    return on("spark.sql.adaptive.enabled") and on("spark.sql.adaptive.skewJoin.enabled")


def hot_keys(df: DataFrame, on: list[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``min_rows`` rows, and how many salts each needs.

    Counted with map-side partial aggregation. At most rows/min_rows keys can
    come out, whatever the data looks like.
    """
    return (
        df.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > min_rows)
        .select(*on, F.ceil(F.col("_n") / F.lit(min_rows)).cast("int").alias("_salts"))
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    hot: DataFrame | None = None,
    salts: int = 16,
) -> DataFrame:
    """``left`` joined to unique ``right`` keys with the rows of hot keys spread
    over several tasks.

    Each left row goes to one salt of its key; the one right row of that key
    is repeated for each salt. ``hot`` (from :func:`hot_keys`) limits this to
    the keys that need it; without it every key gets ``salts`` salts, which is
    the choice for streams, where counts are not known before. Right only for
    joins that keep or drop left rows: left_semi, left_anti, left, inner.
    """
    if how not in ("left_semi", "left_anti", "left", "inner"):
        raise ValueError(f"cannot salt a {how} join")
    # Seeded, so a retried task sends its rows the same way.
    draw = F.rand(SALT_SEED)
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    if hot is None:
        spread = left.withColumn("_salt", (draw * salts).cast("int"))
        count = F.lit(salts)
        repeated = right
    else:
        # A null key matches nothing, so its rows may go anywhere.
        spread = left.join(hot, on, "left").withColumn(
            "_salt",
            (draw * F.when(no_key, F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))).cast("int"),
        ).drop("_salts")
        repeated = right.join(hot, on, "left")
        count = F.coalesce(F.col("_salts"), F.lit(1))
    repeated = repeated.withColumn("_salt", F.explode(F.sequence(F.lit(0), count - 1)))
    return spread.join(repeated.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "left_semi",
    max_broadcast_bytes: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``left`` to ``right`` without ever multiplying left rows.

    Runs one or two small jobs to measure ``right``.
    """
    on = [on] if isinstance(on, str) else on
    spark = left.sparkSession
    needed = right.select(*on) if how in ("left_semi", "left_anti") else right
    unique = unique_keys(needed, on)
    if fits_broadcast(needed, max_broadcast_bytes):
        # Repeated keys cannot multiply rows of a semi or anti join.
        small = needed if needed is not right else unique
        return left.join(F.broadcast(small), on, how)
    # Stored once: it is measured and joined, and AQE splits a skewed join only
    # where nothing stands between the exchange and the join.
    ensure_checkpoint_dir(spark)
    unique = unique.checkpoint()
    if fits_broadcast(unique, max_broadcast_bytes):
        return left.join(F.broadcast(unique), on, how)
    if aqe_splits_skew(spark):
        return left.join(unique.hint("merge"), on, how)
    hot = hot_keys(left, on, hot_rows).checkpoint()
    # its size is bounded by the rows of the left side, not by what the caller lets a lookup take
    if fits_broadcast(hot):
        return salted_join(left, unique, on, how, F.broadcast(hot))
    return salted_join(left, unique, on, how)
