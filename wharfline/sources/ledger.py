"""Done marks and run logs, kept as append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.operators.sync import DONE_KEY, DONE_VALUE, UPLOADED
from wharfline.workdir import exists

LEDGER_SCHEMA = "key string, tag_key string, tag_value string, at timestamp"

# Fixed value: the stamp in front of a log line.
STAMP = "yyyy-MM-dd HH:mm:ss"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table; empty before anything was marked."""
    if exists(spark, path):
        # batches lie in folders of their own
        return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def done_marks(outcomes: DataFrame, key: str = "src") -> DataFrame:
    """Ledger rows for the files of ``outcomes`` that succeeded."""
    return outcomes.filter(F.col("status") == UPLOADED).select(
        F.col(key).alias("key"),
        F.lit(DONE_KEY).alias("tag_key"),
        F.lit(DONE_VALUE).alias("tag_value"),
        F.current_timestamp().alias("at"),
    )


def mark_done(outcomes: DataFrame, path: str, key: str = "src") -> None:
    """Append done marks. Call it on stored outcomes, after the data is
    written: a crash in between repeats work and never loses it."""
    done_marks(outcomes, key).write.mode("append").parquet(path)


def mark_batch(outcomes: DataFrame, path: str, batch: str, key: str = "src") -> None:
    """Write a batch's done marks in place of those it may have left before."""
    done_marks(outcomes, key).write.mode("overwrite").parquet(f"{path.rstrip('/')}/marks-{batch}")


def append_log(rows: DataFrame, message: Column, path: str) -> None:
    """Append one stamped text line per row; stamps are in UTC."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    stamp = F.date_format(utc, STAMP)
    rows.select(F.concat(F.lit("["), stamp, F.lit("] "), message).alias("value")).write.mode(
        "append"
    ).text(path)
