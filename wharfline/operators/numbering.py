"""1-based numbering of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wharfline.workdir import ensure_checkpoint_dir


def number_rows(df: DataFrame, order: list[str], name: str = "task_no") -> DataFrame:
    """Adds ``name`` = 1, 2, ... in the order of ``order``.

    A window without partitions would sort everything in one task. Here the
    rows are range-partitioned, sorted within partitions and stored; one count
    per partition then gives each partition its offset. ``order`` should be
    unique; tied rows get their numbers in any order.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
        .checkpoint()
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition, so one task and a broadcast hold it.
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("_first"))
        .withColumn("_skip", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_row") - F.col("_first") + F.col("_skip") + 1)
        .drop("_part", "_row", "_first", "_skip")
    )
