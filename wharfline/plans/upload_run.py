"""Bring a folder tree to a destination, unpacking what is compressed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.operators.folders import check_targets
from wharfline.operators.sync import ERROR, SKIPPED, gz_twins, sync_plan
from wharfline.operators.transfer import PART_BYTES, sync_job
from wharfline.sources.inventory import root_name, walk_inventory


def plan_upload(
    spark: SparkSession, root: str, present: DataFrame, prefix: str = ""
) -> DataFrame:
    """Walk ``root`` and decide per file: uploaded, skipped or error.

    ``present`` is the destination's inventory (``key, size``). What can't be
    read stays in the plan with action 'error' and its text. A root that can't
    be listed raises, and so do two files for one target.
    """
    found = walk_inventory(spark, root)
    # the root itself is the one row that is not below the root
    broken = found.filter(F.col("error").isNotNull() & (F.rtrim(F.col("uri"), F.lit("/")) == F.lit(root_name(root)))).first()
    if broken:
        raise FileNotFoundError(f"{root}: {broken['error']}")
    readable = gz_twins(found.filter(F.col("error").isNull()))
    plan = sync_plan(readable, present, prefix)
    check_targets(plan.filter(F.col("action") != SKIPPED).select(F.col("uri").alias("src"), "dst"))
    bad = sync_plan(found.filter(F.col("error").isNotNull()), present, prefix)
    return plan.unionByName(bad.withColumn("action", F.lit(ERROR)))


def run_upload(
    plan: DataFrame,
    dest_root: str,
    out: str | None = None,
    part_bytes: int = PART_BYTES,
    tasks: int | None = None,
    on_error: str = "record",
) -> DataFrame:
    """Outcomes of a plan from :func:`plan_upload`; ``src`` records the origin."""
    target = F.concat(F.lit(dest_root.rstrip("/") + "/"), F.col("dst"))
    moves = plan.select(
        F.col("uri").alias("src"), target.alias("dst"), "size", "action", "compressed_source", "error"
    )
    return sync_job(moves, out, part_bytes, tasks, on_error)
