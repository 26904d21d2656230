"""Copy everything below some prefixes to another place, keeping the folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.operators.folders import (
    FOLDER_CAP,
    PlanError,
    check_targets,
    folder_cap,
    folder_rollup,
    numbered_plan,
    rebase_plan,
    union_sources,
)
from wharfline.operators.sync import outcome_summary, reconcile_sizes
from wharfline.operators.transfer import PART_BYTES, copy_job
from wharfline.sources.ledger import append_log


@dataclass
class CopyPlan:
    """What would be copied: look at it, then hand it to :func:`run_copy`."""

    tasks: DataFrame
    rollup: DataFrame
    folders: DataFrame


def plan_copy(
    inventory: DataFrame, sources: list[str] | DataFrame, base: str, dest: str, cap: int = FOLDER_CAP
) -> CopyPlan:
    """Tasks and summaries for an inventory of ``key, size``.

    Fails for sources in different buckets, for no objects at all and for two
    sources that would write one target.
    """
    sourced = union_sources(inventory, sources)
    plan = rebase_plan(sourced, base, dest)
    if plan.isEmpty():
        raise PlanError("no objects found under any source prefix")
    check_targets(plan)
    return CopyPlan(numbered_plan(plan), folder_rollup(sourced), folder_cap(sourced, cap))


def summary_lines(plan: CopyPlan) -> DataFrame:
    """line: what a run is about to copy, per source its counts and first folders, then the total; in order.

    Sources are in the order of their names.
    """
    def text(kind: int, place, *parts) -> list:
        return [F.lit(kind).alias("kind"), F.col("source"), place.cast("bigint").alias("place"), F.concat(*parts).alias("line")]

    none = F.lit(0)
    heads = plan.rollup.select(*text(
        0, none, F.lit("  "), "source", F.lit(": "), F.col("n_objects").cast("string"), F.lit(" objects, "),
        F.col("n_folders").cast("string"), F.lit(" nested folder(s):")))
    folders = plan.folders.select(*text(0, F.col("rn"), F.lit("    "), "folder"))
    last = plan.folders.groupBy("source").agg(F.max("rn").alias("rn"), F.max("n_more").alias("n_more")).filter("n_more > 0")
    more = last.select(*text(0, F.col("rn") + 1, F.lit("    ... and "), F.col("n_more").cast("string"), F.lit(" more")))
    total = plan.tasks.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(1).alias("kind"), F.lit("").alias("source"), F.lit(0).cast("bigint").alias("place"),
        F.concat(F.lit("  Total: "), F.col("n").cast("string"), F.lit(" objects. Starting copy.")).alias("line"))
    lines = heads.unionByName(folders).unionByName(more).unionByName(total)
    return lines.orderBy("kind", "source", "place").select("line")


def run_copy(
    plan: CopyPlan,
    source_root: str,
    dest_root: str,
    out: str | None = None,
    log: str | None = None,
    part_bytes: int = PART_BYTES,
    tasks: int | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Carry out a plan between two roots (a folder or URI in front of keys).

    A key named by two overlapping sources for one target is copied once. A ``log``
    begins with the plan's summary and has a line for each file.
    """

    def at(root: str, key: str):
        return F.concat(F.lit(root.rstrip("/") + "/"), F.col(key))

    moves = plan.tasks.select(
        at(source_root, "src").alias("src"), at(dest_root, "dst").alias("dst"), "size"
    ).dropDuplicates(["src", "dst"])
    if log:
        append_log(summary_lines(plan), F.col("line"), log)
    outcomes = copy_job(moves, out, part_bytes, tasks, on_error="record" if log else on_error)
    if log:
        message = F.concat_ws(" ", "status", "src", F.lit("->"), "dst", F.col("bytes").cast("string"))
        append_log(outcomes, F.concat_ws(" | ", message, "error"), log)
        if on_error == "fail":
            _raise_on_errors(outcomes)
    return outcomes


def _raise_on_errors(outcomes: DataFrame) -> None:
    from wharfline.operators.transfer import TransferError

    n = outcome_summary(outcomes).first()["n_errors"]
    if n:
        raise TransferError(f"{n} files failed, see the log")


def verify_copy(spark: SparkSession, plan: CopyPlan, present: DataFrame) -> DataFrame:
    """Planned sizes against an inventory (``key, size``) of the destination."""
    return reconcile_sizes(plan.tasks, present)
