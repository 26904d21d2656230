"""Folder views of an inventory, and the copy plan built from it.

An inventory has ``key`` (``/``-separated) and ``size``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wharfline.functions import paths as P
from wharfline.operators.lookup import fits_broadcast
from wharfline.operators.numbering import number_rows
from wharfline.workdir import ensure_checkpoint_dir

# Fixed value: folders listed per source in a report.
FOLDER_CAP = 200


class PlanError(ValueError):
    """A plan that must not be run."""


def folder_tree(inventory: DataFrame) -> DataFrame:
    """path, depth, label for every folder at every level, sorted by path.

    Keys are reduced to distinct parent folders before the levels are
    exploded, so the explode grows with folders and not with files.
    """
    parents = (
        inventory.select(P.parent_folder(F.rtrim(F.col("key"), F.lit("/"))).alias("parent"), "key")
        .filter(F.instr(F.rtrim(F.col("key"), F.lit("/")), "/") > 0)
        .select("parent")
        .distinct()
    )
    return (
        parents.select(F.explode(P.folders_up_to("parent")).alias("path"))
        .distinct()
        .select(
            "path",
            P.folder_depth("path").cast("bigint").alias("depth"),
            P.tree_label("path").alias("label"),
        )
        .orderBy("path")
    )


def source_table(sources: DataFrame) -> DataFrame:
    """source_no, source, bucket, prefix for addresses in ``source_no, source``.

    Addresses are split like all others. One without a bucket, and sources in
    different buckets, make a plan that must not be run.
    """
    at = P.split_uri("source")
    table = sources.select(
        F.col("source_no").cast("int").alias("source_no"), "source", at["bucket"].alias("bucket"), at["key"].alias("prefix")
    )
    seen = table.agg(F.min("bucket").alias("first"), F.max("bucket").alias("last")).first()
    if seen["first"] == "":
        raise PlanError("a source has no bucket")
    if seen["first"] != seen["last"]:
        raise PlanError(f"sources must share one bucket, got {seen['first']!r}, {seen['last']!r} and perhaps more")
    return table


def numbered_sources(spark: SparkSession, uris: list[str]) -> DataFrame:
    """source_no (from 1, in the order given) and source."""
    return spark.createDataFrame(list(enumerate(uris, 1)), "source_no int, source string")


def union_sources(
    inventory: DataFrame, sources: list[str] | DataFrame, max_broadcast_bytes: int | None = None
) -> DataFrame:
    """Inventory rows once per source they lie under, with source_no, source, prefix
    (inventory columns of these names are replaced).

    A bag union: a key under two overlapping prefixes comes out twice. Sources
    are addresses or a table (``source_no, source``) of any number of them: each
    key looks its own ancestors up, so the plan stays the same and the
    inventory is scanned once. What all sources have in common in front is also a
    pushed filter. Within the byte bound the sources are broadcast; beyond it
    keys and ancestors are shuffled, where AQE splits a hot folder. An inventory
    with a column ``bucket`` gives rows of the sources' bucket only.
    """
    spark = inventory.sparkSession
    given = numbered_sources(spark, sources) if isinstance(sources, list) else sources
    ensure_checkpoint_dir(spark)
    table = source_table(given).checkpoint()
    seen = table.agg(
        F.min("bucket").alias("bucket"), F.min(P.as_folder(F.col("prefix"))).alias("low"), F.max(P.as_folder(F.col("prefix"))).alias("high")
    ).first()
    if "bucket" in inventory.columns:
        inventory = inventory.filter(F.col("bucket") == seen["bucket"])
    # what the first and the last of all prefixes share, all share
    shared = os.path.commonprefix([seen["low"] or "", seen["high"] or ""])
    kept = [c for c in inventory.columns if c not in ("source_no", "source", "prefix")]
    reached = inventory.filter(F.startswith("key", F.lit(shared))).select(*kept, F.explode(P.ancestors("key")).alias("_folder"))
    folders = table.select("source_no", "source", "prefix", P.as_folder(F.col("prefix")).alias("_folder"))
    small = fits_broadcast(folders, max_broadcast_bytes)
    found = reached.join(F.broadcast(folders) if small else folders.hint("merge"), "_folder")
    return found.select("source_no", "source", "prefix", *kept)


def rebase_plan(sourced: DataFrame, base: str, dest: str) -> DataFrame:
    """Adds ``dst`` to the rows of :func:`union_sources`; ``key`` becomes ``src``."""
    return sourced.select(
        "source_no",
        "source",
        F.col("key").alias("src"),
        P.rebase("key", F.col("prefix"), base, dest).alias("dst"),
        *[c for c in sourced.columns if c not in ("source_no", "source", "prefix", "key")],
    )


def numbered_plan(plan: DataFrame) -> DataFrame:
    """Adds ``task_no`` in the order of sources and keys."""
    return number_rows(plan, ["source_no", "src"])


def duplicate_targets(plan: DataFrame) -> DataFrame:
    """dst, n for targets that more than one distinct source would write."""
    return (
        plan.select("src", "dst")
        .distinct()
        .groupBy("dst")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def check_targets(plan: DataFrame) -> None:
    """Fail a plan in which two sources share a target."""
    clash = duplicate_targets(plan).take(5)
    if clash:
        raise PlanError("several sources for one target: " + ", ".join(r["dst"] for r in clash))


def _source_folders(sourced: DataFrame) -> DataFrame:
    """Distinct non-empty parent folders, relative to the prefix, per source."""
    return (
        sourced.select("source", P.parent_folder(P.relative("key", F.col("prefix"))).alias("folder"))
        .filter(F.col("folder") != "")
        .distinct()
    )


def folder_rollup(sourced: DataFrame) -> DataFrame:
    """source, n_objects, n_folders.

    Both counts combine before the shuffle, so a source with a third of all
    keys costs no task more than the others.
    """
    folder = P.parent_folder(P.relative("key", F.col("prefix")))
    return (
        sourced.select("source", F.nullif(folder, F.lit("")).alias("folder"))
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("n_objects"), F.count_distinct("folder").alias("n_folders"))
    )


def folder_list(sourced: DataFrame) -> DataFrame:
    """source, folder in sorted order; rows rather than an array per source,
    which has no bound."""
    return _source_folders(sourced).orderBy("source", "folder")


def folder_cap(sourced: DataFrame, cap: int = FOLDER_CAP) -> DataFrame:
    """The first ``cap`` folders per source and how many more there are.

    The rank filter reaches below the shuffle, so at most ``cap`` rows per
    source and task travel; the totals are a separate partial aggregate.
    """
    folders = _source_folders(sourced)
    ranked = folders.withColumn(
        "rn", F.row_number().over(W.partitionBy("source").orderBy("folder"))
    ).filter(F.col("rn") <= cap)
    totals = folders.groupBy("source").agg(F.count(F.lit(1)).alias("n_folders"))
    return ranked.join(totals, "source").select(
        "source",
        "folder",
        F.col("rn").cast("bigint").alias("rn"),
        F.greatest(F.col("n_folders") - cap, F.lit(0)).alias("n_more"),
    )
