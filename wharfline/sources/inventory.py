"""File inventories.

``walk_inventory`` lists folders level by level, each level's folders dealt out
anew, and stores what it finds; jobs that move files start from it.
``scan_inventory`` is a data source that lists when it is read and takes filters
into the listing; it suits looking at part of a tree.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import wharfline
from wharfline.functions.paths import base_name, relative
from wharfline.sources.listing import list_files, lister, root_name
from wharfline.workdir import new_dir

cloudpickle.register_pickle_by_value(wharfline)

_ENTRY = "path string, is_dir boolean, size bigint, mtime_us bigint, error string"
_EMIT_ROWS = 10_000
_TASK_FOLDERS = 500


def scan_inventory(spark: SparkSession, root: str, glob: str | None = None, hidden: bool = False) -> DataFrame:
    """uri, path (below ``root``), size, mtime, error of every file under ``root``.

    ``glob`` is a pattern of file names; one such as ``*.gz`` reaches the listing.
    Filters that follow, by prefix or suffix of ``path`` or by ``size``, do too.
    """
    files = list_files(spark, root, hidden)
    if not glob:
        return files
    tail = glob[1:]
    if glob.startswith("*") and not set(tail) & set("*?["):
        return files.filter(F.endswith("path", F.lit(tail)))
    return files.filter(F.rlike(base_name("path"), F.lit(fnmatch.translate(glob))))


def _list_folders(folders: Iterator[str], root: str, hidden: bool) -> Iterator[pd.DataFrame]:
    """Frames of entries; folders are streamed, so a huge one needs no memory."""
    listing = lister(root)
    rows: list[tuple] = []
    for folder in folders:
        try:
            for e in listing(folder):
                if hidden or not e.name.startswith("."):
                    rows.append((e.uri, e.is_dir, e.size, e.mtime_us, e.error))
                if len(rows) >= _EMIT_ROWS:
                    yield _frame(rows)
                    rows = []
        except OSError as err:
            rows.append((folder, False, None, None, f"{type(err).__name__}: {err}"))
    yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["path", "is_dir", "size", "mtime_us", "error"])
    return out.astype({"size": "Int64", "mtime_us": "Int64", "is_dir": "bool"})


def walk_inventory(
    spark: SparkSession, root: str, hidden: bool = False, tasks: int | None = None
) -> DataFrame:
    """uri, path, size, mtime, error for all files below a folder or URI.

    One job per folder level lists all folders of that level in parallel;
    hidden folders are never entered unless ``hidden``. What cannot be read is
    a row with ``error`` and no size.
    """
    top = root_name(root)
    work = new_dir(spark, "walk")
    at_least = tasks or spark.sparkContext.defaultParallelism * 2

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _list_folders(iter(batch["path"]), top, hidden)

    folders, n_folders, level = spark.createDataFrame([(top,)], "path string"), 1, -1
    while n_folders:
        level += 1
        here = f"{work}/level={level}"
        if level:
            folders = folders.repartition(max(at_least, n_folders // _TASK_FOLDERS), "path")
        folders.mapInPandas(step, _ENTRY).write.parquet(here)
        folders = spark.read.schema(_ENTRY).parquet(here).filter("is_dir").select("path")
        n_folders = folders.count()
    return (
        spark.read.schema(_ENTRY)
        .parquet(*[f"{work}/level={n}" for n in range(level + 1)])
        .filter(~F.col("is_dir"))
        .select(
            F.col("path").alias("uri"),
            relative("path", top).alias("path"),
            "size",
            F.timestamp_micros("mtime_us").alias("mtime"),
            "error",
        )
    )
