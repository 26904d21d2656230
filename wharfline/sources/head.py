"""The first data lines of line files, without reading the rest.

Samples need a few lines in input order. Files are taken in the order of their
names and read from the front until there is enough: the number of lines is
doubled each time, so at most about twice of what was needed is read. Spark runs a
limit on one split first and on more only where that has too few lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.text import preview
from wharfline.operators.diagnose import SAMPLE_KEYS, SAMPLE_LINES, flag_members
from wharfline.sources.lines import data_lines, refuse_hidden

START_LINES = 1_000
MOST_LINES = 256_000   # lines kept on the driver at most; each cut to its preview


def head_lines(
    spark: SparkSession, path: str | list[str], enough: Callable[[list[Row]], bool], start: int = START_LINES, most: int = MOST_LINES
) -> list[Row] | None:
    """``shown, k`` of the first data lines, as many as ``enough`` asks for, or all.

    None where ``most`` lines were not enough.
    """
    refuse_hidden(spark, path)
    files = sorted(spark.read.text(path).inputFiles())
    n = start
    while True:
        rows: list[Row] = []
        for file in files:
            data = data_lines(spark.read.text(file)).select(preview("value").alias("shown"), "k")
            rows += data.limit(n - len(rows)).collect()
            if len(rows) == n:
                break
        if enough(rows) or len(rows) < n:
            return rows
        if n >= most:
            return None
        n = min(2 * n, most)


def head_sample_lines(spark: SparkSession, path: str | list[str], keys: DataFrame, n: int = SAMPLE_LINES) -> DataFrame:
    """The first ``n`` data lines: ord, shown, k, in_list (null for key '')."""
    rows = head_lines(spark, path, lambda found: len(found) >= n, start=n)[:n]
    sample = spark.createDataFrame([(i, r["shown"], r["k"]) for i, r in enumerate(rows, 1)], "ord long, shown string, k string")
    return flag_members(sample, keys).select("ord", "shown", "k", F.when(F.col("k") != "", F.col("in_list")).alias("in_list"))


def head_sample_keys(
    spark: SparkSession, path: str | list[str], keys: DataFrame, n: int = SAMPLE_KEYS, start: int = START_LINES, most: int = MOST_LINES
) -> DataFrame | None:
    """The first ``n`` distinct non-empty keys in input order: ord, k, in_list.

    The first lines give them as soon as ``n`` keys are among them. None where
    that takes more than ``most`` lines; ``sample_keys`` then reads everything.
    """

    def distinct(rows: list[Row]) -> list[str]:
        return list(dict.fromkeys(r["k"] for r in rows if r["k"]))

    rows = head_lines(spark, path, lambda found: len(distinct(found)) >= n, start, most)
    if rows is None:
        return None
    sample = spark.createDataFrame(list(enumerate(distinct(rows)[:n], 1)), "ord long, k string")
    return flag_members(sample, keys).select("ord", "k", "in_list")
