"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

import wharfline
from wharfline.workdir import new_dir

# Functions travel with their code: executors need not have this package.
cloudpickle.register_pickle_by_value(wharfline)

_TYPES = {"string": StringType(), "double": DoubleType(), "long": LongType()}


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result depends on files only, so a lost executor costs no recomputation
    of what led to it.
    """
    spark = df.sparkSession
    path = new_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Let jobs inside send rows to Python ``n`` at a time: for rows that are texts, the usual ten thousand take up too much."""
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(option)
    spark.conf.set(option, str(n))
    try:
        yield
    finally:
        spark.conf.set(option, before)


def row_tag(df: DataFrame, *names: str) -> None:
    """Fail early where a needed column is missing or ambiguous."""
    for name in names:
        if df.columns.count(name) != 1:
            raise ValueError(f"column {name} must occur exactly once, columns are {df.columns}")


def with_fields(df: DataFrame, **types: str) -> StructType:
    """The schema of ``df`` followed by new fields; ``df`` has none of these names."""
    return StructType([*df.schema.fields, *(StructField(n, _TYPES[t]) for n, t in types.items())])


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
