"""Tables stored in buckets of their keys, so that joins don't shuffle them again.

The files carry their bucket in the name; what a reader needs besides is kept
beside them. A table is opened under a passing name, so the catalog stays as it
was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ABOUT = "columns string, keys array<string>, buckets int"


def write_buckets(df: DataFrame, path: str, on: list[str], buckets: int, gather: bool = True) -> DataFrame:
    """Store ``df`` bucketed and sorted by ``on`` below ``path``, and open it.

    ``gather`` shuffles the rows first, so that a bucket is one file. Without it
    each task writes its own file for each of its buckets and nothing is
    shuffled; that suits few and large rows.
    """
    spark = df.sparkSession
    name = _passing_name()
    rows = df.repartition(buckets, *on) if gather else df
    rows.write.mode("overwrite").bucketBy(buckets, *on).sortBy(*on).option("path", f"{path}/data").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.range(1).select(
        F.lit(columns).alias("columns"), F.array(*[F.lit(c) for c in on]).alias("keys"), F.lit(buckets).alias("buckets")
    ).write.mode("overwrite").parquet(f"{path}/about")
    return open_buckets(spark, path)


def open_buckets(spark: SparkSession, path: str) -> DataFrame:
    """A table that :func:`write_buckets` stored, in this or an earlier session."""
    about = spark.read.schema(_ABOUT).parquet(f"{path}/about").first()
    keys, name = ", ".join(f"`{k}`" for k in about["keys"]), _passing_name()
    place = f"{path}/data".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({about['columns']}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {about['buckets']} BUCKETS LOCATION '{place}'")
    try:
        # resolved here; the files stay when the name goes
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _passing_name() -> str:
    return f"wharfline_{uuid.uuid4().hex}"
