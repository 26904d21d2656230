"""Line, key, path and inventory views derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions import paths as P
from wharfline.sources.lines import split_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ORDER_FIELDS = ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority"]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pos, value: every order as a comma-separated line, customer key first."""
    orders = table(spark, sf_dir, "orders")
    fields = [F.col(c).cast("string") for c in ORDER_FIELDS]
    return orders.select(F.col("o_orderkey").alias("pos"), F.concat_ws(",", *fields).alias("value"))


def segment_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value: the customers of one market segment, one key per line."""
    customers = table(spark, sf_dir, "customer")
    return customers.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").cast("string").alias("value")
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_text(table(spark, sf_dir, "documents"), "doc_id", "text")


def benchmark_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_text(table(spark, sf_dir, "benchmark"), "item_id", "text")


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; those with o_orderkey divisible by 97 end in a byte that is
    not UTF-8."""
    bad = F.concat(F.col("value").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    return order_lines(spark, sf_dir).withColumn(
        "value", F.when(F.col("pos") % 97 == 0, bad).otherwise(F.col("value"))
    )


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, key, size: a page's address without its scheme as key."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.regexp_replace("url", "^https?://", "").alias("key"),
        F.length("html").cast("bigint").alias("size"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, key, size: documents as files, every third one compressed."""
    doc = F.col("doc_id")
    ext = F.when(doc % 3 == 0, F.lit(".csv.gz")).otherwise(F.lit(".csv"))
    key = F.concat(F.lit("in/"), "source", F.lit("/"), "lang", F.lit("/"), doc.cast("string"), ext)
    return table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", key.alias("key"), F.col("n_chars").alias("size")
    )


def destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, size: most of the inventory unpacked, some with another size."""
    return (
        inventory(spark, sf_dir)
        .filter(F.col("doc_id") % 7 != 0)
        .select(
            P.drop_gz_suffix("key").alias("key"),
            (F.col("size") + F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0)).alias("size"),
        )
    )
