"""Line files.

Spark's text reader ends lines at ``\\n``, ``\\r`` and ``\\r\\n`` and leaves the
bytes of a line alone, so undecodable lines can still be told apart. It drops
a byte-order mark at the start of a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wharfline.functions.text import (
    col,
    first_field_key,
    is_blank,
    is_decodable,
    preview,
    strip,
    whole_line_key,
)
from wharfline.operators.lookup import lookup_join
from wharfline.workdir import ensure_checkpoint_dir


def split_at_line_ends(text: Column | str) -> Column:
    """array of lines; a one-character separator spares the regex engine."""
    unix = F.replace(F.replace(col(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.split(unix, "\n")


# Names that Spark's own writers leave beside data.
MARKERS = ("_SUCCESS", "_temporary", "_spark_metadata", "_committed_", "_started_")


class HiddenInput(ValueError):
    """A file that Spark's readers would pass over."""


def refuse_hidden(spark: SparkSession, path: str | list[str]) -> None:
    """Raise for names with ``_`` or ``.`` in front among the inputs.

    Spark's text reader passes over them, whether named, matched by a pattern or
    in a folder. Looks where the reader does: at the given paths, one level below,
    and below folders of partitions (``name=value``). Markers of Spark's own writers
    and checksums are no data.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hidden = []
    for one in [path] if isinstance(path, str) else path:
        place = jvm.org.apache.hadoop.fs.Path(one)
        fs = place.getFileSystem(conf)
        waiting = list(fs.globStatus(place) or [])
        while waiting:
            status = waiting.pop()
            names = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            hidden += [n.getPath().toString() for n in names if _is_hidden(n.getPath().getName())]
            if status.isDirectory():
                waiting += [n for n in names if n.isDirectory() and "=" in n.getPath().getName()]
    if hidden:
        raise HiddenInput(f"{len(hidden)} inputs would be passed over, rename them: {sorted(hidden)[:10]}")


def _is_hidden(name: str) -> bool:
    return name[:1] in "._" and "=" not in name and not name.startswith(MARKERS) and not name.endswith(".crc")


def read_lines(
    spark: SparkSession, path: str | list[str], positions: bool = False, spread: int | None = None
) -> DataFrame:
    """``value`` per line, gzip files included; with ``positions`` also ``pos``,
    a struct that sorts in input order.

    Take positions here: row ids that are added after a filter or a shuffle
    no longer follow the input. ``spread`` deals the lines out to that many
    partitions; use it for gzip files, which are one partition each. Names that
    Spark would pass over raise ``HiddenInput``.
    """
    refuse_hidden(spark, path)
    df = spark.read.text(path)
    if positions:
        df = _with_positions(df)
    return df.repartition(spread) if spread else df


def _with_positions(df: DataFrame) -> DataFrame:
    return df.select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Adds ``line_no``, 1-based within each file, to lines with positions.

    The rows of a file split follow one another in one partition, so a count
    and a first row id per split are enough. That table is stored and, if it
    fits, broadcast: the lines themselves are neither sorted nor shuffled.
    """
    ensure_checkpoint_dir(lines.sparkSession)
    per_split = (
        lines.groupBy(F.col("pos.file").alias("file"), F.col("pos.block").alias("block"))
        .agg(F.min("pos.row").alias("first_row"), F.count(F.lit(1)).alias("n"))
        .checkpoint()
    )
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = per_split.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    placed = lines.withColumns({"file": F.col("pos.file"), "block": F.col("pos.block")})
    return (
        lookup_join(placed, starts, ["file", "block"], "left")
        .withColumn("line_no", F.col("pos.row") - F.col("first_row") + F.col("skip") + 1)
        .drop("file", "block", "first_row", "skip")
    )


def split_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, line_no, value`` for every non-blank line of a text column, stripped."""
    return (
        df.select(
            F.col(id_col),
            F.posexplode(split_at_line_ends(text_col)).alias("line_no", "raw"),
        )
        .filter(~is_blank("raw"))
        .select(id_col, F.col("line_no").cast("bigint").alias("line_no"), strip("raw").alias("value"))
    )


def data_lines(lines: DataFrame, key: Column | None = None) -> DataFrame:
    """Lines that count as data, with their key in ``k``: decodable, not blank."""
    k = first_field_key("value") if key is None else key
    return lines.filter(is_decodable("value") & ~is_blank("value")).withColumn("k", k)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines whose bytes are not valid UTF-8."""
    return lines.filter(~is_decodable("value"))


def first_rejects(lines: DataFrame, n: int = 10, pos: str = "pos") -> DataFrame:
    """The first ``n`` rejected lines in input order, readable: bad bytes are
    replaced and the length is in bytes."""
    return (
        rejected_lines(lines)
        .orderBy(pos)
        .limit(n)
        .select(
            pos,
            preview(F.make_valid_utf8("value")).alias("shown"),
            F.octet_length("value").cast("bigint").alias("n_bytes"),
        )
    )


def key_lines(lines: DataFrame, key: Column | None = None) -> DataFrame:
    """Key list ``k``: decodable lines, blank ones included as ''."""
    k = whole_line_key("value") if key is None else key
    return lines.filter(is_decodable("value")).select(k.alias("k"))


def parquet_to_lines(df: DataFrame, columns: list[str] | None = None, sep: str = ",") -> DataFrame:
    """Rows as separated text; a null is an empty field."""
    names = columns or df.columns
    fields = [F.coalesce(col(n).cast("string"), F.lit("")) for n in names]
    return df.select(F.concat_ws(sep, *fields).alias("value"))
