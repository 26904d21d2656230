"""Writing matched lines."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from fnmatch import fnmatchcase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import wharfline
from wharfline.sources.files import commit_staged, discard_staged, posix_path, staging_name, write_at
from wharfline.workdir import new_dir

cloudpickle.register_pickle_by_value(wharfline)

# Fixed value: name of the result beside the data file.
OUTPUT_NAME = "matches_output.csv"
GZIP = 31  # zlib's window bits for a gzip member


def output_path(data_path: str) -> str:
    """The result's place: the folder of the data file, or no folder at all."""
    folder, slash, _ = data_path.rpartition("/")
    return f"{folder}{slash}{OUTPUT_NAME}"


class OutputInInput(ValueError):
    """The result would lie among the files that a next run reads."""


def _segments(path: str) -> list[str]:
    """Segments of a full name: plain ones and ``file:`` ones alike, others with their scheme in front."""
    plain = posix_path(path)
    full = path if plain is None else os.path.abspath(plain)
    return [s for s in full.split("/") if s]


def refuse_output_in_input(data_path: str | list[str], out: str) -> None:
    """Raise where an input file, folder or pattern takes in ``out`` or a part below it.

    Patterns match segment by segment, as Hadoop's do; alternatives in braces
    count as anything.
    """
    target = _segments(out)
    for one in [data_path] if isinstance(data_path, str) else data_path:
        given = [re.sub(r"\{[^}]*\}", "*", s) for s in _segments(one)]
        # a folder takes in its files, and a result is a file or a folder of parts
        for name in (target, [*target, "part-00000.txt"]):
            if len(given) <= len(name) and all(map(fnmatchcase, name, given)):
                raise OutputInInput(f"{out} lies in the input {one}; name another place as out")


def write_matches(matches: DataFrame, path: str, pos: str = "pos", single: bool = False) -> None:
    """Write ``value`` in input order, replacing ``path``, a folder of parts.

    Parts in name order hold the lines in input order. With ``single``, ``path``
    is one file, see :func:`write_one_file`. ``matches`` is read more than once, so
    hand over a stored result.
    """
    if single:
        write_one_file(matches, path, pos)
    else:
        matches.orderBy(pos).select("value").write.mode("overwrite").text(path)


def _with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds where each line begins, in bytes from the start of its partition."""
    at = 0
    for batch in batches:
        ends = np.cumsum(_sizes(batch.column("value")) + 1)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) + at
        at += int(ends[-1]) if len(ends) else 0
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(begins[: len(batch)])], names=[*batch.schema.names, "at"])


def _sizes(values: pa.Array) -> np.ndarray:
    return pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64)


def _gzip_member(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of a partition as one gzip member, piece by piece, and where each piece begins; nothing without lines."""
    packer, at, some = zlib.compressobj(wbits=GZIP), 0, False

    def row(piece: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"value": pa.array([piece], pa.binary()), "at": pa.array([at], pa.int64())})

    for batch in batches:
        some = some or len(batch) > 0
        piece = packer.compress(b"".join([(v or b"") + b"\n" for v in batch.column("value").to_pylist()]))
        if piece:
            yield row(piece)
            at += len(piece)
    if some:
        yield row(packer.flush())


def _write_ranges(staged: str, end: bytes):
    """Writer of lines at their places in the staged file, ``end`` after each; what is next to each other goes in one write."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_bytes = 0
        for batch in batches:
            if not len(batch):
                continue
            begins = batch.column("begin").to_numpy()
            lines = [v + end for v in batch.column("value").to_pylist()]
            ends = begins + np.array([len(line) for line in lines])
            cuts = [0, *(np.flatnonzero(begins[1:] != ends[:-1]) + 1).tolist(), len(lines)]
            for a, b in zip(cuts, cuts[1:]):
                n_bytes += write_at(staged, int(begins[a]), b"".join(lines[a:b]))
        yield pa.RecordBatch.from_pydict({"n_bytes": pa.array([n_bytes], pa.int64())})

    return write


def _write_joined(placed: DataFrame, target: str, end: bytes) -> int:
    """Store ``value, at`` of sorted partitions, and write the partitions one after the other, ``end`` between values and between partitions; returns the file's bytes."""
    spark = placed.sparkSession
    table = new_dir(spark, "one-file")
    placed.withColumn("part", F.spark_partition_id()).write.parquet(table)
    stored = spark.read.schema("value binary, at bigint, part int").parquet(table)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # one row per partition, so one task and a broadcast hold it
    parts = stored.groupBy("part").agg(F.sum(F.octet_length("value") + F.lit(len(end))).alias("n"))
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    staged = staging_name(target, uuid.uuid4().hex)
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    write_at(staged, 0, b"")
    written = new_dir(spark, "ranges")
    ranges = stored.join(F.broadcast(starts), "part").select("value", (F.col("at") + F.col("start")).alias("begin"))
    try:
        ranges.mapInArrow(_write_ranges(staged, end), "n_bytes bigint").write.parquet(written)
        total = spark.read.schema("n_bytes bigint").parquet(written).agg(F.sum("n_bytes")).first()[0] or 0
        if total:
            os.truncate(staged, total - len(end))
        return commit_staged(staged, target, max(total - len(end), 0))
    finally:
        discard_staged(staged)


def _one_file(path: str) -> str:
    target = posix_path(path)
    if target is None:
        raise ValueError(f"one file is written in ranges, which {path} does not allow; write parts instead")
    return target


def _in_order(lines: DataFrame, pos: str) -> DataFrame:
    return lines.repartitionByRange(pos).sortWithinPartitions(pos).select(F.col("value").cast("binary").alias("value"))


def write_one_file(lines: DataFrame, path: str, pos: str = "pos") -> int:
    """Write ``value`` in the order of ``pos`` as one file of ``\\n``-separated lines; returns its bytes.

    Many tasks write it: lines are range-partitioned, sorted and stored with
    their places, and the sizes of the partitions before tell each where it
    begins in the file. The last line has no line end, no lines give an empty
    file. The file gets its name when all ranges are there; a repeated task
    writes the same bytes at the same places. ``path`` is on a folder that all
    executors share.
    """
    target = _one_file(path)
    return _write_joined(_in_order(lines, pos).mapInArrow(_with_places, "value binary, at bigint"), target, b"\n")


def write_one_gzip(lines: DataFrame, path: str, pos: str = "pos") -> int:
    """Write ``value`` in the order of ``pos`` as one gzip file, a newline after every line; returns its bytes.

    Many tasks write it, as in :func:`write_one_file`: each sorted partition is a
    member of its own, and members one after the other are one gzip file. A null
    value is an empty line; no lines give an empty file.
    """
    target = _one_file(path)
    return _write_joined(_in_order(lines, pos).mapInArrow(_gzip_member, "value binary, at bigint"), target, b"")
