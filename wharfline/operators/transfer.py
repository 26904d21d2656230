"""Copying and unpacking many files as Spark jobs.

A plan has ``src``, ``dst`` and ``size``. Every job stores its
outcomes (OUTCOME_SCHEMA) as a table, since a second evaluation would move the
files again, and returns that table. ``run`` names a run: repeated under the same
name it takes the place of what a stopped one has left.
"""

from __future__ import annotations

import math
import os
import time
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import wharfline
from wharfline.functions import paths as P
from wharfline.operators.numbering import number_rows
from wharfline.operators.sync import ERROR, SKIPPED, UPLOADED
from wharfline.sources import files as IO
from wharfline.workdir import ensure_checkpoint_dir, new_dir

# Task functions travel with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(wharfline)

# Fixed value: bytes per copied part.
PART_BYTES = 100 * 1024 * 1024

TASK_BYTES = 2 * 1024 * 1024 * 1024
TASK_FILES = 2_000

OUTCOME_SCHEMA = (
    "src string, dst string, status string, bytes bigint, error string, "
    "compressed_source string, started timestamp, ended timestamp"
)
_ROW = "src string, dst string, bytes bigint, error string, started_us bigint, ended_us bigint"
_ROW_NAMES = ["src", "dst", "bytes", "error", "started_us", "ended_us"]


class TransferError(RuntimeError):
    """At least one file failed under ``on_error='fail'``."""


def _now_us() -> int:
    return time.time_ns() // 1000


def _attempt(work: Callable[[], int]) -> tuple[int, str | None, int, int]:
    """Run one file's work; an exception becomes the row's error."""
    started = _now_us()
    try:
        return work(), None, started, _now_us()
    except Exception as e:  # noqa: BLE001 - one bad file must not end the job
        return 0, f"{type(e).__name__}: {e}", started, _now_us()


def _task_token(run: str) -> str:
    ctx = TaskContext.get()
    return f"{run}-{ctx.taskAttemptId() if ctx else 0}"


def _staged(src: str, dst: str, run: str) -> str:
    """Staging name of one copy; it differs for two sources of one target."""
    return IO.staging_name(IO.posix_path(dst), f"{run}-{zlib.crc32(src.encode()):08x}")


def _task_count(plan: DataFrame, tasks: int | None) -> int:
    """Enough tasks for the cluster as it is now and for the plan's size; with
    dynamic allocation a session may start with very few cores."""
    if tasks:
        return tasks
    got = plan.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    by_size = math.ceil((got["size"] or 0) / TASK_BYTES)
    by_count = math.ceil(got["n"] / TASK_FILES)
    cores = plan.sparkSession.sparkContext.defaultParallelism
    return max(2 * cores, by_size, by_count)


def _outcomes(rows: DataFrame, status: Column, compressed: Column) -> DataFrame:
    return rows.select(
        "src",
        "dst",
        status.alias("status"),
        "bytes",
        "error",
        compressed.cast("string").alias("compressed_source"),
        F.timestamp_micros("started_us").alias("started"),
        F.timestamp_micros("ended_us").alias("ended"),
    )


def _status() -> Column:
    return F.when(F.col("error").isNull(), F.lit(UPLOADED)).otherwise(F.lit(ERROR))


def _store(outcomes: DataFrame, out: str | None, run: str, on_error: str) -> DataFrame:
    """Store this run's outcomes below ``out`` and read them back. A run of the same
    name that was cut off has left nothing that counts; its rest is replaced."""
    if on_error not in ("record", "fail"):
        raise ValueError(f"on_error must be 'record' or 'fail', not {on_error!r}")
    spark = outcomes.sparkSession
    table = f"{out or new_dir(spark, 'outcomes')}/run={run}"
    outcomes.write.mode("overwrite").parquet(table)
    stored = spark.read.schema(OUTCOME_SCHEMA).parquet(table)
    _sweep(stored, run)
    if on_error == "fail":
        bad = stored.filter(F.col("status") == ERROR)
        n = bad.count()
        if n:
            shown = [f"{r['src']}: {r['error']}" for r in bad.orderBy("src").limit(10).collect()]
            raise TransferError(f"{n} files failed; first: " + "; ".join(shown))
    return stored


def _sweep(stored: DataFrame, run: str) -> None:
    """Remove staged files that killed tasks of this run have left beside the targets."""

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [IO.sweep_staged(IO.posix_path(f) or "/", run) for f in batch["folder"]]})

    moved = stored.filter((F.col("status") != SKIPPED) & _on_shared_folder("dst"))
    folders = moved.select(P.parent_folder("dst").alias("folder")).filter("folder <> ''").distinct()
    folders.mapInPandas(sweep, "n bigint").write.format("noop").mode("overwrite").save()


def _unpack_rows(plan: DataFrame, tasks: int, run: str) -> DataFrame:
    """One compressed file per row, each streamed whole by one task."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = _task_token(run)
        for batch in batches:
            rows = [
                (s, d, *_attempt(lambda s=s, d=d: IO.stream_to(s, d, token, unpack=True)))
                for s, d in zip(batch["src"], batch["dst"])
            ]
            yield pd.DataFrame(rows, columns=_ROW_NAMES)

    return _by_size(plan, tasks).select("src", "dst").mapInPandas(unpack, _ROW)


def _by_size(plan: DataFrame, tasks: int) -> DataFrame:
    """Files dealt out from the largest down, forth and back over the tasks, so
    that tasks get about the same bytes and no two giants share one."""
    sized = plan.withColumn("_less", -F.coalesce(F.col("size"), F.lit(0)))
    turn = (F.col("_turn") - 1) % (2 * tasks)
    task = F.when(turn < tasks, turn).otherwise(2 * tasks - 1 - turn)
    return number_rows(sized, ["_less", "src"], "_turn").repartitionById(tasks, task.cast("int"))


def _part_rows(plan: DataFrame, part_bytes: int) -> DataFrame:
    """Byte ranges of all files as rows, so one huge file uses many tasks.

    Ranges need a shared folder at both ends; any other file is one range.
    """
    ranged = _on_shared_folder("src") & _on_shared_folder("dst")
    step = F.when(ranged, F.lit(part_bytes)).otherwise(F.greatest("size", F.lit(1))).cast("bigint")
    last = F.greatest(F.ceil(F.col("size") / F.col("step")), F.lit(1)) - 1
    return (
        plan.withColumns({"ranged": ranged, "step": step})
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .withColumn("offset", F.col("part") * F.col("step"))
        .withColumn("length", F.least(F.col("size") - F.col("offset"), F.col("step")))
        .drop("part", "step")
    )


def _copy_parts(plan: DataFrame, part_bytes: int, tasks: int, run: str) -> DataFrame:
    def copy_one(r, token: str) -> int:
        if not r.ranged:
            return IO.stream_to(r.src, r.dst, token, unpack=False, size=int(r.size))
        staged = _staged(r.src, r.dst, run)
        return IO.copy_range(IO.posix_path(r.src), staged, int(r.offset), int(r.length))

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = _task_token(run)
        for batch in batches:
            rows = [
                (r.src, r.dst, *_attempt(lambda r=r: copy_one(r, token)), r.size, r.ranged)
                for r in batch.itertuples(index=False)
            ]
            yield pd.DataFrame(rows, columns=[*_ROW_NAMES, "size", "ranged"])

    return (
        _part_rows(plan, part_bytes)
        .repartition(tasks, "src", "dst", "offset")
        .mapInPandas(copy, _ROW + ", size bigint, ranged boolean")
    )


def _commit_parts(parts: DataFrame, tasks: int, run: str) -> DataFrame:
    """Move every file whose parts all arrived to its name."""

    def commit_one(r) -> int:
        staged = _staged(r.src, r.dst, run) if r.ranged else None
        problem = r.error
        if problem is None and r.bytes != r.size:
            problem = f"size mismatch: source {r.size}, copied {r.bytes}"
        if problem is None and r.ranged:
            now = os.path.getsize(IO.posix_path(r.src))
            if now != r.size:
                problem = f"source changed from {r.size} to {now} bytes"
        if problem is not None:
            if staged:
                IO.discard_staged(staged)
            raise OSError(problem)
        return IO.commit_staged(staged, IO.posix_path(r.dst), int(r.size)) if staged else int(r.bytes)

    def commit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                n, error, _, ended = _attempt(lambda r=r: commit_one(r))
                rows.append((r.src, r.dst, n, error, r.started_us, ended))
            yield pd.DataFrame(rows, columns=_ROW_NAMES)

    whole = parts.groupBy("src", "dst", "size", "ranged").agg(
        F.sum("bytes").alias("bytes"),
        F.min("error").alias("error"),
        F.min("started_us").alias("started_us"),
    )
    return whole.repartition(tasks, "dst").mapInPandas(commit, _ROW)


def _on_shared_folder(name: str) -> Column:
    return F.startswith(F.col(name), F.lit("file:")) | ~F.contains(F.col(name), F.lit("://"))


def _copy_outcomes(plan: DataFrame, run: str, part_bytes: int, tasks: int) -> DataFrame:
    spark = plan.sparkSession
    # An unknown size cannot be verified; -1 makes it an error row.
    size = F.coalesce(F.col("size").cast("bigint"), F.lit(-1))
    plan = plan.select("src", "dst", size.alias("size"))
    # Stored before anything is renamed: redoing lost parts afterwards could
    # put an incomplete file in place of a finished one.
    parts_table = new_dir(spark, "parts")
    _copy_parts(plan, part_bytes, tasks, run).write.parquet(parts_table)
    rows = _commit_parts(spark.read.parquet(parts_table), tasks, run)
    return _outcomes(rows, _status(), F.lit(None))


def _unpack_outcomes(plan: DataFrame, run: str, tasks: int) -> DataFrame:
    return _outcomes(_unpack_rows(plan, tasks, run), _status(), F.lit("yes"))


def copy_job(
    plan: DataFrame,
    out: str | None = None,
    part_bytes: int = PART_BYTES,
    tasks: int | None = None,
    on_error: str = "record",
    run: str | None = None,
) -> DataFrame:
    """Copy ``src`` to ``dst`` byte for byte and check the size.

    On shared folders files are cut into parts; the parts' outcomes are stored
    before anything gets its final name, so a lost executor never leads to a
    half-written target. Files with another scheme are streamed one per task.
    Existing targets are replaced; a zero-byte file is copied as such.
    """
    run, tasks = run or uuid.uuid4().hex, _task_count(plan, tasks)
    return _store(_copy_outcomes(plan, run, part_bytes, tasks), out, run, on_error)


def unpack_job(
    plan: DataFrame,
    out: str | None = None,
    tasks: int | None = None,
    on_error: str = "record",
    run: str | None = None,
) -> DataFrame:
    """Gunzip ``src`` to ``dst``. A gzip stream cannot be cut, so each file is
    streamed by one task, and ``size`` (compressed) serves to balance the tasks;
    a corrupt file gives an error row and no target."""
    run, tasks = run or uuid.uuid4().hex, _task_count(plan, tasks)
    return _store(_unpack_outcomes(plan, run, tasks), out, run, on_error)


def sync_job(
    plan: DataFrame,
    out: str | None = None,
    part_bytes: int = PART_BYTES,
    tasks: int | None = None,
    on_error: str = "record",
    run: str | None = None,
) -> DataFrame:
    """Carry out a plan with ``src, dst, size, action, compressed_source``:
    copy plain files, unpack compressed ones, record the skipped ones and those
    that the plan itself marks as errors (their text in ``error``)."""
    run = run or uuid.uuid4().hex
    # Fixed first: the moves below change what the plan was derived from.
    ensure_checkpoint_dir(plan.sparkSession)
    if "error" not in plan.columns:
        plan = plan.withColumn("error", F.lit(None).cast("string"))
    plan = plan.select("src", "dst", "size", "action", "compressed_source", "error").checkpoint()
    todo = plan.filter(~F.col("action").isin(SKIPPED, ERROR))
    tasks = _task_count(todo, tasks)
    packed = F.coalesce(F.col("compressed_source") == "yes", F.lit(False))
    now = F.current_timestamp()
    untouched = plan.filter(F.col("action").isin(SKIPPED, ERROR)).select(
        "src",
        "dst",
        F.col("action").alias("status"),
        F.lit(0).cast("bigint").alias("bytes"),
        "error",
        "compressed_source",
        now.alias("started"),
        now.alias("ended"),
    )
    outcomes = (
        _copy_outcomes(todo.filter(~packed), run, part_bytes, tasks)
        .unionByName(_unpack_outcomes(todo.filter(packed), run, tasks))
        .unionByName(untouched)
    )
    return _store(outcomes, out, run, on_error)
