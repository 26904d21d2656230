"""Transfers in batches that survive a restart.

The plan is a stored table, cut into steps of a fixed number of files. A
Structured Streaming query reads it step by step; each batch moves its files,
stores their outcomes and then their done marks, all under the batch's number.
A run that was stopped goes on with the batch it was in: the stream's checkpoint
knows which steps a batch holds, and a batch whose outcomes are complete is not
moved again.

What lies below ``state``:

- ``plan``: the steps, one file each; more may be added between runs
- ``stream``: the checkpoint of the query
- ``outcomes/run=batch-N``: what came of the files of a batch
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.operators.folders import PlanError
from wharfline.operators.numbering import number_rows
from wharfline.operators.sync import ERROR, SKIPPED, UPLOADED
from wharfline.operators.transfer import OUTCOME_SCHEMA, TransferError, copy_job, sync_job, unpack_job
from wharfline.sources.ledger import mark_batch
from wharfline.workdir import exists

PLAN_SCHEMA = "src string, dst string, size bigint, action string, compressed_source string, error string"
STEP_FILES = 1_000
JOBS = {"copy": copy_job, "unpack": unpack_job, "sync": sync_job}


def store_plan(plan: DataFrame, state: str, step_files: int = STEP_FILES) -> None:
    """Store ``src, dst, size`` (and for 'sync' the rest of PLAN_SCHEMA) as steps.

    Steps follow the order of ``src`` and hold ``step_files`` files each, so a
    repeated call writes the same ones. A plan that is complete already stays.
    """
    if step_files < 1:
        raise PlanError("a step holds at least one file")
    if not exists(plan.sparkSession, f"{state}/plan/_SUCCESS"):
        _write_steps(plan, state, step_files, "overwrite")


def extend_plan(plan: DataFrame, state: str, step_files: int = STEP_FILES) -> None:
    """Add steps to a stored plan; the next run takes them up."""
    _write_steps(plan, state, step_files, "append")


def _write_steps(plan: DataFrame, state: str, step_files: int, mode: str) -> None:
    given = {f.name for f in plan.schema.fields}
    cells = [F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in _plan_fields(plan.sparkSession)]
    numbered = number_rows(plan.select(*cells), ["src", "dst"], "_no").withColumn("_step", F.expr(f"int((_no - 1) div {step_files})"))
    steps = numbered.agg(F.max("_step")).first()[0]
    if steps is None:
        rows = numbered.coalesce(1)
    else:
        rows = numbered.repartitionById(steps + 1, F.col("_step")).sortWithinPartitions("_no")
    rows.drop("_no", "_step").write.mode(mode).parquet(f"{state}/plan")


def _plan_fields(spark: SparkSession):
    return spark.createDataFrame([], PLAN_SCHEMA).schema.fields


def run_stored(
    spark: SparkSession,
    state: str,
    kind: str,
    ledger: str | None = None,
    steps_per_batch: int = 1,
    tasks: int | None = None,
    on_batch: Callable[[int], None] | None = None,
    stop_on_error: bool = False,
    **options,
) -> DataFrame:
    """Carry out the stored plan and return :func:`outcomes_of` it.

    ``kind`` is 'copy', 'unpack' or 'sync', ``options`` go to its job. Run it
    again after a crash or for added steps. A failed file is an error row and
    gets no done mark; a new plan against the ledger takes it up again.
    ``on_batch`` is called with the number of each batch that is committed; an
    exception in it ends the run after that batch. ``stop_on_error`` ends it after
    the first batch with a failed file: its outcomes and marks are kept, and files
    of later batches are not touched.
    """
    if kind not in JOBS:
        raise PlanError(f"kind must be one of {sorted(JOBS)}, not {kind!r}")
    job = JOBS[kind]

    def move(batch: DataFrame, number: int) -> None:
        table = f"{state}/outcomes/run={_name(number)}"
        if not exists(spark, f"{table}/_SUCCESS"):
            job(batch, f"{state}/outcomes", tasks=tasks, run=_name(number), **options)
        if ledger:
            stored = spark.read.schema(OUTCOME_SCHEMA).parquet(table)
            mark_batch(stored, ledger, f"{_plan_name(state)}-{number}")
        if on_batch:
            on_batch(number)
        if stop_on_error:
            bad = spark.read.schema(OUTCOME_SCHEMA).parquet(table).filter(F.col("status") == ERROR).select("src", "error").first()
            if bad:
                raise TransferError(f"stopped after batch {number}: {bad['src']}: {bad['error']}")

    steps = spark.readStream.schema(PLAN_SCHEMA).option("maxFilesPerTrigger", steps_per_batch).parquet(f"{state}/plan")
    query = (
        steps.writeStream.foreachBatch(move)
        .option("checkpointLocation", f"{state}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return outcomes_of(spark, state)


def _name(number: int) -> str:
    return f"batch-{number}"


def _plan_name(state: str) -> str:
    return state.rstrip("/").rpartition("/")[2]


def outcomes_of(spark: SparkSession, state: str) -> DataFrame:
    """Outcomes of all batches so far, with ``batch``."""
    if not exists(spark, f"{state}/outcomes"):
        return spark.createDataFrame([], OUTCOME_SCHEMA).withColumn("batch", F.lit(None).cast("bigint"))
    found = spark.read.schema(OUTCOME_SCHEMA + ", run string").parquet(f"{state}/outcomes")
    return found.withColumn("batch", F.substring_index("run", "-", -1).cast("bigint")).drop("run")


def batch_counts(outcomes: DataFrame) -> DataFrame:
    """batch, n_files, n_uploaded, n_skipped, n_errors, n_bytes."""
    status = F.col("status")
    return outcomes.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(status == UPLOADED).alias("n_uploaded"),
        F.count_if(status == SKIPPED).alias("n_skipped"),
        F.count_if(status == ERROR).alias("n_errors"),
        F.sum("bytes").alias("n_bytes"),
    )
