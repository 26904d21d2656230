"""Unpack every compressed file of an inventory once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.functions import paths as P
from wharfline.operators.folders import check_targets
from wharfline.operators.lookup import lookup_join
from wharfline.operators.sync import SKIPPED, done_keys, ledger_pending
from wharfline.operators.transfer import unpack_job
from wharfline.plans.resumable_run import STEP_FILES, run_stored, store_plan
from wharfline.sources.ledger import mark_done, read_ledger
from wharfline.workdir import ensure_checkpoint_dir


def unpack_targets(files: DataFrame, everywhere: bool = False) -> DataFrame:
    """src, dst, key, size for the ``.gz`` rows of an inventory with ``uri, size``.

    ``everywhere`` removes each ``.gz`` in the name, not only the last.
    """
    dst = P.drop_gz_everywhere("uri") if everywhere else P.drop_gz_suffix("uri")
    return files.filter(P.is_gz("uri")).select(
        F.col("uri").alias("src"), dst.alias("dst"), F.col("uri").alias("key"), "size"
    )


def resume_unpack(
    files: DataFrame,
    ledger: str,
    state: str,
    everywhere: bool = False,
    step_files: int = STEP_FILES,
    steps_per_batch: int = 1,
    tasks: int | None = None,
    **options,
) -> DataFrame:
    """Unpack in batches, each marked in the ledger as soon as it is done.

    The first call stores what the ledger leaves to do as the plan below
    ``state``; a call after a stop goes on with that plan. Returns the outcomes
    of all batches; ``options`` go to ``run_stored``.
    """
    spark = files.sparkSession
    targets = unpack_targets(files, everywhere)
    check_targets(targets)
    store_plan(ledger_pending(targets, read_ledger(spark, ledger)), state, step_files)
    return run_stored(spark, state, "unpack", ledger, steps_per_batch, tasks, **options)


def run_unpack(
    files: DataFrame,
    ledger: str,
    out: str | None = None,
    everywhere: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Unpack what the ledger does not mark as done, then mark it.

    Two files for one target raise. Returns one row per compressed file: src, dst, status, bytes, error. Run
    it again after a crash or for new files; done files are skipped.
    """
    targets = unpack_targets(files, everywhere)
    check_targets(targets)
    done = done_keys(read_ledger(files.sparkSession, ledger)).withColumn("done", F.lit(1))
    # Stored, so that the split does not move when the ledger grows.
    ensure_checkpoint_dir(files.sparkSession)
    split = lookup_join(targets, done, "key", "left").checkpoint()
    outcomes = unpack_job(split.filter(F.col("done").isNull()), out, tasks)
    mark_done(outcomes, ledger)
    return outcomes.select("src", "dst", "status", "bytes", "error").unionByName(
        split.filter(F.col("done") == 1).select(
            "src",
            "dst",
            F.lit(SKIPPED).alias("status"),
            F.lit(0).cast("bigint").alias("bytes"),
            F.lit(None).cast("string").alias("error"),
        )
    )
