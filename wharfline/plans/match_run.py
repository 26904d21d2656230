"""Match a data file against a key file, end to end."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.text import is_blank, is_decodable
from wharfline.operators.diagnose import key_variants, sample_keys, sample_members
from wharfline.operators.match import match_lines
from wharfline.sources.head import head_sample_keys, head_sample_lines
from wharfline.sources.lines import data_lines, first_rejects, key_lines, read_lines
from wharfline.sources.matches import output_path, refuse_output_in_input, write_matches
from wharfline.workdir import new_dir

# Fixed value: sample keys tried in other spellings when nothing matched.
DIAGNOSED_KEYS = 5


class EmptyKeyList(ValueError):
    """The key file held no usable line."""


@dataclass
class MatchRun:
    """Counters of a run, where its result is, and what to look at next.

    ``samples()`` reads the beginning of the data file when asked for, ``rejects``
    all of it.
    """

    status: str
    n_processed: int
    n_matches: int
    n_errors: int
    seconds: float
    output: str | None
    matches: DataFrame
    samples: Callable[[], DataFrame]
    rejects: DataFrame
    diagnosis: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def rows_per_second(self) -> float:
        return self.n_processed / self.seconds if self.seconds > 0 else 0.0


def store_keys(spark: SparkSession, key_path: str) -> DataFrame:
    table = new_dir(spark, "keys")
    key_lines(read_lines(spark, key_path)).write.parquet(table)
    return spark.read.schema("k string").parquet(table)


def run_match(
    spark: SparkSession,
    data_path: str,
    key_path: str,
    out: str | None = None,
    max_broadcast_bytes: int | None = None,
    single: bool = False,
) -> MatchRun:
    """Read both files, keep the matching lines and write them in input order.

    The data file is read once: counters are observed while the matches go to
    an intermediate table, which is then sorted. Nothing is written to the
    result's place when nothing matched; ``status`` is then 'no rows' or
    'no matches', and for the latter ``diagnosis`` says why. A place that the
    input takes in is refused, or the next run would read the result as data.
    The result is a folder of parts in order; with ``single`` one file.
    """
    target = out or output_path(data_path)
    refuse_output_in_input(data_path, target)
    # stored once: it is looked at for emptiness, measured and joined
    keys = store_keys(spark, key_path)
    if keys.isEmpty():
        raise EmptyKeyList(f"no keys in {key_path}")
    started = time.monotonic()
    lines = read_lines(spark, data_path, positions=True)
    seen, hit = Observation("lines"), Observation("matches")
    observed = lines.observe(
        seen,
        F.count_if(is_decodable("value") & ~is_blank("value")).alias("n_processed"),
        F.count_if(~is_decodable("value")).alias("n_errors"),
    )
    found = match_lines(data_lines(observed), keys, max_broadcast_bytes)
    table = new_dir(spark, "matches")
    found.observe(hit, F.count(F.lit(1)).alias("n_matches")).write.parquet(table)
    matches = spark.read.parquet(table)
    n_matches = hit.get["n_matches"]
    output = None
    if n_matches:
        output = target
        write_matches(matches, output, single=single)
    probe = data_lines(lines)
    n_processed = seen.get["n_processed"]
    status = "no rows" if n_processed == 0 else "matched" if n_matches else "no matches"
    run = MatchRun(
        status=status,
        n_processed=n_processed,
        n_matches=n_matches,
        n_errors=seen.get["n_errors"],
        seconds=time.monotonic() - started,
        output=output,
        matches=matches,
        samples=lambda: head_sample_lines(spark, data_path, keys),
        rejects=first_rejects(lines),
    )
    if status == "no matches":
        tried = head_sample_keys(spark, data_path, keys, DIAGNOSED_KEYS)
        if tried is None:
            tried = sample_keys(probe, keys, DIAGNOSED_KEYS)
        run.diagnosis = {
            "keys": tried,
            "variants": key_variants(tried, keys, max_broadcast_bytes),
            "members": sample_members(keys),
        }
    return run
