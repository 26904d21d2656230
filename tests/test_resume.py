"""Resumable transfers, one ordered file, and gzip files read in ranges."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from wharfline.plans.match_run import run_match
from wharfline.plans.resumable_run import batch_counts, extend_plan, outcomes_of, run_stored, store_plan
from wharfline.plans.unpack_run import resume_unpack
from wharfline.sources import gzip_ranges as GZ
from wharfline.sources.gzip_ranges import GzipError, index_gzip, lines_of_range, read_ranges
from wharfline.sources.inventory import walk_inventory
from wharfline.sources.ledger import read_ledger
from wharfline.sources.matches import write_one_file, write_one_gzip
from workload.queries import gz_ranges


class Stop(Exception):
    pass


def stop_after(n):
    def on_batch(number):
        if number >= n:
            raise Stop(f"after batch {number}")
    return on_batch


def files_in(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith("."))


def gz_files(folder, n):
    folder.mkdir()
    for i in range(n):
        (folder / f"f{i:02}.gz").write_bytes(gzip.compress(f"text {i}\n".encode() * (i + 1)))
    return folder


def test_a_stopped_run_goes_on_with_the_rest(spark, tmp_path):
    src = gz_files(tmp_path / "in", 10)
    (src / "f03.gz").write_bytes(b"no gzip")
    files = walk_inventory(spark, str(src))
    state, ledger = str(tmp_path / "state"), str(tmp_path / "ledger")

    def run(**kw):
        return resume_unpack(files, ledger, state, step_files=2, **kw)

    with pytest.raises(Exception, match="after batch 1"):
        run(on_batch=stop_after(1))
    made = [n for n in files_in(src) if not n.endswith(".gz")]
    assert len(made) in (3, 4) and read_ledger(spark, ledger).count() == len(made)
    stamps = {n: os.stat(src / n).st_mtime_ns for n in made}
    for r in {b["batch"]: b for b in batch_counts(outcomes_of(spark, state)).collect()}.values():
        assert r["n_files"] == 2
    got = run()
    assert {n: os.stat(src / n).st_mtime_ns for n in made} == stamps, "finished files are not touched again"
    counts = {r["batch"]: (r["n_files"], r["n_uploaded"] + r["n_errors"]) for r in batch_counts(got).collect()}
    assert counts == {n: (2, 2) for n in range(5)}
    assert got.filter("status = 'error'").count() == 1 and read_ledger(spark, ledger).count() == 9
    for i in range(10):
        if i != 3:
            assert (src / f"f{i:02}").read_text() == f"text {i}\n" * (i + 1)
    # nothing is left; another state takes up what failed
    assert run().count() == 10
    (src / "f03.gz").write_bytes(gzip.compress(b"mended"))
    again = resume_unpack(files, ledger, str(tmp_path / "state2"))
    assert [r["status"] for r in again.collect()] == ["uploaded"] and (src / "f03").read_text() == "mended"
    assert read_ledger(spark, ledger).count() == 10


def test_a_batch_cut_off_before_its_outcomes_is_done_again(spark, tmp_path):
    src = gz_files(tmp_path / "in", 3)
    plan = walk_inventory(spark, str(src)).select(F.col("uri").alias("src"), F.concat(F.lit(f"{tmp_path}/out/"), "path").alias("dst"), "size")
    state = str(tmp_path / "state")
    store_plan(plan, state, 2)
    with pytest.raises(Exception, match="after batch 0"):
        run_stored(spark, state, "copy", on_batch=stop_after(0))
    os.remove(f"{state}/outcomes/run=batch-0/_SUCCESS")
    got = run_stored(spark, state, "copy")
    assert got.count() == 3 and got.filter("status = 'uploaded'").count() == 3
    assert files_in(tmp_path / "out") == ["f00.gz", "f01.gz", "f02.gz"]
    (src / "later.gz").write_bytes(b"x")
    later = spark.createDataFrame([(f"{src}/later.gz", f"{tmp_path}/out/later.gz", 1)], "src string, dst string, size long")
    extend_plan(later, state)
    store_plan(later, state)   # a complete plan stays
    got = run_stored(spark, state, "copy", steps_per_batch=5)
    assert got.count() == 4 and {r["batch"] for r in got.collect()} == {0, 1, 2}
    assert sum(not n.startswith(".") and n.endswith(".part") for n in os.listdir(tmp_path / "out")) == 0


def test_the_first_failure_stops_the_run(spark, tmp_path):
    src = gz_files(tmp_path / "in", 12)
    (src / "f04.gz").write_bytes(b"no gzip")
    files = walk_inventory(spark, str(src))
    state = str(tmp_path / "state")
    for _ in range(2):   # started again, it stops at the same batch as long as that has the failure
        with pytest.raises(Exception, match="stopped after batch .*f04.gz"):
            resume_unpack(files, str(tmp_path / "ledger"), state, step_files=1, stop_on_error=True)
    got = {os.path.basename(r["src"]): r["status"] for r in outcomes_of(spark, state).collect()}
    assert got["f04.gz"] == "error" and set(got.values()) - {"error"} <= {"uploaded"}
    made = [n for n in files_in(src) if not n.endswith(".gz")]
    assert len(made) == len(got) - 1 < 11, "files of later batches are not touched"


def test_an_empty_plan(spark, tmp_path):
    nothing = spark.createDataFrame([], "src string, dst string, size long")
    store_plan(nothing, str(tmp_path / "s"))
    assert run_stored(spark, str(tmp_path / "s"), "sync").count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_one_file_in_order(spark, conf, tmp_path, n):
    conf("spark.sql.shuffle.partitions", "7")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(n)
    lines = ["".join(rng.choice("aé,x ") for _ in range(rng.randrange(9))) for _ in range(n)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "pos long, value string").repartition(5, F.rand(3))
    out = tmp_path / "deep" / "one.csv"
    for _ in range(2):
        assert write_one_file(df, str(out)) == len("\n".join(lines).encode())
        assert out.read_bytes() == "\n".join(lines).encode()
    assert files_in(out.parent) == ["one.csv"] and len(os.listdir(out.parent)) == 1


def test_one_file_needs_a_shared_folder(spark):
    with pytest.raises(ValueError, match="ranges"):
        write_one_file(spark.createDataFrame([(1, "a")], "pos long, value string"), "s3://a/b")


def test_match_into_one_file(spark, tmp_path):
    (tmp_path / "d").write_bytes(b"a,1\nb,2\n\xff\na,3\n\nb\n")
    (tmp_path / "k").write_text("a\nb\n")
    run = run_match(spark, str(tmp_path / "d"), str(tmp_path / "k"), single=True)
    assert (tmp_path / "matches_output.csv").read_bytes() == b"a,1\nb,2\na,3\nb" and run.n_matches == 4


def test_one_gzip_file_by_many_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "6")
    lines = spark.range(5000).select(F.col("id").alias("pos"), F.when(F.col("id") % 50 > 0, F.concat(F.lit("é"), F.col("id") * 7)).alias("value"))
    size = write_one_gzip(lines.orderBy(F.desc("pos")), str(tmp_path / "in" / "x.gz"))
    packed = (tmp_path / "in" / "x.gz").read_bytes()
    text = "".join((f"é{i * 7}" if i % 50 else "") + "\n" for i in range(5000)).encode()
    assert gzip.decompress(packed) == text and size == len(packed)
    index = index_gzip(spark.createDataFrame([(str(tmp_path / "in" / "x.gz"),)], "uri string"), span=1)
    assert index.filter(F.col("bits") == -1).count() == 6, "a member for each partition"
    assert write_one_gzip(lines.limit(0), str(tmp_path / "none.gz")) == 0 and gzip.decompress((tmp_path / "none.gz").read_bytes()) == b""


def test_gz_ranges_sorts_in_many_tasks(spark, tmp_path, conf, monkeypatch):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "6")
    spark.range(3000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
                             F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(str(tmp_path / "orders.parquet"))
    seen, index = [], GZ.index_gzip
    monkeypatch.setattr(GZ, "index_gzip", lambda files, *a, **k: seen.append(index(files, None, 1)) or index(files, *a, **k))
    got = gz_ranges(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r["line_no"], r["value"]) for r in got] == [(i + 1, f"{i % 9},{i},F,1-URGENT") for i in range(3000)]
    assert seen[0].select("uri").distinct().count() == 1
    assert seen[0].filter(F.col("bits") == -1).count() == 6, "one file, a member for each sorted partition"


def some_text(n, seed):
    rng = random.Random(seed)
    ends = [b"\n"] * 8 + [b"\r\n", b"\r", b"\n\n"]
    words = [bytes(rng.randrange(256) for _ in range(6)).replace(b"\n", b"n").replace(b"\r", b"r") for _ in range(400)]
    return b"".join(b" ".join(rng.choice(words) for _ in range(rng.randrange(40))) + rng.choice(ends) for _ in range(n)) + b"no end"


@pytest.mark.parametrize("members", [1, 2, 300])
@pytest.mark.parametrize("level", [0, 1, 9])
def test_gzip_in_ranges(spark, tmp_path, members, level):
    text = b"\xef\xbb\xbf" + some_text(6000, members)
    size = -(-len(text) // members)
    path = tmp_path / "x.gz"
    path.write_bytes(b"".join(gzip.compress(text[i:i + size], level) for i in range(0, len(text), size)))
    files = spark.createDataFrame([(str(path),)], "uri string")
    index = index_gzip(files, span=40_000)
    places = index.orderBy("point").collect()
    assert len(places) > 4 and places[-1]["out_end"] == len(text)
    assert all(a["out_end"] == b["out_at"] for a, b in zip(places, places[1:]))
    lines = read_ranges(index)
    got = [bytes(r["v"]) for r in lines.orderBy("pos").select(F.col("value").cast("binary").alias("v")).collect()]
    assert got == text[3:].splitlines()
    used = lines.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 4, "more than four tasks read the file"


def test_damaged_and_empty_gzip(spark, tmp_path):
    whole = gzip.compress(some_text(2000, 1))
    (tmp_path / "cut.gz").write_bytes(whole[:len(whole) // 2])
    (tmp_path / "bad.gz").write_bytes(b"not gzip at all")
    (tmp_path / "void.gz").write_bytes(b"")
    (tmp_path / "none.gz").write_bytes(gzip.compress(b""))
    (tmp_path / "good.gz").write_bytes(gzip.compress(b"a\nb"))
    names = ["cut", "bad", "void", "none", "good", "missing"]
    index = index_gzip(spark.createDataFrame([(f"{tmp_path}/{n}.gz",) for n in names], "uri string"), span=10_000)
    errors = {os.path.basename(r["uri"]) for r in index.filter("error is not null").collect()}
    assert errors == {"cut.gz", "bad.gz", "missing.gz"}
    with pytest.raises(Exception, match=GzipError.__name__):
        read_ranges(index).count()
    sound = index.join(index.filter("error is not null").select("uri"), "uri", "left_anti")
    assert sorted(r["value"] for r in read_ranges(sound.select(*index.columns)).collect()) == ["a", "b"]


def test_every_cut_keeps_the_lines():
    text = b"a\r\nbb\n\nccc\r\rd\n" + b"long" * 9 + b"\r\nlast"
    whole = text.splitlines()
    for step in range(1, len(text) + 1):
        for chunk in (1, 3, 100):
            got = []
            for start in range(0, len(text), step):
                chunks = (text[i:i + chunk] for i in range(start, len(text), chunk))
                got += lines_of_range(chunks, start, min(start + step, len(text)), text[start - 1:start] if start else b"")
            assert [line for _, line in got] == whole, step
            assert all(text[at:at + len(line)] == line for at, line in got)
