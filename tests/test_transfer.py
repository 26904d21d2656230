"""Copy, unpack and sync jobs on temporary files."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from wharfline.operators import transfer as T
from wharfline.operators.folders import PlanError
from wharfline.operators.sync import outcome_summary
from wharfline.plans.copy_run import plan_copy, run_copy, verify_copy
from wharfline.plans.unpack_run import run_unpack
from wharfline.plans.upload_run import plan_upload, run_upload
from wharfline.sources import files as IO
from wharfline.sources.inventory import scan_inventory, walk_inventory
from wharfline.sources.ledger import append_log, read_ledger


def body(seed, n):
    return random.Random(seed).randbytes(n)


def write(root, name, data):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return str(path)


def visible(root):
    return {
        os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), "rb").read()
        for d, _, names in os.walk(root) for f in names
    }


def rows_by_name(df):
    return {os.path.basename(r["src"]): r for r in df.collect()}


@pytest.fixture
def plan_of(spark, tmp_path):
    def make(files, missing=()):
        rows = [(write(tmp_path / "in", n, b), str(tmp_path / "out" / n), len(b)) for n, b in files.items()]
        rows += [(str(tmp_path / "in" / n), str(tmp_path / "out" / n), 3) for n in missing]
        return spark.createDataFrame(rows, "src string, dst string, size long")

    return make


FILES = {"one": b"x", "empty": b"", "exact": body(1, 3000), "odd/deep/more": body(2, 10_001), "ü sp": body(3, 999)}


@pytest.mark.parametrize("part", [1000, 1 << 20])
def test_copy(tmp_path, plan_of, part):
    plan = plan_of(FILES, missing=["gone"])
    write(tmp_path / "out", "one", b"older and longer")
    got = rows_by_name(T.copy_job(plan, part_bytes=part))
    assert visible(tmp_path / "out") == FILES
    assert {n: (r["status"], r["bytes"]) for n, r in got.items() if n != "gone"} == {
        os.path.basename(n): ("uploaded", len(b)) for n, b in FILES.items()}
    assert got["gone"]["status"] == "error" and "FileNotFoundError" in got["gone"]["error"]
    assert all(r["started"] <= r["ended"] for r in got.values())


def test_one_file_is_copied_by_many_tasks(plan_of):
    parts = T._part_rows(plan_of({"big": body(4, 10_500)}), 1000).orderBy("offset").collect()
    assert [(r["offset"], r["length"]) for r in parts] == [(i * 1000, 1000) for i in range(10)] + [(10_000, 500)]


def test_copy_detects_a_source_of_another_size(spark, tmp_path):
    src = write(tmp_path / "in", "f", b"12345")
    for planned in (4, 6):
        dst = str(tmp_path / "out" / f"f{planned}")
        plan = spark.createDataFrame([(src, dst, planned)], "src string, dst string, size long")
        row = T.copy_job(plan).first()
        assert row["status"] == "error" and not os.path.exists(dst)
    assert visible(tmp_path / "out") == {}


def test_names_as_long_as_names_can_be(tmp_path, plan_of):
    name = "n" * 255
    assert T.copy_job(plan_of({name: b"x"})).first()["status"] == "uploaded"
    assert visible(tmp_path / "out") == {name: b"x"}


def test_task_count_follows_the_plan(spark):
    plan = spark.createDataFrame([("a", 40 * T.TASK_BYTES), ("b", None)], "src string, size long")
    assert T._task_count(plan, None) == 40
    assert T._task_count(plan, 3) == 3
    assert T._task_count(plan.limit(0), None) == 2 * spark.sparkContext.defaultParallelism


def test_unknown_size_is_an_error_row(spark, tmp_path):
    src = write(tmp_path / "in", "f", b"12345")
    plan = spark.createDataFrame([(src, str(tmp_path / "out/f"), None)], "src string, dst string, size long")
    assert [r["status"] for r in T.copy_job(plan).collect()] == ["error"]
    assert visible(tmp_path / "out") == {}


def test_two_sources_of_one_target_never_mix(spark, tmp_path):
    bodies = [bytes([65 + i]) * 5000 for i in range(2)]
    rows = [(write(tmp_path / "in", f"f{i}", b), str(tmp_path / "out/f"), 5000) for i, b in enumerate(bodies)]
    T.copy_job(spark.createDataFrame(rows, "src string, dst string, size long"), part_bytes=100)
    assert visible(tmp_path / "out")["f"] in bodies


def test_copy_between_file_uris_and_streamed(spark, tmp_path, monkeypatch):
    plan = spark.createDataFrame(
        [(f"file://{write(tmp_path / 'in', 'a', b'abc')}", f"file://{tmp_path}/out/a", 3)], "src string, dst string, size long")
    assert T.copy_job(plan).first()["status"] == "uploaded"
    # The way for other schemes, tried on a shared folder.
    monkeypatch.setattr(T, "_on_shared_folder", lambda name: F.lit(False))
    other = plan.withColumn("dst", F.lit(f"file://{tmp_path}/out2/a"))
    assert T.copy_job(other).first()["status"] == "uploaded"
    wrong = other.withColumn("size", F.lit(4).cast("long"))
    assert "size mismatch" in T.copy_job(wrong).first()["error"]


def test_fail_policy_stores_outcomes_first(spark, tmp_path, plan_of):
    plan = plan_of({"a": b"1", "b": b"22"}, missing=["gone"])
    log = str(tmp_path / "outcomes")
    with pytest.raises(T.TransferError, match="1 files failed.*gone"):
        T.copy_job(plan, out=log, on_error="fail")
    assert tuple(outcome_summary(spark.read.parquet(log)).first()) == (3, 2, 0, 1)
    assert visible(tmp_path / "out") == {"a": b"1", "b": b"22"}
    with pytest.raises(ValueError):
        T.copy_job(plan, on_error="ignore")


def test_runs_share_an_outcome_table(spark, tmp_path, plan_of):
    log = str(tmp_path / "outcomes")
    for n in ("a", "b"):
        assert T.copy_job(plan_of({n: b"1"}), out=log).count() == 1
    assert spark.read.parquet(log).count() == 2


def test_repeated_parts_and_commits_do_no_harm(tmp_path):
    data = body(5, 2500)
    src, dst = write(tmp_path, "src", data), str(tmp_path / "t" / "dst")
    staged = IO.staging_name(dst, "run")
    for offset in (2000, 0, 1000, 0, 2000):
        IO.copy_range(src, staged, offset, min(1000, 2500 - offset))
    assert not os.path.exists(dst)
    assert IO.commit_staged(staged, dst, 2500) == 2500
    assert IO.commit_staged(staged, dst, 2500) == 2500
    assert open(dst, "rb").read() == data


GZ = {
    "plain.gz": gzip.compress(b"hello\n"),
    "two.gz": gzip.compress(b"a\n") + gzip.compress(b"b\n"),
    "zero.gz": gzip.compress(b""),
    "nothing.gz": b"",
    "d.gz.x/deep.gz": gzip.compress(body(6, 50_000)),
    "cut.gz": gzip.compress(body(7, 5000))[:-200],
    "bad.gz": b"this is not gzip",
}
UNPACKED = {"plain": b"hello\n", "two": b"a\nb\n", "zero": b"", "nothing": b""}


def test_unpack_tasks_get_even_shares(spark):
    sizes = [1000, 990, 980, 970] + [10] * 36
    plan = spark.createDataFrame([(f"s{i:02}", f"d{i}", n) for i, n in enumerate(sizes)], "src string, dst string, size long")
    spread = T._by_size(plan, 4).groupBy(F.spark_partition_id().alias("p")).agg(F.sum("size").alias("n"), F.count("*").alias("c"))
    rows = spread.collect()
    assert len(rows) == 4 and sum(r["c"] for r in rows) == len(sizes)
    assert max(r["n"] for r in rows) - min(r["n"] for r in rows) <= 30


def test_unpack_records_bad_files_and_goes_on(spark, tmp_path):
    for n, b in GZ.items():
        write(tmp_path / "in", n, b)
    files = walk_inventory(spark, str(tmp_path / "in"))
    ledger = str(tmp_path / "ledger")
    first = rows_by_name(run_unpack(files, ledger))
    assert {n for n, r in first.items() if r["status"] == "error"} == {"cut.gz", "bad.gz"}
    assert first["two.gz"]["bytes"] == 4 and first["nothing.gz"]["bytes"] == 0
    found = visible(tmp_path / "in")
    assert {k: found[k] for k in UNPACKED} == UNPACKED
    assert found["d.gz.x/deep"] == body(6, 50_000)
    # No target and no staged rest of the two bad files.
    assert set(found) == set(GZ) | set(UNPACKED) | {"d.gz.x/deep"}
    assert read_ledger(spark, ledger).count() == 5
    again = rows_by_name(run_unpack(files, ledger))
    assert {n: r["status"] for n, r in again.items()} == {
        n: "error" if n in ("cut.gz", "bad.gz") else "skipped" for n in first}
    write(tmp_path / "in", "bad.gz", gzip.compress(b"mended"))
    third = rows_by_name(run_unpack(files, ledger))
    assert third["bad.gz"]["status"] == "uploaded" and third["bad.gz"]["bytes"] == 6


def test_unpack_with_every_suffix_removed(spark, tmp_path):
    write(tmp_path / "in", "a.gz.d/x.gz", gzip.compress(b"1"))
    files = walk_inventory(spark, str(tmp_path / "in"))
    run_unpack(files, str(tmp_path / "ledger"), everywhere=True)
    assert visible(tmp_path / "in")["a.d/x"] == b"1"


def test_upload(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    for n, b in {
        "new.csv": b"1", "same.csv": b"22", "grown.csv": b"333", "p.csv.gz": gzip.compress(b"pp"), "p.csv": b"old",
        "done.csv.gz": gzip.compress(b"dd"), ".hid": b"h", ".d/x": b"h", "bad.gz": b"no",
    }.items():
        write(root, n, b)
    for n, b in {"b/same.csv": b"xx", "b/grown.csv": b"x", "b/done.csv": b"other size"}.items():
        write(out, n, b)
    there = scan_inventory(spark, str(out)).select(F.col("path").alias("key"), "size")
    plan = plan_upload(spark, str(root), there, prefix="b/")
    got = rows_by_name(run_upload(plan, str(out)))
    assert {n: (r["status"], r["compressed_source"]) for n, r in got.items()} == {
        "new.csv": ("uploaded", None), "same.csv": ("skipped", None), "grown.csv": ("uploaded", None),
        "p.csv.gz": ("uploaded", "yes"), "done.csv.gz": ("skipped", "yes"), "bad.gz": ("error", "yes")}
    assert visible(out) == {
        "b/new.csv": b"1", "b/same.csv": b"xx", "b/grown.csv": b"333", "b/p.csv": b"pp", "b/done.csv": b"other size"}


def keyed(spark, root):
    return walk_inventory(spark, str(root)).select(F.col("path").alias("key"), "size")


def test_copy_run(spark, tmp_path):
    files = {"in/a/1": b"1", "in/b/c/2": b"22", "in/b/e": b"", "out/no": b"n"}
    for n, b in files.items():
        write(tmp_path / "in", n, b)
    plan = plan_copy(keyed(spark, tmp_path / "in"), ["s3://w/in/b", "s3://w/in"], "in/", "N/")
    assert [(r["task_no"], r["src"], r["dst"]) for r in plan.tasks.orderBy("task_no").collect()] == [
        (1, "in/b/c/2", "N/b/c/2"), (2, "in/b/e", "N/b/e"), (3, "in/a/1", "N/a/1"),
        (4, "in/b/c/2", "N/b/c/2"), (5, "in/b/e", "N/b/e")]
    log = str(tmp_path / "log")
    run_copy(plan, str(tmp_path / "in"), str(tmp_path / "out"), log=log)
    assert visible(tmp_path / "out") == {"N/a/1": b"1", "N/b/c/2": b"22", "N/b/e": b""}
    logged = [r["value"].partition("] ")[2] for r in spark.read.text(log).collect()]
    assert sum(line.startswith("uploaded ") for line in logged) == 3
    assert [line for line in logged if not line.startswith("uploaded ")] == [
        "  s3://w/in: 3 objects, 3 nested folder(s):", "    a", "    b", "    b/c", "  s3://w/in/b: 2 objects, 1 nested folder(s):", "    c",
        "  Total: 5 objects. Starting copy."]
    checks = verify_copy(spark, plan, keyed(spark, tmp_path / "out"))
    assert {r["check"] for r in checks.collect()} == {"verified"}
    write(tmp_path / "out", "N/a/1", b"cut short")
    checks = verify_copy(spark, plan, keyed(spark, tmp_path / "out"))
    assert [r["src"] for r in checks.filter("check = 'mismatch'").collect()] == ["in/a/1"]


def test_copy_run_refuses_empty_and_clashing_plans(spark):
    inventory = spark.createDataFrame([("p/a/b", 1), ("p//a/b", 1)], "key string, size long")
    with pytest.raises(PlanError, match="no objects"):
        plan_copy(inventory, ["s3://w/other"], "", "out")
    with pytest.raises(PlanError, match="one target"):
        plan_copy(inventory, ["s3://w/p"], "", "out")


def test_copy_run_fails_after_logging(spark, tmp_path):
    write(tmp_path / "in", "p/a", b"1")
    plan = plan_copy(keyed(spark, tmp_path / "in"), ["w/p"], "", "")
    plan.tasks = plan.tasks.union(plan.tasks.select("source_no", "source", F.lit("p/gone").alias("src"), F.lit("p/gone").alias("dst"), "size", F.lit(2).cast("long")))
    with pytest.raises(T.TransferError):
        run_copy(plan, str(tmp_path / "in"), str(tmp_path / "out"), log=str(tmp_path / "log"))
    logged = [r["value"] for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert sum("->" in line for line in logged) == 2 and sum("error" in line for line in logged) == 1
    assert sum("Total: 2 objects" in line for line in logged) == 1 and len(logged) == 4


def test_log_stamps_are_utc(spark, conf, tmp_path):
    conf("spark.sql.session.timeZone", "Asia/Tokyo")
    append_log(spark.range(1), F.lit("hello"), str(tmp_path / "log"))
    import datetime as dt

    stamp = spark.read.text(str(tmp_path / "log")).first()["value"]
    at = dt.datetime.strptime(stamp, "[%Y-%m-%d %H:%M:%S] hello").replace(tzinfo=dt.timezone.utc)
    assert abs((dt.datetime.now(dt.timezone.utc) - at).total_seconds()) < 120


def test_a_lost_staged_file_is_no_success(tmp_path):
    """An old target of the same size is not taken for the copy."""
    dst = tmp_path / "t"
    dst.write_bytes(b"old")
    staged = IO.staging_name(str(dst), "run-1")
    with pytest.raises(FileNotFoundError):
        IO.commit_staged(staged, str(dst), 3)
    IO.write_at(staged, 0, b"new")
    assert [IO.commit_staged(staged, str(dst), 3) for _ in range(2)] == [3, 3] and dst.read_bytes() == b"new"


def test_leftovers_of_a_run_are_swept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out" / "x").mkdir(parents=True)
    (tmp_path / "in" / "a").write_text("1")
    dst = str(tmp_path / "out" / "x" / "a")
    for run in ("mine", "other"):
        (tmp_path / "out" / "x" / os.path.basename(IO.staging_name(dst, f"{run}-77"))).write_text("half")
    plan = spark.createDataFrame([(str(tmp_path / "in" / "a"), dst, 1)], "src string, dst string, size long")
    T.copy_job(plan, run="mine")
    left = os.listdir(tmp_path / "out" / "x")
    assert "a" in left and len(left) == 2 and any(".other-77" in n for n in left)
