"""Folders, plans, skip rules and outcome counts."""

import random

import pytest
from pyspark.sql import functions as F

from wharfline.operators import folders as FO
from wharfline.operators import sync as S
from wharfline.operators.numbering import number_rows
from wharfline.sources import inventory, listing
from wharfline.sources.inventory import scan_inventory, walk_inventory
from wharfline.sources.matches import output_path
from workload.queries import many_sources


def inv(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, size long")


def test_folder_tree(spark):
    keys = ["a/b/c.csv", "a/b/", "a-x/y", "plain", "a//z", "/top", "é/ü/f", ""]
    want = {"a", "a/b", "a-x", "a/", "", "é", "é/ü"}
    rows = FO.folder_tree(inv(spark, keys)).collect()
    assert [r["path"] for r in rows] == sorted(want)
    assert {r["path"]: r["label"] for r in rows}["a/b"] == "    |-- b"


SOURCES = ["s3://b/p/x", "s3://b/p", "b//q/"]


def test_sources_are_a_bag(spark):
    got = FO.union_sources(inv(spark, ["p/x/1", "p/2", "q/3", "px/4", "p"]), SOURCES)
    assert sorted((r["source_no"], r["key"]) for r in got.collect()) == [
        (1, "p/x/1"), (2, "p/2"), (2, "p/x/1"), (3, "q/3")]


def test_sources_must_share_a_bucket(spark):
    for bad in (["s3://a/x", "s3://b/y"], ["s3:///x"], ["s3://a/x", ""]):
        with pytest.raises(FO.PlanError):
            FO.source_table(FO.numbered_sources(spark, bad))


@pytest.mark.parametrize("bound", [None, 0])
def test_thousands_of_sources_make_no_larger_plan(spark, bound):
    rng = random.Random(4)
    names = ["a", "ab", "b", "", "x.y", "é"]
    keys = ["/".join(rng.choice(names) for _ in range(rng.randrange(1, 6))) for _ in range(400)]
    uris = ["s3://b/" + "/".join(rng.choice(names) for _ in range(rng.randrange(4))) + rng.choice(["", "/", "//"]) for _ in range(2000)]
    few = FO.union_sources(inv(spark, keys), uris[:2], bound)
    many = FO.union_sources(inv(spark, keys), uris, bound)
    expected = []
    for no, uri in enumerate(uris, 1):
        bare = uri.removeprefix("s3://b/").lstrip("/").rstrip("/")
        expected += [(no, k) for k in keys if k.startswith(bare + "/" if bare else "")]
    assert sorted((r["source_no"], r["key"]) for r in many.collect()) == sorted(expected) != []

    def size(df):
        return len(df._jdf.queryExecution().optimizedPlan().toString())

    assert abs(size(many) - size(few)) < 200


def test_many_sources_gathers_files_by_folder(spark, tmp_path):
    orders = [(k, k % 7 if k % 11 else None, "FO"[k % 2], float(k)) for k in range(300)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k,) for k in [0, 1, 2, 3, 4, 9]], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    found = many_sources(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan, "a task counts the sources of its folders only"
    expected = {}
    for k in [0, 1, 2, 3, 4]:
        for no, kinds in [(2 * k, "FO"), *([(2 * k + 1, "F")] if k % 3 == 0 else [])]:
            prices = [int(p) for _, c, status, p in orders if c == k and status in kinds]
            expected[no] = (len(prices), sum(prices))
    assert {r["source_no"]: (r["n_files"], r["n_bytes"]) for r in found.collect()} == expected


def test_no_sources(spark):
    assert FO.union_sources(inv(spark, ["a/b"]), FO.numbered_sources(spark, ["s3://b/"]).limit(0)).count() == 0


def test_rollup_and_cap(spark):
    keys = [f"p/f{i:03}/n" for i in range(250)] + ["p/file", "p/f001/m", "q/g/h/z"]
    sourced = FO.union_sources(inv(spark, keys), ["s3://b/p", "s3://b/q"])
    assert {tuple(r) for r in FO.folder_rollup(sourced).collect()} == {("s3://b/p", 252, 250), ("s3://b/q", 1, 1)}
    rows = FO.folder_cap(sourced).orderBy("source", "rn").collect()
    assert [r["folder"] for r in rows[:200]] == [f"f{i:03}" for i in range(200)]
    assert {r["n_more"] for r in rows[:200]} == {50} and tuple(rows[200]) == ("s3://b/q", "g/h", 1, 0)
    assert FO.folder_list(sourced).count() == 251


def test_cap_filter_reaches_below_the_shuffle(spark):
    sourced = FO.union_sources(inv(spark, ["p/a/b"]), ["s3://b/p"])
    plan = FO.folder_cap(sourced)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 200, Partial" in plan


def test_duplicate_targets_fail_the_plan(spark):
    sourced = FO.union_sources(inv(spark, ["p/a/b", "p//a/b"]), ["s3://b/p"])
    plan = FO.rebase_plan(sourced, "", "out")
    assert [tuple(r) for r in FO.duplicate_targets(plan).collect()] == [("out/p/a/b", 2)]
    with pytest.raises(FO.PlanError):
        FO.check_targets(plan)
    # One key under two overlapping sources is no clash.
    overlap = FO.union_sources(inv(spark, ["p/x/1"]), ["s3://b/p", "s3://b/p/x"])
    FO.check_targets(FO.rebase_plan(overlap, "", "out"))


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_numbering(spark, rows):
    rng = random.Random(3)
    keys = [f"{rng.randrange(10**9):09}-{i}" for i in range(rows)]
    got = number_rows(inv(spark, keys).repartition(7), ["key"])
    assert [r["key"] for r in got.orderBy("task_no").collect()] == sorted(keys)
    assert sorted(r["task_no"] for r in got.collect()) == list(range(1, rows + 1))


def test_numbering_with_one_value_in_most_rows(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("source_no"), "id")
    got = number_rows(df, ["source_no", "id"]).orderBy("task_no").collect()
    assert [r["task_no"] for r in got] == list(range(1, 6001))
    assert [(r["source_no"], r["id"]) for r in got] == sorted((r["source_no"], r["id"]) for r in got)


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_twins(spark, bound):
    paths = ["x", "x.gz", "y", "z.gz", "x.gz.gz", "d/x", "d/x.gz", "w.gzip"]
    files = spark.createDataFrame([(p, 1) for p in paths], "path string, size long")
    kept = {p for p in paths if p.endswith(".gz") or p + ".gz" not in paths}
    assert {r["path"] for r in S.gz_twins(files, bound).collect()} == kept
    assert S.gz_twins(files, bound).columns == ["path", "size"]


def test_hidden(spark):
    files = spark.createDataFrame([("a",), (".a",), ("d/.a",), (".d/a",), ("d/_a",), ("d.x/a.b",)], "path string")
    assert {r["path"] for r in S.visible_files(files).collect()} == {"a", "d/_a", "d.x/a.b"}


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_sync_plan(spark, bound):
    files = spark.createDataFrame(
        [("same", 5), ("other", 5), ("new", 5), ("packed.gz", 5), ("fresh.gz", 5), ("w\\n", 0)], "path string, size long")
    there = spark.createDataFrame(
        [("p/same", 5), ("p/other", 6), ("p/packed", 99), ("p/fresh.gz", 5), ("p/w/n", 0)], "key string, size long")
    got = {r["path"]: (r["dst"], r["action"], r["compressed_source"]) for r in S.sync_plan(files, there, "p/", bound).collect()}
    assert got == {
        "same": ("p/same", "skipped", None), "other": ("p/other", "uploaded", None), "new": ("p/new", "uploaded", None),
        "packed.gz": ("p/packed", "skipped", "yes"), "fresh.gz": ("p/fresh", "uploaded", "yes"),
        "w\\n": ("p/w/n", "skipped", None)}


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_reconcile(spark, bound):
    want = spark.createDataFrame([("a", "A", 1), ("b", "B", 1), ("c", "C", 1), ("z", "Z", 0)], "src string, dst string, size long")
    there = spark.createDataFrame([("A", 1), ("B", 2), ("Z", 0), ("Q", 1)], "key string, size long")
    got = {r["src"]: r["check"] for r in S.reconcile_sizes(want, there, bound).collect()}
    assert got == {"a": "verified", "b": "mismatch", "c": "missing", "z": "verified"}


def test_ledger_rules(spark):
    ledger = spark.createDataFrame(
        [("a", "Decompressed", "True"), ("b", "Decompressed", "False"), ("c", "Other", "True")],
        "key string, tag_key string, tag_value string")
    files = spark.createDataFrame([(k,) for k in "abcd"], "key string")
    assert {r["key"] for r in S.ledger_pending(files, ledger).collect()} == set("bcd")


def test_summary_counts_unknown_as_uploaded(spark):
    out = spark.createDataFrame([("uploaded",), ("skipped",), ("error",), ("odd",)], "status string")
    assert tuple(S.outcome_summary(out).first()) == (4, 2, 1, 1)
    assert tuple(S.outcome_summary(out.limit(0)).first()) == (0, 0, 0, 0)


def test_volume_and_rate(spark):
    out = spark.createDataFrame([("a", 0), ("b", 0)], "source string, bytes long")
    assert {tuple(r) for r in S.copy_volume(out, "source").collect()} == {("a", 1, 0, 100.0), ("b", 1, 0, 100.0)}
    timed = spark.createDataFrame([(3 << 20, 0, 2_000_000), (1 << 20, 1_000_000, 4_000_000)], "bytes long, s long, e long")
    timed = timed.select("bytes", F.timestamp_micros("s").alias("started"), F.timestamp_micros("e").alias("ended"))
    assert tuple(S.copy_rate(timed).first()) == (4 << 20, 4.0, 1.0, "4,194,304")
    assert S.copy_rate(timed.withColumn("ended", F.col("started")).limit(1)).first()["mb_per_s"] is None


def test_output_path():
    assert output_path("b/k/data.csv") == "b/k/matches_output.csv"
    assert output_path("data.csv") == "matches_output.csv"


@pytest.fixture
def tree(tmp_path):
    for name, body in {
        "a.csv": b"12345", "_u.txt": b"1", ".h.txt": b"1", ".d/z.txt": b"1", "x": b"1", "x.gz": b"22",
        "a.gz.d/x.gz": b"333", "deep/e/f/g/h.txt": b"", "deep/.e/h.txt": b"1", "sp ace/ü %41.txt": b"4444",
    }.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    (tmp_path / "in" / "link").symlink_to(tmp_path / "in" / "deep", target_is_directory=True)
    (tmp_path / "in" / "gone").symlink_to(tmp_path / "nowhere")
    return str(tmp_path / "in")


def test_walk(spark, tree):
    rows = walk_inventory(spark, tree).collect()
    assert {r["path"]: r["size"] for r in rows if r["error"] is None} == {
        "a.csv": 5, "_u.txt": 1, "x": 1, "x.gz": 2, "a.gz.d/x.gz": 3, "deep/e/f/g/h.txt": 0, "sp ace/ü %41.txt": 4}
    assert {r["path"] for r in rows if r["error"]} == {"link", "gone"}
    hidden = {r["path"] for r in walk_inventory(spark, f"file://{tree}", hidden=True).collect() if not r["error"]}
    assert {".h.txt", ".d/z.txt", "deep/.e/h.txt"} <= hidden


def test_walk_by_uri(spark, tree, monkeypatch):
    """The listing used for other schemes, tried on a shared folder."""
    monkeypatch.setattr(listing, "posix_path", lambda uri: None)
    rows = walk_inventory(spark, f"file://{tree}/deep").collect()
    assert [(r["uri"], r["path"], r["size"]) for r in rows] == [(f"file://{tree}/deep/e/f/g/h.txt", "e/f/g/h.txt", 0)]


def test_walk_of_a_missing_folder_says_so(spark, tmp_path):
    rows = walk_inventory(spark, str(tmp_path / "no")).collect()
    assert len(rows) == 1 and "FileNotFoundError" in rows[0]["error"]


def test_scan(spark, tree):
    found = scan_inventory(spark, tree).collect()
    # As in the walk: empty files count, links to folders are not followed.
    assert {r["path"]: r["size"] for r in found if r["error"] is None} == {
        "a.csv": 5, "_u.txt": 1, "x": 1, "x.gz": 2, "a.gz.d/x.gz": 3, "deep/e/f/g/h.txt": 0, "sp ace/ü %41.txt": 4}
    assert {r["path"] for r in found if r["error"]} == {"link", "gone"}
    assert {r["path"] for r in scan_inventory(spark, tree, glob="*.gz").collect()} == {"x.gz", "a.gz.d/x.gz"}


def test_scan_pushes_its_filters(spark, tree):
    plan = scan_inventory(spark, tree).filter(F.startswith("path", F.lit("deep/")) & (F.col("size") < 9))._jdf.queryExecution()
    assert "startswith(path" not in plan.optimizedPlan().toString().lower()


def test_relative_root_and_bucket(spark, tmp_path, monkeypatch):
    (tmp_path / "c" / "x").mkdir(parents=True)
    (tmp_path / "c" / "x" / "y.txt").write_text("1")
    monkeypatch.chdir(tmp_path)
    assert [r["path"] for r in scan_inventory(spark, str(tmp_path / "c")).collect()] == ["x/y.txt"]
    assert [r["path"] for r in walk_inventory(spark, "c").collect()] == ["x/y.txt"]
    inv = spark.createDataFrame([("b1", "p/1", 1), ("b2", "p/2", 2)], "bucket string, key string, size long")
    assert [r["key"] for r in FO.union_sources(inv, ["s3://b1/p"]).collect()] == ["p/1"]


def a_tree(tmp_path):
    for i in range(6):
        for j in range(4):
            folder = tmp_path / f"d{i}" / f"e{j}"
            folder.mkdir(parents=True)
            (folder / "a.csv").write_text("x" * (10 * i + j))
            (folder / "b.csv.gz").write_text("yy")
    (tmp_path / "empty").write_text("")
    (tmp_path / "_kept").write_text("1")
    (tmp_path / ".hidden").write_text("1")
    (tmp_path / "d0" / ".secret").mkdir()
    (tmp_path / "d0" / ".secret" / "f").write_text("1")
    return str(tmp_path)


def test_scan_agrees_with_the_walk(spark, tmp_path):
    root = a_tree(tmp_path)
    (tmp_path / "dangling").symlink_to(tmp_path / "nowhere")

    def rows(df):
        return sorted((r["path"], r["uri"], r["size"], r["mtime"], r["error"]) for r in df.collect())

    for hidden in (False, True):
        assert rows(inventory.scan_inventory(spark, root, hidden=hidden)) == rows(inventory.walk_inventory(spark, root, hidden)) != []
    assert inventory.scan_inventory(spark, root, "*.gz").count() == 24 and inventory.scan_inventory(spark, root, "[ab].csv").count() == 24
    assert inventory.scan_inventory(spark, "file://" + root).count() == inventory.scan_inventory(spark, root).count()


def test_filters_reach_the_listing(spark, tmp_path, monkeypatch):
    from pyspark.sql.datasource import GreaterThan, IsNotNull, LessThanOrEqual, StringEndsWith, StringStartsWith

    root = a_tree(tmp_path)
    scanned = inventory.scan_inventory(spark, root)
    some = scanned.filter(F.startswith("path", F.lit("d3/e1/")) & (F.col("size") > 5) & F.contains("path", F.lit("csv")))
    assert [r["path"] for r in some.collect()] == ["d3/e1/a.csv"]
    assert scanned.filter("size <= 31 and size >= 30 and path like '%.csv'").count() == 2
    assert scanned.filter("path like 'd1%' and path like 'd2%'").count() == 0
    seen = []
    plain = listing._list_posix
    monkeypatch.setattr(listing, "_list_posix", lambda folder: seen.append(folder) or plain(folder))

    def listed(*filters):
        seen.clear()
        reader = listing.FolderReader({"root": root, "tasks": "3"})
        left = list(reader.pushFilters(list(filters)))
        found = [p for part in reader.partitions() for b in reader.read(part) for p in b.column("path").to_pylist()]
        return left, sorted(found), set(seen)

    everything = listed()
    assert len(everything[2]) == 31 and len(everything[1]) == 50
    left, found, folders = listed(StringStartsWith(("path",), "d2/"), IsNotNull(("path",)), StringEndsWith(("path",), ".gz"))
    assert left == [IsNotNull(("path",))] and found == [f"d2/e{j}/b.csv.gz" for j in range(4)]
    assert folders == {root, f"{root}/d2", *(f"{root}/d2/e{j}" for j in range(4))}
    _, found, folders = listed(StringStartsWith(("path",), "d5/e3"), GreaterThan(("size",), 2), LessThanOrEqual(("size",), 53))
    assert found == ["d5/e3/a.csv"] and len(folders) == 3


def test_a_missing_root_is_an_error_row(spark, tmp_path):
    row, = inventory.scan_inventory(spark, str(tmp_path / "none")).collect()
    assert row["error"].startswith("FileNotFoundError") and row["size"] is None
