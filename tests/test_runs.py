"""The match run on files and its streaming form."""

import random
from types import SimpleNamespace

import pytest

from wharfline.plans.match_run import EmptyKeyList, run_match
from wharfline.plans.upload_run import plan_upload, run_upload
from wharfline.sources.head import head_lines, head_sample_keys, head_sample_lines
from wharfline.sources.lines import HiddenInput, key_lines, read_lines
from wharfline.sources.matches import OutputInInput
from wharfline.streaming.match import LostProgress, stream_counts, stream_match, stream_rates
from wharfline.streaming.progress import batch_rows, counted_match, totals
from wharfline.workdir import shared_root


def data_file(path, seed, n=400):
    rng = random.Random(seed)
    lines = []
    for i in range(n):
        key = rng.choice(["k", " k", "k ", ""]) + str(rng.randrange(40)) if rng.random() > 0.1 else rng.choice(["", "  "])
        lines.append((key + rng.choice(["", ",x", f",{i},z"])).encode())
    lines += [b"k1,\xff", b"\xff", b"", b"k1,dup", b"k1,dup"]
    rng.shuffle(lines)
    path.write_bytes(b"\n".join(lines))
    return lines


def brute(raw_lines, listed):
    hits = n = bad = 0
    out = []
    for raw in raw_lines:
        try:
            line = raw.decode()
        except UnicodeDecodeError:
            bad += 1
            continue
        if not line.strip():
            continue
        n += 1
        if line.split(",")[0].strip() in listed:
            hits += 1
            out.append(line)
    return n, hits, bad, out


@pytest.mark.parametrize("bound", [0, None])
@pytest.mark.parametrize("blank", [True, False])
def test_run(spark, conf, tmp_path, bound, blank):
    conf("spark.sql.files.maxPartitionBytes", "500")
    conf("spark.sql.files.openCostInBytes", "8")
    raw = data_file(tmp_path / "data.csv", 3)
    listed = {"k1", "k2", "7"} | ({""} if blank else set())
    (tmp_path / "keys.csv").write_text("k1\n k2 \nk1\n7" + ("\n\n" if blank else ""))
    run = run_match(spark, str(tmp_path / "data.csv"), str(tmp_path / "keys.csv"), max_broadcast_bytes=bound)
    n, hits, bad, out = brute(raw, listed)
    assert (run.status, run.n_processed, run.n_matches, run.n_errors) == ("matched", n, hits, bad)
    assert run.output == str(tmp_path / "matches_output.csv")
    parts = sorted((tmp_path / "matches_output.csv").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text().splitlines() == out
    assert run.rows_per_second == pytest.approx(n / run.seconds)
    assert run.samples().count() == 5 and run.rejects.count() == bad


def test_big_results_are_parts_in_order(spark, tmp_path):
    raw = data_file(tmp_path / "d", 4, 3000)
    (tmp_path / "k").write_text("\n".join(f"k{i}" for i in range(40)))
    out = tmp_path / "out"
    run_match(spark, str(tmp_path / "d"), str(tmp_path / "k"), out=str(out))
    text = "".join(p.read_text() for p in sorted(out.glob("part-*")))
    assert text.splitlines() == brute(raw, {f"k{i}" for i in range(40)})[3]


def test_no_matches_are_explained_and_nothing_is_written(spark, tmp_path):
    (tmp_path / "d").write_text("+55-1,a\n(2)2,b\n\n+551,c\n99,d\n")
    (tmp_path / "k").write_text("551\n22\n")
    (tmp_path / "matches_output.csv").write_text("earlier result")
    run = run_match(spark, str(tmp_path / "d"), str(tmp_path / "k"))
    assert (run.status, run.n_processed, run.n_matches, run.output) == ("no matches", 4, 0, None)
    assert (tmp_path / "matches_output.csv").read_text() == "earlier result"
    found = {r["k"]: (r["rule"], r["found_as"]) for r in run.diagnosis["variants"].collect()}
    assert found == {"+55-1": (None, None), "(2)2": (3, "22"), "+551": (4, "551"), "99": (None, None)}
    assert [r["k"] for r in run.diagnosis["members"].collect()] == ["22", "551"]


def test_empty_inputs(spark, tmp_path):
    (tmp_path / "empty").write_text("")
    (tmp_path / "blank").write_text("\n  \n")
    (tmp_path / "k").write_text("a\n")
    with pytest.raises(EmptyKeyList):
        run_match(spark, str(tmp_path / "k"), str(tmp_path / "empty"))
    run = run_match(spark, str(tmp_path / "blank"), str(tmp_path / "k"))
    assert (run.status, run.n_processed) == ("no rows", 0)


@pytest.mark.parametrize("bound", [0, None])
def test_stream_equals_batch_and_restarts(spark, tmp_path, bound):
    (tmp_path / "in").mkdir()
    raw = []
    for i in range(3):
        raw += data_file(tmp_path / "in" / f"f{i}", i, 100)
    (tmp_path / "k").write_text("k1\nk1\nk2\n\n")
    keys = key_lines(read_lines(spark, str(tmp_path / "k")))

    def run():
        q = stream_match(spark, str(tmp_path / "in"), keys, str(tmp_path / "out"), str(tmp_path / "state"),
                         files_per_batch=2, max_broadcast_bytes=bound)
        q.awaitTermination()
        return q

    def result():
        return sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect())

    listed = {"k1", "k2", ""}
    q = run()
    n, hits, bad, out = brute(raw, listed)
    assert result() == sorted(out)
    assert stream_counts(q) == {"n_lines": len(raw), "n_processed": n, "n_errors": bad, "n_matches": hits}
    assert len(stream_rates(q)) >= 2
    run()
    assert result() == sorted(out)
    raw += data_file(tmp_path / "in" / "later", 9, 50)
    run()
    assert result() == sorted(brute(raw, listed)[3])


def test_stream_totals_beyond_the_kept_progress(spark, tmp_path, conf):
    conf("spark.sql.streaming.numRecentProgressUpdates", "3")
    (tmp_path / "in").mkdir()
    for i in range(8):
        (tmp_path / "in" / f"{i}.csv").write_text("a,1\nb,2\n")
    keys = spark.createDataFrame([("a",)], "k string")
    (tmp_path / "in" / "odd.csv").write_bytes(b"a\n\n  \n\xff\nc,a\n")

    def run():
        return counted_match(spark, str(tmp_path / "in"), keys, str(tmp_path / "out"), str(tmp_path / "state"), files_per_batch=1)

    batches = run()
    assert tuple(totals(batches).first()) == (21, 18, 1, 9)
    assert sorted(r["batch"] for r in batches.collect()) == list(range(9))
    (tmp_path / "in" / "later.csv").write_text("a\n")
    run()
    assert tuple(totals(batch_rows(spark, str(tmp_path / "state-progress"))).first()) == (22, 19, 1, 10)
    q = stream_match(spark, str(tmp_path / "in"), keys, str(tmp_path / "out2"), str(tmp_path / "state2"), files_per_batch=1)
    q.awaitTermination()
    with pytest.raises(LostProgress):
        stream_counts(q)


def test_hidden_inputs_are_refused(spark, tmp_path):
    for name in ("d.csv", "_e.csv", "_SUCCESS"):
        (tmp_path / name).write_text("a,1\n")
    for path in (str(tmp_path), str(tmp_path / "*.csv"), str(tmp_path / "_e.csv"), [str(tmp_path / "_e.csv")]):
        with pytest.raises(HiddenInput):
            read_lines(spark, path)
    assert read_lines(spark, str(tmp_path / "d.csv")).count() == 1
    deep = tmp_path / "p" / "a=1" / "b=2"
    deep.mkdir(parents=True)
    (deep / "f.csv").write_text("a,1\n")
    assert read_lines(spark, str(tmp_path / "p")).count() == 1
    (deep / "_g.csv").write_text("a,1\n")
    with pytest.raises(HiddenInput):
        read_lines(spark, str(tmp_path / "p"))


def test_result_is_not_written_into_the_input(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "d.csv").write_text("a,1\n")
    (tmp_path / "k").write_text("a\n")
    with pytest.raises(OutputInInput):
        run_match(spark, str(tmp_path / "b" / "*.csv"), str(tmp_path / "k"))
    for _ in range(2):
        run = run_match(spark, str(tmp_path / "b" / "*.csv"), str(tmp_path / "k"), out=str(tmp_path / "out"))
        assert (run.n_processed, run.n_matches) == (1, 1)


def test_upload_keeps_what_cannot_be_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good").write_text("x")
    (tmp_path / "in" / "dangling").symlink_to(tmp_path / "nowhere")
    nothing = spark.createDataFrame([], "key string, size bigint")
    got = {r["src"].rsplit("/", 1)[1]: r for r in run_upload(plan_upload(spark, str(tmp_path / "in"), nothing), str(tmp_path / "out")).collect()}
    assert got["good"]["status"] == "uploaded" and got["dangling"]["status"] == "error" and got["dangling"]["error"]
    with pytest.raises(FileNotFoundError):
        plan_upload(spark, str(tmp_path / "missing"), nothing)


@pytest.mark.parametrize(
    ("named", "given", "master", "root"),
    [("/a", "/b/x", "yarn", "/a"), (None, "/b/x", "yarn", "/b/x"), (None, None, "yarn", None), (None, None, "local-cluster[1,1,1]", None)])
def test_shared_root(named, given, master, root):
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: named), sparkContext=SimpleNamespace(getCheckpointDir=lambda: given, master=master))
    if root:
        assert shared_root(session) == root
    else:
        with pytest.raises(ValueError):
            shared_root(session)


def tasks_of(spark, work):
    """Result of ``work`` and how many tasks its jobs ran."""
    import uuid

    tag = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(tag, "")
    try:
        got = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(tag) for s in tracker.getJobInfo(j).stageIds]
    return got, sum(s.numTasks for s in stages if s)


def test_samples_read_no_more_than_they_need(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "2000")
    conf("spark.sql.files.openCostInBytes", "8")
    (tmp_path / "in").mkdir()
    lines = [["\n".join(f"{f}{i // 7},{i}" for i in range(3000))] for f in "ab"]
    for f, body in zip("ab", lines, strict=True):
        (tmp_path / "in" / f"{f}.csv").write_text("\n \n" + body[0])
    path = str(tmp_path / "in")
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    (rows, n_tasks) = tasks_of(spark, lambda: head_lines(spark, path, lambda found: len(found) >= 5, start=5))
    assert [r["k"] for r in rows] == ["a0"] * 5 and n_tasks == 1
    listed = spark.createDataFrame([("a1",)], "k string")
    got = head_sample_keys(spark, path, listed, 3, start=2)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a0", False), (2, "a1", True), (3, "a2", False)]
    assert head_sample_keys(spark, path, listed, 500, start=100, most=400) is None
    everything = head_sample_keys(spark, path, listed, 5000).collect()
    assert len(everything) == 2 * 429 and max(everything)["k"] == "b428"
    assert [(r["ord"], r["in_list"]) for r in head_sample_lines(spark, path, listed, 2).orderBy("ord").collect()] == [(1, False), (2, False)]


@pytest.mark.parametrize(("given", "out", "refused"), [
    ("/a/*.csv", "/a/x/out.csv", False), ("/a/*.csv", "/a/out.csv", True), ("/a/in", "file:/a/in/out", True), ("in", "{cwd}/in", True),
    ("{cwd}/in", "in/deep/out", True), ("/a/in", "/a/in2", False), ("/a/*/*", "/a/out", True), ("/a/*/*.csv", "/a/out", False),
    ("/a/{b,c}/d", "/a/b/d/out", True), ("s3://b/k", "s3://b/k/out", True), ("s3://b/k", "/b/k/out", False), (["/x", "/a"], "/a/o", True)])
def test_results_among_inputs(given, out, refused):
    import os

    from wharfline.sources.matches import refuse_output_in_input

    def at(p):
        return p.replace("{cwd}", os.getcwd())

    args = ([at(g) for g in given] if isinstance(given, list) else at(given)), at(out)
    if refused:
        with pytest.raises(OutputInInput):
            refuse_output_in_input(*args)
    else:
        refuse_output_in_input(*args)
