"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wharfline.functions import paths as P
from wharfline.functions.text import first_field_key
from wharfline.operators import catalog as C
from wharfline.operators import diagnose as D
from wharfline.operators import folders as FO
from wharfline.operators import match as M
from wharfline.operators import sync as S
from wharfline.operators import transfer as T
from wharfline.operators.keystore import build_key_store, match_stored
from wharfline.operators.numbering import number_rows
from wharfline.plans.copy_run import plan_copy, summary_lines
from wharfline.plans.match_run import EmptyKeyList, run_match
from wharfline.plans.resumable_run import batch_counts
from wharfline.plans.unpack_run import resume_unpack, run_unpack
from wharfline.sources import gzip_ranges as GZ
from wharfline.sources import inventory as INV
from wharfline.sources import ledger as LG
from wharfline.sources import lines as L
from wharfline.sources.head import head_sample_keys
from wharfline.sources.matches import write_one_gzip
from wharfline.streaming.match import stream_match as start_stream
from wharfline.streaming.progress import counted_match, totals
from wharfline.workdir import new_dir
from workload import views as V

Query = Callable[[SparkSession, str], DataFrame]

SOURCES = ["s3://wharf/in/src1", "s3://wharf/in/src1/en", "s3://wharf/in/src2/", "s3://wharf/in/"]
BUCKETS = 16


def _probe(spark: SparkSession, d: str) -> DataFrame:
    return L.data_lines(V.order_lines(spark, d))


def _keys(spark: SparkSession, d: str) -> DataFrame:
    return L.key_lines(V.segment_keys(spark, d))


# --- line matching ---------------------------------------------------------


def match_lines(spark, d):
    return M.match_lines(_probe(spark, d), _keys(spark, d)).select("pos", "value")


def match_lines_shuffled(spark, d):
    """The same match the way it runs for a key list too big to broadcast."""
    found = M.match_lines(_probe(spark, d), _keys(spark, d), max_broadcast_bytes=0)
    return found.select("pos", "value")


def match_key_store(spark, d):
    """Two probes against one stored key list, which neither of them shuffles."""
    store = build_key_store(_keys(spark, d), f"{new_dir(spark, 'store')}/keys", BUCKETS)
    probe = _probe(spark, d)
    even, odd = probe.filter("pos % 2 = 0"), probe.filter("pos % 2 = 1")
    return match_stored(even, store).unionByName(match_stored(odd, store)).select("pos", "value")


def match_counts(spark, d):
    return M.match_counts(V.damaged_lines(spark, d), _keys(spark, d))


def split_lines(spark, d):
    return V.document_lines(spark, d)


def match_document_lines(spark, d):
    keys = L.key_lines(V.benchmark_lines(spark, d))
    probe = V.document_lines(spark, d).withColumn("k", first_field_key("value"))
    return M.match_lines(probe, keys).select("doc_id", "line_no", "value")


def match_whole_lines(spark, d):
    """Document lines that occur whole in the benchmark: another probe key."""
    keys = L.key_lines(V.benchmark_lines(spark, d))
    probe = V.document_lines(spark, d).withColumn("k", F.col("value"))
    return M.match_lines(probe, keys).select("doc_id", "line_no", "value")


def sample_lines(spark, d):
    return D.sample_lines(_probe(spark, d), _keys(spark, d))


def sample_keys(spark, d):
    return D.sample_keys(_probe(spark, d), _keys(spark, d))


def head_keys(spark, d):
    """The first keys of line files, read from the front until there are enough."""
    path = _write_lines(V.order_lines(spark, d).orderBy("pos"), new_dir(spark, "lines"))
    return head_sample_keys(spark, path, _keys(spark, d))


def sample_members(spark, d):
    return D.sample_members(_keys(spark, d))


def first_matches(spark, d):
    return M.first_matches(match_lines(spark, d)).select("pos", "value")


def undecodable_lines(spark, d):
    return L.rejected_lines(V.damaged_lines(spark, d)).select(
        "pos", F.octet_length("value").cast("bigint").alias("n_bytes")
    )


def first_rejects(spark, d):
    return L.first_rejects(V.damaged_lines(spark, d))


def key_variants(spark, d):
    """Customer keys written in five styles against plain listed keys."""
    customers = V.table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    plain = (F.col("id") + 5550000000).cast("string")
    a, b = F.left(plain, F.lit(3)), F.substr(plain, F.lit(4))
    style = F.col("id") % 5
    written = (
        F.when(style == 0, plain)
        .when(style == 1, F.concat(a, F.lit(" "), b))
        .when(style == 2, F.concat(a, F.lit("-"), b))
        .when(style == 3, F.concat(F.lit("("), a, F.lit(")"), b))
        .otherwise(F.concat(F.lit("+"), plain))
    )
    listed = customers.filter(F.col("id") % 2 == 0).select(plain.alias("k"))
    found = D.key_variants(customers.select(written.alias("k")), listed)
    return found.select("k", F.col("rule").cast("bigint").alias("rule"), "found_as")


def _key_columns(spark, d):
    def keys(name, c):
        return V.table(spark, d, name).select(F.col(c).alias("k"))

    columns = {
        "customer.c_custkey": keys("customer", "c_custkey"),
        "orders.o_custkey": keys("orders", "o_custkey"),
        "orders.o_orderkey": keys("orders", "o_orderkey"),
        "lineitem.l_orderkey": keys("lineitem", "l_orderkey"),
        "lineitem.l_returnflag": keys("lineitem", "l_returnflag"),
        "customer.c_mktsegment": keys("customer", "c_mktsegment"),
    }
    pairs = [
        ("customer.c_custkey", "orders.o_custkey"),
        ("orders.o_orderkey", "lineitem.l_orderkey"),
        ("lineitem.l_returnflag", "customer.c_mktsegment"),
    ]
    return columns, pairs


KEY_COLUMNS = {
    "customer": ["c_custkey", "c_nationkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"],
    "part": ["p_partkey"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "nation": ["n_nationkey", "n_regionkey"],
    "region": ["r_regionkey"],
}


def _key_tables(spark, d):
    return {name: (V.table(spark, d, name), columns) for name, columns in KEY_COLUMNS.items()}


def key_pairs(spark, d):
    """Shared keys of all pairs of key columns, counted by one shuffle."""
    return C.exact_pairs(_key_tables(spark, d))


def key_estimates(spark, d):
    """All pairs by sketches: whether each estimate is within five parts in a hundred of the pair's larger column."""
    tables = _key_tables(spark, d)
    guess = C.estimate_pairs(C.column_sketches(tables)).withColumnsRenamed({n: f"{n}_" for n in ("n_left", "n_right", "n_common")})
    larger = F.greatest("n_left", "n_right")
    near = [F.abs(F.col(f"{n}_") - F.col(n)) <= 0.05 * larger for n in ("n_left", "n_right", "n_common")]
    return guess.join(C.exact_pairs(tables), ["left_col", "right_col"]).select(
        "left_col", "right_col", (near[0] & near[1] & near[2]).alias("near"))


def key_overlap(spark, d):
    return D.key_overlap(*_key_columns(spark, d))


def key_catalog(spark, d):
    return D.key_catalog(D.key_overlap(*_key_columns(spark, d)))


# --- line files ------------------------------------------------------------


def parquet_to_lines(spark, d):
    return L.parquet_to_lines(V.table(spark, d, "lineitem"))


def _write_lines(lines: DataFrame, path: str, **options) -> str:
    lines.select("value").write.options(**options).text(path)
    return path


def line_numbers(spark, d):
    """Lines written in order, read back in splits and numbered per file."""
    path = new_dir(spark, "lines")
    ordered = V.order_lines(spark, d).orderBy("pos").select("value")
    _write_lines(ordered, path)
    numbered = L.number_lines(L.read_lines(spark, path, positions=True))
    # Per file, numbers must run from 1 in the order of the keys that the lines were written in.
    key = F.split_part("value", F.lit(","), F.lit(2)).cast("bigint")
    rank = F.row_number().over(W.partitionBy("pos.file").orderBy(key))
    return numbered.select(F.col("line_no"), rank.cast("bigint").alias("rank")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.bool_and(F.col("line_no") == F.col("rank")).alias("complete"))


def gz_roundtrip(spark, d):
    path = _write_lines(V.order_lines(spark, d), new_dir(spark, "gz"), compression="gzip")
    return L.read_lines(spark, path)


def match_files(spark, d):
    """The whole run on files: read, match, count, write in order, read back."""
    base = new_dir(spark, "run")
    data = _write_lines(V.damaged_lines(spark, d).orderBy("pos"), f"{base}/data")
    keys = _write_lines(V.segment_keys(spark, d), f"{base}/keys")
    run = run_match(spark, data, keys, out=f"{base}/out")
    parts = L.read_lines(spark, run.output, positions=True)
    return number_rows(parts, ["pos"], "line_no").select("line_no", "value")


def run_statuses(spark, d):
    """How runs end: with matches, without, without rows, and refused for an empty key list."""
    base = new_dir(spark, "run")
    lines = V.damaged_lines(spark, d)
    _write_lines(lines, f"{base}/data")
    _write_lines(lines.select(F.lit("  ").alias("value")), f"{base}/blank")
    _write_lines(V.segment_keys(spark, d), f"{base}/keys")
    _write_lines(V.segment_keys(spark, d).select(F.concat(F.lit("no-"), "value").alias("value")), f"{base}/others")
    _write_lines(V.segment_keys(spark, d).filter("false"), f"{base}/none")
    rows = []
    for data, keys in (("data", "keys"), ("data", "others"), ("blank", "keys"), ("data", "none")):
        try:
            run = run_match(spark, f"{base}/{data}", f"{base}/{keys}", out=f"{base}/{data}-{keys}")
            rows.append((data, keys, run.status, run.n_processed, run.n_matches, run.n_errors, run.output is not None))
        except EmptyKeyList:
            rows.append((data, keys, "empty key list", None, None, None, False))
    return spark.createDataFrame(
        rows, "data string, keys string, status string, n_processed long, n_matches long, n_errors long, written boolean")


def match_one_file(spark, d):
    """The run's result as one file, written by many tasks: its lines and their numbers."""
    base = new_dir(spark, "run")
    data = _write_lines(V.damaged_lines(spark, d).orderBy("pos"), f"{base}/data")
    keys = _write_lines(V.segment_keys(spark, d), f"{base}/keys")
    run = run_match(spark, data, keys, out=f"{base}/matches.csv", single=True)
    return L.number_lines(L.read_lines(spark, run.output, positions=True)).select("line_no", "value")


def gz_ranges(spark, d):
    """One gzip file read by many tasks from the places of its index, lines numbered."""
    base = new_dir(spark, "gz")
    write_one_gzip(V.order_lines(spark, d), f"{base}/in/lines.gz")
    files = INV.walk_inventory(spark, f"{base}/in").filter(P.is_gz("path"))
    lines = GZ.read_ranges(GZ.index_gzip(files, f"{base}/index", span=64 * 1024))
    return number_rows(lines, ["pos"], "line_no").select("line_no", "value")


def stream_match(spark, d):
    base = new_dir(spark, "stream")
    _write_lines(V.order_lines(spark, d), f"{base}/in")
    query = start_stream(spark, f"{base}/in", _keys(spark, d), f"{base}/out", f"{base}/state")
    query.awaitTermination()
    return spark.read.text(f"{base}/out")


def stream_progress(spark, d):
    """Counters of a stream whose batches outnumber the reports Spark keeps, bad and blank lines among its input."""
    base = new_dir(spark, "stream")
    lines = V.damaged_lines(spark, d)
    blank = lines.filter("pos % 89 = 0").withColumn("value", F.lit("  "))
    both = lines.unionByName(blank).select("value", (F.col("pos") % 6).alias("bucket"))
    both.repartition("bucket").write.partitionBy("bucket").text(f"{base}/in")
    option = "spark.sql.streaming.numRecentProgressUpdates"
    kept = spark.conf.get(option)
    spark.conf.set(option, "4")
    try:
        batches = counted_match(spark, f"{base}/in/*", _keys(spark, d), f"{base}/out", f"{base}/state", files_per_batch=1)
    finally:
        spark.conf.set(option, kept)
    return totals(batches)


# --- paths -----------------------------------------------------------------


def parse_paths(spark, d):
    """Every parser on every address, with and without scheme."""
    padded = F.concat(F.lit("  s3://"), F.regexp_replace("key", "/", "//"), F.lit("\t"))
    return V.page_paths(spark, d).select(
        "page_id",
        P.split_bucket("key")["bucket"].alias("plain_bucket"),
        P.split_bucket("key")["key"].alias("plain_key"),
        P.split_uri(padded)["bucket"].alias("uri_bucket"),
        P.split_uri(padded)["key"].alias("uri_key"),
        P.split_bucket_prefix("key")["bucket"].alias("arg_bucket"),
        P.split_bucket_prefix("key")["prefix"].alias("arg_prefix"),
        P.split_bucket_prefix("key", "given")["prefix"].alias("given_prefix"),
    )


def folder_tree(spark, d):
    return FO.folder_tree(V.page_paths(spark, d))


def _by_host(spark, d):
    pages = V.page_paths(spark, d)
    return pages.withColumn("source", P.split_bucket("key")["bucket"]).withColumn("prefix", F.col("source"))


def folder_rollup(spark, d):
    return FO.folder_rollup(_by_host(spark, d))


def folder_list(spark, d):
    return FO.folder_list(_by_host(spark, d))


def folder_cap(spark, d):
    return FO.folder_cap(_by_host(spark, d), cap=2)


def strip_suffix(spark, d):
    key = F.concat(F.lit("a.gz.d/"), F.col("key"))
    return V.inventory(spark, d).select(
        "doc_id", P.drop_gz_suffix(key).alias("at_end"), P.drop_gz_everywhere(key).alias("everywhere")
    )


def union_sources(spark, d):
    return FO.union_sources(V.inventory(spark, d), SOURCES).select("source_no", "source", "key", "size")


def many_sources(spark, d):
    """Order files against a table of thousands of overlapping sources; files and bytes per source."""
    orders = V.table(spark, d, "orders")
    folder = F.concat_ws("/", F.lit("in"), F.col("o_custkey").cast("string"), "o_orderstatus")
    files = orders.select(
        F.concat(folder, F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("key"),
        F.floor("o_totalprice").alias("size"))
    # files of a folder together, split where they are many: a task then counts its own share of the sources, not all
    files = files.withColumn("folder", P.parent_folder("key")).hint("rebalance", "folder").drop("folder")
    customers = V.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    whole = customers.select((F.col("k") * 2).alias("source_no"), F.concat(F.lit("s3://wharf/in/"), F.col("k").cast("string")).alias("source"))
    part = customers.filter("k % 3 = 0").select(
        (F.col("k") * 2 + 1).alias("source_no"), F.concat(F.lit("s3://wharf/in/"), F.col("k").cast("string"), F.lit("/F/")).alias("source"))
    sourced = FO.union_sources(files, whole.unionByName(part))
    return sourced.groupBy(F.col("source_no").cast("bigint").alias("source_no"), "source", "prefix").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"))


def union_buckets(spark, d):
    """Objects of another bucket under the same prefixes are left out."""
    inv = V.inventory(spark, d).withColumn("bucket", F.when(F.col("doc_id") % 3 == 0, "quay").otherwise("wharf"))
    return FO.union_sources(inv, SOURCES).select("source_no", "source", "key", "size")


def rebase_paths(spark, d):
    """The copy plan: overlapping sources, rebased and numbered."""
    sourced = FO.union_sources(V.inventory(spark, d), SOURCES)
    plan = FO.numbered_plan(FO.rebase_plan(sourced, base="in/", dest="out/"))
    return plan.select("task_no", "source_no", "src", "dst")


def duplicate_targets(spark, d):
    """Keys with doubled slashes fall on the targets of their plain twins."""
    inv = V.inventory(spark, d).select("key")
    twins = inv.filter(F.endswith("key", F.lit("0.csv"))).select(F.regexp_replace("key", "^in/", "in//").alias("key"))
    sourced = FO.union_sources(inv.unionByName(twins), ["s3://wharf/in/"])
    return FO.duplicate_targets(FO.rebase_plan(sourced, "in/", "out/"))


# --- skip rules and outcomes -------------------------------------------------


def _files(spark, d):
    """Inventory relative to in/, with some hidden names and folders."""
    doc, key = F.col("doc_id"), F.substr("key", F.lit(4))
    folder, name = P.parent_folder(key), P.base_name(key)
    path = (
        F.when(doc % 11 == 0, F.concat(folder, F.lit("/."), name))
        .when(doc % 13 == 0, F.concat(F.lit(".old/"), key))
        .when(doc % 17 == 0, F.concat(folder, F.lit("/_"), name))
        .otherwise(key)
    )
    return V.inventory(spark, d).withColumn("path", path).select("path", "size")


def _with_twins(spark, d):
    files = _files(spark, d)
    plain = files.filter(P.is_gz("path")).select(
        P.drop_gz_suffix("path").alias("path"), (F.col("size") * 4).alias("size")
    )
    return files.unionByName(plain.filter(F.col("size") % 8 == 0))


def visible_files(spark, d):
    return S.visible_files(_files(spark, d))


def gz_twins(spark, d):
    return S.gz_twins(S.visible_files(_with_twins(spark, d)))


def _plan(spark, d):
    files = V.inventory(spark, d).select(F.col("key").alias("path"), "size")
    return S.sync_plan(files, V.destination(spark, d))


def sync_plan(spark, d):
    return _plan(spark, d).select("path", "size", "dst", "action", "compressed_source", "shown")


def _ledger(spark, d):
    """Marks for labelled documents: done where toxic, begun elsewhere."""
    return V.table(spark, d, "labels").select(
        F.col("doc_id").cast("string").alias("key"),
        F.lit(S.DONE_KEY).alias("tag_key"),
        F.when(F.col("toxic") == 1, F.lit(S.DONE_VALUE)).otherwise(F.lit("False")).alias("tag_value"),
    )


def ledger_pending(spark, d):
    files = V.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"))
    return S.ledger_pending(files, _ledger(spark, d))


def reconcile_sizes(spark, d):
    expected = V.inventory(spark, d).select(
        F.col("key").alias("src"), P.drop_gz_suffix("key").alias("dst"), "size"
    )
    return S.reconcile_sizes(expected, V.destination(spark, d))


def _outcomes(spark, d):
    """Planned actions as outcomes; sizes divisible by 50 stand for failures."""
    failed = F.col("size") % 50 == 0
    return _plan(spark, d).select(
        F.col("path").alias("src"),
        "dst",
        F.when(failed, F.lit(S.ERROR)).otherwise(F.col("action")).alias("status"),
        F.when(failed | (F.col("action") == S.SKIPPED), F.lit(0)).otherwise(F.col("size")).alias("bytes"),
    )


def outcome_summary(spark, d):
    return S.outcome_summary(_outcomes(spark, d))


def completed(spark, d):
    """Planned files against the outcomes known so far (no failures)."""
    known = _outcomes(spark, d).filter(F.col("status") != S.ERROR)
    return S.completed(_plan(spark, d), known)


def copy_volume(spark, d):
    done = V.inventory(spark, d).select("source", F.col("size").alias("bytes"))
    return S.copy_volume(done, "source")


# --- transfer jobs -----------------------------------------------------------


def _line_files(spark, d, path, **options):
    """Order lines in one folder per key bucket."""
    lines = V.order_lines(spark, d).select("value", (F.col("pos") % BUCKETS).alias("bucket"))
    lines.write.partitionBy("bucket").options(**options).text(path)
    return path


def _per_bucket(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.col("bucket").cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.octet_length("value") + 1).alias("n_bytes"),
        F.count_distinct("value").alias("n_distinct"),
        F.max("value").alias("last_line"),
    )


def _read_buckets(spark, path):
    return _per_bucket(spark.read.text(path))


def decompress_job(spark, d):
    """Gzip files unpacked twice through one ledger; lines and bytes per folder."""
    base = new_dir(spark, "unpack")
    _line_files(spark, d, f"{base}/in", compression="gzip")
    files = INV.walk_inventory(spark, f"{base}/in").filter(P.is_gz("path"))
    run_unpack(files, f"{base}/ledger")
    again = run_unpack(files, f"{base}/ledger")
    rerun = again.agg(F.count_if(F.col("status") != S.SKIPPED).alias("n_again")).scalar()
    unpacked = spark.read.option("pathGlobFilter", "*.txt").text(f"{base}/in")
    return _per_bucket(unpacked).withColumn("n_again", rerun)


class _Stopped(RuntimeError):
    """Ends a run on purpose."""


def resumed_unpack(spark, d):
    """Unpacking in batches of four files, stopped after the first and taken up again.

    One row per batch: files, outcomes and done marks, and the lines and bytes of
    all that was unpacked.
    """
    base = new_dir(spark, "resume")
    lines = V.order_lines(spark, d).select("value", (F.col("pos") % BUCKETS).alias("bucket"))
    lines.repartition("bucket").write.partitionBy("bucket").option("compression", "gzip").text(f"{base}/in")
    files = INV.walk_inventory(spark, f"{base}/in").filter(P.is_gz("path"))

    def stop(number):
        raise _Stopped(f"after batch {number}")

    try:
        resume_unpack(files, f"{base}/ledger", f"{base}/state", step_files=4, on_batch=stop)
    except StreamingQueryException as stopped:
        if _Stopped.__name__ not in str(stopped):
            raise
    outcomes = resume_unpack(files, f"{base}/ledger", f"{base}/state", step_files=4)
    marks = LG.read_ledger(spark, f"{base}/ledger").select(F.col("key").alias("src"))
    marked = outcomes.join(marks, "src").groupBy("batch").agg(F.count(F.lit(1)).alias("n_marks"))
    total = spark.read.option("pathGlobFilter", "*.txt").text(f"{base}/in").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.octet_length("value") + 1).alias("n_line_bytes"))
    return batch_counts(outcomes).join(marked, "batch").select(
        "batch", "n_files", "n_uploaded", "n_errors", "n_marks",
        total.select("n_lines").scalar().alias("n_lines"), total.select("n_line_bytes").scalar().alias("n_line_bytes"))


def copy_job(spark, d):
    """Files copied in small parts; lines and bytes per folder at the target."""
    base = new_dir(spark, "copy")
    _line_files(spark, d, f"{base}/in")
    src = INV.walk_inventory(spark, f"{base}/in")
    dst = F.concat(F.lit(f"{base}/out/"), F.col("path"))
    T.copy_job(src.select(F.col("uri").alias("src"), dst.alias("dst"), "size"), part_bytes=4096, on_error="fail")
    return _read_buckets(spark, f"{base}/out")


def transfer_rate(spark, d):
    """Bytes of a copy, written out with separators, and whether a rate came of it."""
    base = new_dir(spark, "rate")
    _line_files(spark, d, f"{base}/in")
    src = INV.scan_inventory(spark, f"{base}/in", glob="*.txt")
    done = T.copy_job(src.select(F.col("uri").alias("src"), F.concat(F.lit(f"{base}/out/"), "path").alias("dst"), "size"))
    return S.copy_rate(done).select("n_bytes", "n_bytes_text", (F.col("mb_per_s") > 0).alias("has_rate"))


def copy_log(spark, d):
    """The summary that a copy's log begins with, as numbered lines without their stamps."""
    files = V.inventory(spark, d).select("key", "size")
    plan = plan_copy(files, ["s3://wharf/in/src1/", "s3://wharf/in/src2/", "s3://wharf/in/src1/en/"], "in/", "out/", cap=2)
    lines = number_rows(summary_lines(plan).withColumn("at", F.monotonically_increasing_id()), ["at"], "line_no")
    path = f"{new_dir(spark, 'log')}/log"
    LG.append_log(lines, F.concat(F.lpad(F.col("line_no").cast("string"), 6, "0"), "line"), path)
    logged = F.regexp_extract("value", r"^\[\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\] (\d{6})(.*)$", 0)
    body = F.substr(logged, F.lit(23))
    return spark.read.text(path).select(F.substring(body, 1, 6).cast("bigint").alias("line_no"), F.substr(body, F.lit(7)).alias("line"))


def upload_job(spark, d):
    """Half the folders compressed: walked, planned, moved; then planned again.

    ``n_left`` counts what a second plan would still move.
    """
    from wharfline.plans.upload_run import plan_upload, run_upload

    base = new_dir(spark, "upload")
    lines = V.order_lines(spark, d).select("value", (F.col("pos") % BUCKETS).alias("bucket"))
    odd = F.col("bucket") % 2 == 1
    for part, compression in ((lines.filter(odd), "gzip"), (lines.filter(~odd), "none")):
        part.write.mode("append").partitionBy("bucket").option("compression", compression).text(
            f"{base}/in"
        )
    nothing = spark.createDataFrame([], "key string, size bigint")
    # Spark's own marker files are no data.
    plan = plan_upload(spark, f"{base}/in", nothing).filter(P.base_name("path") != "_SUCCESS")
    run_upload(plan, f"{base}/out", on_error="fail")
    there = INV.walk_inventory(spark, f"{base}/out").select(F.col("path").alias("key"), "size")
    left = plan_upload(spark, f"{base}/in", there).filter(
        (P.base_name("path") != "_SUCCESS") & (F.col("action") != S.SKIPPED)
    )
    n_left = left.agg(F.count(F.lit(1)).alias("n")).scalar()
    return _read_buckets(spark, f"{base}/out").withColumn("n_left", n_left)


def scan_inventory(spark, d):
    """Sizes found by the listing source and by the walk agree for every file."""
    base = _line_files(spark, d, new_dir(spark, "scan"))
    scanned = INV.scan_inventory(spark, base, glob="*.txt")
    walked = INV.walk_inventory(spark, base).filter(P.base_name("path") != "_SUCCESS")
    check = S.reconcile_sizes(
        walked.select(F.col("path").alias("src"), F.col("path").alias("dst"), "size"),
        scanned.select(F.col("path").alias("key"), "size"),
    )
    return check.groupBy("check").agg(F.sum("size").alias("n_bytes"))


def run_log(spark, d):
    """Ledger and log written from outcomes, read back and counted."""
    base = new_dir(spark, "log")
    outcomes = _outcomes(spark, d)
    LG.append_log(outcomes, F.concat_ws(" ", "status", "src"), f"{base}/log")
    LG.mark_done(outcomes, f"{base}/ledger")
    stamped = F.rlike("value", F.lit(r"^\[\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\] (uploaded|skipped|error) in/"))
    n_done = S.done_keys(LG.read_ledger(spark, f"{base}/ledger")).agg(F.count_distinct("key").alias("n")).scalar()
    return spark.read.text(f"{base}/log").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(stamped).alias("n_stamped")
    ).withColumn("n_done", n_done)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        match_lines,
        match_lines_shuffled,
        match_key_store,
        match_counts,
        split_lines,
        match_document_lines,
        match_whole_lines,
        sample_lines,
        sample_keys,
        head_keys,
        sample_members,
        first_matches,
        undecodable_lines,
        first_rejects,
        key_variants,
        key_overlap,
        key_pairs,
        key_estimates,
        key_catalog,
        parquet_to_lines,
        line_numbers,
        gz_roundtrip,
        gz_ranges,
        match_files,
        match_one_file,
        run_statuses,
        stream_match,
        stream_progress,
        parse_paths,
        folder_tree,
        folder_rollup,
        folder_list,
        folder_cap,
        strip_suffix,
        union_sources,
        many_sources,
        union_buckets,
        rebase_paths,
        duplicate_targets,
        visible_files,
        gz_twins,
        sync_plan,
        ledger_pending,
        reconcile_sizes,
        outcome_summary,
        completed,
        copy_volume,
        decompress_job,
        resumed_unpack,
        copy_job,
        transfer_rate,
        copy_log,
        upload_job,
        scan_inventory,
        run_log,
    )
}
