"""Line reading, keys and rejects on files with awkward bytes."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from wharfline.functions import text as T
from wharfline.sources import lines as L

RAW = (
    b"a,1\nb,2\r\nc,3\rd,4\n\n   \n,lead\nnocomma\n\"x,y\",z\n8\x00,q\n"
    b"bad\xff,1\nsur\xed\xa0\x80,2\n\xe2\x80\x83wide\xe3\x80\x80,5\nlast,9"
)


def expected_lines(raw):
    return raw.splitlines()


def brute(raw):
    """What a plain reading of the bytes gives: (line, key) and bad lines."""
    good, bad = [], []
    for b in expected_lines(raw):
        try:
            line = b.decode("utf-8")
        except UnicodeDecodeError:
            bad.append(b)
            continue
        if line.strip():
            good.append((line, line.split(",")[0].strip()))
    return good, bad


def in_order(df):
    return df.orderBy("pos")


def test_lines_end_like_splitlines(spark, tmp_path):
    (tmp_path / "f").write_bytes(RAW)
    got = L.read_lines(spark, str(tmp_path / "f"), positions=True)
    raw = [bytes(r[0]) for r in in_order(got).select(F.col("value").cast("binary")).collect()]
    assert raw == expected_lines(RAW)


def test_data_lines_and_rejects(spark, tmp_path):
    (tmp_path / "f").write_bytes(RAW)
    lines = L.read_lines(spark, str(tmp_path / "f"), positions=True)
    good, bad = brute(RAW)
    assert [tuple(r) for r in in_order(L.data_lines(lines)).select("value", "k").collect()] == good
    assert L.rejected_lines(lines).count() == len(bad)
    assert [r["n_bytes"] for r in L.first_rejects(lines).collect()] == [len(b) for b in bad]


def test_key_list_keeps_blank_lines(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"  a \n\n\t\nb,c\n\xff\n")
    keys = [r["k"] for r in L.key_lines(L.read_lines(spark, str(tmp_path / "f"))).collect()]
    assert sorted(keys) == ["", "", "a", "b,c"]


def test_strip_removes_what_python_strips(spark):
    chars = [chr(i) for i in range(0x3100) if chr(i) not in "\ud800"]
    rows = [(i, c + "k" + c) for i, c in enumerate(chars)]
    df = spark.createDataFrame(rows, "i int, v string")
    got = {r["i"]: (r["s"], r["b"]) for r in df.select(
        "i", T.strip("v").alias("s"), T.is_blank(F.left("v", F.lit(1))).alias("b")).collect()}
    for i, v in rows:
        assert got[i] == (v.strip(), v[0].strip() == ""), hex(i)


def test_byte_order_mark_is_dropped(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"\xef\xbb\xbfk,1\n")
    assert L.data_lines(L.read_lines(spark, str(tmp_path / "f"))).first()["k"] == "k"


def test_gzip_members(spark, tmp_path):
    (tmp_path / "f.gz").write_bytes(gzip.compress(b"a\nb\n") + gzip.compress(b"c\n"))
    (tmp_path / "g.gz").write_bytes(gzip.compress(b""))
    got = L.read_lines(spark, str(tmp_path))
    assert sorted(r["value"] for r in got.collect()) == ["a", "b", "c"]


def test_spread_gzip_keeps_positions(spark, tmp_path):
    lines = [f"line{i}" for i in range(500)]
    (tmp_path / "f.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    df = L.read_lines(spark, str(tmp_path / "f.gz"), positions=True, spread=6)
    assert df.select(F.spark_partition_id()).distinct().count() == 6
    got = in_order(L.number_lines(df)).collect()
    assert [(r["value"], r["line_no"]) for r in got] == [(v, i) for i, v in enumerate(lines, 1)]


@pytest.mark.parametrize("split", ["64", "1000"])
def test_positions_and_numbers_over_many_splits(spark, conf, tmp_path, split):
    conf("spark.sql.files.maxPartitionBytes", split)
    conf("spark.sql.files.openCostInBytes", "8")
    rng = random.Random(5)
    want = []
    for name in ("a.txt", "b.txt", "c.txt"):
        lines = [f"{name}-{i}," + "x" * rng.randrange(30) for i in range(rng.randrange(50, 120))]
        (tmp_path / name).write_text("\n".join(lines))
        want += [(line, i) for i, line in enumerate(lines, 1)]
    lines = L.read_lines(spark, str(tmp_path), positions=True)
    assert lines.rdd.getNumPartitions() > 3
    got = [(r["value"], r["line_no"]) for r in in_order(L.number_lines(lines)).collect()]
    assert got == want


def test_split_text(spark):
    df = spark.createDataFrame([(1, " a \r\n\r\nb\rc\n \t\n")], "i int, t string")
    rows = [tuple(r) for r in L.split_text(df, "i", "t").orderBy("line_no").collect()]
    assert rows == [(1, 0, "a"), (1, 2, "b"), (1, 3, "c")]


def test_parquet_to_lines_keeps_null_fields(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert L.parquet_to_lines(df).first()["value"] == "1,,x"
    assert L.parquet_to_lines(df, ["c", "a"], sep=";").first()["value"] == "x;1"
