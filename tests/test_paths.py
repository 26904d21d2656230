"""Path expressions against plain Python on seeded random strings."""

import random

import pytest
from pyspark.sql import functions as F

from wharfline.functions import paths as P


def random_paths(seed, n=600):
    rng = random.Random(seed)
    parts = ["a", "bb", "in", "out", "x.gz", ".h", "_u", "", "s3:", "é", " ", "c.csv", "\t", "日本"]
    out = ["", "/", "//", "a", "/a", "a/", "a//b", "in/", "in", "out/x", "s3://b/k", "s3://", "x.gz.gz"]
    while len(out) < n:
        out.append(rng.choice(["", "s3://", " ", "/"]) + "/".join(rng.choices(parts, k=rng.randrange(1, 6))))
    return out


def evaluate(spark, rows, schema, *columns):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


# Derived by hand from the rules: text, then bucket and key of a plain split, of an
# address, and of an argument without and with a prefix of its own.
PARSED = [
    ("", ("", ""), ("", ""), ("", ""), ("", "q")),
    ("a", ("a", ""), ("a", ""), ("a", ""), ("a", "q")),
    ("a/", ("a", ""), ("a", ""), ("a", ""), ("a/", "q")),
    ("a/b", ("a", "b"), ("a", "b"), ("a", "b/"), ("a/b", "q")),
    ("a/b/", ("a", "b/"), ("a", "b/"), ("a", "b/"), ("a/b/", "q")),
    ("a//b", ("a", "/b"), ("a", "b"), ("a", "/b/"), ("a//b", "q")),
    ("s3://k/x/y", ("s3:", "/k/x/y"), ("k", "x/y"), ("s3:", "/k/x/y/"), ("s3://k/x/y", "q")),
    (" s3://k/x ", (" s3:", "/k/x "), ("k", "x"), (" s3:", "/k/x /"), (" s3://k/x ", "q")),
    ("/a", ("", "a"), ("", "a"), ("", "a/"), ("/a", "q")),
]


def test_parsers(spark):
    got = evaluate(
        spark, [(row[0],) for row in PARSED], "p string",
        P.split_bucket("p"), P.split_uri("p"), P.split_bucket_prefix("p"), P.split_bucket_prefix("p", "q"),
    )
    for row, found in zip(PARSED, got):
        assert [tuple(x) for x in found] == list(row[1:]), row[0]


def test_suffixes_names_and_folders(spark):
    paths = random_paths(2)
    got = evaluate(
        spark, [(p,) for p in paths], "p string",
        P.drop_gz_suffix("p"), P.drop_gz_everywhere("p"), P.parent_folder("p"),
        P.folder_depth("p"), P.tree_label("p"), P.is_hidden("p"), P.is_gz("p"), P.base_name("p"),
    )
    for p, row in zip(paths, got):
        name = p.split("/")[-1]
        assert row == (
            p.removesuffix(".gz"), p.replace(".gz", ""), p.rpartition("/")[0],
            p.count("/"), "    " * p.count("/") + "|-- " + name,
            any(part.startswith(".") for part in p.split("/")), p.endswith(".gz"), name,
        ), p


# Derived by hand: key, source prefix, base, destination, and where the key goes.
REBASED = [
    ("in/a/f", "in/a", "in", "out", "out/a/f"),
    ("in/a/f", "in/a/", "in/", "out/", "out/a/f"),
    ("in/a/b/f", "in/a", "in", "", "a/b/f"),
    ("in/f", "in", "in", "out", "out/f"),
    ("x/y/f", "x/y", "in", "out", "out/x/y/f"),
    ("inn/f", "inn", "in", "out", "out/inn/f"),
    ("f", "", "", "out", "out/f"),
    ("in//f", "in", "in", "o/p//", "o/p/f"),
    ("in/f.gz", "in", "", "", "in/f.gz"),
]


def test_rebase(spark):
    got = evaluate(spark, [r[:4] for r in REBASED], "k string, p string, b string, d string",
                   P.rebase("k", F.col("p"), F.col("b"), F.col("d")))
    assert [g[0] for g in got] == [r[4] for r in REBASED]


@pytest.mark.parametrize("seed", [3, 4])
def test_rebasing_keeps_what_is_below_the_prefix(spark, seed):
    """Where prefix and base agree, taking the destination away again gives the relative key."""
    rng = random.Random(seed)
    rows = [(f"in/{p}".replace("//", "/"), rng.choice(["out", "o/p/"])) for p in random_paths(seed) if not p.startswith("/")]
    got = evaluate(spark, rows, "k string, d string", P.rebase("k", F.lit("in"), F.lit("in"), F.col("d")), P.relative("k", "in"))
    for (k, d), (there, rel) in zip(rows, got):
        assert there == d.rstrip("/") + "/" + rel and k.endswith(rel), k


def test_suffix_before_a_newline_stays(spark):
    assert evaluate(spark, [("x.gz\n",), ("x.gz",)], "p string", P.drop_gz_suffix("p"), P.is_gz("p")) == [("x.gz\n", False), ("x", True)]


def test_prefix_does_not_take_in_longer_names(spark):
    assert evaluate(spark, [("out/a",), ("in/a",)], "k string", P.under("k", "in")) == [(False,), (True,)]


def test_target_keys(spark):
    rows = [("a\\b.csv",), ("x/y",)]
    assert evaluate(spark, rows, "r string", P.target_key("r"), P.target_key("r", "pre/x//")) == [
        ("a/b.csv", "pre/x/a/b.csv"), ("x/y", "pre/x/x/y")]


def test_display_name_is_cut(spark):
    assert evaluate(spark, [("d/" + "n" * 40,)], "p string", P.display_name("p")) == [("n" * 30,)]
