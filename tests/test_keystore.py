"""The bucketed key store."""

import random

import pytest
from pyspark.sql import functions as F

from wharfline.operators.keystore import build_key_store, match_stored, open_key_store


def plan_of(df):
    df.count()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lists(spark):
    rng = random.Random(2)
    keys = [f"k{rng.randrange(500)}" for _ in range(700)] + ["", None, "é"]
    probe = [(i, rng.choice(["k1", "k1", f"k{rng.randrange(900)}", "", "é", None])) for i in range(4000)]
    expected = sorted(i for i, k in probe if k is not None and k in set(keys))
    return spark.createDataFrame([(k,) for k in keys], "k string"), spark.createDataFrame(probe, "pos long, k string"), expected


@pytest.mark.parametrize("hot", [10**9, 300])
@pytest.mark.parametrize("sample", [1.0, 0.2])
def test_matches(lists, tmp_path, hot, sample):
    keys, probe, expected = lists
    store = build_key_store(keys, str(tmp_path / "s"), buckets=5)
    assert sorted(r["pos"] for r in match_stored(probe, store, hot, sample).collect()) == expected


def test_the_stored_side_is_not_shuffled(spark, conf, lists, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    keys, probe, expected = lists
    build_key_store(keys, str(tmp_path / "s"), buckets=16)
    tables = spark.catalog.listTables()
    store = open_key_store(spark, str(tmp_path / "s"))
    assert spark.catalog.listTables() == tables, "the catalog stays as it was"
    for _ in range(2):
        found = match_stored(probe, store, sample=1.0)
        plan = plan_of(found.select("pos", F.spark_partition_id()))
        final = plan.split("Initial Plan")[0]
        assert final.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in final, plan
        assert found.count() == len(expected)


def test_buckets_follow_the_size(spark, monkeypatch, tmp_path, lists):
    from wharfline.operators import keystore

    monkeypatch.setattr(keystore, "BUCKET_BYTES", 10_000)
    store = build_key_store(lists[0], str(tmp_path / "s"))
    assert store.distinct().count() == store.count()
    about = spark.read.parquet(str(tmp_path / "s" / "about")).first()
    assert about["buckets"] > 3


def test_an_empty_store(spark, tmp_path, lists):
    store = build_key_store(lists[0].limit(0), str(tmp_path / "s"))
    assert match_stored(lists[1], store).count() == 0
