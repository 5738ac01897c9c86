"""Merge of a stored table: results against a plain merge, files against what may be rewritten."""

import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import bucket_merge as B
from strata.operators.merge import value_changed


def rules():
    return {"update_cols": ["v"], "condition": value_changed("v"), "on_update": {"b": F.lit(2)}}


def files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def table(spark, path):
    return {r["k"]: (r["v"], r["b"]) for r in B.read_buckets(spark, path).collect()}


@pytest.fixture()
def target(spark, scratch):
    path = f"{scratch}/t"
    B.write_buckets(spark.range(100_000).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v"),
                                                F.lit(1).alias("b")), path, ["k"])
    return path


def batch(spark, rows):
    return spark.createDataFrame([(k, v, 2) for k, v in rows], "k long, v double, b int")


def test_few_rows_rewrite_few_buckets(spark, target):
    before, want = files(target), table(spark, target)
    rows = [(k * 1000, 0.5) for k in range(8)] + [(500_000, 7.0), (70, 70.0), (71, None)]
    counts = B.merge_into(spark, target, batch(spark, rows), ["k"], **rules())
    assert counts == {"update": 8, "keep": 2, "insert": 1}
    new = files(target) - before
    assert before <= files(target)
    changed = spark.createDataFrame([(k,) for k, _ in rows[:9]], "k long").select(B.bucket_of(["k"], 64)).collect()
    assert {os.path.basename(os.path.dirname(f)) for f in new} == {f"bucket_of_64={r[0]}" for r in changed}
    want.update({k: (v, 2) for k, v in rows[:9]})
    assert table(spark, target) == want


def test_a_rerun_writes_nothing(spark, target):
    rows = batch(spark, [(1, 2.0), (200_000, 3.0)])
    B.merge_into(spark, target, rows, ["k"], **rules())
    before = files(target)
    assert B.merge_into(spark, target, rows, ["k"], **rules()) == {"keep": 2}
    assert files(target) == before


def test_untouched_buckets_are_not_scanned(spark, target):
    rows = batch(spark, [(1, 2.0)])
    made, folders = B._folders(spark, target)
    rows = rows.withColumn("bucket_of_64", B.bucket_of(["k"], made))
    part = B._matched(spark, folders, rows, ["k"], "bucket_of_64")
    bucket = rows.first()["bucket_of_64"]
    assert all(f"bucket_of_64={bucket}/" in f for f in part.inputFiles())


def test_older_readers_and_lost_runs(spark, target):
    old = B.read_buckets(spark, target)
    B.merge_into(spark, target, batch(spark, [(1, 2.0)]), ["k"], **rules())
    assert old.where("k = 1").first()["v"] == 1.0  # what a reader holds is not overwritten
    os.makedirs(f"{target}/v000003/bucket_of_64=0")  # a run that was lost before its record
    assert table(spark, target)[1] == (2.0, 2)
    B.merge_into(spark, target, batch(spark, [(2, 9.0)]), ["k"], **rules())
    assert table(spark, target)[2] == (9.0, 2)
    assert B.drop_superseded(spark, target, keep=1) == 2
    assert len(table(spark, target)) == 100_000


def test_random_batches_against_a_plain_merge(spark, scratch):
    draw, path, want = random.Random(3), f"{scratch}/r", {}
    for _ in range(3):
        rows = {draw.randrange(40): draw.choice([None, 1.0, 2.0]) for _ in range(20)}
        B.merge_into(spark, path, batch(spark, rows.items()), ["k"], buckets=4, **rules())
        for k, v in rows.items():
            if k not in want:
                want[k] = (v, 2)
            elif want[k][0] is None or (v is not None and v != want[k][0]):
                want[k] = (v, 2)
        assert table(spark, path) == want


def test_bad_batches_raise(spark, target):
    with pytest.raises(ValueError, match="duplicate merge keys"):
        B.merge_into(spark, target, batch(spark, [(1, 1.0), (1, 2.0)]), ["k"])
    with pytest.raises(ValueError, match="null merge key"):
        B.merge_into(spark, target, batch(spark, [(None, 1.0)]), ["k"])
    assert B.merge_into(spark, target, batch(spark, [(5, 1.5), (5, 2.5)]), ["k"], duplicates="last", dedup_order=["v"],
                        update_cols=["v"]) == {"update": 1}
    assert table(spark, target)[5] == (2.5, 1)
    assert B.merge_into(spark, target, batch(spark, []), ["k"]) == {}
    with pytest.raises(ValueError, match="there already"):
        B.write_buckets(spark.range(1).select(F.col("id").alias("k")), target, ["k"])
