"""Rows along the curve: same rows, and files that filters on either key can skip."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import layout as L
from strata.sources.sinks import write_table


def test_interleaved_bits(spark):
    rows = [(a, b) for a in range(8) for b in range(8)]
    got = spark.createDataFrame(rows, "a int, b int").select(
        "a", "b", L.interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect()
    for a, b, z in got:
        assert z == int("".join(f"{a:03b}"[i] + f"{b:03b}"[i] for i in range(3)), 2)


def test_ranks_follow_the_order(spark):
    rows = [(i, f"k{i % 97:02d}", dt.date(2020, 1, 1) + dt.timedelta(days=i % 300), i / 7) for i in range(3000)]
    df = spark.createDataFrame([*rows, (None, None, None, None)], "n int, s string, d date, x double")
    ends = L.bounds(df, ["n", "s", "d", "x"], 3)
    assert all(1 <= len(e) <= 8 and e == sorted(set(e)) for e in ends.values())
    got = df.select(*[F.struct(k, L.rank(F.col(k), ends[k]).alias("r")).alias(k) for k in ends]).collect()
    for k, e in ends.items():
        for row in got:
            value, r = row[k]
            assert r == (0 if value is None else sum(b < value for b in e))
        assert len({row[k]["r"] for row in got}) >= 8


def test_values_by_hash_when_there_are_many(spark):
    df = spark.range(40_000).select(F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("s"))
    ends = L.bounds(df, ["s"], 4)["s"]
    sizes = [r["count"] for r in df.groupBy(L.rank(F.col("s"), ends)).count().collect()]
    assert len(sizes) >= 16 and max(sizes) < 2 * 40_000 / 16


@pytest.fixture()
def points(spark):
    draw = random.Random(1)
    return spark.createDataFrame([(i, draw.random(), f"{draw.randrange(10 ** 6):06d}") for i in range(20_000)],
                                 "id int, x double, y string")


def test_either_key_skips_files(spark, scratch, points):
    L.along_curve(points, ["x", "y"], files=64).write.parquet(f"{scratch}/z")
    points.repartitionByRange(64, "x", "y").write.parquet(f"{scratch}/plain")
    z, plain = spark.read.parquet(f"{scratch}/z"), spark.read.parquet(f"{scratch}/plain")
    assert sorted(map(tuple, z.collect())) == sorted(map(tuple, points.collect()))
    assert L.share_read(plain, "y", "400000", "410000") > 0.9  # sorted by x alone, nothing can be skipped
    assert L.share_read(z, "y", "400000", "410000") < 0.35
    assert L.share_read(z, "x", 0.4, 0.41) < 0.35


def test_writes_of_several_keys_and_odd_rows(spark, scratch, points):
    odd = points.limit(5).unionByName(spark.createDataFrame([(None, None, None), (1, float("nan"), "")], points.schema))
    write_table(odd, f"{scratch}/t", cluster_by=["x", "y"])
    assert spark.read.parquet(f"{scratch}/t").count() == 7
    write_table(points.limit(0), f"{scratch}/none", cluster_by=["x", "y"])
    assert spark.read.parquet(f"{scratch}/none").count() == 0
    only_keys = points.select("x", "y").withColumn("y", F.lit("a"))
    write_table(only_keys, f"{scratch}/keys", cluster_by=["x", "y"])
    assert spark.read.parquet(f"{scratch}/keys").count() == 20_000
