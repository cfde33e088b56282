"""Samples of an exact size: counts, ties, repeatability, distribution."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.operators import split


def number(key, seed):
    return int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("n", [0, 1, 37, 500, 1999, 2000, 5000])
def test_exact_sample_is_the_smallest_numbers(spark, n):
    df = spark.range(2000).repartition(7)
    got = {r.id: r.copies for r in split.exact_sample(df, ["id"], n, 5).collect()}
    want = set(sorted(range(2000), key=lambda i: number(i, 5))[:n])
    assert {i for i, c in got.items() if c} == want and len(got) == 2000


def test_ties_still_give_the_exact_size(spark):
    df = spark.range(900).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))   # three keys, 300 rows each
    for n in (1, 299, 300, 301, 650, 900):
        out = split.exact_sample(df, ["k"], n, 1)
        assert out.count() == 900 and out.agg(F.sum("copies")).first()[0] == n
    same = spark.createDataFrame([(1, None)] * 10, "k int, v string")
    assert split.exact_sample(same, ["k", "v"], 4, 1).agg(F.sum("copies")).first()[0] == 4


@pytest.mark.parametrize("n,width", [(1000, 150), (3000, 20_000), (1, 100), (0, 100)])
def test_exact_bootstrap_counts(spark, n, width):
    df = spark.range(3000).repartition(5)
    out = split.exact_bootstrap(df, ["id"], n, 3, width)
    got = {r.id: r.copies for r in out.collect()}
    assert len(got) == 3000 and sum(got.values()) == n
    again = split.exact_bootstrap(df.repartition(2), ["id"], n, 3, width)
    assert got == {r.id: r.copies for r in again.collect()}                              # partitions do not matter


def test_bootstrap_is_uniform(spark):
    df = spark.range(500)
    total = np.zeros(500)
    for seed in range(12):
        for r in split.exact_bootstrap(df, ["id"], 1000, seed, 60).collect():
            total[r.id] += r.copies
    # 12 x 1000 draws over 500 rows: 24 each, with a variance of about 24
    assert total.sum() == 12_000 and 15 < total.var() < 35 and total.max() < 50
    inbag, out = split.bootstrap(df, ["id"], 1)
    assert inbag.count() == 500 and 130 < out.count() < 235                              # about 500 / e rows are never drawn


def test_subsample_and_its_complement(spark):
    df = spark.range(1001)
    a, b = split.subsample(df, ["id"], 0.3, 9)
    assert (a.count(), b.count()) == (300, 701) and a.join(b, "id").count() == 0
    assert split.subsample(df.limit(0), ["id"], 0.3, 9)[0].count() == 0
    assert split.exact_bootstrap(df.limit(0), ["id"], 5, 9).count() == 0


def test_bootstrap_tasks_are_bounded_by_rows(spark):
    """However few partitions the session has, no task ranks and joins all rows; the draws do not depend on it."""
    df = spark.range(3000).select(F.col("id").cast("string").alias("id"))
    out = split.exact_bootstrap(df, ["id"], 1500, 3, 50, rows_a_task=100)
    assert max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()) <= 300
    assert sorted(out.collect()) == sorted(split.exact_bootstrap(df, ["id"], 1500, 3, 50).collect())
