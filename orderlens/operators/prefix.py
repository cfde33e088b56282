"""Prefix sums over a sorted value histogram, without a task that holds a whole key.

A histogram (key columns, value, weights) is range-partitioned by key and value and written with its
range number.  Weights are summed a range, the ranges' totals are summed up in order (a row a key
and range, a number bounded by the partitions), and inside each range a window finishes the sum.  A
key with all rows -- or a table with one key -- is spread over all ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def below(hist: DataFrame, keys: list[str], value: str, weights: list[str]) -> DataFrame:
    """``hist`` with ``below_<w>`` for each weight: its sum over the key's rows of smaller value.
    (key, value) must be unique."""
    spark = hist.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = materialize(hist.repartitionByRange(n, *keys, value).withColumn("__part", F.spark_partition_id()), "histogram")
    sums = parts.groupBy(*keys, "__part").agg(*[F.sum(w).alias(f"__s_{w}") for w in weights])
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "__part", *[F.coalesce(F.sum(f"__s_{w}").over(before), F.lit(0)).alias(f"__o_{w}") for w in weights])
    match = [parts["__part"] == offsets["__part"], *[parts[k].eqNullSafe(offsets[k]) for k in keys]]
    on = match[0]
    for m in match[1:]:
        on = on & m
    joined = parts.join(offsets, on, "inner").select(parts["*"], *[offsets[f"__o_{w}"] for w in weights])
    inside = Window.partitionBy(*keys, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    cols = [(F.col(f"__o_{w}") + F.coalesce(F.sum(w).over(inside), F.lit(0))).alias(f"below_{w}") for w in weights]
    return joined.select(*hist.columns, *cols)


def quantile_columns(q: float, name: str, value: Column, n: Column, first: Column, count: Column) -> list[Column]:
    """Aggregates for the q-quantile of sorted rows that hold ranks ``first .. first + count - 1`` of n:
    the values at the ranks below and above q * (n - 1); ``interpolated`` joins them."""
    at = F.lit(float(q)) * (n - 1)
    holds = lambda rank: (first <= rank) & (rank < first + count)
    return [F.max(F.when(holds(F.floor(at)), value)).alias(f"__lo_{name}"),
            F.max(F.when(holds(F.ceil(at)), value)).alias(f"__hi_{name}"),
            F.max(at - F.floor(at)).alias(f"__fr_{name}")]


def interpolated(name: str) -> Column:
    lo, hi, part = (F.col(f"__{p}_{name}") for p in ("lo", "hi", "fr"))
    return (lo + (hi - lo) * part).alias(name)
