"""Deterministic splits and samples.

Row membership is a pure function of the row's key columns and a seed, so the
result does not depend on partitioning or on task retries (a lost executor
recomputes exactly the same rows).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed multipliers of the arithmetic split key (primes)
_M_ITEM, _M_USER, _M_DAY = 7919, 104729, 1299709


def split_key(seed: int = 0) -> Column:
    """An integer in [0, 100) from (item, user, order day); plain arithmetic so SQL engines can repeat it."""
    day = F.datediff(F.col("order_date"), F.lit("1970-01-01").cast("date")).cast("long")
    # each term is reduced before it is added: no overflow whatever the ids
    term = lambda c, m: F.pmod(_number(c), F.lit(100)) * (m % 100)
    raw = term("item_id", _M_ITEM) + term("user_id", _M_USER) + F.pmod(day, F.lit(100)) * (_M_DAY % 100) + seed
    return F.pmod(raw, F.lit(100))


def _number(c: str) -> Column:
    """An id as a number: itself, or a hash of an id that is no number."""
    return F.coalesce(F.col(c).try_cast("long"), F.xxhash64(F.col(c).cast("string")))


def train_test_label(train_pct: int = 80, seed: int = 0) -> Column:
    """T7: 'train' for the first ``train_pct`` percent of the key space, else 'test'."""
    return F.when(split_key(seed) < train_pct, F.lit("train")).otherwise(F.lit("test"))


def hash_fraction(keys: list[str], seed: int) -> Column:
    """A uniform value in [0, 1) from a 64-bit hash of the key columns and a seed."""
    h = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    return F.pmod(h, F.lit(1 << 53)).cast("double") / float(1 << 53)


# ---- samples of an exact size --------------------------------------------------------------------

#: Bits by which the draw number is read at a time; a pass counts at most 2**16 values.
_DIGIT, _DIGITS = 1 << 16, 4


def draw_number(keys: list[str], seed: int) -> Column:
    """A number in [0, 2**60) from the keys' texts and a seed; by MD5, so SQL engines can repeat it."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _threshold(numbered: DataFrame, n: int) -> tuple[int, int, int]:
    """(t, less, equal): ``less`` < n rows have a number below t, and with the ``equal`` rows at t there are n
    or more.  Digit by digit, from the highest: counts of a digit's values, a prefix sum over them."""
    prefix, less, equal = 0, 0, 0
    for d in range(_DIGITS):
        width = _DIGIT ** (_DIGITS - 1 - d)
        inside = numbered.filter((F.col("__draw") >= prefix) & (F.col("__draw") < prefix + width * _DIGIT)) if d else numbered
        counts = sorted((r["digit"], r["count"]) for r in
                        inside.groupBy(F.expr(f"(__draw - {prefix}L) div {width}L").alias("digit")).count().collect())
        if not d and sum(c for _, c in counts) <= n:  # all rows
            return 1 << 60, n, 0
        for digit, equal in counts:
            if less + equal >= n:
                prefix += digit * width
                break
            less += equal
    return prefix, less, equal


def exact_sample(df: DataFrame, keys: list[str], n: int, seed: int) -> DataFrame:
    """T8 without replacement: ``df`` with ``copies``, 1 for exactly ``n`` rows (all, if there are no more) and else 0.

    The sample is the rows of the n smallest draw numbers, found by counting, not by sorting; only rows that
    share the last number (equal keys) are ranked among themselves."""
    if n <= 0:
        return df.withColumn("copies", F.lit(0))
    numbered = df.withColumn("__draw", draw_number(keys, seed))
    t, less, equal = _threshold(numbered, n)
    below = (F.col("__draw") < t).cast("int")
    if less + equal <= n:
        return numbered.withColumn("copies", (F.col("__draw") <= t).cast("int")).drop("__draw")
    tied = numbered.filter(F.col("__draw") == t)
    order = Window.partitionBy("__draw").orderBy(*[F.col(f"`{c}`") for c in tied.columns if _orderable(tied, c)])
    some = tied.withColumn("copies", (F.row_number().over(order) <= n - less).cast("int"))
    return numbered.filter(F.col("__draw") != t).withColumn("copies", below).unionByName(some).drop("__draw")


def _orderable(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() not in ("map", "variant", "udt")


def exact_bootstrap(df: DataFrame, keys: list[str], n: int, seed: int, rows_a_range: int = 20_000, rows_a_task: int = 200_000) -> DataFrame:
    """T8 with replacement: ``df`` with ``copies``, how often a row is among exactly ``n`` uniform draws.

    Rows are dealt to ranges of their draw numbers.  The draws are dealt to the ranges by conditional binomials, which
    gives the multinomial's parts; in a range each draw picks a rank.  The driver holds a count a range.  Tasks that rank
    and join hold some ``rows_a_task`` rows each, however many rows there are and whatever the session's partitions."""
    import numpy as np
    spark = df.sparkSession
    total = df.count()
    if not total:
        return df.withColumn("copies", F.lit(0))
    ranges = min(1 << 16, -(-total // rows_a_range))
    numbered = (df.withColumn("__draw", draw_number(keys, seed))
                .withColumn("__range", F.pmod(F.col("__draw"), F.lit(ranges)).cast("int")))
    sizes = sorted((r["__range"], r["count"]) for r in numbered.groupBy("__range").count().collect())
    rng, left, rows, dealt = np.random.default_rng([seed & 0xFFFFFFFF, 1]), n, total, []
    for r, size in sizes:
        draws = int(rng.binomial(left, size / rows)) if left else 0
        left, rows = left - draws, rows - size
        dealt.append((r, size, draws))

    def ranks(batches):
        import pandas as pd
        for b in batches:
            for r, size, draws in zip(b["r"], b["size"], b["draws"]):
                picks = np.random.default_rng([seed & 0xFFFFFFFF, 2, r]).integers(0, size, draws)
                rank, copies = np.unique(picks, return_counts=True)
                yield pd.DataFrame({"__range": np.full(len(rank), r, np.int32), "__rank": rank + 1, "copies": copies.astype(np.int32)})

    table = spark.createDataFrame(dealt, "r int, size long, draws long")
    parts = -(-total // rows_a_task)
    spread = lambda d, *by: d if parts <= int(spark.conf.get("spark.sql.shuffle.partitions")) else d.repartition(parts, *by)
    picked = spread(table.repartition(max(1, min(len(dealt), 200)), "r").mapInPandas(ranks, "__range int, __rank long, copies int"), "__range", "__rank")
    order = Window.partitionBy("__range").orderBy("__draw", *[F.col(f"`{c}`") for c in df.columns if _orderable(df, c)])
    ranked = spread(spread(numbered, "__range").withColumn("__rank", F.row_number().over(order).cast("long")), "__range", "__rank")
    return (ranked.join(picked, ["__range", "__rank"], "left").withColumn("copies", F.coalesce("copies", F.lit(0)))
            .drop("__draw", "__range", "__rank"))


def subsample(df: DataFrame, keys: list[str], fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """A sample of ``int(fraction * rows)`` rows without replacement, and its out-of-bag complement."""
    out = exact_sample(df, keys, int(fraction * df.count()), seed)
    return out.filter("copies = 1").drop("copies"), out.filter("copies = 0").drop("copies")


def bootstrap(df: DataFrame, keys: list[str], seed: int, fraction: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """T8 with replacement: ``int(fraction * rows)`` draws, a row as often as it was drawn; rows never drawn are
    the out-of-bag set."""
    out = exact_bootstrap(df, keys, int(fraction * df.count()), seed)
    inbag = (out.filter("copies > 0").withColumn("__rep", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "__rep"))
    return inbag, out.filter("copies = 0").drop("copies")


def poisson_one(keys: list[str], seed: int) -> Column:
    """A Poisson(1) draw from a 64-bit hash: the number of steps of the distribution function at or
    below a uniform value.  The steps end where a double cannot tell them from 1."""
    u = hash_fraction(keys, seed)
    steps, below, term, k = [], 0.0, math.exp(-1.0), 0
    while below + term > below and below + term < 1.0:
        below += term
        steps.append(below)
        k += 1
        term /= k
    return F.size(F.filter(F.array(*[F.lit(x) for x in steps]), lambda x: x <= u))
