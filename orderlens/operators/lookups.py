"""Fitted lookup tables.

Every table is a grouped aggregate over the fit data, keyed by 1-3 columns.
Plans are plain ``groupBy().agg()`` (partial aggregation before the shuffle,
so a hot key costs one combined row per map task, never a hot task), plus
per-user windows over *baskets* (a user's baskets are bounded by the number
of distinct order dates, so even a user holding a third of all rows yields a
small window partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import prefix as P

TARGET = "return"

ITEM_COLS = ["item_max_delivery", "item_mean_delivery", "item_min_delivery", "item_orders", "item_max_price"]
BASKET_COLS = ["order_num_items", "order_max_price", "order_total_value", "order_median_price",
               "order_min_price", "order_num_sizes", "order_num_colors"]
ORDER_COLS = BASKET_COLS + ["order_seqnum", "order_num_brand_id"]
BRAND_COLS = ["brand_min_price", "brand_mean_price", "brand_max_price"]
STATE_COLS = ["state_mean_delivery", "state_max_delivery"]
HISTORY_COLS = ["history", "history_cumsum", "history_perc"]
WOE_VARS = ["item_color", "month", "item_size"]


def money_sum(c: str) -> Column:
    """Exact sum of a money column (DECIMAL accumulation, DOUBLE result): order-independent."""
    return F.sum(F.col(c).cast("decimal(38,6)")).cast("double")


def _nunique(c: str) -> Column:
    # exact distinct count without an Expand: the set is bounded by the distinct values in one basket
    return F.size(F.collect_set(F.col(c)))


# ------------------------------------------------------------------ A1: WOE

def fit_woe(labelled: DataFrame, var: str, target: str = TARGET) -> DataFrame:
    """A1: ``ln((ev/EV) / (nev/NEV))`` per category; zero counts -> 0.5; totals unsmoothed.

    Totals are over all labelled rows (including rows whose category is
    null) and enter as two numbers; null categories get no row.
    """
    totals = labelled.agg(F.sum(F.col(target)).cast("double"), F.count(F.lit(1)).cast("double")).first()
    events, rows = totals[0], totals[1]
    per = (labelled.filter(F.col(var).isNotNull())
           .groupBy(var)
           .agg(F.sum(F.col(target)).cast("double").alias("_ev"),
                F.count(F.col(target)).cast("double").alias("_cnt")))
    ev = F.when(F.col("_ev") == 0, F.lit(0.5)).otherwise(F.col("_ev"))
    nev_raw = F.col("_cnt") - F.col("_ev")
    nev = F.when(nev_raw == 0, F.lit(0.5)).otherwise(nev_raw)
    total, rest = F.lit(events).cast("double"), F.lit(None if events is None else rows - events).cast("double")
    woe = F.log(F.try_divide(F.try_divide(ev, total), F.try_divide(nev, rest)))
    return per.select(F.col(var), woe.alias(f"woe_{var}"))


# ------------------------------------------------------------------ A2-A6

def fit_items(features: DataFrame) -> DataFrame:
    """A2: per item -- max/mean/min days to delivery, number of rows with a user, max price."""
    return features.groupBy("item_id").agg(
        F.max("days_to_delivery").alias("item_max_delivery"),
        F.avg("days_to_delivery").alias("item_mean_delivery"),
        F.min("days_to_delivery").alias("item_min_delivery"),
        F.count("user_id").alias("item_orders"),
        F.max("item_price").alias("item_max_price"))


def fit_baskets(features: DataFrame) -> DataFrame:
    """A3: per basket (user, order date) -- counts, price max/sum/median/min, distinct sizes / colours."""
    return features.groupBy("user_id", "order_date").agg(
        F.count("item_id").alias("order_num_items"),
        F.max("item_price").alias("order_max_price"),
        money_sum("item_price").alias("order_total_value"),
        F.median("item_price").alias("order_median_price"),
        F.min("item_price").alias("order_min_price"),
        _nunique("item_size").cast("long").alias("order_num_sizes"),
        _nunique("item_color").cast("long").alias("order_num_colors"))


def with_seqnum(baskets: DataFrame, out: str = "order_seqnum") -> DataFrame:
    """Dense rank of the order date within the user's baskets."""
    w = Window.partitionBy("user_id").orderBy("order_date")
    return baskets.withColumn(out, F.dense_rank().over(w).cast("long"))


def fit_brand_counts(features: DataFrame) -> DataFrame:
    """A4: rows per (user, order date, brand)."""
    return (features.filter(F.col("brand_id").isNotNull())
            .groupBy("user_id", "order_date", "brand_id")
            .agg(F.count(F.lit(1)).alias("order_num_brand_id")))


def fit_orders(features: DataFrame) -> DataFrame:
    """A3 + W1 + A4/J7: basket stats fanned out to one row per brand in the basket."""
    baskets = with_seqnum(fit_baskets(features))
    return baskets.join(fit_brand_counts(features), ["user_id", "order_date"], "left")


def fit_brands(features: DataFrame) -> DataFrame:
    """A5: per brand -- min/mean/max price."""
    return features.groupBy("brand_id").agg(
        F.min("item_price").alias("brand_min_price"),
        (money_sum("item_price") / F.count("item_price")).alias("brand_mean_price"),
        F.max("item_price").alias("brand_max_price"))


def fit_states(features: DataFrame) -> DataFrame:
    """Per state -- mean/max days to delivery (null state: no row)."""
    return (features.filter(F.col("user_state").isNotNull())
            .groupBy("user_state").agg(
                F.avg("days_to_delivery").alias("state_mean_delivery"),
                F.max("days_to_delivery").alias("state_max_delivery")))


# ------------------------------------------------------------------ A7, W2-W5

def fit_return_history(features: DataFrame, target: str = TARGET) -> DataFrame:
    """A7 + W2-W5: per labelled basket, the return flag of the *previous* basket and its running share.

    ``history`` = max(return) of the user's previous labelled basket (0 for the
    first), ``history_cumsum`` its running sum, ``history_perc`` the running
    sum over the labelled-basket sequence number.  A basket never sees its own
    label, so there is no target leak.
    """
    b = (features.filter(F.col(target).isNotNull())
         .groupBy("user_id", "order_date")
         .agg(F.max(target).alias("_ret")))
    w = Window.partitionBy("user_id").orderBy("order_date")
    hist = F.coalesce(F.lag("_ret", 1).over(w), F.lit(0)).cast("double")
    b = b.withColumn("history", hist).withColumn("_seq", F.dense_rank().over(w))
    b = b.withColumn("history_cumsum",
                     F.sum("history").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    b = b.withColumn("history_perc", F.col("history_cumsum") / F.col("_seq"))
    return b.select("user_id", "order_date", *HISTORY_COLS)


# ------------------------------------------------------------------ A9-A11

def price_quantiles(features: DataFrame) -> DataFrame:
    """Quartiles of the item price, linear interpolation, exact: ranks come from prefix sums over
    the price histogram, so no task holds all distinct prices."""
    hist = (features.filter(F.col("item_price").isNotNull()).groupBy("item_price").agg(F.count(F.lit(1)).alias("c")))
    ranked = P.below(hist, [], "item_price", ["c"])
    n = F.lit(ranked.agg(F.sum("c")).first()[0])
    names = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    aggs = [a for k, q in names.items() for a in P.quantile_columns(q, k, F.col("item_price"), n, F.col("below_c"), F.col("c"))]
    return ranked.agg(*aggs).select(*[P.interpolated(k) for k in names])


def column_means(df: DataFrame, cols: list[str]) -> DataFrame:
    """A10: one-row frame of column means (imputation values)."""
    return df.agg(*[F.avg(c).alias(c) for c in cols])


def column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column -- is the minimum 0, does any null occur (one aggregation, then unpivoted)."""
    aggs = []
    for c in cols:
        aggs.append((F.min(F.col(f"`{c}`").cast("double")) == 0).alias(f"{c}__min0"))
        aggs.append((F.count_if(F.col(f"`{c}`").isNull()) > 0).alias(f"{c}__nulls"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__min0`, `{c}__nulls`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, min_is_zero, has_nulls)")
