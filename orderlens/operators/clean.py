"""Cleaning (P1-P17, A8): sentinels -> imputation -> flags -> day counts -> sizes.

Plan shape: one aggregation job for the two global medians (exact; Spark's
percentile aggregate keeps a value->count map, so with integer day counts it
is a small histogram that combines map-side), then a single narrow
projection.  No UDF: every rule is a native expression, so the projection
stays inside whole-stage codegen and fuses with the scan.

Median semantics: the median of day differences may be a half day.  The
original adds that timedelta to a date, so

* imputed delivery date  = order_date + floor(m)      (date part)
* days_to_delivery        = floor(m)
* imputed date of birth   = reg_date - ceil(m)         (date part)
* age (imputed rows)      = datediff(order, reg) + floor(m)

which is exactly what the timestamp arithmetic yields, kept in integer days.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import colors, sizes
from ..sources.scan import NA_VALUES, apply_sentinels

# fixed value: birth years up to this one are implausible
DOB_MIN_YEAR = 1926

CLEAN_COLUMNS = [
    "color", "is_na_delivery_date", "is_dob_missing", "is_item_pants", "is_item_underwear",
    "is_letter_coded", "is_item_clothes", "days_to_delivery", "user_tenure", "age", "month",
    "delivery_thu", "delivery_fri", "age2", "user_tenure2", "item_price2", "item_size_cl",
]


@dataclass(frozen=True)
class CleanParams:
    """Fitted scalars of the cleaning step (global medians, in days)."""

    median_delivery_days: float | None
    median_dob_days: float | None


def plausible_dob(col: Column) -> Column:
    """Birth dates in or before 1926 become null."""
    return F.when(F.year(col) <= DOB_MIN_YEAR, F.lit(None).cast("date")).otherwise(col)


def median_columns() -> list[Column]:
    return [
        F.median(F.datediff("delivery_date", "order_date")).alias("median_delivery_days"),
        F.median(F.datediff(F.col("user_reg_date"), plausible_dob(F.col("user_dob")))).alias("median_dob_days"),
    ]


def fit_medians(df: DataFrame) -> CleanParams:
    """The two global medians (one small aggregation job; result is a 1-row scalar)."""
    row = df.agg(*median_columns()).first()
    return CleanParams(row["median_delivery_days"], row["median_dob_days"])


def _floor(x: float | None):
    return None if x is None or math.isnan(x) else int(math.floor(x))


def _ceil(x: float | None):
    return None if x is None or math.isnan(x) else int(math.ceil(x))


def _per_file(params, fn, attr):
    """A literal, or -- with (labelled, unlabelled) params -- a choice by label presence."""
    if isinstance(params, CleanParams):
        return F.lit(fn(getattr(params, attr))).cast("int")
    pk, pu = params
    return (F.when(F.col("return").isNotNull(), F.lit(fn(getattr(pk, attr))))
             .otherwise(F.lit(fn(getattr(pu, attr))))).cast("int")


def clean_with(df: DataFrame, params) -> DataFrame:
    """P1-P17 as one projection, given fitted medians (stream-safe: no aggregation).

    ``params`` is one ``CleanParams`` or a (labelled, unlabelled) pair, which
    cleans both files in one pass with each file's own medians.
    """
    fl_del = _per_file(params, _floor, "median_delivery_days")
    fl_dob = _per_file(params, _floor, "median_dob_days")
    ce_dob = _per_file(params, _ceil, "median_dob_days")

    order = F.col("order_date")
    reg = F.col("user_reg_date")
    na_del = F.col("delivery_date").isNull()
    delivery = F.when(na_del, F.date_add(order, fl_del)).otherwise(F.col("delivery_date"))
    dob0 = plausible_dob(F.col("user_dob"))
    dob_missing = dob0.isNull()
    dob = F.when(dob_missing, F.date_sub(reg, ce_dob)).otherwise(dob0)

    days = F.when(na_del, fl_del).otherwise(F.datediff(F.col("delivery_date"), order)).cast("long")
    tenure_raw = F.datediff(order, reg).cast("long")
    tenure = F.when(tenure_raw < 0, F.lit(0).cast("long")).otherwise(tenure_raw)
    age = F.when(dob_missing, F.datediff(order, reg) + fl_dob).otherwise(F.datediff(order, dob0)).cast("long")
    size = F.col("item_size")
    price = F.col("item_price")

    # the normalised size and its numeric value are computed once, in their own projection;
    # the optimizer does not inline a non-trivial expression that is used many times, so
    # the 30-branch bucket CASE below compares a column, not a regex chain.
    df = df.withColumn("__size_norm", sizes.normalised_size(F.col("item_size")))
    df = df.withColumn("__size_num", sizes.numeric_size(F.col("__size_norm")))
    base = [F.col(f"`{c}`") for c in df.columns if c not in ("delivery_date", "user_dob", "__size_norm", "__size_num")]
    out = df.select(
        *base,
        delivery.alias("delivery_date"),
        dob.alias("user_dob"),
        colors.color_family(F.col("item_color")).alias("color"),
        na_del.alias("is_na_delivery_date"),
        dob_missing.alias("is_dob_missing"),
        sizes.is_pants(size).alias("is_item_pants"),
        sizes.is_underwear(size).alias("is_item_underwear"),
        sizes.is_letter_coded(size).alias("is_letter_coded"),
        sizes.is_clothes(size).alias("is_item_clothes"),
        days.alias("days_to_delivery"),
        tenure.alias("user_tenure"),
        age.alias("age"),
        F.month(delivery).cast("long").alias("month"),
        (F.weekday(delivery) == 4).alias("delivery_thu"),
        (F.weekday(delivery) == 5).alias("delivery_fri"),
        (age * age).alias("age2"),
        (tenure * tenure).alias("user_tenure2"),
        (price * price).alias("item_price2"),
        sizes.size_bucket(F.col("__size_norm"), F.col("__size_num")).alias("item_size_cl"),
    )
    # restore the raw column order, derived columns after it
    raw_order = [c for c in df.columns if not c.startswith("__size")]
    return out.select(*[F.col(f"`{c}`") for c in raw_order + CLEAN_COLUMNS])


def clean(df: DataFrame, na_values=NA_VALUES, params: CleanParams | None = None) -> DataFrame:
    """Sentinels -> (fit medians) -> cleaned table.  ``df`` is a raw order-item table."""
    raw = apply_sentinels(df, na_values)
    if params is None:
        params = fit_medians(raw)
    return clean_with(raw, params)


def clean_split(raw: DataFrame, na_values=NA_VALUES) -> tuple[DataFrame, DataFrame]:
    """Clean the labelled and the unlabelled part separately (each with its own medians).

    This mirrors cleaning two input files, one with labels and one without.
    """
    s = apply_sentinels(raw, na_values)
    # both files' medians in one aggregation job
    rows = {r["is_known"]: r for r in
            s.groupBy(F.col("return").isNotNull().alias("is_known")).agg(*median_columns()).collect()}

    def params(flag):
        r = rows.get(flag)
        return CleanParams(r["median_delivery_days"], r["median_dob_days"]) if r else CleanParams(None, None)

    known = clean_with(s.filter(F.col("return").isNotNull()), params(True))
    unknown = clean_with(s.filter(F.col("return").isNull()), params(False))
    return known, unknown


def history_params(s: DataFrame) -> tuple[CleanParams, CleanParams]:
    """The medians of the labelled and of the unlabelled rows (sentinels are null), one job."""
    rows = {r["is_known"]: r for r in
            s.groupBy(F.col("return").isNotNull().alias("is_known")).agg(*median_columns()).collect()}

    def params(flag):
        r = rows.get(flag)
        return CleanParams(r["median_delivery_days"], r["median_dob_days"]) if r else CleanParams(None, None)

    return params(True), params(False)


def clean_history(raw: DataFrame, na_values=NA_VALUES, params: tuple[CleanParams, CleanParams] | None = None) -> DataFrame:
    """Both files cleaned in ONE pass over the raw rows (each row with its own file's medians).

    Equal to ``history(*clean_split(raw))`` but the upstream scan / joins run
    once instead of once per file.
    """
    s = apply_sentinels(raw, na_values)
    return clean_with(s, params or history_params(s))


def history(known: DataFrame, unknown: DataFrame) -> DataFrame:
    """Bag union by name; a missing label column becomes null."""
    return known.unionByName(unknown, allowMissingColumns=True)
