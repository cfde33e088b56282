"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracles.

Every query reads the driver tables of ``sf_dir`` in full (through the
adapter) and returns a lazy DataFrame.  Computed columns carry the same
names in the Spark result and in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as cl
from . import sql as S
from .context import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


def round_sig(c, digits: int = 12):
    """Round to ``digits`` significant digits (for large magnitudes where fixed decimals exceed precision)."""
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, c).otherwise(F.round(c / p, digits - 1) * p)


def round_sig_sql(x: str, digits: int = 12) -> str:
    p = f"pow(10.0, floor(log10(abs({x}))))"
    return f"CASE WHEN {x} = 0 THEN {x} ELSE round({x} / {p}, {digits - 1}) * {p} END"


# ---------------------------------------------------------------- cleaning (L1)

_RAW_OUT = ["order_date", "delivery_date", "item_id", "item_size", "item_color", "brand_id",
            "item_price", "user_id", "user_title", "user_dob", "user_state", "user_reg_date", "return"]


@register("scan_sentinels", S.with_ctes(
    "SELECT " + ", ".join('"return"' if c == "return" else c for c in _RAW_OUT) + " FROM sent"))
def scan_sentinels(spark, sf_dir):
    """Every sentinel cell becomes null (all string / date columns)."""
    return inputs(spark, sf_dir).sentinel.select(*_RAW_OUT)


@register("color_family", S.with_ctes(
    "SELECT item_color, color, count(*) AS n FROM history GROUP BY item_color, color"))
def color_family(spark, sf_dir):
    """Colour -> family, default ``other``."""
    return inputs(spark, sf_dir).history.groupBy("item_color", "color").agg(F.count(F.lit(1)).alias("n"))


@register("color_json", S.with_ctes(
    "SELECT item_color, color, count(*) AS n FROM history GROUP BY item_color, color"))
def color_json(spark, sf_dir):
    """The colour map read from a JSON file and joined to the rows."""
    import json
    import uuid

    from ..functions import colors
    from ..session import scratch_path
    path = scratch_path(spark, f"colors-{uuid.uuid4().hex}")
    spark.createDataFrame([(json.dumps(colors.COLOR_FAMILIES, indent=1),)], "value string").write.text(path)
    rows = colors.with_color_family(inputs(spark, sf_dir).history, colors.read_color_map(spark, path))
    return rows.groupBy("item_color", "color").agg(F.count(F.lit(1)).alias("n"))


_NUMERIC = ["item_price", "return", "is_na_delivery_date", "is_dob_missing", "is_item_pants", "is_item_underwear", "is_letter_coded",
            "is_item_clothes", "days_to_delivery", "user_tenure", "age", "month", "delivery_thu", "delivery_fri", "age2", "item_price2"]


@register("numeric_projection", S.with_ctes(" UNION ALL ".join(
    f"(SELECT '{c}' AS column_name, {round_sig_sql(f'sum(CAST({chr(34)}{c}{chr(34)} AS DOUBLE))', 9)} AS total FROM known)"
    for c in _NUMERIC)))
def numeric_projection(spark, sf_dir):
    """The number and flag columns of the cleaned table by their types, without a drop-list; a sum each."""
    from ..operators import features as FT
    rows = FT.numeric_only(FT.drop_columns(inputs(spark, sf_dir).known, ["item_id", "user_id", "user_tenure2", "no_such_column"]))
    sums = rows.agg(*[round_sig(F.sum(F.col(f"`{c}`").cast("double")), 9).alias(c) for c in rows.columns])
    return sums.unpivot([], rows.columns, "column_name", "total")


@register("global_medians", S.with_ctes(
    "SELECT known_ AS is_known, m_del AS median_delivery_days, m_dob AS median_dob_days FROM med"))
def global_medians(spark, sf_dir):
    """The two global medians, per input file (labelled / unlabelled)."""
    s = inputs(spark, sf_dir).sentinel
    return s.groupBy(F.col("return").isNotNull().alias("is_known")).agg(*cl.median_columns())


@register("delivery_imputed", S.with_ctes(
    "SELECT order_date, delivery_date, is_na_delivery_date, days_to_delivery, month, "
    "delivery_thu, delivery_fri FROM history"))
def delivery_imputed(spark, sf_dir):
    """P2-P3 (+P12, P14): missing delivery dates imputed by the median offset."""
    return inputs(spark, sf_dir).history.select(
        "order_date", "delivery_date", "is_na_delivery_date", "days_to_delivery", "month",
        "delivery_thu", "delivery_fri")


@register("dob_imputed", S.with_ctes(
    "SELECT user_id, user_reg_date, user_dob, is_dob_missing, age, age2 FROM history"))
def dob_imputed(spark, sf_dir):
    """Implausible birth dates nulled, then imputed from the median gap."""
    return inputs(spark, sf_dir).history.select(
        "user_id", "user_reg_date", "user_dob", "is_dob_missing", "age", "age2")


@register("size_flags", S.with_ctes(
    "SELECT item_size, is_item_pants, is_item_underwear, is_letter_coded, is_item_clothes, "
    "count(*) AS n FROM history GROUP BY ALL"))
def size_flags(spark, sf_dir):
    """Regex flags on the raw size."""
    return (inputs(spark, sf_dir).history
            .groupBy("item_size", "is_item_pants", "is_item_underwear", "is_letter_coded", "is_item_clothes")
            .agg(F.count(F.lit(1)).alias("n")))


@register("day_diffs", S.with_ctes(
    "SELECT days_to_delivery, user_tenure, age, month, delivery_thu, delivery_fri, "
    "age2, user_tenure2, item_price2 FROM history"))
def day_diffs(spark, sf_dir):
    """Day differences, clamp, month, weekday flags, squares."""
    return inputs(spark, sf_dir).history.select(
        "days_to_delivery", "user_tenure", "age", "month", "delivery_thu", "delivery_fri",
        "age2", "user_tenure2", "item_price2")


@register("size_bucket", S.with_ctes(
    "SELECT item_size, item_size_cl, count(*) AS n FROM history GROUP BY item_size, item_size_cl"))
def size_bucket(spark, sf_dir):
    """Normalised size strings and numeric size buckets."""
    return inputs(spark, sf_dir).history.groupBy("item_size", "item_size_cl").agg(F.count(F.lit(1)).alias("n"))


@register("history_union", S.with_ctes(
    'SELECT "return", count(*) AS n, count(DISTINCT user_id) AS users FROM '
    '(SELECT "return", user_id FROM known UNION ALL SELECT NULL, user_id FROM unknown) GROUP BY 1'))
def history_union(spark, sf_dir):
    """Labelled ∪ unlabelled by name; the unlabelled side has no label column."""
    i = inputs(spark, sf_dir)
    h = cl.history(i.known, i.unknown.drop("return"))
    return h.groupBy("return").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


# ---------------------------------------------------------------- fitted tables (L2)

def _woe_query(var: str):
    def q(spark, sf_dir):
        from ..operators import lookups as L
        w = L.fit_woe(inputs(spark, sf_dir).known, var)
        return w.select(var, F.round(f"woe_{var}", 9).alias(f"woe_{var}"))
    q.__doc__ = f"A1: weight of evidence of ``{var}`` on labelled rows."
    return q


for _name, _var in (("woe_color", "item_color"), ("woe_month", "month"), ("woe_size", "item_size")):
    register(_name, S.with_fit(f"SELECT {_var}, round(woe_{_var}, 9) AS woe_{_var} FROM woe_{_var}_fit"))(
        _woe_query(_var))


@register("item_stats", S.with_fit(
    "SELECT item_id, item_max_delivery, round(item_mean_delivery, 6) AS item_mean_delivery, "
    "item_min_delivery, item_orders, item_max_price FROM items_fit"))
def item_stats(spark, sf_dir):
    """A2: per-item delivery and price statistics over all rows."""
    from ..operators import lookups as L
    t = L.fit_items(inputs(spark, sf_dir).history)
    return t.withColumn("item_mean_delivery", r6(F.col("item_mean_delivery")))


@register("order_stats", S.with_fit(
    "SELECT user_id, order_date, order_num_items, order_max_price, round(order_total_value, 6) AS order_total_value, "
    "round(order_median_price, 6) AS order_median_price, order_min_price, order_num_sizes, order_num_colors "
    "FROM baskets_fit"))
def order_stats(spark, sf_dir):
    """A3: basket statistics (exact median, exact distinct counts)."""
    from ..operators import lookups as L
    t = L.fit_baskets(inputs(spark, sf_dir).history)
    return (t.withColumn("order_total_value", r6(F.col("order_total_value")))
             .withColumn("order_median_price", r6(F.col("order_median_price"))))


@register("order_seqnum", S.with_fit("SELECT user_id, order_date, order_seqnum FROM baskets_seq"))
def order_seqnum(spark, sf_dir):
    """Dense rank of the basket date per user."""
    from ..operators import lookups as L
    b = inputs(spark, sf_dir).history.select("user_id", "order_date").distinct()
    return L.with_seqnum(b)


@register("order_brand_counts", S.with_fit(
    "SELECT user_id, order_date, brand_id, order_num_items, order_seqnum, order_num_brand_id FROM orders_fit"))
def order_brand_counts(spark, sf_dir):
    """Basket rows fanned out per brand with the brand's row count."""
    from ..operators import lookups as L
    return L.fit_orders(inputs(spark, sf_dir).history).select(
        "user_id", "order_date", "brand_id", "order_num_items", "order_seqnum", "order_num_brand_id")


@register("brand_stats", S.with_fit(
    "SELECT brand_id, brand_min_price, round(brand_mean_price, 6) AS brand_mean_price, brand_max_price FROM brands_fit"))
def brand_stats(spark, sf_dir):
    """A5: per-brand min / mean / max price."""
    from ..operators import lookups as L
    return L.fit_brands(inputs(spark, sf_dir).history).withColumn(
        "brand_mean_price", r6(F.col("brand_mean_price")))


@register("state_stats", S.with_fit(
    "SELECT user_state, round(state_mean_delivery, 6) AS state_mean_delivery, state_max_delivery FROM states_fit"))
def state_stats(spark, sf_dir):
    """Per-state mean / max days to delivery."""
    from ..operators import lookups as L
    return L.fit_states(inputs(spark, sf_dir).history).withColumn(
        "state_mean_delivery", r6(F.col("state_mean_delivery")))


@register("return_history", S.with_fit(
    "SELECT user_id, order_date, history, history_cumsum, round(history_perc, 6) AS history_perc FROM rethist_fit"))
def return_history(spark, sf_dir):
    """Lagged basket return flag, running sum and running share (no target leak)."""
    from ..operators import lookups as L
    return L.fit_return_history(inputs(spark, sf_dir).history).withColumn(
        "history_perc", r6(F.col("history_perc")))


@register("price_quantiles", S.with_fit(
    "SELECT round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3 FROM qs"))
def price_quantiles(spark, sf_dir):
    """Price quartiles with linear interpolation."""
    from ..operators import lookups as L
    q = L.price_quantiles(inputs(spark, sf_dir).history)
    return q.select(*[r6(F.col(c)).alias(c) for c in ("q1", "q2", "q3")])


# ---------------------------------------------------------------- transform (L2): joins + features

def _fitted_on_known(spark, sf_dir):
    """Spec fitted on the labelled file, applied to the unlabelled file (exercises every imputation)."""
    from ..operators import features as FT
    i = inputs(spark, sf_dir, materialize=True)
    return FT, FT.fit(i.known), i


def _rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


_ITEM = ["item_max_delivery", "item_mean_delivery", "item_min_delivery", "item_orders", "item_max_price"]
_ORD = ["order_num_items", "order_max_price", "order_total_value", "order_median_price", "order_min_price",
        "order_num_sizes", "order_num_colors", "order_seqnum", "order_num_brand_id"]
_BS = ["brand_min_price", "brand_mean_price", "brand_max_price", "state_mean_delivery", "state_max_delivery"]
_HIST = ["history", "history_cumsum", "history_perc"]
_WOE = ["woe_item_color", "woe_month", "woe_item_size"]


def _sel(cols, digits=6, keys=()):
    return ", ".join(list(keys) + [f"round(CAST({c} AS DOUBLE), {digits}) AS \"{c}\"" for c in cols])


@register("join_items", S.with_transform(f"SELECT {_sel(_ITEM, keys=['item_id'])} FROM featw"))
def join_items(spark, sf_dir):
    """Rows ⟕ item stats, unseen items imputed with the column means."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return _rounded(FT.transform(spec, i.unknown, _ITEM, keep=("item_id",)), _ITEM)


@register("join_orders", S.with_transform(
    f"SELECT {_sel(_ORD, keys=['user_id', 'order_date', 'brand_id'])} FROM featw"))
def join_orders(spark, sf_dir):
    """Rows ⟕ basket stats per brand; fixed 1 / fitted-mean imputation, brand count 0."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return _rounded(FT.transform(spec, i.unknown, _ORD, keep=("user_id", "order_date", "brand_id")), _ORD)


@register("join_brands_states", S.with_transform(
    f"SELECT {_sel(_BS, keys=['brand_id', 'user_state'])} FROM featw"))
def join_brands_states(spark, sf_dir):
    """Rows ⟕ brand stats ⟕ state stats, imputed with the means."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return _rounded(FT.transform(spec, i.unknown, _BS, keep=("brand_id", "user_state")), _BS)


@register("join_history", S.with_transform(
    f"SELECT {_sel(_HIST, keys=['user_id', 'order_date'])} FROM featw"))
def join_history(spark, sf_dir):
    """Rows ⟕ return history; baskets without labelled history get 0."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return _rounded(FT.transform(spec, i.unknown, _HIST, keep=("user_id", "order_date")), _HIST)


@register("join_woe", S.with_transform(
    f"SELECT {_sel(_WOE, digits=9, keys=['item_color', 'month', 'item_size'])} FROM featw"))
def join_woe(spark, sf_dir):
    """Rows ⟕ three WOE tables; unseen categories get the batch mean."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return _rounded(FT.transform(spec, i.unknown, _WOE, keep=("item_color", "month", "item_size")), _WOE, 9)


@register("price_off", S.with_transform(f"SELECT {_sel(['price_off'], keys=['item_id', 'item_price'])} FROM featw"))
def price_off(spark, sf_dir):
    """Relative discount to the item's max price, 0 where undefined."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return _rounded(FT.transform(spec, i.unknown, ["price_off"], keep=("item_id", "item_price")), ["price_off"])


@register("gift_flag", S.with_transform(
    f"SELECT {_sel(['order_min_price', 'order_has_gift'], keys=['user_id', 'order_date'])} FROM featw"))
def gift_flag(spark, sf_dir):
    """Basket contains a zero-price item."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    cols = ["order_min_price", "order_has_gift"]
    return _rounded(FT.transform(spec, i.unknown, cols, keep=("user_id", "order_date")), cols)


_QF = ["is_q1_value", "is_q2_value", "is_q3_value", "is_q4_value"]


@register("quartile_flags", S.with_transform(
    "SELECT item_price, "
    "CAST(item_price <= q1 AS DOUBLE) AS is_q1_value, CAST(item_price > q1 AND item_price <= q2 AS DOUBLE) AS is_q2_value, "
    "CAST(item_price > q2 AND item_price <= q3 AS DOUBLE) AS is_q3_value, CAST(item_price > q3 AS DOUBLE) AS is_q4_value "
    "FROM featw CROSS JOIN qs"))
def quartile_flags(spark, sf_dir):
    """P20: price quartile flags from the fitted quartiles."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return FT.transform(spec, i.unknown, _QF, keep=("item_price",))


RATIOS = ["order_total_value/state_mean_delivery", "days_to_delivery/state_mean_delivery",
          "item_price/state_mean_delivery", "age/order_num_sizes", "item_mean_delivery/order_seqnum",
          "item_max_delivery/order_num_colors", "user_tenure/history_perc", "price_off/item_price"]


def _ratio_sql(name):
    a, b = name.split("/")
    return f'round(CAST({a} AS DOUBLE) / (CAST({b} AS DOUBLE) + 1), 6) AS "{name}"'


@register("ratio_features", S.with_transform("SELECT " + ", ".join(_ratio_sql(n) for n in RATIOS) + " FROM featw"))
def ratio_features(spark, sf_dir):
    """Named ratio features a / (b + 1)."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return _rounded(FT.transform(spec, i.unknown, RATIOS, keep=()), RATIOS)


INTERACTIONS = ["item_price*order_num_items", "days_to_delivery*item_min_delivery",
                "is_letter_coded*order_total_value", "item_price2*order_num_sizes",
                "is_dob_missing*is_item_clothes", "delivery_fri*state_max_delivery", "age*history"]


def _inter_sql(name):
    a, b = name.split("*")
    from ..operators.features import FLAGS
    if a in FLAGS and b in FLAGS:
        return f'CAST({a} AND {b} AS DOUBLE) AS "{name}"'
    return f'CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE) AS "{name}"'


@register("interaction_features", S.with_transform(
    "SELECT " + ", ".join(_inter_sql(n) for n in INTERACTIONS) + " FROM featw"))
def interaction_features(spark, sf_dir):
    """Named interactions a * b (AND for two flags)."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return FT.transform(spec, i.unknown, INTERACTIONS, keep=())


ONEHOTS = ([f"user_title_{v}" for v in ("Company", "Family", "Mr", "Mrs")]
           + [f"month_{m}" for m in range(1, 13)]
           + [f"item_size_cl_{v}" for v in ("UNSIZED", "XS", "S", "M", "L", "XL")])


def _onehot_sql(name):
    for src in ("user_title", "month", "item_size_cl"):
        if name.startswith(src + "_"):
            v = name[len(src) + 1:]
            lit = v if src == "month" else f"'{v}'"
            return f'CAST(coalesce({src} = {lit}, false) AS DOUBLE) AS "{name}"'
    raise KeyError(name)


@register("onehot", S.with_transform(
    "SELECT user_title, month, item_size_cl, " + ", ".join(_onehot_sql(n) for n in ONEHOTS) + " FROM featw"))
def onehot(spark, sf_dir):
    """One-hot columns ``col_value``; a null category gives all zeros."""
    FT, spec, i = _fitted_on_known(spark, sf_dir)
    return FT.transform(spec, i.unknown, ONEHOTS, keep=("user_title", "month", "item_size_cl"))


LOGIT_SUBSET = ["item_price", "order_total_value/state_mean_delivery", "days_to_delivery",
                "days_to_delivery/state_mean_delivery", "item_price/state_mean_delivery"]


@register("feature_matrix", S.with_transform(
    'SELECT "return", round(CAST(item_price AS DOUBLE), 6) AS item_price, '
    + _ratio_sql("order_total_value/state_mean_delivery") + ", "
    + 'round(CAST(days_to_delivery AS DOUBLE), 6) AS days_to_delivery, '
    + _ratio_sql("days_to_delivery/state_mean_delivery") + ", " + _ratio_sql("item_price/state_mean_delivery")
    + " FROM featw", src="history", x="known"))
def feature_matrix(spark, sf_dir):
    """Keep-list selection cast to DOUBLE with the label (spec fitted on all rows)."""
    from ..operators import features as FT
    i = inputs(spark, sf_dir, materialize=True)
    spec = FT.fit(i.history)
    return _rounded(FT.transform(spec, i.known, LOGIT_SUBSET, keep=("return",)), LOGIT_SUBSET)


# ---------------------------------------------------------------- EDA (L3)

_EDA_NA = ("not_reported", "?", "1994-12-31")


def _eda_raw(spark, sf_dir):
    from ..sources import adapter
    return adapter.order_items(spark, sf_dir)


@register("rate_by_delivery_days", S.with_ctes(
    'SELECT days_to_delivery, round(avg("return"), 6) AS perc_returned, count("return") AS total_items '
    "FROM (SELECT date_diff('day', order_date, delivery_date) AS days_to_delivery, \"return\" FROM sent "
    'WHERE "return" IS NOT NULL) WHERE days_to_delivery IS NOT NULL GROUP BY days_to_delivery '
    'HAVING count("return") > 10', na_values=_EDA_NA))
def rate_by_delivery_days(spark, sf_dir):
    """A12 (flagship): return rate by days to delivery, groups with more than 10 items."""
    from ..operators import eda
    out = eda.rate_by_delivery_days(eda.eda_known(_eda_raw(spark, sf_dir)))
    return out.withColumn("perc_returned", r6(F.col("perc_returned")))


@register("rate_by_weekday", S.with_ctes(
    "SELECT weekday, round(perc_returned, 6) AS perc_returned, "
    "round(stddev_samp(perc_returned) OVER (), 6) AS std_between_days FROM ("
    'SELECT CAST(isodow(delivery_date) - 1 AS BIGINT) AS weekday, avg("return") AS perc_returned FROM sent '
    'WHERE "return" IS NOT NULL AND delivery_date IS NOT NULL GROUP BY 1)', na_values=_EDA_NA))
def rate_by_weekday(spark, sf_dir):
    """Return rate per delivery weekday and its spread across weekdays."""
    from ..operators import eda
    out = eda.rate_by_weekday(eda.eda_known(_eda_raw(spark, sf_dir)))
    return out.select("weekday", r6(F.col("perc_returned")).alias("perc_returned"),
                      r6(F.col("std_between_days")).alias("std_between_days"))


_BASKETS_SQL = ('SELECT user_id, order_date, count(item_color) AS n_colors, count(item_size) AS n_sizes, '
                'CAST(least(coalesce(sum("return"), 0), 1) AS BIGINT) AS returned FROM sent GROUP BY user_id, order_date')


@register("basket_by_returned", S.with_ctes(_BASKETS_SQL, na_values=_EDA_NA))
def basket_by_returned(spark, sf_dir):
    """Basket colour / size counts and returned flag (all rows, EDA sentinels)."""
    from ..operators import eda
    from ..sources.scan import apply_sentinels
    return eda.basket_by_returned(apply_sentinels(_eda_raw(spark, sf_dir), _EDA_NA))


def _box_sql():
    cols = []
    for c in ("n_colors", "n_sizes"):
        cols += [f"CAST(min({c}) AS DOUBLE) AS {c}_min",
                 f"round(quantile_cont({c}, 0.25), 6) AS {c}_q1",
                 f"round(quantile_cont({c}, 0.5), 6) AS {c}_median",
                 f"round(quantile_cont({c}, 0.75), 6) AS {c}_q3",
                 f"CAST(max({c}) AS DOUBLE) AS {c}_max"]
    return f"SELECT returned, {', '.join(cols)} FROM ({_BASKETS_SQL}) GROUP BY returned"


@register("boxplot_summary", S.with_ctes(_box_sql(), na_values=_EDA_NA))
def boxplot_summary(spark, sf_dir):
    """Five-number summaries of basket colour / size counts per returned flag."""
    from ..operators import eda
    from ..sources.scan import apply_sentinels
    b = eda.basket_by_returned(apply_sentinels(_eda_raw(spark, sf_dir), _EDA_NA))
    out = eda.boxplot_summary(b)
    return _rounded(out, [c for c in out.columns if c.endswith(("_q1", "_median", "_q3"))])


_PROFILE_NUMBERS = ["item_price", "days_to_delivery", "user_tenure", "age", "month", "age2", "user_tenure2", "item_price2", "return"]
_PROFILE_OTHERS = {"text": ["item_size", "item_color", "brand_id", "user_title", "user_state", "color", "item_size_cl"],
                   "date": ["order_date", "delivery_date", "user_dob", "user_reg_date"],
                   "flag": ["is_na_delivery_date", "is_dob_missing", "is_item_pants", "is_item_underwear", "is_letter_coded",
                            "is_item_clothes", "delivery_thu", "delivery_fri"]}
PROFILE_COLS = _PROFILE_NUMBERS + [c for cs in _PROFILE_OTHERS.values() for c in cs]


def _profile_sql():
    parts = []
    for c in _PROFILE_NUMBERS:
        parts.append(
            f"SELECT '{c}' AS column_name, 'number' AS kind, count(x) AS count, count(*) - count(x) AS n_nulls, "
            f"count(DISTINCT x) AS n_unique, CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, "
            f"{round_sig_sql('avg(x)')} AS mean, {round_sig_sql('stddev_samp(x)')} AS std, "
            f"min(x) AS min, {round_sig_sql('quantile_cont(x, 0.25)')} AS q25, "
            f"{round_sig_sql('quantile_cont(x, 0.5)')} AS q50, "
            f"{round_sig_sql('quantile_cont(x, 0.75)')} AS q75, max(x) AS max "
            f'FROM (SELECT CAST("{c}" AS DOUBLE) AS x FROM known)')
    none = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    for kind, cols in _PROFILE_OTHERS.items():
        for c in cols:
            parts.append(
                f"SELECT '{c}' AS column_name, '{kind}' AS kind, sum(n) FILTER (s IS NOT NULL) AS count, "
                f"coalesce(sum(n) FILTER (s IS NULL), 0) AS n_nulls, count(s) AS n_unique, "
                f"arg_min(s, (-n, s)) FILTER (s IS NOT NULL) AS top, max(n) FILTER (s IS NOT NULL) AS freq, {none} "
                f"FROM (SELECT CAST({c} AS VARCHAR) AS s, count(*) AS n FROM known GROUP BY 1)")
    return " UNION ALL ".join(f"({p})" for p in parts)


@register("table_profile", S.with_ctes(_profile_sql()))
def table_profile(spark, sf_dir):
    """describe(include="all") and info of the cleaned labelled table, long form."""
    from ..operators import eda
    out = eda.table_profile(inputs(spark, sf_dir).known, PROFILE_COLS)
    for c in ("mean", "std", "q25", "q50", "q75"):
        out = out.withColumn(c, round_sig(F.col(c)))
    return out


def _all_cells():
    """SQL of every candidate feature by name (one-hots apart), and the ratios' denominators by name."""
    from ..operators import features as FT
    flags = FT.FLAGS
    num = lambda c: f"CAST({c} AS DOUBLE)"
    plain = list(FT.BASE_NUMERIC) + FT.WOE_NAMES + ["price_off"]
    non_flag = [n for n in plain if n not in flags]
    m, half = len(non_flag) // 2, len(FT.BASE_NUMERIC) // 2
    cells, dens = {n: num(n) for n in plain}, {}
    for a in non_flag[:m]:
        for b in non_flag[m:]:
            if not a.startswith("woe") and not b.startswith("woe"):
                n, d, name = (b, a, f"{b}/{a}") if b == "price_off" else (a, b, f"{a}/{b}")
                cells[name], dens[name] = f"{num(n)} / ({num(d)} + 1)", b
    for a in FT.BASE_NUMERIC[:half]:
        for b in FT.BASE_NUMERIC[half:]:
            cells[f"{a}*{b}"] = f"{num(a)} * {num(b)}"
    price = {"is_q1_value": "item_price <= q1", "is_q2_value": "item_price > q1 AND item_price <= q2",
             "is_q3_value": "item_price > q2 AND item_price <= q3", "is_q4_value": "item_price > q3"}
    cells |= {k: num(f"({v})") for k, v in price.items()}
    return cells, dens


def _fit_rows_ctes(dens):
    """The fitted rows' features, and denominators whose smallest value is 0: their ratios do not exist."""
    fit_rows = [(n + "_h" if n in ("feat", "featw") else n, q) for n, q in S.transform_ctes("history")]
    fit_rows = [(n, q.replace("FROM feat f", "FROM feat_h f")) for n, q in fit_rows if n in ("feat_h", "featw_h")]
    gone = " UNION ALL ".join(f"SELECT '{d}' AS d, min(CAST({d} AS DOUBLE)) = 0 AS z FROM fit_rows" for d in sorted(set(dens.values())))
    of = ", ".join(f"('{n}', '{d}')" for n, d in dens.items())
    return fit_rows + [("fit_rows", "SELECT * FROM featw_h"), ("gone", gone), ("of_", f"SELECT * FROM (VALUES {of}) t(n, d)")]


def _corr_ctes():
    """Correlations above 0.9 of all candidate features.  Centred values stand in lists of 512 rows, so a pair is
    some dot products."""
    from ..operators import features as FT
    cells, dens = _all_cells()
    wide = "SELECT row_number() OVER (ORDER BY order_item_id) - 1 AS rn, * FROM featw"
    hot = " UNION ALL ".join(
        f"SELECT k.rn, '{c}_' || CAST(h.v AS VARCHAR) AS f, CASE WHEN k.{c} = h.v THEN 1.0 ELSE 0.0 END AS x FROM rows_ k "
        f"CROSS JOIN (SELECT DISTINCT {c} AS v FROM history WHERE {c} IS NOT NULL) h" for c in FT.DUMMY_SOURCES)
    return _fit_rows_ctes(dens) + [
        ("rows_", wide),
        ("cells_", "SELECT rn, " + ", ".join(f'{e} AS "{n}"' for n, e in cells.items()) + " FROM rows_ CROSS JOIN qs"),
        ("long_", "SELECT * FROM cells_ UNPIVOT INCLUDE NULLS (x FOR f IN (COLUMNS(* EXCLUDE rn)))"),
        ("all_", "SELECT rn, f, x FROM long_ WHERE f NOT IN (SELECT n FROM of_ JOIN gone ON gone.d = of_.d WHERE z) "
                 f"UNION ALL SELECT rn, f, CAST(x AS DOUBLE) FROM ({hot})"),
        ("mean_", "SELECT f, avg(x) AS m, count(*) AS n FROM all_ GROUP BY f"),
        ("list_", "SELECT a.f, a.rn // 512 AS c, list(coalesce(a.x - m.m, 0) ORDER BY a.rn) AS v FROM all_ a JOIN mean_ m ON a.f = m.f GROUP BY ALL"),
        ("var_", "SELECT l.f, sum(list_dot_product(v, v)) AS s, any_value(m.m) AS m, any_value(m.n) AS n FROM list_ l JOIN mean_ m ON l.f = m.f GROUP BY l.f"),
        ("some_", "SELECT f, s FROM var_ WHERE s > 1e-12 * (s + n * m * m)"),
        ("dot_", "SELECT a.f AS fa, b.f AS fb, sum(list_dot_product(a.v, b.v)) AS p FROM list_ a JOIN list_ b ON a.c = b.c AND a.f < b.f GROUP BY ALL"),
        ("half_", "SELECT fa, fb, p / sqrt(x.s * y.s) AS r FROM dot_ JOIN some_ x ON x.f = fa JOIN some_ y ON y.f = fb"),
        ("corr_long", "SELECT fa AS var1, fb AS var2, r AS correlation FROM half_ WHERE abs(r) > 0.9 "
                      "UNION ALL SELECT fb, fa, r FROM half_ WHERE abs(r) > 0.9")]


def _corr_oracle(final, more=()):
    return S.with_ctes(final, S.fit_ctes("history") + S.transform_ctes("known") + _corr_ctes() + list(more))


def _corr_input(spark, sf_dir):
    """Correlations of the whole expanded matrix, WOE and one-hots included; its joined columns are written once."""
    from ..operators import eda
    from ..operators import features as FT
    i = inputs(spark, sf_dir, materialize=True)
    spec = FT.fit(i.history, raw=i.sentinel, clean=i.cleaned)
    known = spec.joined().filter(F.col("return").isNotNull())
    names = FT.expand_names(spec, ignore_woe=False, add_dummies=True)
    x, expansion = FT.feature_array(spec, known, names, keep=(), cells="cells", joined=True)
    return eda, eda.corr_arrays(x, names, "cells", expansion=expansion)


@register("corr_pairs", _corr_oracle(
    "SELECT var1, var2, round(abs(correlation), 6) AS abs_correlation FROM corr_long "
    "WHERE var1 < var2 AND abs(correlation) > 0.9"))
def corr_pairs(spark, sf_dir):
    """Correlation pairs above 0.9, mirror pairs removed, strongest first."""
    eda, long = _corr_input(spark, sf_dir)
    out = eda.high_corr_pairs(long, 0.9)
    return out.withColumn("abs_correlation", r6(F.col("abs_correlation")))


@register("corr_partners", _corr_oracle(
    "SELECT var1, count(DISTINCT var2) AS n_partners, count(DISTINCT var2) > 3 AS problematic FROM corr_long "
    "WHERE var1 <> var2 AND abs(correlation) > 0.9 GROUP BY var1"))
def corr_partners(spark, sf_dir):
    """Number of highly correlated partners per variable, flagged above 3."""
    eda, long = _corr_input(spark, sf_dir)
    return eda.corr_partners(long, 0.9, 3)


@register("droplist", _corr_oracle(
    "SELECT DISTINCT CASE WHEN pa.n > pb.n THEN c.var1 WHEN pb.n > pa.n THEN c.var2 "
    "ELSE greatest(c.var1, c.var2) END AS variable FROM corr_long c JOIN p pa ON c.var1 = pa.var1 "
    "JOIN p pb ON c.var2 = pb.var1 WHERE c.var1 < c.var2 AND abs(c.correlation) > 0.9",
    [("p", "SELECT var1, count(DISTINCT var2) AS n FROM corr_long WHERE var1 <> var2 AND abs(correlation) > 0.9 "
             "GROUP BY var1")]))
def droplist(spark, sf_dir):
    """Automatic drop-list from the correlation pairs."""
    eda, long = _corr_input(spark, sf_dir)
    return eda.droplist(long, 0.9)


# ---------------------------------------------------------------- cost layer

# fixed coefficients of the scored-rows queries: intercept + one per LOGIT_SUBSET feature
BETA = [-0.5, 0.8, -0.3, 0.5, -0.2, 0.4]
POOL = [[0.0] * 6, BETA, [2 * b for b in BETA], [-b for b in BETA]]
_FN = ["f1", "f2", "f3", "f4", "f5"]


def _scored(spark, sf_dir, cutoff=0.5):
    """Labelled rows -> standardised LOGIT_SUBSET features (global std) -> p = sigmoid(x·BETA)."""
    from ..operators import cost as CO
    from ..operators import features as FT
    from ..session import materialize
    i = inputs(spark, sf_dir, materialize=True)
    spec = FT.fit(i.history)
    fm = FT.transform(spec, i.known, LOGIT_SUBSET, keep=("order_item_id", "return", "item_price"))
    # the keep-list already holds item_price as a feature; carry the price separately.  The joined columns are written
    # once: the means, samples and costs are passes over them, none joins anew
    fm = materialize(fm.select("order_item_id", F.col("return").alias("y"), F.col("item_price").alias("price"),
                               *[F.col(f"`{n}`").alias(f) for n, f in zip(LOGIT_SUBSET, _FN)]), "scored-features")
    means, stds = CO.standardize_params(fm, _FN, "global")
    x = CO.standardized_array(_FN, means, stds, intercept=True)
    return fm.select("order_item_id", "y", "price", x.alias("x")).withColumn("p", CO.logit_score(F.col("x"), BETA))


def _scored_sql():
    feats = [
        "CAST(item_price AS DOUBLE)",
        "CAST(order_total_value AS DOUBLE) / (CAST(state_mean_delivery AS DOUBLE) + 1)",
        "CAST(days_to_delivery AS DOUBLE)",
        "CAST(days_to_delivery AS DOUBLE) / (CAST(state_mean_delivery AS DOUBLE) + 1)",
        "CAST(item_price AS DOUBLE) / (CAST(state_mean_delivery AS DOUBLE) + 1)",
    ]
    fm = 'SELECT order_item_id, "return" AS y, item_price AS price, ' + ", ".join(f"{e} AS {f}" for e, f in zip(feats, _FN)) + " FROM featw"
    st = "SELECT count(*) AS n, " + ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in _FN) + " FROM fm"
    grand = "(" + " + ".join(f"m_{f}" for f in _FN) + f") / {len(_FN)}"
    gs = f"SELECT *, {grand} AS grand FROM st"
    m2 = " + ".join(f"(v_{f} * n + n * ((m_{f} - grand) * (m_{f} - grand)))" for f in _FN)
    gstd = f"SELECT *, sqrt(({m2}) / (n * {len(_FN)})) AS g FROM gs"
    z = "(1.0 * " + str(BETA[0]) + "".join(f" + ((fm.{f} - m_{f}) / g) * {b}" for f, b in zip(_FN, BETA[1:])) + ")"
    sc = ("SELECT y, price, z, CASE WHEN z >= 0 THEN 1.0 / (1.0 + exp(-abs(z))) ELSE exp(-abs(z)) / (1.0 + exp(-abs(z))) END AS p "
          f"FROM (SELECT fm.*, {z} AS z FROM fm CROSS JOIN gstd)")
    # bucket = number of grid cutoffs (i * (1/99), last = 1) strictly below p
    g = "(1.0 / 99)"
    k0 = "CAST(least(greatest(ceil(p * 99), 0), 99) AS INTEGER)"
    gv = lambda e: f"(CASE WHEN {e} = 99 THEN 1.0 ELSE ({e}) * {g} END)"
    bk = (f"SELECT *, least(greatest(k0 + CASE WHEN {gv('k0')} < p THEN 1 ELSE 0 END "
          f"- CASE WHEN k0 > 0 AND {gv('k0 - 1')} >= p THEN 1 ELSE 0 END, 0), 100) AS k, "
          "CAST(round(price * 100) AS BIGINT) AS cents FROM (SELECT *, " + k0 + " AS k0 FROM scored)")
    return S.fit_ctes("history") + S.transform_ctes("known") + [
        ("fm", fm), ("st", st), ("gs", gs), ("gstd", gstd), ("scored", sc), ("scored_b", bk)]


def _cost_oracle(final, extra=None):
    return S.with_ctes(final, _scored_sql() + (extra or []))


_UNITS_SQL = ("CASE WHEN pred AND y = 0 THEN cents * 50 WHEN NOT pred AND y = 1 THEN cents * 25 + 75000 ELSE 0 END")


@register("standardize", _cost_oracle(
    "SELECT y, " + ", ".join(f"round((fm.{f} - m_{f}) / g, 9) AS {f}" for f in _FN) + " FROM fm CROSS JOIN gstd"))
def standardize(spark, sf_dir):
    """(x - column mean) / global population std."""
    s = _scored(spark, sf_dir)
    return s.select("y", *[F.round(F.col("x")[j + 1], 9).alias(f) for j, f in enumerate(_FN)])


@register("logit_score", _cost_oracle("SELECT y, price, round(p, 9) AS p, p > 0.5 AS predicted FROM scored"))
def logit_score(spark, sf_dir):
    """Stable sigmoid of x·beta (fixed beta) and the hard label at 0.5."""
    s = _scored(spark, sf_dir)
    return s.select("y", "price", F.round("p", 9).alias("p"), (F.col("p") > 0.5).alias("predicted"))


@register("row_cost", _cost_oracle(
    f"SELECT y, price, pred AS predicted, ({_UNITS_SQL}) / 10000.0 AS cost "
    "FROM (SELECT *, p > 0.5 AS pred FROM scored_b)"))
def row_cost(spark, sf_dir):
    """Per-row misclassification cost at cutoff 0.5 (FP 0.5·price, FN 2.5·(3 + 0.1·price))."""
    from ..functions import cost as C
    s = _scored(spark, sf_dir)
    pred = F.col("p") > 0.5
    return s.select("y", "price", pred.alias("predicted"),
                    (C.row_cost_units(pred, F.col("y"), F.col("price")) / C.UNITS).alias("cost"))


@register("utility_at_cutoff", _cost_oracle(
    f"SELECT -sum({_UNITS_SQL}) / 10000.0 AS utility, count(*) AS n, "
    f"round(-sum({_UNITS_SQL}) / 10000.0 / count(*), 9) AS avg_utility FROM (SELECT *, p > 0.5 AS pred FROM scored_b)"))
def utility_at_cutoff(spark, sf_dir):
    """Total and per-item utility at one cutoff."""
    from ..operators import cost as CO
    out = CO.utility_at(_scored(spark, sf_dir), "p", "y", "price", 0.5)
    return out.withColumn("avg_utility", F.round("avg_utility", 9))


_SWEEP_SQL = [
    ("bc", "SELECT k, sum(CASE WHEN y = 1 THEN cents * 25 + 75000 ELSE 0 END) AS fn, "
           "sum(CASE WHEN y = 0 THEN cents * 50 ELSE 0 END) AS fp FROM scored_b GROUP BY k"),
    ("fullk", "SELECT g.k, coalesce(bc.fn, 0) AS fn, coalesce(bc.fp, 0) AS fp FROM range(0, 101) g(k) "
             "LEFT JOIN bc ON bc.k = g.k"),
    ("util", "SELECT k, sum(fn) OVER (ORDER BY k) + sum(fp) OVER () - sum(fp) OVER (ORDER BY k) AS units FROM fullk"),
    ("best", "SELECT k, units FROM util WHERE k < 100 ORDER BY units, k LIMIT 1"),
]


@register("cutoff_sweep", _cost_oracle(
    "SELECT -units / 10000.0 AS best_utility, CASE WHEN k = 99 THEN 1.0 ELSE k * (1.0 / 99) END AS best_cutoff, "
    "CAST(k AS INTEGER) AS best_index FROM best", _SWEEP_SQL))
def cutoff_sweep(spark, sf_dir):
    """Best utility over 100 cutoffs in one pass (bucket sums + running window)."""
    from ..operators import cost as CO
    return CO.cutoff_sweep(_scored(spark, sf_dir), "p", "y", "price").drop("n")


@register("avg_cost", _cost_oracle(
    "SELECT round(-units / 10000.0 / (SELECT count(*) FROM scored_b), 9) AS avg_best_utility FROM best", _SWEEP_SQL))
def avg_cost(spark, sf_dir):
    """Per-item utility of the best cutoff (rescaled fitness)."""
    from ..operators import cost as CO
    best = CO.cutoff_sweep(_scored(spark, sf_dir), "p", "y", "price")
    return best.select(F.round(F.col("best_utility") / F.col("n"), 9).alias("avg_best_utility"))


@register("cost_baselines", _cost_oracle(
    "SELECT -sum(CASE WHEN y = 1 THEN cents * 25 + 75000 ELSE 0 END) / 10000.0 AS predict_none, "
    "-sum(CASE WHEN y = 0 THEN cents * 50 ELSE 0 END) / 10000.0 AS predict_all, count(*) AS n FROM scored_b"))
def cost_baselines(spark, sf_dir):
    """Utility of predicting no returns / all returns."""
    from ..operators import cost as CO
    return CO.baselines(_scored(spark, sf_dir), "y", "price")


def _pool_sql():
    rows = []
    for ci, cand in enumerate(POOL):
        z = f"(1.0 * {cand[0]}" + "".join(f" + ((fm.{f} - m_{f}) / g) * {b}" for f, b in zip(_FN, cand[1:])) + ")"
        rows.append(f"SELECT {ci} AS cand_id, y, price, {z} AS z FROM fm CROSS JOIN gstd")
    zz = " UNION ALL ".join(rows)
    p = ("SELECT cand_id, y, price, CASE WHEN z >= 0 THEN 1.0 / (1.0 + exp(-abs(z))) "
         "ELSE exp(-abs(z)) / (1.0 + exp(-abs(z))) END AS p FROM (" + zz + ")")
    g = "(1.0 / 99)"
    gv = lambda e: f"(CASE WHEN {e} = 99 THEN 1.0 ELSE ({e}) * {g} END)"
    k0 = "CAST(least(greatest(ceil(p * 99), 0), 99) AS INTEGER)"
    bk = (f"SELECT *, least(greatest(k0 + CASE WHEN {gv('k0')} < p THEN 1 ELSE 0 END "
          f"- CASE WHEN k0 > 0 AND {gv('k0 - 1')} >= p THEN 1 ELSE 0 END, 0), 100) AS k, "
          f"CAST(round(price * 100) AS BIGINT) AS cents FROM (SELECT *, {k0} AS k0 FROM ({p}))")
    return [
        ("pb", bk),
        ("pbc", "SELECT cand_id, k, sum(CASE WHEN y = 1 THEN cents * 25 + 75000 ELSE 0 END) AS fn, "
                "sum(CASE WHEN y = 0 THEN cents * 50 ELSE 0 END) AS fp FROM pb GROUP BY cand_id, k"),
        ("pfull", "SELECT c.cand_id, g.k, coalesce(pbc.fn, 0) AS fn, coalesce(pbc.fp, 0) AS fp "
                  f"FROM range(0, {len(POOL)}) c(cand_id) CROSS JOIN range(0, 101) g(k) "
                  "LEFT JOIN pbc ON pbc.cand_id = c.cand_id AND pbc.k = g.k"),
        ("putil", "SELECT cand_id, k, sum(fn) OVER (PARTITION BY cand_id ORDER BY k) + sum(fp) OVER (PARTITION BY cand_id) "
                  "- sum(fp) OVER (PARTITION BY cand_id ORDER BY k) AS units FROM pfull"),
        ("pbest", "SELECT cand_id, arg_min(k, units * 1000 + k) AS k, min(units) AS units FROM putil WHERE k < 100 "
                  "GROUP BY cand_id"),
        ("pfit", "SELECT CAST(cand_id AS BIGINT) AS cand_id, -units / 10000.0 AS best_utility, "
                 "CASE WHEN k = 99 THEN 1.0 ELSE k * (1.0 / 99) END AS best_cutoff, CAST(k AS INTEGER) AS best_index, "
                 "row_number() OVER (ORDER BY units, cand_id) AS rank FROM pbest"),
    ]


def _population(spark, sf_dir):
    import numpy as np

    from ..operators import cost as CO
    s = _scored(spark, sf_dir)
    fit = CO.population_fitness(s, "x", "y", "price", np.asarray(POOL))
    return CO.rank_candidates(fit.drop("out_of_bag", "n")).withColumn("rank", F.col("rank").cast("long"))


@register("population_fitness", _cost_oracle("SELECT * FROM pfit", _pool_sql()))
def population_fitness(spark, sf_dir):
    """Best utility and cutoff for each candidate coefficient vector, ranked."""
    return _population(spark, sf_dir)


@register("elite_topk", _cost_oracle("SELECT cand_id, best_utility, rank FROM pfit WHERE rank <= 2", _pool_sql()))
def elite_topk(spark, sf_dir):
    """The elite -- top int(elitism * population) candidates (elitism 0.5 of 4)."""
    return _population(spark, sf_dir).filter(F.col("rank") <= 2).select("cand_id", "best_utility", "rank")


def _oob_sql():
    """The pool's best cutoffs inside and outside a sample of half the rows."""
    import re
    drawn = ("SELECT *, row_number() OVER (ORDER BY CAST('0x' || substr(md5('7|' || order_item_id), 1, 15) AS BIGINT), order_item_id) "
             "<= floor(0.5 * count(*) OVER ()) AS inside FROM fm")
    ctes = [("drawn", drawn)]
    for tag, where in (("i", "inside"), ("o", "NOT inside")):
        ctes.append((f"fm_{tag}", f"SELECT * FROM drawn WHERE {where}"))
        for n, q in _pool_sql():
            q = re.sub(r"\b(pb|pbc|pfull|putil|pbest|pfit)\b", rf"\1_{tag}", q).replace("FROM fm CROSS JOIN", f"FROM fm_{tag} fm CROSS JOIN")
            ctes.append((f"{n}_{tag}", q))
    return ctes


@register("population_oob", _cost_oracle(
    "SELECT i.cand_id, i.best_utility, i.best_cutoff, o.best_utility AS oob_utility, o.best_cutoff AS oob_cutoff, "
    "(SELECT count(*) FROM fm_i) AS n, (SELECT count(*) FROM fm_o) AS oob_n, "
    "i.cand_id = (SELECT arg_min(cand_id, (-best_utility, cand_id)) FROM pfit_o) AS chosen "
    "FROM pfit_i i JOIN pfit_o o ON i.cand_id = o.cand_id", _oob_sql()))
def population_oob(spark, sf_dir):
    """Each candidate's utility and cutoff on a sample of exactly half the rows and on the rows out
    of bag, in one pass; the candidate that is best out of bag is chosen."""
    import numpy as np

    from ..operators import cost as CO
    from ..operators import split
    rows = _scored(spark, sf_dir).drop("p")
    drawn = split.exact_sample(rows, ["order_item_id"], int(0.5 * rows.count()), 7)
    fit = CO.population_fitness(drawn, "x", "y", "price", np.asarray(POOL), copies="copies")
    side = lambda out: fit.filter(F.col("out_of_bag") == out)
    both = side(False).select("cand_id", "best_utility", "best_cutoff", "n").join(
        side(True).select("cand_id", F.col("best_utility").alias("oob_utility"), F.col("best_cutoff").alias("oob_cutoff"), F.col("n").alias("oob_n")), "cand_id")
    best = both.agg(F.max_by("cand_id", F.struct("oob_utility", -F.col("cand_id"))).alias("best"))  # one row
    return both.crossJoin(F.broadcast(best)).withColumn("chosen", F.col("cand_id") == F.col("best")).drop("best")


_PEN = ("SELECT s.split, sum(pos * (2 * below + neg)) / (2.0 * sum(pos) * sum(neg)) AS auc FROM ("
        "SELECT split, p, pos, neg, coalesce(sum(neg) OVER (PARTITION BY split ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below "
        "FROM (SELECT split, p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg FROM scored_split GROUP BY ALL)) s GROUP BY s.split")


def _penalised_sql():
    sc = dict(_scored_sql())["scored"]
    split_sc = sc.replace("SELECT y, price, z,", "SELECT order_item_id, y, price, z,", 1)
    label = ("CASE WHEN ((item_id * 7919 + user_id * 104729 + date_diff('day', DATE '1970-01-01', order_date) * 1299709) % 100 + 100) % 100 < 80 "
             "THEN 'train' ELSE 'test' END")
    return [("keyed", split_sc), ("scored_split", f"SELECT {label} AS split, y, p FROM keyed JOIN known USING (order_item_id)"), ("auc_", _PEN),
            ("two", "SELECT max(CASE WHEN split = 'train' THEN auc END) AS tr, max(CASE WHEN split = 'test' THEN auc END) AS te FROM auc_")]


@register("penalised_fixed", _cost_oracle(
    "SELECT gap, round(tr, 6) AS train_auc, round(te, 6) AS test_auc, round(te - CASE WHEN abs(te - tr) > gap THEN 1 ELSE 0 END, 6) AS two_sided, "
    "round(te - CASE WHEN tr - te > gap THEN 1 ELSE 0 END, 6) AS one_sided FROM two CROSS JOIN (VALUES (0.0), (0.03), (0.5)) g(gap)", _penalised_sql()))
def penalised_fixed(spark, sf_dir):
    """The penalised score of fixed coefficients under three gaps, by the two-sided and the one-sided rule."""
    from ..operators import cost as CO
    from ..operators import models as M
    from ..operators import split
    from ..session import materialize
    rows = _scored(spark, sf_dir).select("order_item_id", "y", "p")
    sides = rows.join(inputs(spark, sf_dir).known.select("order_item_id", split.train_test_label(80, 0).alias("split")), "order_item_id")
    sides = materialize(sides.select("split", "y", "p"), "split-scores")    # read for each side
    tr, te = (CO.auc_exact(sides.filter(F.col("split") == k), "p", "y").first()["auc"] for k in ("train", "test"))
    out = [(g, round(tr, 6), round(te, 6), round(M.penalised(tr, te, g, True), 6), round(M.penalised(tr, te, g, False), 6)) for g in (0.0, 0.03, 0.5)]
    return spark.createDataFrame(out, "gap double, train_auc double, test_auc double, two_sided double, one_sided double")


@register("cumulative_share", S.with_ctes(
    "SELECT month, round(share, 9) AS share, round(sum(share) OVER (ORDER BY month), 9) AS cumulative_share FROM "
    "(SELECT month, count(*) * 1.0 / (SELECT count(*) FROM known) AS share FROM known GROUP BY month)"))
def cumulative_share(spark, sf_dir):
    """Each month's share of the labelled rows and the running sum over the months."""
    from ..operators import eda
    known = inputs(spark, sf_dir).known
    shares = known.groupBy("month").agg((F.count(F.lit(1)) / F.lit(known.count())).alias("share"))
    return eda.cumulative(shares, "month", "share", "cumulative_share").select(
        "month", F.round("share", 9).alias("share"), F.round("cumulative_share", 9).alias("cumulative_share"))


@register("auc_exact", _cost_oracle(
    "SELECT round(sum(pos * (2 * below + neg)) / (2.0 * sum(pos) * sum(neg)), 6) AS auc, "
    "CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM ("
    "SELECT p, pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below "
    "FROM (SELECT p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg "
    "FROM scored GROUP BY p))"))
def auc_exact(spark, sf_dir):
    """Exact ROC AUC with tie handling, scalable two-level prefix sum."""
    from ..operators import cost as CO
    out = CO.auc_exact(_scored(spark, sf_dir), "p", "y")
    return out.withColumn("auc", F.round("auc", 6))


# ---------------------------------------------------------------- fit scalars, profile, expansion, split

@register("impute_means", S.with_transform(
    "SELECT " + ", ".join(f"round(im.{c}, 6) AS {c}" for c in _ITEM) + ", "
    + ", ".join(f"round(om.{c}, 6) AS {c}" for c in ["order_total_value", "order_median_price", "order_min_price",
                                                    "order_max_price"]) + ", "
    + ", ".join(f"round(bm.{c}, 6) AS {c}" for c in ["brand_min_price", "brand_mean_price", "brand_max_price"]) + ", "
    + ", ".join(f"round(sm.{c}, 6) AS {c}" for c in ["state_mean_delivery", "state_max_delivery"])
    + " FROM im CROSS JOIN om CROSS JOIN bm CROSS JOIN sm"))
def impute_means(spark, sf_dir):
    """A10: imputation means of the fitted tables (order means after the per-brand fan-out)."""
    from ..operators import features as FT
    from ..operators import lookups as L
    spec = FT.fit(inputs(spark, sf_dir, materialize=True).known)
    means = {c: spec.means(t)[c] for t, cols in (("items", _ITEM), ("orders", FT.ORDER_FILL_MEAN), ("brands", L.BRAND_COLS),
                                                ("states", L.STATE_COLS)) for c in cols}
    row = spark.createDataFrame([tuple(means.values())], ", ".join(f"{c} double" for c in means))
    return row.select(*[r6(F.col(c)).alias(c) for c in row.columns])


def _profile_cols():
    from ..operators import features as FT
    return [c for c in FT.BASE_NUMERIC if c not in FT.FLAGS] + ["price_off"]


def _profile_sql():
    parts = [f"SELECT '{c}' AS column_name, min(CAST({c} AS DOUBLE)) = 0 AS min_is_zero, "
             f"count_if({c} IS NULL) > 0 AS has_nulls FROM featw" for c in _profile_cols()]
    return " UNION ALL ".join(parts)


@register("column_profile", S.with_transform(_profile_sql(), src="history", x="known"))
def column_profile(spark, sf_dir):
    """Per feature column -- minimum is 0 / any null (decides which ratios exist)."""
    from ..operators import features as FT
    from ..operators import lookups as L
    i = inputs(spark, sf_dir, materialize=True)
    spec = FT.fit(i.history)
    cols = _profile_cols()
    return L.column_profile(FT.transform(spec, i.known, cols, keep=()), cols)


def _expansion_sql():
    from ..operators import features as FT
    non_flag = _profile_cols()
    m = len(non_flag) // 2
    noms, dens = non_flag[:m], non_flag[m:]
    half = len(FT.BASE_NUMERIC) // 2
    ia, ib = FT.BASE_NUMERIC[:half], FT.BASE_NUMERIC[half:]

    def values(lst):
        return ", ".join(f"({i}, '{n}')" for i, n in enumerate(lst))

    prof = " UNION ALL ".join(f"SELECT '{c}' AS c, min(CAST({c} AS DOUBLE)) = 0 AS z FROM featw" for c in dens)
    names = (
        f"SELECT 0 AS grp, pos AS a, 0 AS b, name FROM (VALUES {values(FT.BASE_NUMERIC)}) t(pos, name) "
        "UNION ALL SELECT 1, 0, 0, 'price_off' "
        "UNION ALL SELECT 2, n.pos, d.pos, CASE WHEN d.name = 'price_off' THEN d.name || '/' || n.name "
        f"ELSE n.name || '/' || d.name END FROM (VALUES {values(noms)}) n(pos, name) "
        f"CROSS JOIN (VALUES {values(dens)}) d(pos, name) JOIN prof ON prof.c = d.name WHERE NOT prof.z "
        f"UNION ALL SELECT 3, a.pos, b.pos, a.name || '*' || b.name FROM (VALUES {values(ia)}) a(pos, name) "
        f"CROSS JOIN (VALUES {values(ib)}) b(pos, name)")
    drops = "('delivery_thu', 'delivery_fri', 'order_has_gift')"
    final = ("SELECT CAST(row_number() OVER (ORDER BY grp, a, b) - 1 AS BIGINT) AS position, name AS feature_name "
             f"FROM names WHERE NOT (name LIKE 'is%' OR name IN {drops})")
    return S.with_ctes(final, S.fit_ctes("history") + S.transform_ctes("history") + [("prof", prof), ("names", names)])


def _feature_sums_sql():
    """Sums of every candidate feature: one wide aggregate, unpivoted, kept where the ratio exists; one-hots
    by counting."""
    from ..operators import features as FT
    cells, dens = _all_cells()
    wide = "SELECT " + ", ".join(f'sum({e}) AS "{n}"' for n, e in cells.items()) + " FROM featw CROSS JOIN qs"
    hot = " UNION ALL ".join(
        f"SELECT '{c}_' || CAST(h.v AS VARCHAR) AS feature_name, CAST(count(k.v) AS DOUBLE) AS total FROM "
        f"(SELECT DISTINCT {c} AS v FROM history WHERE {c} IS NOT NULL) h LEFT JOIN (SELECT {c} AS v FROM known) k ON h.v = k.v GROUP BY h.v"
        for c in FT.DUMMY_SOURCES)
    return S.with_ctes(
        f"SELECT feature_name, {round_sig_sql('total', 9)} AS total, (SELECT count(*) FROM known) AS n FROM "
        "(SELECT feature_name, total FROM long_ WHERE feature_name NOT IN (SELECT n FROM of_ JOIN gone ON gone.d = of_.d WHERE z) "
        f"UNION ALL SELECT feature_name, total FROM ({hot}))",
        S.fit_ctes("history") + S.transform_ctes("known") + _fit_rows_ctes(dens) + [
            ("wide_", wide), ("long_", "UNPIVOT wide_ ON COLUMNS(*) INTO NAME feature_name VALUE total")])


@register("all_features", _expansion_sql())
def all_features(spark, sf_dir):
    """U4: the full candidate feature list of the half-split rules (fit profile, one-hots off)."""
    from ..operators import features as FT
    spec = FT.fit(inputs(spark, sf_dir, materialize=True).history)
    names = FT.expand_names(spec)
    return spark.createDataFrame(list(enumerate(names)), "position long, feature_name string")


@register("hash_split", S.with_ctes(
    "SELECT CASE WHEN ((item_id * 7919 + user_id * 104729 + date_diff('day', DATE '1970-01-01', order_date) * 1299709) "
    "% 100 + 100) % 100 < 80 THEN 'train' ELSE 'test' END AS split, \"return\", count(*) AS n "
    "FROM known GROUP BY ALL"))
def hash_split(spark, sf_dir):
    """Deterministic 80/20 train/test labelling of every labelled row."""
    from ..operators import split
    k = inputs(spark, sf_dir).known
    return k.groupBy(split.train_test_label(80, 0).alias("split"), "return").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- k-NN

_KNN_DISTANCE = {1: "list_sum(list_transform(list_zip(a.v, b.v), lambda x: abs(x[1] - x[2])))",
                 2: "list_distance(a.v, b.v)",
                 3: "list_sum(list_transform(list_zip(a.v, b.v), lambda x: pow(abs(x[1] - x[2]), 3)))"}


def _knn_sql(p: int, k: int, weights: str) -> str:
    weight = "count(*)" if weights == "uniform" else (
        "sum(CASE WHEN least = 0 THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / dist END)")
    dist = "dist" if p < 3 else "pow(dist, 1.0 / 3)"
    return f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS BIGINT) AS label FROM embeddings),
d0 AS (SELECT a.vec_id, a.label AS true_label, b.vec_id AS nb, b.label, {_KNN_DISTANCE[p]} AS dist
       FROM e a JOIN e b ON a.vec_id <> b.vec_id),
d AS (SELECT vec_id, true_label, nb, label, {dist} AS dist FROM d0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nb) AS rn, min(dist) OVER (PARTITION BY vec_id) AS least FROM d),
v AS (SELECT vec_id, true_label, label, {weight} AS votes FROM r WHERE rn <= {k} GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, label) AS pick FROM v)
SELECT vec_id, true_label AS label, label AS predicted FROM w WHERE pick = 1"""


def _knn(spark, sf_dir, k, p, weights):
    from ..operators import knn
    from ..sources.adapter import read_table
    e = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long"))
    return knn.knn_predict(e, e, "vec_id", "embedding", "label", k, p, weights).select("vec_id", "label", "predicted")


@register("knn_vote", _knn_sql(2, 5, "uniform"))
def knn_vote(spark, sf_dir):
    """Leave-one-out 5-NN majority vote over the embeddings (Euclidean, ties by id / label)."""
    return _knn(spark, sf_dir, 5, 2, "uniform")


@register("knn_vote_p1", _knn_sql(1, 7, "distance"))
def knn_vote_p1(spark, sf_dir):
    """7-NN by city-block distance, votes by inverse distance."""
    return _knn(spark, sf_dir, 7, 1, "distance")


@register("knn_vote_p3", _knn_sql(3, 15, "uniform"))
def knn_vote_p3(spark, sf_dir):
    """15-NN by the Minkowski distance of order 3."""
    return _knn(spark, sf_dir, 15, 3, "uniform")


@register("knn_returns")
def knn_returns(spark, sf_dir):
    """M9 on the standardised return features: every test row against all train rows, votes by inverse
    distance; exact AUC of the share of returned neighbours."""
    from pyspark.ml.functions import vector_to_array
    from ..operators import cost as CO
    from ..operators import knn
    M, names, train, test = _model_data(spark, sf_dir, LOGIT_SUBSET)[:4]
    scaler = M.Pipeline(stages=M._scaled("standard")).fit(train)
    side = lambda d: scaler.transform(d).select(F.xxhash64("order_item_id").alias("id"), vector_to_array("scaled").alias("v"),
                                                F.col("return").cast("long").alias("label"))
    out = knn.knn_predict(side(test), side(train), "id", "v", "label", k=15, p=2, weights="distance", exclude_self=False)
    return CO.auc_exact(out, "positive", "label")


# ---------------------------------------------------------------- models, GA, sinks (rows-only checks)

# fixed values: the keep-list of the network script (resolved by name: base, ratio, interaction)
MODEL_FEATURES = ["days_to_delivery", "item_price*order_num_items", "item_price*order_num_sizes",
                  "days_to_delivery/brand_mean_price", "days_to_delivery*order_seqnum", "days_to_delivery*brand_max_price",
                  "days_to_delivery/order_median_price", "order_total_value", "item_price",
                  "order_total_value/order_num_colors", "is_item_clothes*order_median_price",
                  "item_price/brand_mean_price", "order_total_value/brand_mean_price",
                  "days_to_delivery*order_total_value", "item_mean_delivery/brand_min_price", "item_mean_delivery",
                  "item_price/brand_max_price", "order_max_price/order_median_price", "is_letter_coded*brand_min_price"]


def _model_data(spark, sf_dir, names=None):
    """Labelled rows with named features, written once and assembled; deterministic 80/20 split."""
    from ..operators import features as FT
    from ..operators import models as M
    from ..operators import split
    from ..session import materialize
    names = names or MODEL_FEATURES
    i = inputs(spark, sf_dir, materialize=True)
    spec = FT.fit(i.history)
    fm = FT.transform(spec, i.known.withColumn("split", split.train_test_label(80, 0)).withColumn("price", F.col("item_price")), names,
                      keep=("order_item_id", "return", "price", "split"))
    data = M.assemble(materialize(fm, "model-features"), names)
    return M, names, data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test"), i, spec


#: What split labels and results take of a row.
_KEYS = ("order_item_id", "item_id", "user_id", "order_date")


def _full_data(spark, sf_dir):
    """All candidate features -- WOE and one-hots included -- as one vector, for both files."""
    from ..operators import features as FT
    from ..operators import models as M
    from ..operators import split
    i = inputs(spark, sf_dir, materialize=True)
    spec = FT.fit(i.history, raw=i.sentinel, clean=i.cleaned)
    rows = spec.joined(_KEYS)
    names = FT.expand_names(spec, ignore_woe=False, add_dummies=True)

    def side(rows):
        return (FT.feature_array(spec, rows, names, keep=("order_item_id", "return", "split"), vectors={"features": names}, joined=True)
                .withColumn("label", F.col("return").cast("double")))

    known = side(rows.filter(F.col("return").isNotNull()).withColumn("split", split.train_test_label(80, 0)))
    return M, names, known, lambda: side(rows.filter(F.col("return").isNull()))


def _appended(spark, records, name):
    """Records appended to a metrics table, read back."""
    import uuid

    from ..session import scratch_path
    from ..sources import sinks
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    sinks.append_metrics(records, path)
    return spark.read.schema(records.schema).parquet(path)


def _fit_report(spark, name, model_pipe, train, test, two_sided=True):
    from ..operators import models as M
    _, t = M.evaluate(model_pipe, train, test, two_sided)
    return spark.createDataFrame([(name, t.train_auc, t.test_auc, t.score, t.seconds)],
                                 "model string, train_auc double, test_auc double, penalised double, seconds double")


def _scaled_poly_sql():
    feats = ["CAST(item_price AS DOUBLE)", "CAST(order_total_value AS DOUBLE) / (CAST(state_mean_delivery AS DOUBLE) + 1)",
             "CAST(days_to_delivery AS DOUBLE)", "CAST(days_to_delivery AS DOUBLE) / (CAST(state_mean_delivery AS DOUBLE) + 1)",
             "CAST(item_price AS DOUBLE) / (CAST(state_mean_delivery AS DOUBLE) + 1)"]
    cells = ", ".join(f"{e} AS f{j}" for j, e in enumerate(feats))
    parts = [f"SELECT '{n}' AS feature, round(avg((f{j} - lo) / (hi - lo)), 6) AS minmax_mean, "
             f"round(avg(((f{j} - m) / s) * ((f{j} - m) / s)), 6) AS square_mean, "
             f"round(avg(((f{j} - m) / s) * ((f0 - m0) / s0)), 6) AS product_mean "
             f"FROM pm CROSS JOIN (SELECT min(f{j}) AS lo, max(f{j}) AS hi, avg(f{j}) AS m, stddev_samp(f{j}) AS s, "
             f"avg(f0) AS m0, stddev_samp(f0) AS s0 FROM pm)" for j, n in enumerate(LOGIT_SUBSET)]
    return S.with_ctes(" UNION ALL ".join(f"({p})" for p in parts),
                       S.fit_ctes("history") + S.transform_ctes("known") + [("pm", f"SELECT {cells} FROM featw")])


@register("scaled_poly", _scaled_poly_sql())
def scaled_poly(spark, sf_dir):
    """M1-M3: min-max scaling, standard scaling and degree-2 terms; a feature's mean of the first, of its
    square among the terms, and of its product with the first feature."""
    from pyspark.ml.functions import vector_to_array
    M, names, train, test = _model_data(spark, sf_dir, LOGIT_SUBSET)[:4]
    data = train.unionByName(test)
    pipe = M.Pipeline(stages=M._scaled("standard") + M.degree_two("scaled", "poly")
                      + [M.MinMaxScaler(inputCol="features", outputCol="mm")])
    out = pipe.fit(data).transform(data).select(vector_to_array("mm").alias("mm"), vector_to_array("poly").alias("poly"))
    # degree-2 terms after the constant: x0, x0², x1, x0 x1, x1², x2, ...
    start = lambda j: 1 + j * (j + 3) // 2
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.col("mm")[j].alias("a"), F.col("poly")[start(j) + j + 1].alias("b"),
                               F.col("poly")[start(j) + 1].alias("c")) for j, n in enumerate(names)])
    return out.select(F.explode(cells).alias("v")).groupBy("v.feature").agg(
        F.round(F.avg("v.a"), 6).alias("minmax_mean"), F.round(F.avg("v.b"), 6).alias("square_mean"),
        F.round(F.avg("v.c"), 6).alias("product_mean"))


@register("pca_scores")
def pca_scores(spark, sf_dir):
    """Scores on the principal components of the standardised features: fitted on the train rows, given
    for train and test rows."""
    from pyspark.ml.functions import vector_to_array
    M, names, train, test = _model_data(spark, sf_dir)[:4]
    model, scored, _ = M.pca_fit(train, len(names))
    both = scored.unionByName(model.transform(test))
    return both.select("split", "return", vector_to_array("pca").alias("pca_scores"))


@register("pca_variance")
def pca_variance(spark, sf_dir):
    """Explained variance ratio per component and its running sum, over the full feature matrix."""
    from ..operators import eda
    M, names, known, _ = _full_data(spark, sf_dir)
    _, _, ev = M.pca_fit(known.filter("split = 'train'"), 20)
    df = spark.createDataFrame(list(enumerate(ev)), "component long, explained_variance double")
    return eda.cumulative(df, "component", "explained_variance", "cumulative_variance")


@register("feature_sums", _feature_sums_sql())
def feature_sums(spark, sf_dir):
    """The full feature matrix of the labelled rows -- every candidate, WOE and one-hots
    included -- as one array column; its rows and sum a feature."""
    import numpy as np
    from ..operators import features as FT
    i = inputs(spark, sf_dir, materialize=True)
    spec = FT.fit(i.history, raw=i.sentinel, clean=i.cleaned)
    known = spec.joined().filter(F.col("return").isNotNull())
    names = FT.expand_names(spec, ignore_woe=False, add_dummies=True)
    x, expansion = FT.feature_array(spec, known, names, keep=(), cells="cells", joined=True)

    def sums(batches):
        import pyarrow as pa
        total, n = np.zeros(len(names)), 0       # a sum over a null is null
        for b in batches:
            for v in expansion.parts(b.column(0)):
                total += v.sum(axis=0)
                n += len(v)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(names), dtype=np.int32)), pa.array(total, from_pandas=True), pa.array(np.full(len(names), n))],
                                         names=["position", "total", "n"])

    name = F.array(*[F.lit(n) for n in names])
    return (x.select("cells").mapInArrow(sums, "position int, total double, n long").groupBy("position")
            .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
            .select(F.element_at(name, F.col("position") + 1).alias("feature_name"), round_sig(F.col("total"), 9).alias("total"), "n"))


@register("logit_fit")
def logit_fit(spark, sf_dir):
    """M4 (+M1, M3, M12, M13): L2 logistic regression on scaled degree-2 terms, exact train/test AUC."""
    M, names, train, test, i, spec = _model_data(spark, sf_dir, LOGIT_SUBSET)
    return _fit_report(spark, "logistic", M.logistic(C=0.5, penalty="l2", n=train.count()), train, test)


@register("forest_importance")
def forest_importance(spark, sf_dir):
    """Forest importances over the full feature matrix, largest first (top 61)."""
    M, names, known, _ = _full_data(spark, sf_dir)
    train = known.filter("split = 'train'")
    model = M.forest(num_trees=30, max_depth=8, n=train.count()).fit(train)
    imp = M.feature_importance(model, names)
    df = spark.createDataFrame([(r + 1, n, v) for r, (n, v) in enumerate(imp)],
                               "rank long, feature string, importance double")
    return df.orderBy("rank").limit(61)


@register("penalised_auc")
def penalised_auc(spark, sf_dir):
    """Overfit-penalised score, two-sided (most models) and one-sided (forest) gap rule."""
    M, names, train, test, i, spec = _model_data(spark, sf_dir)
    model = M.forest(num_trees=20, max_depth=10, n=train.count()).fit(train)
    a_tr, a_te = M.auc(model.transform(train)), M.auc(model.transform(test))
    rows = [("two_sided", a_tr, a_te, M.penalised(a_tr, a_te, two_sided=True)),
            ("one_sided", a_tr, a_te, M.penalised(a_tr, a_te, two_sided=False))]
    return spark.createDataFrame(rows, "rule string, train_auc double, test_auc double, penalised double")


@register("gbt_fit")
def gbt_fit(spark, sf_dir):
    """M6: gradient-boosted trees, exact train/test AUC and penalised score."""
    M, names, train, test, i, spec = _model_data(spark, sf_dir)
    return _fit_report(spark, "boosted", M.boosted(max_iter=20, max_depth=3, subsample=0.8, n=train.count()),
                       train, test)


@register("mlp_fit")
def mlp_fit(spark, sf_dir):
    """M7: feed-forward network on min-max scaled features: 100 hidden units, Adam, up to 1000 epochs with early stopping."""
    M, names, train, test, i, spec = _model_data(spark, sf_dir)
    return _fit_report(spark, "network", M.network((100,), "relu", "adam"), train, test)


@register("svm_fit")
def svm_fit(spark, sf_dir):
    """M8: SVM with each of the three kernels (landmark maps for RBF and sigmoid); exact AUC of the margin, a row a
    kernel."""
    M, names, train, test, i, spec = _model_data(spark, sf_dir)
    n = train.count()
    out = None
    for kernel in ("linear", "rbf", "sigmoid"):
        row = _fit_report(spark, f"svm_{kernel}", M.svm(len(names), C=0.75, kernel=kernel, n=n, max_iter=30), train, test)
        out = row if out is None else out.unionByName(row)
    return out


@register("random_search")
def random_search(spark, sf_dir):
    """Seeded random search of the logistic pipeline (penalty, C) with the penalised AUC objective."""
    M, names, train, test, i, spec = _model_data(spark, sf_dir, LOGIT_SUBSET)
    n = train.count()
    def objective(p):
        return M.evaluate(M.logistic(C=p["C"], penalty=p["penalty"], n=n, max_iter=50), train, test)[1]

    return _appended(spark, M.trials_frame(spark, M.random_search(M.SPACES["logistic"], objective, max_evals=10, seed=42), "logistic"), "trials")


# fixed values: the k-NN script's keep-list
KNN_FEATURES = ["item_price", "days_to_delivery", "price_off"]


def _search(spark, sf_dir, evals):
    """One search over all six spaces, each on its script's features (WOE and one-hots for the trees); the trials
    are appended to a metrics table as they end."""
    import uuid

    from ..operators import features as FT
    from ..operators import models as M
    from ..operators import split, tuning
    from ..session import materialize, scratch_path
    from ..sources.sinks import MetricsTable
    i = inputs(spark, sf_dir, materialize=True)
    spec = FT.fit(i.history, raw=i.sentinel, clean=i.cleaned)
    known = spec.joined(_KEYS).filter(F.col("return").isNotNull()).withColumn("split", split.train_test_label(80, 0))
    full = FT.expand_names(spec, ignore_woe=False, add_dummies=True)
    every = list(dict.fromkeys(full + MODEL_FEATURES + LOGIT_SUBSET + KNN_FEATURES))  # keep-lists may name ratios that the rules leave out
    lists = {"small": LOGIT_SUBSET, "nineteen": MODEL_FEATURES, "three": KNN_FEATURES, "whole": full}
    x = FT.feature_array(spec, known, every, keep=("order_item_id", "return", "split"), vectors=lists, joined=True)
    n = x.filter("split = 'train'").count()

    def sides(name):
        data = x.select("order_item_id", "split", F.col("return").cast("double").alias("label"), F.col(name).alias("features"))
        if name != "whole":  # the matrix is made as it is read
            data = materialize(data, "search-side")
        return data.filter("split = 'train'"), data.filter("split = 'test'"), n, len(lists[name])

    small, nineteen, three, whole = map(sides, lists)
    data = {"logistic": small, "svm": small, "knn": three, "network": nineteen, "boosted": whole, "forest": whole}
    tasks = {m: (M.SPACES[m], M.objective(m, *data[m])) for m in M.SPACES}
    table = MetricsTable(scratch_path(spark, f"trials-{uuid.uuid4().hex}"))
    return tuning, tuning.search(spark, tasks, evals, seed=42, parallel=4, table=table), table


@register("tuning_trials")
def tuning_trials(spark, sf_dir):
    """Trials of all six models at a time, a row a trial with its status, read back from the metrics
    table."""
    _, trials, _ = _search(spark, sf_dir, 1)
    return trials


@register("sample_exact", S.with_ctes(
    "SELECT order_item_id, CAST(rn <= floor(0.5 * n) AS INTEGER) AS copies FROM (SELECT order_item_id, count(*) OVER () AS n, "
    "row_number() OVER (ORDER BY CAST('0x' || substr(md5('7|' || order_item_id), 1, 15) AS BIGINT), order_item_id) AS rn FROM known)"))
def sample_exact(spark, sf_dir):
    """Exactly half of the labelled rows, drawn without replacement; the rest is out of bag."""
    from ..operators import split
    known = inputs(spark, sf_dir, materialize=True).known.select("order_item_id")
    return split.exact_sample(known, ["order_item_id"], int(0.5 * known.count()), 7).select("order_item_id", "copies")


@register("sample_bootstrap")
def sample_bootstrap(spark, sf_dir):
    """int(0.5 * rows) draws with replacement; how often each labelled row was drawn (0: out of bag)."""
    from ..operators import split
    known = inputs(spark, sf_dir, materialize=True).known.select("order_item_id")
    return split.exact_bootstrap(known, ["order_item_id"], int(0.5 * known.count()), 7).select("order_item_id", "copies")


def _ga_data(spark, sf_dir):
    """Train and test rows with the full feature matrix, WOE and one-hots included, as one array."""
    from ..operators import features as FT
    from ..operators import split
    i = inputs(spark, sf_dir, materialize=True)
    spec = FT.fit(i.history, raw=i.sentinel, clean=i.cleaned)
    known = spec.joined(_KEYS).filter(F.col("return").isNotNull())
    names = FT.expand_names(spec, ignore_woe=False, add_dummies=True)
    rows = known.withColumn("split", split.train_test_label(80, 0)).withColumn("price", F.col("item_price"))
    data, expansion = FT.feature_array(spec, rows, names, keep=("order_item_id", "return", "price", "split"), vectors={"features": names},
                                       cells="cells", joined=True)
    return names, data.filter("split = 'train'"), data.filter("split = 'test'"), expansion


def _ga(train, expansion, components=None, generations=4, population=20):
    from ..operators.genetic import GeneticSearch
    ga = GeneticSearch(elitism=0.1, population_size=population, crossover="arithmetic", prob_mutation=0.3, seed=42)
    ga.fit_array(train, "x", "return", "price", ["order_item_id"], components, loc=0.0, scale=3.0, cells="cells", expansion=expansion)
    ga.run(maxiter=generations, subsample=0.5, reset_prob=0.5)
    return ga


@register("ga_run")
def ga_run(spark, sf_dir):
    """Genetic search over the full feature matrix and over its first 20 principal components; a history
    row a generation."""
    _, train, _, expansion = _ga_data(spark, sf_dir)
    spaces = [(name, _ga(train, expansion, k).history_frame(spark)) for name, k in (("features", None), ("components", 20))]
    records = spaces[0][1].withColumn("space", F.lit(spaces[0][0])).unionByName(spaces[1][1].withColumn("space", F.lit(spaces[1][0])))
    return _appended(spark, records, "ga-history")


#: Fixed candidates over the full matrix: a coefficient depends on the feature's name only.
FULL_POOL = 4


def _pool_coefficient(name: str, c: int) -> float:
    return ((len(name) * (c + 3)) % 7 - 3) * 0.05


def _pool_full_sql():
    mean = "SELECT f, avg(x) AS m, var_pop(x) AS v FROM all_ GROUP BY f"
    z = ("SELECT c.cand_id, a.rn, 0.1 + sum((coalesce(a.x, m.m) - m.m) / (SELECT sqrt(avg(v + (m - (SELECT avg(m) FROM pm_)) * (m - (SELECT avg(m) FROM pm_)))) FROM pm_) "
         "* ((length(a.f) * (c.cand_id + 3)) % 7 - 3) * 0.05) AS z "
         f"FROM all_ a JOIN pm_ m ON a.f = m.f CROSS JOIN range(0, {FULL_POOL}) c(cand_id) GROUP BY ALL")
    rows = 'SELECT cand_id, r."return" AS y, r.item_price AS price, z FROM z_ JOIN rows_ r ON r.rn = z_.rn'
    pool = _pool_sql()
    first = pool[0][1]
    start, end = first.index(" AS p FROM (") + len(" AS p FROM ("), first.rindex(")))")
    pool[0] = ("pb", first[:start] + rows + first[end:])
    pool[2] = ("pfull", pool[2][1].replace(f"range(0, {len(POOL)})", f"range(0, {FULL_POOL})"))
    ctes = [c for c in _corr_ctes() if c[0] in ("fit_rows", "gone", "of_", "rows_", "cells_", "long_", "all_", "feat_h", "featw_h")]
    return S.with_ctes("SELECT cand_id, best_utility, best_cutoff, best_index, rank FROM pfit",
                       S.fit_ctes("history") + S.transform_ctes("known") + ctes + [("pm_", mean), ("z_", z)] + pool)


@register("population_full", _pool_full_sql())
def population_full(spark, sf_dir):
    """Utility and cutoff of fixed candidates over the full feature matrix of the labelled rows, scaled by
    one standard deviation, scored from the raw features by folded coefficients."""
    import numpy as np

    from ..operators import cost as CO
    from ..operators.genetic import GeneticSearch
    names, train, test, expansion = _ga_data(spark, sf_dir)
    ga = GeneticSearch(population_size=FULL_POOL).fit_array(train.unionByName(test), "x", "return", "price", ["order_item_id"],
                                                            cells="cells", expansion=expansion)
    pool = np.array([[0.1, *(_pool_coefficient(n, c) for n in names)] for c in range(FULL_POOL)])
    fit = ga.fitness(ga.data, ga._raw(pool))
    return CO.rank_candidates(fit.drop("out_of_bag", "n")).withColumn("rank", F.col("rank").cast("long"))


@register("cost_report")
def cost_report(spark, sf_dir):
    """Test-set cost over the full feature matrix: the GA in both spaces (its own cutoff), forest, logistic and SVM
    (best cutoff), and both baselines."""
    from ..operators import cost as CO
    from ..operators import models as M
    names, train, test, expansion = _ga_data(spark, sf_dir)
    rows = []
    for name, k in (("genetic", None), ("genetic on components", 20)):
        ga = _ga(train, expansion, k, generations=3, population=16)
        scored = ga.predict_proba(test).select("p", F.col("return").alias("y"), "price")
        rows.append((name, CO.utility_at(scored, "p", "y", "price", ga.optimal_cutoff).first()["utility"], float(ga.optimal_cutoff)))
    vector = lambda d: d.select("features", F.col("return").cast("double").alias("label"), "price")
    tr, te, n = vector(train), vector(test), train.count()
    svm = M.calibrated(M.svm(len(names), C=0.75, n=n, max_iter=20), tr)
    for name, pipe in (("forest", M.forest(num_trees=12, max_depth=8, n=n)), ("logistic", M.logistic(C=1.0, n=n, poly=False, max_iter=40)), ("svm", svm)):
        sc = M.positive_score(pipe.fit(tr).transform(te) if name != "svm" else svm.transform(te)).select(
            F.col("score").alias("p"), F.col("label").cast("int").alias("y"), "price")
        b = CO.cutoff_sweep(sc, "p", "y", "price").first()
        rows.append((name, b["best_utility"], b["best_cutoff"]))
    base = CO.baselines(test.select(F.col("return").alias("y"), "price"), "y", "price").first()
    rows += [("baseline_none", base["predict_none"], None), ("baseline_all", base["predict_all"], None)]
    return spark.createDataFrame(rows, "model string, utility double, cutoff double")


@register("score_unknown")
def score_unknown(spark, sf_dir):
    """Refit on all labelled rows with every feature and score every unlabelled row (probability of return)."""
    import uuid

    from ..session import scratch_path
    from ..sources import sinks
    M, names, known, unknown = _full_data(spark, sf_dir)
    model = M.logistic(C=0.5, n=known.count(), poly=False).fit(known)
    pred = M.positive_score(model.transform(unknown())).select("order_item_id", F.col("score").alias("p"))
    path = scratch_path(spark, f"predictions-{uuid.uuid4().hex}")
    sinks.write_predictions(pred, path)
    return spark.read.option("header", True).schema("order_item_id string, `return` double").csv(path)


@register("csv_roundtrip", S.with_ctes(
    "SELECT order_date, delivery_date, CAST(item_id AS VARCHAR) AS item_id, item_size, item_color, brand_id, item_price, "
    "CAST(user_id AS VARCHAR) AS user_id, user_title, user_dob, user_state, user_reg_date, \"return\" FROM sent",
    na_values=("not_reported", "?", "1994-12-31")))
def csv_roundtrip(spark, sf_dir):
    """Raw order items written as CSV with text dates and the columns in another order, read back
    by name with the typed scan."""
    import uuid

    from ..session import scratch_path
    from ..sources import adapter, scan
    raw = adapter.order_items(spark, sf_dir)
    text = raw.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if c in scan.DATE_COLUMNS else F.col(f"`{c}`")
                        for c in sorted(raw.columns)])
    path = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    scan.write_order_items_csv(text, path)
    return scan.read_order_items_csv(spark, path, scan.EDA_NA_VALUES).drop("order_item_id")


def _name_list_sql():
    return f"SELECT feature_name AS name FROM ({_expansion_sql()})"


@register("name_lists", _name_list_sql())
def name_lists(spark, sf_dir):
    """A keep-list written one name per line (with a duplicate and a blank line), read back distinct."""
    import uuid

    from ..operators import features as FT
    from ..session import scratch_path
    from ..sources import lists
    spec = FT.fit(inputs(spark, sf_dir, materialize=True).history)
    names = FT.expand_names(spec)
    lines = spark.createDataFrame([(n,) for n in names + [names[0], ""]], "value string")
    path = scratch_path(spark, f"names-{uuid.uuid4().hex}")
    lines.write.mode("overwrite").text(path)
    return lists.read_name_list(spark, path)


@register("trials_log")
def trials_log(spark, sf_dir):
    """Forest importances written as a ranked log, the top names extracted back from its tail."""
    import uuid

    from ..session import scratch_path
    from ..sources import lists, sinks
    imp = forest_importance(spark, sf_dir)
    path = scratch_path(spark, f"importance-log-{uuid.uuid4().hex}")
    sinks.write_importance_log(imp, path)
    return lists.important_variables(spark, path, tail=300, top=61)
