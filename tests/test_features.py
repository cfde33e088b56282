"""Fitted tables and feature transform: leakage, WOE smoothing, imputation, one-hots, expansion."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from orderlens.operators import features as FT
from orderlens.operators import lookups as L

D = dt.date
SCHEMA = ("user_id long, order_date date, item_id long, brand_id string, item_price double, item_size string, "
          "item_color string, user_state string, days_to_delivery long, month long, `return` int")


@pytest.fixture(scope="module")
def hist(spark):
    rows = [
        # user 1: three labelled baskets and one unlabelled basket in between
        (1, D(2012, 1, 1), 10, "b1", 10.0, "m", "red", "S1", 2, 1, 1),
        (1, D(2012, 1, 1), 11, "b2", 20.0, "l", "blue", "S1", 3, 1, 0),   # basket of two brands
        (1, D(2012, 2, 1), 10, "b1", 10.0, "m", "red", "S1", 2, 2, None),  # unlabelled
        (1, D(2012, 3, 1), 12, "b1", 30.0, "m", "red", "S1", 4, 3, 0),
        (1, D(2012, 4, 1), 12, "b1", 0.0, "s", "green", "S1", 1, 4, 1),    # gift
        (2, D(2012, 1, 5), 13, "b3", 15.0, "xl", "black", "S2", 5, 1, 0),  # category without returns
        (2, D(2012, 1, 5), 10, "b1", 12.0, "m", "red", None, 2, 1, 0),     # null state
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_return_history_has_no_leak(hist):
    h = {(r["user_id"], r["order_date"]): r for r in L.fit_return_history(hist).collect()}
    assert (1, D(2012, 2, 1)) not in h                      # unlabelled basket: no history row
    assert h[(1, D(2012, 1, 1))]["history"] == 0.0           # first basket never sees its own label
    assert h[(1, D(2012, 3, 1))]["history"] == 1.0           # previous labelled basket was returned
    assert h[(1, D(2012, 4, 1))]["history"] == 0.0
    assert h[(1, D(2012, 4, 1))]["history_cumsum"] == 1.0
    assert math.isclose(h[(1, D(2012, 4, 1))]["history_perc"], 1.0 / 3)


def test_woe_smoothing_and_sign(hist):
    w = {r["item_color"]: r["woe_item_color"] for r in L.fit_woe(hist.filter(F.col("return").isNotNull()),
                                                                 "item_color").collect()}
    # labelled: 6 rows, 2 events; red: 1 event / 2 non-events
    assert math.isclose(w["red"], math.log((1 / 2) / (2 / 4)))
    # black has no events -> 0.5
    assert math.isclose(w["black"], math.log((0.5 / 2) / (1 / 4)))
    # green: 1 event, no non-events -> 0.5 -> ln((1/2) / (0.5/4)) = ln 4 > 0
    assert math.isclose(w["green"], math.log(4.0)) and w["green"] > 0


def test_orders_fan_out_and_seqnum(hist):
    o = L.fit_orders(hist).filter((F.col("user_id") == 1) & (F.col("order_date") == D(2012, 1, 1))).collect()
    assert sorted(r["brand_id"] for r in o) == ["b1", "b2"]
    assert all(r["order_num_items"] == 2 and r["order_seqnum"] == 1 for r in o)
    assert all(r["order_total_value"] == 30.0 and r["order_median_price"] == 15.0 for r in o)


def test_transform_imputes_unseen(spark, hist):
    spec = FT.fit(hist)
    x = spark.createDataFrame([(9, D(2013, 1, 1), 99, "zz", 5.0, "m", "red", "S9", 3, 1, None)], SCHEMA)
    names = ["item_orders", "order_num_items", "order_num_brand_id", "brand_mean_price", "state_mean_delivery",
             "history", "order_has_gift", "price_off"]
    r = FT.transform(spec, x, names, keep=()).first()
    assert r["order_num_items"] == 1.0 and r["order_num_brand_id"] == 0.0 and r["history"] == 0.0
    assert math.isclose(r["item_orders"], spec.means("items")["item_orders"])
    assert math.isclose(r["brand_mean_price"], spec.means("brands")["brand_mean_price"])


def test_ratio_and_interaction_by_name(spark, hist):
    spec = FT.fit(hist)
    x = hist.filter(F.col("return").isNotNull())
    r = FT.transform(spec, x, ["item_price/order_num_items", "item_price*order_num_items"], keep=("item_price",)) \
        .filter(F.col("item_price") == 30.0).first()
    assert r["item_price/order_num_items"] == 30.0 / 2 and r["item_price*order_num_items"] == 30.0


def test_onehots_sum_at_most_one(spark, hist):
    spec = FT.fit(hist)
    names = [f"user_state_{v}" for v in spec.categories["user_state"]]
    out = FT.transform(spec, hist, names, keep=())
    s = out.select(sum(F.col(f"`{n}`") for n in names).alias("s")).collect()
    assert all(r["s"] <= 1 for r in s)
    assert any(r["s"] == 0 for r in s)                      # null state -> all zeros


def test_expansion_rules(spark):
    from orderlens.plans.context import inputs
    spec = FT.fit(inputs(spark, "/root/testdata/sf0.001").history)
    names = FT.expand_names(spec)
    # base 38 - 8 flags - order_has_gift, + price_off, ratios, 19 x 19 interactions minus 6 flag rows
    assert sum("*" in n for n in names) == 19 * 19 - 6 * 19
    assert not any(n.startswith("is") for n in names)
    assert "price_off" in names
    assert all("woe" not in n for n in names)
    # denominators whose minimum is 0 never appear
    assert not any(n.endswith("/history") for n in names)


def test_ratio_over_minus_one_gets_the_mean(spark, hist):
    """A denominator of -1 makes b + 1 zero: the value is the column's mean over the batch, never null."""
    rows = [(1, D(2012, 1, 1), 10, "b1", 10.0, "m", "red", "S1", d, 1, 1) for d in (-1, 1, 4)]
    x = spark.createDataFrame(rows, SCHEMA)
    spec = FT.fit(hist)
    got = sorted(r[0] for r in FT.transform(spec, x, ["item_price/days_to_delivery"], keep=()).collect())
    assert got == pytest.approx(sorted([10 / 2, 10 / 5, (10 / 2 + 10 / 5) / 2]))
    fit = FT.fit(x.withColumn("item_price", F.lit(6.0)))
    again = sorted(r[0] for r in FT.transform(fit, x, ["item_price/days_to_delivery"], keep=(), impute="fit").collect())
    assert again == pytest.approx(sorted([10 / 2, 10 / 5, (6 / 2 + 6 / 5) / 2]))


def test_feature_array_equals_columns(spark, hist):
    spec = FT.fit(hist)
    names = ["item_price", "woe_item_color", "item_price/order_num_items", "user_state_S1", "is_q1_value", "history"]
    wide = sorted(tuple(r) for r in FT.transform(spec, hist, names, keep=()).collect())
    assert sorted(tuple(r["x"]) for r in FT.feature_array(spec, hist, names, keep=()).collect()) == wide


def test_vectors_are_made_without_an_array(spark, hist):
    from pyspark.ml.linalg import VectorUDT
    spec = FT.fit(hist)
    names = ["item_price", "woe_item_color", "item_price/order_num_items", "user_state_S1", "is_q1_value", "history"]
    df = FT.feature_array(spec, hist, names, keep=(), vectors={"features": names, "two": names[2:4]})
    assert df.schema["features"].dataType == VectorUDT()
    rows = df.collect()
    assert [r["features"].toArray().tolist() for r in rows] == [r["x"] for r in rows]
    assert [r["two"].toArray().tolist() for r in rows] == [r["x"][2:4] for r in rows]
    plan = df.select("two")._jdf.queryExecution().executedPlan().toString()
    assert "UDF(" not in plan and plan.count("ArrowEvalPython") == 1


def test_small_tables_are_broadcast_and_written_once(spark, hist):
    from orderlens import session
    spec = FT.fit(hist)
    written = []
    real = session.materialize
    session.materialize = lambda df, name="table": written.append(name) or real(df, name)
    try:
        for _ in range(2):
            out = FT.transform(spec, hist, ["brand_mean_price", "state_mean_delivery", "woe_month", "item_orders"], keep=())
    finally:
        session.materialize = real
    assert sorted(written) == ["fit-brands", "fit-items", "fit-states", "fit-woe_month"]
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_array_is_made_of_a_written_table_of_its_columns(spark, hist, monkeypatch):
    """Many passes read the joined columns; the wide array is never written, and is what ``transform`` gives."""
    from orderlens import session
    written = {}
    plain = session.materialize
    monkeypatch.setattr(session, "materialize", lambda df, name="table": written.setdefault(name, plain(df, name)))
    spec = FT.fit(hist)
    names = ["item_price", "item_price/order_num_items", "item_price*item_max_price", "is_q1_value*is_q1_value", "price_off/item_price",
             "item_max_delivery/item_price", "woe_item_color", "user_state_S1", "user_state_none", "month_3"]
    late = hist.withColumn("item_price", F.when(F.col("item_id") == 13, -1.0).otherwise(F.col("item_price")))  # a denominator of 0
    got = {(r["item_id"], r["order_date"]): r["x"] for r in
           FT.feature_array(spec, late, names, keep=("item_id", "order_date"), write="joined").collect()}
    want = {(r["item_id"], r["order_date"]): [r[n] for n in names] for r in FT.transform(spec, late, names, keep=("item_id", "order_date")).collect()}
    assert got == want
    assert "array" not in {t.split("<")[0] for _, t in written["joined"].dtypes}


def test_flags_settle_an_interaction_with_a_missing_one(spark, hist):
    spec = FT.fit(hist)
    rows = hist.withColumn("delivery_thu", F.when(F.col("item_id") == 10, None).otherwise(F.col("item_id") == 11)).withColumn(
        "delivery_fri", F.when(F.col("item_id") == 13, None).otherwise(F.col("user_state").isNull()))
    names = ["delivery_thu*delivery_fri", "delivery_thu/item_price"]
    key = lambda r: (r["item_id"], r["order_date"], r["user_id"])
    keep = ("item_id", "order_date", "user_id")
    got = {key(r): r["x"] for r in FT.feature_array(spec, rows, names, keep=keep).collect()}
    assert got == {key(r): [r[n] for n in names] for r in FT.transform(spec, rows, names, keep=keep).collect()}


def test_the_matrix_is_equal_by_cells_and_from_rows_joined_once(spark):
    """A pass that expands cells itself, and rows that were joined for profile and matrix alike, give the array's values."""
    import numpy as np

    from orderlens.plans.context import inputs
    i = inputs(spark, "/root/testdata/sf0.001", materialize=True)
    plain, once = FT.fit(i.history), FT.fit(i.history, raw=i.sentinel, clean=i.cleaned)
    known = once.joined(("order_item_id",)).filter(F.col("return").isNotNull())
    names = FT.expand_names(plain, ignore_woe=False, add_dummies=True)
    assert FT.expand_names(once, ignore_woe=False, add_dummies=True) == names and len(names) > 500
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "joined-rows" in plan
    want = {r["order_item_id"]: r["x"] for r in FT.feature_array(plain, i.known, names, keep=("order_item_id",)).collect()}
    cells, expansion = FT.feature_array(once, known, names, keep=("order_item_id",), cells="c", joined=True)
    cells = cells.drop("x")
    assert len(cells.first()["c"]) < 100
    rows = cells.toArrow()
    got = np.concatenate(list(expansion.parts(rows["c"].combine_chunks(), rows=700)))
    assert got.shape == (len(want), len(names))
    wanted = np.array([[np.nan if v is None else v for v in want[k]] for k in rows["order_item_id"].to_pylist()])
    assert np.allclose(got, wanted, rtol=1e-12, equal_nan=True)


def test_cells_with_nulls_expand_as_the_array(spark, hist):
    import numpy as np
    names = ["item_price", "woe_item_color", "item_price/order_seqnum", "days_to_delivery*item_price", "month_2", "month_4", "order_seqnum/item_price"]
    spec = FT.fit(hist)
    rows = hist.withColumn("days_to_delivery", F.when(F.col("item_id") != 11, F.col("days_to_delivery")))
    rows = rows.withColumn("item_price", F.when(F.col("item_id") == 10, -1.0).when(F.col("item_id") != 13, F.col("item_price")))
    want = [[np.nan if v is None else v for v in r["x"]] for r in FT.feature_array(spec, rows, names, keep=()).collect()]
    cells, expansion = FT.feature_array(spec, rows, names, keep=(), cells="c")
    got = np.concatenate(list(expansion.parts(cells.select("c").toArrow()["c"].combine_chunks(), rows=2)))
    key = lambda m: sorted(map(repr, np.round(m, 9).tolist()))
    assert key(got) == key(np.array(want))
