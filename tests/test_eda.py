"""Correlations with nulls and constants, whole-table profile, exact quantiles over ranges."""

import numpy as np
import pandas as pd
import pytest

from orderlens.operators import eda
from orderlens.operators import lookups as L


def test_pairwise_correlation(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(1e4, 1, (300, 4)), columns=list("abcd"))
    pdf["b"] += 0.8 * pdf["a"]
    pdf["c"] = pdf["c"].where(rng.random(300) < 0.6)
    pdf["a"] = pdf["a"].where(rng.random(300) < 0.7)
    pdf["k"] = 7.0
    pdf["e"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in pdf)).repartition(5)
    got = {(r["var1"], r["var2"]): r["correlation"] for r in eda.corr_long(df, list(pdf)).collect()}
    want = pdf.astype(float).corr()
    assert len(got) == 30
    for (a, b), r in got.items():
        if np.isnan(want.loc[a, b]) or "k" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-9)


@pytest.mark.parametrize("block,held", [(128, 1 << 26), (3, 1 << 26), (2, 100)])
def test_correlation_in_blocks(spark, block, held):
    rng = np.random.default_rng(4)
    x = rng.normal(1e4, 1, (400, 11))
    x[:, 1] += 2 * x[:, 0]
    x[:, 5] = 3.3                                          # constant
    x[rng.random((400, 11)) < 0.1] = np.nan
    x[:, 7] = rng.normal(0, 1e-6, 400) + 1e-3 * x[:, 7]
    names = [f"f{i}" for i in range(11)]
    rows = [([None if np.isnan(v) else float(v) for v in r],) for r in x] + [(None,)]
    df = spark.createDataFrame(rows, "x array<double>").repartition(4)
    got = {(r["var1"], r["var2"]): r["correlation"] for r in eda.corr_arrays(df, names, block=block, held_bytes=held).collect()}
    want = pd.DataFrame(x, columns=names).corr()
    assert len(got) == 11 * 10
    for (a, b), r in got.items():
        if "f5" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-8)


def test_profile(spark):
    rows = [("x", 1.0, True, 3), ("y", 2.5, None, 3), ("y", None, False, 1), (None, 2.5, False, None), ("x", 9.0, False, 2)]
    df = spark.createDataFrame(rows, "s string, d double, f boolean, i int")
    got = {r["column_name"]: r for r in eda.table_profile(df).collect()}
    want = pd.DataFrame({"d": [1.0, 2.5, None, 2.5, 9.0], "i": [3, 3, 1, None, 2]}).describe()
    for c in "di":
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want[c][theirs])
    assert (got["s"]["kind"], got["s"]["count"], got["s"]["n_nulls"], got["s"]["n_unique"], got["s"]["top"], got["s"]["freq"]) == ("text", 4, 1, 2, "x", 2)
    assert (got["f"]["kind"], got["f"]["top"], got["f"]["freq"], got["f"]["n_nulls"]) == ("flag", "false", 3, 1)
    assert got["d"]["top"] is None and got["s"]["mean"] is None


def test_price_quantiles(spark):
    rng = np.random.default_rng(0)
    prices = rng.exponential(50, 5000).round(2)
    prices[:2000] = 19.9                                   # one price holds a large part of the rows
    df = spark.createDataFrame([(float(p),) for p in prices] + [(None,)], "item_price double").repartition(6)
    assert tuple(L.price_quantiles(df).first()) == pytest.approx(tuple(np.quantile(prices, [0.25, 0.5, 0.75])))
    assert tuple(L.price_quantiles(df.limit(0)).first()) == (None, None, None)
