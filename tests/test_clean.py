"""Cleaning rules on a hand fixture (one row per rule) and size bucketing edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.functions import colors, sizes
from orderlens.operators import clean as cl
from orderlens.sources.scan import EDA_NA_VALUES, apply_sentinels

D = dt.date
SCHEMA = ("order_item_id string, order_date date, delivery_date date, item_id long, item_size string, "
          "item_color string, brand_id string, item_price double, user_id long, user_title string, "
          "user_dob date, user_state string, user_reg_date date, `return` int")


def rows():
    base = dict(order_date=D(2012, 6, 1), delivery_date=D(2012, 6, 4), item_id=1, item_size="xl",
                item_color="red", brand_id="b1", item_price=10.0, user_id=1, user_title="Mrs",
                user_dob=D(1970, 1, 1), user_state="S1", user_reg_date=D(2011, 1, 1), ret=1)
    out = []

    def add(i, **kw):
        r = dict(base)
        r.update(kw)
        out.append((str(i), r["order_date"], r["delivery_date"], r["item_id"], r["item_size"], r["item_color"],
                    r["brand_id"], r["item_price"], r["user_id"], r["user_title"], r["user_dob"], r["user_state"],
                    r["user_reg_date"], r["ret"]))
    add(1, delivery_date=D(1994, 12, 31))                      # sentinel delivery
    add(2, delivery_date=D(2012, 6, 8))                        # 7 days
    add(3, user_dob=D(1900, 11, 19))                           # implausible dob
    add(4, user_dob=D(1926, 6, 1))                             # year 1926 -> null
    add(5, user_dob=D(1927, 6, 1))                             # 1927 kept
    add(6, user_reg_date=D(2013, 1, 1))                        # registration after order -> tenure 0
    add(7, item_size="4+", item_price=0.0)                     # underwear size, gift
    add(8, item_size="4032")                                   # pants
    add(9, item_size="unsized", item_color="?")                # non clothing; '?' colour
    add(10, item_size="XXXL", item_color="brwon")
    add(11, item_size="15", user_title="not_reported")
    add(12, item_size="30", delivery_date=D(2012, 6, 2))
    return out


@pytest.fixture(scope="module")
def cleaned(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    return {r["order_item_id"]: r for r in cl.clean(df).collect()}


def test_delivery_sentinel_imputed_with_median(cleaned):
    # non-missing offsets: 3 x 10 rows, 7, 1 -> median 3
    r = cleaned["1"]
    assert r["is_na_delivery_date"] and r["days_to_delivery"] == 3
    assert r["delivery_date"] == D(2012, 6, 4)
    assert not cleaned["2"]["is_na_delivery_date"] and cleaned["2"]["days_to_delivery"] == 7


def test_dob_rules(cleaned):
    assert cleaned["3"]["is_dob_missing"] and cleaned["4"]["is_dob_missing"]
    assert not cleaned["5"]["is_dob_missing"]
    assert cleaned["5"]["user_dob"] == D(1927, 6, 1)
    # imputed: reg - median(reg - dob); age consistent with the imputed gap
    r = cleaned["3"]
    assert r["age"] == (r["order_date"] - r["user_reg_date"]).days + (r["user_reg_date"] - r["user_dob"]).days


def test_tenure_clamp_and_squares(cleaned):
    r = cleaned["6"]
    assert r["user_tenure"] == 0 and r["user_tenure2"] == 0
    assert cleaned["2"]["age2"] == cleaned["2"]["age"] ** 2


def test_size_flags(cleaned):
    assert cleaned["7"]["is_item_underwear"] and not cleaned["7"]["is_item_pants"]
    assert cleaned["8"]["is_item_pants"]
    assert not cleaned["9"]["is_item_clothes"]
    assert cleaned["1"]["is_letter_coded"]


def test_size_bucket(cleaned):
    assert cleaned["7"]["item_size_cl"] == "S"          # 4.5 in (0, 15): 3 <= x < 6
    assert cleaned["8"]["item_size_cl"] == "XL"         # 4032 in the last bin of (2930, 4035)
    assert cleaned["9"]["item_size_cl"] == "UNSIZED"
    assert cleaned["10"]["item_size_cl"] == "XL"        # XXXL -> XL
    assert cleaned["11"]["item_size_cl"] is None        # 15 lies between ranges
    assert cleaned["12"]["item_size_cl"] == "XS"        # 30 falls into the later range


def test_colours_and_titles(cleaned):
    assert cleaned["9"]["color"] == "other"
    assert cleaned["10"]["color"] == "brownish"
    assert cleaned["1"]["color"] == "redish"
    assert cleaned["11"]["user_title"] is None


def test_weekday_flags_monday_zero(cleaned):
    # 2012-06-08 is a Friday -> weekday 4 -> 'delivery_thu' (named after the original code)
    assert cleaned["2"]["delivery_thu"] and not cleaned["2"]["delivery_fri"]


def test_eda_sentinel_question_mark(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    s = {r["order_item_id"]: r for r in apply_sentinels(df, EDA_NA_VALUES).collect()}
    assert s["9"]["item_color"] is None


def test_bucket_edges_match_rule():
    conds = sizes.bucket_conditions()
    assert len(conds) == 30
    assert conds[5][0] == 18.0 and conds[9][1] == 30.0
    # the same grid rule as an evenly spaced 6-point grid
    assert sizes.bin_edges(18, 30)[1] == 18 + (30 - 18) / 5


def test_colour_map_size():
    assert len(colors.COLOR_FAMILIES) == 85
    assert len(set(colors.COLOR_FAMILIES.values())) == 14


def test_clean_is_one_stage_without_python(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    plan = cl.clean(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert F is not None


def test_sizes_with_letters_are_not_numbers(spark):
    from orderlens.functions import sizes
    rows = [("75D",), ("80F",), ("42d",), ("1e1",), ("nan",), ("38+",), ("15",), ("xxl",), (None,)]
    df = spark.createDataFrame(rows, "s string").select("s", sizes.clean_size("s").alias("c"))
    got = {r["s"]: r["c"] for r in df.collect()}
    assert got == {"75D": "75D", "80F": "80F", "42d": "42D", "1e1": "L", "nan": None, "38+": "S", "15": None, "xxl": "XL", None: None}


def test_csv_by_name_with_missing_tokens(spark, tmp_path):
    from orderlens.sources import scan
    (tmp_path / "x.csv").write_text(
        "user_id,delivery_date,item_id,order_date,item_price,item_color,user_title,return\n"
        "U7,?,A12,2012-06-22,49.9,NA,not_reported,1\n"
        "8,1994-12-31,13,2012-06-23,nan,red,Mrs,\n"
        "9,2012-06-25,14,bad,null,n/a,Mr,0\n")
    rows = {r["user_id"]: r for r in scan.read_order_items_csv(spark, str(tmp_path), scan.EDA_NA_VALUES).collect()}
    assert rows["U7"]["item_id"] == "A12" and rows["U7"]["delivery_date"] is None and rows["U7"]["item_price"] == 49.9
    assert rows["U7"]["item_color"] is None and rows["U7"]["user_title"] is None and rows["U7"]["return"] == 1
    assert rows["8"]["delivery_date"] is None and rows["8"]["item_price"] is None and rows["8"]["return"] is None
    assert rows["9"]["order_date"] is None and str(rows["9"]["delivery_date"]) == "2012-06-25" and rows["9"]["item_price"] is None


def test_split_key_of_any_id(spark):
    import datetime as dt
    from orderlens.operators import split
    rows = [(2**62, -2**62, dt.date(2012, 1, 1)), (5, 7, dt.date(1960, 1, 1))]
    df = spark.createDataFrame(rows, "item_id long, user_id long, order_date date")
    days = [(r[2] - dt.date(1970, 1, 1)).days for r in rows]
    want = [(i * 7919 + u * 104729 + d * 1299709) % 100 for (i, u, _), d in zip(rows, days)]
    assert [r[0] for r in df.select(split.split_key()).collect()] == want
    text = spark.createDataFrame([("A12", "U7", dt.date(2012, 1, 1))], "item_id string, user_id string, order_date date")
    assert 0 <= text.select(split.split_key()).first()[0] < 100
    copies = spark.range(20000).select(split.poisson_one(["id"], 3).alias("c")).groupBy("c").count().collect()
    share = {r["c"]: r["count"] / 20000 for r in copies}
    assert abs(share[0] - 0.3679) < 0.015 and abs(share[1] - 0.3679) < 0.015 and abs(share[3] - 0.0613) < 0.01
