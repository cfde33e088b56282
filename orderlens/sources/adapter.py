"""Adapter: driver tables -> raw order-item table (FIXTURES F2).

``lineitem ⨝ orders ⨝ customer ⨝ nation ⨝ part`` (inner, every key matches).
The result has the raw order-item schema, sentinels included
(``delivery_date = 1994-12-31`` and ``user_title = 'not_reported'``), so the
cleaning layer sees the same kind of input it was written for.

Scale notes: lineitem meets part, then orders that have met their customers (shuffle on
the order key, or co-located if both are bucketed by it).  ``nation`` is a fixed
25-row dimension and is broadcast explicitly; customer and part are left to
the planner, whose broadcast threshold is a size check of its own.  Only the
columns used below are read (parquet column pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values of the adapter rules
DELIVERY_SENTINEL = "1994-12-31"
TITLE_SENTINEL = "not_reported"
LETTER_SIZES = ["xs", "S", "m", "L", "XXL", "xxxl"]
TITLES = {"MACHINERY": "not_reported", "BUILDING": "Mr", "HOUSEHOLD": "Mrs", "FURNITURE": "Family"}
TITLE_DEFAULT = "Company"

RAW_COLUMNS = [
    "order_item_id", "order_date", "delivery_date", "item_id", "item_size", "item_color",
    "brand_id", "item_price", "user_id", "user_title", "user_dob", "user_state",
    "user_reg_date", "return",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order items (F1 schema) derived from the driver tables."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")

    pk = F.col("p_partkey")
    letters = F.array(*[F.lit(s) for s in LETTER_SIZES])
    size = (F.when(pk % 6 == 0, F.lit("unsized"))
              .when(pk % 6 == 1, F.element_at(letters, (F.floor(pk / 6) % 6 + 1).cast("int")))
              .when(pk % 6 == 2, F.col("p_size").cast("string"))
              .when(pk % 6 == 3, F.concat(F.col("p_size").cast("string"), F.lit("+")))
              .when(pk % 6 == 4, (F.lit(2932) + (pk * 17) % 1100).cast("string"))
              .otherwise((F.lit(76) + pk % 101).cast("string")))
    # what the line items take of a part: a word of its name, not the name, goes through the shuffles
    p = p.select("p_partkey", "p_brand", size.alias("item_size"), F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("item_color"))

    seg = F.col("c_mktsegment")
    title = F.lit(TITLE_DEFAULT)
    for k, v in reversed(list(TITLES.items())):
        title = F.when(seg == k, F.lit(v)).otherwise(title)

    # orders meet their customers before the line items, which are then moved twice only: to the parts and to the orders.
    # Orders grow with the line items: always the co-partitioned join, whatever today's size
    of = (o.join(c, o.o_custkey == c.c_custkey)
           .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)    # fixed 25-row dimension
           .select("o_orderkey", "o_custkey", "o_orderdate", title.alias("user_title"), "n_name"))
    price = (F.when((F.col("l_linenumber") == 7) & (F.col("l_quantity") >= 48), F.lit(0.0))
              .otherwise(F.col("l_extendedprice")))
    ret = (F.when(F.col("l_returnflag") == "R", F.lit(1))
             .when(F.col("l_returnflag") == "A", F.lit(0))
             .otherwise(F.lit(None).cast("int")))
    li = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate", price.alias("item_price"), ret.alias("return"))
    j = li.join(p, li.l_partkey == p.p_partkey).join(of.hint("merge"), li.l_orderkey == o.o_orderkey)

    order_date = F.col("o_orderdate").cast("date")
    ship_days = F.datediff(F.col("l_shipdate"), F.col("o_orderdate"))
    delivery = (F.when(F.col("l_shipdate") >= F.col("o_orderdate"),
                       F.date_add(order_date, (ship_days % 30).cast("int")))
                 .otherwise(F.lit(DELIVERY_SENTINEL).cast("date")))

    ck = F.col("o_custkey")
    dob = (F.when(ck % 10 == 0, F.lit(None).cast("date"))
             .when(ck % 10 == 1, F.lit("1900-11-19").cast("date"))
             .otherwise(F.date_add(F.lit("1940-01-01").cast("date"), ((ck * 131) % 18000).cast("int"))))
    reg = F.date_add(F.lit("1995-01-01").cast("date"), ((ck * 13) % 900).cast("int"))

    key = F.concat_ws("-", *[F.col(x).cast("string") for x in
                             ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")])

    return j.select(
        key.alias("order_item_id"),
        order_date.alias("order_date"),
        delivery.alias("delivery_date"),
        F.col("l_partkey").alias("item_id"),
        "item_size",
        "item_color",
        F.col("p_brand").alias("brand_id"),
        "item_price",
        F.col("o_custkey").alias("user_id"),
        "user_title",
        dob.alias("user_dob"),
        F.col("n_name").alias("user_state"),
        reg.alias("user_reg_date"),
        "return",
    )


# The same adapter in DuckDB SQL (a CTE body), used by the oracle queries.
ADAPTER_SQL = """
SELECT
  concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) AS order_item_id,
  CAST(o.o_orderdate AS DATE) AS order_date,
  CASE WHEN l.l_shipdate >= o.o_orderdate
       THEN CAST(o.o_orderdate AS DATE) + CAST(date_diff('day', o.o_orderdate, l.l_shipdate) % 30 AS INTEGER)
       ELSE DATE '1994-12-31' END AS delivery_date,
  l.l_partkey AS item_id,
  CASE p.p_partkey % 6
       WHEN 0 THEN 'unsized'
       WHEN 1 THEN ['xs', 'S', 'm', 'L', 'XXL', 'xxxl'][CAST((p.p_partkey // 6) % 6 + 1 AS INTEGER)]
       WHEN 2 THEN CAST(p.p_size AS VARCHAR)
       WHEN 3 THEN CAST(p.p_size AS VARCHAR) || '+'
       WHEN 4 THEN CAST(2932 + (p.p_partkey * 17) % 1100 AS VARCHAR)
       ELSE CAST(76 + p.p_partkey % 101 AS VARCHAR) END AS item_size,
  split_part(p.p_name, ' ', 1) AS item_color,
  p.p_brand AS brand_id,
  CASE WHEN l.l_linenumber = 7 AND l.l_quantity >= 48 THEN CAST(0.0 AS DOUBLE) ELSE l.l_extendedprice END AS item_price,
  o.o_custkey AS user_id,
  CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'not_reported' WHEN 'BUILDING' THEN 'Mr'
       WHEN 'HOUSEHOLD' THEN 'Mrs' WHEN 'FURNITURE' THEN 'Family' ELSE 'Company' END AS user_title,
  CASE WHEN c.c_custkey % 10 = 0 THEN NULL
       WHEN c.c_custkey % 10 = 1 THEN DATE '1900-11-19'
       ELSE DATE '1940-01-01' + CAST((c.c_custkey * 131) % 18000 AS INTEGER) END AS user_dob,
  n.n_name AS user_state,
  DATE '1995-01-01' + CAST((c.c_custkey * 13) % 900 AS INTEGER) AS user_reg_date,
  CAST(CASE l.l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS INTEGER) AS "return"
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
"""
