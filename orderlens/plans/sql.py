"""DuckDB oracle SQL building blocks.

Each oracle query is ``WITH <chain of CTEs> <final SELECT>``.  The CTEs
re-state the pipeline in plain SQL (adapter, sentinels, medians, cleaning,
fitted tables, ...); the final SELECT states the operator under test.
"""

from __future__ import annotations

from ..functions import colors, sizes
from ..sources.adapter import ADAPTER_SQL

_STRING_COLS = ["order_item_id", "item_size", "item_color", "brand_id", "user_title", "user_state"]
_DATE_COLS = ["order_date", "delivery_date", "user_dob", "user_reg_date"]
_RAW = ["order_item_id", "order_date", "delivery_date", "item_id", "item_size", "item_color",
        "brand_id", "item_price", "user_id", "user_title", "user_dob", "user_state", "user_reg_date", '"return"']


def _sentinel_select(na_values) -> str:
    na = ", ".join(f"'{v}'" for v in na_values)
    cols = []
    for c in _RAW:
        if c in _STRING_COLS:
            cols.append(f"CASE WHEN {c} IN ({na}) THEN NULL ELSE {c} END AS {c}")
        elif c in _DATE_COLS:
            cols.append(f"CASE WHEN strftime({c}, '%Y-%m-%d') IN ({na}) THEN NULL ELSE {c} END AS {c}")
        else:
            cols.append(c)
    return "SELECT " + ", ".join(cols) + " FROM raw"


def size_cl_sql(col: str) -> str:
    s = (f"regexp_replace(regexp_replace(replace(upper({col}), '+', '.5'), "
         f"'[xX]{{2,}}[Ll]', 'XL', 'g'), '[xX]{{2,}}[Ss]', 'XS', 'g')")
    # a decimal number, by the rule rather than by what a cast accepts
    x = (f"CASE WHEN regexp_matches({s}, '^\\s*[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?\\s*$') THEN TRY_CAST({s} AS DOUBLE) "
         f"WHEN upper(trim({s})) IN ('NAN', 'INF', '-INF', 'INFINITY') THEN CAST('nan' AS DOUBLE) END")
    return f"CASE WHEN {x} IS NULL THEN {s} ELSE {sizes.size_bucket_sql(x)} END"


COLOR_VALUES = colors.color_map_sql_values()

CLEAN_SELECT = f"""
SELECT b.order_item_id, b.order_date, b.item_id, b.item_size, b.item_color, b.brand_id, b.item_price,
  b.user_id, b.user_title, b.user_state, b.user_reg_date, b."return",
  CASE WHEN b.delivery_date IS NULL THEN b.order_date + CAST(floor(m.m_del) AS INTEGER) ELSE b.delivery_date END AS delivery_date,
  CASE WHEN b.dob0 IS NULL THEN b.user_reg_date - CAST(ceil(m.m_dob) AS INTEGER) ELSE b.dob0 END AS user_dob,
  coalesce(cm.color, 'other') AS color,
  b.delivery_date IS NULL AS is_na_delivery_date,
  b.dob0 IS NULL AS is_dob_missing,
  regexp_matches(b.item_size, '^[0-9]{{4}}') AS is_item_pants,
  regexp_matches(b.item_size, '^[3-9]\\+?$') AS is_item_underwear,
  regexp_matches(b.item_size, '^[xlsmXLSM]') AS is_letter_coded,
  NOT starts_with(b.item_size, 'unsized') AS is_item_clothes,
  CAST(CASE WHEN b.delivery_date IS NULL THEN floor(m.m_del) ELSE date_diff('day', b.order_date, b.delivery_date) END AS BIGINT) AS days_to_delivery,
  CAST(CASE WHEN date_diff('day', b.user_reg_date, b.order_date) < 0 THEN 0 ELSE date_diff('day', b.user_reg_date, b.order_date) END AS BIGINT) AS user_tenure,
  CAST(CASE WHEN b.dob0 IS NULL THEN date_diff('day', b.user_reg_date, b.order_date) + floor(m.m_dob)
            ELSE date_diff('day', b.dob0, b.order_date) END AS BIGINT) AS age,
  b.item_price * b.item_price AS item_price2,
  {size_cl_sql('b.item_size')} AS item_size_cl
FROM base b
JOIN med m ON (b."return" IS NOT NULL) = m.known_
LEFT JOIN (VALUES {COLOR_VALUES}) cm(item_color, color) ON b.item_color = cm.item_color
"""

# the cleaned table with the remaining derived columns (month, weekdays, squares)
CLEAN2_SELECT = """
SELECT *, CAST(month(delivery_date) AS BIGINT) AS month,
  isodow(delivery_date) = 5 AS delivery_thu,
  isodow(delivery_date) = 6 AS delivery_fri,
  age * age AS age2,
  user_tenure * user_tenure AS user_tenure2
FROM clean0
"""


def ctes(na_values=("not_reported", "1994-12-31")) -> list[tuple[str, str]]:
    return [
        ("raw", ADAPTER_SQL),
        ("sent", _sentinel_select(na_values)),
        ("base", "SELECT *, CASE WHEN year(user_dob) <= 1926 THEN NULL ELSE user_dob END AS dob0 FROM sent"),
        ("med", """SELECT ("return" IS NOT NULL) AS known_,
                    median(date_diff('day', order_date, delivery_date)) AS m_del,
                    median(date_diff('day', dob0, user_reg_date)) AS m_dob
                   FROM base GROUP BY 1"""),
        ("clean0", CLEAN_SELECT),
        ("clean", CLEAN2_SELECT),
        ("known", 'SELECT * FROM clean WHERE "return" IS NOT NULL'),
        ("unknown", 'SELECT * FROM clean WHERE "return" IS NULL'),
        ("history", "SELECT * FROM clean"),
    ]


def with_ctes(final: str, extra: list[tuple[str, str]] | None = None, na_values=("not_reported", "1994-12-31")) -> str:
    parts = ctes(na_values) + (extra or [])
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in parts)
    return f"WITH {body}\n{final}"


# ------------------------------------------------------------------ fitted tables

def woe_sql(var: str) -> str:
    return f"""SELECT {var}, ln((CASE WHEN g.ev = 0 THEN 0.5 ELSE g.ev END / t.te)
                 / (CASE WHEN g.cnt - g.ev = 0 THEN 0.5 ELSE g.cnt - g.ev END / (t.n - t.te))) AS woe_{var}
FROM (SELECT {var}, CAST(sum("return") AS DOUBLE) AS ev, CAST(count("return") AS DOUBLE) AS cnt
      FROM known WHERE {var} IS NOT NULL GROUP BY {var}) g
CROSS JOIN (SELECT CAST(sum("return") AS DOUBLE) AS te, CAST(count(*) AS DOUBLE) AS n FROM known) t"""


def fit_ctes(src: str = "history") -> list[tuple[str, str]]:
    """Fitted tables over ``src`` (WOE and return history always use the labelled rows)."""
    return [(n, q.replace("FROM history", f"FROM {src}")) for n, q in _FIT_CTES]


_FIT_CTES: list[tuple[str, str]] = [
    ("items_fit", """SELECT item_id, max(days_to_delivery) AS item_max_delivery,
        avg(days_to_delivery) AS item_mean_delivery, min(days_to_delivery) AS item_min_delivery,
        count(user_id) AS item_orders, max(item_price) AS item_max_price
      FROM history GROUP BY item_id"""),
    ("baskets_fit", """SELECT user_id, order_date, count(item_id) AS order_num_items,
        max(item_price) AS order_max_price,
        CAST(sum(CAST(item_price AS DECIMAL(38,6))) AS DOUBLE) AS order_total_value,
        median(item_price) AS order_median_price, min(item_price) AS order_min_price,
        count(DISTINCT item_size) AS order_num_sizes, count(DISTINCT item_color) AS order_num_colors
      FROM history GROUP BY user_id, order_date"""),
    ("baskets_seq", """SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY order_date) AS order_seqnum
      FROM baskets_fit"""),
    ("brandcounts", """SELECT user_id, order_date, brand_id, count(*) AS order_num_brand_id
      FROM history WHERE brand_id IS NOT NULL GROUP BY user_id, order_date, brand_id"""),
    ("orders_fit", """SELECT b.*, c.brand_id, c.order_num_brand_id
      FROM baskets_seq b LEFT JOIN brandcounts c ON b.user_id = c.user_id AND b.order_date = c.order_date"""),
    ("brands_fit", """SELECT brand_id, min(item_price) AS brand_min_price,
        CAST(sum(CAST(item_price AS DECIMAL(38,6))) AS DOUBLE) / count(item_price) AS brand_mean_price,
        max(item_price) AS brand_max_price FROM history GROUP BY brand_id"""),
    ("states_fit", """SELECT user_state, avg(days_to_delivery) AS state_mean_delivery,
        max(days_to_delivery) AS state_max_delivery FROM history WHERE user_state IS NOT NULL GROUP BY user_state"""),
    ("rh0", """SELECT user_id, order_date, max("return") AS ret FROM known GROUP BY user_id, order_date"""),
    ("rh1", """SELECT *, CAST(coalesce(lag(ret, 1) OVER (PARTITION BY user_id ORDER BY order_date), 0) AS DOUBLE) AS history,
        dense_rank() OVER (PARTITION BY user_id ORDER BY order_date) AS seq FROM rh0"""),
    ("rethist_fit", """SELECT user_id, order_date, history,
        sum(history) OVER (PARTITION BY user_id ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS history_cumsum,
        sum(history) OVER (PARTITION BY user_id ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / seq AS history_perc
      FROM rh1"""),
    ("woe_item_color_fit", woe_sql("item_color")),
    ("woe_month_fit", woe_sql("month")),
    ("woe_item_size_fit", woe_sql("item_size")),
    ("qs", """SELECT quantile_cont(item_price, 0.25) AS q1, quantile_cont(item_price, 0.5) AS q2,
        quantile_cont(item_price, 0.75) AS q3 FROM history"""),
]


def with_fit(final: str, extra: list[tuple[str, str]] | None = None, src: str = "history") -> str:
    return with_ctes(final, fit_ctes(src) + (extra or []))


def transform_ctes(x: str) -> list[tuple[str, str]]:
    """Lookup joins with their imputation, as the feature transform does it (CTE ``feat``)."""
    return [
        ("im", """SELECT avg(item_max_delivery) AS item_max_delivery, avg(item_mean_delivery) AS item_mean_delivery,
            avg(item_min_delivery) AS item_min_delivery, avg(item_orders) AS item_orders,
            avg(item_max_price) AS item_max_price FROM items_fit"""),
        ("om", """SELECT avg(order_total_value) AS order_total_value, avg(order_median_price) AS order_median_price,
            avg(order_min_price) AS order_min_price, avg(order_max_price) AS order_max_price FROM orders_fit"""),
        ("bm", """SELECT avg(brand_min_price) AS brand_min_price, avg(brand_mean_price) AS brand_mean_price,
            avg(brand_max_price) AS brand_max_price FROM brands_fit"""),
        ("sm", """SELECT avg(state_mean_delivery) AS state_mean_delivery,
            avg(state_max_delivery) AS state_max_delivery FROM states_fit"""),
        ("feat", f"""SELECT x.*,
            coalesce(CAST(i.item_max_delivery AS DOUBLE), im.item_max_delivery) AS item_max_delivery,
            coalesce(i.item_mean_delivery, im.item_mean_delivery) AS item_mean_delivery,
            coalesce(CAST(i.item_min_delivery AS DOUBLE), im.item_min_delivery) AS item_min_delivery,
            coalesce(CAST(i.item_orders AS DOUBLE), im.item_orders) AS item_orders,
            coalesce(i.item_max_price, im.item_max_price) AS item_max_price,
            coalesce(o.order_num_items, 1) AS order_num_items,
            coalesce(o.order_max_price, om.order_max_price) AS order_max_price,
            coalesce(o.order_total_value, om.order_total_value) AS order_total_value,
            coalesce(o.order_median_price, om.order_median_price) AS order_median_price,
            coalesce(o.order_min_price, om.order_min_price) AS order_min_price,
            coalesce(o.order_num_sizes, 1) AS order_num_sizes,
            coalesce(o.order_num_colors, 1) AS order_num_colors,
            coalesce(o.order_seqnum, 1) AS order_seqnum,
            coalesce(o.order_num_brand_id, 0) AS order_num_brand_id,
            coalesce(b.brand_min_price, bm.brand_min_price) AS brand_min_price,
            coalesce(b.brand_mean_price, bm.brand_mean_price) AS brand_mean_price,
            coalesce(b.brand_max_price, bm.brand_max_price) AS brand_max_price,
            coalesce(s.state_mean_delivery, sm.state_mean_delivery) AS state_mean_delivery,
            coalesce(CAST(s.state_max_delivery AS DOUBLE), sm.state_max_delivery) AS state_max_delivery,
            coalesce(h.history, 0) AS history,
            coalesce(h.history_cumsum, 0) AS history_cumsum,
            coalesce(h.history_perc, 0) AS history_perc,
            CAST(coalesce(o.order_min_price, om.order_min_price) = 0 AS DOUBLE) AS order_has_gift,
            wc.woe_item_color AS woe_item_color_raw, wm.woe_month AS woe_month_raw, ws.woe_item_size AS woe_item_size_raw
          FROM {x} x
          LEFT JOIN items_fit i ON x.item_id = i.item_id
          LEFT JOIN orders_fit o ON x.user_id = o.user_id AND x.order_date = o.order_date AND x.brand_id = o.brand_id
          LEFT JOIN brands_fit b ON x.brand_id = b.brand_id
          LEFT JOIN states_fit s ON x.user_state = s.user_state
          LEFT JOIN rethist_fit h ON x.user_id = h.user_id AND x.order_date = h.order_date
          LEFT JOIN woe_item_color_fit wc ON x.item_color = wc.item_color
          LEFT JOIN woe_month_fit wm ON x.month = wm.month
          LEFT JOIN woe_item_size_fit ws ON x.item_size = ws.item_size
          CROSS JOIN im CROSS JOIN om CROSS JOIN bm CROSS JOIN sm"""),
        ("featw", """SELECT f.*,
            coalesce(woe_item_color_raw, avg(woe_item_color_raw) OVER ()) AS woe_item_color,
            coalesce(woe_month_raw, avg(woe_month_raw) OVER ()) AS woe_month,
            coalesce(woe_item_size_raw, avg(woe_item_size_raw) OVER ()) AS woe_item_size,
            coalesce((item_max_price - item_price) / nullif(item_max_price, 0), 0) AS price_off
          FROM feat f"""),
    ]


def with_transform(final: str, src: str = "known", x: str = "unknown") -> str:
    return with_ctes(final, fit_ctes(src) + transform_ctes(x))
