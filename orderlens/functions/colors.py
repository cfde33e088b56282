"""Colour normalisation.

A raw ``item_color`` is mapped to a colour family; anything not in the map
(including null) becomes ``other``.  The lookup is a tiny fixed table, so it
is applied as a map literal inside the projection (no join, no shuffle).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The colour -> family map of the data set (85 entries), kept
# in its natural order.  These must equal the original lookup for identical
# results.
# ---------------------------------------------------------------------------
COLOR_FAMILIES: dict[str, str] = {
    "red": "redish", "terracotta": "redish", "magenta": "redish", "bordeaux": "redish",
    "crimson": "redish", "grey": "greyish", "ash": "greyish", "anthracite": "greyish",
    "iron": "greyish", "basalt": "greyish", "dark grey": "greyish", "graphite": "greyish",
    "ecru": "whiteish", "white": "whiteish", "ivory": "whiteish", "creme": "whiteish",
    "vanille": "whiteish", "azure": "blueish", "darkblue": "blueish", "dark navy": "blueish",
    "opal": "blueish", "blue": "blueish", "navy": "blueish", "baltic blue": "blueish",
    "cobalt blueturquoise": "blueish", "aqua": "blueish", "petrol": "blueish",
    "aquamarine": "blueish", "denim": "blueish", "dark denim": "blueish", "blau": "blueish",
    "purple": "purpleish", "aubergine": "purpleish", "amethyst": "purpleish",
    "berry": "purpleish", "dark garnet": "purpleish", "currant purple": "purpleish",
    "ocher": "yellowish", "yellow": "yellowish", "champagner": "yellowish",
    "lemon": "yellowish", "black": "blackish", "mocca": "brownish", "brown": "brownish",
    "cognac": "brownish", "habana": "brownish", "mahagoni": "brownish", "ingwer": "brownish",
    "caramel": "brownish", "kanel": "brownish", "ebony": "brownish", "brwon": "brownish",
    "green": "greenish", "oliv": "greenish", "olive": "greenish", "mint": "greenish",
    "dark oliv": "greenish", "jade": "greenish", "avocado": "greenish", "stained": "stained",
    "beige": "other", "ancient": "other", "nature": "other", "pink": "pinkish",
    "coral": "pinkish", "fuchsia": "pinkish", "hibiscus": "pinkish", "antique pink": "pinkish",
    "gold": "metal", "silver": "metal", "copper coin": "metal", "metal": "metal",
    "striped": "other", "apricot": "orangeish", "curry": "orangeish", "orange": "orangeish",
    "mango": "orangeish", "khaki": "other", "pallid": "other", "floral": "other",
    "almond": "other", "aviator": "other", "perlmutt": "other", "curled": "other",
    "?": "other",
}
DEFAULT_FAMILY = "other"


def color_map_column(mapping: dict[str, str] | None = None) -> Column:
    """The colour map as a ``map<string,string>`` literal (bounded: one entry per colour)."""
    mapping = COLOR_FAMILIES if mapping is None else mapping
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def color_family(col: Column | str, mapping: dict[str, str] | None = None) -> Column:
    """``coalesce(map[item_color], 'other')`` -- null colours map to ``other`` too."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.try_element_at(color_map_column(mapping), c), F.lit(DEFAULT_FAMILY))


def read_color_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{colour: family}`` (one file, over any number of lines) as rows (item_color, color)."""
    pairs = F.from_json("value", "map<string,string>")
    return (spark.read.text(path, wholetext=True).select(F.explode(pairs).alias("item_color", "color"))
            .dropDuplicates(["item_color"]))


def with_color_family(df: DataFrame, families: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """P1 / J8 by join: ``color`` from a (item_color, color) table, ``other`` where it has none.  The table is
    broadcast if it has at most ``broadcast_rows`` rows."""
    side = F.broadcast(families) if families.count() <= broadcast_rows else families
    return df.drop("color").join(side, "item_color", "left").fillna(DEFAULT_FAMILY, subset=["color"])


def color_map_sql_values(mapping: dict[str, str] | None = None) -> str:
    """The same map as a SQL ``VALUES`` list (for the DuckDB oracle)."""
    mapping = COLOR_FAMILIES if mapping is None else mapping
    rows = ", ".join(f"({json.dumps(k).replace(chr(34), chr(39))}, '{v}')" for k, v in mapping.items())
    return rows
