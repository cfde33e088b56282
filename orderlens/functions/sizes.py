"""Size normalisation and bucketing.

All rules are native Spark expressions (no Python UDF): the numeric bucketing
is a single CASE over 30 literal edges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Numeric size ranges and the five bucket labels per range.
# Each range (low, high) is cut into five equal half-open bins.
# ---------------------------------------------------------------------------
SIZE_RANGES: list[tuple[float, float]] = [(0, 15), (18, 30), (30, 52), (52, 59), (75, 177), (2930, 4035)]
SIZE_LABELS: list[str] = ["XS", "S", "M", "L", "XL"]

# regexes of the size flags (fixed values)
PANTS_RE = "^[0-9]{4}"
UNDERWEAR_RE = "^[3-9]\\+?$"
LETTER_RE = "^[xlsmXLSM]"
UNSIZED_PREFIX = "unsized"
# text that is a decimal number; engines' casts also take type suffixes (``75D``), which are bra sizes
NUMBER_RE = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def bin_edges(low: float, high: float, bins: int = 5) -> list[float]:
    """Equally spaced edges low..high, computed as ``low + i*step`` with the last edge exact.

    This is how evenly spaced grids are commonly produced in floating point, so
    edges like 20.4 carry the same binary value as the original rule.
    """
    step = (float(high) - float(low)) / bins
    edges = [i * step + float(low) for i in range(bins + 1)]
    edges[-1] = float(high)
    return edges


def bucket_conditions() -> list[tuple[float, float, str]]:
    """(lower, upper, label) in the order the rule tries them; first match wins."""
    out = []
    for low, high in SIZE_RANGES:
        e = bin_edges(low, high)
        for i, lab in enumerate(SIZE_LABELS):
            out.append((e[i], e[i + 1], lab))
    return out


def _lit(x: float) -> str:
    return repr(float(x))


def size_bucket_sql(expr: str) -> str:
    """CASE expression text bucketing the DOUBLE ``expr``; null when in no bin."""
    parts = [f"WHEN {_lit(lo)} <= {expr} AND {expr} < {_lit(hi)} THEN '{lab}'" for lo, hi, lab in bucket_conditions()]
    return "CASE " + " ".join(parts) + " END"


def normalised_size(col: Column) -> Column:
    """upper; literal '+' -> '.5'; X{2,}L -> XL; X{2,}S -> XS."""
    s = F.upper(col)
    s = F.replace(s, F.lit("+"), F.lit(".5"))
    s = F.regexp_replace(s, "[xX]{2,}[Ll]", "XL")
    s = F.regexp_replace(s, "[xX]{2,}[Ss]", "XS")
    return s


def numeric_size(col: Column) -> Column:
    """The text as a double, if it is a decimal number (``nan`` and ``inf`` are in no bin)."""
    return F.when(col.rlike(NUMBER_RE), col.try_cast("double")).when(F.upper(F.trim(col)).isin("NAN", "INF", "-INF", "INFINITY"), F.lit(float("nan")))


def size_bucket(col: Column, num: Column | None = None) -> Column:
    """Numeric strings -> bucket label (or null outside all bins); other strings stay as they are.

    ``num`` may be a column already holding ``numeric_size(col)``: pass it so the (regex-heavy) input is computed once per row, not once per branch.
    """
    x = numeric_size(col) if num is None else num
    # one literal array of (low, high, label) bins and a first-match lookup: the same comparisons
    # as a 30-branch CASE, but compact generated code (a wide CASE inflates the fused stage
    # beyond what the JIT compiles, which slowed the whole cleaning projection several-fold)
    bins = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(lab).alias("lab"))
                     for lo, hi, lab in bucket_conditions()])
    hit = F.filter(bins, lambda b: (b["lo"] <= x) & (x < b["hi"]))
    return F.when(x.isNull(), col).otherwise(F.try_element_at(hit, F.lit(1)).getField("lab"))


def clean_size(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return size_bucket(normalised_size(c))


def is_pants(col: Column) -> Column:
    return col.rlike(PANTS_RE)


def is_underwear(col: Column) -> Column:
    return col.rlike(UNDERWEAR_RE)


def is_letter_coded(col: Column) -> Column:
    return col.rlike(LETTER_RE)


def is_clothes(col: Column) -> Column:
    return ~col.startswith(UNSIZED_PREFIX)
