"""Fitted feature spec: fit lookup tables once, transform any batch by feature *name*.

``fit(history)`` builds the lookup tables (items, baskets fanned out per
brand, brands, states, return history, three WOE tables), the imputation
means (small scalars), the one-hot categories and the price quartiles.

``transform(X, names)`` resolves each requested name to a column expression
and joins only the lookup tables those names need:

* base column ``item_max_delivery`` / ``order_total_value`` / ``history`` ...
* ``price_off`` and ``order_has_gift``
* ``woe_item_color`` / ``woe_month`` / ``woe_item_size``
* ``is_q1_value`` .. ``is_q4_value``
* one-hots ``user_title_<v>``, ``user_state_<v>``, ``item_size_cl_<v>``, ``month_<v>``
* ratios ``a/b`` = a / (b + 1), interactions ``a*b`` = a*b (AND for two flags)

so a 20-feature request never materialises the ~600 candidate columns.
``expand_names`` gives the full candidate list of the half-split rules.

``feature_array`` gives any list of them, hundreds if need be, as one ``array<double>``.

Joins: each fitted table that a transform needs is written once to the shared checkpoint folder; one
small job over it counts its rows and takes its imputation means.  A table of at most
``BROADCAST_ROWS`` rows is broadcast (a size known from that count); a larger one is joined by
shuffle, with AQE splitting skewed partitions of the big side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import lookups as L

TARGET = "return"

# exact base column order: it fixes the half-splits of ratios and interactions
BASE_NUMERIC = [
    "item_price",
    "is_na_delivery_date", "is_dob_missing", "is_item_pants", "is_item_underwear", "is_letter_coded",
    "is_item_clothes",
    "days_to_delivery", "user_tenure", "age",
    "delivery_thu", "delivery_fri",
    "age2", "user_tenure2", "item_price2",
    *L.ITEM_COLS,
    *L.ORDER_COLS,
    *L.BRAND_COLS,
    *L.STATE_COLS,
    *L.HISTORY_COLS,
    "order_has_gift",
]
FLAGS = {"is_na_delivery_date", "is_dob_missing", "is_item_pants", "is_item_underwear", "is_letter_coded",
         "is_item_clothes", "delivery_thu", "delivery_fri"}
WOE_NAMES = [f"woe_{v}" for v in L.WOE_VARS]
QUARTILE_FLAGS = ["is_q1_value", "is_q2_value", "is_q3_value", "is_q4_value"]
DUMMY_SOURCES = ["user_title", "user_state", "item_size_cl", "month"]
# columns dropped with the flags when one-hots are off
NON_DUMMY_DROPS = ["delivery_thu", "delivery_fri", "order_has_gift"]
# fixed imputation constants of the basket columns (others use the fitted means)
ORDER_FILL_ONE = ["order_num_items", "order_num_sizes", "order_num_colors", "order_seqnum"]
ORDER_FILL_MEAN = ["order_total_value", "order_median_price", "order_min_price", "order_max_price"]

# a fitted table of at most so many rows (about 10 MB) is broadcast
BROADCAST_ROWS = 100_000
# lookup tables: key columns and value columns
TABLES = {
    "items": (["item_id"], L.ITEM_COLS),
    "orders": (["user_id", "order_date", "brand_id"], L.ORDER_COLS),
    "brands": (["brand_id"], L.BRAND_COLS),
    "states": (["user_state"], L.STATE_COLS),
    "return_history": (["user_id", "order_date"], L.HISTORY_COLS),
    **{f"woe_{v}": ([v], [f"woe_{v}"]) for v in L.WOE_VARS},
}


class FeatureSpec:
    """Fitted tables plus small fitted scalars, each made and written once, on first use."""

    def __init__(self, history: DataFrame, target: str = TARGET, raw: DataFrame | None = None, clean=None):
        self.fit_data, self.target, self.raw, self.clean = history, target, raw, clean
        self.profile: dict[str, tuple[bool, bool]] | None = None
        self._cache: dict[str, object] = {}

    def _once(self, key, make):
        if key not in self._cache:
            self._cache[key] = make()
        return self._cache[key]

    def _build(self, name: str) -> DataFrame:
        h = self.fit_data
        if name.startswith("woe_"):
            return L.fit_woe(h.filter(F.col(self.target).isNotNull()), name[4:], self.target)
        return {"items": L.fit_items, "orders": L.fit_orders, "brands": L.fit_brands, "states": L.fit_states,
                "return_history": lambda d: L.fit_return_history(d, self.target)}[name](h)

    def table(self, name: str) -> DataFrame:
        """A fitted table, written once: later joins read it and a lost executor replays no fit."""
        from ..session import materialize
        return self._once(name, lambda: materialize(self._build(name), f"fit-{name}"))

    def stats(self, name: str) -> dict:
        """``rows``, and for each value column its ``mean`` and whether it is -1 anywhere: one small job."""
        def make():
            cols = TABLES[name][1]
            aggs = [F.count(F.lit(1)).alias("rows")]
            for j, c in enumerate(cols):
                aggs += [F.avg(c).alias(f"m{j}"), (F.count_if(F.col(c) == -1) > 0).alias(f"u{j}")]
            row = self.table(name).agg(*aggs).first()
            return {"rows": row["rows"], "mean": {c: row[f"m{j}"] for j, c in enumerate(cols)},
                    "minus_one": {c for j, c in enumerate(cols) if row[f"u{j}"]}}
        return self._once(f"stats {name}", make)

    def lookup(self, name: str) -> DataFrame:
        """The table as a join side: broadcast if its counted rows are few."""
        df = self.table(name)
        return F.broadcast(df) if self.stats(name)["rows"] <= BROADCAST_ROWS else df

    def means(self, name: str) -> dict:
        return self.stats(name)["mean"]

    def joined(self, keep: tuple[str, ...] = ()) -> DataFrame:
        """The fit data with all looked-up columns, and ``keep``, written once: the profile, and matrices of its rows
        (``joined=True``), read it, so the rows are joined once in all.  They are joined raw where the spec has them, and
        cleaned afterwards: the raw columns, which the shuffles carry, are less than half as many."""
        from ..session import materialize

        def make():
            need = {*BASE_NUMERIC, *WOE_NAMES}
            looked_up: list[str] = []
            df = _large_joins(self, self.fit_data if self.raw is None else self.raw, need, looked_up)
            df = _finished(self, df if self.raw is None else self.clean(df), need, looked_up)
            wanted = need | {*DUMMY_SOURCES, *L.WOE_VARS, self.target, *keep}
            return materialize(df.select(*[F.col(f"`{c}`") for c in df.columns if c in wanted]), "joined-rows")
        return self._once("joined", make)

    @property
    def quantiles(self) -> tuple:
        def make():
            q = L.price_quantiles(self.fit_data).first()
            return (q["q1"], q["q2"], q["q3"])
        return self._once("quantiles", make)

    @property
    def categories(self) -> dict[str, list]:
        """One-hot categories: they become columns, so their number is that of the plan's columns."""
        def make():
            cats = {}
            for c in [c for c in DUMMY_SOURCES if c in self.fit_data.columns]:
                # distinct first (the key is computed once per row in the projection); a null
                # filter here would be pushed below the projection and inline the size CASE
                cats[c] = sorted(r[0] for r in self.fit_data.select(c).distinct().collect() if r[0] is not None)
            return cats
        return self._once("categories", make)


def fit(history: DataFrame, target: str = TARGET, raw: DataFrame | None = None, clean=None) -> FeatureSpec:
    """Fit all lookup tables on ``history`` (labelled rows feed WOE and return history).  ``raw`` are the same rows before
    ``clean``, which keeps the tables' keys, for ``FeatureSpec.joined``."""
    return FeatureSpec(history, target, raw, clean)


# ------------------------------------------------------------------ name resolution

def _split(name: str) -> tuple[str, str, str] | None:
    for op in ("/", "*"):
        if op in name:
            a, b = name.split(op, 1)
            return a, op, b
    return None


def _dummy(name: str, spec: FeatureSpec) -> tuple[str, object] | None:
    for src in DUMMY_SOURCES:
        pre = src + "_"
        if name.startswith(pre):
            val = name[len(pre):]
            return src, (int(val) if src == "month" and val.isdigit() else val)
    return None


def atoms(names: list[str], spec: FeatureSpec) -> set[str]:
    """Base / WOE / derived names that the requested features depend on."""
    out: set[str] = set()
    for n in names:
        if n in BASE_NUMERIC or n in WOE_NAMES or n in ("price_off",) or n in QUARTILE_FLAGS:
            out.add(n)
        elif _dummy(n, spec) is not None:
            continue
        elif _split(n) is not None:
            a, _, b = _split(n)
            out |= atoms([a], spec) | atoms([b], spec)
        else:
            out.add(n)
    if "price_off" in out:
        out.add("item_max_price")
    if "order_has_gift" in out:
        out.add("order_min_price")
    return out


def _fill(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    """coalesce(col, value) for the given columns; a fractional fill widens the column to DOUBLE."""
    def one(c):
        v = fills[c]
        col = F.col(f"`{c}`")
        if isinstance(v, float):
            col = col.cast("double")
        return F.coalesce(col, F.lit(v)).alias(c)
    return df.select(*[one(c) if c in fills else F.col(f"`{c}`") for c in df.columns])


def _numeric_fill0(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[
        (F.coalesce(F.col(f"`{f.name}`"), F.lit(0)).alias(f.name)
         if f.name in cols and isinstance(f.dataType, T.NumericType) else F.col(f"`{f.name}`"))
        for f in df.schema.fields])


def join_lookups(spec: FeatureSpec, X: DataFrame, need: set[str]) -> DataFrame:
    """J1-J5 (+J6): left joins, each with its own imputation; no join reads what another adds.

    After J1-J5 every remaining null in a looked-up numeric
    column becomes 0 (the original's last join imputes with 0 for the whole frame).
    """
    looked_up: list[str] = []
    return _finished(spec, _large_joins(spec, X, need, looked_up), need, looked_up)


def _large_joins(spec: FeatureSpec, X: DataFrame, need: set[str], looked_up: list[str]) -> DataFrame:
    """J1-J5; ``looked_up`` gets the names of the columns."""
    out = X

    def joined(df: DataFrame, name: str, fills: dict) -> DataFrame:
        looked_up.extend(TABLES[name][1])
        return _fill(df.join(spec.lookup(name), TABLES[name][0], "left"), fills)

    def mean_fills(name: str, cols: list[str]) -> dict:
        return {c: float(m) for c, m in spec.means(name).items() if c in cols and m is not None}

    # the large tables first, that of most columns last: what it adds goes through no other table's shuffle
    if need & set(L.HISTORY_COLS):
        out = joined(out, "return_history", {})
    if need & set(L.ITEM_COLS):
        out = joined(out, "items", mean_fills("items", L.ITEM_COLS))
    if need & set(L.ORDER_COLS) or "order_has_gift" in need:
        out = joined(out, "orders", {**{c: 1 for c in ORDER_FILL_ONE}, **mean_fills("orders", ORDER_FILL_MEAN)})
    if need & set(L.BRAND_COLS):
        out = joined(out, "brands", mean_fills("brands", L.BRAND_COLS))
    if need & set(L.STATE_COLS):
        out = joined(out, "states", mean_fills("states", L.STATE_COLS))
    return out


def _finished(spec: FeatureSpec, out: DataFrame, need: set[str], looked_up: list[str]) -> DataFrame:
    """What follows J1-J5: the last fill, the gift flag and J6."""
    # The last merge fills every remaining numeric null with 0
    base_numeric = [c for c in BASE_NUMERIC if c in out.columns]
    out = _numeric_fill0(out, looked_up + base_numeric)
    if "order_has_gift" in need:
        out = out.withColumn("order_has_gift", (F.col("order_min_price") == 0).cast("double"))
    for v in L.WOE_VARS:
        if f"woe_{v}" in need:
            out = out.join(spec.lookup(f"woe_{v}"), v, "left")
    return out


def _as_double(c: Column, is_flag: bool) -> Column:
    return c.cast("double") if not is_flag else c.cast("boolean").cast("double")


def _expressions(spec: FeatureSpec, df: DataFrame, names: list[str], need: set[str]) -> dict[str, Column]:
    """Each name as a DOUBLE expression over the joined rows ``df``."""
    q1 = q2 = q3 = None
    if any(n in QUARTILE_FLAGS for n in need):
        q1, q2, q3 = spec.quantiles
    exprs: dict[str, Column] = {}

    def base(n: str) -> Column:
        if n == "price_off":
            return F.coalesce(F.try_divide(F.col("item_max_price") - F.col("item_price"), F.col("item_max_price")),
                              F.lit(0.0))
        if n in QUARTILE_FLAGS:
            p = F.col("item_price")
            return {"is_q1_value": p <= q1, "is_q2_value": (p > q1) & (p <= q2),
                    "is_q3_value": (p > q2) & (p <= q3), "is_q4_value": p > q3}[n]
        return F.col(f"`{n}`")

    def is_flag(n: str) -> bool:
        return n in FLAGS or n in QUARTILE_FLAGS

    for n in names:
        d = _dummy(n, spec)
        if n in BASE_NUMERIC or n in WOE_NAMES or n == "price_off" or n in QUARTILE_FLAGS:
            exprs[n] = _as_double(base(n), is_flag(n))
        elif d is not None:
            src, val = d
            exprs[n] = F.coalesce(F.col(src) == F.lit(val), F.lit(False)).cast("double")
        elif _split(n) is not None:
            a, op, b = _split(n)
            if op == "/":
                exprs[n] = F.try_divide(_as_double(base(a), is_flag(a)), _as_double(base(b), is_flag(b)) + 1)
            elif is_flag(a) and is_flag(b):
                exprs[n] = (base(a) & base(b)).cast("double")
            else:
                exprs[n] = _as_double(base(a), is_flag(a)) * _as_double(base(b), is_flag(b))
        elif n in df.columns:
            exprs[n] = df[n].cast("double")
        else:
            raise KeyError(n)
    return exprs


def _woe_mean(spec: FeatureSpec, X: DataFrame, name: str) -> float | None:
    """Mean of a WOE column over the rows of ``X`` whose category is known, from category counts."""
    var = name[4:]
    counts = X.filter(F.col(var).isNotNull()).groupBy(var).agg(F.count(F.lit(1)).alias("n"))
    row = counts.join(spec.lookup(name), var).agg((F.sum(F.col(name) * F.col("n")) / F.sum("n")).alias("m")).first()
    return row["m"]


def _undefined_ratios(spec: FeatureSpec, X: DataFrame, names: list[str]) -> list[str]:
    """Ratios whose denominator is -1 (so that b + 1 is 0) in some row: known from the fitted tables'
    statistics, and for columns of ``X`` itself from one narrow job."""
    of = {n: _split(n)[2] for n in names if _split(n) is not None and _split(n)[1] == "/" and _dummy(n, spec) is None}
    table_of = {c: t for t, (_, cols) in TABLES.items() for c in cols}
    own = sorted({d for d in of.values() if d in X.columns and d not in FLAGS and d not in table_of})
    bad = set()
    if own:
        row = X.agg(*[(F.count_if(F.col(f"`{d}`") == -1) > 0).alias(f"u{j}") for j, d in enumerate(own)]).first()
        bad = {d for j, d in enumerate(own) if row[f"u{j}"]}
    for d in set(of.values()) - set(own):
        if d in table_of and (d in spec.stats(table_of[d])["minus_one"] or spec.means(table_of[d]).get(d) == -1):
            bad.add(d)
    return [n for n, d in of.items() if d in bad]


def _resolved(spec: FeatureSpec, X: DataFrame, names: list[str], impute: str, write: str | None = None,
              keep: tuple[str, ...] = (), joined: bool = False) -> tuple[DataFrame, dict[str, Column], dict[str, float | None]]:
    """The joined rows and, by name, expressions without nulls, and what fills their nulls.  ``write`` names a table that the joined columns -- those
    that ``names`` depend on, and ``keep`` -- are written to once, and read from afterwards.  ``joined`` says that ``X`` are rows of ``FeatureSpec.joined``."""
    need = atoms(names, spec)
    df = X if joined else join_lookups(spec, X, need)
    if write:
        from ..session import materialize
        wanted = need | set(keep) | {"item_price", "item_max_price"} | {d[0] for n in names if (d := _dummy(n, spec)) is not None}
        df = materialize(df.select(*[F.col(f"`{c}`") for c in df.columns if c in wanted]), write)
    exprs = _expressions(spec, df, names, need)
    # batch means as the original; ``fit`` takes them over the fit data, so it also works on a stream
    rows = X if impute == "batch" else spec.fit_data
    fills = {n: _woe_mean(spec, rows, n) for n in names if n in WOE_NAMES}
    if ratios := _undefined_ratios(spec, rows, names):
        basis = df if impute == "batch" else join_lookups(spec, rows, need)
        row = basis.agg(*[F.avg(exprs[n]).alias(f"m{j}") for j, n in enumerate(ratios)]).first()
        fills |= {n: row[f"m{j}"] for j, n in enumerate(ratios)}
    for n, m in fills.items():
        exprs[n] = F.coalesce(exprs[n], F.lit(m).cast("double"))
    return df, exprs, fills


def transform(spec: FeatureSpec, X: DataFrame, names: list[str], keep: tuple[str, ...] = ("order_item_id", TARGET),
              impute: str = "batch", joined: bool = False) -> DataFrame:
    """Resolve ``names`` to columns of ``X`` (joined with the needed lookups); all features as DOUBLE.

    A value that is still missing -- an unseen WOE category, a ratio whose denominator is 0 -- gets the
    column's mean: over the batch (``impute='batch'``, as the original) or over the fit data (``'fit'``,
    without an aggregate of the batch).
    """
    df, exprs, _ = _resolved(spec, X, names, impute, joined=joined)
    kept = [k for k in keep if k in df.columns and k not in exprs]
    return df.select(*[F.col(f"`{k}`") for k in kept], *[e.alias(n) for n, e in exprs.items()])


def feature_array(spec: FeatureSpec, X: DataFrame, names: list[str], keep: tuple[str, ...] = ("order_item_id", TARGET),
                  out: str = "x", impute: str = "batch", write: str | None = None, vectors: dict[str, list[str]] | None = None,
                  cells: str | None = None, joined: bool = False) -> DataFrame | tuple[DataFrame, "Expansion"]:
    """``keep`` columns and all of ``names`` as one ``array<double>``, in that order: hundreds of features
    are one column, so no stage outgrows code generation.

    ``vectors`` names further columns, each the vector of a list out of ``names`` for ``pyspark.ml``.  Each is expanded
    from the joined columns by itself, so a pass that reads one makes no more than its features.

    For several passes ``write`` names a table of the joined columns, some 50 whatever the number of names: it is
    written once, and the array is made of it as it is read.  The array itself, a number a name and row, is never
    written.

    ``cells`` is for passes that are Python functions of batches: it names a further column of the single columns that
    ``names`` are made of, and with the frame comes the ``Expansion`` of a batch of them to the matrix.  The pass calls it
    where it needs the numbers, so they do not go to the JVM and back."""
    df, exprs, fills = _resolved(spec, X, names, impute, write, keep, joined)
    kept = [k for k in keep if k in df.columns]
    columns = [*[F.col(f"`{k}`") for k in kept], _expanded(spec, df, names, exprs, fills).alias(out),
               *[_expanded(spec, df, some, exprs, fills, vector=True).alias(c) for c, some in (vectors or {}).items()]]
    if cells is None:
        return df.select(*columns)
    single, expansion = _cells(spec, df, names, exprs, fills)
    return df.select(*columns, single.alias(cells)), expansion


def _expanded(spec: FeatureSpec, df: DataFrame, names: list[str], exprs: dict[str, Column], fills: dict[str, float | None],
              vector: bool = False) -> Column:
    """``names`` as one array (or vector), from an array of their single columns."""
    import numpy as np
    from pyspark.ml.linalg import VectorUDT

    from .models import vector_batch
    single, expansion = _cells(spec, df, names, exprs, fills)
    total = len(names)

    @F.arrow_udf(VectorUDT() if vector else "array<double>")
    def expand(x):
        import pyarrow as pa
        y, null = expansion(x)
        if vector:
            return vector_batch(y, null)
        ends = np.arange(0, y.size + 1, total, dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(y.ravel(), mask=None if null is None else null.ravel()))

    return expand(single)


def _cells(spec: FeatureSpec, df: DataFrame, names: list[str], exprs: dict[str, Column],
           fills: dict[str, float | None]) -> tuple[Column, "Expansion"]:
    """The single columns that ``names`` are made of as one array, and what makes the names of it."""
    import numpy as np
    pairs = {n: p for n in names if n not in BASE_NUMERIC and _dummy(n, spec) is None and (p := _split(n)) is not None}
    single = list(dict.fromkeys(x for a, _, b in pairs.values() for x in (a, b)))
    raw = _expressions(spec, df, single, atoms(single, spec))
    sources = list(dict.fromkeys(d[0] for n in names if n not in BASE_NUMERIC and (d := _dummy(n, spec)) is not None))
    values = {c: list(dict.fromkeys(_dummy(n, spec)[1] for n in names if n not in BASE_NUMERIC and (_dummy(n, spec) or "")[:1] == (c,)))
              for c in sources}
    cells: list[Column] = [raw[n] for n in single]
    at = {n: j for j, n in enumerate(single)}
    for c in sources:  # the number of a row's category, 0 for any other
        at[c, "code"] = len(cells)
        known = F.array(*[F.lit(v).cast(df.schema[c].dataType) for v in values[c]])
        cells.append(F.coalesce(F.array_position(known, F.col(c)), F.lit(0)).cast("double"))
    plain, ratio, product, hot = [], [], [], []
    for k, n in enumerate(names):
        d = _dummy(n, spec) if n not in BASE_NUMERIC else None
        if n in pairs:
            a, op, b = pairs[n]
            (ratio if op == "/" else product).append((k, at[a], at[b]))
        elif d is not None:
            hot.append((k, at[d[0], "code"], values[d[0]].index(d[1]) + 1))
        else:
            plain.append((k, len(cells)))
            cells.append(exprs[n])
    columns = lambda found, width: [np.array(c, int) for c in zip(*found)] if found else [np.zeros(0, int)] * width
    (pk, pj), (rk, ra, rb), (mk, ma, mb), (hk, hj, hv) = (columns(x, w) for x, w in ((plain, 2), (ratio, 3), (product, 3), (hot, 3)))
    fill = np.array([np.nan if fills.get(names[k]) is None else fills[names[k]] for k in rk], float)
    filled = np.array([fills.get(names[k]) is not None for k in rk], bool)
    flags = FLAGS | set(QUARTILE_FLAGS)
    both = np.array([pairs[names[k]][0] in flags and pairs[names[k]][2] in flags for k in mk], bool)
    return F.array(*cells), Expansion(len(cells), len(names), (pk, pj), (rk, ra, rb), (mk, ma, mb), (hk, hj, hv), fill, filled, both)


class Expansion:
    """A batch of single columns -> (matrix of the names, which of its values are null or None): ratios, interactions and
    one-hots, which are most names, are a few numpy operations a batch."""

    def __init__(self, width, total, plain, ratio, product, hot, fill, filled, both):
        self.width, self.total, self.plain, self.ratio, self.product, self.hot = width, total, plain, ratio, product, hot
        self.fill, self.filled, self.both = fill, filled, both

    def __call__(self, x):
        import numpy as np
        (pk, pj), (rk, ra, rb), (mk, ma, mb), (hk, hj, hv) = self.plain, self.ratio, self.product, self.hot
        flat = x.flatten()
        gone = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, self.width) if flat.null_count else None
        v = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, self.width)
        y, null = np.empty((len(v), self.total)), None
        below = v[:, rb] + 1.0
        none = below == 0
        if gone is not None:
            null = np.zeros(y.shape, bool)
            null[:, pk] = gone[:, pj]
            a, b = gone[:, ma], gone[:, mb]
            # a flag that is off settles an AND, whatever the other one
            null[:, mk] = np.where(self.both, (a & (b | (v[:, mb] != 0))) | (b & (a | (v[:, ma] != 0))), a | b)
            none |= gone[:, ra] | gone[:, rb]
        with np.errstate(all="ignore"):
            share = v[:, ra] / below
        if none.any():
            share = np.where(none, self.fill, share)
            null = np.zeros(y.shape, bool) if null is None else null
            null[:, rk] = none & ~self.filled
        y[:, pk], y[:, rk], y[:, mk], y[:, hk] = v[:, pj], share, v[:, ma] * v[:, mb], v[:, hj] == hv
        return y, null

    def parts(self, lists, rows: int = 4096):
        """The matrix of a batch some rows at a time, a null as no number."""
        import numpy as np
        for at in range(0, len(lists), rows):
            y, null = self(lists.slice(at, rows))
            if null is not None:
                y[null] = np.nan
            yield y


def numeric_only(df: DataFrame) -> DataFrame:
    """The columns that are numbers or flags by their type, in their order."""
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))])


def drop_columns(df: DataFrame, names) -> DataFrame:
    """Without the columns of a drop-list; names that are no column are ignored."""
    gone = set(names)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])


# ------------------------------------------------------------------ full expansion (U4)

def fit_profile(spec: FeatureSpec, data: DataFrame | None = None) -> dict[str, tuple[bool, bool]]:
    """A11 at fit: (min == 0, any null) per non-flag base column of the transformed fit data."""
    cols = [c for c in BASE_NUMERIC if c not in FLAGS] + ["price_off"]
    written = data is None and "joined" in spec._cache
    data = spec.joined() if written else spec.fit_data if data is None else data
    t = transform(spec, data, cols, keep=(), joined=written)
    prof = L.column_profile(t, cols).collect()
    spec.profile = {r["column_name"]: (bool(r["min_is_zero"]), bool(r["has_nulls"])) for r in prof}
    return spec.profile


def expand_names(spec: FeatureSpec, ignore_woe: bool = True, add_dummies: bool = False,
                 add_interactions: bool = True, add_ratios: bool = True, drop: list[str] | None = None) -> list[str]:
    """The candidate list of the half-split rules (U4), decided once with the fit profile."""
    prof = spec.profile if spec.profile is not None else fit_profile(spec)
    names = list(BASE_NUMERIC)
    if not ignore_woe:
        names += WOE_NAMES
    names.append("price_off")
    outnames = [n for n in BASE_NUMERIC]
    if add_ratios:
        cols = [n for n in names if n not in FLAGS]
        m = len(cols) // 2
        for nom in cols[:m]:
            for den in cols[m:]:
                if nom.startswith("woe") or den.startswith("woe"):
                    continue
                if prof.get(den, (False, False))[0]:
                    continue
                names.append(f"{den}/{nom}" if den == "price_off" else f"{nom}/{den}")
    if add_interactions:
        m = len(outnames) // 2
        for a in outnames[:m]:
            for b in outnames[m:]:
                if prof.get(a, (False, False))[1] or prof.get(b, (False, False))[1]:
                    continue
                names.append(f"{a}*{b}")
    drops = set(drop or [])
    if add_dummies:
        for src in DUMMY_SOURCES:
            names += [f"{src}_{v}" for v in spec.categories.get(src, [])]
        names += QUARTILE_FLAGS
    else:
        drops |= {n for n in names if n.startswith("is")} | set(NON_DUMMY_DROPS)
    return [n for n in names if n not in drops]
