"""Whitening of embeddings by an exact spectrum.

Entries become integers, so the scatter matrix n * sum(x x^T) - S S^T = n^2 V of the vectors is known
exactly.  Its characteristic polynomial is computed exactly as well: modulo each of many primes the matrix
is brought to Hessenberg form, whose polynomial a recurrence gives, and Chinese remaindering joins the
coefficients.  All roots of a symmetric matrix are real, so the sign changes of the polynomial shifted to
a point count the roots beyond it: bisection isolates the largest roots and refines them to
``DIGITS`` bits.  The null space of the matrix less a root, by inverse iteration in integers of that
precision, is the root's component.  Neither step rounds to doubles before the end, so close eigenvalues
do not mix components.

*Scale.*  A task turns its vectors into sums of products in groups of columns, exact in doubles and
64-bit integers by splitting entries into limbs; Spark adds them up by row of the matrix.  The driver holds
dim x dim integers, whatever the rows.  Primes and components are dealt to tasks.  Two further passes
apply the components and measure their result.

Defined results: vectors that are null, empty or hold a null or non-finite entry, or one that leaves the range of a
long, are dropped; so are vectors of another length than most have (a tie: the longer length); repeated rows and
null or tied ids each count and give rows; a component whose eigenvalue is 0 cannot be whitened and is
left out, with it all later ones; no vectors, or equal ones only, give no rows; equal eigenvalues share a
null space, of which an orthonormal basis is taken.  ``deviation`` is null where it leaves the range of a long;
``deviation_exact`` has it as a decimal text.  Only the id and the vector are read, so other columns may
have any names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE, COMPONENTS = 1024, 8
#: Bits to which roots and components are computed, and bits more in which the arithmetic is done.
DIGITS, GUARD = 192, 128
#: Columns of a block of the scatter matrix, and vectors multiplied at a time.
BLOCK, ROWS = 256, 4096
LIMB = 20


# ---- exact sums ----------------------------------------------------------------------------------

def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a^T b of 64-bit integers as Python integers: limbs of ``LIMB`` bits, whose products' sums over
    ``ROWS`` rows are exact in doubles (2 * 20 + 12 = 52 bits)."""
    def limbs(x):
        out = []
        while True:
            low = x & ((1 << LIMB) - 1) if (x > (1 << LIMB)).any() or (x < -(1 << LIMB)).any() else x
            out.append(low.astype(np.float64))
            if low is x:
                return out
            x = x >> LIMB
    total = np.zeros((a.shape[1], b.shape[1]), object)
    for i, u in enumerate(limbs(a)):
        for j, v in enumerate(limbs(b)):
            total += (u.T @ v).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _integers(flat: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * entry).  A constant added to all of them (the query's 100000) changes no result: what is
    centred has it no more."""
    return np.floor(flat * scale).astype(np.int64)


def _vectors(batch, column: int, dim: int, scale: int):
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return _integers(flat.reshape(-1, dim), scale)


def scatter(rows: DataFrame, dim: int, scale: int = SCALE) -> tuple[int, list[int], np.ndarray]:
    """(n, S without the shift, n * sum(y y^T) - S S^T) of the vectors of ``rows`` (one column ``vector``)."""
    def add(batches):
        import pyarrow as pa
        products: dict[tuple[int, int], np.ndarray] = {}
        sums, n = np.zeros(dim, object), 0
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                y = _vectors(b.slice(i, ROWS), 0, dim, scale)
                n += len(y)
                # in two limbs a sum of 4096 rows cannot overflow
                sums += (y >> 32).sum(0).astype(object) * (1 << 32) + (y & 0xFFFFFFFF).sum(0).astype(object)
                for r in range(0, dim, BLOCK):
                    for c in range(r, dim, BLOCK):
                        p = exact_products(y[:, r:r + BLOCK], y[:, c:c + BLOCK])
                        products[r, c] = products[r, c] + p if (r, c) in products else p
        if n:
            rows_, columns, values = [-1, -2], [0, 0], [[str(n)], [str(x) for x in sums]]
            for (r, c), p in products.items():
                rows_ += range(r, r + len(p))
                columns += [c] * len(p)
                values += [[str(x) for x in line] for line in p]
            yield pa.RecordBatch.from_arrays([pa.array(rows_, pa.int32()), pa.array(columns, pa.int32()), pa.array(values, pa.list_(pa.string()))],
                                             names=["row", "first", "part"])

    def together(batches):
        import pyarrow as pa
        held: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for r, c, part in zip(*(b.column(i).to_pylist() for i in range(3))):
                x = np.array([int(v) for v in part], object)
                held[r, c] = held[r, c] + x if (r, c) in held else x
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in held], pa.int32()), pa.array([c for _, c in held], pa.int32()),
                                              pa.array([[str(v) for v in x] for x in held.values()], pa.list_(pa.string()))], names=["row", "first", "part"])

    kind = "row int, first int, part array<string>"
    found = rows.select("vector").mapInArrow(add, kind).repartition("row", "first").mapInArrow(together, kind).collect()  # a row a line of the matrix
    lines = {(r.row, r.first): [int(v) for v in r.part] for r in found}
    if not lines:
        return 0, [0] * dim, np.zeros((dim, dim), object)
    n, s = lines.pop((-1, 0))[0], lines.pop((-2, 0))
    m = np.zeros((dim, dim), object)
    for (r, c), part in lines.items():
        m[r, c:c + len(part)] = part
        m[c:c + len(part), r] = part
    s_ = np.array(s, object)
    return n, s, n * m - np.outer(s_, s_)


# ---- the characteristic polynomial ---------------------------------------------------------------

def primes(count: int) -> list[int]:
    """The largest primes below 2**31, in falling order."""
    found, x = [], 2**31 - 1
    while len(found) < count:
        d, s = x - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        for base in (2, 3, 5, 7):  # decides below 3 215 031 751
            y = pow(base, d, x)
            if y not in (1, x - 1) and not any((y := y * y % x) == x - 1 for _ in range(s - 1)):
                break
        else:
            found.append(x)
        x -= 2
    return found


def hessenberg_polynomial(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, from the constant on, of det(t - m) modulo a prime below 2**31 (``m`` reduced)."""
    h = m.astype(np.int64).copy()
    n = len(h)
    for k in range(n - 2):  # similarity steps that clear column k below its subdiagonal
        at = np.flatnonzero(h[k + 1:, k])
        if not len(at):
            continue
        i = k + 1 + int(at[0])
        if i != k + 1:
            h[[i, k + 1]] = h[[k + 1, i]]
            h[:, [i, k + 1]] = h[:, [k + 1, i]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(1)) % p
    polys = [np.array([1], np.int64)]
    for k in range(n):
        q = np.zeros(k + 2, np.int64)
        q[1:] = polys[k]
        q[:-1] = (q[:-1] - int(h[k, k]) * polys[k] % p) % p
        t = 1
        for i in range(k - 1, -1, -1):
            t = t * int(h[i + 1, i]) % p
            if not t:
                break
            if h[i, k]:
                q[:i + 1] = (q[:i + 1] - t * int(h[i, k]) % p * polys[i] % p) % p
        polys.append(q)
    return polys[n]


def characteristic_polynomial(spark, m: np.ndarray) -> list[int]:
    """Coefficients of det(t - m), from the constant on, of a positive semidefinite integer matrix."""
    n = len(m)
    # a coefficient is a sum of principal minors, each at most the product of its diagonal entries
    bound = 1
    for d in m.diagonal():
        bound *= 1 + int(d)
    count = (2 * bound).bit_length() // 30 + 1
    shared = spark.sparkContext.broadcast([[int(x) for x in line] for line in m])

    def of(batches):
        import pyarrow as pa
        whole = np.array(shared.value, object)
        for b in batches:
            for p in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([hessenberg_polynomial((whole % p).astype(np.int64), p).tolist()])], names=["p", "c"])

    ps = primes(count)
    frame = spark.createDataFrame([(p,) for p in ps], "p long").repartition(min(len(ps), 64))
    found = {r.p: r.c for r in frame.mapInArrow(of, "p long, c array<long>").collect()}
    total = math.prod(ps)
    out = [0] * (n + 1)
    for p in ps:
        others = total // p
        weight = others * pow(others, -1, p)
        for i, c in enumerate(found[p]):
            out[i] += c * weight
    return [x % total - total if x % total > total // 2 else x % total for x in out]


# ---- roots ---------------------------------------------------------------------------------------

def shifted(c: list[int], num: int, bits: int) -> list[int]:
    """Coefficients of 2**(bits * degree) * c(t / 2**bits + num / 2**bits)."""
    n = len(c) - 1
    out = [x << (bits * (n - i)) for i, x in enumerate(c)]
    for i in range(n):
        for k in range(n - 1, i - 1, -1):
            out[k] += num * out[k + 1]
    return out


def roots_beyond(c: list[int], num: int, bits: int) -> int:
    """Roots of ``c`` larger than num / 2**bits, with multiplicity: the sign changes after a shift, as all are real."""
    signs = [x > 0 for x in shifted(c, num, bits) if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_sign(c: list[int], num: int, bits: int) -> int:
    out = 0
    for i, x in enumerate(reversed(c)):
        out = out * num + (x << (bits * i))
    return (out > 0) - (out < 0)


def largest_roots(c: list[int], count: int, digits: int = DIGITS) -> list[tuple[int, int, int]]:
    """The largest positive roots of ``c``, all of whose roots are real and not negative, until ``count`` are found with multiplicity:
    (num, bits, multiplicity), the root lying in (num, num + 1] / 2**bits, with ``digits`` bits or more of it known.
    Roots that agree to that many bits are one."""
    while len(c) > 1 and not c[0]:  # roots at 0
        c = c[1:]
    if len(c) < 2:
        return []
    top = max(1, -c[-2]).bit_length()  # the roots' sum is beyond every root
    # (low, high] at scale 2**bits, its number of roots, and that of the roots beyond it; the largest first
    todo, out, found = [(0, 1 << top, 0, len(c) - 1, 0)], [], 0
    while todo and found < count:
        low, high, bits, many, beyond = todo.pop()
        if high - low == 1:
            if low.bit_length() >= digits:
                out.append((low, bits, many))
                found += many
                continue
            low, high, bits = low * 2, high * 2, bits + 1
        middle = (low + high) // 2
        if many == 1:  # the sign of c tells whether an odd number of roots is beyond
            sign = value_sign(c, middle, bits)
            above = int(sign != 0 and (sign < 0) != (beyond % 2 == 1))
        else:
            above = roots_beyond(c, middle, bits) - beyond
        if many - above:
            todo.append((low, middle, bits, many - above, beyond + above))
        if above:
            todo.append((middle, high, bits, above, beyond))
    return out


# ---- components ----------------------------------------------------------------------------------

def null_vectors(m: np.ndarray, num: int, bits: int, many: int, seed: int, digits: int = DIGITS) -> list[list[float]]:
    """``many`` orthonormal vectors of the null space of m - (num + 1/2) / 2**bits, by inverse iteration in fixed point."""
    n = len(m)
    size = max(int(abs(x)) for x in m.ravel()).bit_length() + n.bit_length()
    work = digits + GUARD
    # entries below 1 in size, in units of 2**-work
    fix = lambda x, b: x << (work - size - b) if work >= size + b else x >> (size + b - work)
    a = np.array([[fix(int(x), 0) for x in line] for line in m], object)
    root = fix(2 * num + 1, bits + 1)
    for i in range(n):
        a[i, i] -= root
    order = list(range(n))
    for k in range(n):  # LU with partial pivots, in place
        i = max(range(k, n), key=lambda r: abs(a[r, k]))
        if i != k:
            a[[i, k]] = a[[k, i]]
            order[i], order[k] = order[k], order[i]
        if not a[k, k]:
            a[k, k] = 1
        if k + 1 < n:
            a[k + 1:, k] = (a[k + 1:, k] << work) // a[k, k]
            a[k + 1:, k + 1:] -= (a[k + 1:, k][:, None] * a[k, k + 1:][None, :]) >> work
    rng = np.random.default_rng(seed)

    def solved(v):
        x = np.array([v[i] for i in order], object)
        for k in range(n):
            x[k + 1:] -= (a[k + 1:, k] * x[k]) >> work
        for k in range(n - 1, -1, -1):
            x[k] = (x[k] << work) // a[k, k]
            x[:k] -= (a[:k, k] * x[k]) >> work
        return x

    def unit(x):
        length = math.isqrt(sum(int(v) * int(v) for v in x))
        return np.array([(int(v) << work) // length for v in x], object)

    basis = []
    for _ in range(many):
        x = unit(np.array([int(v) for v in rng.integers(-(1 << 40), 1 << 40, n)], object))
        for _ in range(3):
            x = solved(x)
            for _ in range(2):
                x = unit(x)
                for b in basis:
                    x = x - ((b * (int((x * b).sum()) >> work)) >> work)
            x = unit(x)
        basis.append(x)
    out = []
    for x in basis:
        v = [int(i) / (1 << work) for i in x]
        lead = max(v, key=abs)
        out.append([i if lead > 0 else -i for i in v])  # either sign would do: the largest entry is positive
    return out


def components(spark, m: np.ndarray, count: int) -> list[tuple[float, float, list[float]]]:
    """(eigenvalue, its part of the trace, unit vector) of the ``count`` largest positive eigenvalues of ``m``."""
    trace = sum(int(x) for x in m.diagonal())
    if not trace:
        return []
    found = largest_roots(characteristic_polynomial(spark, m), count)
    shared = spark.sparkContext.broadcast([[int(x) for x in line] for line in m])

    def of(batches):
        import pyarrow as pa
        whole = np.array(shared.value, object)
        for b in batches:
            for i, num, bits, many in zip(*(b.column(k).to_pylist() for k in range(4))):
                vs = null_vectors(whole, int(num), bits, many, i)
                yield pa.RecordBatch.from_arrays([pa.array([i] * many, pa.int32()), pa.array(range(many), pa.int32()), pa.array(vs)], names=["i", "k", "v"])

    frame = spark.createDataFrame([(i, str(num), bits, many) for i, (num, bits, many) in enumerate(found)], "i int, num string, bits int, many int")
    vectors = {(r.i, r.k): r.v for r in frame.repartition(len(found), "i").mapInArrow(of, "i int, k int, v array<double>").collect()}
    out = []
    for i, (num, bits, many) in enumerate(found):
        for k in range(many):
            # the integers' quotients are rounded once
            out.append(((2 * num + 1) / (1 << (bits + 1)), (2 * num + 1) / (trace << (bits + 1)), vectors[i, k]))
    return out[:count]


# ---- the operator --------------------------------------------------------------------------------

def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, count: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, deviation_exact, whitened, explained, identity_error`` of every vector and
    each of the ``count`` largest components."""
    spark = rows.sparkSession
    x = F.col("vector")
    inside = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 2.0**62 / scale)
    clean = (rows.select(F.col(id_col).alias("vec_id"), F.transform(F.col(vector_col), lambda v: v.cast("double")).alias("vector"))
             .filter(x.isNotNull() & (F.size(x) > 0) & F.forall(x, inside)))
    lengths = clean.groupBy(F.size(x).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = lengths["dim"] if lengths else 0
    fit = clean.filter(F.size(x) == dim)
    n, sums, m = scatter(fit, dim, scale) if dim else (0, [], None)
    parts = components(spark, m, count) if n else []
    # an eigenvalue of V is one of m over n**2
    axes = np.array([v for _, _, v in parts]).reshape(len(parts), dim) / np.array([math.sqrt(e) / n for e, _, _ in parts])[:, None]
    shared = spark.sparkContext.broadcast((sums, axes))

    def apply(batches):
        import pyarrow as pa
        s, axes_ = shared.value
        whole, rest = [t // n for t in s], np.array([t % n / n for t in s])
        small = max(map(abs, whole)) < 1 << 62
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                y = _vectors(part, 1, dim, scale)
                # x - S / n: first the whole numbers, exactly, then the fraction that S / n has beyond
                centred = (y - np.array(whole, np.int64) if small else (y.astype(object) - np.array(whole, object))).astype(np.float64) - rest
                largest = max(abs(int(y.min())), abs(int(y.max()))) * n + max(map(abs, s))
                if largest * largest * dim < 1 << 63:
                    exact = ((y * n - np.array(s, np.int64)) ** 2).sum(1).tolist()
                else:
                    exact = ((y.astype(object) * n - np.array(s, object)) ** 2).sum(1).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([d if d < 1 << 63 else None for d in exact], pa.int64()), pa.array(list(map(str, exact))),
                     pa.array(list(centred @ axes_.T), pa.list_(pa.float64()))], names=["vec_id", "deviation", "deviation_exact", "w"])

    if parts:
        kind = f"vec_id {clean.schema['vec_id'].dataType.simpleString()}, deviation long, deviation_exact string, w array<double>"
        out = written(fit.select("vec_id", "vector").mapInArrow(apply, kind), "whitened")
        error = identity_error(out, len(parts), n)
    else:
        out, error = fit.select("vec_id", F.lit(0).cast("long").alias("deviation"), F.lit("").alias("deviation_exact"),
                                F.array().cast("array<double>").alias("w")), 0.0
    explained = F.array(*(F.lit(p) for _, p, _ in parts)).cast("array<double>")
    return (out.select("vec_id", "deviation", "deviation_exact", F.posexplode("w").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "deviation_exact", "whitened",
                    F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))


def identity_error(out: DataFrame, k: int, n: int) -> float:
    """The largest absolute entry of the covariance of ``w`` (arrays of ``k``), centred, less the identity."""
    def summed(of) -> np.ndarray:
        def add(batches):
            import pyarrow as pa
            total = sum(of(b.column(0).flatten().to_numpy().reshape(-1, k)) for b in batches if b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array([np.ravel(total).tolist()], pa.list_(pa.float64()))], names=["s"])

        found = out.select("w").mapInArrow(add, "s array<double>").select(F.posexplode("s").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
        by = {r["at"]: r["v"] for r in found.collect()}  # at most k * k rows
        return np.array([by[i] for i in sorted(by)]) / n

    mean = summed(lambda w: w.sum(0))

    def products(w):
        w = w - mean
        return w.T @ w

    return float(np.abs(summed(products).reshape(k, k) - np.eye(k)).max())
