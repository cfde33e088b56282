"""Quality classifier: an interpolated modified Kneser-Ney model of characters, trained on trusted text;
a document is kept if its perplexity is at most a quantile of trusted documents of its language.

A symbol is a code point; nothing is folded, so the tables grow with what is written in the trusted text.
Counts are taken over all trusted documents by a sharded aggregation; discounts, context totals and lower
orders come from joins of the count tables, sharded by context.  Scoring is joins, too: documents are
dealt to chunks of about ``CHUNK`` characters, the distinct runs of each chunk are joined with the tables, order by
order, and their costs go to the chunk, whose documents are summed there.  No table reaches the driver
or is sent to all tasks.

Text that a model was trained on scores too well, so the quantiles are taken over cross-fitted scores:
trusted documents are dealt to ``HOLD_OUT`` parts by id hash, and each part is scored by a model of the
other parts.  So each language has all its trusted documents for its own quantile and typical score, few
or many.  Documents are judged by the model of all parts.

Short documents score unevenly, so a score is the mean over its symbols and ``PRIOR`` further ones
at the language's typical score.

Defined results: a null or empty text has no perplexity and is rejected; a null language is one of
its own; texts of any length are scored whole; tied scores fall on the same side of a threshold; a document with several label
rows is trusted if all of them say so; an empty table gives no rows; only the named columns are read, so other columns may have any names (those of ``keep`` but the
results'); a language without trusted text has no threshold, and its documents with text are kept; a document counts as trusted if no label row says otherwise; rows repeated whole are scored
alike; without trusted text nothing can be judged and every document with text is kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, written

ORDER, BITS = 4, 6
SYMBOLS = 1 << BITS
EDGE = SYMBOLS - 1
QUANTILE, HOLD_OUT, PRIOR = 0.995, 5, 60
#: Ids of trusted documents that may be broadcast (16 MB).
MAX_BROADCAST_IDS = 2_000_000
#: Step of the scores (log perplexity) that quantiles are taken to; -log of the least probability is 69.1.
STEP = 0.0005
LEAST = 1e-30
#: Symbols that a task counts at a time, and that a chunk of documents has: what is joined for a chunk is a part of its text
#: that shrinks as it grows.
CHUNK, CHUNK_SYMBOLS = 4_000_000, 32_000_000
#: Bits of a code point, and the one beyond all that frames a text.
POINT_BITS, FRAME = 21, 0x110000
MARKS = " \n.,;:!?-()|#$%&*/'\""


# ------------------------------------------------------------------ runs of code points

def framed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, symbol, texts' first runs): each run of ORDER code points of each text, framed, as its first
    ORDER - 1 in one number and its last."""
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(x) for x in parts], np.int64)
    ends = np.cumsum(sizes + ORDER)
    s = np.full(int(ends[-1]) if len(ends) else 0, FRAME, np.int64)
    inside = np.ones(len(s), bool)
    for k in range(ORDER - 1):
        inside[ends - sizes - ORDER + k] = False
    inside[ends - 1] = False
    if parts:
        s[inside] = np.concatenate(parts)
    # a run is told by its last symbol, of which the frame before a text is none
    last = np.ones(len(s), bool)
    for k in range(ORDER - 1):
        last[ends - sizes - ORDER + k] = False
    at = np.flatnonzero(last)
    context = np.zeros(len(at), np.int64)
    for k in range(ORDER - 1, 0, -1):
        context = (context << POINT_BITS) | s[at - k]
    return context, s[at], np.cumsum(sizes + 1) - sizes - 1


def distinct_runs(context: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, symbol, n) of the different runs."""
    contexts, at = np.unique(context, return_inverse=True)
    runs, n = np.unique((at << POINT_BITS) | symbol, return_counts=True)
    return contexts[runs >> POINT_BITS], runs & ((1 << POINT_BITS) - 1), n


def packed(rows: DataFrame) -> DataFrame:
    """(_chunk, _rows): rows of a chunk, compressed together, so that texts are moved at a third of their size."""
    def pack(batches):
        import pyarrow as pa
        how = pa.ipc.IpcWriteOptions(compression="zstd")
        for b in batches:
            chunk = b.column("_chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1):
                if len(at):
                    to = pa.BufferOutputStream()
                    with pa.ipc.new_stream(to, b.schema, options=how) as out:
                        out.write_batch(b.take(pa.array(at)))
                    yield pa.RecordBatch.from_arrays([pa.array(chunk[at[:1]]), pa.array([to.getvalue().to_pybytes()], pa.binary())], names=["_chunk", "_rows"])

    return rows.mapInArrow(pack, "_chunk int, _rows binary")


def unpacked(batches):
    import pyarrow as pa
    for b in batches:
        for x in b.column("_rows"):
            yield from pa.ipc.open_stream(x.as_buffer())


def run_counts(texts: DataFrame, by: tuple[str, ...] | None = None) -> DataFrame:
    """(context, symbol, n) over the text column of ``texts``, for each value of its second column if it has one:
    counted in the tasks, then summed.  With ``by`` such rows are ``packed``, and the second column is ``by``."""
    rows, by = (iter, texts.columns[1:]) if by is None else (unpacked, by)

    def count(batches):
        import pyarrow as pa
        held, size = {}, 0

        def counted():
            for key, some in held.items():
                for i in range(0, len(some), 4096):
                    context, symbol, n = distinct_runs(*framed(some[i:i + 4096])[:2])
                    columns = [pa.array(np.full(len(n), key, np.int32))] if by else []
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(context), pa.array(symbol.astype(np.int32)), pa.array(n.astype(np.int64))],
                                                     names=[*by, "context", "symbol", "n"])

        for b in rows(batches):
            keys = b.column(1).to_pylist() if by else [None] * b.num_rows
            for t, key in zip(b.column(0), keys):
                if text := t.as_py():
                    held.setdefault(key, []).append(text)
                    size += len(text) + 1
                if size >= CHUNK:
                    yield from counted()
                    held, size = {}, 0
        yield from counted()

    fields = "".join(f"{c} int, " for c in by) + "context long, symbol int, n long"
    return texts.mapInArrow(count, fields).groupBy(*by, "context", "symbol").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ an alphabet of 64 folded symbols, in one dense table

def _symbol_table() -> np.ndarray:
    """Code point -> symbol: a-z, capitals, digits, each mark, other marks, then hashed ones: letters
    beyond ASCII as many as are left, other scripts 3; the last symbol is the text's edge."""
    table = np.empty(0x110000, np.uint8)
    n_marks = 26 + 2 + len(MARKS)
    other, low, letters = n_marks, n_marks + 1, EDGE - 3
    points = np.arange(0x110000)
    table[:] = letters + points % 3
    table[0x2000:0x2E00] = other
    table[:0x80] = other
    latin = np.arange(0xDF, 0x250)
    table[latin] = low + latin % (letters - low)
    table[0x80:0xC0] = other
    table[0xC0:0xDF] = 26
    table[ord("a"):ord("z") + 1] = np.arange(26)
    table[ord("A"):ord("Z") + 1] = 26
    table[ord("0"):ord("9") + 1] = 27
    for i, c in enumerate(MARKS):
        table[ord(c)] = 28 + i
    table[[9, 11, 12, 13]] = table[32]
    assert table.max() < EDGE
    return table


_TABLE: list[np.ndarray] = []


def grams(text: str) -> np.ndarray:
    """The code of each run of ORDER symbols, the text being framed by edges."""
    if not _TABLE:
        _TABLE.append(_symbol_table())
    s = _TABLE[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int32)
    s = np.concatenate([np.full(ORDER - 1, EDGE, np.int32), s, [np.int32(EDGE)]])
    n = len(s) - ORDER + 1
    code = np.zeros(n, np.int32)
    for k in range(ORDER):
        code = (code << BITS) | s[k:k + n]
    return code


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) over the text column of ``texts``, for each ``part`` if that is its second column: counted
    in the tasks, then summed."""
    by = texts.columns[1:]

    def count(batches):
        import pyarrow as pa
        held, size = [], 0

        def counted():
            seen, n = np.unique(np.concatenate(held), return_counts=True)
            columns = [seen >> ORDER * BITS] if by else []
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in [*columns, seen & (SYMBOLS ** ORDER - 1)]]
                                              + [pa.array(n.astype(np.int64))], names=[*by, "gram", "n"])

        for b in batches:
            for i, v in enumerate(b.column(0)):
                if text := v.as_py():
                    found = grams(text)
                    held.append(found | np.int64(b.column(1)[i].as_py() << ORDER * BITS) if by else found)
                    size += len(held[-1])
                if size >= CHUNK:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    fields = "".join(f"{c} int, " for c in by) + "gram int, n long"
    return texts.mapInArrow(count, fields).groupBy(*by, "gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame, by: list[str]) -> dict[tuple, list[float]]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the counts of counts, for each model."""
    rows = counts.groupBy(*by).agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).collect()
    out = {}
    for row in rows:
        # each count of counts is raised by 1: the same rule for any size, also where one is 0
        n1, n2, n3, n4 = ((row[f"n{k}"] or 0) + 1 for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        out[tuple(row[c] for c in by)] = [min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1)]
    return out


def train(counts: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """``train_runs`` of the folded alphabet: (gram, p) and (context, weight) by order."""
    split = counts.select(F.shiftright("gram", BITS).cast("long").alias("context"), F.col("gram").bitwiseAND(SYMBOLS - 1).alias("symbol"), "n")
    probs, weights = train_runs(split, BITS, 1.0 / SYMBOLS)
    return [t.select(F.shiftleft("context", BITS).bitwiseOR(F.col("symbol")).alias("gram"), "p") for t in probs], weights


def _without_first(k: int, bits: int):
    """The context of order ``k`` of a longer one: its last k - 1 symbols."""
    return F.col("context").bitwiseAND(F.lit((1 << bits * (k - 1)) - 1).cast("long"))


def train_runs(counts: DataFrame, bits: int = POINT_BITS, least: float = 1.0) -> tuple[list[DataFrame], list[DataFrame]]:
    """(probabilities, weights) by order 1..ORDER: (context, symbol, p) of each run seen, interpolated with the
    lower orders, the lowest being ``least`` for any symbol, and (context, weight) that an unseen run's
    lower-order probability is given.  With a column ``model`` in ``counts``, a model each, side by side."""
    by = ["model"] if "model" in counts.columns else []
    run = [*by, "context", "symbol"]
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: in how many longer runs a run ends
        shorter = tables[k + 1].withColumn("context", _without_first(k, bits))
        tables[k] = written(shorter.groupBy(*run).agg(F.count("*").alias("n")), f"grams{k}")
    lower = None
    probs, weights = [], []
    for k in range(1, ORDER + 1):
        cut = F.lit(None).cast("double")
        for key, d in _discounts(tables[k], by).items():
            own = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
            cut = F.when(F.col("model") == key[0], own).otherwise(cut) if by else own
        contexts = tables[k].groupBy(*by, "context").agg(F.sum("n").alias("total"), F.sum(cut).alias("held"))
        contexts = contexts.select(*by, "context", "total", (F.col("held") / F.col("total")).alias("weight"))
        joined = tables[k].join(contexts, [*by, "context"])
        if lower is None:
            joined = joined.withColumn("lower", F.lit(least))
        else:
            joined = (joined.withColumn("suffix", _without_first(k - 1, bits))
                      .join(lower.select(*by, F.col("context").alias("suffix"), "symbol", F.col("p").alias("lower")), [*by, "suffix", "symbol"]))
        lower = written(joined.select(*run, "weight", ((F.col("n") - cut) / F.col("total") + F.col("weight") * F.col("lower")).alias("p")),
                        f"probabilities{k}")
        probs.append(lower.select("context", "symbol", "p", *by))
        weights.append(lower.groupBy(*by, "context").agg(F.first("weight").alias("weight")).select("context", "weight", *by))
    return probs, weights


def run_costs(runs: DataFrame, probs: list[DataFrame], weights: list[DataFrame], least: float) -> DataFrame:
    """(model, context, symbol, cost) of each of the different ``runs``: -log of its probability.  A run that an order
    has not seen is given the weight of its context there, if that was seen, of its probability of the next lower order."""
    def probability(wanted: DataFrame, k: int) -> DataFrame:
        if k == 0:
            return wanted.withColumn("p", F.lit(least))
        below = _without_first(k - 1, POINT_BITS) if k > 1 else F.lit(0).cast("long")
        lower = probability(wanted.select("model", below.alias("context"), "symbol").distinct(), k - 1)
        return (wanted.withColumn("suffix", below)
                .join(lower.select("model", F.col("context").alias("suffix"), "symbol", F.col("p").alias("lower")), ["model", "suffix", "symbol"])
                .join(weights[k - 1], ["model", "context"], "left")
                .join(probs[k - 1], ["model", "context", "symbol"], "left")
                .select("model", "context", "symbol", F.coalesce("p", F.coalesce("weight", F.lit(1.0)) * F.col("lower")).alias("p")))

    found = probability(runs.select("model", "context", "symbol").distinct(), ORDER)
    return found.select("model", "context", "symbol", (-F.log(F.greatest("p", F.lit(LEAST)))).alias("cost"))


class Scorer:
    """-log probability of every gram code.  At most 64**4 entries, whatever the corpus."""

    def __init__(self, probs, weights):
        p = np.full(SYMBOLS, 1.0 / SYMBOLS, np.float32)
        for k, ((grams_, seen), (contexts, weight)) in enumerate(zip(probs, weights), 1):
            back = np.ones(SYMBOLS ** (k - 1), np.float32)
            back[contexts] = weight
            # gram = context * 64 + symbol; what is left of it without its first symbol is the lower order's
            wide = np.empty((len(back), SYMBOLS), np.float32)
            lower = p.reshape(-1, SYMBOLS)
            for at in range(0, len(back), len(lower)):
                np.multiply(lower, back[at:at + len(lower), None], out=wide[at:at + len(lower)])
            p = wide.ravel()
            p[grams_] = seen
        # in place: the table of the highest order is 64 MB
        np.maximum(p, np.float32(1e-30), out=p)
        np.log(p, out=p)
        self.cost = np.negative(p, out=p)

    def score(self, text: str) -> tuple[float, int]:
        """(sum of -log probability, number of symbols) of a text."""
        c = self.cost[grams(text)]
        return float(c.sum(dtype=np.float64)), len(c)


def _arrays(df: DataFrame):
    """A table of the folded alphabet, at most 64**ORDER rows, as arrays."""
    t = df.toArrow()
    return t.column(0).to_numpy().astype(np.int32), t.column(1).to_numpy().astype(np.float32)


# ------------------------------------------------------------------ scores

def summed(packs, costs, at: int, n: int):
    """The first ``n`` columns of the packed documents with the sum of the costs of their texts' runs (column ``at``) and the number of these."""
    import pyarrow as pa
    docs = pa.Table.from_batches(unpacked([packs]))
    total, symbols = [None] * docs.num_rows, [0] * docs.num_rows
    known, where = np.unique(costs["context"].to_numpy(), return_inverse=True)
    runs = (where.astype(np.int64) << POINT_BITS) | costs["symbol"].to_numpy()
    order = np.argsort(runs)
    runs, cost = runs[order], costs["cost"].to_numpy()[order]

    def flush(rows, texts):
        context, symbol, first = framed(texts)
        found = np.searchsorted(runs, (np.searchsorted(known, context) << POINT_BITS) | symbol)
        for i, x, m in zip(rows, np.add.reduceat(cost[found], first).tolist(), np.diff(first, append=len(found)).tolist()):
            total[i], symbols[i] = x, m

    rows, texts, size = [], [], 0
    for i, t in enumerate(docs.column(at)):
        if text := t.as_py():
            rows.append(i)
            texts.append(text)
            size += len(text)
            if size >= CHUNK // 4:
                flush(rows, texts)
                rows, texts, size = [], [], 0
    if rows:
        flush(rows, texts)
    return pa.table([*docs.columns[:n], pa.array(total, pa.float64()), pa.array(symbols, pa.int64())],
                    names=[*docs.column_names[:n], "cost", "symbols"])


def scored(docs: DataFrame, probs: list[DataFrame], weights: list[DataFrame], least: float, which, text_col: str = "text",
           keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """``keep`` columns, ``cost`` (sum of -log probability; null without text) and ``symbols`` of every row
    by the model of the number ``which``."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.length(text_col) + 1)).first()[0] or 1
    # as many chunks as the texts need; of small texts enough to have all tasks at work
    dealt = max(1, -(-size // CHUNK_SYMBOLS), min(spark.sparkContext.defaultParallelism, size // 1_000_000))
    # a chunk has one model; whatever the ids are, its rows are found by what they hold
    chunk = F.pmod(F.xxhash64(*[F.col(c) for c in docs.columns if c in ("doc_id", text_col)], F.lit("chunk")), F.lit(dealt))
    chunk = (which * F.lit(dealt) + chunk).cast("int").alias("_chunk")
    runs = run_counts(packed(docs.select(text_col, chunk)).repartition(dealt, "_chunk"), ("_chunk",))
    runs = written(runs.select("_chunk", "context", "symbol").withColumn("model", F.floor(F.col("_chunk") / dealt).cast("int")), "runs")
    release()  # the texts' shuffle
    costs = written(run_costs(runs, probs, weights, least), "costs")
    release()
    costs = runs.join(costs, ["model", "context", "symbol"]).select("_chunk", "context", "symbol", "cost").repartition(dealt, "_chunk")
    rows = packed(docs.select(*keep, *([] if text_col in keep else [text_col]), chunk))
    n, at = len(keep), keep.index(text_col) if text_col in keep else len(keep)
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields] + ["cost double", "symbols long"])
    return (rows.repartition(dealt, "_chunk").groupBy("_chunk").cogroup(costs.groupBy("_chunk"))
            .applyInArrow(lambda left, right: summed(left, right, at, n), fields))


def _limits(scores: DataFrame, quantile: float) -> DataFrame:
    """(_l, t): the quantile of ``shrunk`` a language, to a step of ``STEP`` upwards.  Scores are counted by steps, of
    which a language has at most 70 / STEP, so the running count is small and the result always the same."""
    steps = scores.groupBy("_l", F.floor(F.col("shrunk") / STEP).alias("b")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy("_l").orderBy("b"))
    total = F.sum("c").over(Window.partitionBy("_l"))
    return (steps.withColumn("u", upto).withColumn("a", total).filter(F.col("u") >= quantile * F.col("a"))
            .groupBy("_l").agg(((F.min("b") + 1) * STEP).alias("t")))


def classify(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang",
             keep: tuple[str, ...] = (), quantile: float = QUANTILE, hold_out: int = HOLD_OUT, prior: float = PRIOR) -> DataFrame:
    """``doc_id, lang`` and ``keep`` columns, ``perplexity, threshold, kept`` of every row of ``docs``."""
    trusted = (labels.groupBy(F.col(id_col).alias("_id"))
               .agg(((F.min("quality") >= 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("_ok"))
               .filter("_ok").select("_id"))
    trusted = written(trusted, "trusted")
    # labels are few beside the texts: their ids go to the texts while they are at most so many,
    # beyond that the texts are shuffled to them
    trusted = F.broadcast(trusted) if trusted.count() <= MAX_BROADCAST_IDS else trusted.hint("merge")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("_t"),
                       *[F.col(c) for c in keep if c not in (id_col, lang_col, text_col)])
    part = F.pmod(F.xxhash64("doc_id", F.lit("hold-out")), F.lit(hold_out)).cast("int")
    known = base.select("doc_id", "lang", "_t").join(trusted, F.col("doc_id") == F.col("_id"), "left_semi")
    counts = written(run_counts(known.select("_t", part.alias("part"))), "counts")
    # the text itself is carried along only where it is wanted
    others = [c for c in base.columns if c != "_t" or text_col in keep]
    named = lambda df: df.withColumnRenamed("_t", text_col) if text_col in keep else df
    if counts.isEmpty():
        return named(base.select(*others, F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"),
                                 (F.length(F.coalesce("_t", F.lit(""))) > 0).alias("kept")))
    # model k is of all parts but k; the last one is of all
    models = counts.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(hold_out)))).filter("model <> part")
    models = models.groupBy("model", "context", "symbol").agg(F.sum("n").alias("n"))
    # the lowest order has each symbol alike, and one for those that no trusted text has
    least = 1.0 / (counts.select("symbol").distinct().count() + 1)
    probs, weights = train_runs(written(models, "model-counts"), least=least)
    trial = scored(known.withColumn("part", part), probs, weights, least, F.col("part"), "_t", ("lang",))
    trial = written(trial.filter("cost is not null"), "trial")
    release()
    marks = scored(base, probs, weights, least, F.lit(hold_out), "_t", tuple(others))
    # one row a language
    typicals = F.broadcast(trial.groupBy(F.col("lang").alias("_l")).agg((F.sum("cost") / F.sum("symbols")).alias("typical")))
    with_typical = lambda df: (df.join(typicals, F.col("lang").eqNullSafe(F.col("_l")), "left")
                               .withColumn("shrunk", F.coalesce((F.col("cost") + prior * F.col("typical")) / (F.col("symbols") + prior),
                                                                F.col("cost") / F.col("symbols"))))
    limits = _limits(with_typical(trial).select("_l", "shrunk"), quantile).select(F.col("_l").alias("_k"), F.col("t").alias("limit"))
    out = with_typical(marks).join(F.broadcast(limits), F.col("lang").eqNullSafe(F.col("_k")), "left")
    return named(out.select(*others, F.exp("shrunk").alias("perplexity"), F.exp("limit").alias("threshold"),
                            (F.col("cost").isNotNull() & F.coalesce(F.col("shrunk") <= F.col("limit"), F.lit(True))).alias("kept")))
