"""Benchmark decontamination with an FM-index per training shard.

A shard (the documents of one task, in parts of bounded size) is a sequence of word ids.  Its suffix
array, Burrows-Wheeler transform and wavelet matrix are built with numpy; every benchmark window is
backward-searched through the wavelet ranks, all windows at once; occurrences are located through
sampled suffix positions; overlapping occurrences merge into removal spans.

A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
window.  The index leaves out what no window can touch: a run of benchmark words shorter than the
shortest window lies in no occurrence.

The benchmark is cut into pieces that hold all windows, and pieces into parts of about ``PART_CHARS``.  One
part is searched in one pass without a shuffle.  More are searched one after another, each with windows of bounded
size; only texts with hits are passed on, named by their SHA-256, and a text's spans and items are merged.

Defined results: a null text has no words; an item without words has no window; rows repeated whole
are judged one by one, tied and null ids too; texts of any length are searched whole; item ids that tie are one
item; an empty benchmark hits nothing, an empty table gives no rows; only the named columns are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
import re
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # after lower-casing A-Z
WINDOW = 10
#: Characters of the benchmark that travel with the tasks at a time, and words of a piece of an item.
PART_CHARS, PIECE_WORDS = 2_000_000, 20_000
#: A shard's index is built over at most about so many words; a task with more builds several.
SHARD_WORDS = 3_000_000
SAMPLE = 16


def words_of(text: str | None) -> list[bytes]:
    # bytes.lower() lower-cases A-Z alone
    return WORD.findall(text.encode().lower()) if text else []


class Windows:
    """Distinct windows of the benchmark as word-id rows, and the items that each belongs to."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        found: dict[tuple, set] = {}
        for item, text in items:
            ids = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[i:i + window]), set()).add(item)
        self.patterns = sorted(found)
        self.items = [sorted(found[p], key=str) for p in self.patterns]
        self.size = np.array([len(p) for p in self.patterns], np.int64)
        self.shortest = int(self.size.min()) if len(self.size) else 0
        # right-aligned, so that the backward search steps through all windows at once
        self.grid = np.zeros((len(self.patterns), window), np.int32)
        for row, p in zip(self.grid, self.patterns):
            row[window - len(p):] = p


class Wavelet:
    """Wavelet matrix over small integers: access and rank in one step a bit."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.n = len(values)
        self.words, self.blocks, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = ((values >> level) & 1).astype(bool)
            padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            padded[:self.n] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.blocks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(self.n - int(bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        block, rest = i >> 6, (i & 63).astype(np.uint64)
        return self.blocks[level][block] + np.bitwise_count(self.words[level][block] & ((np.uint64(1) << rest) - np.uint64(1)))

    def rank(self, value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each value before lo and before hi."""
        start = np.zeros(len(value), np.int64)
        for level in range(self.bits):
            one = ((value >> (self.bits - 1 - level)) & 1).astype(bool)
            moved = []
            for x in (start, lo, hi):
                ones = self._ones(level, x)
                moved.append(np.where(one, self.zeros[level] + ones, x - ones))
            start, lo, hi = moved
        return lo - start, hi - start

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value at each position, and how often it occurs before."""
        start, value = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for level in range(self.bits):
            one = ((self.words[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            value = value * 2 + one
            ones, base = self._ones(level, i), self._ones(level, start)
            i = np.where(one, self.zeros[level] + ones, i - ones)
            start = np.where(one, self.zeros[level] + base, start - base)
        return value, i - start


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """Suffix positions in order, by prefix doubling.  ``ranks`` are positive; equal prefixes settle
    at the latest where the sequence ends or holds a value that occurs once."""
    n = len(ranks)
    rank = np.unique(ranks, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:max(0, n - step)] = rank[step:]
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        rank[order] = new
        if new[-1] == n:
            return order
        step *= 2


class FMIndex:
    """Index of a sequence of word ids in which 0 parts the runs; a pattern holds no 0."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        n = len(sequence)
        parts = sequence == 0
        # each 0 sorts before all words and differs from every other 0
        ranks = np.where(parts, np.cumsum(parts), sequence.astype(np.int64) + int(parts.sum()))
        order = suffix_array(ranks)
        self.wavelet = Wavelet(sequence[order - 1].astype(np.int64), sigma)
        counts = np.bincount(sequence, minlength=sigma)
        self.before = np.concatenate([[0], np.cumsum(counts)])[:sigma]
        self.n = n
        # sampled: every SAMPLE-th position, and the first of each run, so that no walk meets a 0
        keep = (order % SAMPLE == 0) | parts[order - 1] | parts[order]
        self.sampled = keep
        self.place = np.cumsum(keep) - 1
        self.sample = order[keep]

    def search(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that begin with each right-aligned pattern."""
        lo, hi = np.zeros(len(grid), np.int64), np.full(len(grid), self.n, np.int64)
        for j in range(grid.shape[1] - 1, -1, -1):
            live = np.flatnonzero((grid[:, j] > 0) & (lo < hi))
            if not len(live):
                continue
            c = grid[live, j].astype(np.int64)
            a, b = self.wavelet.rank(c, lo[live], hi[live])
            lo[live], hi[live] = self.before[c] + a, self.before[c] + b
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Sequence positions of suffix-array rows: step back until a sampled row."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.sampled[rows])
        while len(todo):
            c, before = self.wavelet.access_rank(rows[todo])
            rows[todo] = self.before[c] + before
            steps[todo] += 1
            todo = todo[~self.sampled[rows[todo]]]
        return self.sample[self.place[rows]] + steps


def _shard(ids: list[np.ndarray], w: Windows):
    """Hits in the documents of a shard, each an array of word ids (0: not a benchmark word).

    Returns (document, first word, size, pattern) of every occurrence."""
    none = (np.empty(0, np.int64),) * 4
    if not ids or not w.shortest:
        return none
    sizes = np.array([len(x) for x in ids], np.int64)
    # a 0 before each document and at the end parts the runs
    flat = np.zeros(int(sizes.sum()) + len(ids) + 1, np.int32)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1] + 1
    for s, x in zip(starts, ids):
        flat[s:s + len(x)] = x
    known = flat > 0
    edge = np.flatnonzero(np.diff(known.astype(np.int8)))  # flat begins and ends with 0
    first, last = edge[::2] + 1, edge[1::2] + 1
    long_ = last - first >= w.shortest
    first, last = first[long_], last[long_]
    if not len(first):
        return none
    run = last - first
    at = np.repeat(first - np.concatenate([[0], np.cumsum(run + 1)[:-1]]), run + 1) + np.arange(int((run + 1).sum()))
    sequence = np.concatenate([[0], np.where(known[at], flat[at], 0)])  # at last, each run's end is a 0
    place = np.concatenate([[0], at])
    sequence[np.cumsum(run + 1)] = 0
    index = FMIndex(sequence.astype(np.int64), len(w.ids) + 1)
    lo, hi = index.search(w.grid)
    found = hi - lo
    pattern = np.repeat(np.arange(len(lo)), found)
    if not len(pattern):
        return none
    rows = np.repeat(lo - np.concatenate([[0], np.cumsum(found)[:-1]]), found) + np.arange(int(found.sum()))
    where = place[index.locate(rows)]
    doc = np.searchsorted(starts, where, "right") - 1
    return doc, where - starts[doc], w.size[pattern], pattern


def merged_spans(begin: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """Union of [begin, begin + size), touching spans joined."""
    out: list[list[int]] = []
    for b, e in sorted(zip(begin.tolist(), (begin + size).tolist())):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [tuple(x) for x in out]


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between the words of one span."""
    raw = text.encode()
    words = [m.span() for m in WORD.finditer(raw.lower())]
    out, at = [], 0
    for b, e in spans:
        out.append(raw[at:words[b][0]])
        at = words[e - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  cleaned: bool = False, part_chars: int = PART_CHARS) -> DataFrame:
    """``keep`` columns, ``n_words, n_hit, n_items, items_sha256, contaminated, spans`` and, with
    ``cleaned``, ``clean_text`` (the text without its spans) of every row."""
    bench = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    total = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    if total > part_chars:
        return _in_parts(docs, bench, window, text_col, keep, cleaned, -(-total // part_chars))
    shared = docs.sparkSession.sparkContext.broadcast(Windows([tuple(r) for r in bench.collect()], window))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    fields += ["n_words long", "n_hit long", "n_items long", "items_sha256 string", "contaminated boolean",
               "spans array<struct<first:int,last:int>>"] + ["clean_text string"] * cleaned
    n_keep = len(keep)

    def judge(w: Windows, held: list, ids: list[np.ndarray]):
        import pyarrow as pa
        doc, begin, size, pattern = _shard(ids, w)
        order = np.argsort(doc, kind="stable")
        doc, begin, size, pattern = doc[order], begin[order], size[order], pattern[order]
        bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
        done = 0
        for b in held:
            cols: dict[str, list] = {k: [] for k in ("n_words", "n_hit", "n_items", "items", "spans", "clean")}
            for i in range(b.num_rows):
                s, e = bounds[done + i], bounds[done + i + 1]
                spans, items = [], []
                if e > s:
                    spans = merged_spans(begin[s:e], size[s:e])
                    items = sorted({str(x) for p in set(pattern[s:e].tolist()) for x in w.items[p]})
                cols["n_words"].append(len(ids[done + i]))
                cols["n_hit"].append(sum(y - x for x, y in spans))
                cols["n_items"].append(len(items))
                cols["items"].append(hashlib.sha256(",".join(items).encode()).hexdigest())
                cols["spans"].append([{"first": x, "last": y - 1} for x, y in spans])
                if cleaned:
                    text = b.column(n_keep)[i].as_py()
                    cols["clean"].append(without_words(text, spans) if spans else text)
            done += b.num_rows
            arrays = [*b.columns[:n_keep], pa.array(cols["n_words"], pa.int64()), pa.array(cols["n_hit"], pa.int64()),
                      pa.array(cols["n_items"], pa.int64()), pa.array(cols["items"], pa.string()),
                      pa.array([x > 0 for x in cols["n_hit"]], pa.bool_()),
                      pa.array(cols["spans"], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))]
            names = [*keep, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
            if cleaned:
                arrays.append(pa.array(cols["clean"], pa.string()))
                names.append("clean_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    def search(batches):
        w = shared.value
        held, ids, words = [], [], 0
        for b in batches:
            for v in b.column(n_keep):
                found = words_of(v.as_py())
                ids.append(np.fromiter(map(w.ids.get, found, repeat(0)), np.int32, len(found)))
                words += len(found)
            held.append(b if cleaned else b.select(range(n_keep)))
            if words >= SHARD_WORDS:
                yield from judge(w, held, ids)
                held, ids, words = [], [], 0
        if held:
            yield from judge(w, held, ids)

    return docs.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(search, ", ".join(fields))


# ---- a benchmark of several parts ----------------------------------------------------------------

def _pieces(bench: DataFrame, window: int, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(item, piece, text): items cut into pieces of at most ``piece_words`` window starts, so that each window is in one."""
    kind = bench.schema["item"].dataType.simpleString()

    def cut(batches):
        import pyarrow as pa
        for b in batches:
            for i in range(b.num_rows):
                words = words_of(b.column(1)[i].as_py())
                starts = range(0, max(1, len(words) - window + 1) if words else 0, piece_words)
                parts = [b" ".join(words[s:s + piece_words + window - 1]).decode() for s in starts]
                if parts:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i] * len(parts))), pa.array(range(len(parts)), pa.int32()),
                                                      pa.array(parts, pa.string())], names=["item", "piece", "text"])

    return bench.mapInArrow(cut, f"item {kind}, piece int, text string")


def _in_parts(docs: DataFrame, bench: DataFrame, window: int, text_col: str, keep: tuple[str, ...], cleaned: bool, parts: int) -> DataFrame:
    spark = docs.sparkSession
    part = F.pmod(F.xxhash64("item", "piece"), F.lit(parts)).cast("int")
    pieces = written(_pieces(bench, window).withColumn("part", part), "benchmark")
    plain = docs.select(*keep, F.col(text_col).cast("string").alias("_text")).withColumn("_digest", F.sha2("_text", 256))
    n = len(keep)
    found = []
    for k in range(parts):
        mine = [(r["item"], r["text"]) for r in pieces.filter(F.col("part") == k).select("item", "text").collect()]  # of bounded size
        shared = spark.sparkContext.broadcast(Windows(mine, window))

        def search(batches, shared=shared):
            import pyarrow as pa
            w = shared.value

            def hits(digests, ids):
                doc, begin, size, pattern = _shard(ids, w)
                rows = []
                for d in np.unique(doc).tolist():
                    at = doc == d
                    items = sorted({str(x) for q in set(pattern[at].tolist()) for x in w.items[q]})
                    spans = [{"first": x, "last": y - 1} for x, y in merged_spans(begin[at], size[at])]
                    rows.append((digests[d], spans, items))
                return pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                     pa.array([r[2] for r in rows], pa.list_(pa.string()))], names=["_digest", "spans", "items"])

            digests, ids, words = [], [], 0
            for b in batches:
                for text, digest in zip(b.column(0), b.column(1)):
                    these = words_of(text.as_py())
                    ids.append(np.fromiter(map(w.ids.get, these, repeat(0)), np.int32, len(these)))
                    digests.append(digest.as_py())
                    words += len(these)
                if words >= SHARD_WORDS:
                    yield hits(digests, ids)
                    digests, ids, words = [], [], 0
            if ids:
                yield hits(digests, ids)

        out = plain.select("_text", "_digest").mapInArrow(search, "_digest string, spans array<struct<first:int,last:int>>, items array<string>")
        found.append(written(out.dropDuplicates(["_digest"]), "hits"))
        shared.unpersist()
    hits_ = found[0]
    for f in found[1:]:
        hits_ = hits_.unionByName(f)
    hits_ = written(hits_.groupBy("_digest").agg(F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(F.collect_list("items")).alias("_items")), "all-hits")
    discard(pieces, *found)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    fields += ["n_words long", "n_hit long", "n_items long", "items_sha256 string", "contaminated boolean",
               "spans array<struct<first:int,last:int>>"] + ["clean_text string"] * cleaned

    def together(batches):
        import pyarrow as pa
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for text, spans, items in zip(*(b.column(n + i).to_pylist() for i in range(3))):
                begin = np.array([x["first"] for x in spans or []], np.int64)
                size = np.array([x["last"] for x in spans or []], np.int64) - begin + 1
                merged, names = merged_spans(begin, size), sorted(set(items or []))
                hit = sum(y - x for x, y in merged)
                for c, v in zip(cols, (len(words_of(text)), hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0,
                                       [{"first": x, "last": y - 1} for x, y in merged], without_words(text, merged) if merged else text)):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])), pa.string()]
            names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "clean_text"]
            take = 6 + cleaned
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *(pa.array(c, t) for c, t in list(zip(cols, kinds))[:take])], names=[*keep, *names[:take]])

    joined = plain.join(hits_, "_digest", "left").select(*(plain[c] for c in keep), "_text", "_spans", "_items")
    return joined.mapInArrow(together, ", ".join(fields))
