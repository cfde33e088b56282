"""Repeated byte strings removed by a distributed, common-prefix-aware merge sort of suffixes.

A byte goes if a string of ``size`` bytes that covers it also starts anywhere else.  Suffixes are
sorted in runs, front-coded, exchanged by range, and merged by loser trees that carry each
candidate's common prefix with the last output, so a known prefix is never compared again.  A
suffix's longest common prefix with its neighbours in the merged order says how far it repeats.

Only suffixes that can matter are sorted, as in the duplicate detection of distributed string
sorting (hashes only leave out; every byte that goes was compared by the merge):

1. Equal texts (by SHA-256) are one text, with a number of its own; a text of ``size`` bytes or more that occurs twice goes whole.
2. Each window of ``size`` bytes belongs to a cell: its leftmost minimal k-mer, and the window's
   distance to it in steps of ``CELL``.  Equal windows lie in equal cells, and all windows of a cell
   share a core of at least ``size - CELL + 1`` bytes; a cell whose core is nowhere else is left out.
3. A cell left over gives the suffix at its first window, long enough for its last one.
4. Where cells with one core differ around it, a repeat may begin inside a cell: at windows that
   occur after different predecessors.  These windows' suffixes are sorted as well.

A run keeps equal suffixes once, so a passage that a third of the documents share costs a range one
entry a run.  Every step is written to the shared folder.

Defined results: a null text is empty; texts shorter than ``size`` lose nothing; rows repeated whole
are copies of each other; matches never cross documents; texts of any length are cut whole; tied and null ids give a row each; an empty
table gives no rows; only the named columns are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, release, written

SIZE, KMER, CELL = 400, 16, 64
#: Bytes of distinct suffixes in a run, and what a range of the merge holds on average.
RUN_BYTES = 24_000_000
RANGE_BYTES = 24_000_000
#: Splitters are taken from at most about so many sampled suffixes, and are cut to so many bytes: two
#: suffixes with a longer common prefix are never parted.
SAMPLES, SPLITTER = 100_000, 64

RUN_FIELDS = ("run long, entries int, bytes long, block binary, samples array<binary>, cores binary, fulls binary, "
              "m_entry binary, m_text binary, m_bytes binary, m_at binary")


# ---- hashes of byte strings ----------------------------------------------------------------------

class Powers:
    """Powers of an odd number modulo 2**64, and of its inverse, as far as needed."""

    def __init__(self):
        self.base = 0x9E3779B97F4A7C15
        self.bytes = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                steps = np.full(n + 1, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_POWERS = Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    _POWERS.to(len(raw))
    h = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_POWERS.bytes[raw] * _POWERS.up[:len(raw)], out=h[1:])
    return h


def span_hash(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of bytes [begin, end), the same wherever they stand."""
    return _mix((h[end] - h[begin]) * _POWERS.down[begin] + (end - begin).astype(np.uint64))


def anchors(h: np.ndarray, size: int, kmer: int = KMER) -> np.ndarray:
    """For each window of ``size`` bytes: where its leftmost k-mer of minimal hash starts."""
    n_kmers = len(h) - kmer
    at = np.arange(n_kmers)
    low = np.uint64(31)  # the hash's high bits, then the position
    key = (span_hash(h, at, at + kmer) >> low << low) | at.astype(np.uint64)
    w = size - kmer + 1
    padded = np.full(-(-n_kmers // w) * w, np.uint64(2**64 - 1))
    padded[:n_kmers] = key
    rows = padded.reshape(-1, w)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n_kmers - w + 1
    return (np.minimum(after[:windows], before[w - 1:w - 1 + windows]) & np.uint64((1 << 31) - 1)).astype(np.int64)


def cells(raw: np.ndarray, size: int, cell: int = CELL, kmer: int = KMER):
    """(core hash, first window, last window, prefix hashes) of each cell of a text."""
    h = prefix_hash(raw)
    anchor = anchors(h, size, kmer)
    step = (anchor - np.arange(len(anchor))) // cell
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (step[1:] != step[:-1])) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(anchor)]]) - 1
    begin = anchor[first] - step[first] * cell  # the cell's last possible window starts here
    return span_hash(h, begin, begin - cell + 1 + size), first, last, h


# ---- runs and merging ----------------------------------------------------------------------------

def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix of a and b, of which ``at`` bytes are known."""
    while a[at:at + 16] == b[at:at + 16]:
        at += 16
        if at >= len(a) or at >= len(b):
            return min(len(a), len(b))
    n = min(len(a), len(b))
    while at < n and a[at] == b[at]:
        at += 1
    return at


def front_code(strings: list[bytes]) -> bytes:
    """Sorted distinct strings: each as what it shares with the one before, and its other bytes."""
    import zstandard
    out, last = [], b""
    for s in strings:
        n = common(last, s)
        out.append(struct.pack("<II", n, len(s) - n))
        out.append(s[n:])
        last = s
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def front_decoded(block: bytes):
    """Yield (common prefix with the string before, string)."""
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(block)
    at, last, unpack = 0, b"", struct.Struct("<II").unpack_from
    while at < len(raw):
        n, m = unpack(raw, at)
        at += 8 + m
        last = last[:n] + raw[at - m:at]
        yield n, last


def merge(streams: list):
    """Merge sorted streams of (common prefix with the stream's last string, string).

    Yields (stream, common prefix with the last output, string).  A loser tree in which each
    candidate knows its common prefix with the last output: the longer one is smaller, and only
    equal ones compare bytes, from there on."""
    k = 1 << max(0, len(streams) - 1).bit_length()
    nexts = [iter(s).__next__ for s in streams]
    strings: list = [None] * k
    known = [0] * k

    def advance(i: int) -> None:
        try:
            known[i], strings[i] = nexts[i]()
        except StopIteration:
            known[i], strings[i] = -1, None

    def loses(a: int, b: int) -> bool:
        """Whether a is the larger; the loser's known prefix becomes that with the winner."""
        ka, kb = known[a], known[b]
        if ka != kb:
            return ka < kb
        if ka < 0:
            return a > b
        x, y = strings[a], strings[b]
        n = common(x, y, ka)
        lost = (a > b) if n == len(x) == len(y) else x[n:n + 1] > y[n:n + 1]
        known[a if lost else b] = n
        return lost

    for i in range(k):
        if i < len(streams):
            advance(i)
            known[i] = min(known[i], 0)
        else:
            known[i] = -1
    losers = [0] * k
    winners = list(range(k))
    node = k
    while node > 1:  # play the first round, level by level
        level = []
        for j in range(0, node, 2):
            a, b = winners[j], winners[j + 1]
            lost = loses(a, b)
            losers[(node + j) // 2] = a if lost else b
            level.append(b if lost else a)
        winners, node = level, node // 2
    win = winners[0]
    while known[win] >= 0:
        yield win, known[win], strings[win]
        advance(win)
        node = (win + k) // 2
        while node:
            if loses(win, losers[node]):
                win, losers[node] = losers[node], win
            node //= 2


def merged_lengths(blocks: list[tuple[bytes, np.ndarray]]) -> list[np.ndarray]:
    """For each run's block (front-coded strings, whether each occurs more than once in its run):
    every string's longest common prefix with any other suffix of the range."""
    out = [np.zeros(len(many), np.int32) for _, many in blocks]
    place = [0] * len(blocks)
    last = None
    for s, n, string in merge([front_decoded(b) for b, _ in blocks]):
        i = place[s]
        place[s] += 1
        if last is not None and n > out[last[0]][last[1]]:
            out[last[0]][last[1]] = n
        out[s][i] = len(string) if blocks[s][1][i] else n
        last = (s, i)
    return out


class Run:
    """Suffixes of a run: equal ones once, each with the places (text, its bytes, position) that have it."""

    def __init__(self):
        self.entries: dict[bytes, list] = {}
        self.bytes = 0

    def add(self, suffix: bytes, place: tuple, core: int = 0, full: int = 0) -> None:
        found = self.entries.get(suffix)
        if found is None:
            self.entries[suffix] = [core, full, place]
            self.bytes += len(suffix)
        else:
            found.append(place)

    def row(self, run: int) -> dict:
        strings = sorted(self.entries)
        step = max(1, len(strings) // 64)
        kept = [self.entries[s] for s in strings]
        places = [(i, *p) for i, e in enumerate(kept) for p in e[2:]]
        column = lambda i, kind: np.array([p[i] for p in places], kind).tobytes()
        return {"run": run, "entries": len(strings), "bytes": self.bytes, "block": front_code(strings),
                "samples": [s[:SPLITTER] for s in strings[step // 2::step]],
                "cores": np.array([e[0] for e in kept], np.int64).tobytes(),
                "fulls": np.array([e[1] for e in kept], np.int64).tobytes(),
                "m_entry": column(0, np.int32), "m_text": column(1, np.int64), "m_bytes": column(2, np.int32), "m_at": column(3, np.int32)}


def _run_numbers(kind: int):
    """Numbers of a task's runs, different for all tasks and both kinds of runs."""
    from pyspark import TaskContext
    context = TaskContext.get()
    n = ((context.partitionId() << 16) << 1) + kind
    while True:
        yield n
        n += 2


def _rows(batch, at_once: int = 256):
    """Rows of a batch as dicts, a few at a time."""
    for i in range(0, batch.num_rows, at_once):
        yield from batch.slice(i, at_once).to_pylist()


def _batch(rows: list[dict], schema):
    import pyarrow as pa
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(spark, ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


# ---- the steps -----------------------------------------------------------------------------------

def _packed(docs: DataFrame, keep: list[str], min_bytes: int = 0) -> DataFrame:
    """``keep`` columns (first of ``docs``), and of the last column, a text: ``digest`` (its SHA-256),
    ``bytes`` (its length) and ``z`` (the text, compressed, as it is shuffled)."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    n = len(keep)

    def pack(batches):
        import pyarrow as pa
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            column = b.column(n)
            texts = [(v.as_py() or "").encode() for v in column]
            at = [i for i, t in enumerate(texts) if len(t) >= min_bytes]
            kept = b.select(range(n)) if len(at) == len(texts) else b.select(range(n)).take(pa.array(at, pa.int64()))
            arrays = [*kept.columns, pa.array([hashlib.sha256(texts[i]).digest() for i in at], pa.binary()),
                      pa.array([len(texts[i]) for i in at], pa.int32()), pa.array([squeeze(texts[i]) for i in at], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "digest", "bytes", "z"])

    return docs.mapInArrow(pack, ", ".join([*fields, "digest binary", "bytes int", "z binary"]))


def _cells(texts: DataFrame, size: int) -> DataFrame:
    """(core, text, bytes, first, last) of every cell."""
    def of(batches):
        import pyarrow as pa
        import zstandard
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            names = b.schema.names
            held, n = [], 0
            for text, size_, z in zip(*(b.column(names.index(c)).to_pylist() for c in ("text", "bytes", "z"))):
                core, first, last, _ = cells(np.frombuffer(expand(z), np.uint8), size)
                held.append((core.view(np.int64), np.full(len(core), text), np.full(len(core), size_, np.int32),
                             first.astype(np.int32), last.astype(np.int32)))
                n += len(core)
                if n >= 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=["core", "text", "bytes", "first", "last"])
                    held, n = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=["core", "text", "bytes", "first", "last"])

    return texts.select("text", "bytes", "z").mapInArrow(of, "core long, text long, bytes int, first int, last int")


def _first_runs(picked: DataFrame, size: int, run_bytes: int) -> DataFrame:
    """Runs of the suffixes at the first windows of the picked cells (rows: text, bytes, z, picked)."""
    schema = _arrow(picked.sparkSession, RUN_FIELDS)

    def sort(batches):
        import zstandard
        expand = zstandard.ZstdDecompressor().decompress
        numbers, run = _run_numbers(0), Run()
        for b in batches:
            for r in _rows(b):
                raw = expand(r["z"])
                h = prefix_hash(np.frombuffer(raw, np.uint8))
                mine = r["picked"]
                first = np.array([p["first"] for p in mine])
                last = np.array([p["last"] for p in mine])
                full = span_hash(h, first, last + size).view(np.int64).tolist()
                for p, f, s, e in zip(mine, full, first.tolist(), last.tolist()):
                    run.add(raw[s:e + size], (r["text"], r["bytes"], s), p["core"], f)
                if run.bytes >= run_bytes:
                    yield _batch([run.row(next(numbers))], schema)
                    run = Run()
        if run.entries:
            yield _batch([run.row(next(numbers))], schema)

    return picked.select("text", "bytes", "z", "picked").mapInArrow(sort, RUN_FIELDS)


def _windows(runs: DataFrame, size: int) -> DataFrame:
    """(hash, before, run, entry, at) of the windows of chosen entries (rows: run, block, chosen):
    ``before`` tells the window one byte earlier, or the entry where there is none."""
    def of(batches):
        import pyarrow as pa
        for b in batches:
            for r in _rows(b, 1):
                chosen, cols = set(r["chosen"]), [[], [], [], []]
                for i, (_, s) in enumerate(front_decoded(r["block"])):
                    if i not in chosen:
                        continue
                    at = np.arange(len(s) - size + 1)
                    h = span_hash(prefix_hash(np.frombuffer(s, np.uint8)), at, at + size)
                    start = _mix(np.array([r["run"] * 2_000_003 + i], np.int64).view(np.uint64) + np.uint64(0x5851F42D4C957F2D))
                    for c, x in zip(cols, (h, np.concatenate([start, h[:-1]]), np.full(len(at), i, np.int32), at.astype(np.int16))):
                        c.append(x)
                if cols[0]:
                    h, before, entry, at = map(np.concatenate, cols)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(before.view(np.int64)),
                                                      pa.array(np.full(len(h), r["run"])), pa.array(entry), pa.array(at)],
                                                     names=["hash", "before", "run", "entry", "at"])

    return runs.mapInArrow(of, "hash long, before long, run long, entry int, at short")


def _second_runs(runs: DataFrame, run_bytes: int) -> DataFrame:
    """Runs of the suffixes inside entries (rows: a run and ``inner``, an array of (entry, at))."""
    schema = _arrow(runs.sparkSession, RUN_FIELDS)

    def sort(batches):
        numbers, run = _run_numbers(1), Run()
        for b in batches:
            for r in _rows(b, 1):
                wanted: dict[int, list[int]] = {}
                for x in r["inner"]:
                    wanted.setdefault(x["entry"], []).append(x["at"])
                entry = np.frombuffer(r["m_entry"], np.int32)
                text, size_, pos = (np.frombuffer(r[c], k) for c, k in (("m_text", np.int64), ("m_bytes", np.int32), ("m_at", np.int32)))
                for i, (_, s) in enumerate(front_decoded(r["block"])):
                    if i in wanted:
                        m = int(np.searchsorted(entry, i))  # any of its places: more than one are settled already
                        for at in wanted[i]:
                            run.add(s[at:], (int(text[m]), int(size_[m]), int(pos[m]) + at))
                if run.bytes >= run_bytes:
                    yield _batch([run.row(next(numbers))], schema)
                    run = Run()
        if run.entries:
            yield _batch([run.row(next(numbers))], schema)

    return runs.mapInArrow(sort, RUN_FIELDS)


def _inner_suffixes(runs: DataFrame, size: int, run_bytes: int) -> DataFrame:
    """Step 4: runs of the windows, inside cells whose core occurs in different surroundings, at which
    a repeat may begin."""
    def entries(batches):
        import pyarrow as pa
        for b in batches:
            for run, cores, fulls in zip(*(b.column(i).to_pylist() for i in range(3))):
                core, full = np.frombuffer(cores, np.int64), np.frombuffer(fulls, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(full), pa.array(np.full(len(core), run)),
                                                  pa.array(np.arange(len(core), dtype=np.int32))], names=["core", "full", "run", "entry"])

    known = runs.select("run", "cores", "fulls").mapInArrow(entries, "core long, full long, run long, entry int")
    # one entry stands for those with equal bytes
    kinds = known.groupBy("core", "full").agg(F.min(F.struct("run", "entry")).alias("one"))
    mixed = known.groupBy("core").agg(F.min("full").alias("a"), F.max("full").alias("b")).filter("a <> b").select("core")
    chosen = (kinds.join(mixed, "core", "left_semi").select("one.run", "one.entry")
              .groupBy("run").agg(F.collect_list("entry").alias("chosen")))
    seen = written(_windows(runs.select("run", "block").join(chosen, "run"), size), "windows")
    begins = seen.groupBy("hash").agg(F.min("before").alias("a"), F.max("before").alias("b")).filter("a <> b").select("hash")
    inner = (seen.filter("at > 0").select("hash", "run", "entry", "at").join(begins, "hash", "left_semi")
             .groupBy("run").agg(F.collect_list(F.struct("entry", "at")).alias("inner")))
    out = written(_second_runs(runs.select("run", "block", "m_entry", "m_text", "m_bytes", "m_at").join(inner, "run"), run_bytes), "second-runs")
    discard(seen)
    return out


def _splitters(runs: DataFrame, range_bytes: int) -> list[bytes]:
    """Cuts of the suffix order into ranges of about ``range_bytes``, from sampled suffixes."""
    total = runs.agg(F.sum("bytes"), F.sum(F.size("samples"))).first()
    ranges = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(total[0] or 0) // range_bytes))
    share = min(1.0, SAMPLES / max(1, total[1] or 0))
    sample = runs.select(F.explode("samples").alias("s")).filter(F.abs(F.xxhash64("s") % 1_000_000) < share * 1_000_000)
    found = sorted(bytes(r.s) for r in sample.collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def _ranges(runs: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Each run cut at the splitters: (range, run, start, block, many)."""
    cuts = runs.sparkSession.sparkContext.broadcast(splitters)
    fields = "range int, run long, start int, block binary, many binary"
    schema = _arrow(runs.sparkSession, fields)

    def cut(batches):
        from bisect import bisect_right
        for b in batches:
            for run, block, m_entry, n in zip(*(b.column(i).to_pylist() for i in range(4))):
                many = np.bincount(np.frombuffer(m_entry, np.int32), minlength=n) > 1
                strings = [s for _, s in front_decoded(block)]
                at = np.array([bisect_right(cuts.value, s) for s in strings])
                bounds = np.flatnonzero(np.diff(at, prepend=-1, append=-1)).tolist()
                rows = [{"range": int(at[s]), "run": run, "start": s, "block": front_code(strings[s:e]), "many": many[s:e].tobytes()}
                        for s, e in zip(bounds, bounds[1:])]
                if rows:
                    yield _batch(rows, schema)

    return runs.select("run", "block", "m_entry", "entries").mapInArrow(cut, fields)


def _merged(ranges: DataFrame, n_ranges: int) -> DataFrame:
    """(run, start, lengths) of every block, after each range's merge."""
    fields = "run long, start int, lengths binary"
    schema = _arrow(ranges.sparkSession, fields)

    def together(batches):
        held: list[dict] = []

        def done():
            found = merged_lengths([(r["block"], np.frombuffer(r["many"], bool)) for r in held])
            return _batch([{"run": r["run"], "start": r["start"], "lengths": x.tobytes()} for r, x in zip(held, found)], schema)

        for b in batches:
            for r in b.to_pylist():
                if held and held[-1]["range"] != r["range"]:
                    yield done()
                    held = []
                held.append(r)
        if held:
            yield done()

    return ranges.repartition(n_ranges, "range").sortWithinPartitions("range", "run", "start").mapInArrow(together, fields)


def _found_spans(runs: DataFrame, merged: DataFrame, size: int) -> DataFrame:
    """(text, bytes, begin, end) of the strings of ``size`` bytes or more that repeat."""
    def of(batches):
        import pyarrow as pa
        for b in batches:
            for r in _rows(b, 1):
                length = np.zeros(r["entries"], np.int32)
                for part in r["parts"]:
                    x = np.frombuffer(part["lengths"], np.int32)
                    length[part["start"]:part["start"] + len(x)] = x
                mine = length[np.frombuffer(r["m_entry"], np.int32)]
                hit = mine >= size
                if not hit.any():
                    continue
                at = np.frombuffer(r["m_at"], np.int32)[hit]
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r["m_text"], np.int64)[hit]), pa.array(np.frombuffer(r["m_bytes"], np.int32)[hit]),
                                                  pa.array(at), pa.array(at + mine[hit])], names=["text", "bytes", "begin", "end"])

    parts = merged.groupBy("run").agg(F.collect_list(F.struct("start", "lengths")).alias("parts"))
    return (runs.select("run", "entries", "m_entry", "m_text", "m_bytes", "m_at").join(parts, "run")
            .mapInArrow(of, "text long, bytes int, begin int, end int"))


def repeated_spans(docs: DataFrame, size: int = SIZE, run_bytes: int = RUN_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(digest, copies, spans) of the texts (last column of ``docs``) that lose something; ``spans`` is an
    array of (begin, end) that may overlap, and null where the whole text goes as a copy."""
    if size < CELL + 2 * KMER:
        raise ValueError(f"size must be at least {CELL + 2 * KMER}")
    texts = written(_packed(docs, [], size).groupBy("digest", "bytes")
                    .agg(F.count("*").alias("copies"), F.first("z").alias("z"))
                    .withColumn("text", F.monotonically_increasing_id()), "texts")  # written, so the numbers stay
    names = written(texts.select("text", "digest"), "names")
    release()
    cores = written(_cells(texts, size).groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core"), "cores")
    release()
    picked = written(_cells(texts, size).join(cores, "core")
                     .groupBy("text", "bytes").agg(F.collect_list(F.struct("core", "first", "last")).alias("picked")), "picked")
    discard(cores)
    release()
    first = written(_first_runs(texts.select("text", "bytes", "z").join(picked, ["text", "bytes"]), size, run_bytes), "first-runs")
    discard(picked)
    whole = written(texts.filter("copies > 1").select("text", "bytes", "copies"), "whole")
    discard(texts)
    release()
    second = _inner_suffixes(first, size, run_bytes)
    release()
    runs = first.unionByName(second)
    splitters = _splitters(runs, range_bytes)
    merged = written(_merged(_ranges(runs, splitters), len(splitters) + 1), "merged")
    release()
    spans = _found_spans(runs, merged, size).groupBy("text", "bytes").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    out = whole.join(spans, ["text", "bytes"], "full_outer")
    out = written(out.join(names, "text").select("digest", F.coalesce("copies", F.lit(1)).alias("copies"),
                                                 F.when(F.col("copies") > 1, None).otherwise(F.col("spans")).alias("spans")), "spans")
    discard(first, second, merged, whole, names)
    release()
    return out


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [(b, e) for b, e in out]


def remove_repeats(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = SIZE,
                   kept_text: bool = False, run_bytes: int = RUN_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``keep`` columns, ``n_bytes, n_removed, n_spans, kept_sha256`` and, with ``kept_text``, ``kept`` (the
    remaining bytes as text; a character that was cut goes) of every row."""
    source = docs.select(*keep, docs[text_col].cast("string").alias("_text"))
    found = repeated_spans(source.select("_text"), size, run_bytes, range_bytes)
    rows = _packed(source, list(keep)).join(found, "digest", "left")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema.fields]
    fields += ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"] + ["kept string"] * kept_text
    n = len(keep)

    def cut(batches):
        import pyarrow as pa
        import zstandard
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            sizes, gone, counts, sums, texts = [], [], [], [], []
            for z, copies, found_ in zip(*(b.column(n + i).to_pylist() for i in range(3))):
                raw = expand(z) if z else b""
                if copies and copies > 1:
                    spans = [(0, len(raw))]
                else:
                    spans = united([(s["begin"], s["end"]) for s in found_ or []])
                pieces, at = [], 0
                for s, e in spans:
                    pieces.append(raw[at:s])
                    at = e
                left = b"".join([*pieces, raw[at:]])
                sizes.append(len(raw))
                gone.append(len(raw) - len(left))
                counts.append(len(spans))
                sums.append(hashlib.sha256(left).hexdigest())
                if kept_text:
                    texts.append(left.decode("utf-8", "ignore"))
            arrays = [*b.columns[:n], *(pa.array(x, pa.int64()) for x in (sizes, gone, counts)), pa.array(sums, pa.string())]
            if kept_text:
                arrays.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * kept_text)

    return rows.select(*keep, "z", "copies", "spans").mapInArrow(cut, ", ".join(fields))
