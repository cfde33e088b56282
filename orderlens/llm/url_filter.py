"""URL rules looked up in a sorted array of 64-bit xxhash keys: memory-mapped on the workers, probed
with vectorised binary search, and each hit confirmed against the stored rule string.

A rule is a host and a path (``example.org/es/``) with an action.  It fits its host and all
subdomains, if the url's path starts with the rule's path; the longest fitting rule wins.  A url
that no rule fits gets the default verdict.

Defined results: a null url or one without ``://`` has an empty host and path and fits no rule;
repeated rules count once (the later action wins); no rules, no hits; rows repeated whole, and tied or null ids, are
judged each; urls of any length are read whole; rules of equal length cannot tie, as a url has one prefix of each
length; an empty table gives no rows; only the named columns are read, so other columns may have any names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules up to this count are one array a worker maps (8 bytes a key and the strings); beyond it they
#: are joined on the key instead.
MAX_ARRAY_RULES = 20_000_000


def host_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every string a rule that fits could have: each suffix of the host's labels, followed by each
    prefix of the path that is as long as some rule's path.  Longest first."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.lit(n) for n in sorted(set(lengths), reverse=True)]),
                        lambda n: n <= F.length(path))
    found = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))
    return F.when(host != "", found).otherwise(F.array().cast("array<string>"))


def _pack(rules: list[tuple[str, str]]) -> np.ndarray:
    """Rules as one byte array: count, sorted keys, offsets, then "action TAB rule" strings."""
    import xxhash
    rows = sorted((int(np.uint64(xxhash.xxh64_intdigest(r.encode(), seed=42)).astype(np.int64)), r, a) for r, a in rules)
    blobs = [f"{a}\t{r}".encode() for _, r, a in rows]
    head = np.array([len(rows)], np.int64)
    keys = np.array([k for k, _, _ in rows], np.int64)
    offsets = np.cumsum([0, *map(len, blobs)], dtype=np.int64)
    return np.concatenate([x.view(np.uint8) for x in (head, keys, offsets)] + [np.frombuffer(b"".join(blobs), np.uint8)])


class RuleArray:
    """The packed rules of a file, memory-mapped."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view(np.int64)[0])
        self.keys = raw[8:8 + 8 * n].view(np.int64)
        self.offsets = raw[8 + 8 * n:16 + 16 * n].view(np.int64)
        self.blob = raw[16 + 16 * n:]

    def probe(self, keys: np.ndarray, strings) -> list[tuple[int, str, str]]:
        """(index of the probe, action, rule) of each key that is stored with that very string."""
        lo = np.searchsorted(self.keys, keys, "left")
        hi = np.searchsorted(self.keys, keys, "right")
        out = []
        for i in np.flatnonzero(hi > lo):
            want = strings[i].as_py()
            for j in range(lo[i], hi[i]):  # equal keys lie side by side: a collision is told apart here
                action, _, rule = self.blob[self.offsets[j]:self.offsets[j + 1]].tobytes().decode().partition("\t")
                if rule == want:
                    out.append((int(i), action, rule))
        return out


def filter_urls(df: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", default: str = "allow",
                keep: tuple[str, ...] = (), max_array_rules: int = MAX_ARRAY_RULES) -> DataFrame:
    """``keep`` columns and ``host, path, rule, verdict`` for every row of ``df``.

    ``rules``: (rule, action) pairs.  The candidate strings and their keys are made by Spark
    expressions; the workers only probe.
    """
    spark = df.sparkSession
    actions = dict(rules)
    url = F.col(url_col).cast("string")
    base = df.select(*[F.col(c) for c in keep], host_of(url).alias("host"), path_of(url).alias("path"))
    if not actions:
        return base.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    lengths = sorted({len(r) - (r.find("/") if "/" in r else len(r)) for r in actions})
    cand = candidates(F.col("host"), F.col("path"), lengths)
    probes = base.withColumn("_cand", cand).withColumn("_key", F.transform("_cand", lambda c: F.xxhash64(c)))
    if len(actions) > max_array_rules:
        return _joined(probes, actions, default, keep)
    file = shared_bytes(spark, "url-rules", _pack(list(actions.items())).tobytes())
    spark.sparkContext.addFile(file)
    name = file.rsplit("/", 1)[1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields) + ", rule string, verdict string"
    wide = [*keep, "host", "path"]

    def probe(batches):
        import pyarrow as pa
        from pyspark import SparkFiles
        array = RuleArray(SparkFiles.get(name))
        for b in batches:
            lists = b.column(b.schema.get_field_index("_cand"))
            keys = b.column(b.schema.get_field_index("_key")).flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), np.diff(np.asarray(lists.offsets)))
            rule, verdict = [None] * b.num_rows, [default] * b.num_rows
            for i, action, r in array.probe(keys, lists.flatten()):
                at = row[i]
                if rule[at] is None or len(r) > len(rule[at]):
                    rule[at], verdict[at] = r, action
            cols = [b.column(b.schema.get_field_index(c)) for c in wide]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=[*wide, "rule", "verdict"])

    return probes.mapInArrow(probe, schema)


def _joined(probes: DataFrame, actions: dict[str, str], default: str, keep: tuple[str, ...]) -> DataFrame:
    """The same by a join on the candidate string: for rule sets too large for a worker."""
    rules = probes.sparkSession.createDataFrame(list(actions.items()), "rule string, verdict string")
    hits = (probes.select("host", "path", "_cand").distinct()
            .select("host", "path", F.explode("_cand").alias("rule")).join(rules, "rule")
            .groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.length("rule")).alias("hit")))
    return probes.join(hits, ["host", "path"], "left").select(
        *[F.col(c) for c in keep], "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
