"""Shared helpers: tables, written intermediates, Arrow buffers, blocks of hot groups, components."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where it is unset (tests) the library's own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    from ..session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark)


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: no recomputation, lineage cut."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more: what was made of them is written, too."""
    for t in tables:
        spark = t.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.written_to)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release() -> None:
    """Let Spark drop the shuffle files of steps that are done: their frames are garbage."""
    import gc

    from pyspark import SparkContext
    gc.collect()
    SparkContext._active_spark_context._jvm.System.gc()


def shared_bytes(spark: SparkSession, name: str, data: bytes) -> str:
    """Write ``data`` to a file of the shared folder through Spark's file system; return its path."""
    path = shared_path(spark, name)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        for i in range(0, len(data), 1 << 24):
            out.write(bytearray(data[i:i + (1 << 24)]))
    finally:
        out.close()
    return path


def utf8_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow string or binary column as (bytes, offsets); a null is empty."""
    import pyarrow as pa
    col = column.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    if not len(off):
        off = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def in_blocks(members: DataFrame, keys: list[str], by: str, block_rows: int) -> DataFrame:
    """Members of each group of ``keys`` dealt to blocks of about ``block_rows`` rows, so that no
    group has to fit in one task.

    Adds ``block`` (the shard a row goes to), ``home`` (the block that indexes the row) and ``own``
    (whether this is it).  A group of one block gets each row once.  A group of n blocks gets each
    row n times: once to be indexed, n - 1 times to be looked up.  Every pair of a group meets in
    some block.  Groups of one row are left out.
    """
    sized = members.groupBy(*keys).agg(F.count("*").alias("_n"))
    sized = sized.filter(F.col("_n") > 1)
    out = members.join(sized, keys)
    blocks = F.ceil(F.col("_n") / F.lit(block_rows)).cast("int")
    return (out.withColumn("home", F.pmod(F.xxhash64(by), blocks).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("own", F.col("home") == F.col("block"))
            .drop("_n"))


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links a-b: the smallest node of each one's component (pointer jumping)."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        low, high = np.minimum(la, lb)[open_], np.maximum(la, lb)[open_]
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): component is the smallest node reachable.

    Alternating large-star and small-star rounds: each round links a node's neighbours to the
    smallest of them.  Neighbourhoods are never gathered: the smallest is a partial aggregate, and
    the join of links with it can be split when a node is hot.  Every round is written to the
    shared folder, so a lost executor repeats one round only.
    """
    links = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .filter("u <> v").distinct(), "links")

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = state(links)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        before, large = links, written(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = state(links)
        discard(before, large)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
