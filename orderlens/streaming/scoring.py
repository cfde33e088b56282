"""Scoring a stream of raw order items with a fitted spec (Structured Streaming).

Nothing in the original is a stream, but every transform here is stateless
once fitted: cleaning uses fitted medians (``CleanParams``), the feature spec
joins *static* fitted tables (stream-static left joins) and fills with fitted
means (``impute='fit'``).  So the same plan that scores a batch scores a
micro-batch, with no state store and no watermark needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as cl
from ..operators import cost as CO
from ..operators import features as FT
from ..sources.scan import NA_VALUES, RAW_SCHEMA, apply_sentinels, parse_dates


def read_raw_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A stream of raw order-item files (fixed schema, as streaming sources require)."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.schema(RAW_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def score_stream(raw_stream: DataFrame, params: cl.CleanParams, spec: FT.FeatureSpec, names: list[str],
                 beta: list[float], means: list[float], stds: list[float], cutoff: float,
                 na_values=NA_VALUES, key: str = "order_item_id") -> DataFrame:
    """Clean -> features by name -> standardised logit score -> hard label, per micro-batch."""
    s = parse_dates(apply_sentinels(raw_stream, na_values))
    cleaned = cl.clean_with(s, params)
    feats = FT.transform(spec, cleaned, names, keep=(key,), impute="fit")
    x = CO.standardized_array(names, means, stds, intercept=len(beta) == len(names) + 1)
    return feats.select(F.col(key), CO.logit_score(x, beta).alias("p")).withColumn(
        "predicted", F.col("p") > F.lit(float(cutoff)))


def run_to_table(scored: DataFrame, path: str, checkpoint: str):
    """Drive the stream over all that is there into a Parquet table; returns the ended query."""
    q = (scored.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", checkpoint).start(path))
    q.awaitTermination()
    return q
