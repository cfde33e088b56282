"""A fitted spec scores a stream of raw files exactly like the same rows in batch."""

import os
import uuid

from pyspark.sql import functions as F

from orderlens.operators import clean as cl
from orderlens.operators import cost as CO
from orderlens.operators import features as FT
from orderlens.session import scratch_path
from orderlens.sources import adapter
from orderlens.streaming import scoring

SF = "/root/testdata/sf0.001"
NAMES = ["item_price", "days_to_delivery", "order_total_value/state_mean_delivery", "woe_item_color"]


def test_stream_matches_batch(spark):
    raw = adapter.order_items(spark, SF)
    known, unknown = cl.clean_split(raw)
    spec = FT.fit(cl.history(known, unknown))
    params = cl.fit_medians(cl.apply_sentinels(raw.filter(F.col("return").isNull())))
    feats = FT.transform(spec, known, NAMES, keep=(), impute="fit")
    means, stds = CO.standardize_params(feats, NAMES)
    beta = [-0.2, 0.3, -0.1, 0.2, 0.4]

    src = scratch_path(spark, f"stream-src-{uuid.uuid4().hex}")
    unl = raw.filter(F.col("return").isNull())
    unl.write.parquet(src)
    stream = scoring.read_raw_stream(spark, src, schema=unl.schema)
    scored = scoring.score_stream(stream, params, spec, NAMES, beta, means, stds, 0.5)
    table = scratch_path(spark, f"scored-{uuid.uuid4().hex}")
    scoring.run_to_table(scored, table, scratch_path(spark, f"stream-ckpt-{uuid.uuid4().hex}"))
    got = {r["order_item_id"]: r["p"] for r in spark.read.parquet(table).collect()}

    batch = scoring.score_stream(spark.read.parquet(src), params, spec, NAMES, beta, means, stds, 0.5)
    want = {r["order_item_id"]: r["p"] for r in batch.collect()}
    assert len(got) == len(want) == unl.count()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert os.path.basename(src)
