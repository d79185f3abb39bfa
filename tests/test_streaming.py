"""Structured Streaming request scorer equals the batch scorer on the same requests."""

from pyspark.sql import functions as F

from conftest import SF_TINY
from panelcast.plans import catalog as C
from panelcast.streaming import requests_stream as RS


def test_stream_matches_batch(spark, tmp_path):
    fi = C.forecast_inputs(spark, SF_TINY)
    raw = C.generated_requests(fi)
    in_dir, out_dir = str(tmp_path / "in"), str(tmp_path / "out")
    raw.select("value").repartition(3).write.text(in_dir)
    q = RS.start_scoring(spark, in_dir, out_dir, C.stream_scorer(spark, SF_TINY),
                         checkpoint=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(900)
    assert q.exception() is None
    got = spark.read.parquet(out_dir).drop("batch_id")
    want = C.score_request_table(fi, raw.select(F.sha2("value", 256).alias("request_id"), "value"))
    cols = sorted(want.columns)
    g = got.select(*cols).select(F.to_json(F.struct(*cols)).alias("j"))
    w = want.select(*cols).select(F.to_json(F.struct(*cols)).alias("j"))
    assert g.count() == w.count() == raw.count()
    assert g.exceptAll(w).count() == 0 and w.exceptAll(g).count() == 0
