"""Streaming parity: windowed jobs run as a stream (AvailableNow) give exactly the batch rows of the windows that the
watermark has closed."""

import datetime as dt

from pyspark.sql import functions as F

from bazaar.sources.tables import read_table
from bazaar.streaming import monitors as S

from .conftest import SF001


def test_request_metrics_stream_matches_batch(spark, tmp_path):
    stream = S.request_metrics(S.events_stream(spark, SF001))
    got = S.run_available_now(stream, "t_metrics", sink_dir=str(tmp_path / "m"))
    batch = S.request_metrics(read_table(spark, SF001, "events"))
    max_ts = read_table(spark, SF001, "events").agg(F.max("ts")).first()[0]
    closed = batch.where(F.col("window_start") + F.expr("INTERVAL 5 MINUTES") <= F.lit(max_ts - dt.timedelta(minutes=1)))
    g = sorted(tuple(r) for r in got.select("window_start", "event_type", "requests", "errors").collect())
    b = sorted(tuple(r) for r in closed.select("window_start", "event_type", "requests", "errors").collect())
    assert len(g) > 0 and g == b  # exactly the windows that the watermark has closed


def test_window_counts_stream_matches_batch(spark, tmp_path):
    from bazaar.operators import drift as D

    got = S.run_available_now(D.window_counts(S.events_stream(spark, SF001)), "t_drift", sink_dir=str(tmp_path / "d"))
    batch = D.window_counts(read_table(spark, SF001, "events"))
    max_ts = read_table(spark, SF001, "events").agg(F.max("ts")).first()[0]
    closed = batch.where(F.col("window_start") + F.expr("INTERVAL 1 DAY") <= F.lit(max_ts - dt.timedelta(hours=1)))
    cols = ["window_start", "event_type", "n", "le_0", "le_9"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, closed.select(*cols).collect()))


def test_prediction_log_stream(spark, tmp_path):
    from bazaar.operators.experiments import prediction_log

    got = S.run_available_now(prediction_log(S.events_stream(spark, SF001)), "t_preds", sink_dir=str(tmp_path / "p"))
    want = prediction_log(read_table(spark, SF001, "events"))
    assert got.count() == want.count()
    assert got.select("model_version").distinct().count() == 2
