"""Count-triggered monitors as streams: the batch form's groups, restarts, a missing baseline, replayed batches."""

import pytest
from pyspark.sql import functions as F

from bazaar.streaming import buffers as B

SCHEMA = "model string, id long, x double, y double"


def _rows(start, n, model="m"):
    return [(model, i, None if i % 7 == 0 else float(i % 13), float(i % 3)) for i in range(start, start + n)]


class Feed:
    """A folder that files of rows are put into, read as a stream one file a micro-batch."""

    def __init__(self, spark, base):
        self.spark, self.base, self.files = spark, str(base), 0

    def put(self, rows):
        self.files += 1
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.base}/in")

    def run(self, df):
        q = (df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{self.base}/ck")
             .option("path", f"{self.base}/out").trigger(availableNow=True).start())
        q.awaitTermination()
        return self.spark.read.parquet(f"{self.base}/out")


EDGES = [2.0, 5.0, 9.0]
VECTOR = lambda: B.drift_vector(["x", "y"], EDGES)


def _sums(df):
    return sorted((r["model"], r["flush"], r["n"], list(r["first"]), list(r["sums"])) for r in df.collect())


@pytest.mark.parametrize("n, rows, every, ends", [(0, 250, 100, [100, 200]), (99, 1, 100, [1]), (230, 5, 100, [1]), (0, 99, 100, []), (150, 150, 100, [1, 101])])
def test_segments(n, rows, every, ends):
    assert B.flush_segments(n, rows, every) == ends


def test_stream_with_restarts_equals_batch(spark, tmp_path):
    feed, seen = Feed(spark, tmp_path), []
    for start, n in ((0, 130), (130, 20), (150, 77), (227, 190)):
        rows = _rows(start, n) + _rows(start, n // 2, "other")
        seen += [r for r in rows]
        feed.put(rows)
        got = feed.run(B.stream_flushes(feed.stream(), "model", VECTOR(), 50))  # a new query each time: state from the checkpoint
    rows = spark.createDataFrame([(m, i, *rest) for i, (m, _, *rest) in enumerate(seen)], SCHEMA)
    want = B.flushes(rows, "model", "id", VECTOR(), 8, 50)
    assert _sums(got) == _sums(want) and got.where("model = 'm'").count() == 417 // 50


def test_rows_wait_for_a_baseline(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.put(_rows(0, 700))
    assert feed.run(B.stream_flushes(feed.stream(), "model", VECTOR(), 100, ready=False)).count() == 0
    feed.put(_rows(700, 101))
    got = feed.run(B.stream_flushes(feed.stream(), "model", VECTOR(), 100)).orderBy("flush").collect()
    assert [r["n"] for r in got] == [701, 100]  # all that waited, none dropped, with the next row
    assert got[0]["sums"][0] == sum(i % 7 != 0 for i in range(701))


def test_drift_of_flushes_and_missing_values(spark):
    ref = spark.createDataFrame([("m", i, float(i % 10), None) for i in range(100)], SCHEMA)
    cur = spark.createDataFrame([("m", i, float(i % 10) + (i >= 100) * 6, 1.0) for i in range(200)], SCHEMA)
    got = B.buffer_drift(B.flushes(cur, "model", "id", VECTOR(), 8, 100), "model", ref, ["x", "y"], EDGES).collect()
    by = {(r["flush"], r["feature"]): (r["distance"], r["drifted"]) for r in got}
    assert by[0, "x"] == (0.0, False) and by[1, "x"][1] and by[0, "y"] == (None, False)


def test_attributions_skip_other_feature_sets(spark):
    rows = [("a", i, {"u": 1.0, "v": -2.0}) for i in range(100)] + [("b", i, {"u": 1.0}) for i in range(100)]
    df = spark.createDataFrame(rows, "model string, id long, c map<string,double>")
    vector = B.attribution_vector("c", ["u", "v"])
    got = B.buffer_attribution_drift(B.flushes(df, "model", "id", vector, 3, 100), "model", {"u": 1.0, "v": 1.0}).collect()
    assert sorted((r["model"], r["feature"], r["current"], r["drift_ratio"], r["alert"]) for r in got) == [
        ("a", "u", 1.0, 0.0, False), ("a", "v", 2.0, 1.0, True)]


def test_replayed_batch_adds_nothing(spark, tmp_path):
    feed, base = Feed(spark, tmp_path), str(tmp_path / "log")
    feed.put(_rows(0, 30))
    log = feed.stream().where(F.col("id") >= 0)
    assert B.run_exactly_once(log, base).count() == 30
    B.commit_batch(spark.createDataFrame(_rows(0, 30), SCHEMA), 0, base)  # the batch again, as after a crash before its commit
    feed.put(_rows(30, 12))
    got = B.run_exactly_once(feed.stream().where(F.col("id") >= 0), base)
    assert sorted(r["id"] for r in got.collect()) == list(range(42))
