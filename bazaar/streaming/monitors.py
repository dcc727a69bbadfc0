"""Request / prediction monitoring as Structured Streaming jobs.

The same window functions run on a batch DataFrame (for the oracle check) and
on a streaming one.  Event time is ``ts``; the watermark bounds state: rows
arriving later than ``watermark`` behind the max seen event time are dropped
(Spark's append-mode semantics), which is the documented late-data policy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.tables import read_table

LATENCY_EDGES = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]  # seconds, 10 bucket edges
SCORE_EDGES = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]      # 11 score edges


def _watermarked(events: DataFrame, watermark: str) -> DataFrame:
    """Streams need a TIMESTAMP event time for the watermark; the parquet column is TIMESTAMP_NTZ.
    Batch input is left as is (no time-zone dependence)."""
    if not events.isStreaming:
        return events
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)


def request_metrics(events: DataFrame, window: str = "5 minutes", watermark: str = "1 minute") -> DataFrame:
    """Per event-time window and model (event_type): requests, errors, error ratio,
    mean latency and cumulative latency-bucket counts (value / 100 = latency in seconds)."""
    lat = F.col("value") / 100.0
    e = _watermarked(events, watermark)
    g = e.groupBy(F.window("ts", window).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("errors"),
        F.sum(lat).alias("latency_sum"),
        *[F.sum(F.when(lat <= edge, 1).otherwise(0)).alias(f"le_{i}") for i, edge in enumerate(LATENCY_EDGES)],
    )
    return g.select(F.col("w.start").alias("window_start"), "event_type", "requests", "errors",
                    (F.col("errors") / F.col("requests")).alias("error_ratio"),
                    (F.col("latency_sum") / F.col("requests")).alias("mean_latency"),
                    *[f"le_{i}" for i in range(len(LATENCY_EDGES))])


def latency_quantile(metrics: DataFrame, q: float) -> DataFrame:
    """Quantile from the cumulative bucket counts with linear interpolation inside the bucket."""
    edges = [0.0] + LATENCY_EDGES
    n = F.col("requests")
    rank = F.lit(q) * n
    out = F.lit(None).cast("double")
    for i in reversed(range(len(LATENCY_EDGES))):
        lo_c = F.col(f"le_{i - 1}") if i > 0 else F.lit(0)
        hi_c = F.col(f"le_{i}")
        frac = (rank - lo_c) / F.when(hi_c > lo_c, hi_c - lo_c).otherwise(F.lit(1))
        est = F.lit(edges[i]) + (F.lit(edges[i + 1]) - F.lit(edges[i])) * frac
        out = F.when(hi_c >= rank, est).otherwise(out)
    # beyond the last finite edge: the last edge (as a bucket histogram cannot say more)
    out = F.when(F.col(f"le_{len(LATENCY_EDGES) - 1}") < rank, F.lit(LATENCY_EDGES[-1])).otherwise(out)
    return metrics.select("window_start", "event_type", F.round(out, 9).alias(f"latency_q{int(q * 100)}"))


def score_histogram(events: DataFrame, window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """Per window, cumulative counts of scores <= each edge, mean score and share above 0.5."""
    s = F.col("value") / 500.0
    e = _watermarked(events, watermark)
    p = e.where(F.col("event_type") != "purchase")
    g = p.groupBy(F.window("ts", window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(s).alias("score_sum"),
        *[F.sum(F.when(s <= edge, 1).otherwise(0)).alias(f"le_{i}") for i, edge in enumerate(SCORE_EDGES)],
    )
    return g.select(F.col("w.start").alias("window_start"), "n", (F.col("score_sum") / F.col("n")).alias("mean_score"),
                    (1 - F.col("le_5") / F.col("n")).alias("share_above_half"),
                    *[f"le_{i}" for i in range(len(SCORE_EDGES))])


def events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The events table read as a file stream (schema taken from the batch table); ``max_files`` limits a micro-batch."""
    schema = read_table(spark, sf_dir, "events").schema
    # a file stream watches a directory; pick the events file(s) in it
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(sf_dir.rstrip("/"))


def run_available_now(df: DataFrame, name: str, output_mode: str = "append", sink_dir: str | None = None):
    """Run a streaming DataFrame to completion (Trigger.AvailableNow) into a parquet sink.

    In append mode windows that the watermark has not closed at the end of the input stay in the state: the sink
    holds the windows that end at or before the greatest event time less the watermark, and the next run adds the rest.

    Checkpoint and sink live under the session's checkpoint dir (a shared
    folder on a cluster), so a restarted query resumes from its offsets and
    state instead of starting over.
    """
    spark = df.sparkSession
    base = sink_dir or shared_dir(spark, f"streams/{name}")
    q = (df.writeStream.outputMode(output_mode).format("parquet")
         .option("checkpointLocation", f"{base}/_checkpoint").option("path", f"{base}/data")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/data")


def prediction_log_sink(spark: SparkSession, sf_dir: str, challenger_pct: float = 0.5):
    """Append-only prediction log from the event stream (assignment is a pure column expression)."""
    from ..operators.experiments import prediction_log

    return run_available_now(prediction_log(events_stream(spark, sf_dir), challenger_pct), "prediction_log")
