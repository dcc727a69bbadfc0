"""Champion / challenger experiments and distribution drift.

The ``events`` table stands in for the prediction log (FIXTURES.md C):
user_id = customer, value / 500 = churn score, every non-purchase event is a
prediction, a ``purchase`` is an order.  "Now" is the latest event time.

AUC (rank-sum with average ties) and the two-sample KS statistic are computed
from value-frequency tables: rows are first reduced to one row per distinct
(group, value), and running counts over those are taken in two levels (buckets of
values, then inside a bucket), so no step holds a group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import running_totals


def ab_bucket(key: Column) -> Column:
    """sha256 of the key text -> last 8 hex digits -> integer -> mod 100."""
    return F.pmod(F.conv(F.substring(F.sha2(key.cast("string"), 256), -8, 8), 16, 10).cast("bigint"), F.lit(100))


def assign_version(df: DataFrame, key: str, challenger_pct: float = 0.5) -> DataFrame:
    """Challenger when bucket < int(pct * 100); pct must be in [0, 1]."""
    if not 0.0 <= challenger_pct <= 1.0:
        raise ValueError("challenger_pct must be in [0, 1]")
    b = ab_bucket(F.col(key))
    return df.withColumn("model_version", F.when(b < int(challenger_pct * 100), "challenger").otherwise("champion"))


def prediction_log(events: DataFrame, challenger_pct: float = 0.5) -> DataFrame:
    """X10 (batch form): predictions = non-purchase events with score value / 500."""
    p = events.where(F.col("event_type") != "purchase").select(
        F.col("user_id").alias("customer_id"), (F.col("value") / 500.0).alias("churn_prob"),
        F.col("ts").alias("predicted_at"), "event_id")
    return assign_version(p, "customer_id", challenger_pct)


def materialize_outcomes(preds: DataFrame, events: DataFrame, window_days: int = 7, labelled: DataFrame | None = None,
                         age_days: int = 0) -> DataFrame:
    """First prediction per customer older than the window; churned = no purchase in the window from the
    day of this prediction on (dates, so an earlier purchase of the same day counts).

    "Now" is the latest event time less ``age_days``; the outcome is dated now.  Customers in ``labelled`` are
    skipped by an anti-join.  The range condition is a left join on the customer; one row per customer results.
    """
    now = events.agg(F.max("ts") - F.expr(f"INTERVAL {age_days} DAYS")).scalar()
    first = (preds.where(F.col("predicted_at") <= now - F.expr(f"INTERVAL {window_days} DAYS"))
             .groupBy("customer_id").agg(F.to_date(F.min("predicted_at")).alias("day")))
    if labelled is not None:
        first = first.join(labelled.select("customer_id").distinct(), "customer_id", "left_anti")
    buys = events.where((F.col("event_type") == "purchase") & (F.col("ts") <= now)).select(
        F.col("user_id").alias("cid"), F.to_date("ts").alias("bought"))
    j = first.join(buys, (first.customer_id == buys.cid) & (buys.bought >= first.day) &
                   (buys.bought < F.date_add(first.day, window_days)), "left")
    return j.groupBy("customer_id").agg((F.count("bought") == 0).alias("churned")).select(
        "customer_id", "churned", F.to_date(now).alias("outcome_date"))


def outcomes_to_date(preds: DataFrame, events: DataFrame, window_days: int = 7, every_days: int = 7) -> DataFrame:
    """Two runs of the outcome job, ``every_days`` apart: the later run labels only customers without a label."""
    earlier = materialize_outcomes(preds, events, window_days, age_days=every_days)
    later = materialize_outcomes(preds, events, window_days, labelled=earlier)
    return earlier.unionByName(later)


def labelled_predictions(preds: DataFrame, outcomes: DataFrame, events: DataFrame, window_days: int = 7) -> DataFrame:
    """Matured predictions (predicted_at <= now - window) joined with their customer's outcome."""
    now = events.agg(F.max("ts")).scalar()
    p = preds.where(F.col("predicted_at") <= now - F.expr(f"INTERVAL {window_days} DAYS"))
    return p.join(outcomes.select("customer_id", F.col("churned").cast("int").alias("label")), "customer_id")


def version_stats(labelled: DataFrame) -> DataFrame:
    """Per version: n, mean probability, churn rate."""
    return labelled.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("n"), F.avg("churn_prob").alias("mean_prob"),
        F.avg(F.col("label").cast("double")).alias("churn_rate"))


def auc_by_group(scored: DataFrame, group: str, score: str, label: str) -> DataFrame:
    """Exact ROC-AUC per group by rank-sum with average ties; groups with one class are dropped.

    AUC = (sum of positive ranks - n+(n+ + 1)/2) / (n+ n-), ranks over the
    group's scores with ties averaged.  Computed on (group, score) frequency
    rows, with running counts over buckets of scores: no task sorts a group.
    """
    vf = scored.groupBy(group, score).agg(F.count(F.lit(1)).alias("n"),
                                          F.sum(F.col(label).cast("bigint")).alias("pos"))
    vf = running_totals(vf, [group], score, ["n"])
    vf = vf.withColumn("avg_rank", F.col("n_before") + (F.col("n") + 1) / 2.0)
    g = vf.groupBy(group).agg(F.sum(F.col("pos") * F.col("avg_rank")).alias("rsum"),
                              F.sum("pos").alias("npos"), (F.sum("n") - F.sum("pos")).alias("nneg"))
    g = g.where((F.col("npos") > 0) & (F.col("nneg") > 0))
    return g.select(group, "npos", "nneg", ((F.col("rsum") - F.col("npos") * (F.col("npos") + 1) / 2.0)
                                            / (F.col("npos") * F.col("nneg"))).alias("auc"))


def promotion_decision(stats: DataFrame, aucs: DataFrame, min_n: int = 1000, margin: float = 0.01) -> DataFrame:
    """Promote the challenger when n_challenger >= min_n and AUC_c >= AUC_p + margin."""
    s = stats.join(aucs.select("model_version", "auc"), "model_version", "left")
    row = s.agg(F.max(F.when(F.col("model_version") == "challenger", F.col("n"))).alias("n_challenger"),
                F.max(F.when(F.col("model_version") == "challenger", F.col("auc"))).alias("auc_challenger"),
                F.max(F.when(F.col("model_version") == "champion", F.col("auc"))).alias("auc_champion"))
    ok = (F.coalesce(F.col("n_challenger"), F.lit(0)) >= min_n) & (
        F.col("auc_challenger") >= F.col("auc_champion") + margin)
    return row.withColumn("promote", F.coalesce(ok, F.lit(False)))


# ----------------------------------------------------------------------------- drift

def ks_drift(reference: DataFrame, current: DataFrame, feature_key: str, value: str,
             p_threshold: float = 0.05) -> DataFrame:
    """Two-sample KS statistic and asymptotic p-value per feature.

    D = max over values of |F_ref(v) - F_cur(v)|, evaluated on the union of the
    distinct values (value-frequency rows, cumulative counts per feature).
    p-value: Kolmogorov limiting distribution with the Stephens correction,
    summed over 100 terms.  Drift when p < threshold.  A feature without a value on one side has no statistic and has
    not drifted.
    """
    r = reference.groupBy(feature_key, value).agg(F.count(F.lit(1)).alias("c1")).withColumn("c2", F.lit(0))
    c = current.groupBy(feature_key, value).agg(F.count(F.lit(1)).alias("c2")).withColumn("c1", F.lit(0))
    u = r.unionByName(c).groupBy(feature_key, value).agg(F.sum("c1").alias("c1"), F.sum("c2").alias("c2"))
    u = running_totals(u, [feature_key], value, ["c1", "c2"])
    u = u.select(feature_key, F.try_divide(F.col("c1_before") + F.col("c1"), F.col("c1_total")).alias("f1"),
                 F.try_divide(F.col("c2_before") + F.col("c2"), F.col("c2_total")).alias("f2"),
                 F.col("c1_total").alias("n1"), F.col("c2_total").alias("n2"))
    d = u.groupBy(feature_key).agg(F.max(F.abs(F.col("f1") - F.col("f2"))).alias("ks_stat"),
                                   F.first("n1").alias("n_ref"), F.first("n2").alias("n_cur"))
    ne = F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur"))
    lam = (F.sqrt(ne) + 0.12 + F.try_divide(F.lit(0.11), F.sqrt(ne))) * F.col("ks_stat")
    terms = F.transform(F.sequence(F.lit(1), F.lit(100)),
                        lambda j: F.pow(F.lit(-1.0), j - 1) * F.exp(-2.0 * j * j * lam * lam))
    p = F.least(F.greatest(2 * F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)), F.lit(1.0))
    out = d.withColumn("p_value", F.when(F.col("ks_stat") == 0, F.lit(1.0)).when(F.col("ks_stat") > 0, F.round(p, 8)))
    return out.withColumn("drifted", F.coalesce(F.col("p_value") < p_threshold, F.lit(False)))


def dataset_drift(per_feature: DataFrame, share_threshold: float = 0.5) -> DataFrame:
    """Drifted share and the dataset-level flag."""
    return per_feature.agg(F.count(F.lit(1)).alias("n_features"),
                           F.sum(F.col("drifted").cast("int")).alias("n_drifted")).select(
        "n_features", "n_drifted", (F.col("n_drifted") / F.col("n_features")).alias("drift_share"),
        (F.col("n_drifted") / F.col("n_features") >= share_threshold).alias("dataset_drift"))


def retrain_decision(summary: DataFrame, share: float = 0.30, min_features: int = 3, checked_at: Column | None = None,
                     now: Column | None = None, max_age_hours: int = 24) -> DataFrame:
    """Retrain when the dataset drifted, share >= 0.30 and at least 3 features drifted.

    With ``checked_at`` and ``now`` a result of ``max_age_hours`` or older is stale and never a reason to retrain.
    """
    ok = F.col("dataset_drift") & (F.col("drift_share") >= share) & (F.col("n_drifted") >= min_features)
    if checked_at is None or now is None:
        return summary.withColumn("retrain", ok)
    fresh = checked_at + F.expr(f"INTERVAL {max_age_hours} HOURS") > now
    return summary.withColumn("fresh", fresh).withColumn("retrain", ok & F.col("fresh"))
