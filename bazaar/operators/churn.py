"""Churn models: split, encoding, boosted trees with cross-validation, metrics, gate, attributions, scoring
(M6-M11, M13, M14, F14, D6, D7).

Curves and ranks are computed on distinct scores with running totals over score buckets, so no task sorts all scores.
Attributions are Shapley values of the raw score by sampled orders of the features; every row gets them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.ranks import exact_quantiles, running_totals
from ..functions.stats import equal_width_bin
from ..session import cut
from .experiments import auc_by_group
from .features import churn_dataset

NUMERIC = ["days_since_last_purchase", "total_orders_90d", "total_orders_all_time", "avg_order_value_last_6m",
           "avg_order_value_all_time", "total_spend_all_time", "unique_categories_purchased", "return_rate_historical",
           "is_prime_member"]
CATEGORICAL = ["preferred_category"]
FEATURES = [*NUMERIC, *CATEGORICAL]


# ------------------------------------------------------------------ data

def ordinal_codes(train: DataFrame, col: str) -> DataFrame:
    """the values of a column in order, with codes from 0 (one row per category)."""
    values = train.select(F.col(col).alias("_value")).where(F.col("_value").isNotNull()).distinct()
    return values.withColumn("_code", (F.row_number().over(Window.orderBy("_value")) - 1).cast("int"))


def encode(df: DataFrame, col: str, codes: DataFrame) -> DataFrame:
    """the column replaced by its code, values unknown to the codes by -1."""
    j = df.join(codes, df[col] == codes["_value"], "left")
    return j.withColumn(col, F.coalesce("_code", F.lit(-1))).select(*df.columns)


def split(fact: DataFrame, customers: DataFrame, products: DataFrame, train_ref: str, test_ref: str, window_days: int = 365,
          preferred_col: str = "category", rates: tuple[float, float] | None = (0.05, 0.98)) -> DataFrame:
    """M6: the churn sets of two reference dates, one ``split`` column; categories are encoded by those of ``train``.

    The churn rate of the training rows must lie within ``rates`` (None: no check).
    """
    train = churn_dataset(fact, customers, products, train_ref, window_days, preferred_col=preferred_col)
    test = churn_dataset(fact, customers, products, test_ref, window_days, preferred_col=preferred_col)
    if rates is not None:
        rate = train.agg(F.avg("churned")).first()[0]
        if rate is None or not rates[0] < rate < rates[1]:
            raise ValueError(f"churn rate {rate} of the training rows is outside {rates}")
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    for c in CATEGORICAL:
        both = encode(both, c, ordinal_codes(train, c))
    return both


# ------------------------------------------------------------------ model

def _vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("_x", array_to_vector(F.array(*[F.col(c).cast("double") for c in FEATURES])))


def _training_rows(train: DataFrame, folds: int) -> DataFrame:
    """Vector, label, weight (both classes count alike) and fold (by a hash of the customer) of every row."""
    n = train.agg(F.sum(F.col("churned").cast("double")).alias("pos"), F.count(F.lit(1)).alias("n")).first()
    weight = F.when(F.col("churned") == 1, (n["n"] - (n["pos"] or 0.0)) / max(n["pos"] or 0.0, 1.0)).otherwise(1.0)
    return _vectors(train).select("_x", F.col("churned").cast("double").alias("_y"), weight.alias("_w"),
                                  F.pmod(F.xxhash64("customer_id"), F.lit(folds)).cast("int").alias("_fold"))


def train_model(train: DataFrame, folds: int = 3, depths: tuple[int, ...] = (3, 5), trees: int = 20) -> GBTClassificationModel:
    """M7: boosted trees; churned rows weigh so that both classes count alike; the depth of the best mean AUC over
    folds (by a hash of the customer) wins.  All rows take part."""
    gbt = GBTClassifier(featuresCol="_x", labelCol="_y", weightCol="_w", maxIter=trees, seed=42)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build()
    score = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="_y", metricName="areaUnderROC")
    return CrossValidator(estimator=gbt, estimatorParamMaps=grid, evaluator=score, numFolds=folds, foldCol="_fold",
                          seed=42).fit(_training_rows(train, folds)).bestModel


@dataclass(frozen=True)
class Setting:
    """The seven searched parameters.  A least gain and a least number of rows restrain the leaves, as penalties on a
    leaf's absolute and squared value do elsewhere."""

    trees: int
    depth: int
    rate: float
    row_share: float
    column_share: float
    least_gain: float
    least_rows: int

    def estimator(self, trees: int) -> GBTClassifier:
        return GBTClassifier(featuresCol="_x", labelCol="_y", weightCol="_w", maxIter=trees, maxDepth=self.depth, stepSize=self.rate,
                             subsamplingRate=self.row_share, featureSubsetStrategy=str(self.column_share),
                             minInfoGain=self.least_gain, minInstancesPerNode=self.least_rows, seed=42)


#: Bounds of the search; the learning rate is drawn on a log scale.
BOUNDS: dict[str, tuple[float, float]] = {
    "trees": (100, 500), "depth": (3, 8), "rate": (0.01, 0.3), "row_share": (0.6, 1.0), "column_share": (0.6, 1.0),
    "least_gain": (0.0, 0.01), "least_rows": (1, 50),
}


def draw_settings(n: int, bounds: dict[str, tuple[float, float]] | None = None, seed: int = 42) -> list[Setting]:
    """``n`` random settings within the bounds (those that are not given are ``BOUNDS``)."""
    rng = np.random.default_rng(seed)
    at = {**BOUNDS, **(bounds or {})}
    whole = lambda k: int(rng.integers(int(at[k][0]), int(at[k][1]) + 1))
    part = lambda k: round(float(rng.uniform(*at[k])), 4)
    return [Setting(whole("trees"), whole("depth"), round(float(np.exp(rng.uniform(*np.log(at["rate"])))), 4), part("row_share"),
                    part("column_share"), part("least_gain"), whole("least_rows")) for _ in range(n)]


TRIALS = ("trial int, rung int, trees_used int, trees int, depth int, rate double, row_share double, column_share double, "
          "least_gain double, least_rows int, fold_auc array<double>, mean_auc double, chosen boolean")


@dataclass
class Search:
    """The chosen model, its setting, and a table of all trials (one row per setting and rung)."""

    model: GBTClassificationModel
    setting: Setting
    trials: DataFrame


def search_model(train: DataFrame, settings: list[Setting], folds: int = 3, first: int = 10, parallel: int = 4) -> Search:
    """M7: random search over seven parameters by successive halving.

    Every setting is judged by its mean AUC over folds (by a hash of the customer, all rows) with ``first`` trees; the
    better half goes on with twice the trees, until one is left, which is fitted on all rows with all its trees.  A tie
    goes to the earlier setting.  A fold with one class only has no AUC and is left out of the mean; where no fold has
    one, the first setting wins.  The rows are stored once; up to ``parallel`` fits run beside each other as Spark jobs.
    """
    if not settings:
        raise ValueError("no setting to search")
    rows = cut(_training_rows(train, folds))
    both = {r["_fold"] for r in rows.groupBy("_fold").agg(F.countDistinct("_y").alias("k")).where("k > 1").collect()}
    score = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="_y", metricName="areaUnderROC", numBins=0)

    def judged(job: tuple[int, int, int]) -> float | None:
        i, fold, trees = job
        if fold not in both:
            return None
        model = settings[i].estimator(trees).fit(rows.where(F.col("_fold") != fold).drop("_fold"))
        return float(score.evaluate(model.transform(rows.where(F.col("_fold") == fold))))

    left, rung, trials = list(range(len(settings))), 0, []
    while True:
        trees = {i: min(settings[i].trees, first << rung) for i in left}
        jobs = [(i, f, trees[i]) for i in left for f in range(folds)]
        with ThreadPool(min(parallel, len(jobs))) as pool:
            auc = dict(zip(jobs, pool.map(inheritable_thread_target(rows.sparkSession)(judged), jobs, chunksize=1), strict=True))
        mean = {}
        for i in left:
            got = [auc[i, f, trees[i]] for f in range(folds)]
            mean[i] = float(np.mean([g for g in got if g is not None])) if any(g is not None for g in got) else None
            trials.append((i, rung, trees[i], *asdict(settings[i]).values(), got, mean[i]))
        left = sorted(left, key=lambda i: (-(mean[i] if mean[i] is not None else -1.0), i))[: (len(left) + 1) // 2]
        rung += 1
        if len(left) == 1:
            break
    best = left[0]
    table = rows.sparkSession.createDataFrame([(*t, t[0] == best) for t in trials], TRIALS)  # trials, not data
    return Search(settings[best].estimator(settings[best].trees).fit(rows), settings[best], table)


def score_rows(model: GBTClassificationModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Every row with ``churn_probability`` (6 digits) and ``churn_label`` (probability at or over the threshold)."""
    p = model.transform(_vectors(df)).withColumn("churn_probability", F.round(vector_to_array("probability")[1], 6))
    return p.withColumn("churn_label", (F.col("churn_probability") >= threshold).cast("int")).select(
        *df.columns, "churn_probability", "churn_label")


# ------------------------------------------------------------------ metrics

def pr_curve(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Precision, recall and F1 of every distinct score as threshold."""
    vf = scored.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))
    vf = running_totals(vf.withColumn("_neg", -F.col("threshold")), [], "_neg", ["n", "pos"])
    hit = F.col("pos_before") + F.col("pos")
    c = vf.withColumn("precision", hit / (F.col("n_before") + F.col("n"))).withColumn("recall", F.try_divide(hit, F.col("pos_total")))
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-10)
    return c.select("threshold", "precision", "recall", f1.alias("f1"), F.try_divide("pos", "pos_total").alias("_step"), "n", "pos")


def best_threshold(curve: DataFrame) -> DataFrame:
    """M9: the threshold of the best F1, the lowest of equals."""
    return curve.agg(F.max(F.struct("f1", -F.col("threshold"))).alias("b")).select(
        (-F.col("b.col2")).alias("threshold"), F.col("b.f1").alias("f1"))


def confusion(scored: DataFrame, score: str, label: str, threshold: Column | float) -> DataFrame:
    """Tp, fp, fn, tn and precision, recall, F1 at a threshold."""
    hit, is_pos = F.col(score) >= threshold, F.col(label) == 1
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    c = scored.agg(n(hit & is_pos).alias("tp"), n(hit & ~is_pos).alias("fp"), n(~hit & is_pos).alias("fn"), n(~hit & ~is_pos).alias("tn"))
    safe = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    c = c.withColumn("precision", safe(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn(
        "recall", safe(F.col("tp"), F.col("tp") + F.col("fn")))
    total = F.col("precision") + F.col("recall")
    return c.withColumn("f1", F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(0.0))


def metrics(scored: DataFrame, score: str, label: str) -> DataFrame:
    """M8: one row: ROC-AUC, average precision, precision / recall / F1 at the best threshold, counts and churn rate.

    Without a positive row recall, F1 and average precision are null; with one class only the AUC is.
    """
    curve = pr_curve(scored, score, label)
    auc = auc_by_group(scored.withColumn("_all", F.lit(1)), "_all", score, label)
    best = curve.agg(F.max(F.struct("f1", -F.col("threshold"), "precision", "recall")).alias("b"),
                     F.sum(F.col("precision") * F.col("_step")).alias("avg_precision"),
                     F.coalesce(F.sum("pos"), F.lit(0)).alias("npos"), F.coalesce(F.sum(F.col("n") - F.col("pos")), F.lit(0)).alias("nneg"))
    return best.select(
        auc.select("auc").scalar().alias("roc_auc"), "avg_precision", F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"),
        F.col("b.f1").alias("f1"), (-F.col("b.col2")).alias("threshold"), "npos", "nneg",
        F.try_divide(F.col("npos"), F.col("npos") + F.col("nneg")).alias("churn_rate"))


def quality_gate(row: DataFrame, metric: str = "roc_auc", least: float = 0.68) -> DataFrame:
    """The metric row with ``meets_threshold``."""
    return row.withColumn("meets_threshold", F.coalesce(F.col(metric) >= least, F.lit(False)))


def require_quality(gated: DataFrame) -> None:
    """Refuses a model whose gate failed."""
    row = gated.first()
    if row is None or not row["meets_threshold"]:
        raise RuntimeError(f"model refused: {row.asDict() if row else 'no metrics'}")


def score_histogram(scored: DataFrame, score: str, label: str, bins: int = 40) -> DataFrame:
    """Rows per score bin and label."""
    b = equal_width_bin(F.col(score), F.lit(0.0), F.lit(1.0), bins)
    return scored.groupBy(b.alias("bin"), label).agg(F.count(F.lit(1)).alias("n"))


def feature_by_label(rows: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Quartiles of each feature by label."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]))
    long = rows.select(label, each.alias("f")).select(label, "f.feature", "f.value")
    q = exact_quantiles(long, [label, "feature"], "value", [0.25, 0.5, 0.75])
    return q.select(label, "feature", "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))


# ------------------------------------------------------------------ attributions

class Trees:
    """Boosted trees as arrays, to score many rows of numbers in numpy inside tasks."""

    def __init__(self, model: GBTClassificationModel):
        feature, threshold, left, right, value, roots = [], [], [], [], [], []

        def put(node) -> int:
            at = len(feature)
            for column, x in zip((feature, threshold, left, right, value), (-1, 0.0, at, at, float(node.prediction())), strict=True):
                column.append(x)
            if node.subtreeDepth() > 0:
                split = node.split()
                feature[at], threshold[at] = int(split.featureIndex()), float(split.threshold())
                left[at], right[at] = put(node.leftChild()), put(node.rightChild())
            return at

        depth = 0
        for tree in model.trees:
            root = tree._java_obj.rootNode()
            depth = max(depth, int(root.subtreeDepth()))
            roots.append(put(root))
        self.feature, self.threshold, self.value = np.array(feature), np.array(threshold), np.array(value)
        self.left, self.right, self.roots, self.depth = np.array(left), np.array(right), np.array(roots), depth
        self.weights = np.array(model.treeWeights)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The raw score of the positive class (half the log odds) of each row."""
        at = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            below = x[row, np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(f < 0, at, np.where(below, self.left[at], self.right[at]))
        return (self.value[at] * self.weights).sum(axis=1)


def shapley(score: Callable[[np.ndarray], np.ndarray], x: np.ndarray, background: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Contributions (rows x features): the change of the score when a feature's value comes in, averaged over the
    orders, each taken from a background row (in turn) to the row; with every order used for every background row they
    add up to the row's score less the background's mean score."""
    n, d = x.shape
    out = np.zeros((n, d))
    for z in background:
        for order in orders:
            inner = np.broadcast_to(z, (d + 1, n, d)).copy()
            for k, f in enumerate(order):
                inner[k + 1 :, :, f] = x[:, f]
            s = score(inner.reshape(-1, d)).reshape(d + 1, n)
            out[:, order] += (s[1:] - s[:-1]).T
    return out / (len(background) * len(orders))


def sampled_orders(features: int, pairs: int, seed: int = 42) -> np.ndarray:
    """Random orders in pairs of an order and its reverse."""
    rng = np.random.default_rng(seed)
    forth = [rng.permutation(features) for _ in range(pairs)]
    return np.array([o for f in forth for o in (f, f[::-1])])


BACKGROUND, PAIRS = 8, 4  # background rows, pairs of orders


def contribution_rows(model: GBTClassificationModel, df: DataFrame, key: str, background: int = BACKGROUND, pairs: int = PAIRS) -> DataFrame:
    """(key, values): Shapley values of the raw score (half the log odds) in the order of ``FEATURES``, by sampled pairs
    of orders.

    A row's values add up to its raw score less the mean raw score of the background: ``background`` rows of ``df``, the
    first by a hash of the key (a bounded sample).  Rows are scored in Arrow batches; the model travels as arrays.
    """
    x = F.array(*[F.col(c).cast("double") for c in FEATURES])
    rows = df.select(F.col(key), x.alias("x"))
    few = rows.orderBy(F.xxhash64(key), key).limit(background).collect()
    if not few:
        return df.select(key, F.array(F.lit(0.0)).alias("values")).where(F.lit(False))
    base, trees, orders = np.array([r["x"] for r in few], float), Trees(model), sampled_orders(len(FEATURES), pairs)

    @F.pandas_udf("array<double>")
    def values(batch: pd.Series) -> pd.Series:
        parts = [shapley(trees.margins, np.array(batch.iloc[i : i + 512].tolist(), float), base, orders) for i in range(0, len(batch), 512)]
        return pd.Series(list(np.concatenate([*parts, np.zeros((0, len(FEATURES)))])))

    return rows.select(key, values("x").alias("values"))


def contributions(model: GBTClassificationModel, df: DataFrame, key: str, background: int = BACKGROUND, pairs: int = PAIRS) -> DataFrame:
    """(key, feature, value): ``contribution_rows``, a row per feature."""
    each = contribution_rows(model, df, key, background, pairs).select(key, F.posexplode("values").alias("j", "value"))
    names = F.array(*map(F.lit, FEATURES))
    return each.select(key, F.get(names, F.col("j")).alias("feature"), "value")


def mean_attribution(contribs: DataFrame) -> DataFrame:
    """Mean absolute contribution of each feature, over all rows."""
    return contribs.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"), F.count(F.lit(1)).alias("n"))


def top_contributions(rows: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Each key's contributions by absolute value, the first k; equal ones by name.

    ``rows`` is ``contribution_rows`` (key, values) or ``contributions`` (key, feature, value).  Arrays are grouped as they
    are, without names: a row per key is shuffled, not one per feature.
    """
    if "values" in rows.columns:
        names = sorted(FEATURES)
        place = F.array(*[F.lit(names.index(f)) for f in FEATURES])
        told = lambda v: F.transform(v, lambda x, i: F.struct((-F.abs(x)).alias("o"), F.get(place, i).alias("feature"), x.alias("value")))
        ranked = rows.groupBy(key).agg(F.collect_list("values").alias("v")).select(
            key, F.array_sort(F.flatten(F.transform("v", told))).alias("c"))
        name = lambda f: F.get(F.array(*map(F.lit, names)), f)
    else:
        ranked = rows.groupBy(key).agg(F.array_sort(F.collect_list(
            F.struct((-F.abs("value")).alias("o"), F.col("feature").alias("feature"), F.col("value").alias("value")))).alias("c"))
        name = lambda f: f
    return ranked.select(key, F.transform(F.slice("c", 1, k), lambda c: F.struct(name(c["feature"]).alias("feature"), c["value"].alias("value"))).alias("top"))
