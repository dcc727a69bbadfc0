"""Mixing sources to target weights by soft membership.

A classifier fitted on the labelled table gives every document a posterior over domains, so a document belongs to
several domains in part.  Nonnegative document rates are then fitted by projected-gradient least squares such that the
expected tokens of each domain, the sum of rate x tokens x posterior, match the targets.

Classifier: multinomial logistic regression with an elastic-net penalty over hashed words (case folded, cut at
everything but letters and digits) and doubled signs, present or not; it is fitted on all labelled documents.  Scoring is
part of a scan: a document's score
sums the weights of its buckets, which are read off an array of a fixed size.

Rates: the gradient of a document depends on it only by its posterior and on the corpus by one residual per domain.
So a step is one aggregate over (tokens, posterior), and a document's rate is the replay of the residuals so far: no
table of rates is kept between steps, and nothing is shuffled but one row of sums a task.  Residuals are taken relative
to each domain's tokens, which bounds the step by 1, and the loop ends when no residual changes.

All steps are DataFrame operations of the JVM.

Defined results: null, empty or blank text has 0 tokens, the classifier's intercepts as its posterior, and takes part;
null doc_ids are kept and repeated rows give one output row each; a domain without a target has target 0; labelled
rows without quality and toxic are ignored, of several labels of a doc_id the first domain by name counts; with one
domain only everything belongs to it; an empty table or no labelled document gives an empty result (and a mixture of
the rows as they are); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from bazaar.functions.ranks import running_totals
from bazaar.llm.common import ROW, cut, packed, stored, unpacked

GAPS = r"[ \t\n\x0B\f\r.,]+"  # between what is counted as tokens
BREAKS = r"[^\p{L}\p{M}\p{N}]+"  # between the classifier's words
BUCKETS = 1 << 16
SIGNS = r"([!#$%&*|?])\1"
RARE = 2500  # a bucket takes part if one in so many labelled documents has it, and two at least
PENALTY, SPARSE, ROUNDS = 0.002, 0.9, 30  # strength of the penalty, the part of it on absolute weights, iterations
STEPS, SETTLED = 60, 1e-7
FEW = 1000  # so many buckets with a weight are looked for in a document before its weights are added up
LEAST = 0.5  # no limit of a posterior is lower

#: Domain of a labelled row.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'low' WHEN quality = 1 THEN 'good' END"


def _featured(rows: DataFrame) -> DataFrame:
    """``rows(_text, ...)`` with ``_tokens`` and ``_b``: the distinct buckets (from 0) of words, and one more where more
    than one of fifty places has a sign doubled."""
    words = F.split(F.lower("_text"), BREAKS, -1)
    buckets = F.array_distinct(F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(BUCKETS - 1))))
    doubled = F.when(50 * F.regexp_count("_text", F.lit(SIGNS)) > F.length("_text"), F.array(F.lit(BUCKETS).cast("long")))
    rows = rows.withColumn("_tokens", F.size(F.array_remove(F.split("_text", GAPS, -1), "")).cast("long"))
    return rows.withColumn("_b", F.concat(buckets, F.coalesce(doubled, F.array().cast("array<bigint>"))))


def _read(rows: DataFrame) -> DataFrame:
    """``rows(_text, ...)`` with their features in place of the text, stored: texts are taken apart once, for the fit, the
    limits and the scores."""
    return stored(_featured(rows).drop("_text").withColumn("_b", F.col("_b").cast("array<int>")))


class Classifier:
    """Posteriors over ``domains``: a weight per domain and bucket, and an intercept per domain."""

    def __init__(self, domains: list[str], weights: np.ndarray, intercepts: np.ndarray):
        self.domains, self.weights, self.intercepts = domains, weights, intercepts

    def posteriors(self, rows: DataFrame) -> DataFrame:
        """``rows(_tokens, _b, ...)`` with ``_p``, the posteriors in the order of the domains, in place of ``_b``."""
        names = [c for c in rows.columns if c != "_b"]
        # only differences count, so the first domain scores 0; the others' weights are one row of arrays of a fixed
        # size, and a bucket's weight is read off by its place
        k = range(1, len(self.domains))
        if not k:
            return rows.select(*names, F.array(F.lit(1.0)).alias("_p"))
        apart = self.weights - self.weights[0]
        told = np.flatnonzero(np.any(apart != 0, axis=0)).tolist()
        table = rows.sparkSession.createDataFrame([[told, *[apart[i].tolist() for i in k]]],
                                                  ", ".join(["told array<int>", *[f"w{i} array<double>" for i in k]]))
        if len(told) <= FEW:  # the others add nothing
            rows = rows.withColumn("_b", F.array_intersect("_b", table.select("told").scalar()))
        # each array is named once, so that it is read off where it stands and no row carries a copy
        rows = rows.withColumns({f"_w{i}": table.select(f"w{i}").scalar() for i in k})
        rows = rows.select(*names, F.transform("_b", lambda b: F.array(*[F.get(f"_w{i}", b) for i in k])).alias("_x"))

        def score(i: int) -> Column:
            return F.aggregate("_x", F.lit(float(self.intercepts[i] - self.intercepts[0])), lambda a, x: a + F.get(x, F.lit(i - 1)))

        rows = rows.withColumn("_s", F.array(F.lit(0.0), *map(score, k))).withColumn("_e", F.transform("_s", lambda x: F.exp(x - F.array_max("_s"))))
        whole = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
        return rows.select(*names, F.transform("_e", lambda x: x / whole).alias("_p"))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("_hash"), F.coalesce(docs["text"], F.lit("")).alias("_text"))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (_hash, _tokens, _b, domain) of all labelled documents."""
    return _known(_read(_rows(docs)), labels)


def _known(read: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.select(F.col("doc_id"), F.expr(DOMAIN).alias("domain")).dropna()
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    return stored(read.select("doc_id", "_hash", "_tokens", "_b").join(known, "doc_id").drop("doc_id"))


def fit(docs: DataFrame, labels: DataFrame) -> Classifier | None:
    """The classifier of a labelled table (doc_id, quality, toxic); None where no document is labelled."""
    return _fitted(_labelled(docs, labels))


def _told(rows: DataFrame, n: int) -> list[int]:
    """The buckets that take part, of the ``n`` documents ``rows(_b, ...)``.

    Buckets that so few documents hold that no weight is worth its penalty need not be fitted: a document moves the mean
    loss's gradient by less than 1 / n, and a weight stays 0 where that gradient is within the penalty on absolute weights.
    So the best weights of these are 0 whatever the labels are, while each step of a fit costs the driver arrays of all
    buckets and domains.
    """
    seen = rows.select(F.explode("_b").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    seen = seen.where((F.col("n") >= max(2.0, n // RARE)) & (F.col("n") > PENALTY * SPARSE * n))
    return seen.agg(F.array_sort(F.collect_list("b"))).first()[0]


def _vectors(rows: DataFrame, told: list[int]) -> DataFrame:
    """``rows(_label, _b)`` as (_x, _label), stored: 1 at the place of each bucket of ``told`` in the document.  The column
    carries no names of places, which would be as many as the buckets in each plan that the driver keeps."""
    at = dict(zip(told, range(len(told)), strict=True))
    table = rows.sparkSession.createDataFrame([[[at.get(b) for b in range(BUCKETS + 1)]]], "at array<int>")
    rows = rows.withColumn("_at", table.scalar())
    rows = rows.withColumn("_i", F.sort_array(F.array_compact(F.transform("_b", lambda b: F.get("_at", b)))))
    sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(max(1, len(told))).alias("size"), F.col("_i").alias("indices"),
                      F.transform("_i", lambda i: F.lit(1.0)).alias("values"))
    # a vector is kept as such a struct, so it is read as one without a step in Python
    return stored(rows.select(sparse.alias("_x"), "_label"), StructType([StructField("_x", VectorUDT()), StructField("_label", DoubleType())]))


def _fitted(rows: DataFrame) -> Classifier | None:
    counts = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(counts)
    weights = np.zeros((len(domains), BUCKETS + 1))
    if len(domains) < 2:
        return Classifier(domains, weights, np.zeros(len(domains))) if domains else None
    n = sum(counts.values())
    told = _told(rows, n)
    label = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")).cast("double") - 1
    vectors = _vectors(rows.select(label.alias("_label"), "_b"), told)
    lr = LogisticRegression(featuresCol="_x", labelCol="_label", family="multinomial", regParam=PENALTY, elasticNetParam=SPARSE,
                            maxIter=ROUNDS, standardization=False)
    # the fit reads its rows twice before it keeps them; partitions follow the rows, as each iteration is a job
    model = lr.fit(vectors.coalesce(max(4, n // 10_000)))
    weights[:, told] = model.coefficientMatrix.toArray()[:, : len(told)]
    return Classifier(domains, weights, model.interceptVector.toArray())


def _rated(members: DataFrame, history: list[list[float]], least: float = 0.0) -> DataFrame:
    """``members`` with ``_rate`` after the given residuals: each step goes against the gradient and stays at ``least`` or
    above.  The residuals are one row of data and no literals, so the code of every step is compiled once."""
    if not history:
        return members.withColumn("_rate", F.lit(1.0))
    steps = members.sparkSession.createDataFrame([(history,)], "g array<array<double>>").scalar()
    dot = lambda g: sum((F.element_at("_p", i + 1) * F.element_at(g, i + 1) for i in range(len(history[0]))), F.lit(0.0))
    rate = F.aggregate("_g", F.lit(1.0), lambda r, g: F.greatest(F.lit(least), r - dot(g)))
    return members.withColumn("_g", steps).withColumn("_rate", rate).drop("_g")


def _tokens_of(members: DataFrame, k: int) -> list[float]:
    """Expected tokens by domain of ``members(_tokens, _p, _rate)``."""
    row = members.select((F.col("_tokens") * F.col("_rate")).alias("w"), "_p").agg(
        *[F.sum(F.col("w") * F.element_at("_p", i + 1)).alias(f"m{i}") for i in range(k)]
    ).first()
    return [x or 0.0 for x in row]


def fit_rates(members: DataFrame, targets: list[float], least: float = 0.0, settled: float = SETTLED) -> list[list[float]]:
    """Residuals of the projected-gradient steps over ``members(_tokens, _p)``; ``targets`` are tokens by domain."""
    k = len(targets)
    have = _tokens_of(_rated(members, []), k)
    history: list[list[float]] = []
    for _ in range(STEPS):
        now = _tokens_of(_rated(members, history, least), k) if history else have
        residual = [(m - t) / h if h else 0.0 for m, t, h in zip(now, targets, have, strict=True)]
        if max(map(abs, residual), default=0.0) < settled or history and max(
            abs(a - b) for a, b in zip(residual, history[-1], strict=True)
        ) < SETTLED:
            break
        history.append(residual)
    return history


def targets_of(members: DataFrame, domains: list[str], weights: dict[str, float] | None, shares: dict[str, float] | None) -> list[float]:
    """Target tokens by domain: ``weights`` of a mixture as large as the corpus, or ``shares`` of what each has."""
    have = _tokens_of(_rated(members, []), len(domains))
    if shares is not None:
        return [h * shares.get(d, 0.0) for d, h in zip(domains, have, strict=True)]
    whole = sum((weights or {}).values()) or 1.0
    return [sum(have) * (weights or {}).get(d, 0.0) / whole for d in domains]


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, shares: dict[str, float] | None = None) -> DataFrame:
    """One row per document: doc_id, tokens, posterior of each domain, rate."""
    read = _read(_rows(docs))
    model = _fitted(_known(read, labels))
    if model is None:
        return docs.select("doc_id", F.lit(0).cast("long").alias("tokens"), F.lit(1.0).alias("rate")).where(F.lit(False))
    members = cut(model.posteriors(read).select("doc_id", "_tokens", "_p"))
    history = fit_rates(members, targets_of(members, model.domains, weights, shares))
    return _rated(members, history).select(
        "doc_id", F.col("_tokens").alias("tokens"),
        *[F.element_at("_p", i + 1).alias(f"p_{d}") for i, d in enumerate(model.domains)], F.col("_rate").alias("rate"),
    )


def limit_of(scored: DataFrame) -> float:
    """The posterior over which fewest rows of ``scored(p, member)`` are told wrong: the middle of the widest gap between
    neighbouring values that reaches this, the lowest of equals.  Exact, by running totals over the distinct values.
    """
    ends = scored.sparkSession.createDataFrame([(0.0, None), (1.0, None)], "p double, member boolean")
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    counts = scored.select("p", "member").unionByName(ends).groupBy("p").agg(n(F.col("member")).alias("m"), n(~F.col("member")).alias("o"))
    at = running_totals(counts, [], "p", ["m", "o"])
    # a gap starts at one value and ends at the next: told wrong are the members up to its start and the others from its end
    start = (F.col("m_before") + F.col("m") + F.col("o_total") - F.col("o_before") - F.col("o")).alias("wrong")
    end = (F.col("m_before") + F.col("o_total") - F.col("o_before")).alias("wrong")
    sides = at.where("p < 1").select("p", F.lit(0).alias("side"), start).unionByName(at.where("p > 0").select("p", F.lit(1).alias("side"), end))
    best = sides.where(F.col("wrong") == sides.agg(F.min("wrong")).scalar()).select("side", "p", F.lit(1).alias("k"))
    # gaps do not overlap, so the first start belongs to the first end
    gaps = running_totals(best, ["side"], "p", ["k"]).groupBy("k_before").agg(F.min("p").alias("a"), F.max("p").alias("b"))
    widest = gaps.agg(F.min_by(F.struct("a", "b"), F.struct((F.col("a") - F.col("b")).alias("w"), "a")).alias("g")).first()["g"]
    return (widest["a"] + widest["b"]) / 2


def limits(model: Classifier, rows: DataFrame, unwanted: list[str]) -> dict[str, float]:
    """Posterior over which a document belongs to a domain, from all labelled ``rows`` that the classifier has not seen.

    The limit is ``LEAST`` at least, so what goes is more likely of the domain than not; a domain that is missing on
    either side gets just that.
    """
    seen = stored(model.posteriors(rows.select("domain", "_tokens", "_b")).select("domain", "_p"))
    domains = {r["domain"] for r in seen.select("domain").distinct().collect()}
    out = {}
    for d in unwanted:
        known = d in model.domains and d in domains and len(domains) > 1
        p = F.element_at("_p", model.domains.index(d) + 1).alias("p") if known else None
        out[d] = max(LEAST, limit_of(seen.select(p, (F.col("domain") == d).alias("member")))) if known else LEAST
    return out


def drawn(docs: DataFrame, labels: DataFrame, shares: dict[str, float], snap: float = 0.1, least: float = 0.0,
          settled: float = SETTLED) -> DataFrame:
    """The input's rows, each as often as its rate says: whole part, and one more with the probability of the rest.

    A document of a domain with share 0 goes: its posterior is over a limit calibrated on labelled documents, whatever
    the rest of the corpus is.  Rates are fitted over the others, whose posteriors are shared out among the domains that
    stay.  The draw is by a hash of doc_id and text.  A rate within ``snap`` of a whole number counts as that number.
    With ``least`` at 1 no document of a domain that stays is lost: what has to grow is repeated, nothing is thinned.
    """
    read = _read(packed(docs, "doc_id", "text").select(
        ROW, "doc_id", F.xxhash64("text").alias("_hash"), F.coalesce("text", F.lit("")).alias("_text")
    ))
    known = _known(read, labels)
    part = F.pmod(F.xxhash64(F.lit("limit"), "_hash"), F.lit(3))  # one text in three tells the limits, the others fit
    model = _fitted(known.where(part > 0)) or _fitted(known)
    if model is None:
        return docs
    # written once with the posteriors, before anything asks for them: a filter above the scoring would repeat it in
    # each of its conditions.  The steps read the narrow columns, the draw reads the rows
    scored = stored(model.posteriors(read))
    gone = [d for d in model.domains if shares.get(d, 0.0) == 0.0]
    stay = [d for d in model.domains if d not in gone]
    if gone and stay:
        p = {d: F.element_at("_p", i + 1) for i, d in enumerate(model.domains)}
        for d, limit in limits(model, known.where(part == 0), gone).items():
            scored = scored.where(p[d] <= limit)
        whole = sum((p[d] for d in stay), F.lit(0.0))
        scored = scored.withColumn("_p", F.array(*[F.when(whole > 0, p[d] / whole).otherwise(1.0 / len(stay)) for d in stay]))
    rated = _rated(scored, fit_rates(scored, targets_of(scored, stay or gone, None, shares), least, settled), least)
    near = F.when(F.abs(F.col("_rate") - F.round("_rate")) <= snap, F.round("_rate")).otherwise(F.col("_rate"))
    draw = F.pmod(F.xxhash64(F.lit("draw"), "doc_id", "_hash"), F.lit(1 << 30)) / float(1 << 30)
    times = rated.withColumn("_times", F.floor(near + draw).cast("int"))
    kept = times.where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return unpacked(kept)
