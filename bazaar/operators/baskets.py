"""Market baskets, frequent itemsets, association rules, recommendations.

Frequent itemsets come from Spark ML's distributed FP-Growth (PFP).  Rules are
expanded from the itemsets for **every** antecedent/consequent split (Spark's
own ``associationRules`` only emits single-item consequents), and the
supports of both sides are looked up by an equi-join on the sorted item array.
Work is bounded by the itemsets, not by the baskets.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut

SUPPORT_CANDIDATES = [0.005, 0.002, 0.001]


def baskets(fact: DataFrame, products: DataFrame, key: str = "transaction_id", item: str = "subcategory") -> DataFrame:
    """One row per basket with its sorted distinct items (basket key is a parameter, quirk Q8)."""
    j = fact.select(key, "product_id").join(products.select("product_id", item).where(F.col(item).isNotNull()),
                                            "product_id")
    return j.groupBy(key).agg(F.array_sort(F.collect_set(item)).alias("items"))


def popularity(fact: DataFrame, products: DataFrame, k: int = 50, key: str = "transaction_id") -> DataFrame:
    """Distinct baskets per subcategory, top-k, with rank (cold-start list)."""
    j = fact.select(key, "product_id").join(products.select("product_id", "subcategory")
                                            .where(F.col("subcategory").isNotNull()), "product_id")
    p = j.groupBy("subcategory").agg(F.countDistinct(key).alias("n_transactions"))
    w = Window.orderBy(F.desc("n_transactions"), "subcategory")
    return p.orderBy(F.desc("n_transactions"), "subcategory").limit(k).withColumn("pop_rank", F.row_number().over(w))


def frequent_itemsets(bk: DataFrame, min_support: float) -> DataFrame:
    """FP-Growth itemsets (items sorted) with their basket counts."""
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(bk)
    return model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").cast("bigint").alias("freq"))


def all_rules(itemsets: DataFrame, n_baskets, min_lift: float = 1.0) -> DataFrame:
    """Every split A -> C of every frequent itemset (|I| >= 2); support, confidence, lift; lift >= min_lift.

    Antecedents come level by level: an itemset without one of its items, then each of these without one more.  Only
    distinct (itemset, antecedent) pairs go on, so a level never holds more rows than there are splits of its size.
    """
    multi = itemsets.where(F.size("items") >= 2).select("items", F.col("freq").alias("freq_i"))
    largest = itemsets.agg(F.max(F.size("items"))).first()[0] or 0
    level, splits = multi.withColumn("antecedents", F.col("items")), None
    for _ in range(largest - 1):
        level = level.where(F.size("antecedents") >= 2).select(
            "items", "freq_i", F.explode(F.transform("antecedents", lambda x: F.array_remove(F.col("antecedents"), x)))
            .alias("antecedents")).distinct()
        splits = level if splits is None else splits.unionByName(level)
    if splits is None:
        splits = level.limit(0)
    splits = splits.withColumn("consequents", F.array_except("items", "antecedents"))
    sup = itemsets.select(F.col("items").alias("_s_items"), F.col("freq").alias("_s_freq"))
    a = splits.join(sup, splits.antecedents == sup._s_items).withColumnRenamed("_s_freq", "freq_a").drop("_s_items")
    c = a.join(sup, a.consequents == sup._s_items).withColumnRenamed("_s_freq", "freq_c").drop("_s_items")
    n = F.lit(n_baskets).cast("double")
    conf = F.col("freq_i") / F.col("freq_a")
    out = c.select(
        "antecedents", "consequents",
        (F.col("freq_i") / n).alias("support"),
        conf.alias("confidence"),
        (conf / (F.col("freq_c") / n)).alias("lift"),
    )
    return out.where(F.col("lift") >= min_lift)


def mine_rules(bk: DataFrame, candidates=SUPPORT_CANDIDATES, min_lift: float = 1.0) -> tuple[DataFrame, float | None]:
    """FP-Growth at each support in order; the first one that yields rules wins (None: popularity only).

    The loop runs over the fixed candidate list (three distributed fits at most).  Baskets, itemsets and rules are
    each stored once, so no step runs the fact join again.
    """
    bk = cut(bk)
    n = bk.count()
    rules = None
    for s in candidates:
        rules = cut(all_rules(cut(frequent_itemsets(bk, s)), n, min_lift))
        if not rules.isEmpty():
            return rules, s
    return rules, None


def rank_rules(rules: DataFrame) -> DataFrame:
    """Rules sorted by lift (descending), ties by the item lists, with a rank column."""
    ka, kc = F.array_join("antecedents", "|"), F.array_join("consequents", "|")
    w = Window.orderBy(F.desc("lift"), ka, kc)
    return rules.withColumn("rule_rank", F.row_number().over(w))


def recommend_all(ranked_rules: DataFrame, pop: DataFrame, subjects: DataFrame, n: int = 5) -> DataFrame:
    """For every subcategory of ``subjects(subcategory)``, up to n recommendations.

    Tier 1: the first n rules (by lift) whose antecedents contain the
    subcategory, their consequents other than itself, in rule order (no
    de-duplication inside the tier).  Tier 2: the popularity list (without the
    subcategory and tier-1 items) fills the remaining slots.  Confidence and
    lift are rounded to 4 decimals.  Only the first 2n+1 popularity entries can
    ever be used, so the fill joins against that bounded list.
    """
    subs = subjects.select(F.col("subcategory").alias("s")).where(F.col("s").isNotNull()).distinct()
    ex = ranked_rules.select(F.explode("antecedents").alias("s"), "consequents", "confidence", "lift", "rule_rank")
    m = ex.join(subs, "s")
    m = m.withColumn("_r", F.row_number().over(Window.partitionBy("s").orderBy("rule_rank"))).where(F.col("_r") <= n)
    t1 = m.select("s", "rule_rank", F.posexplode("consequents").alias("pos", "rec"), "confidence", "lift")
    t1 = t1.where(F.col("rec") != F.col("s"))
    t1 = t1.withColumn("_o", F.row_number().over(Window.partitionBy("s").orderBy("rule_rank", "pos")))
    t1 = t1.where(F.col("_o") <= n).select(
        "s", "rec", F.round("confidence", 4).alias("confidence"), F.round("lift", 4).alias("lift"),
        F.lit("association_rules").alias("source"), F.col("_o").cast("bigint").alias("order"))
    top = pop.where(F.col("pop_rank") <= 2 * n + 1).select(F.col("subcategory").alias("rec"), "pop_rank")
    cand = subs.join(F.broadcast(top), F.col("rec") != F.col("s"))  # |subcategories| x (2n+1) rows
    cand = cand.join(t1.select("s", "rec"), ["s", "rec"], "left_anti")
    t2 = cand.select("s", "rec", F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("double").alias("lift"),
                     F.lit("popularity_fallback").alias("source"), (F.lit(1000) + F.col("pop_rank")).alias("order"))
    both = t1.unionByName(t2)
    both = both.withColumn("slot", F.row_number().over(Window.partitionBy("s").orderBy("order")))
    return both.where(F.col("slot") <= n).select(F.col("s").alias("subcategory"), "slot",
                                                 F.col("rec").alias("recommendation"), "confidence", "lift", "source")


def source_mix(recs: DataFrame) -> DataFrame:
    """Recommendation count by source."""
    return recs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
