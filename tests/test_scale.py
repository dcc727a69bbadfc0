"""Steps that have to grow no faster than their input: what is stored, what is shuffled, and that results stay whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.operators import cleaning as C


def test_cleaning_stores_parquet_and_only_gaps_meet_the_product_medians(spark):
    raw = spark.createDataFrame(
        [("T1", "0099-01-02", "p", "4", "10", "s"), ("T2", "2015-03-04", "p", "2 stars", "20", "s"), ("T3", "2015-03-04", "p", None, None, "s"),
         ("T4", "x", "q", None, "30", None), ("T4", "x", "q", None, "30", None), ("T2_DUP", "2015-03-04", "p", "2", "20", "s"),
         ("T5", "2015-03-04", None, None, "40", "t")],
        "transaction_id string, order_date string, product_id string, customer_rating string, original_price_inr string, subcategory string")
    parsed = C.parse_stage(raw)
    assert parsed.inputFiles() and all(f.endswith(".parquet") for f in parsed.inputFiles())
    got = {r["transaction_id"]: (str(r["order_date"]), r["customer_rating"], r["original_price_inr"]) for r in C.clean_sales(raw).collect()}
    assert got == {"T1": ("0099-01-02", 4.0, 10.0), "T2": ("2015-03-04", 2.0, 20.0), "T3": ("2015-03-04", 2.0, 20.0),
                   "T4": ("1900-01-01", None, 30.0), "T5": ("2015-03-04", None, 40.0)}
    assert C.clean_sales(raw).count() == 5


def test_pairs_of_baskets_that_straddle_batches_and_partitions(spark):
    import random

    from bazaar.operators import kpis

    rng = random.Random(5)
    rows = [(t, rng.randrange(1, 40)) for t in range(30) for _ in range(rng.randrange(1, 6))] + [(99, rng.randrange(1, 2000)) for _ in range(1500)]
    kind = {p: "abcd"[p % 4] for p in range(2000)}
    fact = spark.createDataFrame(rows, "transaction_id bigint, product_id bigint")
    products = spark.createDataFrame(list(kind.items()), "product_id bigint, subcategory string")
    lines: dict[str, int] = {}
    for _, p in rows:
        lines[kind[p]] = lines.get(kind[p], 0) + 1
    top = sorted(lines, key=lambda s: (-lines[s], s))[:3]
    want: dict[tuple[str, str], int] = {}
    by: dict[int, list[int]] = {}
    for t, p in rows:
        if kind[p] in top:
            by.setdefault(t, []).append(p)
    for items in by.values():
        for x in items:
            for y in items:
                if x < y:
                    want[kind[x], kind[y]] = want.get((kind[x], kind[y]), 0) + 1
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((r["cat_a"], r["cat_b"], r["co_count"]) for r in kpis.copurchase_matrix(fact, products, 3).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[0])
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old[1])
    assert got == sorted([(a, b, n) for (a, b), n in want.items()] + [(b, a, n) for (a, b), n in want.items()])
    assert not hasattr(kpis.copurchase_matrix, "bucket_width") and "bucket_width" not in kpis.copurchase_matrix.__code__.co_varnames


def test_age_pivot_reads_its_pairs_once(spark):
    from pyspark.sql import functions as F

    from bazaar.operators import eda

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def told(x):
        seen.add(1)
        return x

    pairs = spark.createDataFrame([("18-25", "a", 1.0), ("26-35", "b", 2.0)], "customer_age_group string, subcategory string, x double")
    got = eda.age_pivot(pairs.select("customer_age_group", "subcategory", told(F.col("x") + F.rand() * 0).alias("revenue_m"))).collect()
    assert len(got) == 4 and seen.value == 2


def test_health_joins_facts_once(spark, monkeypatch):
    from bazaar.plans import derived_q, named

    from .conftest import SF001

    loaded = []
    for m in (derived_q, named):
        real = m.load_star
        monkeypatch.setattr(m, "load_star", lambda *a, real=real, **kw: loaded.append(1) or real(*a, **kw))
    assert derived_q.SPARK["d5_health"](spark, SF001).count() == 6 and len(loaded) == 1


def test_top_contributions_of_arrays_equal_those_of_rows(spark):
    from pyspark.sql import functions as F

    from bazaar.operators import churn

    rows = spark.createDataFrame([(1, [float((-1) ** i * (i % 4)) for i in range(10)]), (1, [0.5 * i for i in range(10)]), (2, [1.0] * 10), (None, [0.0] * 10)],
                                 "customer_id int, values array<double>")
    long = rows.select("customer_id", F.posexplode("values").alias("j", "value")).select("customer_id", F.get(F.array(*map(F.lit, churn.FEATURES)), F.col("j")).alias("feature"), "value")
    for k in (3, 10):
        a, b = (sorted(d.collect(), key=str) for d in (churn.top_contributions(rows, "customer_id", k), churn.top_contributions(long, "customer_id", k)))
        assert a == b and len(a) == 3


def test_cleaning_shuffles_whole_only_rows_that_may_have_a_copy(spark, monkeypatch):
    """Copies are found whatever their gaps are filled with; the other rows stay where they are."""
    n = 400
    rows = [(f"T{k}", "2015-03-04", f"p{k % 5}", None if k % 7 == 0 else str(k % 5), "n/a" if k % 11 == 0 else str(k % 13), "s" if k % 3 else "t") for k in range(n)]
    rows += [r for k, r in enumerate(rows) if k % 40 == 0] + [(r[0] + "_DUP", *r[1:]) for r in rows[:9]]
    names = ["transaction_id", "order_date", "product_id", "customer_rating", "original_price_inr", "subcategory"]
    # rows that are equal only when filled: 5 is the median of the price, 2 the one of the rating
    twins = [("U", "2015-03-04", "q", r, p, "u") for r in (None, "2") for p in (None, "5")] + [("V", "2015-03-04", "q", "2", p, "u") for p in ("4", "5", "6")]
    raw = spark.createDataFrame(rows + twins, ", ".join(f"{c} string" for c in names)).repartition(6)
    moved = []
    real = C._shared
    monkeypatch.setattr(C, "_shared", lambda df, h: moved.append(real(df, h)) or moved[-1])
    got = C.clean_sales(raw)
    assert moved[0].where("_shared").count() < 2 * (n // 40 + 7)
    whole = C.parse_stage(raw)
    want = whole.where("NOT endswith(transaction_id, '_DUP')").select(*names[:2], "customer_rating", "original_price_inr").distinct()
    assert got.count() == want.count() == n + 4
    assert got.where("transaction_id = 'U'").select("customer_rating", "original_price_inr").collect() == [(2.0, 5.0)]
    log = C.cleaning_log(raw).first()
    assert (log["input_rows"], log["output_rows"], log["duplicates_removed"]) == (len(rows) + 7, n + 4, 9 + n // 40 + 3)
    # the log's rows hold flags, no second form of a text
    counted = C._counted(C.parse_values(raw.withColumn("customer_city", F.lit("bombay")).withColumn("delivery_days", F.lit("x"))))
    assert all(kind == "boolean" for name, kind in counted.dtypes if name.startswith("_"))


def test_dirty_extract_is_shuffled_before_anything_is_derived(spark):
    """The rows that meet orders and products have the tables' columns only."""
    plan = C.dirty_sales(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    top, *below = plan.toString().split("Join Inner")
    for derived in ("TXN", "Navratri", "customer_tier", "lpad"):
        assert derived in top and derived not in "".join(below[:3])


def test_intermediates_free_their_shuffles(spark):
    from pyspark.sql import functions as F

    from bazaar.session import FREES_SHUFFLES, frees_shuffles, stored

    def left():
        root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f.getName() for f in (root.getAllFiles().apply(i) for i in range(root.getAllFiles().size())) if f.getName().startswith("shuffle_")}

    table = spark.range(5000).groupBy(F.pmod("id", F.lit(977)).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    before = left()
    with frees_shuffles(spark):
        kept = stored(table)
    new = left() - before
    assert kept.count() == 977 and not new
    assert spark.conf.get(FREES_SHUFFLES) == "false"
