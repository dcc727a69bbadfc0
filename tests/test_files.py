"""CSV and JSON sources, sinks and the run log, in a temporary folder."""

import datetime as dt

import pytest

from bazaar.operators import loading as L
from bazaar.sources import files


def _write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


def test_column_names_and_years():
    assert files.column_name("  Final Amount (INR) ") == "final_amount_inr"
    assert files.column_name(" Base Price (2015)", only_word_characters=False) == "base_price_(2015)"
    assert files.source_year("/x/shop_2019.csv") == 2019 and files.source_year("/x/shop.csv") is None


def test_yearly_files(spark, tmp_path):
    _write(tmp_path, "shop_2019.csv", 'Order ID,Final Amount (INR)\n1,"1,200"\n2,5\n')
    _write(tmp_path, "shop_2020.csv", "Order ID,City\n3,Pune\n")
    _write(tmp_path, "shop_2021.csv", "")
    _write(tmp_path, "shop_2022.csv", "Order ID,City\n")
    _write(tmp_path, "other.txt", "x\n")
    rows = files.read_sales(spark, str(tmp_path), "shop_*.csv").orderBy("order_id").collect()
    assert [(r["order_id"], r["final_amount_inr"], r["city"], r["source_year"]) for r in rows] == [
        ("1", "1,200", None, 2019), ("2", "5", None, 2019), ("3", None, "Pune", 2020)]


def test_file_without_year(spark, tmp_path):
    _write(tmp_path, "shop.csv", "a\n1\n")
    assert files.read_sales(spark, str(tmp_path)).columns == ["a"]


def test_missing_and_unusable_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_sales(spark, str(tmp_path), "*.csv")
    _write(tmp_path, "shop_2019.csv", "")  # Spark's listing leaves files without bytes out
    with pytest.raises(FileNotFoundError):
        files.read_sales(spark, str(tmp_path), "*.csv")
    _write(tmp_path, "shop_2020.csv", "a,b\n")
    with pytest.raises(ValueError):
        files.read_sales(spark, str(tmp_path), "*.csv")
    with pytest.raises(FileNotFoundError):
        files.read_catalog(spark, str(tmp_path / "none.csv"))


def test_catalog_json_and_bound_sql(spark, tmp_path):
    _write(tmp_path, "catalog.csv", "Product ID,Weight (kg)\nP1,2\n")
    assert files.read_catalog(spark, str(tmp_path / "catalog.csv")).columns == ["product_id", "weight_(kg)"]
    _write(tmp_path, "a.json", '{"threshold": 0.5,\n "names": ["x", "y"]}')
    row = files.read_json(spark, str(tmp_path / "a.json")).first()
    assert row["threshold"] == 0.5 and row["names"] == ["x", "y"]
    assert files.query(spark, "SELECT :a + 1 AS v, :b AS w", a=2, b="it's").first().asDict() == {"v": 3, "w": "it's"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "k int, s string")
    files.write_csv(df, str(tmp_path / "c"))
    got = spark.read.options(**files.CSV_OPTIONS).csv(str(tmp_path / "c")).orderBy("k").collect()
    assert [(r["k"], r["s"]) for r in got] == [("1", 'a "b", c'), ("2", None)]
    files.write_parquet(df, str(tmp_path / "p"), "k")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_run_log_keeps_all_and_shows_the_last(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(5):
        L.append_run(spark.createDataFrame([(i,)], "dates_fixed int"), path, dt.datetime(2024, 1, 1 + i))
    got = [r["dates_fixed"] for r in L.last_runs(spark, path, 3).collect()]
    assert got == [4, 3, 2] and L.last_runs(spark, path).count() == 5


FACT = "transaction_id string, order_year int, amount double, at int"


def test_fact_load_is_idempotent_and_moves_rows(spark, tmp_path):
    path = str(tmp_path / "fact")
    load = lambda rows: L.load_facts(spark, path, spark.createDataFrame(rows, FACT), ["transaction_id"], ["at"])
    assert load([]) == 0
    assert load([("a", 2019, 1.0, 1), ("b", 2019, 2.0, 1), ("c", 2020, 3.0, 1), ("a", 2019, 9.0, 2)]) == 3
    for _ in range(2):
        assert load([("b", 2020, 5.0, 3), ("d", 2021, 6.0, 3)]) == 2
        got = sorted(tuple(r) for r in spark.read.parquet(path).select("transaction_id", "order_year", "amount").collect())
        assert got == [("a", 2019, 9.0), ("b", 2020, 5.0), ("c", 2020, 3.0), ("d", 2021, 6.0)]


def test_upsert_without_a_table_takes_the_last_row(spark):
    rows = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1)], "k int, v string, at int")
    assert sorted((r["k"], r["v"]) for r in L.upsert(None, rows, ["k"], ["at"]).collect()) == [(1, "y"), (2, "z")]


def test_fact_commit_is_one_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "committed")
    commit = lambda rows: L.commit_facts(spark, path, spark.createDataFrame(rows, FACT), ["transaction_id"], ["at"])
    told = lambda: sorted((r["transaction_id"], r["order_year"], r["amount"]) for r in L.current_facts(spark, path).collect())
    assert L.current_facts(spark, path) is None and commit([]) == 0
    assert commit([("a", 2019, 1.0, 1), ("b", 2019, 2.0, 1), ("c", 2020, 3.0, 1)]) == 3
    before = told()
    with monkeypatch.context() as m:  # the run dies between the data and the commit
        m.setattr(spark.__class__, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            L.commit_facts(spark, path, spark.range(1).selectExpr("'c' AS transaction_id", "2021 AS order_year", "9.0D AS amount", "5 AS at"),
                           ["transaction_id"], ["at"])
    assert told() == before
    for _ in range(2):  # a year may be left empty, and a second time changes nothing
        assert commit([("c", 2021, 9.0, 5)]) == 1
        assert told() == [("a", 2019, 1.0), ("b", 2019, 2.0), ("c", 2021, 9.0)]
    with pytest.raises(ValueError):
        commit([("d", None, 1.0, 1)])
