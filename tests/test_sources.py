"""Readers and writers: CSV with the published layout, Parquet round trip,
model save / load."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from churnscope.sources import (edge_transactions, load_model, read_rejects, read_transactions,
                                read_written, save_model, transactions_from_events,
                                transactions_from_orders, write_table)
from tests.conftest import SF_SMALL


def test_orders_fixture_contract(spark):
    tx = transactions_from_orders(spark, SF_SMALL)
    assert [f.name for f in tx.schema] == ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate",
                                          "UnitPrice", "CustomerID", "Country"]
    assert tx.schema["UnitPrice"].dataType.simpleString() == "decimal(20,6)"
    ret = tx.filter(F.col("InvoiceNo").startswith("C"))
    assert ret.filter(F.col("Quantity") > 0).count() == 0


def test_events_fixture_has_times_of_day(spark):
    tx = transactions_from_events(spark, SF_SMALL)
    assert tx.filter(F.hour("InvoiceDate") != 0).count() > 0


def test_csv_round_trip(spark):
    out = tempfile.mkdtemp(prefix="cs-csv-")
    tx = edge_transactions(spark)
    text = tx.select(
        "InvoiceNo", "StockCode", F.lit("desc").alias("Description"),
        F.col("Quantity").cast("string").alias("Quantity"),
        F.date_format("InvoiceDate", "M/d/yyyy H:mm").alias("InvoiceDate"),
        F.col("UnitPrice").cast("string").alias("UnitPrice"),
        F.concat(F.col("CustomerID").cast("string"), F.lit(".0")).alias("CustomerID"), "Country")
    write_table(text, out, fmt="csv")
    back = read_transactions(spark, out, fmt="csv")
    assert back.count() == tx.count()
    a = sorted(tuple(r) for r in tx.filter(F.col("CustomerID").isNotNull())
               .select("CustomerID", "InvoiceDate", "UnitPrice").collect())
    b = sorted(tuple(r) for r in back.filter(F.col("CustomerID").isNotNull())
               .select("CustomerID", "InvoiceDate", "UnitPrice").collect())
    assert a == b


def test_parquet_round_trip_sorted(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="cs-pq-"), "t")
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    write_table(df, out, order_by=[F.desc("v"), "id"])
    assert read_written(spark, out).count() == 100


def test_model_save_load(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(float(i), i % 2) for i in range(40)], "x double, is_churned int")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression(labelCol="is_churned")]).fit(df)
    path = tempfile.mkdtemp(prefix="cs-model-")
    save_model([("a", model), ("b", model)], path, ["x"], "Ensemble", 0.4, {"auc": 0.5}, spark)
    loaded, meta = load_model(spark, path)
    assert meta.model_name == "Ensemble" and meta.features == ["x"] and list(loaded) == ["a", "b"]
    assert loaded["b"].transform(df).count() == 40


def _csv(tmp_path, *lines):
    path = tmp_path / "tx.csv"
    path.write_text("\n".join(["StockCode,InvoiceNo,Extra,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country", *lines]) + "\n",
                    encoding="ISO-8859-1")
    return str(path)


def test_csv_quotes_header_order_and_exact_prices(spark, tmp_path):
    path = _csv(tmp_path, 'A,1,x,"CHARLIE+LOLA""EXTREMELY, BUSY"" SIGN",6,12/1/2010 8:26,0.001,17850.0,UK',
                'B,2,x,"caf\xe9, ""x""",100,2010-12-01 08:26:00,1.055,2,UK', 'C,3,x,d,6.0,2010-12-01,2.55,,UK')
    rows = {r.InvoiceNo: r for r in read_transactions(spark, path).collect()}
    assert [(r.StockCode, r.Quantity, str(r.UnitPrice), r.CustomerID) for r in (rows["1"], rows["2"], rows["3"])] == [
        ("A", 6, "0.001000", 17850), ("B", 100, "1.055000", 2), ("C", 6, "2.550000", None)]
    from churnscope.operators.clean import valid_sales
    from churnscope.functions.columns import money
    got = {r.InvoiceNo: r.amount for r in valid_sales(read_transactions(spark, path))
           .select("InvoiceNo", money(F.col("amount_units")).alias("amount")).collect()}
    assert got == {"1": 0.006, "2": 105.5}


def test_unreadable_values_are_never_dropped_in_silence(spark, tmp_path):
    import pytest
    path = _csv(tmp_path, "A,1,x,d,6,12/1/2010 8:26,2.5,1,UK", "A,2,x,d,6.5,12/1/2010 8:26,2.5,1,UK", "A,3,x,d,6,soon,2.5,1,UK",
                "A,4,x,d,6,12/1/2010 8:26,0.0000001,1,UK", "A,5,x,d,6,12/1/2010 8:26,2.5,abc,UK", "A,6,x,d,,12/1/2010 8:26,,1,UK")
    with pytest.raises(Exception, match="unreadable"):
        read_transactions(spark, path).collect()
    assert [r.InvoiceNo for r in read_transactions(spark, path, on_reject="skip").collect()] == ["1"]
    assert sorted(r.reject for r in read_rejects(spark, path).collect()) == [
        "CustomerID", "InvoiceDate", "Quantity", "Quantity,UnitPrice", "UnitPrice"]


def test_missing_columns_are_named(spark, tmp_path):
    import pytest
    path = tmp_path / "x.csv"
    path.write_text("InvoiceNo,Quantity\n1,2\n")
    with pytest.raises(ValueError, match="UnitPrice"):
        read_transactions(spark, str(path))


def test_rounding_is_half_even_at_any_size(spark):
    from churnscope.functions.columns import round_even
    rows = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (1000000000000.128,), (-0.125,)], "x double")
    got = [r[0] for r in rows.select(round_even(F.col("x"), 2)).collect()]
    assert got == [0.12, 0.38, 2.5, 1000000000000.13, -0.12]


def test_money_is_the_nearest_double_beyond_2_53(spark):
    from decimal import Decimal
    from churnscope.functions.columns import money
    for n in (1, 123456789, 2 ** 53 + 1, 10 ** 18 + 7):
        got = spark.createDataFrame([(n,)], "n long").select(money(F.col("n"))).first()[0]
        assert got == float(Decimal(n) / 10 ** 6)


def test_runs_of_different_size_are_sized_apart(spark):
    from churnscope.session import size_shuffles
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        small = size_shuffles(spark, transactions_from_events(spark, SF_SMALL))
        large = size_shuffles(spark, transactions_from_orders(spark, "/root/testdata/sf0.1"), target_bytes=1 << 20)
        assert small == 2 * spark.sparkContext.defaultParallelism < large == int(spark.conf.get(key))
        assert size_shuffles(spark, transactions_from_events(spark, SF_SMALL)) == small
    finally:
        spark.conf.unset(key)


def test_fail_mode_raises_whatever_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "bad-date.csv")
    with open(path, "w") as f:
        f.write("InvoiceNo,StockCode,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                "1,a,2,12/1/2010 8:26,1.5,7,X\n2,b,3,someday,2.5,8,Y\n")
    tx = read_transactions(spark, path)
    for action in (lambda: tx.count(), lambda: tx.groupBy("Country").count().collect(), lambda: tx.agg(F.max("InvoiceDate")).collect(),
                   lambda: tx.select("StockCode").collect()):
        with pytest.raises(Exception, match="unreadable InvoiceDate"):
            action()
    assert read_transactions(spark, path, on_reject="skip").count() == 1
