import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from storelake.operators import dims, facts, incremental
from storelake.plans import retail_views as views
from storelake.schemas import CUSTOMERS, TRANSACTIONS
from storelake.sinks.files import stored


def transaction(**changed):
    base = dict(
        transaction_id="T1", customer_id="C1", product_id="P1", order_date="2024-01-02", order_value=10.0,
        payment_method="UPI", device_type="web", discount_applied=0.0, shipping_delay_days=1, fraud_label=0,
    )
    return tuple({**base, **changed}.values())


def transactions(spark, *rows):
    return spark.createDataFrame([transaction(**r) for r in rows], TRANSACTIONS)


def test_dates_in_many_forms(spark):
    texts = ["2024-01-02", "2024-1-2", "2024-01-02T10:00:00", "UNKNOWN", "2024-02-30", "", None]
    df = transactions(spark, *[dict(order_date=t) for t in texts])
    assert [(r.date_key, r.full_date) for r in dims.dim_date(df).collect()] == [(20240102, date(2024, 1, 2))]


def test_weekends_and_names(spark):
    df = transactions(spark, *[dict(order_date=f"2024-03-{d:02}") for d in (8, 9, 10, 11)])
    got = {r.day: (r.day_of_week, r.is_weekend) for r in dims.dim_date(df).collect()}
    assert got == {
        8: ("Friday", False), 9: ("Saturday", True), 10: ("Sunday", True), 11: ("Monday", False),
    }
    row = dims.dim_date(df).first()
    assert (row.month, row.month_name, row.quarter, row.year) == (3, "March", 1, 2024)


def test_surrogate_key_is_sha256(spark):
    df = transactions(spark, {}, dict(payment_method=None), dict(payment_method="UPI"))
    rows = dims.dim_payment(df).collect()
    assert [(r.payment_method_key, r.payment_method) for r in rows] == [
        (hashlib.sha256(b"UPI").hexdigest(), "UPI")
    ]


def test_customer_dimension(spark):
    rows = [
        ("C1", 30, "F", "FR", "2024-01-05", 1.0, 2.0, 0),
        ("C1", 30, "F", "FR", "never", 1.0, 2.0, 0),
        ("C2", None, None, None, "never", None, None, None),
    ]
    got = {r.customer_id: r for r in dims.dim_customer(spark.createDataFrame(rows, CUSTOMERS)).collect()}
    assert got["C1"].registration_date == date(2024, 1, 5)
    assert got["C2"].registration_date is None
    assert got["C2"].customer_key == hashlib.sha256(b"C2").hexdigest()


def test_net_value_keeps_float(spark):
    df = transactions(spark, dict(order_value=10.1, discount_applied=0.1))
    net = df.select(facts.net_value(df).alias("net"))
    assert net.schema["net"].dataType.simpleString() == "float"
    assert net.first().net == pytest.approx(9.09, abs=1e-5)


def test_missing_keys_are_null_and_rows_stay(spark, run_ts):
    df = transactions(spark, {}, dict(customer_id="C9"), dict(customer_id=None), dict(order_date="UNKNOWN"))
    customers = spark.createDataFrame([("C1",)], "customer_id string").withColumn("customer_key", F.lit("k"))
    products = spark.createDataFrame([], "product_id string, product_key string")
    fact = facts.fact_transactions(df, customers, products, dims.dim_payment(df), "INITIAL", run_ts)
    rows = fact.collect()
    assert len(rows) == 4
    assert sorted((r.customer_id or "", r.customer_key) for r in rows) == [
        ("", None), ("C1", "k"), ("C1", "k"), ("C9", None),
    ]
    assert all(r.product_key is None and r.payment_method_key for r in rows)
    assert sorted(str(r.date_key) for r in rows) == ["20240102"] * 3 + ["None"]
    assert {(r.load_type, r.ingested_at) for r in rows} == {("INITIAL", rows[0].ingested_at)}


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_joins_neither_fan_out_nor_lose_rows(spark, run_ts, folder):
    txn, behavior = views.transactions(spark, folder), views.behavior(spark, folder)
    customers = stored(dims.dim_customer(views.customers(spark, folder)))
    products = stored(dims.dim_product(views.products(spark, folder)))
    payments = stored(dims.dim_payment(txn))
    for dim, key in ((customers, "customer_id"), (products, "product_id"), (payments, "payment_method")):
        assert dim.count() == dim.select(key).distinct().count()
    fact = stored(facts.fact_transactions(txn, customers, products, payments, "INITIAL", run_ts))
    assert fact.count() == txn.count()
    assert fact.filter("payment_method_key is null or date_key is null").isEmpty()
    assert facts.fact_behavior(behavior, customers, "INITIAL", run_ts).count() == behavior.count()


def final_plan(df):
    df.toPandas()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def skewed(spark):
    """A third of all rows under one customer, and a third under one product; some dimension rows are missing."""
    n = F.col("id")
    txn = stored(
        spark.range(60000).select(
            F.concat(F.lit("T"), n).alias("transaction_id"),
            F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("C"), n % 1000)).alias("customer_id"),
            F.when(n % 3 == 1, "hot").otherwise(F.concat(F.lit("P"), n % 1000)).alias("product_id"),
            F.lit("2024-01-02").alias("order_date"),
            F.rand(1).alias("order_value"),
            F.concat(F.lit("M"), n % 40).alias("payment_method"),
            F.lit("web").alias("device_type"),
            F.lit(0.1).alias("discount_applied"),
            F.lit(1).alias("shipping_delay_days"),
            F.lit(0).alias("fraud_label"),
        )
    )
    names = {"customer_id": "customer_key", "product_id": "product_key", "payment_method": "payment_method_key"}
    keyed = [
        stored(txn.select(name).distinct().filter(~F.col(name).endswith("7")).withColumn(key, F.sha2(name, 256)))
        for name, key in names.items()
    ]
    return txn, keyed


def test_hot_keys_are_split(skewed, run_ts, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    )
    txn, keyed = skewed
    fact = facts.fact_transactions(txn, *keyed, "INITIAL", run_ts)
    assert final_plan(fact).count("SortMergeJoin(skew=true)") >= 2
    assert fact.count() == 60000


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_the_join_strategy_does_not_change_the_fact(skewed, run_ts, conf, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    txn, keyed = skewed
    nulls = txn.limit(5).withColumns({"customer_id": F.lit(None).cast("string"), "product_id": F.lit("gone")})
    fact = stored(facts.fact_transactions(stored(txn.union(nulls)), *keyed, "INITIAL", run_ts))
    assert fact.count() == 60005
    for name, key in (("customer_id", "customer_key"), ("product_id", "product_key")):
        assert fact.filter(f"{key} is null").count() > 5
        assert fact.filter(f"{key} <> sha2({name}, 256)").isEmpty()


@pytest.mark.parametrize("rows", [50_000, 50_001])
def test_the_size_of_a_dimension_does_not_change_the_join(spark, rows):
    ids = F.concat(F.lit("C"), F.col("id"))
    dim = stored(spark.range(rows - 1).select(ids.alias("customer_id"), F.lit("k").alias("customer_key")))
    twice = stored(dim.union(spark.createDataFrame([("C1", "k2")], dim.schema)))
    fact = spark.createDataFrame([("C1",), ("gone",), (None,)], "customer_id string")
    found = facts.add_key(fact, twice, "customer_id", "customer_key").collect()
    assert sorted((r.customer_id or "", r.customer_key or "") for r in found) == [("", ""), ("C1", "k"), ("C1", "k2"), ("gone", "")]


def test_small_dimensions_are_broadcast_by_size(spark, run_ts):
    txn = views.transactions(spark, SMALL)
    customers = stored(dims.dim_customer(views.customers(spark, SMALL)))
    plan = final_plan(facts.add_key(txn, customers, "customer_id", "customer_key"))
    assert "BroadcastHashJoin [customer_id" in plan
    assert "ReadSchema: struct<customer_key:string,customer_id:string>" in plan


def test_a_large_dimension_is_looked_up_without_shuffling_the_facts(spark, conf, monkeypatch):
    """F1-F7, F9-F15: a dimension above the broadcast threshold had every fact shuffled, once for each such dimension."""
    monkeypatch.setattr(facts, "LARGE", 100)
    monkeypatch.setattr(incremental, "BITS", 1 << 15)  # full enough that some missing keys pass it
    conf(spark__sql__autoBroadcastJoinThreshold="30KB", spark__sql__adaptive__autoBroadcastJoinThreshold="30KB")
    n = F.col("id")
    ids = spark.range(6000).select(F.concat(F.lit("C"), n).alias("customer_id"))
    dim = stored(ids.filter(~F.col("customer_id").endswith("7")).withColumn("customer_key", F.sha2("customer_id", 256)))
    rows = ids.union(ids.limit(500)).union(spark.createDataFrame([(None,), ("gone",)], "customer_id string"))
    fact = stored(rows.withColumn("there", F.lit(1)))
    found = facts.add_key(fact, dim, "customer_id", "customer_key")
    assert sorted(found.columns) == ["customer_id", "customer_key", "there"]
    assert "SortMergeJoin" not in final_plan(found)
    plain = fact.join(dim, "customer_id", "left")
    assert found.select(plain.columns).exceptAll(plain).isEmpty() and found.count() == plain.count()


@pytest.mark.parametrize("odd", [("C1", "other"), ("C1", None), (None, "k")])
def test_a_large_dimension_with_other_keys_keeps_them(spark, monkeypatch, odd):
    monkeypatch.setattr(facts, "LARGE", 5)
    ids = spark.range(10).select(F.concat(F.lit("C"), F.col("id")).alias("customer_id"))
    dim = stored(ids.withColumn("customer_key", F.sha2("customer_id", 256)).union(spark.createDataFrame([odd], "a string, b string")))
    fact = spark.createDataFrame([("C1",), ("gone",), (None,)], "customer_id string")
    found = facts.add_key(fact, dim, "customer_id", "customer_key").collect()
    plain = fact.join(dim, "customer_id", "left").collect()
    assert sorted(map(str, found)) == sorted(map(str, plain))
