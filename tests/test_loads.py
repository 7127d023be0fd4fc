from functools import partial

import pytest

from storelake.plans import loads
from storelake.schemas import BATCH_TABLES, GOLD_COLUMNS, GOLD_TABLES
from storelake.sinks.files import stored

CUSTOMERS = [("C1", 30, "F", "FR", "2024-01-05", 1.5, 2.5, 0), ("C2", 40, "M", "DE", "2024-01-06", 1.5, 2.5, 1)]
PRODUCTS = [("P1", "toys", 9.5, 0.5, 1.0)]
BEHAVIOR = [("C1", 1.0, 2, 0.5, 0.5, 1, 4.0, 0)]
TRANSACTIONS = [
    ("T1", "C1", "P1", "2024-01-02", 10.0, "UPI", "web", 0.5, 1, 0),
    ("T2", "C3", "P2", "2024-01-03", 20.0, "Crypto", "app", 0.0, 2, 1),
]


def sources(spark, **changed):
    rows = dict(customers=CUSTOMERS, products=PRODUCTS, behavior=BEHAVIOR, transactions=TRANSACTIONS)
    rows.update(changed)
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in BATCH_TABLES.items()}


@pytest.fixture
def lake(tmp_path):
    return loads.Lake(str(tmp_path))


def gold(spark, lake, name):
    return spark.read.parquet(f"{lake.gold}/{name}")


def test_initial_then_incremental(spark, lake, run_ts):
    assert loads.run(spark, "initial", lake, sources(spark), run_ts) == {
        "customers": 2, "products": 1, "behavior": 1, "transactions": 2,
    }
    fact = {r.transaction_id: r for r in gold(spark, lake, "fact_transactions").collect()}
    assert fact["T1"].customer_key and fact["T1"].product_key and fact["T1"].net_value == 5.0
    assert fact["T2"].customer_key is None and fact["T2"].product_key is None
    assert fact["T2"].payment_method_key and fact["T2"].date_key == 20240103
    assert {r.load_type for r in fact.values()} == {"INITIAL"}

    late = [("C0", 1, "F", "FR", "2024-01-05", 1.5, 2.5, 0), ("C3", 2, "M", "DE", "2024-01-06", 1.5, 2.5, 1)]
    incoming = sources(
        spark,
        customers=CUSTOMERS + late,
        products=PRODUCTS + [("P2", "food", 1.5, 0.5, 2.0)],
        behavior=BEHAVIOR + [("C2", 1.0, 2, 0.5, 0.5, 1, 4.0, 0), ("C2", 9.0, 2, 0.5, 0.5, 1, 4.0, 0)],
    )
    assert loads.run(spark, "incremental", lake, incoming, run_ts) == {
        "customers": 1, "products": 1, "behavior": 2,
    }
    fact = {r.transaction_id: r for r in gold(spark, lake, "fact_transactions").collect()}
    assert fact["T2"].customer_key and fact["T2"].product_key
    assert {r.load_type for r in fact.values()} == {"INCREMENTAL"}
    assert sorted(r.customer_id for r in gold(spark, lake, "dim_customer").collect()) == ["C1", "C2", "C3"]
    assert gold(spark, lake, "fact_behavior").count() == 3

    assert loads.run(spark, "incremental", lake, incoming, run_ts) == {
        "customers": 0, "products": 0, "behavior": 0,
    }
    assert gold(spark, lake, "fact_transactions").count() == 2


def test_gold_columns_in_load_order(spark, lake, run_ts):
    loads.run(spark, "initial", lake, sources(spark), run_ts)
    assert {name: gold(spark, lake, name).columns for name in GOLD_TABLES} == GOLD_COLUMNS
    types = dict(gold(spark, lake, "fact_transactions").dtypes)
    assert (types["net_value"], types["date_key"], types["ingested_at"]) == ("float", "int", "timestamp")
    assert dict(gold(spark, lake, "dim_customer").dtypes)["registration_date"] == "date"


def test_initial_load_can_be_repeated(spark, lake, run_ts):
    loads.run(spark, "initial", lake, sources(spark), run_ts)
    before = {name: sorted(map(tuple, gold(spark, lake, name).collect()), key=repr) for name in GOLD_TABLES}
    loads.run(spark, "initial", lake, sources(spark), run_ts)
    after = {name: sorted(map(tuple, gold(spark, lake, name).collect()), key=repr) for name in GOLD_TABLES}
    assert before == after


def test_warehouse_receives_the_written_tables(spark, lake, run_ts):
    loaded = {}
    loads.run(spark, "initial", lake, sources(spark), run_ts, lambda df, name: loaded.update({name: df.collect()}))
    assert sorted(loaded) == sorted(GOLD_TABLES)
    for name, rows in loaded.items():
        assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, gold(spark, lake, name).collect()), key=repr)


def test_unconvertible_values_of_an_increment(spark, tmp_path, run_ts):
    incoming = sources(spark)
    text_ages = incoming["customers"].selectExpr(
        "'C9' as customer_id", "'old' as age", "gender", "country", "registration_date", "loyalty_score",
        "lifetime_value", "churn_label",
    ).limit(1)
    for switch, wanted in ((False, 1), (True, 0)):
        lake = loads.Lake(str(tmp_path / str(switch)))
        loads.run(spark, "initial", lake, sources(spark), run_ts)
        load = partial(loads.incremental_load, spark, lake, {**incoming, "customers": text_ages}, run_ts)
        assert load(cast_then_clean=switch)["customers"] == wanted
        ages = spark.read.parquet(f"{lake.silver}/customers").filter("customer_id = 'C9'").collect()
        assert [r.age for r in ages] == [None] * wanted


def test_dirty_rows_do_not_reach_silver(spark, lake, run_ts):
    dirty = TRANSACTIONS + TRANSACTIONS[:1] + [("T3", None, "P1", "2024-01-02", 1.0, "UPI", "web", 0.0, 1, 0)]
    assert loads.run(spark, "initial", lake, sources(spark, transactions=dirty), run_ts)["transactions"] == 2


def test_streamed_rows_are_not_read_by_the_batch(spark, lake, run_ts):
    loads.run(spark, "initial", lake, sources(spark), run_ts)
    names = gold(spark, lake, "fact_transactions").columns
    assert "fraud_label" in names and "high_value_flag" not in names


def test_unknown_mode(spark, lake, run_ts):
    with pytest.raises(ValueError, match="initial, incremental"):
        loads.run(spark, "rebuild", lake, {}, run_ts)


def test_a_failing_job_is_reported(spark):
    def fail():
        raise RuntimeError("no space")

    with pytest.raises(RuntimeError, match="no space"):
        loads.together(spark, good=lambda: 1, bad=fail)


def test_line_breaks_in_one_table(spark, lake, run_ts):
    wordy = [("P1", "toys\nand games", 9.5, 0.5, 1.0)]
    loads.extract(spark, sources(spark, products=wordy), lake)
    assert loads.initial_load(spark, lake, run_ts, multi_line=["products"])["products"] == 1
    assert gold(spark, lake, "dim_product").first().category == "toys\nand games"


def test_watermark_order_of_an_increment(spark, tmp_path, run_ts):
    one, ten = (CUSTOMERS[0][1:], CUSTOMERS[1][1:])
    for order, wanted in (("lexicographic", 0), ("numeric", 1)):
        lake = loads.Lake(str(tmp_path / order))
        loads.run(spark, "initial", lake, sources(spark, customers=[("C9", *one)]), run_ts)
        incoming = sources(spark, customers=[("C9", *one), ("C10", *ten)])
        assert loads.incremental_load(spark, lake, incoming, run_ts, key_order=order)["customers"] == wanted


def test_rows_cut_by_line_breaks_are_an_error(spark, tmp_path, run_ts):
    lake = loads.Lake(str(tmp_path / "cut"))
    tables = {name: stored(spark.createDataFrame([], schema)) for name, schema in BATCH_TABLES.items()}
    tables["customers"] = spark.createDataFrame(
        [("C1", 30, "F", "x\ny", "2020-01-01", 1.0, 2.0, 0)], BATCH_TABLES["customers"]
    )
    with pytest.raises(ValueError, match="customers were extracted"):
        loads.run(spark, "initial", lake, tables, run_ts)
    assert loads.run(spark, "initial", lake, tables, run_ts, multi_line=["customers"])["customers"] == 1


def test_dropped_rows_are_counted_by_reason(spark, tmp_path):
    lake = loads.Lake(str(tmp_path))
    lines = {
        "products": "product_id,category,price,margin_percentage,popularity_score\n"
        "a,x,1.5,1,1\na,x,1.5,1,1\nb,x,bad,1,1\nc,x,,1,1\nd,x,NaN,1,1\ne,x\nf,x,1,1,1,more\n,x,1,1,1\na,x,1.5,1,1\n",
        "customers": "h\n", "behavior": "h\n", "transactions": "h\n",
    }
    for name, text in lines.items():
        (tmp_path / "bronze" / name).mkdir(parents=True)
        (tmp_path / "bronze" / name / "a.csv").write_text(text)
    found = loads.bronze_to_silver(spark, lake)
    assert found["products"] == {"kept": 2, "malformed": 2, "nulls": 3, "repeated": 2}
    assert found["customers"] == {"kept": 0, "malformed": 0, "nulls": 0, "repeated": 0}
    assert sorted(r.product_id for r in spark.read.parquet(f"{lake.silver}/products").collect()) == ["a", "f"]
