"""Every registered query against its SQL on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import MEDIUM
from oracle_check import compare, connect
from storelake.operators.validation import REQUIRED_FIELDS
from storelake.plans import retail_views as views
from storelake.plans.catalog import QUERIES
from storelake.sinks.files import stored


@pytest.fixture(scope="module")
def database():
    return connect(MEDIUM)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    problem, rows, _ = compare(spark, database, MEDIUM, name, queries()[name], oracle_sql()[name])
    assert problem is None
    assert rows > 0


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(set(oracle_sql()) & set(QUERIES))
    assert set(QUERIES) <= set(queries())


def test_entry_is_the_transaction_fact(spark):
    fact = entry(spark)
    assert fact.columns[:4] == ["customer_key", "product_key", "payment_method_key", "date_key"]
    assert fact.count() > 0


# The branches that the queries are there for, each of which has to occur in the data.
BRANCHES = [
    ("fact_transactions", "customer_key is null"),
    ("fact_transactions", "product_key is null"),
    ("fact_behavior", "customer_key is null"),
    ("initial_load", "customer_key is null and product_key is null"),
    ("initial_behavior", "customer_key is null"),
    ("incremental_load", "product_key is null"),
    ("dim_customer", "registration_date is null"),
    ("validate_range", "message like '%greater than 0'"),
    ("validate_range", "message like '%less than 10000'"),
    ("validate_optional", "message like 'discount%; shipping%'"),
    ("stream_rejections", "index = 1"),
    ("initial_line_breaks", "device_type like '%\n%'"),
    *[("validate_required_fields", f"message like '%{name}'") for name in REQUIRED_FIELDS],
]


@pytest.mark.parametrize("name", sorted({name for name, _ in BRANCHES}))
def test_branches_occur(spark, name):
    rows = stored(QUERIES[name](spark, MEDIUM))
    for condition in [c for n, c in BRANCHES if n == name]:
        assert rows.filter(condition).count() > 0, condition


def test_repeated_customers_collapse(spark):
    assert views.repeated_customers(spark, MEDIUM).count() > QUERIES["dim_customer"](spark, MEDIUM).count()
