"""Dimensions of the star schema."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.keys import date_key, surrogate_key
from storelake.operators.clean import dedup_by_key
from storelake.schemas import GOLD_COLUMNS


def dim_customer(customers: DataFrame) -> DataFrame:
    one_each = dedup_by_key(customers, ["customer_id"])
    keyed = one_each.withColumns(
        {
            "customer_key": surrogate_key("customer_id"),
            "registration_date": F.try_to_date("registration_date"),
        }
    )
    return keyed.select(GOLD_COLUMNS["dim_customer"])


def dim_product(products: DataFrame) -> DataFrame:
    one_each = dedup_by_key(products, ["product_id"])
    return one_each.withColumn("product_key", surrogate_key("product_id")).select(GOLD_COLUMNS["dim_product"])


def dim_payment(transactions: DataFrame) -> DataFrame:
    methods = transactions.select("payment_method").filter("payment_method is not null").distinct()
    return methods.select(surrogate_key("payment_method").alias("payment_method_key"), "payment_method")


def dim_date(transactions: DataFrame) -> DataFrame:
    """The dates on which orders were placed, not a full calendar."""
    dates = transactions.select(F.try_to_date("order_date").alias("full_date")).distinct()
    day = F.col("full_date")
    return dates.filter(day.isNotNull()).select(
        date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )
