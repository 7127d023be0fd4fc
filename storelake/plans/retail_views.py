"""The retail tables as views over an order-management star (customer, part, orders, lineitem, events)."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.schemas import TAGS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customer_id(number: str) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(F.col(number).cast("string"), 9, "0"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    registered = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 900).cast("int"))
    return people.select(
        F.col("c_name").alias("customer_id"),
        (F.col("c_custkey") % 60 + 18).cast("int").alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("n_name").alias("country"),
        registered.cast("string").alias("registration_date"),
        (F.col("c_acctbal") / 100).alias("loyalty_score"),
        F.col("c_acctbal").alias("lifetime_value"),
        (F.col("c_custkey") % 2).cast("int").alias("churn_label"),
    )


def repeated_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of which half come twice, with another score, and some without a readable date."""
    readable = F.when(F.col("age") % 5 != 0, F.col("registration_date")).otherwise("unknown")
    once = customers(spark, folder).withColumn("registration_date", readable)
    again = once.filter("gender = 'F'").withColumn("loyalty_score", F.col("loyalty_score") + 1)
    return again.union(once)


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size").cast("double") / 100).alias("margin_percentage"),
        F.col("p_size").cast("double").alias("popularity_score"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    # Dates and flags are made before the join, which shuffles a few bytes less a row for it.
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_shipdate").cast("date").alias("shipped"),
        "l_linenumber",
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("fraud_label"),
        "l_extendedprice",
        "l_discount",
        "l_returnflag",
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("ordered"), "o_orderpriority"
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("T"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("transaction_id"),
        customer_id("o_custkey").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("ordered").cast("string").alias("order_date"),
        F.col("l_extendedprice").alias("order_value"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_returnflag").alias("device_type"),
        F.col("l_discount").alias("discount_applied"),
        F.date_diff("shipped", "ordered").alias("shipping_delay_days"),
        "fraud_label",
    )


def behavior(spark: SparkSession, folder: str) -> DataFrame:
    errors = F.count_if(F.col("event_type") == "error")
    per_user = (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(
            F.max("value").alias("avg_session_time"),
            F.count(F.lit(1)).cast("int").alias("pages_per_session"),
            (F.min("value") / 500).alias("cart_abandon_rate"),
            (errors.cast("double") / F.count(F.lit(1))).alias("return_rate"),
            errors.cast("int").alias("support_tickets"),
        )
    )
    return per_user.select(
        customer_id("user_id").alias("customer_id"),
        "avg_session_time",
        "pages_per_session",
        "cart_abandon_rate",
        "return_rate",
        "support_tickets",
        (F.col("user_id") % 5 + 1).cast("double").alias("review_score"),
        (F.col("user_id") % 2).cast("int").alias("behavior_churn_signal"),
    )


def retail_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, folder),
        "products": products(spark, folder),
        "behavior": behavior(spark, folder),
        "transactions": transactions(spark, folder),
    }


def event_payment(event_type: str = "event_type") -> Column:
    """A payment method per event type; errors get one outside the accepted domain."""
    return (
        F.when(F.col(event_type) == "view", "UPI")
        .when(F.col(event_type) == "click", "Debit Card")
        .when(F.col(event_type) == "signup", "PayPal")
        .when(F.col(event_type) == "purchase", "Credit Card")
        .otherwise("Cash")
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One API request per event, with two transactions.

    The first may exceed the value range, carry an unknown payment method, or come without an
    id; the second lacks its customer when its value is small, and leaves the optional fields out.
    """
    product = F.get_json_object("props", "$.k")
    first = F.struct(
        F.when(F.col("event_type") != "signup", F.concat(F.lit("E"), F.col("event_id"))).alias("transaction_id"),
        customer_id("user_id").alias("customer_id"),
        product.alias("product_id"),
        F.col("ts").cast("date").cast("string").alias("order_date"),
        (F.col("value") * 50).alias("order_value"),
        event_payment().alias("payment_method"),
        F.col("event_type").alias("device_type"),
        (F.col("value") / 1000).alias("discount_applied"),
        F.day("ts").alias("shipping_delay_days"),
    )
    second = F.struct(
        F.concat(F.lit("S"), F.col("event_id")).alias("transaction_id"),
        F.when(F.col("value") >= 5, customer_id("user_id")).otherwise("").alias("customer_id"),
        product.alias("product_id"),
        F.lit("").alias("order_date"),
        F.col("value").cast("string").alias("order_value"),
        F.lit("UPI").alias("payment_method"),
    )
    body = F.concat(F.lit('{"transactions": ['), F.to_json(first), F.lit(", "), F.to_json(second), F.lit("]}"))
    return table(spark, folder, "events").select(F.col("event_id").alias("request_id"), body.alias("body"))


def misshapen_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One API request per event whose shape follows the event type."""
    listed = F.concat(F.lit('{"transactions": ['), F.col("props"), F.lit("]}"))
    crowded = F.concat_ws(", ", F.array_repeat("props", 101))
    body = (
        F.when(F.col("event_type") == "view", listed)
        .when(F.col("event_type") == "click", F.lit('{"transactions": []}'))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"transactions": '), F.col("props"), F.lit("}")))
        .when(
            (F.col("event_type") == "purchase") & (F.col("value") > 50),
            F.concat(F.lit('{"transactions": ['), crowded, F.lit("]}")),
        )
        .when(F.col("event_type") == "purchase", F.col("props"))
        .otherwise(F.substring(listed, 1, 20))
    )
    return table(spark, folder, "events").select(F.col("event_id").alias("request_id"), body.alias("body"))


def keyed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Stream records from events: keys repeat per user and product, seq orders them."""
    record = F.struct(
        F.concat(customer_id("user_id"), F.lit("-"), F.get_json_object("props", "$.k")).alias("transaction_id"),
        customer_id("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("ts").cast("date").cast("string").alias("order_date"),
        (F.col("value") * 10).alias("order_value"),
        event_payment().alias("payment_method"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("device_type"),
        (F.col("value") / 1000).alias("discount_applied"),
        F.day("ts").alias("shipping_delay_days"),
        F.when(F.col("value") * 10 > 950, 1).otherwise(0).alias("high_value_flag"),
    )
    return table(spark, folder, "events").select(
        customer_id("user_id").alias("key"),
        F.col("event_id").alias("seq"),
        F.base64(F.to_json(record).cast("binary")).alias("data"),
    )


def tagged(name: str, tag: str, value: Column) -> list[Column]:
    """Map entry of an attribute whose value sits under one type tag."""
    others = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != tag else value.alias(tag) for f in TAGS]
    return [F.lit(name), F.struct(*others)]


def change_records(spark: SparkSession, folder: str) -> DataFrame:
    """Change feed from events, as JSON lines; signups come without an image, errors are removals."""
    image = F.create_map(
        *tagged("transaction_id", "S", F.concat(F.lit("E"), F.col("event_id"))),
        *tagged("customer_id", "S", customer_id("user_id")),
        *tagged("product_id", "S", F.get_json_object("props", "$.k")),
        *tagged("order_date", "S", F.col("ts").cast("date").cast("string")),
        *tagged("order_value", "S", F.col("value").cast("string")),
        *tagged("payment_method", "S", event_payment()),
        *tagged("device_type", "NULL", F.lit(True)),
        *tagged("discount_applied", "N", (F.col("value") / 1000).cast("string")),
        *tagged("shipping_delay_days", "N", F.day("ts").cast("string")),
        *tagged("high_value_flag", "N", F.when(F.col("value") > 95, "1").otherwise("0")),
        *tagged("ingested_at", "S", F.col("ts").cast("string")),
    )
    kind = F.col("event_type")
    event_name = F.when(kind == "error", "REMOVE").when(kind == "click", "MODIFY").otherwise("INSERT")
    carried = F.struct(F.when(kind != "signup", image).alias("NewImage"))
    change = F.struct(event_name.alias("eventName"), carried.alias("dynamodb"))
    return table(spark, folder, "events").select(F.to_json(change).alias("value"))


def any_tag_records(spark: SparkSession, folder: str) -> DataFrame:
    """Change feed from events, as JSON lines, whose device type is tagged in ten ways and whose delay in three."""
    day, pay = F.day("ts").cast("string"), event_payment()
    kinds = [
        F.concat(F.lit('{"L":[{"S":"'), pay, F.lit('"},{"N":"'), day, F.lit('"}]}')),
        F.concat(F.lit('{"M":{"a":{"S":"'), day, F.lit('"}}}')),
        F.lit('{"SS":["a","b c"]}'),
        F.concat(F.lit('{"NS":["'), day, F.lit('","2"]}')),
        F.lit('{"B":"aGk="}'),
        F.lit('{"BOOL":false}'),
        F.concat(F.lit('{"N":"'), day, F.lit('"}')),
        F.concat(F.lit('{"N":"'), day, F.lit('.50"}')),
        F.concat(F.lit('{"N":"1","S":"'), pay, F.lit('"}')),
        F.lit('{"NULL":true}'),
    ]
    delays = [F.concat(F.lit('{"N":"'), day, F.lit('"}')), F.lit('{"S":"7"}'), F.lit('{"BS":["aGk="]}')]
    device = F.element_at(F.array(*kinds), (F.col("event_id") % 10 + 1).cast("int"))
    delay = F.element_at(F.array(*delays), (F.col("event_id") % 3 + 1).cast("int"))
    value = F.concat(
        F.lit('{"eventName":"INSERT","dynamodb":{"NewImage":{"transaction_id":{"S":"E'), F.col("event_id"),
        F.lit('"},"device_type":'), device, F.lit(',"shipping_delay_days":'), delay, F.lit("}}}"),
    )
    return table(spark, folder, "events").select(value.alias("value"))
