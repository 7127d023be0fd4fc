"""Declared schemas of every table, message and file."""

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

TEXT, INT, LONG, FLOAT, DOUBLE, BOOL = (
    StringType(),
    IntegerType(),
    LongType(),
    FloatType(),
    DoubleType(),
    BooleanType(),
)


def columns(**types: DataType) -> StructType:
    """Nullable columns in the order given."""
    return StructType([StructField(name, data_type) for name, data_type in types.items()])


# Names, order and types of the tables; files bind by position.
CUSTOMERS = columns(
    customer_id=TEXT,
    age=INT,
    gender=TEXT,
    country=TEXT,
    registration_date=TEXT,
    loyalty_score=FLOAT,
    lifetime_value=FLOAT,
    churn_label=INT,
)

PRODUCTS = columns(
    product_id=TEXT, category=TEXT, price=FLOAT, margin_percentage=FLOAT, popularity_score=FLOAT
)

BEHAVIOR = columns(
    customer_id=TEXT,
    avg_session_time=FLOAT,
    pages_per_session=INT,
    cart_abandon_rate=FLOAT,
    return_rate=FLOAT,
    support_tickets=INT,
    review_score=FLOAT,
    behavior_churn_signal=INT,
)

TRANSACTIONS = columns(
    transaction_id=TEXT,
    customer_id=TEXT,
    product_id=TEXT,
    order_date=TEXT,
    order_value=FLOAT,
    payment_method=TEXT,
    device_type=TEXT,
    discount_applied=FLOAT,
    shipping_delay_days=INT,
    fraud_label=INT,
)

BATCH_TABLES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "behavior": BEHAVIOR,
    "transactions": TRANSACTIONS,
}

# The Gold tables and their columns in load order.
GOLD_COLUMNS = {
    "dim_customer": ["customer_key", *CUSTOMERS.names],
    "dim_product": ["product_key", *PRODUCTS.names],
    "dim_payment": ["payment_method_key", "payment_method"],
    "dim_date": [
        "date_key",
        "full_date",
        "day",
        "month",
        "month_name",
        "quarter",
        "year",
        "day_of_week",
        "is_weekend",
    ],
    "fact_transactions": [
        "customer_key",
        "product_key",
        "payment_method_key",
        "date_key",
        "transaction_id",
        "customer_id",
        "product_id",
        "payment_method",
        "order_value",
        "discount_applied",
        "net_value",
        "shipping_delay_days",
        "fraud_label",
        "device_type",
        "load_type",
        "ingested_at",
    ],
    "fact_behavior": ["customer_key", *BEHAVIOR.names, "load_type", "ingested_at"],
}

GOLD_TABLES = list(GOLD_COLUMNS)

# A streamed transaction ends in high_value_flag where the batch table has fraud_label.
# Files of either bind by position, so one must never be read as the other.
STREAM_TXN = columns(
    transaction_id=TEXT,
    customer_id=TEXT,
    product_id=TEXT,
    order_date=TEXT,
    order_value=DOUBLE,
    payment_method=TEXT,
    device_type=TEXT,
    discount_applied=DOUBLE,
    shipping_delay_days=INT,
    high_value_flag=INT,
)

# Fields of one transaction in a request body: those of the stream without the computed flag.
REQUEST_FIELDS = STREAM_TXN.names[:-1]

# JSON scalars are declared as text, so that a quoted number reads like a bare one.
STREAM_RECORD = columns(**{name: TEXT for name in STREAM_TXN.names})

# Keyed stream frame: the customer is the key, seq the position in the stream, data base64 text.
KEYED_RECORD = columns(key=TEXT, seq=LONG, data=TEXT)

STORE_ITEM = columns(
    **{name: TEXT for name in STREAM_TXN.names[:8]},
    shipping_delay_days=INT,
    high_value_flag=INT,
    ingested_at=TEXT,
)

ITEM_LOG = columns(seq=LONG, **{f.name: f.dataType for f in STORE_ITEM}, batch_id=LONG)

ALERT = columns(
    transaction_id=TEXT, customer_id=TEXT, order_value=DOUBLE, payment_method=TEXT, order_date=TEXT
)

# Change record of the keyed store: each attribute carries its value under a type tag, which may be any.
TAGS = columns(S=TEXT, N=TEXT, BOOL=BOOL, NULL=BOOL)
CHANGE_RECORD = columns(eventName=TEXT, dynamodb=columns(NewImage=MapType(TEXT, VariantType())))

# Landed change rows with the hour they arrived in.
LANDED = columns(**{f.name: f.dataType for f in STREAM_TXN}, year=TEXT, month=TEXT, day=TEXT, hour=TEXT)
