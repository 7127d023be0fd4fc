"""From decoded requests to keyed stream records: validate, build, publish."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.keys import utc_date
from storelake.functions.text import non_blank_or, to_number, to_whole
from storelake.operators.lateral import computed_once
from storelake.operators.validation import PAYMENT_METHODS, VALIDATION_FAILED, transaction_errors

# High-value flag bound, prefix of a generated id and default device.
FLAG_THRESHOLD = 950
ID_PREFIX = "TXN"
DEFAULT_DEVICE = "Unknown"


def check(decoded: DataFrame, methods: list[str] = PAYMENT_METHODS) -> DataFrame:
    """Add ``errors``: the failing transactions of each request with index and messages.

    Only requests of good shape are looked into. Everything happens within the row.
    """

    def verdict(tx: Column, index: Column) -> Column:
        messages = transaction_errors(lambda name: tx[name], methods)
        return F.struct(index.alias("index"), messages.alias("messages"))

    failing = F.filter(F.transform("transactions", verdict), lambda v: F.size(v["messages"]) > 0)
    return computed_once(decoded, errors=F.when(F.col("shape_error").isNull(), failing))


def rejections(checked: DataFrame) -> DataFrame:
    """One row per rejected request with the reason."""
    reason = F.coalesce("shape_error", F.when(F.size("errors") > 0, VALIDATION_FAILED))
    return checked.select("request_id", reason.alias("error"), "errors").filter("error is not null")


def error_messages(checked: DataFrame) -> DataFrame:
    """One row per message, in the order the rules are listed."""
    failing = checked.select("request_id", F.explode("errors").alias("failing"))
    return failing.select(
        "request_id", F.col("failing.index").alias("index"), F.posexplode("failing.messages").alias("no", "message")
    )


def accepted(checked: DataFrame) -> DataFrame:
    """Transactions of the requests without any error: one bad transaction rejects its request."""
    whole = checked.filter(F.col("shape_error").isNull() & (F.size("errors") == 0))
    return whole.select("request_id", F.posexplode("transactions").alias("index", "tx")).select(
        "request_id", "index", "tx.*"
    )


def generated_id(hex_digits: int | None = None) -> Column:
    """Id derived from the transaction's place and parties, so that a retry generates the same one.

    The whole hash keeps ids apart at any volume; a shorter form is cut only where the caller asks for it.
    """
    origin = F.concat_ws("|", "request_id", "index", "customer_id", "product_id")
    digest = F.upper(F.sha2(origin, 256))
    return F.concat(F.lit(ID_PREFIX), digest if hex_digits is None else F.substring(digest, 1, hex_digits))


def build(
    transactions: DataFrame,
    now: Column,
    flag_threshold: float = FLAG_THRESHOLD,
    hex_digits: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed stream records of valid transactions, with defaults and the high-value flag.

    ``now`` dates the orders that come without a date: one literal per batch run, the current
    timestamp in a stream. The flag looks at the rounded value.
    ``hex_digits`` shortens generated ids; ``keep`` names columns to pass on in front.
    """
    value = F.round(to_number(F.col("order_value")), 2)
    today = utc_date(now)
    return transactions.select(
        *keep,
        non_blank_or(F.col("transaction_id"), generated_id(hex_digits)).alias("transaction_id"),
        "customer_id",
        "product_id",
        non_blank_or(F.col("order_date"), today).alias("order_date"),
        value.alias("order_value"),
        "payment_method",
        F.coalesce("device_type", F.lit(DEFAULT_DEVICE)).alias("device_type"),
        F.coalesce(to_number(F.col("discount_applied")), F.lit(0.0)).alias("discount_applied"),
        F.coalesce(to_whole(F.col("shipping_delay_days")), F.lit(0)).alias("shipping_delay_days"),
        F.when(value > flag_threshold, 1).otherwise(0).alias("high_value_flag"),
    )


def to_keyed_json(built: DataFrame, fields: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Message frame: the customer as key, the record (``fields``, or all columns) as JSON."""
    record = F.to_json(F.struct(*(fields or built.columns)), {"ignoreNullFields": "false"})
    return built.select(*keep, F.col("customer_id").alias("key"), record.alias("value"))


def request_metrics(checked: DataFrame) -> dict[str, Column]:
    """Counters to observe while ``checked`` is written."""
    good = F.col("shape_error").isNull() & (F.size("errors") == 0)
    sent = F.when(good, F.size("transactions")).otherwise(0)
    return {
        "requests": F.count(F.lit(1)),
        "rejected": F.count_if(~good),
        "sent": F.coalesce(F.sum(sent), F.lit(0)),
    }
