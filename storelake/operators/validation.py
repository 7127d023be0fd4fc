"""Rules for incoming transactions, as column expressions.

Each rule yields its message or null, so the same rules run over flat rows, over the elements
of a request and over streams.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from storelake.functions.text import is_blank, to_number, to_whole

# The rules' fields, bounds, domain and messages.
REQUIRED_FIELDS = ["customer_id", "product_id", "order_value", "payment_method"]
PAYMENT_METHODS = ["UPI", "Debit Card", "Credit Card", "PayPal", "Crypto"]
MAX_ORDER_VALUE = 10000
MAX_REQUEST_SIZE = 100
MISSING_FIELD = "Missing required field: {}"
VALUE_TOO_SMALL = "order_value must be greater than 0"
VALUE_TOO_LARGE = "order_value must be less than {}"
NOT_A_NUMBER = "{} must be a number"
UNKNOWN_PAYMENT = "payment_method must be one of: {}"
INVALID_JSON = "Invalid JSON in request body"
NO_TRANSACTIONS = "Request body must contain a 'transactions' list"
NOT_A_LIST = "transactions must be a list"
EMPTY_LIST = "transactions list is empty"
LIST_TOO_LONG = f"Maximum {MAX_REQUEST_SIZE} transactions per request"
VALIDATION_FAILED = "Validation failed"


def required(field: str, value: Column) -> Column:
    return F.when(is_blank(value), MISSING_FIELD.format(field))


def numeric(field: str, value: Column) -> Column:
    return F.when(to_number(value).isNull(), NOT_A_NUMBER.format(field))


def in_range(value: Column, most: float = MAX_ORDER_VALUE) -> Column:
    """The upper bound itself is allowed."""
    number = to_number(value)
    return F.when(number <= 0, VALUE_TOO_SMALL).when(number > most, VALUE_TOO_LARGE.format(most))


def in_domain(value: Column, methods: list[str]) -> Column:
    unknown = ~is_blank(value) & ~value.isin(methods)
    return F.when(unknown, UNKNOWN_PAYMENT.format(", ".join(methods)))


def transaction_errors(field, methods: list[str] = PAYMENT_METHODS) -> Column:
    """Ordered messages of one transaction; ``field`` maps a field name to its text column.

    An absent value and a null count alike. The optional numbers may be left out, but not be
    unreadable.
    """
    discount, delay = field("discount_applied"), field("shipping_delay_days")
    rules = [
        *[required(name, field(name)) for name in REQUIRED_FIELDS],
        in_range(field("order_value")),
        numeric("order_value", field("order_value")),
        in_domain(field("payment_method"), methods),
        F.when(discount.isNotNull(), numeric("discount_applied", discount)),
        F.when(
            delay.isNotNull() & to_whole(delay).isNull(), NOT_A_NUMBER.format("shipping_delay_days")
        ),
    ]
    return F.array_compact(F.array(*rules))
