"""API requests: one JSON body per row, holding a list of transactions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from storelake.operators import validation as rules
from storelake.operators.lateral import computed_once
from storelake.schemas import REQUEST_FIELDS, TEXT, columns

BODY = columns(transactions=ArrayType(columns(**{name: TEXT for name in REQUEST_FIELDS})))


def decode_requests(requests: DataFrame) -> DataFrame:
    """Parse ``body`` into ``transactions`` (an array of text fields) and ``shape_error``.

    The shape error is null for a request whose body holds a list of acceptable length. Only a
    body that yields no list is looked at again, to tell why. A list with anything but objects
    and nulls counts as no list.
    """
    body = F.from_json("body", BODY, {"allowSingleQuotes": "false"})
    parsed = computed_once(requests, parsed=body).withColumn("transactions", F.col("parsed.transactions"))
    document = F.try_parse_json("body")
    count = F.size("transactions")
    reason = (
        F.when(F.col("transactions").isNotNull(), F.when(count == 0, rules.EMPTY_LIST))
        .when(document.isNull(), rules.INVALID_JSON)
        .when(F.try_variant_get(document, "$.transactions", "variant").isNull(), rules.NO_TRANSACTIONS)
        .otherwise(rules.NOT_A_LIST)
    )
    shape_error = F.when(count > rules.MAX_REQUEST_SIZE, rules.LIST_TOO_LONG).otherwise(reason)
    return parsed.withColumn("shape_error", shape_error).drop("parsed")
