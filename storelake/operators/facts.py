"""Facts of the star schema.

Dimensions are left-joined on their natural key, on which they are unique, so a fact keeps
exactly the rows of its source. Pass dimensions that are stored tables (Gold, or
``sinks.files.stored``): their sizes are then known when the fact is planned.
"""

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.keys import date_key, lineage, surrogate_key
from storelake.operators.incremental import key_bits, with_mark
from storelake.schemas import GOLD_COLUMNS
from storelake.sinks.files import stored

LARGE = 100_000  # rows of a dimension that is looked up by a bitmap of its keys


def add_key(fact: DataFrame, dim: DataFrame, natural_key: str, key: str) -> DataFrame:
    """The left join with a dimension for its surrogate key; null where the dimension lacks the row.

    A plain join without a hint: Spark broadcasts a stored dimension below its threshold, and otherwise meets it in a
    sort-merge join whose hot keys adaptive execution splits. ``add_keys`` says which dimensions need no such join.
    """
    return add_keys(fact, [(dim, natural_key, key)])


def add_keys(fact: DataFrame, joins: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """The left joins with dimensions, each given with its natural and its surrogate key, in this order.

    A large dimension that holds every natural key once, with the key that its hash gives, tells a fact no more than
    whether the natural key is there. Then the facts are not shuffled: a broadcast bitmap of the hashes of the dimension's keys
    (``incremental.BITS`` bits at most) settles which keys are missing. Keys that pass it without being there are found
    from the distinct keys alone, in one more pass over the key columns of the facts, and are met in a plain join: that is broadcast
    while they are few. All other dimensions meet the facts in a plain join.
    """
    hashed = {natural: stored(key_bits(dim, natural)) for dim, natural, key in joins if _large_and_hashed(dim, natural, key)}
    strange = _strangers(fact, {natural: (dim, hashed[natural]) for dim, natural, _ in joins if natural in hashed})
    for dim, natural, key in joins:
        if natural in hashed:
            there, odd = _unused(fact, "there"), _unused(fact, "odd")
            odd_ones = strange.filter(F.col("name") == natural).select(F.col("value").alias(natural), F.lit(True).alias(odd))
            met = with_mark(fact, natural, hashed[natural], there).join(odd_ones, natural, "left")
            known = F.col(there) & F.col(odd).isNull()
            fact = met.withColumn(key, F.when(known, surrogate_key(natural))).drop(there, odd)
        else:
            fact = fact.join(dim.select(natural, key), natural, "left")
    return fact


def _large_and_hashed(dim: DataFrame, natural: str, key: str) -> bool:
    if dim.count() <= LARGE:
        return False
    own = F.count_if(F.col(key).eqNullSafe(surrogate_key(natural)))
    each = dim.filter(F.col(natural).isNotNull()).groupBy(natural).agg(F.count(F.lit(1)).alias("n"), own.alias("own"))
    return each.filter("n <> 1 or own <> 1").isEmpty()


def _strangers(fact: DataFrame, looked_up: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame | None:
    """Keys of the facts whose bit is set although the dimension lacks them: ``name`` of the column and ``value``."""
    if not looked_up:
        return None
    seen, there = fact.select(*looked_up), dict(zip(looked_up, [f"there{n}" for n in range(len(looked_up))]))
    for natural, (_, bits) in looked_up.items():
        seen = with_mark(seen, natural, bits, there[natural])
    pairs = [F.when(F.col(there[n]), F.struct(F.lit(n).alias("name"), F.col(n).alias("value"))) for n in looked_up]
    maybe = seen.select(F.explode(F.array_compact(F.array(*pairs))).alias("pair")).select("pair.*").distinct()
    kept = [dim.select(F.lit(n).alias("name"), F.col(n).alias("value")) for n, (dim, _) in looked_up.items()]
    return stored(maybe.join(reduce(DataFrame.union, kept), ["name", "value"], "left_anti"))


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def net_value(transactions: DataFrame) -> Column:
    """Order value after discount, in the type of the discount (a float stays a float)."""
    one = F.lit(1).cast(transactions.schema["discount_applied"].dataType)
    return F.col("order_value") * (one - F.col("discount_applied"))


def fact_transactions(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    load_type: str,
    run_ts: datetime,
) -> DataFrame:
    measured = transactions.withColumns(
        {
            "date_key": date_key(F.try_to_date("order_date")),
            "net_value": net_value(transactions),
        }
    )
    joins = [
        (products, "product_id", "product_key"),
        (customers, "customer_id", "customer_key"),
        (payments, "payment_method", "payment_method_key"),
    ]
    keyed = add_keys(measured, joins)
    return keyed.withColumns(lineage(load_type, run_ts)).select(GOLD_COLUMNS["fact_transactions"])


def fact_behavior(behavior: DataFrame, customers: DataFrame, load_type: str, run_ts: datetime) -> DataFrame:
    keyed = add_key(behavior, customers, "customer_id", "customer_key")
    return keyed.withColumns(lineage(load_type, run_ts)).select(GOLD_COLUMNS["fact_behavior"])
