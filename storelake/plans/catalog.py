"""Registered queries: each takes a session and a folder of tables and returns a frame.

Queries that write do so under the scratch folder and return what a reader finds there.
"""

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.functions.keys import iso_timestamp, lineage
from storelake.operators import clean, dims, facts, incremental, ingest, validation, watermarks
from storelake.operators.lateral import computed_once
from storelake.plans import loads
from storelake.plans import retail_views as views
from storelake.schemas import (
    BATCH_TABLES,
    CHANGE_RECORD,
    CUSTOMERS,
    KEYED_RECORD,
    LONG,
    STREAM_TXN,
    TRANSACTIONS,
    columns,
)
from storelake.session import scratch_path
from storelake.sinks import files as sinks
from storelake.sources.files import read_csv, read_table
from storelake.sources.requests import decode_requests
from storelake.streaming import changes, items, publish

Query = Callable[[SparkSession, str], DataFrame]

# One pinned run time keeps lineage comparable between runs.
RUN_TS = datetime(2024, 7, 1, 12, 30, tzinfo=timezone.utc)

QUERIES: dict[str, Query] = {}

# Dimensions cut by these lack some of the keys that the facts hold.
IN_CREDIT = "lifetime_value > 3000"
SLOW_SELLER = "popularity_score <= 25"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def shown(fact: DataFrame) -> DataFrame:
    """Ingestion time as UTC text."""
    return fact.withColumn("ingested_at", iso_timestamp(F.col("ingested_at")))


# Dimensions and facts


@query
def dim_customer(spark, folder):
    return dims.dim_customer(views.repeated_customers(spark, folder))


@query
def dim_product(spark, folder):
    return dims.dim_product(views.products(spark, folder))


@query
def dim_payment(spark, folder):
    return dims.dim_payment(views.transactions(spark, folder))


@query
def dim_date(spark, folder):
    return dims.dim_date(views.transactions(spark, folder))


@query
def fact_transactions(spark, folder):
    transactions = views.transactions(spark, folder)
    by = loads.together(
        spark,
        customers=lambda: sinks.stored(dims.dim_customer(views.customers(spark, folder).filter(IN_CREDIT))),
        products=lambda: sinks.stored(dims.dim_product(views.products(spark, folder).filter(SLOW_SELLER))),
        payments=lambda: sinks.stored(dims.dim_payment(transactions)),
    )
    return shown(
        facts.fact_transactions(
            transactions,
            by["customers"],
            by["products"],
            by["payments"],
            "INITIAL",
            RUN_TS,
        )
    )


@query
def fact_behavior(spark, folder):
    by_customer = sinks.stored(dims.dim_customer(views.customers(spark, folder).filter(IN_CREDIT)))
    return shown(facts.fact_behavior(views.behavior(spark, folder), by_customer, "INITIAL", RUN_TS))


# Joins, against dimensions that lack some of the keys


@query
def join_left_customer(spark, folder):
    in_credit = views.customers(spark, folder).filter(IN_CREDIT)
    by_customer = sinks.stored(dims.dim_customer(in_credit))
    keyed = facts.add_key(views.transactions(spark, folder), by_customer, "customer_id", "customer_key")
    return keyed.select("transaction_id", "customer_id", "order_value", "customer_key")


@query
def join_left_product(spark, folder):
    slow_sellers = views.products(spark, folder).filter(SLOW_SELLER)
    by_product = sinks.stored(dims.dim_product(slow_sellers))
    keyed = facts.add_key(views.transactions(spark, folder), by_product, "product_id", "product_key")
    return keyed.select("transaction_id", "product_id", "order_value", "product_key")


@query
def join_left_payment(spark, folder):
    transactions = views.transactions(spark, folder)
    by_payment = sinks.stored(dims.dim_payment(transactions))
    keyed = facts.add_key(transactions, by_payment, "payment_method", "payment_method_key")
    return keyed.select("transaction_id", "payment_method", "order_value", "payment_method_key")


# Cleaning and projection


@query
def clean_rows(spark, folder):
    events = views.table(spark, folder, "events")
    banded = events.select(
        F.col("user_id").alias("User ID"),
        F.col("event_type").alias(" Event-Type"),
        F.when(F.col("value") >= 5, F.floor(F.col("value") / 10)).alias("VALUE (band)"),
    )
    return clean.clean(banded).withColumnRenamed("value_band_", "value_band")


@query
def clean_names(spark, folder):
    events = views.table(spark, folder, "events")
    return clean.normalize_names(events.toDF("Event ID", " TS ", "User.Id", "Event-Type", "VALUE", "props"))


@query
def dedup_by_key(spark, folder):
    return clean.dedup_by_key(views.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def cast_to_schema(spark, folder):
    customers = views.customers(spark, folder)
    as_text = customers.select([F.col(c).cast("string").alias(c) for c in customers.columns])
    patchy = as_text.withColumn(
        "loyalty_score",
        F.when(F.col("loyalty_score").startswith("-"), "n/a").otherwise(F.col("loyalty_score")),
    )
    return clean.cast_to(patchy, CUSTOMERS)


@query
def prj_select(spark, folder):
    transactions = views.transactions(spark, folder)
    return transactions.select("transaction_id", "customer_id", "order_date", "order_value", "fraud_label")


@query
def lineage_cols(spark, folder):
    products = views.products(spark, folder)
    return shown(products.withColumns(lineage("INCREMENTAL", RUN_TS)))


# Incremental deltas


@query
def agg_max_key(spark, folder):
    return views.transactions(spark, folder).agg(
        F.max("customer_id").alias("max_customer_id"), F.max("product_id").alias("max_product_id")
    )


@query
def incr_watermark_customers(spark, folder):
    seen = views.behavior(spark, folder)
    return incremental.newer_than(views.customers(spark, folder), seen, "customer_id")


@query
def incr_watermark_products(spark, folder):
    products = views.products(spark, folder)
    return incremental.newer_than(products, products.filter("price < 950"), "product_id")


@query
def incr_watermark_numeric(spark, folder):
    products = views.products(spark, folder)
    return incremental.newer_than(products, products.filter("price < 950"), "product_id", "numeric")


@query
def incr_watermark_marked(spark, folder):
    """Products above the watermark kept by two appends; the stored table is not read for it."""
    path = scratch_path(spark, "marked")
    products = views.products(spark, folder)
    sinks.overwrite(products.filter("price < 920"), path)
    for limit in (935, 950):
        watermarks.append_newer(products.filter(F.col("price") < limit), read_table(spark, path), path, "product_id")
    (mark,) = watermarks.read_mark(spark, path, "product_id", "lexicographic")
    return incremental.above(products, "product_id", mark)


@query
def incr_anti_behavior(spark, folder):
    return incremental.not_in(views.customers(spark, folder), views.behavior(spark, folder), "customer_id")


# Files


@query
def src_csv_typed(spark, folder):
    path = scratch_path(spark, "bronze")
    sinks.write_csv(views.transactions(spark, folder), path)
    return read_csv(spark, path, TRANSACTIONS)


@query
def src_parquet(spark, folder):
    return read_table(spark, f"{folder}/part.parquet")


@query
def sink_parquet_overwrite(spark, folder):
    path = scratch_path(spark, "overwritten")
    transactions = views.transactions(spark, folder)
    sinks.overwrite(transactions.select("transaction_id", "fraud_label"), path)
    sinks.overwrite(transactions, path)
    return read_table(spark, path)


@query
def sink_parquet_append(spark, folder):
    path = scratch_path(spark, "appended")
    products = views.products(spark, folder)
    sinks.overwrite(products.filter("price < 950"), path)
    sinks.append(products.filter("price >= 950"), path)
    return read_table(spark, path)


@query
def sink_append_nonempty(spark, folder):
    path = scratch_path(spark, "delta")
    products = views.products(spark, folder)
    sinks.overwrite(products.filter("price < 950"), path)
    appended = [
        sinks.append_delta(incremental.newer_than(products, read_table(spark, path), "product_id"), path)
        for _ in range(2)
    ]
    first, second = appended
    return read_table(spark, path).withColumns(
        {"first_delta": F.lit(first).cast("bigint"), "second_delta": F.lit(second).cast("bigint")}
    )


@query
def sink_csv_extract(spark, folder):
    path = scratch_path(spark, "extract")
    documents = views.table(spark, folder, "documents")
    sinks.write_csv(documents, path)
    return read_csv(spark, path, documents.schema, multi_line=True)


@query
def sink_csv_fixed(spark, folder):
    path = scratch_path(spark, "fixed")
    sinks.write_csv(keyed_items(spark, folder).select(STREAM_TXN.names), path, line_sep="\n")
    return read_csv(spark, path, STREAM_TXN)


@query
def sink_hour_partitions(spark, folder):
    path = scratch_path(spark, "hourly")
    changes.land(change_feed(spark, folder), path, F.lit(RUN_TS))
    return changes.read_landed(spark, path)


# Requests


def checked_requests(spark, folder) -> DataFrame:
    return ingest.check(decode_requests(views.requests(spark, folder)))


def built_records(spark, folder) -> DataFrame:
    return ingest.build(ingest.accepted(checked_requests(spark, folder)), F.lit(RUN_TS))


@query
def ingest_explode(spark, folder):
    decoded = decode_requests(views.requests(spark, folder))
    elements = decoded.select("request_id", F.posexplode("transactions").alias("index", "tx"))
    numbers = {name: F.col(name).cast("double") for name in ("order_value", "discount_applied")}
    return elements.select("request_id", "index", "tx.*").withColumns(numbers)


def messages(rows: DataFrame, rule) -> DataFrame:
    return rows.withColumn("message", rule).filter("message is not null")


@query
def validate_required(spark, folder):
    decoded = decode_requests(views.requests(spark, folder))
    rows = decoded.select("request_id", F.posexplode("transactions").alias("index", "tx"))
    return messages(
        rows.select("request_id", "index", "tx.customer_id"),
        validation.required("customer_id", F.col("customer_id")),
    )


@query
def validate_required_fields(spark, folder):
    """Every required field, left out of the line of its number."""
    rows = views.transactions(spark, folder)
    line = F.substring_index("transaction_id", "-", -1)
    fields = enumerate(validation.REQUIRED_FIELDS, 1)
    given = {name: F.when(line != str(n), F.col(name).cast("string")) for n, name in fields}
    said = F.array_compact(F.array(*[validation.required(name, value) for name, value in given.items()]))
    return messages(rows.select("transaction_id", F.explode(said).alias("said")), F.col("said")).drop("said")


@query
def validate_optional(spark, folder):
    """Optional numbers that cannot be read, and such as are left out."""
    part = views.table(spark, folder, "part")
    text = {
        "discount_applied": F.when(F.col("p_size") > 40, F.col("p_name")).when(F.col("p_size") > 5, "0.1"),
        "shipping_delay_days": F.when(F.col("p_size") > 45, "1.5").when(F.col("p_size") > 30, F.col("p_type")).when(F.col("p_size") > 9, "2"),
    }
    fixed = {"customer_id": F.lit("C"), "product_id": F.lit("P"), "order_value": F.lit("1"), "payment_method": F.lit("UPI")}
    said = validation.transaction_errors(lambda name: {**fixed, **text}[name])
    return part.select("p_partkey", F.array_join(said, "; ").alias("message")).filter("message <> ''")


@query
def validate_range(spark, folder):
    """Values moved so far that some fall below the range and some lie above it."""
    moved = (F.col("order_value") * 2 - 20000).alias("order_value")
    rows = views.transactions(spark, folder).select("transaction_id", moved)
    return messages(rows, validation.in_range(F.col("order_value").cast("string")))


@query
def validate_numeric(spark, folder):
    part = views.table(spark, folder, "part")
    price = F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(F.col("p_retailprice").cast("string"))
    rows = part.select("p_partkey", price.alias("order_value"))
    return messages(rows, validation.numeric("order_value", F.col("order_value")))


@query
def validate_domain(spark, folder):
    rows = views.transactions(spark, folder).select("transaction_id", "payment_method")
    known = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
    return messages(rows, validation.in_domain(F.col("payment_method"), known))


@query
def validate_errors(spark, folder):
    return ingest.error_messages(checked_requests(spark, folder))


@query
def validate_batch_atomic(spark, folder):
    return ingest.rejections(checked_requests(spark, folder)).select("request_id", "error")


@query
def validate_batch_shape(spark, folder):
    return decode_requests(views.misshapen_requests(spark, folder)).select("request_id", "shape_error")


@query
def validate_json(spark, folder):
    decoded = decode_requests(views.misshapen_requests(spark, folder))
    return decoded.filter(F.col("shape_error") == validation.INVALID_JSON).select("request_id", "shape_error")


@query
def ingest_build(spark, folder):
    return built_records(spark, folder)


def received(keyed: DataFrame) -> DataFrame:
    """What a consumer reads from the published messages."""
    return computed_once(keyed, record=F.from_json("value", STREAM_TXN)).select("key", "record.*")


@query
def publish_keyed_json(spark, folder):
    return received(publish.messages(views.requests(spark, folder), F.lit(RUN_TS)))


@query
def ingest_publish(spark, folder):
    """Validate, build and publish to a folder; what a consumer of the stream reads."""
    path = scratch_path(spark, "published")
    publish.messages(views.requests(spark, folder), F.lit(RUN_TS)).write.json(f"{path}/messages")
    return received(publish.read_published(spark, path))


@query
def run_metrics(spark, folder):
    counted = {}
    write = publish.batch_writer(scratch_path(spark, "published"), F.lit(RUN_TS), on_counted=counted.__setitem__)
    write(views.requests(spark, folder), 0)
    return spark.createDataFrame([counted[0]], "requests bigint, rejected bigint, sent bigint")


# Streams


def change_feed(spark, folder) -> DataFrame:
    records = views.change_records(spark, folder)
    return computed_once(records, change=F.from_json("value", CHANGE_RECORD)).select("change.*")


def keyed_items(spark, folder) -> DataFrame:
    return items.store_items(items.decode_records(views.keyed_records(spark, folder)), F.lit(RUN_TS))


@query
def stream_decode(spark, folder):
    records = items.decode_records(views.keyed_records(spark, folder))
    return clean.cast_to(records, columns(seq=LONG, **{f.name: f.dataType for f in STREAM_TXN}))


@query
def store_item(spark, folder):
    return keyed_items(spark, folder).withColumn("discount_applied", F.col("discount_applied").cast("double"))


@query
def alerts_high_value(spark, folder):
    return items.alerts(keyed_items(spark, folder))


@query
def upsert_latest(spark, folder):
    latest = items.latest_per_key(keyed_items(spark, folder), ["seq"])
    return latest.withColumn("discount_applied", F.col("discount_applied").cast("double"))


@query
def cdc_decode(spark, folder):
    return changes.decode_changes(change_feed(spark, folder))


@query
def cdc_filter(spark, folder):
    kept = changes.with_new_row(change_feed(spark, folder))
    return kept.select("eventName", changes.attribute_text(F.col("dynamodb.NewImage"), "transaction_id").alias("transaction_id"))


@query
def cdc_other_tags(spark, folder):
    """An attribute under every tag there is, in turn."""
    records = views.any_tag_records(spark, folder)
    decoded = computed_once(records, change=F.from_json("value", CHANGE_RECORD)).select("change.*")
    return changes.decode_changes(decoded).select("transaction_id", "device_type", "shipping_delay_days")


def run_upsert_stream(spark, folder) -> tuple[str, str]:
    root = scratch_path(spark, "stream")
    sinks.overwrite(views.keyed_records(spark, folder), f"{root}/input")
    keyed = spark.readStream.schema(KEYED_RECORD).parquet(f"{root}/input")
    log_path, alerts_path = f"{root}/log", f"{root}/alerts"
    items.start_upsert(keyed, log_path, alerts_path, f"{root}/checkpoint", F.lit(RUN_TS)).awaitTermination()
    return log_path, alerts_path


@query
def stream_publish(spark, folder):
    root = scratch_path(spark, "requests")
    requests = views.requests(spark, folder)
    sinks.overwrite(requests, f"{root}/input")
    arriving = spark.readStream.schema(requests.schema).parquet(f"{root}/input")
    publish.start_publish(arriving, f"{root}/out", f"{root}/checkpoint", F.lit(RUN_TS)).awaitTermination()
    return received(publish.read_published(spark, f"{root}/out"))


@query
def stream_rejections(spark, folder):
    root = scratch_path(spark, "requests")
    requests = views.requests(spark, folder)
    sinks.overwrite(requests, f"{root}/input")
    arriving = spark.readStream.schema(requests.schema).parquet(f"{root}/input")
    publish.start_publish(arriving, f"{root}/out", f"{root}/checkpoint", F.lit(RUN_TS)).awaitTermination()
    failing = publish.read_rejections(spark, f"{root}/out").select("request_id", "error", F.explode("errors").alias("e"))
    return failing.select("request_id", "error", F.col("e.index").alias("index"), F.posexplode("e.messages").alias("no", "message"))


@query
def requests_to_items(spark, folder):
    """Requests through the publish stream and the upsert stream to the current items."""
    root = scratch_path(spark, "chain")
    requests = views.requests(spark, folder)
    sinks.overwrite(requests, f"{root}/input")
    arriving = spark.readStream.schema(requests.schema).parquet(f"{root}/input")
    publish.start_publish(arriving, f"{root}/out", f"{root}/publish", F.lit(RUN_TS)).awaitTermination()
    published = spark.readStream.schema(publish.MESSAGE).json(f"{root}/out/messages")
    running = items.start_upsert(
        publish.to_records(published), f"{root}/log", f"{root}/alerts", f"{root}/upsert", F.lit(RUN_TS)
    )
    running.awaitTermination()
    numbers = {name: F.col(name).cast("double") for name in ("order_value", "discount_applied")}
    return items.current_items(spark, f"{root}/log").withColumns(numbers)


@query
def stream_upsert(spark, folder):
    log_path, _ = run_upsert_stream(spark, folder)
    current = items.current_items(spark, log_path)
    return current.withColumn("discount_applied", F.col("discount_applied").cast("double"))


@query
def items_compacted(spark, folder):
    log_path, _ = run_upsert_stream(spark, folder)
    items.compact_items(spark, log_path, f"{log_path}-compacted")
    current = items.current_items(spark, f"{log_path}-compacted")
    return current.withColumn("discount_applied", F.col("discount_applied").cast("double"))


def input_files(spark, folder, root: str, cuts: int, one_file: bool = False) -> list[str]:
    """The keyed records as so many Parquet folders, cut by their sequence number, not yet where the stream looks.

    A folder has as many files as are worth a task, since a batch is decoded by a task for each, or else ``one_file``.
    """
    records, paths = views.keyed_records(spark, folder), [f"{root}/spare/{n}" for n in range(cuts)]
    last = records.agg(F.max("seq")).first()[0]

    def write(n: int) -> None:
        part = records.filter((F.col("seq") * cuts >= n * (last + 1)) & (F.col("seq") * cuts < (n + 1) * (last + 1)))
        sinks.overwrite(part.coalesce(1) if one_file else part.repartition("seq"), paths[n])

    loads.together(spark, **{f"part_{n}": partial(write, n) for n in range(cuts)})
    return paths


@query
def stream_upsert_folded(spark, folder):
    """Four batches, with the log folded after the first, second and third; what then comes from the base and one open batch."""
    root = scratch_path(spark, "folded")
    sinks.make_folder(spark, f"{root}/input")
    keyed = spark.readStream.schema(KEYED_RECORD).parquet(f"{root}/input/*")
    log_path, alerts_path = f"{root}/log", f"{root}/alerts"
    for n, path in enumerate(input_files(spark, folder, root, 4)):
        sinks.move_folder(spark, path, f"{root}/input/{n}")
        items.start_upsert(keyed, log_path, alerts_path, f"{root}/checkpoint", F.lit(RUN_TS)).awaitTermination()
        if n < 3:
            items.fold_items(spark, log_path)
    current = items.current_items(spark, log_path)
    return current.withColumn("discount_applied", F.col("discount_applied").cast("double"))


@query
def stream_replay(spark, folder):
    """A stream whose second file first holds unreadable records: it fails, is mended and restarted. Log rows and alerts."""
    root = scratch_path(spark, "replay")
    paths = input_files(spark, folder, root, 3, one_file=True)
    broken = f"{root}/broken"
    whole = spark.read.schema(KEYED_RECORD).parquet(paths[1])
    sinks.overwrite(whole.withColumn("data", F.when(F.col("seq") % 1000 == 7, F.base64(F.lit("{").cast("binary"))).otherwise(F.col("data"))).coalesce(1), broken)
    sinks.make_folder(spark, f"{root}/input")
    keyed = spark.readStream.schema(KEYED_RECORD).parquet(f"{root}/input/*")
    log_path, alerts_path = f"{root}/log", f"{root}/alerts"

    def run():
        items.start_upsert(keyed, log_path, alerts_path, f"{root}/checkpoint", F.lit(RUN_TS)).awaitTermination()

    sinks.move_folder(spark, paths[0], f"{root}/input/0")
    run()
    sinks.move_folder(spark, broken, f"{root}/input/1")
    try:
        run()
        raise AssertionError("unreadable records went through")
    except StreamingQueryException:
        sinks.replace_files(spark, paths[1], f"{root}/input/1")  # under the names that the failed batch asks for
    sinks.move_folder(spark, paths[2], f"{root}/input/2")
    run()
    run()
    stored = items.read_log(spark, log_path).select(F.lit("item").alias("kind"), "transaction_id", F.col("order_value").cast("double"))
    raised = items.read_alerts(spark, alerts_path).select(F.lit("alert"), "transaction_id", "order_value")
    return stored.union(raised)


@query
def stream_empty_batch(spark, folder):
    """Empty batches among others, to both stores: what folders there are, and the rows in them."""
    root = scratch_path(spark, "sparse")
    records, requests = views.keyed_records(spark, folder), views.requests(spark, folder)
    upsert = items.batch_writer(f"{root}/log", f"{root}/alerts", F.lit(RUN_TS))
    send = publish.batch_writer(f"{root}/out", F.lit(RUN_TS))
    for batch, keep in enumerate((F.lit(False), F.lit(True), F.lit(False))):
        upsert(records.filter(keep), batch)
        send(requests.filter(keep), batch)
        send(requests.filter(keep), batch)
    paths = {name: f"{root}/{name}" for name in ("log", "alerts", "out/messages", "out/rejections")}
    seen = [(name, int(batch)) for name, path in paths.items() for batch in sinks.subfolders(spark, path, "batch_id")]
    rows = items.read_log(spark, paths["log"]).select(F.lit("log").alias("folder"), "batch_id").union(
        items.read_alerts(spark, paths["alerts"]).select(F.lit("alerts"), F.lit(1))).union(
        publish.read_published(spark, f"{root}/out").select(F.lit("out/messages"), F.lit(1))).union(
        publish.read_rejections(spark, f"{root}/out").select(F.lit("out/rejections"), "batch_id"))
    counted = rows.groupBy("folder", "batch_id").agg(F.count(F.lit(1)).alias("rows"))
    return spark.createDataFrame(seen, "folder string, batch_id bigint").join(counted, ["folder", "batch_id"], "left")


@query
def kafka_to_items(spark, folder):
    """The current items of a Kafka frame with two partitions, whose offsets start far apart."""
    records = views.keyed_records(spark, folder)
    part = F.pmod(F.crc32(F.col("key").cast("binary")), F.lit(2)).cast("int")
    frame = records.select(
        F.col("key").cast("binary").alias("key"),
        F.unbase64("data").alias("value"),
        part.alias("partition"),
        F.when(part == 0, F.col("seq")).otherwise(F.col("seq") + 10**9).alias("offset"),
    )
    stored = items.store_items(items.decode_records(publish.from_kafka(frame)), F.lit(RUN_TS))
    latest = items.latest_per_key(stored, ["seq"]).drop("seq")
    return latest.withColumn("discount_applied", F.col("discount_applied").cast("double"))


@query
def stream_alerts(spark, folder):
    _, alerts_path = run_upsert_stream(spark, folder)
    return items.read_alerts(spark, alerts_path)


@query
def cdc_two_hours(spark, folder):
    """Changes landed in two hours by one stream; the first is merged and the second still as it landed."""
    root = scratch_path(spark, "feed")
    records = views.change_records(spark, folder)
    even = F.get_json_object("value", "$.dynamodb.NewImage.transaction_id.S").rlike("[02468]$")
    sinks.make_folder(spark, f"{root}/input")
    feed = spark.readStream.schema(CHANGE_RECORD).json(f"{root}/input")
    for hour, part in enumerate((F.coalesce(even, F.lit(False)), F.coalesce(~even, F.lit(False)))):
        records.filter(part).write.mode("append").text(f"{root}/input")
        at = F.lit(RUN_TS + timedelta(hours=hour))
        changes.start_landing(feed, f"{root}/bronze", f"{root}/checkpoint", at).awaitTermination()
    changes.merge_hours(spark, f"{root}/bronze", f"{root}/merged", RUN_TS + timedelta(hours=1))
    return changes.read_merged(spark, f"{root}/bronze", f"{root}/merged")


@query
def cdc_landing(spark, folder):
    root = scratch_path(spark, "feed")
    views.change_records(spark, folder).write.text(f"{root}/input")
    feed = spark.readStream.schema(CHANGE_RECORD).json(f"{root}/input")
    changes.start_landing(feed, f"{root}/bronze", f"{root}/checkpoint", F.lit(RUN_TS)).awaitTermination()
    return changes.read_landed(spark, f"{root}/bronze")


# Loads


@query
def clean_drops(spark, folder):
    """Products with unreadable, empty and repeated prices, cleaned from CSV: the rows kept, and dropped by reason."""
    lake = loads.Lake(scratch_path(spark, "lake"))
    tables = views.retail_tables(spark, folder)
    number = F.col("product_id").cast("int")
    price = F.when(number % 7 == 0, "n/a").when(number % 5 != 0, F.col("price").cast("string"))
    products = tables["products"].withColumn("price", price)
    tables["products"] = products.union(products.filter(number % 3 == 0)).union(products.filter(number % 4 == 0))
    extracted = loads.extract(spark, tables, lake)
    refined = loads.bronze_to_silver(spark, lake, extracted=extracted)
    rows = [(name, *[counts[c] for c in ("kept", "malformed", "nulls", "repeated")]) for name, counts in refined.items()]
    return spark.createDataFrame(rows, "table_name string, kept bigint, malformed bigint, nulls bigint, repeated bigint")


@query
def bulk_extract(spark, folder):
    lake = loads.Lake(scratch_path(spark, "lake"))
    loads.extract(spark, views.retail_tables(spark, folder), lake)
    counts = [
        read_csv(spark, f"{lake.bronze}/{name}", schema).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.max(schema.names[0]).alias("last_key"),
        )
        for name, schema in BATCH_TABLES.items()
    ]
    customers, products, behavior, transactions = counts
    return customers.union(products).union(behavior).union(transactions)


def extracted(name: str) -> Query:
    """The rows of one extracted table, as Bronze holds them."""

    def read(spark, folder):
        lake = loads.Lake(scratch_path(spark, "lake"))
        loads.extract(spark, {name: views.retail_tables(spark, folder)[name]}, lake)
        return read_csv(spark, f"{lake.bronze}/{name}", BATCH_TABLES[name])

    return read


QUERIES.update({f"extract_{name}": extracted(name) for name in ("customers", "products", "behavior")})


def run_initial_load(spark, folder) -> loads.Lake:
    """A load whose customers and products lack some of the keys of the facts."""
    lake = loads.Lake(scratch_path(spark, "lake"))
    tables = views.retail_tables(spark, folder)
    known = {"customers": tables["customers"].filter(IN_CREDIT), "products": tables["products"].filter(SLOW_SELLER)}
    loads.run(spark, "initial", lake, {**tables, **known}, RUN_TS)
    return lake


@query
def initial_load(spark, folder):
    return shown(read_table(spark, f"{run_initial_load(spark, folder).gold}/fact_transactions"))


@query
def initial_line_breaks(spark, folder):
    """A first load whose transactions hold line breaks."""
    lake = loads.Lake(scratch_path(spark, "lake"))
    tables = views.retail_tables(spark, folder)
    broken = F.concat("device_type", F.lit('\n"x", \n'))
    tables["transactions"] = tables["transactions"].withColumn("device_type", broken)
    loads.run(spark, "initial", lake, tables, RUN_TS, multi_line=["transactions"])
    return read_table(spark, f"{lake.gold}/fact_transactions").select("transaction_id", "device_type", "order_value", "fraud_label")


def gold_table(load: str, name: str) -> Query:
    def read(spark, folder):
        lake = run_initial_load(spark, folder) if load == "initial" else run_both_loads(spark, folder)[0]
        rows = read_table(spark, f"{lake.gold}/{name}")
        return shown(rows) if "ingested_at" in rows.columns else rows

    return read


# The Gold tables that no other query of these loads returns.
for _load in ("initial", "incremental"):
    for _name in ("dim_customer", "dim_product", "dim_payment", "dim_date"):
        QUERIES[f"{_load}_{_name}"] = gold_table(_load, _name)
QUERIES["initial_behavior"] = gold_table("initial", "fact_behavior")


def run_both_loads(spark, folder) -> tuple[loads.Lake, dict[str, int]]:
    """A first load of the cheaper products and the customers seen so far, then everything as increment."""
    lake = loads.Lake(scratch_path(spark, "lake"))
    tables = views.retail_tables(spark, folder)
    first = {
        **tables,
        "customers": tables["customers"].join(tables["behavior"], "customer_id", "left_semi"),
        "products": tables["products"].filter("price < 950"),
        "behavior": tables["behavior"].filter("return_rate < 0.2"),
    }
    loads.run(spark, "initial", lake, first, RUN_TS)
    return lake, loads.run(spark, "incremental", lake, tables, RUN_TS)


@query
def incremental_load(spark, folder):
    lake, _ = run_both_loads(spark, folder)
    return shown(read_table(spark, f"{lake.gold}/fact_transactions"))


@query
def incremental_behavior(spark, folder):
    lake, _ = run_both_loads(spark, folder)
    return shown(read_table(spark, f"{lake.gold}/fact_behavior"))


@query
def incr_new_rows(spark, folder):
    _, entered = run_both_loads(spark, folder)
    return spark.createDataFrame(sorted(entered.items()), "table_name string, rows bigint")
