import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from storelake.functions.text import to_number
from storelake.operators import ingest
from storelake.operators import validation as rules
from storelake.operators.lateral import computed_once
from storelake.sources.requests import decode_requests
from storelake.plans import retail_views as views
from storelake.streaming import publish
from storelake.streaming.publish import batch_writer, from_kafka, read_published, read_rejections, start_publish

GOOD = {"customer_id": "C1", "product_id": "P1", "order_value": 10, "payment_method": "UPI"}


def requests(spark, *bodies):
    texts = [b if isinstance(b, str) or b is None else json.dumps(b) for b in bodies]
    return spark.createDataFrame(list(enumerate(texts)), "request_id int, body string")


def checked(spark, *transactions):
    """One request per transaction."""
    return ingest.check(decode_requests(requests(spark, *[{"transactions": [t]} for t in transactions])))


def messages(spark, *transactions):
    rows = ingest.error_messages(checked(spark, *transactions)).orderBy("request_id", "no").collect()
    return [[r.message for r in rows if r.request_id == i] for i in range(len(transactions))]


def built(spark, run_ts, *transactions, **options):
    frame = ingest.build(ingest.accepted(checked(spark, *transactions)), F.lit(run_ts), **options)
    return frame.collect()


def test_request_shapes(spark):
    bodies = {
        "{": rules.INVALID_JSON,
        "": rules.INVALID_JSON,
        "{'transactions': []}": rules.INVALID_JSON,
        '{"transactions": [{"customer_id": "C1"}, {"cust': rules.INVALID_JSON,
        "{}": rules.NO_TRANSACTIONS,
        "[1]": rules.NO_TRANSACTIONS,
        '{"orders": []}': rules.NO_TRANSACTIONS,
        '{"transactions": null}': rules.NOT_A_LIST,
        '{"transactions": {"a": 1}}': rules.NOT_A_LIST,
        '{"transactions": "x"}': rules.NOT_A_LIST,
        '{"transactions": []}': rules.EMPTY_LIST,
        json.dumps({"transactions": [GOOD]}): None,
        json.dumps({"transactions": [GOOD] * 100}): None,
        json.dumps({"transactions": [GOOD] * 101}): rules.LIST_TOO_LONG,
    }
    decoded = decode_requests(requests(spark, *bodies)).orderBy("request_id").collect()
    assert {r.body: r.shape_error for r in decoded} == bodies


def test_required_fields_in_order(spark):
    got = messages(
        spark,
        GOOD,
        {**GOOD, "customer_id": "", "payment_method": None},
        {},
        {**GOOD, "order_value": ""},
    )
    missing = [f"Missing required field: {f}" for f in rules.REQUIRED_FIELDS]
    assert got == [
        [],
        [missing[0], missing[3]],
        [*missing, "order_value must be a number"],
        [missing[2], "order_value must be a number"],
    ]


@pytest.mark.parametrize(
    "value, wanted",
    [
        (0, "order_value must be greater than 0"),
        (-1, "order_value must be greater than 0"),
        (0.01, None),
        (10000, None),
        (10000.01, "order_value must be less than 10000"),
        ("991.5", None),
        (" 12 ", None),
        ("1e3", None),
        ("Infinity", "order_value must be less than 10000"),
        ("-inf", "order_value must be greater than 0"),
        ("abc", "order_value must be a number"),
        ("NaN", "order_value must be a number"),
        ("12d", "order_value must be a number"),
        ("0x1p3", "order_value must be a number"),
        (True, "order_value must be a number"),
        ([1], "order_value must be a number"),
    ],
)
def test_order_value_rules(spark, value, wanted):
    assert messages(spark, {**GOOD, "order_value": value}) == [[wanted] if wanted else []]


def test_bare_nan_is_no_number(spark):
    body = '{"transactions": [{"customer_id": "C", "product_id": "P", "order_value": NaN, "payment_method": "UPI"}]}'
    errors = ingest.error_messages(ingest.check(decode_requests(requests(spark, body)))).collect()
    assert [e.message for e in errors] == ["order_value must be a number"]


def test_payment_domain(spark):
    wanted = "payment_method must be one of: UPI, Debit Card, Credit Card, PayPal, Crypto"
    got = messages(spark, *[{**GOOD, "payment_method": method} for method in ("Cash", 0, "Crypto")])
    assert got == [[wanted], [wanted], []]


def test_optional_numbers_must_be_readable(spark):
    got = messages(
        spark,
        {**GOOD, "discount_applied": "x", "shipping_delay_days": "soon"},
        {**GOOD, "discount_applied": 0.5, "shipping_delay_days": 3},
        {**GOOD, "shipping_delay_days": 1e12},
    )
    late = "shipping_delay_days must be a number"
    assert got == [["discount_applied must be a number", late], [], [late]]


def test_one_bad_transaction_rejects_its_request(spark, run_ts):
    bad = {**GOOD, "order_value": 0}
    frame = requests(spark, {"transactions": [GOOD, bad, GOOD]}, {"transactions": [GOOD, GOOD]}, "{")
    verdicts = ingest.check(decode_requests(frame))
    good = ingest.accepted(verdicts).collect()
    assert [(r["request_id"], r["index"]) for r in good] == [(1, 0), (1, 1)]
    rejected = {r.request_id: r for r in ingest.rejections(verdicts).collect()}
    assert {i: r.error for i, r in rejected.items()} == {0: rules.VALIDATION_FAILED, 2: rules.INVALID_JSON}
    assert [(e["index"], e.messages) for e in rejected[0].errors] == [(1, ["order_value must be greater than 0"])]


def test_defaults_of_a_built_record(spark, run_ts):
    (row,) = built(spark, run_ts, {**GOOD, "transaction_id": "", "order_date": ""})
    assert row.order_date == "2024-07-01"
    assert (row.device_type, row.discount_applied, row.shipping_delay_days) == ("Unknown", 0.0, 0)
    assert row.transaction_id.startswith("TXN") and len(row.transaction_id) == 67
    assert row.transaction_id == row.transaction_id.upper()


def test_given_values_are_kept(spark, run_ts):
    given = {
        **GOOD, "customer_id": 7, "transaction_id": "T1", "order_date": "2024-01-02", "device_type": "",
        "discount_applied": "0.25", "shipping_delay_days": 3.9,
    }
    (row,) = built(spark, run_ts, given)
    assert (row.transaction_id, row.customer_id, row.order_date) == ("T1", "7", "2024-01-02")
    assert (row.device_type, row.discount_applied, row.shipping_delay_days) == ("", 0.25, 3)


def test_generated_ids_are_stable_and_may_be_shortened(spark, run_ts):
    rows = [GOOD, {**GOOD, "customer_id": "C2"}]
    first, again = (sorted(r.transaction_id for r in built(spark, run_ts, *rows)) for _ in range(2))
    assert first == again and len(set(first)) == 2
    short = built(spark, run_ts, *rows, hex_digits=32)
    assert {len(r.transaction_id) for r in short} == {35}


@pytest.mark.parametrize(
    "value, rounded, flag",
    [(950.004, 950.0, 0), (950.01, 950.01, 1), (950, 950.0, 0), (2.675, 2.68, 0), (0.125, 0.13, 0)],
)
def test_flag_looks_at_the_rounded_value(spark, run_ts, value, rounded, flag):
    (row,) = built(spark, run_ts, {**GOOD, "order_value": value})
    assert (row.order_value, row.high_value_flag) == (rounded, flag)


def test_keyed_json(spark, run_ts):
    good = ingest.accepted(checked(spark, {**GOOD, "transaction_id": "T1"}))
    frame = ingest.to_keyed_json(ingest.build(good, F.lit(run_ts)))
    (row,) = frame.collect()
    assert row.key == "C1"
    assert json.loads(row.value) == {
        "transaction_id": "T1", "customer_id": "C1", "product_id": "P1", "order_date": "2024-07-01",
        "order_value": 10.0, "payment_method": "UPI", "device_type": "Unknown", "discount_applied": 0.0,
        "shipping_delay_days": 0, "high_value_flag": 0,
    }


def test_counters_ride_along(spark, run_ts):
    frame = requests(spark, {"transactions": [GOOD, GOOD]}, {"transactions": [{}]}, "{", {"transactions": [GOOD]})
    counters = Observation()
    verdicts = ingest.check(decode_requests(frame))
    counted = verdicts.observe(counters, *[c.alias(n) for n, c in ingest.request_metrics(verdicts).items()])
    assert ingest.accepted(counted).count() == 3
    assert counters.get == {"requests": 4, "rejected": 2, "sent": 3}


def test_number_grammar(spark):
    texts = ["1", "-1.5", "+.5", "5.", "1E3", "1_0", "1,5", "", " ", "d", "1f", "nan", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", to_number(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == {
        "1": 1.0, "-1.5": -1.5, "+.5": 0.5, "5.": 5.0, "1E3": 1000.0, "1_0": None, "1,5": None, "": None,
        " ": None, "d": None, "1f": None, "nan": None, None: None,
    }


def test_parsing_is_not_repeated_by_filters(spark):
    frame = requests(spark, {"transactions": [GOOD]})
    plan = ingest.accepted(ingest.check(decode_requests(frame)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_computed_once_keeps_rows_and_nulls(spark):
    df = computed_once(spark.range(3), twice=F.when(F.col("id") > 0, F.col("id") * 2)).filter("id < 2")
    assert sorted(map(tuple, df.collect())) == [(0, None), (1, 2)]


def test_a_stream_publishes_what_a_batch_does(spark, run_ts, tmp_path):
    bodies = [{"transactions": [GOOD, {**GOOD, "transaction_id": f"T{n}", "order_value": n}]} for n in range(-2, 30)]
    frame = requests(spark, *bodies, "{")
    frame.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for _ in range(2):  # the second start publishes nothing
        start_publish(stream, out, str(tmp_path / "ck"), F.lit(run_ts)).awaitTermination()
    wanted = sorted(map(tuple, publish.messages(frame, F.lit(run_ts)).collect()))
    assert len(wanted) == 2 * 29
    assert sorted(map(tuple, read_published(spark, out).collect())) == wanted
    rejected = read_rejections(spark, out).collect()
    assert len(rejected) == 4 and {r.error for r in rejected} == {"Validation failed", "Invalid JSON in request body"}


def test_a_replayed_batch_is_counted_and_changes_nothing(spark, run_ts, tmp_path):
    frame = requests(spark, {"transactions": [GOOD, GOOD]}, {"transactions": [{**GOOD, "order_value": -1}]}, "{")
    counted = {}
    write = batch_writer(str(tmp_path), F.lit(run_ts), on_counted=counted.__setitem__)
    for _ in range(2):
        write(frame, 7)
    assert counted == {7: {"requests": 3, "rejected": 2, "sent": 2}}
    assert read_published(spark, str(tmp_path)).count() == 2
    errors = {r.error: r.errors for r in read_rejections(spark, str(tmp_path)).collect()}
    assert errors["Invalid JSON in request body"] is None
    assert [tuple(e) for e in errors["Validation failed"]] == [(0, ["order_value must be greater than 0"])]


def test_generated_ids_are_distinct(spark, run_ts):
    frame = views.requests(spark, "/root/testdata/sf0.1")
    built = ingest.build(ingest.accepted(ingest.check(decode_requests(frame))), F.lit(run_ts))
    made = built.filter("transaction_id like 'TXN%'").select("transaction_id")
    assert made.count() == made.distinct().count() > 10_000


def test_kafka_frames_keep_the_order_of_a_key(spark):
    frame = spark.createDataFrame([(b"C1", b"{}", 0, 5)], "key binary, value binary, partition int, offset long")
    assert from_kafka(frame).collect() == [("C1", 5, "e30=")]
    rows = [(b"C1", b"{}", 1, 5), (b"C2", b"{}", 0, 7), (b"C1", b"{}", 1, 2), (b"C2", b"{}", 0, 1 << 40)]
    two = spark.createDataFrame(rows, "key binary, value binary, partition int, offset long")
    assert [r.key for r in from_kafka(two).orderBy("seq").collect()] == ["C2", "C2", "C1", "C1"]


def test_a_reader_of_published_folders_sees_no_file_twice(spark, run_ts, tmp_path):
    one = requests(spark, {"transactions": [GOOD]}, "{")
    write = batch_writer(str(tmp_path), F.lit(run_ts))
    write(one, 0)
    seen = sorted(str(p) for p in tmp_path.rglob("*.json"))
    write(one, 0)
    write(one.limit(0), 1)
    write(requests(spark, "{"), 2)
    assert sorted(str(p) for p in tmp_path.rglob("*.json") if "batch_id=0" in str(p)) == seen
    assert [p.name for p in (tmp_path / "messages").iterdir()] == ["batch_id=0"]
    assert sorted(p.name for p in (tmp_path / "rejections").iterdir()) == ["batch_id=0", "batch_id=2"]


def test_orders_without_a_date_take_the_day_of_the_stream(spark, tmp_path):
    requests(spark, {"transactions": [GOOD]}).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("request_id int, body string").parquet(str(tmp_path / "in"))
    days = {datetime.now(timezone.utc).date().isoformat()}
    start_publish(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    days.add(datetime.now(timezone.utc).date().isoformat())
    (row,) = read_published(spark, str(tmp_path / "out")).collect()
    assert json.loads(row.value)["order_date"] in days
