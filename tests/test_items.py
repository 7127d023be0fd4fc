import base64
import json
import random
import shutil
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from storelake.functions.keys import hour_parts, iso_timestamp
from storelake.plans import catalog
from storelake.plans import retail_views as views
from storelake.schemas import KEYED_RECORD, STORE_ITEM
from storelake.streaming import items

RECORD = {
    "transaction_id": "T1", "customer_id": "C1", "product_id": "P1", "order_date": "2024-01-02",
    "order_value": 10.5, "payment_method": "UPI", "device_type": "web", "discount_applied": 0.1,
    "shipping_delay_days": 2, "high_value_flag": 0,
}


def encoded(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return base64.b64encode(text.encode()).decode()


def keyed(spark, *records, first=0):
    rows = [("C", seq, encoded(r)) for seq, r in enumerate(records, first)]
    return spark.createDataFrame(rows, KEYED_RECORD)


def record(**changed):
    return {**RECORD, **changed}


def item_frame(spark, run_ts, *records):
    return items.store_items(items.decode_records(keyed(spark, *records)), F.lit(run_ts))


def stored_items(spark, run_ts, *records):
    return item_frame(spark, run_ts, *records).orderBy("seq").collect()


def test_item_fields(spark, run_ts):
    (row,) = stored_items(spark, run_ts, RECORD)
    assert row.asDict() == {
        "seq": 0, **RECORD, "order_value": "10.5", "discount_applied": "0.1",
        "ingested_at": "2024-07-01T12:30:00.000000",
    }


def test_item_defaults(spark, run_ts):
    (empty, nulls) = stored_items(spark, run_ts, {}, record(device_type=None, order_value=None))
    assert {empty[c] for c in STORE_ITEM.names[:4]} == {"UNKNOWN"}
    assert (empty.order_value, empty.discount_applied) == ("0", "0")
    assert (empty.shipping_delay_days, empty.high_value_flag) == (0, 0)
    assert (nulls.device_type, nulls.order_value) == ("UNKNOWN", "0")


def test_text_outside_ascii(spark, run_ts):
    (row,) = stored_items(spark, run_ts, json.dumps(record(device_type="téléphone"), ensure_ascii=False))
    assert row.device_type == "téléphone"


def test_ingestion_time_is_utc_in_any_session_zone(spark, run_ts, conf):
    conf(spark__sql__session__timeZone="Asia/Tokyo")
    (row,) = stored_items(spark, run_ts, RECORD)
    assert row.ingested_at == "2024-07-01T12:30:00.000000"


@pytest.mark.parametrize("bad", ["{", "null", "", record(shipping_delay_days="soon")])
def test_an_unreadable_record_fails_the_batch(spark, run_ts, bad):
    with pytest.raises(Exception):
        stored_items(spark, run_ts, RECORD, bad)


def test_alert_bound_is_strict(spark, run_ts):
    values = [990, 990.01, "991.5", None, 5, "NaN"]
    frame = item_frame(spark, run_ts, *[record(order_value=v) for v in values])
    assert sorted(r.order_value for r in items.alerts(frame).collect()) == [990.01, 991.5]
    assert items.alerts(frame, threshold=4).count() == 4


def test_alert_fields(spark, run_ts):
    full, sparse = items.alerts(item_frame(spark, run_ts, record(order_value=2000), {"order_value": 3000})).collect()
    assert full.asDict() == {
        "transaction_id": "T1", "customer_id": "C1", "order_value": 2000.0, "payment_method": "UPI",
        "order_date": "2024-01-02",
    }
    assert tuple(sparse) == (None, None, 3000.0, None, None)


def test_latest_per_key_matches_brute_force(spark, run_ts):
    rng = random.Random(3)
    records = [record(transaction_id=f"T{rng.choice([0, 0, 0, rng.randrange(40)])}", order_value=n) for n in range(300)]
    frame = item_frame(spark, run_ts, *records)
    got = {r.transaction_id: r.seq for r in items.latest_per_key(frame, ["seq"]).collect()}
    assert got == {r["transaction_id"]: n for n, r in enumerate(records)}


def write_batch(spark, run_ts, tmp_path, batch_id, *records, first=0):
    log, alerts = str(tmp_path / "log"), str(tmp_path / "alerts")
    items.batch_writer(log, alerts, F.lit(run_ts))(keyed(spark, *records, first=first), batch_id)
    return log, alerts


def values(spark, log):
    return {r.transaction_id: r.order_value for r in items.current_items(spark, log).collect()}


def test_alert_messages_name_every_field(spark, run_ts, tmp_path):
    _, alerts = write_batch(spark, run_ts, tmp_path, 0, {"order_value": 3000})
    (line,) = [r.value for r in spark.read.text(alerts).collect()]
    assert json.loads(line) == {
        "transaction_id": None, "customer_id": None, "order_value": 3000.0, "payment_method": None, "order_date": None,
    }


def test_last_batch_wins_and_replay_changes_nothing(spark, run_ts, tmp_path):
    one = [record(order_value=1), record(order_value=2000), record(transaction_id="T2", order_value=5)]
    two = [record(order_value=3)]
    write_batch(spark, run_ts, tmp_path, 0, *one)
    log, alerts = write_batch(spark, run_ts, tmp_path, 1, *two)

    def state():
        rows = sorted(map(tuple, items.read_log(spark, log).collect()))
        messages = sorted(map(tuple, items.read_alerts(spark, alerts).collect()))
        return values(spark, log), rows, messages

    before = state()
    assert before[0] == {"T1": "3", "T2": "5"}
    assert len(before[1]) == 4 and len(before[2]) == 1
    write_batch(spark, run_ts, tmp_path, 0, *one)
    write_batch(spark, run_ts, tmp_path, 1, *two)
    assert state() == before


def test_empty_batch_writes_nothing(spark, run_ts, tmp_path):
    log, alerts = write_batch(spark, run_ts, tmp_path, 0)
    assert items.read_log(spark, log).isEmpty() and not (tmp_path / "alerts").exists()
    assert list((tmp_path / "log").iterdir()) == [] and items.current_items(spark, log).isEmpty()
    write_batch(spark, run_ts, tmp_path, 1, record(order_value=1))
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["batch_id=1"] and list((tmp_path / "alerts").iterdir()) == []


def test_a_batch_that_fails_leaves_nothing_to_see(spark, run_ts, tmp_path):
    with pytest.raises(Exception):
        write_batch(spark, run_ts, tmp_path, 0, record(), "{")
    assert all(p.name.startswith("_") for p in (tmp_path / "log").iterdir())
    log, _ = write_batch(spark, run_ts, tmp_path, 0, record(order_value=4))
    assert values(spark, log) == {"T1": "4"}


def test_replay_adds_lost_alerts_only(spark, run_ts, tmp_path):
    log, alerts = write_batch(spark, run_ts, tmp_path, 0, record(order_value=2000))
    files = sorted(p for p in (tmp_path / "log").rglob("*.parquet"))
    shutil.rmtree(f"{alerts}/batch_id=0")
    write_batch(spark, run_ts, tmp_path, 0, record(order_value=2000))
    assert items.read_alerts(spark, alerts).count() == 1
    assert sorted(p for p in (tmp_path / "log").rglob("*.parquet")) == files


def test_a_log_is_folded_while_it_grows(spark, run_ts, tmp_path):
    draw, wanted, first = random.Random(5), {}, 0
    log = str(tmp_path / "log")
    for batch in range(6):
        records = [record(transaction_id=f"T{draw.choice([0, 0, draw.randrange(60)])}", order_value=first + n) for n in range(25)]
        write_batch(spark, run_ts, tmp_path, batch, *records, first=first)
        first += len(records)
        wanted.update({r["transaction_id"]: str(r["order_value"]) for r in records})
        if batch in (1, 2, 4):
            some = range(0, items.BUCKETS, 2) if batch == 2 else range(items.BUCKETS)  # half a fold, as after a failure
            assert items.fold_items(spark, log, some) == batch
        assert values(spark, log) == wanted
        write_batch(spark, run_ts, tmp_path, 0, *records, first=first)  # a late replay of a folded batch
        assert values(spark, log) == wanted
    assert sorted(int(p.name.split("=")[1]) for p in (tmp_path / "log").glob("batch_id=*")) == [2, 3, 4, 5]
    assert items.folded_up_to(spark, log) == [4] * items.BUCKETS
    plan = items.current_items(spark, log)._jdf.queryExecution().executedPlan().toString()
    assert "(batch_id#" in plan and "> 4)" in plan
    assert len(list((tmp_path / "log-base" / "bucket=0").glob("upto=*"))) <= 2
    items.compact_items(spark, log, str(tmp_path / "new"))
    assert values(spark, str(tmp_path / "new")) == wanted
    assert items.fold_items(spark, log) == 5 and items.fold_items(spark, log) == 5
    assert values(spark, log) == wanted


def test_a_stream_restarts_after_an_unreadable_record(spark, run_ts, tmp_path):
    """The second of three files cannot be read at first."""
    source, spare = tmp_path / "in", tmp_path / "spare"
    records = [record(transaction_id=f"T{n % 11}", order_value=960 + n) for n in range(90)]
    for n in range(3):
        part = records[30 * n : 30 * n + 30]
        keyed(spark, *part, first=30 * n).coalesce(1).write.parquet(str(spare / str(n)))
    keyed(spark, *records[30:45], '{"order_value": ', first=30).coalesce(1).write.parquet(str(spare / "bad"))
    source.mkdir()

    def put(name, into):
        shutil.copy(next((spare / name).glob("*.parquet")), source / f"{into}.parquet")

    for name, into in (("0", "0"), ("bad", "1"), ("2", "2")):
        put(name, into)
        time.sleep(0.02)
    stream = spark.readStream.schema(KEYED_RECORD).option("maxFilesPerTrigger", 1).parquet(str(source))
    log, alerts = str(tmp_path / "log"), str(tmp_path / "alerts")

    def run():
        items.start_upsert(stream, log, alerts, str(tmp_path / "ck"), F.lit(run_ts)).awaitTermination()

    for _ in range(2):  # the same batch fails again
        with pytest.raises(Exception):
            run()
        assert values(spark, log) == {r["transaction_id"]: str(r["order_value"]) for r in records[:30]}
    put("1", "1")
    for _ in range(2):  # nothing is repeated
        run()
    assert values(spark, log) == {r["transaction_id"]: str(r["order_value"]) for r in records}
    assert items.read_log(spark, log).count() == 90
    assert items.read_alerts(spark, alerts).count() == sum(r["order_value"] > 990 for r in records)


def test_compacted_log_takes_later_batches(spark, run_ts, tmp_path):
    log, _ = write_batch(spark, run_ts, tmp_path, 0, record(order_value=1), record(transaction_id="T2"))
    write_batch(spark, run_ts, tmp_path, 1, record(order_value=2), first=2)
    new_log = str(tmp_path / "new")
    items.compact_items(spark, log, new_log)
    assert values(spark, new_log) == values(spark, log) == {"T1": "2", "T2": "10.5"}
    assert items.read_log(spark, new_log).count() == 2
    write = items.batch_writer(new_log, str(tmp_path / "alerts"), F.lit(run_ts))
    write(keyed(spark, record(order_value=9), first=3), 2)
    assert values(spark, new_log) == {"T1": "9", "T2": "10.5"}


def test_stream_over_several_batches_equals_the_batch_result(spark, run_ts, tmp_path):
    source = tmp_path / "in"
    records = [record(transaction_id=f"T{n % 7}", order_value=900 + n) for n in range(120)]
    for start in (0, 40, 80):
        keyed(spark, *records[start : start + 40], first=start).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(KEYED_RECORD).option("maxFilesPerTrigger", 1).parquet(str(source))
    log, alerts = str(tmp_path / "log"), str(tmp_path / "alerts")
    for _ in range(2):  # the second start finds nothing new
        items.start_upsert(stream, log, alerts, str(tmp_path / "ck"), F.lit(run_ts)).awaitTermination()
    assert values(spark, log) == {r["transaction_id"]: str(r["order_value"]) for r in records}
    assert items.read_log(spark, log).select("batch_id").distinct().count() == 3
    assert items.read_alerts(spark, alerts).count() == sum(r["order_value"] > 990 for r in records)


def test_items_are_combined_before_the_shuffle(spark, run_ts):
    frame = items.latest_per_key(item_frame(spark, run_ts, RECORD), ["seq"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning(transaction_id")
    assert plan.index("functions=[max_by") < shuffle < plan.index("partial_max_by")


def test_the_stream_does_not_shuffle(spark, run_ts):
    plan = item_frame(spark, run_ts, RECORD)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_counters_are_logged(spark, run_ts, tmp_path, caplog):
    with caplog.at_level("INFO", logger="storelake.streaming.items"):
        write_batch(spark, run_ts, tmp_path, 7, *[record(order_value=v) for v in (1, 2, 5000)])
    assert "batch 7: 3 written, 1 alerted" in caplog.text


def test_ingestion_time_of_a_running_stream(spark, tmp_path):
    keyed(spark, RECORD).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(KEYED_RECORD).parquet(str(tmp_path / "in"))
    before = datetime.now(timezone.utc).replace(tzinfo=None)
    log = str(tmp_path / "log")
    items.start_upsert(stream, log, str(tmp_path / "alerts"), str(tmp_path / "ck")).awaitTermination()
    (row,) = items.current_items(spark, log).collect()
    after = datetime.now(timezone.utc).replace(tzinfo=None)
    assert before <= datetime.fromisoformat(row.ingested_at) <= after


@pytest.mark.parametrize("instant", ["2024-03-10T02:30:00.000001", "2024-11-03T06:30:00.000000", "1969-12-31T23:59:59.999999"])
def test_utc_text_where_the_session_zone_switches(spark, conf, instant):
    conf(spark__sql__session__timeZone="America/New_York")
    at = spark.range(1).select(F.lit(instant + "Z").cast("timestamp").alias("at"))
    row = at.select(iso_timestamp(F.col("at")).alias("text"), *[c.alias(n) for n, c in hour_parts(F.col("at")).items()]).first()
    assert row.text == instant
    assert f"{row.year}-{row.month}-{row.day}T{row.hour}" == instant[:13]


def test_a_batch_of_the_folded_stream_is_shared_by_tasks(spark, conf, tmp_path):
    """F16: one task wrote the input of each batch, and so one task decoded it."""
    conf(spark__sql__adaptive__coalescePartitions__minPartitionSize="1b")
    paths = catalog.input_files(spark, SMALL, str(tmp_path), 4)
    parts = [spark.read.schema(KEYED_RECORD).parquet(path) for path in paths]
    assert all(part.select(F.input_file_name()).distinct().count() > 1 for part in parts)
    seqs = [sorted(r.seq for r in part.collect()) for part in parts]
    assert sum(seqs, []) == sorted(r.seq for r in views.keyed_records(spark, SMALL).collect())
    (one,) = catalog.input_files(spark, SMALL, str(tmp_path / "one"), 1, one_file=True)
    assert spark.read.schema(KEYED_RECORD).parquet(one).select(F.input_file_name()).distinct().count() == 1
