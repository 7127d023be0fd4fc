import csv
import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from storelake.schemas import CHANGE_RECORD, STREAM_TXN
from storelake.streaming import changes

IMAGE = {
    "transaction_id": {"S": "T1"}, "customer_id": {"S": "C1"}, "product_id": {"N": "12"},
    "order_date": {"S": "2024-01-02"}, "order_value": {"S": "10.5"}, "payment_method": {"S": "UPI"},
    "device_type": {"S": 'a "b", c'}, "discount_applied": {"N": "0.1"}, "shipping_delay_days": {"N": "3"},
    "high_value_flag": {"N": "0"}, "ingested_at": {"S": "2024-01-02T00:00:00"},
}


def change(event="INSERT", **attributes):
    return {"eventName": event, "dynamodb": {"NewImage": {**IMAGE, **attributes}}}


def feed(spark, tmp_path, *records):
    path = tmp_path / "feed"
    path.mkdir(exist_ok=True)
    (path / "a.json").write_text("".join(json.dumps(r) + "\n" for r in records))
    return spark.read.schema(CHANGE_RECORD).json(str(path))


def test_only_new_rows_are_kept(spark, tmp_path):
    records = [
        change("INSERT", transaction_id={"S": "a"}),
        change("MODIFY", transaction_id={"S": "b"}),
        change("REMOVE", transaction_id={"S": "c"}),
        {"eventName": "INSERT", "dynamodb": {}},
        {"eventName": "INSERT", "dynamodb": {"NewImage": {}}},
        {"eventName": "INSERT"},
    ]
    rows = changes.decode_changes(feed(spark, tmp_path, *records)).collect()
    assert sorted(r.transaction_id for r in rows) == ["a", "b"]


def test_typed_attributes(spark, tmp_path):
    cases = {"12": {"N": "12"}, "1.5": {"N": "1.5"}, "1000.0": {"N": "1E3"}, "7.0": {"S": "7"}, "None": {"NULL": True}}
    records = [change(order_value=tag, transaction_id={"S": want}) for want, tag in cases.items()]
    rows = changes.decode_changes(feed(spark, tmp_path, *records)).collect()
    assert all(r.order_value == (None if r.transaction_id == "None" else float(r.transaction_id)) for r in rows)
    assert len(rows) == 5


def test_tag_precedence_and_text_columns(spark, tmp_path):
    frame = feed(spark, tmp_path, change(device_type={"N": "1", "S": "s"}, payment_method={"BOOL": True}))
    row = changes.decode_changes(frame).first()
    assert (row.device_type, row.payment_method, row.product_id) == ("s", "true", "12")
    assert changes.decode_changes(frame).schema == STREAM_TXN


def test_whole_numbers(spark, tmp_path):
    frame = feed(spark, tmp_path, change(shipping_delay_days={"N": "1E1"}, high_value_flag={"S": "1"}))
    row = changes.decode_changes(frame).first()
    assert (row.shipping_delay_days, row.high_value_flag) == (10, 1)


def test_attributes_under_other_tags(spark, tmp_path):
    tags = {
        '{"L":[{"S":"a"},{"N":"1"}]}': {"L": [{"S": "a"}, {"N": "1"}]}, '{"M":{"k":{"BOOL":true}}}': {"M": {"k": {"BOOL": True}}},
        '{"SS":["a","b"]}': {"SS": ["a", "b"]}, '{"NS":["1"]}': {"NS": ["1"]}, '{"B":"aGk="}': {"B": "aGk="},
        '{"BS":["aGk="]}': {"BS": ["aGk="]}, "{}": {}, "s": {"N": "1", "S": "s"}, "12": {"N": "012"}, "1.5": {"N": "1.50"},
        "1": {"N": "1", "BOOL": True}, "false": {"BOOL": False, "NULL": True}, "x": {"N": "x"},
        "12345678901234567890": {"N": "12345678901234567890"},
    }
    records = [change(device_type=tag, payment_method={"S": want}) for want, tag in tags.items()]
    nulls = [change(device_type=tag, payment_method={"S": "none"}) for tag in ({"NULL": True}, {"NULL": False}, {"S": None, "N": "1"})]
    rows = changes.decode_changes(feed(spark, tmp_path, *records, *nulls)).collect()
    assert len(rows) == len(tags) + 3
    assert all((r.device_type or "none") == r.payment_method for r in rows)


def test_landing_by_hour(spark, tmp_path, run_ts):
    records = [change(), change("REMOVE"), change("MODIFY", device_type={"NULL": True}, order_value={"S": "7"})]
    feed(spark, tmp_path, *records)
    stream = spark.readStream.schema(CHANGE_RECORD).json(str(tmp_path / "feed"))
    out = tmp_path / "bronze"
    for _ in range(2):  # the second start lands nothing
        changes.start_landing(stream, str(out), str(tmp_path / "ck"), F.lit(run_ts)).awaitTermination()
    files = list(out.glob("year=2024/month=07/day=01/hour=12/*.csv"))
    assert files
    text = files[0].read_bytes()
    assert b"\r" not in text
    header, *rows = csv.reader(text.decode().splitlines())
    assert header == STREAM_TXN.names
    assert ["T1", "C1", "12", "2024-01-02", "10.5", "UPI", 'a "b", c', "0.1", "3", "0"] in rows
    assert ["T1", "C1", "12", "2024-01-02", "7.0", "UPI", "", "0.1", "3", "0"] in rows
    landed = changes.read_landed(spark, str(out))
    assert landed.count() == 2
    assert {(r.year, r.month, r.day, r.hour) for r in landed.collect()} == {("2024", "07", "01", "12")}


def test_hours_are_pruned(spark, tmp_path, run_ts):
    rows = changes.by_hour(changes.decode_changes(feed(spark, tmp_path, change())), F.lit(run_ts))
    out = str(tmp_path / "out")
    rows.write.partitionBy("year", "month", "day", "hour").option("header", True).csv(out)
    plan = changes.read_landed(spark, out).filter("hour = '12'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan


def test_landing_does_not_shuffle(spark, tmp_path, run_ts):
    rows = changes.by_hour(changes.decode_changes(feed(spark, tmp_path, change())), F.lit(run_ts))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_landing_under_the_processing_hour(spark, tmp_path):
    feed(spark, tmp_path, change())
    stream = spark.readStream.schema(CHANGE_RECORD).json(str(tmp_path / "feed"))
    before = datetime.now(timezone.utc)
    changes.start_landing(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    row = changes.read_landed(spark, str(tmp_path / "out")).first()
    hours = {f"{t:%Y%m%d%H}" for t in (before, datetime.now(timezone.utc))}
    assert row.year + row.month + row.day + row.hour in hours


def test_line_breaks_in_landed_text(spark, tmp_path, run_ts):
    out = str(tmp_path / "out")
    changes.land(feed(spark, tmp_path, change(device_type={"S": "we\nb"})), out, F.lit(run_ts))
    (row,) = changes.read_landed(spark, out, multi_line=True).collect()
    assert (row.device_type, row.shipping_delay_days, row.hour) == ("we\nb", 3, "12")


def test_closed_hours_are_merged(spark, tmp_path, run_ts):
    source, out, merged = tmp_path / "feed", tmp_path / "out", str(tmp_path / "merged")
    source.mkdir()
    stream = spark.readStream.schema(CHANGE_RECORD).option("maxFilesPerTrigger", 1).json(str(source))
    for hour in range(3):
        for n in range(4):
            lines = [json.dumps(change(transaction_id={"S": f"T{hour}{n}{k}"}, device_type={"S": ' a,"b" '})) for k in range(5)]
            (source / f"{hour}{n}.json").write_text("\n".join(lines))
        at = F.lit(run_ts + timedelta(hours=hour))
        changes.start_landing(stream, str(out), str(tmp_path / "ck"), at).awaitTermination()
    assert changes.landed_hours(spark, str(out)) == [("2024", "07", "01", h) for h in ("12", "13", "14")]
    before = sorted(map(tuple, changes.read_landed(spark, str(out)).collect()))
    assert sorted(map(tuple, changes.read_merged(spark, str(out), merged).collect())) == before
    now = run_ts + timedelta(hours=2)
    assert [h[3] for h in changes.merge_hours(spark, str(out), merged, now)] == ["12", "13"]
    assert changes.merge_hours(spark, str(out), merged, now) == []
    assert len(list((out / "year=2024/month=07/day=01/hour=12").glob("*.csv"))) == 4
    assert len(list((tmp_path / "merged/year=2024/month=07/day=01/hour=12").glob("*.csv"))) == 1
    both = changes.read_merged(spark, str(out), merged)
    assert sorted(map(tuple, both.collect())) == before and len(before) == 60
    plan = both.filter("hour = '13'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "hour" in plan.split("PartitionFilters")[1]
    assert both.filter("hour = '14'").count() == 20


def test_a_closed_hour_can_take_several_files(spark, tmp_path, run_ts):
    records = [change(transaction_id={"S": f"T{n}"}) for n in range(200)]
    changes.land(feed(spark, tmp_path, *records).repartition(8), str(tmp_path / "out"), F.lit(run_ts))
    changes.merge_hours(spark, str(tmp_path / "out"), str(tmp_path / "merged"), run_ts + timedelta(hours=1), file_bytes=5000)
    assert 1 < len(list((tmp_path / "merged").rglob("*.csv"))) < 8
    assert changes.read_merged(spark, str(tmp_path / "out"), str(tmp_path / "merged")).count() == 200
