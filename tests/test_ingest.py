import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pulsegrid.functions.payloads import payload_amount, payload_value, with_measures
from pulsegrid.operators.ingest import accept, apply_defaults, batch_summary, flag_late, ingest_status, resolve_tenant
from pulsegrid.schemas import EVENT, EVENT_COLUMNS
from pulsegrid.sources.decode import BAD_BATCH, BAD_JSON, decode_batches, decode_events, encode_events

NOW = 1_700_000_000_000


def events(spark, *overrides):
    base = dict(id="e", tenant_id="acme", user_id="u", event_type="click", source="web", timestamp=NOW, version=1,
                payload=None, labels=None)
    rows = [(*({**base, **o}[c] for c in EVENT_COLUMNS), i) for i, o in enumerate(overrides)]
    return spark.createDataFrame(rows, StructType(EVENT.fields + [StructField("seq", LongType())]))


def test_defaults(spark):
    row = apply_defaults(events(spark, {"id": "", "timestamp": 0, "version": 0}), NOW).first()
    assert len(row["id"]) == 36 and row["timestamp"] == NOW and row["version"] == 1


def test_given_values_stay(spark):
    row = apply_defaults(events(spark, {"id": "x", "timestamp": 5, "version": 3}), NOW).first()
    assert (row["id"], row["timestamp"], row["version"]) == ("x", 5, 3)


@pytest.mark.parametrize(
    "fault, status",
    [({}, "accepted"), ({"tenant_id": ""}, "tenant_id is required"), ({"tenant_id": None}, "tenant_id is required"),
     ({"event_type": ""}, "invalid event"), ({"tenant_id": "", "event_type": ""}, "tenant_id is required"),
     ({"payload": "{broken"}, "invalid event"), ({"payload": '{"a":1}'}, "accepted")],
)
def test_status(spark, fault, status):
    assert ingest_status(events(spark, fault)).first()["status"] == status


def test_second_copy_is_a_duplicate(spark):
    got = ingest_status(events(spark, {"id": "dup-123"}, {"id": "dup-123"}))
    assert sorted(r["status"] for r in got.collect()) == ["accepted", "duplicate"]


def test_invalid_event_does_not_block_its_id(spark):
    got = ingest_status(events(spark, {"event_type": "", "timestamp": NOW - 1}, {}))
    assert sorted(r["status"] for r in got.collect()) == ["accepted", "invalid event"]


def test_header_wins(spark):
    row = spark.range(1).select(resolve_tenant(F.lit("h"), F.lit("b")).alias("a"), resolve_tenant(F.lit(""), F.lit("b")).alias("c"))
    assert tuple(row.first()) == ("h", "b")


def summary(spark, faults):
    df = events(spark, *faults).withColumn("batch_id", F.lit(1))
    return batch_summary(ingest_status(df).withColumn("pos", F.col("seq"))).first()


def test_batch_of_valid_events(spark):
    row = summary(spark, [{"id": "a"}, {"id": "b"}])
    assert (row["accepted"], row["rejected"], row["errors"], row["batch_status"]) == (2, 0, [], "accepted")


def test_batch_with_faults(spark):
    row = summary(spark, [{"id": "a"}, {"id": "b", "tenant_id": ""}, {"id": "c", "event_type": ""}])
    assert (row["accepted"], row["rejected"]) == (1, 2)
    assert row["errors"] == ["tenant_id is required", "invalid event"]


def test_duplicates_count_without_text(spark):
    row = summary(spark, [{"id": "a"}, {"id": "a"}])
    assert (row["accepted"], row["rejected"], row["errors"]) == (1, 1, [])


def test_batch_without_accepted_events_is_bad(spark):
    assert summary(spark, [{"tenant_id": ""}])["batch_status"] == "bad_request"


def test_accept_is_the_whole_path(spark):
    row = accept(events(spark, {"id": "", "version": 0}), NOW, F.lit("made")).first()
    assert (row["id"], row["version"], row["status"]) == ("made", 1, "accepted")


def decode(spark, text):
    return decode_events(spark.createDataFrame([(text,)], "value string")).first()


@pytest.mark.parametrize("text", ["", "nope", "{", "[1]", '{"payload":3}', '{"payload":"x"}', '{"timestamp":"soon"}'])
def test_undecodable(spark, text):
    row = decode(spark, text)
    assert row["decode_error"] == BAD_JSON and row["raw"] == text


@pytest.mark.parametrize(
    "text",
    ['{"id":1}', '{"user_id":true}', '{"source":{"a":"b"}}', '{"event_type":["click"]}', '{"labels":{"a":1}}', '{"labels":{"a":"x","b":{}}}',
     '{"timestamp":1.5}', '{"payload":{"value":1e999}}', '{"value":-1e999}', '{"payload":{"a":[{"b":12e400}]}}', '{"id":"a","payload":{"v":' + "9" * 400 + "}}"],
)
def test_types_are_not_coerced(spark, text):
    row = decode(spark, text)
    assert row["decode_error"] == BAD_JSON and row["raw"] == text


@pytest.mark.parametrize(
    "text",
    ['{"id":"1","source":null,"labels":null}', '{"labels":{}}', '{"payload":{"note":"1e999 is \\"large\\" 9e999"}}', '{"payload":{"v":1e300,"w":1e-999}}',
     '{"payload":{"note":"Infinity"}}', '{"unknown":7}', "{}"],
)
def test_odd_but_decodable(spark, text):
    assert decode(spark, text)["decode_error"] is None


def test_batch_with_one_wrong_type(spark):
    text = '{"events":[{"id":"1"},{"id":"2","labels":{"a":3}}]}'
    rows = decode_batches(spark.createDataFrame([(1, text)], "batch bigint, value string"), "batch").collect()
    assert [(r["pos"], r["decode_error"]) for r in rows] == [(None, BAD_JSON)]


def test_decoded_fields(spark):
    row = decode(spark, json.dumps({"id": "1", "tenant_id": "t", "event_type": "e", "timestamp": 7,
                                    "payload": {"value": 2.5, "tag": "12"}, "labels": {"k": "v"}}))
    assert row["decode_error"] is None and row["labels"] == {"k": "v"} and row["timestamp"] == 7
    assert json.loads(row["payload"]) == {"value": 2.5, "tag": "12"}


def test_missing_and_null_payload_are_fine(spark):
    assert decode(spark, '{"id":"1"}')["decode_error"] is None
    row = decode(spark, '{"id":"1","payload":null}')
    assert row["decode_error"] is None and row["payload"] is None


def test_encode_then_decode(spark):
    df = events(spark, {"payload": '{"value":3}', "labels": {"a": "b"}})
    back = decode_events(encode_events(df).select("value")).first()
    assert (back["id"], back["payload"], back["labels"]) == ("e", '{"value":3}', {"a": "b"})


@pytest.mark.parametrize("n, ok", [(0, False), (1, True), (1000, True), (1001, False)])
def test_batch_sizes(spark, n, ok):
    text = json.dumps({"events": [{"id": str(i)} for i in range(n)]})
    rows = decode_batches(spark.createDataFrame([(1, text)], "batch bigint, value string"), "batch").collect()
    if ok:
        assert [(r["pos"], r["id"]) for r in rows] == [(i, str(i)) for i in range(n)]
    else:
        assert [(r["pos"], r["decode_error"]) for r in rows] == [(None, BAD_BATCH)]


def test_broken_batch(spark):
    rows = decode_batches(spark.createDataFrame([(1, '{"events":[{"id":1},')], "batch bigint, value string"), "batch").collect()
    assert [r["decode_error"] for r in rows] == [BAD_JSON]


@pytest.mark.parametrize(
    "payload, value, amount",
    [('{"value":2,"amount":3}', 2.0, 3.0), ('{"value":"2","amount":"3.5"}', 1.0, 3.5), ("{}", 1.0, 0.0),
     ('{"value":null,"amount":"x"}', 1.0, 0.0), ('{"value":true,"amount":true}', 1.0, 0.0), (None, 1.0, 0.0),
     ('{"value":12345678901234567890,"amount":-1e2}', 12345678901234567890.0, -100.0)],
)
def test_payload_numbers(spark, payload, value, amount):
    df = spark.createDataFrame([(payload,)], "payload string")
    row = df.select(payload_value("payload").alias("v"), payload_amount("payload").alias("a")).first()
    assert (row["v"], row["a"]) == (value, amount)


def test_measures_only_count_purchases(spark):
    rows = with_measures(events(spark, {"payload": '{"amount":5}'}, {"event_type": "purchase", "payload": '{"amount":5}'}))
    assert sorted((r["event_type"], r["amount"], r["value"]) for r in rows.collect()) == [("click", 0.0, 1.0), ("purchase", 5.0, 1.0)]


def test_late_boundary(spark):
    df = events(spark, {"id": "on", "labels": {"late_arrival": "no"}}, {"id": "late", "labels": {"a": "b"}})
    got = {r["id"]: r for r in flag_late(df.withColumn("received_at", F.col("timestamp") + F.when(F.col("id") == "on", 300_000).otherwise(300_001))).collect()}
    assert not got["on"]["is_late"]
    assert got["late"]["is_late"] and got["late"]["labels"] == {"a": "b", "late_arrival": "true"}
