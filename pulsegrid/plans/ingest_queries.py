"""Decoding, validation, duplicates, dead letters, storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.payloads import payload_amount, payload_value
from ..functions.requests import with_request_defaults
from ..functions.timing import DAY, HOUR, between_ms, event_date, event_hour
from ..operators.analytics import merge_replayed
from ..operators.dedup import dedup_increment, drop_duplicates, drop_seen
from ..operators.ingest import batch_summary, flag_late, validate
from ..session import shared_dir
from ..sources.canonical import latest_ms, load_events
from ..sources.decode import decode_batches, decode_events, encode_events
from ..sources.tables import (
    from_dead_letters, read_raw_events, replay, retain, table_health, to_dead_letters, write_raw_events,
)
from ..operators.views import events_per_minute, revenue_per_hour
from .fixtures import checked, statuses, text_of
from .registry import check_sql, query


def _keyed(spark, sf_dir):
    return load_events(spark, sf_dir).withColumn("key", F.concat_ws(":", "user_id", "event_type"))


@query("decode_events", check_sql("""
    SELECT seq, CASE WHEN bad THEN '' ELSE id END AS id, CASE WHEN bad THEN '' ELSE tenant_id END AS tenant_id,
           CASE WHEN bad THEN '' ELSE user_id END AS user_id, CASE WHEN bad THEN 0 ELSE timestamp END AS timestamp,
           CASE WHEN bad THEN '' ELSE k END AS k, CASE WHEN bad THEN 1.0 ELSE value END AS value,
           CASE WHEN bad THEN 'invalid JSON' ELSE '' END AS error
    FROM (SELECT *, seq % 20 = 0 AS bad FROM canon)"""))
def decode_events_query(spark, sf_dir):
    events = load_events(spark, sf_dir)
    broken = F.pmod("seq", F.lit(20)) == 0
    cut_open = F.when(broken, F.concat(F.lit("["), F.col("value"))).otherwise(F.col("value"))
    messages = encode_events(events, keep=["seq"]).select("seq", cut_open.alias("value"))
    out = decode_events(messages)
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return out.select(
        "seq", blank("id"), blank("tenant_id"), blank("user_id"),
        F.coalesce("timestamp", F.lit(0).cast("bigint")).alias("timestamp"),
        F.coalesce(F.element_at("labels", "k"), F.lit("")).alias("k"),
        payload_value("payload").alias("value"),
        F.coalesce("decode_error", F.lit("")).alias("error"),
    )


@query("batch_envelope_explode", check_sql("""
    SELECT batch_id, CASE WHEN kind IN (7, 8) THEN -1 ELSE pos END AS pos,
           CASE WHEN kind IN (7, 8) THEN '' ELSE id END AS id,
           CASE WHEN kind IN (7, 8) THEN 0 ELSE timestamp END AS timestamp,
           CASE kind WHEN 7 THEN 'invalid JSON' WHEN 8 THEN 'events must be 1-1000' ELSE '' END AS error
    FROM (SELECT *, seq // 100 AS batch_id, seq % 100 AS pos, (seq // 100) % 10 AS kind FROM canon)
    WHERE kind NOT IN (7, 8) OR pos = 0"""))
def batch_envelope_explode(spark, sf_dir):
    events = load_events(spark, sf_dir)
    encoded = encode_events(events, keep=["seq"])
    keyed = encoded.select(F.expr("seq div 100").alias("batch_id"), "seq", F.col("value").alias("json"))
    kind = F.pmod("batch_id", F.lit(10))
    # At most 100 texts per batch, by the definition of batch_id.
    envelopes = keyed.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("seq", "json"))).alias("e"))
    text = F.concat(F.lit('{"events":['), F.array_join(F.transform("e", lambda x: x.json), ","), F.lit("]}"))
    messages = envelopes.select(
        "batch_id",
        F.when(kind == 7, F.concat(F.lit("["), text))
        .when(kind == 8, F.lit('{"events":[]}'))
        .otherwise(text)
        .alias("value"),
    )
    return decode_batches(messages, "batch_id").select(
        "batch_id",
        F.coalesce("pos", F.lit(-1)).cast("bigint").alias("pos"),
        F.coalesce("id", F.lit("")).alias("id"),
        F.coalesce("timestamp", F.lit(0).cast("bigint")).alias("timestamp"),
        F.coalesce("decode_error", F.lit("")).alias("error"),
    )


@query("ingest_validate", check_sql(
    "SELECT seq, id, tenant_id, event_type, timestamp, CAST(version AS INTEGER) AS version, error FROM checked",
    "checked"))
def ingest_validate(spark, sf_dir):
    return checked(spark, sf_dir).select(
        "seq", "id", "tenant_id", "event_type", "timestamp", "version",
        F.coalesce("error", F.lit("")).alias("error"),
    )


@query("ingest_status", check_sql("SELECT seq, status FROM statuses", "statuses"))
def ingest_status_query(spark, sf_dir):
    return statuses(spark, sf_dir).select("seq", "status")


@query("ingest_batch_summary", check_sql("""
    SELECT seq // 100 AS batch_id, count(*) FILTER (status = 'accepted') AS accepted,
           count(*) FILTER (status <> 'accepted') AS rejected,
           coalesce(string_agg(status, '|' ORDER BY seq) FILTER (status NOT IN ('accepted', 'duplicate')), '') AS errors,
           CASE WHEN count(*) FILTER (status = 'accepted') = 0 THEN 'bad_request' ELSE 'accepted' END AS batch_status
    FROM statuses GROUP BY 1""", "statuses"))
def ingest_batch_summary(spark, sf_dir):
    rows = statuses(spark, sf_dir).select(
        F.expr("seq div 100").alias("batch_id"), F.expr("cast(seq % 100 AS int)").alias("pos"), "status"
    )
    return batch_summary(rows).withColumn("errors", text_of("errors"))


@query("dedup_24h", """
    WITH RECURSIVE v AS (SELECT 'user-' || user_id || ':' || event_type AS key, epoch_us(ts) // 1000 AS timestamp,
                                event_id AS seq FROM events),
    chain(key, t) AS (
        SELECT key, min(timestamp) FROM v GROUP BY key
        UNION ALL
        SELECT c.key, min(v.timestamp) FROM chain c JOIN v ON v.key = c.key AND v.timestamp >= c.t + 86400000
        GROUP BY c.key)
    SELECT v.key, v.timestamp, min(v.seq) AS seq FROM v JOIN chain c ON v.key = c.key AND v.timestamp = c.t
    GROUP BY v.key, v.timestamp""")
def dedup_24h(spark, sf_dir):
    return drop_duplicates(_keyed(spark, sf_dir), ["key"]).select("key", "timestamp", "seq")


@query("dedup_against_seen", check_sql("""
    , keyed AS (SELECT user_id || ':' || event_type AS key, timestamp, seq FROM canon)
    SELECT i.key, i.timestamp, i.seq FROM keyed i, clock
    WHERE i.timestamp >= now - 259200000 AND NOT EXISTS (
        SELECT 1 FROM keyed s, clock c
        WHERE s.key = i.key AND s.timestamp < c.now - 259200000 AND i.timestamp - s.timestamp < 86400000)
    """, "clock"))
def dedup_against_seen(spark, sf_dir):
    rows = _keyed(spark, sf_dir).select("key", "timestamp", "seq")
    cut = latest_ms(rows) - F.lit(3 * DAY)
    return drop_seen(rows.where(F.col("timestamp") >= cut), rows.where(F.col("timestamp") < cut), ["key"])


@query("dedup_increment", check_sql("""
    , keyed AS (SELECT user_id || ':' || event_type AS key, timestamp, seq FROM canon),
    v AS (
        SELECT i.key, i.timestamp, i.seq FROM keyed i, clock
        WHERE i.timestamp >= now - 432000000 AND NOT EXISTS (
            SELECT 1 FROM keyed s, clock c
            WHERE s.key = i.key AND s.timestamp < c.now - 432000000 AND i.timestamp - s.timestamp < 86400000)),
    steps(key, t) AS (
        SELECT key, min(timestamp) FROM v GROUP BY key
        UNION ALL
        SELECT c.key, min(v.timestamp) FROM steps c JOIN v ON v.key = c.key AND v.timestamp >= c.t + 86400000
        GROUP BY c.key)
    SELECT v.key, v.timestamp, min(v.seq) AS seq FROM v JOIN steps c ON v.key = c.key AND v.timestamp = c.t
    GROUP BY v.key, v.timestamp""", "clock"))
def dedup_increment_query(spark, sf_dir):
    rows = _keyed(spark, sf_dir).select("key", "timestamp", "seq")
    cut = latest_ms(rows) - F.lit(5 * DAY)
    new, old = rows.where(F.col("timestamp") >= cut), rows.where(F.col("timestamp") < cut)
    return dedup_increment(new, old, ["key"])


@query("dlq_records", check_sql("""
    SELECT id, tenant_id, event_type, error, now AS failed_at, CAST(3 AS INTEGER) AS attempts
    FROM checked, clock WHERE error <> ''""", "checked", "clock"))
def dlq_records(spark, sf_dir):
    now = latest_ms(load_events(spark, sf_dir))
    dlq = to_dead_letters(checked(spark, sf_dir), "error", now)
    return dlq.select(
        "original_event.id", "original_event.tenant_id", "original_event.event_type", "error", "failed_at", "attempts"
    )


@query("dlq_reprocess", check_sql("""
    SELECT id, CASE WHEN tenant_id = '' THEN 'tenant-recovered' ELSE tenant_id END AS tenant_id,
           CASE WHEN event_type = '' OR bad_payload THEN 'invalid event' ELSE '' END AS error
    FROM checked WHERE error <> ''""", "checked"))
def dlq_reprocess(spark, sf_dir):
    dlq = to_dead_letters(checked(spark, sf_dir), "error", latest_ms(load_events(spark, sf_dir)))
    fixed = from_dead_letters(dlq).withColumn(
        "tenant_id", F.coalesce(F.nullif("tenant_id", F.lit("")), F.lit("tenant-recovered"))
    )
    return validate(fixed).select("id", "tenant_id", F.coalesce("error", F.lit("")).alias("error"))


@query("replay_range", check_sql("""
    SELECT id, timestamp, false AS notify FROM canon, clock
    WHERE timestamp BETWEEN now - 259200000 AND now - 86400000""", "clock"))
def replay_range(spark, sf_dir):
    events = load_events(spark, sf_dir)
    now = latest_ms(events)
    return replay(events, now - F.lit(3 * DAY), now - F.lit(DAY)).select("id", "timestamp", "notify")


@query("replay_merge", check_sql("""
    SELECT id, tenant_id, timestamp FROM canon, clock WHERE seq % 10 <> 3 OR timestamp >= now - 604800000""", "clock"))
def replay_merge(spark, sf_dir):
    events = load_events(spark, sf_dir).select("id", "tenant_id", "timestamp", "seq")
    stored = events.where(F.pmod("seq", F.lit(10)) != 3)
    again = replay(events, latest_ms(events) - F.lit(7 * DAY)).drop("notify")
    return merge_replayed(stored, again.unionByName(again)).select("id", "tenant_id", "timestamp")


@query("retention_90d", check_sql("""
    SELECT id, timestamp FROM canon, clock
    WHERE CAST(make_timestamp(timestamp * 1000) AS DATE)
          >= CAST(make_timestamp((now + 6912000000) * 1000) AS DATE) - 90""", "clock"))
def retention_90d(spark, sf_dir):
    events = load_events(spark, sf_dir)
    return retain(events, latest_ms(events) + F.lit(80 * DAY)).select("id", "timestamp")


@query("event_calendar_cols", check_sql("""
    SELECT id, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS event_date,
           timestamp - timestamp % 3600000 AS event_hour_ms,
           strftime(make_timestamp(timestamp * 1000), '%Y%m') AS month FROM canon"""))
def event_calendar_cols(spark, sf_dir):
    day = event_date("timestamp")
    return load_events(spark, sf_dir).select(
        "id",
        day.cast("string").alias("event_date"),
        F.unix_millis(event_hour("timestamp")).alias("event_hour_ms"),
        F.date_format(day, "yyyyMM").alias("month"),
    )


@query("late_arrivals", check_sql("""
    SELECT id, (seq % 20) * 60000 > 300000 AS is_late,
           CASE WHEN (seq % 20) * 60000 > 300000 THEN 'true' ELSE '' END AS late_label, k FROM canon"""))
def late_arrivals(spark, sf_dir):
    events = load_events(spark, sf_dir)
    received = events.withColumn("received_at", F.col("timestamp") + F.pmod("seq", F.lit(20)) * 60000)
    return flag_late(received).select(
        "id",
        "is_late",
        F.coalesce(F.element_at("labels", "late_arrival"), F.lit("")).alias("late_label"),
        F.element_at("labels", "k").alias("k"),
    )


@query("payload_value_rule", check_sql("""
    , p AS (
      SELECT seq, event_type, CASE seq % 10
        WHEN 0 THEN '{"value":' || CAST(value AS VARCHAR) || ',"amount":' || CAST(value AS VARCHAR) || '}'
        WHEN 1 THEN '{"value":"12.5","amount":"12.5"}' WHEN 2 THEN '{"value":true,"amount":true}'
        WHEN 3 THEN '{"value":null,"amount":null}' WHEN 4 THEN '{"other":1}'
        WHEN 5 THEN '{"value":{"x":1},"amount":[1]}' WHEN 6 THEN '{"value":1.5e3,"amount":"junk"}'
        WHEN 7 THEN '{broken' WHEN 8 THEN '{"value":' || CAST(seq AS VARCHAR) || ',"amount":-3}' END AS payload FROM canon),
    j AS (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS d FROM p)
    SELECT seq,
      CASE WHEN json_type(d, '$.value') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
           THEN CAST(json_extract_string(d, '$.value') AS DOUBLE) ELSE 1.0 END AS value,
      CASE WHEN event_type <> 'purchase' THEN 0.0
           ELSE coalesce(CASE WHEN json_type(d, '$.amount') IN ('DOUBLE', 'BIGINT', 'UBIGINT', 'VARCHAR')
                              THEN TRY_CAST(json_extract_string(d, '$.amount') AS DOUBLE) END, 0.0) END AS amount
    FROM j"""))
def payload_value_rule(spark, sf_dir):
    m = F.pmod("seq", F.lit(10)).cast("int")
    number = F.col("value").cast("string")
    shapes = F.create_map(
        F.lit(0), F.concat(F.lit('{"value":'), number, F.lit(',"amount":'), number, F.lit("}")),
        F.lit(1), F.lit('{"value":"12.5","amount":"12.5"}'),
        F.lit(2), F.lit('{"value":true,"amount":true}'),
        F.lit(3), F.lit('{"value":null,"amount":null}'),
        F.lit(4), F.lit('{"other":1}'),
        F.lit(5), F.lit('{"value":{"x":1},"amount":[1]}'),
        F.lit(6), F.lit('{"value":1.5e3,"amount":"junk"}'),
        F.lit(7), F.lit("{broken"),
        F.lit(8), F.concat(F.lit('{"value":'), F.col("seq").cast("string"), F.lit(',"amount":-3}')),
    )
    return load_events(spark, sf_dir).withColumn("payload", F.try_element_at(shapes, m)).select(
        "seq",
        payload_value("payload").alias("value"),
        F.when(F.col("event_type") == "purchase", payload_amount("payload")).otherwise(F.lit(0.0)).alias("amount"),
    )


@query("request_defaults", check_sql("""
    , r AS (SELECT seq, now,
        CASE seq % 8 WHEN 0 THEN k WHEN 1 THEN '0' WHEN 2 THEN '-1' WHEN 3 THEN '1440' WHEN 4 THEN 'abc'
                     WHEN 5 THEN '' WHEN 6 THEN '1439' ELSE '12.5' END AS minutes,
        CASE WHEN seq % 3 = 0 THEN CAST(timestamp AS VARCHAR) ELSE 'x' END AS f,
        CASE WHEN seq % 5 = 0 THEN 'tumbling_1h' ELSE '' END AS w, timestamp, k FROM canon, clock)
    SELECT seq, CASE WHEN seq % 8 = 0 THEN CASE WHEN CAST(k AS BIGINT) BETWEEN 1 AND 1439 THEN CAST(k AS BIGINT) ELSE 5 END
                     WHEN seq % 8 = 6 THEN 1439 ELSE 5 END AS minutes_used,
           CASE WHEN f = 'x' THEN now - 3600000 ELSE timestamp END AS from_used, now AS to_used,
           CASE WHEN w = '' THEN 'tumbling_1m' ELSE w END AS window_used FROM r""", "clock"))
def request_defaults(spark, sf_dir):
    events = load_events(spark, sf_dir)
    odd = F.array(*[F.lit(x) for x in ["0", "-1", "1440", "abc", "", "1439", "12.5"]])
    m = F.pmod("seq", F.lit(8)).cast("int")
    requests = events.select(
        "seq",
        F.when(m == 0, F.element_at("labels", "k")).otherwise(F.element_at(odd, F.greatest(m, F.lit(1)))).alias("minutes"),
        F.when(F.pmod("seq", F.lit(3)) == 0, F.col("timestamp").cast("string")).otherwise(F.lit("x")).alias("from"),
        F.lit("").alias("to"),
        F.when(F.pmod("seq", F.lit(5)) == 0, F.lit("tumbling_1h")).otherwise(F.lit("")).alias("window"),
    )
    return with_request_defaults(requests, latest_ms(events)).select(
        "seq", "minutes_used", "from_used", "to_used", "window_used"
    )


@query("table_health", check_sql("""
    SELECT 'raw_events' AS "table", count(*) AS total_rows FROM canon
    UNION ALL SELECT 'events_per_minute', count(*) FROM
        (SELECT DISTINCT tenant_id, event_type, timestamp // 60000 FROM canon)
    UNION ALL SELECT 'revenue_per_hour', count(*) FROM (SELECT DISTINCT tenant_id, timestamp // 3600000 FROM canon)"""))
def table_health_query(spark, sf_dir):
    events = load_events(spark, sf_dir)
    return table_health(
        {
            "raw_events": events,
            "events_per_minute": events_per_minute(events),
            "revenue_per_hour": revenue_per_hour(events),
        }
    )


@query("table_bytes", """
    SELECT 'events' AS "table", count(*) AS total_rows, true AS bytes_ok FROM events""")
def table_bytes(spark, sf_dir):
    """Rows, and whether the bytes of the files lie between one bit and 1,000 bytes a row."""
    health = table_health({"events": spark.read.parquet(f"{sf_dir}/events.parquet")}, with_bytes=True)
    return health.select("table", "total_rows", F.expr("total_bytes BETWEEN total_rows / 8 AND total_rows * 1000").alias("bytes_ok"))


@query("stored_events_slice", check_sql("""
    SELECT id, tenant_id, event_type, timestamp, value FROM canon, clock
    WHERE tenant_id = 'tenant-acme' AND timestamp BETWEEN now - 172800000 AND now - 86400000""", "clock"))
def stored_events_slice(spark, sf_dir):
    """Write the raw table, then read one tenant's day range from it: only those partitions."""
    events = load_events(spark, sf_dir)
    now = latest_ms(events)
    path = shared_dir(spark, "raw-events")
    write_raw_events(events, path)
    stored = read_raw_events(spark, path).where(F.col("tenant_id") == "tenant-acme")
    return between_ms(stored, now - F.lit(2 * DAY), now - F.lit(24 * HOUR)).select(
        "id", "tenant_id", "event_type", "timestamp", "value"
    )
