"""Registered queries that run as Structured Streaming, drained and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowsieve.functions.scalars import round_to
from flowsieve.functions.scale import discard
from flowsieve.operators import validation as va
from flowsieve.plans.catalog import query
from flowsieve.plans.queries_data import _SUMMARY, _TEXT, _text_rows
from flowsieve.plans.queries_metrics import _triage_sql
from flowsieve.plans.views import FEATURES, alerts, alerts_of, probs, sql, table
from flowsieve.session import scratch_path
from flowsieve.sources.keyed import merge_rows, read_rows
from flowsieve.sources.readers import with_record_index
from flowsieve.sources.writers import read_events
from flowsieve.streaming import replay as st


def _staged(spark, df, label, batches=3):
    path = scratch_path(spark, label)
    files = st.stage_batches(df, path, batches)
    stream = st.read_stream(spark, path, df.schema, files_per_batch=files)
    stream.stored_at = path
    return stream


def _events_stream(spark, sf):
    return alerts_of(_staged(spark, table(spark, sf, "events"), "events"))


def _replay(spark, sf):
    """Events of a staged stream, and the stream. Every record keeps its own event, also where two records share an id."""
    records = with_record_index(probs(spark, sf), ["id", "spkts", "sbytes", "rate", "dur"])
    stream = _staged(spark, records, "replay")
    discard(records)  # the staged copy is all that is read from here
    return st.replay(stream, lambda rows: rows, "run-1", [*FEATURES, "p", "probs"]), stream


_REPLAYED = """
SELECT sha256('run-1|' || record_index) AS event_id, record_index, prediction, attack_type,
       binary_probability, binary_threshold, binary_confidence, multiclass_probability, confidence, severity, recommended_action
FROM events0"""


@query("replay_stream", sql(_REPLAYED, "probs", **_triage_sql(0.8)))
def _replay_stream(spark, sf):
    (events, stream), path = _replay(spark, sf), scratch_path(spark, "alerts")
    st.drain(st.start(events, "table", path, f"{path}-checkpoint"))
    discard(stream)
    return read_events(spark, path).drop("timestamp", "model_version")


@query("replay_sink", sql("""
SELECT fmt, prediction, severity, count(*) AS n_events FROM events0, (SELECT unnest(['jsonl', 'csv']) AS fmt)
GROUP BY fmt, prediction, severity""", "probs", **_triage_sql(0.8)))
def _replay_sink(spark, sf):
    (events, stream), out = _replay(spark, sf), None
    for fmt in ("jsonl", "csv"):
        path = scratch_path(spark, fmt)
        st.drain(st.start(events, fmt, path, f"{path}-checkpoint", compression="gzip"))
        part = st.read_sink(spark, fmt, path).select(F.lit(fmt).alias("fmt"), "prediction", "severity")
        out = part if out is None else out.unionByName(part)
    discard(stream)
    return out.groupBy("fmt", "prediction", "severity").agg(F.count("*").alias("n_events"))


@query("upsert_two_runs", sql("""
SELECT event_id, record_index, CAST(CASE WHEN record_index % 3 = 0 THEN 0.5 ELSE 0.8 END AS DOUBLE) AS binary_threshold
FROM events0 WHERE record_index % 2 = 0 OR record_index % 3 = 0""".replace("event_id", "sha256('run-1|' || record_index) AS event_id", 1), "probs", **_triage_sql(0.8)))
def _upsert_two_runs(spark, sf):
    """Two replays with new checkpoints into one table: both stay, and the later one wins where ids meet."""
    records, path = with_record_index(probs(spark, sf), ["id", "spkts", "sbytes", "rate", "dur"]), scratch_path(spark, "two-runs")
    for run, (step, threshold) in enumerate(((2, 0.8), (3, 0.5))):
        stream = _staged(spark, records.filter(F.col("record_index") % step == 0), f"run{run}", batches=2)
        events = st.replay(stream, lambda rows: rows, "run-1", [*FEATURES, "p", "probs"], threshold=threshold)
        st.drain(st.start(events, "table", path, f"{path}-checkpoint{run}"))
        discard(stream)
    discard(records)
    return read_events(spark, path).select("event_id", "record_index", "binary_threshold")


@query("keyed_merge", sql("""
SELECT event_id, record_index, prediction, CASE WHEN record_index % 97 = 0 THEN 'second' WHEN record_index % 10 = 3 THEN 'first' ELSE severity END AS severity
FROM alerts""", "alerts"))
def _keyed_merge(spark, sf):
    """Alerts in a keyed table of buckets, then two changes to some of them, the later one winning where they meet."""
    rows = alerts(spark, sf).select("event_id", "record_index", "prediction", "severity")
    path = scratch_path(spark, "keyed")
    for change in (rows, rows.filter("record_index % 10 = 3").withColumn("severity", F.lit("first")),
                   rows.filter("record_index % 97 = 0").withColumn("severity", F.lit("second"))):
        merge_rows(change, path, "event_id", buckets=16)
    return read_rows(spark, path)


@query("stream_summary", sql("SELECT total, normal, attacks, critical, round(avg_confidence, 6) AS avg_confidence, risk_level FROM s", "alerts", s=_SUMMARY))
def _stream_summary(spark, sf):
    path = scratch_path(spark, "summary")
    st.drain(st.start_batches(st.running_summary(_events_stream(spark, sf)), st.write_latest(path), f"{path}-checkpoint", mode="complete"))
    return st.read_latest(spark, path).withColumn("avg_confidence", round_to("avg_confidence", 6))


@query("stream_timeline", sql("""
SELECT strftime(date_trunc('hour', timestamp), '%Y-%m-%d %H:%M:%S') AS window_start, prediction, count(*) AS n_events,
       round(sum(binary_probability), 4) AS probability_sum FROM alerts GROUP BY 1, 2""", "alerts"))
def _stream_timeline(spark, sf):
    path = scratch_path(spark, "timeline")
    counts = st.running_timeline(_events_stream(spark, sf))
    st.drain(st.start_batches(counts, st.write_latest(path), f"{path}-checkpoint", mode="complete"))
    return st.read_latest(spark, path).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "prediction", "n_events",
        round_to(F.col("avg_probability") * F.col("n_events"), 4).alias("probability_sum"))


@query("stream_late_rows", sql("""
SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS window_start, prediction, count(*) FILTER (NOT late) AS n_events,
       round(coalesce(sum(binary_probability) FILTER (NOT late), 0), 4) AS probability_sum, count(*) FILTER (late) AS n_late
FROM sent GROUP BY 1, 2""", "alerts", sent="""
SELECT date_trunc('hour', timestamp) AS hour, prediction, binary_probability, false AS late FROM alerts
UNION ALL SELECT date_trunc('hour', timestamp), prediction, binary_probability,
       date_trunc('hour', timestamp) + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM alerts) - INTERVAL 1 HOUR
FROM alerts WHERE record_index % 50 = 0"""))
def _stream_late_rows(spark, sf):
    """Windows emitted as they close, and the rows that came after; every fiftieth event is sent again at the end."""
    events, path = table(spark, sf, "events"), scratch_path(spark, "late")
    last = F.lit(events.agg(F.max("ts")).first()[0]) + F.expr("INTERVAL 10 DAYS")
    closing = events.limit(1).withColumn("ts", last.cast(events.schema["ts"].dataType))  # moves the watermark past all windows
    stream = st.closed_windows(alerts_of(st.read_stream(spark, f"{path}-in/*", events.schema, None)))
    for turn, rows in enumerate((events, events.filter("event_id % 50 = 0").unionByName(closing))):
        rows.write.parquet(f"{path}-in/part={turn}")
        st.drain(st.start_batches(stream, st.write_latest(path), f"{path}-checkpoint"))
    out = st.read_batches(spark, path).groupBy("window_start", "prediction")
    return out.agg(
        F.sum("n_events").alias("n_events"), round_to(F.sum("value_sum"), 4).alias("probability_sum"), F.sum("n_late").alias("n_late"),
    ).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("dedup_events", sql("SELECT event_id, prediction, confidence FROM alerts", "alerts"))
def _dedup_events(spark, sf):
    events, path = table(spark, sf, "events"), scratch_path(spark, "dedup")
    repeated = events.unionByName(events.filter("event_id % 5 = 0"))
    unique = st.without_repeats(alerts_of(_staged(spark, repeated, "repeated")), late="60 days")
    st.drain(st.start_batches(unique, st.write_latest(path), f"{path}-checkpoint"))
    return st.read_batches(spark, path).select("event_id", "prediction", "confidence")


@query("stream_quarantine", sql("""
SELECT reason, count(*) AS n_rows FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM v WHERE reasons <> '')
GROUP BY reason UNION ALL SELECT 'accepted', count(*) FROM v WHERE reasons = ''""", "flows", v=_TEXT))
def _stream_quarantine(spark, sf):
    path = scratch_path(spark, "quarantine")
    checked = va.validate_rows(_staged(spark, _text_rows(spark, sf), "text"), ["spkts", "sttl"], required=["sttl"])
    st.drain(st.quarantine_batches(checked, f"{path}/good", f"{path}/bad", f"{path}-checkpoint"))
    good = st.read_batches(spark, f"{path}/good").agg(F.lit("accepted").alias("reason"), F.count("*").alias("n_rows"))
    return va.quarantine_counts(st.read_batches(spark, f"{path}/bad")).unionByName(good)
