from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowsieve.operators import alerts as al, triage as tr
from flowsieve.schemas import ACTIONS, ALERT_SCHEMA, DEFAULT_ACTION, OUTPUT_FIELDS, triage_dimension

CLASSES = ["DoS", "Normal", "Worms"]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        (0, 0.79999, [0.9, 0.05, 0.05]), (1, 0.8, [0.2, 0.7, 0.1]), (2, 0.95, [0.1, 0.1, 0.8]),
        (3, 0.9, [0.3, 0.4, 0.3]), (4, float("nan"), [0.5, 0.2, 0.3]), (5, 0.99, [0.87654, 0.0, 0.12346]),
    ]
    return spark.createDataFrame(rows, "record_index long, p double, probs array<double>")


def test_two_stages(scored):
    rows = {r["record_index"]: r for r in tr.triage(scored, CLASSES).collect()}
    quiet = rows[0]
    assert (quiet["prediction"], quiet["attack_type"], quiet["severity"]) == ("Normal", "Normal", "None")
    assert quiet["multiclass_probability"] is None and quiet["confidence"] == 0.2
    assert quiet["recommended_action"] == ACTIONS["Normal"]
    assert rows[1]["attack_type"] == "DoS" and rows[1]["multiclass_probability"] == 0.2  # Normal was the maximum
    assert rows[2]["attack_type"] == "Worms" and rows[2]["severity"] == "Critical"
    assert rows[3]["attack_type"] == "DoS"  # first of the tied attack classes
    assert rows[4]["prediction"] == "Normal"
    assert rows[5]["confidence"] == 0.8765 and rows[5]["binary_confidence"] == 0.99


def test_threshold_override_and_column(scored):
    assert tr.triage(scored, CLASSES, threshold=0.96).filter("is_attack").count() == 1
    mixed = tr.triage(scored, CLASSES, threshold=F.when(F.col("record_index") == 2, 0.99).otherwise(0.8))
    assert {r["record_index"] for r in mixed.filter("is_attack").collect()} == {1, 3, 5}


def test_bypass_scores_flagged_rows_only_and_agrees(scored):
    seen = []

    def stage_two(rows):
        seen.append(rows.select("record_index"))
        return rows.withColumn("probs", F.col("model_output"))

    out = tr.triage_with_bypass(scored.withColumnRenamed("probs", "model_output"), stage_two, CLASSES)
    assert {r[0] for r in seen[0].collect()} == {1, 2, 3, 5}
    columns = ["record_index", "attack_type", "confidence", "severity"]
    assert sorted(map(tuple, out.select(columns).collect())) == sorted(map(tuple, tr.triage(scored, CLASSES).select(columns).collect()))


def test_unknown_type_gets_defaults(spark):
    df = spark.createDataFrame([(0, 0.9, [0.1, 0.9])], "record_index long, p double, probs array<double>")
    r = tr.triage(df, ["Normal", "Zero-day"]).first()
    assert (r["severity"], r["recommended_action"]) == ("Critical", DEFAULT_ACTION)
    looked = tr.triage_lookup(spark.createDataFrame([("DoS",), ("Zero-day",)], "attack_type string"), triage_dimension(spark))
    assert {r["attack_type"]: r["severity"] for r in looked.collect()} == {"DoS": "Critical", "Zero-day": "Critical"}


def test_events_have_the_closed_schema(scored):
    events = tr.as_events(tr.triage(scored, CLASSES), "run").select(*OUTPUT_FIELDS)
    assert [(f.name, f.dataType) for f in events.schema.fields] == [(f.name, f.dataType) for f in ALERT_SCHEMA.fields]
    ids = [r["event_id"] for r in events.collect()]
    assert len(set(ids)) == 6
    assert set(ids) == {r["event_id"] for r in tr.as_events(tr.triage(scored.repartition(3), CLASSES), "run").collect()}


def test_harmonise_fills_both_spellings(spark):
    df = spark.createDataFrame([(True, 0.87654, "DoS", 0.91234)],
                               "is_attack boolean, binary_confidence double, attack_category string, multi_confidence double")
    r = tr.harmonize(df).first()
    assert (r["prediction"], r["attack_type"], r["severity"]) == ("Attack", "DoS", "Critical")
    assert (r["binary_probability"], r["multiclass_probability"], r["confidence"]) == (0.8765, 0.9123, 0.9123)
    assert r["binary_threshold"] == 0.8


def test_harmonise_defaults(spark):
    df = spark.createDataFrame([(None, 0.3, None), ("Attack", 0.9, "Odd")], "prediction string, binary_probability double, attack_type string")
    a, b = sorted(tr.harmonize(df).collect(), key=lambda r: r["binary_probability"])
    assert (a["prediction"], a["attack_type"], a["severity"], a["attack_category"]) == ("Normal", "Normal", "None", None)
    assert a["binary_confidence"] == 0.7 and a["confidence"] == 0.7
    assert (b["severity"], b["confidence"], b["recommended_action"]) == ("Critical", 0.9, ACTIONS["Normal"])


# ---- alert analytics --------------------------------------------------------


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id string, timestamp string, prediction string, severity string, confidence double, binary_probability double, recommended_action string, attack_type string")


def _row(i, prediction, severity, confidence=0.5, when="2024-01-01T00:00:00"):
    return (str(i), when, prediction, severity, confidence, confidence, "x" * 60, "DoS")


@pytest.mark.parametrize(("severities", "risk"), [
    ([], "—"), (["None"], "Normal"), (["None", "Medium"], "Medium"), (["High", "Medium"], "High"), (["High", "Critical"], "Critical")])
def test_summary_risk_precedence(spark, severities, risk):
    rows = [_row(i, "Normal" if s == "None" else "Attack", s, 0.25 * (i + 1)) for i, s in enumerate(severities)]
    r = al.alert_summary(_events(spark, rows)).first()
    assert r["risk_level"] == risk and r["total"] == len(rows) == r["normal"] + r["attacks"]
    expected = sum(0.25 * (i + 1) for i in range(len(rows))) / len(rows) if rows else 0.0
    assert r["avg_confidence"] == pytest.approx(expected)


def test_histogram_edges(spark):
    rows = [_row(i, "Normal", "None", v) for i, v in enumerate([0.0, 0.0499, 0.05, 0.999, 1.0])]
    got = {r["bin"]: r["n_events"] for r in al.histogram(_events(spark, rows), "confidence", 20).collect()}
    assert got == {0: 2, 1: 1, 19: 2}


def test_latest_and_actions_and_timeline(spark):
    rows = [_row(i, "Attack" if i % 2 else "Normal", "High", when=f"2024-01-01T00:00:{i:02d}") for i in range(20)]
    rows.append(_row(99, "Attack", "High", when="soon"))
    df = _events(spark, rows)
    assert [r["event_id"] for r in al.latest_attacks(df.filter("timestamp <> 'soon'")).collect()] == ["19", "17", "15", "13", "11"]
    action = al.top_actions(df).first()
    assert action["action"] == "x" * 55 + "…" and action["n_events"] == 21
    assert al.timeline(df).count() == 20
    assert al.detail(df, "7").count() == 1


def test_alert_rows_have_seven_columns(spark):
    df = _events(spark, [_row(1, "Attack", "High"), _row(2, "Normal", "None")]).withColumns(
        {"srcip": F.lit("a"), "dstip": F.lit("b"), "proto": F.lit("tcp")})
    rows = tr.alert_rows(df).orderBy("attack_category").collect()
    assert len(rows[0]) == 7 and rows[0]["attack_category"] is None and rows[1]["is_attack"]


def test_newest_row_per_key(spark):
    df = spark.createDataFrame([("a", 0, 5, "x"), ("a", 1, 2, "y"), ("b", 0, 1, "z")], "event_id string, batch_seq int, record_index int, v string")
    assert {r["event_id"]: r["v"] for r in al.newest_per_key(df).collect()} == {"a": "y", "b": "z"}
