from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowsieve.operators import cleaning, profiling, validation
from flowsieve.schemas import FLOW_SCHEMA, FORBIDDEN_FIELDS, NUMERIC_FEATURES, OUTPUT_FIELDS


def test_mixed_labels_text_and_infinities(spark):
    df = spark.createDataFrame([(1, "0", " Normal ", 10.5), (2, "1.0", "Exploits", float("inf"))],
                               "id int, label string, attack_cat string, rate double")
    rows = {r["id"]: r for r in cleaning.clean_split(df).collect()}
    assert (rows[1]["label"], rows[2]["label"]) == (0, 1)
    assert rows[2]["rate"] is None and rows[1]["attack_cat"] == "Normal"


def test_normal_is_enforced(spark):
    df = spark.createDataFrame([(1, 0, "Generic"), (2, 1, "Generic")], "id int, label int, attack_cat string")
    assert {r["id"]: r["attack_cat"] for r in cleaning.clean_split(df).collect()} == {1: "Normal", 2: "Generic"}


@pytest.mark.parametrize("bad", ["2", "0.5", "x", None])
def test_bad_label_stops_the_job(spark, bad):
    df = spark.createDataFrame([(1, "0"), (2, bad)], "id int, label string")
    with pytest.raises(PySparkException, match="unexpected label"):
        cleaning.clean_label(df).collect()
    assert cleaning.label_violations(df).first()["n_invalid"] == 1


def test_text_is_stripped_of_every_blank(spark):
    df = spark.createDataFrame([("\t tcp \r\n\x1f", None)], "proto string, service string")
    assert tuple(cleaning.clean_strings(df).first()) == ("tcp", None)
    assert cleaning.clean_strings(df, null_token="nan").first()["service"] == "nan"


@pytest.mark.parametrize(("names", "expected"), [(["Backdoors"], ["Backdoor"]), (["Backdoors", "Backdoor"], ["Backdoors", "Backdoor"])])
def test_alias_renamed_only_without_the_correct_name(spark, names, expected):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, attack_cat string")
    assert [r["attack_cat"] for r in cleaning.rename_alias(df).orderBy("id").collect()] == expected


def test_no_row_is_lost(spark):
    df = spark.createDataFrame([(i, i % 2, "x", float("nan")) for i in range(50)], "id int, label int, attack_cat string, r double")
    assert cleaning.row_guard(df, cleaning.clean_split(df)).first()["preserved"]
    with pytest.raises(RuntimeError):
        cleaning.require_same_rows(2, 1)


def test_feature_projection_keeps_order():
    assert len(NUMERIC_FEATURES) == 39 and len(FLOW_SCHEMA.fields) == 45


def test_projection_drops_identifier_and_targets(spark):
    df = spark.createDataFrame([], FLOW_SCHEMA)
    assert cleaning.project_features(df).columns == [c for c in df.columns if c not in ("id", "label", "attack_cat")]
    assert len(cleaning.project_features(df).columns) == 42


def test_null_and_infinity_profiles_count_nan(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "a"), (float("-inf"), "b"), (None, "c")], "x double, s string")
    assert {r[0]: r[1] for r in profiling.null_profile(df).collect()} == {"x": 2, "s": 1}
    assert {r[0]: r[1] for r in profiling.inf_profile(df).collect()} == {"x": 1}


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, label int, attack_cat string, x double")
    row = profiling.split_profile(df).first()
    assert (row["n_rows"], row["total_missing"], row["exact_duplicates"]) == (0, 0, 0)
    assert profiling.target_distribution(df).count() == 0


def test_missing_is_a_value_in_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "s string")
    got = {r["s"]: (r["n_rows"], r["pct"]) for r in profiling.value_counts(df, "s").collect()}
    assert got == {"a": (2, 66.667), None: (1, 33.333)}
    assert {r["s"]: r["pct"] for r in profiling.value_counts(df, "s", 2, drop_missing=True).collect()} == {"a": 66.67}


def test_schema_differences(spark):
    left = spark.createDataFrame([], "a int, b string, c double")
    right = spark.createDataFrame([], "a int, c float, d string")
    got = {r["column_name"]: r["status"] for r in profiling.schema_diff(left, right).collect()}
    assert got == {"a": "match", "b": "left_only", "c": "type_mismatch", "d": "right_only"}


# ---- validation -------------------------------------------------------------


def test_numeric_text_rules(spark):
    df = spark.createDataFrame([(1, "5"), (2, ""), (3, None), (4, "abc"), (5, "1e3")], "id int, dur string")
    checked = validation.validate_rows(df, ["dur"])
    assert {r["id"] for r in validation.rejected(checked).collect()} == {4}
    with pytest.raises(PySparkException, match="not_numeric:dur"):
        validation.apply_policy(checked, "fail").collect()
    kept = validation.as_numbers(validation.apply_policy(checked, "quarantine"), ["dur"])
    assert {r["id"]: r["dur"] for r in kept.collect()} == {1: 5.0, 2: None, 3: None, 5: 1000.0}
    with pytest.raises(ValueError, match="on_error"):
        validation.apply_policy(checked, "ignore")


def test_domain_rules_and_protocol(spark):
    df = spark.createDataFrame([(1, 80, "  UDP  ", 1.0, 0), (2, -1, "tcp", 0.0, 1), (3, 70000, "tcp", -2.0, 2)],
                               "id int, sport int, proto string, dur double, label int")
    rows = {r["id"]: r for r in validation.validate_domain(df).collect()}
    assert rows[1]["proto"] == "udp" and rows[1][validation.REASONS] == []
    assert rows[2][validation.REASONS] == ["port:sport"]
    assert rows[3][validation.REASONS] == ["port:sport", "negative:dur", "label:label"]


def test_probabilities_round_before_the_range_rule(spark):
    df = spark.createDataFrame([(1, 1.00001), (2, 1.1), (3, None)], "id int, p double")
    rows = {r["id"]: r for r in validation.validate_probabilities(df, ["p"]).collect()}
    assert rows[1]["p"] == 1.0 and rows[1][validation.REASONS] == []
    assert rows[2][validation.REASONS] == ["range:p"] and rows[3][validation.REASONS] == []


def test_missing_feature_columns_fail_before_running(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="missing 1 required"):
        validation.strip_ground_truth(df, ["a", "b"])


def test_ground_truth_never_leaves(spark):
    df = spark.createDataFrame([tuple(range(8))], ", ".join(f"{c} int" for c in [*FORBIDDEN_FIELDS, "a", "id"]))
    assert validation.strip_ground_truth(df, ["a"], keep=["id", *FORBIDDEN_FIELDS]).columns == ["id", "a"]
    assert not set(validation.display_projection(df).columns) & set(FORBIDDEN_FIELDS)
    with pytest.raises(RuntimeError, match="forbidden"):
        validation.output_projection(df, ["a", "label"])
    assert not set(OUTPUT_FIELDS) & set(FORBIDDEN_FIELDS)


def test_attack_only_refuses_leaked_normals(spark):
    df = spark.createDataFrame([(1, 0, "Normal"), (2, 1, "DoS")], "id int, label int, attack_cat string")
    assert [r["id"] for r in validation.attack_only(df).collect()] == [2]
    with pytest.raises(PySparkException, match="normal row"):
        validation.attack_only(df.withColumn("label", F.lit(1))).collect()


def test_split_profile_shuffles_digests_that_tell_rows_apart(spark):
    """Nulls in other places, signed zeros and NaN count as grouping on the values would; wide text is not shuffled."""
    rows = [("a", 1, "x", None, 0.0), ("b", 1, None, "x", -0.0), ("c", 1, None, "x", 0.0), ("c", 1, None, "x", 0.0),
            ("d", None, "1", "x", float("nan")), ("e", None, "1", "x", float("nan")), ("f", 1, None, "x", None)]
    df = spark.createDataFrame(rows, "id string, n int, s string, t string, v double").withColumn("split", F.lit("train"))
    profile = profiling.split_profile(df, by="split")
    row = profile.first()
    assert (row.n_rows, row.exact_duplicates, row.duplicates_without_id) == (7, 1, 3)
    plan = profile._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") >= 4  # two aggregates, each on two hashes in place of the columns
