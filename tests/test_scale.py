"""Distribution helpers against plain Python, including hot keys and identical rows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsieve.functions import scale
from flowsieve.operators import profiling, quantiles, sampling


def test_running_totals_by_group(spark):
    rng = random.Random(1)
    rows = [(g, i, rng.randint(0, 9)) for g in ("a", "b") for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, v long").repartition(7)
    got = {(r["g"], r["k"]): r["cum_v"] for r in scale.running_totals(df, ["g"], [F.desc("k")], ["v"]).collect()}
    for g in ("a", "b"):
        total = 0
        for _, k, v in sorted((r for r in rows if r[0] == g), key=lambda r: -r[1]):
            total += v
            assert got[(g, k)] == total


def test_running_totals_spans_several_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))
        out = scale.running_totals(df, [], [F.asc("k")], ["v"])
        assert out.filter("cum_v <> k + 1").count() == 0 and out.count() == 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_global_row_number_is_a_permutation_in_order(spark):
    rows = [(i % 50, i) for i in range(1000)] + [(7, -1)] * 600
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    got = scale.global_row_number(df, [F.col("k"), F.col("v")], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(len(rows)))
    assert [(r["k"], r["v"]) for r in got] == sorted(rows)


@pytest.mark.parametrize("hot_share", [0.001, 0.2, 2.0])
def test_semi_join_with_hot_and_null_keys(spark, hot_share):
    left_rows = [(1, "x")] * 400 + [(None, "y")] * 30 + [(2, "z")] * 3 + [(3, None)] * 2 + [(9, "hot")] * 300
    right_rows = [(1, "x"), (None, "y"), (3, None), (5, "q")]
    left = spark.createDataFrame(left_rows, "a int, b string")
    right = spark.createDataFrame(right_rows, "a int, b string")
    got = Counter(tuple(r) for r in scale.semi_join_skew_safe(left, right, ["a", "b"], hot_share).collect())
    assert got == Counter(r for r in left_rows if r in right_rows)


def test_tagged_counts_treats_nulls_as_equal(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "b")], "x int, y string")
    b = spark.createDataFrame([(1, None), (3, "c")], "x int, y string")
    got = {(r["x"], r["y"]): (r["n_a"], r["n_b"]) for r in scale.tagged_counts({"a": a, "b": b}, ["x", "y"]).collect()}
    assert got == {(1, None): (2, 1), (2, "b"): (1, 0), (3, "c"): (0, 1)}


# ---- exact quantiles --------------------------------------------------------


@pytest.mark.parametrize("small", [quantiles._SMALL, 50])
def test_exact_quantiles_match_numpy(spark, monkeypatch, small):
    monkeypatch.setattr(quantiles, "_SMALL", small)
    rng = np.random.default_rng(3)
    smooth = rng.normal(size=5000)
    lumpy = np.where(rng.random(5000) < 0.4, 1.0, np.round(rng.random(5000), 1))
    rows = [(float(a), float(b), None if i % 3 else float(i)) for i, (a, b) in enumerate(zip(smooth, lumpy, strict=True))]
    rows += [(float("nan"), None, None)] * 40
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = {(r["feature"], r["prob"]): r["value"] for r in quantiles.exact_quantiles(df, ["a", "b", "c"], probs).collect()}
    columns = {"a": smooth, "b": lumpy, "c": np.arange(0, 5000, 3, dtype=float)}
    for name, values in columns.items():
        for p in probs:
            assert got[(name, p)] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantile_narrowing_loop_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_SMALL", 10)
    monkeypatch.setattr(quantiles, "_ACCURACY", 20)
    values = np.random.default_rng(5).random(4000)
    df = spark.createDataFrame([(float(v),) for v in values], "a double").repartition(4)
    row = quantiles.exact_quantiles(df, ["a"], [0.5]).first()
    assert row["value"] == pytest.approx(np.median(values), abs=1e-12)


def test_median_interpolates_and_skips_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "a double, b double")
    assert quantiles.exact_median(df, ["a", "b"]) == {"a": 2.5}


# ---- sampling ---------------------------------------------------------------


def _quotas(spark, quotas):
    return spark.createDataFrame(list(quotas.items()), "cls string, quota int")


def _draw(rows, quota):
    import hashlib

    return sorted(rows, key=lambda r: hashlib.md5(f"42:{r[1]}".encode()).hexdigest())[:quota]


def test_mark_first_matches_sorting_by_digest(spark):
    rows = [("a" if i % 3 else "b", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "cls string, id int").repartition(5)
    out = sampling.mark_first(df, "cls", ["id"], _quotas(spark, {"a": 700, "b": 10_000})).collect()
    got = {(r["cls"], r["id"]) for r in out if r["selected"]}
    a, b = [r for r in rows if r[0] == "a"], [r for r in rows if r[0] == "b"]
    assert got == set(_draw(a, 700)) | set(b) and len(out) == 3000


@pytest.mark.parametrize("quota", [0, 1, 5, 17, 399, 400, 450])
def test_mark_first_is_exact_with_shared_ids_and_copies(spark, quota):
    rows = [("a", 1, "same")] * 300 + [("a", 1, f"v{i % 20}") for i in range(60)] + [("a", i, "x") for i in range(2, 92)]
    df = spark.createDataFrame(rows, "cls string, id int, v string").repartition(3)
    out = sampling.mark_first(df, "cls", ["id"], _quotas(spark, {"a": quota})).collect()
    assert Counter((r["cls"], r["id"], r["v"]) for r in out) == Counter(rows)
    assert sum(r["selected"] for r in out) == min(quota, len(rows))


def test_classes_without_a_quota_are_not_selected(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "cls string, id int")
    out = sampling.mark_first(df, "cls", ["id"], _quotas(spark, {"a": 5})).collect()
    assert {r["id"] for r in out if r["selected"]} == {1} and len(out) == 3


def test_stratified_split_sizes(spark):
    rows = [("Normal" if i % 7 < 4 else "DoS" if i % 7 < 6 else "Worms", i) for i in range(1003)]
    df = spark.createDataFrame(rows, "cls string, id int")
    out = sampling.stratified_split(df, "cls", ["id"])
    again = sampling.stratified_split(df.repartition(9), "cls", ["id"])
    chosen = {r["id"] for r in out.filter("is_validation").collect()}
    assert len(chosen) == 201  # ceil(0.2 * 1003)
    assert chosen == {r["id"] for r in again.filter("is_validation").collect()}
    sizes = Counter(c for c, _ in rows)
    picked = Counter(c for c, i in rows if i in chosen)
    assert all(abs(picked[c] - 0.2 * sizes[c]) < 1 for c in sizes)


def test_published_split_size(spark):
    sizes = spark.createDataFrame([("0", 56000), ("1", 119341)], "cls string, n int")
    df = sizes.select("cls", F.explode(F.sequence(F.lit(1), "n")).alias("id"))
    assert sampling.validation_quotas(df, "cls").agg(F.sum("quota")).first()[0] == 35069


def test_scenarios_are_contained_repeatable_and_within_quota(spark):
    kinds = ["Normal", "Generic", "Exploits", "DoS", "Fuzzers", "Reconnaissance", "Analysis", "Backdoor", "Shellcode", "Worms"]
    df = spark.createDataFrame([(i, kinds[i % 10]) for i in range(2050)], "id int, attack_cat string")
    out = sampling.scenarios(df, "attack_cat", ["id"])
    counts = {(r["scenario"], r["attack_cat"]): r["n_rows"] for r in sampling.scenario_counts(out, "attack_cat").collect()}
    assert counts[("normal_demo", "Normal")] == 200 and counts[("mixed_demo", "Worms")] == 5
    assert sum(n for (s, _), n in counts.items() if s == "mixed_demo") == 255
    assert profiling.subset_check(out, df, ["id"]).first()["contained"]
    first = sorted(tuple(r) for r in out.collect())
    assert first == sorted(tuple(r) for r in sampling.scenarios(df.repartition(6), "attack_cat", ["id"]).collect())


def test_large_and_small_quota_paths_agree(spark, monkeypatch):
    df = spark.createDataFrame([("a" if i % 4 else "b", i) for i in range(4000)], "cls string, id int")
    quotas = {"a": 900, "b": 300}
    windowed = {tuple(r) for r in sampling.sample_by_class(df, "cls", ["id"], quotas).collect()}
    monkeypatch.setattr(sampling, "WINDOW_QUOTA", 10)
    assert windowed == {tuple(r) for r in sampling.sample_by_class(df, "cls", ["id"], quotas).collect()}


def test_tied_ids_are_drawn_alike_at_any_quota(spark, monkeypatch):
    """Rows that share ids at the cut are told apart by content, whatever other quotas are asked for."""
    df = spark.createDataFrame([("a", i // 7, float(i)) for i in range(600)] + [("b", i, 0.0) for i in range(50)], "cls string, id int, v double")
    alone = {tuple(r) for r in sampling.sample_by_class(df, "cls", ["id"], {"a": 150}).collect()}
    monkeypatch.setattr(sampling, "WINDOW_QUOTA", 10)
    both = {tuple(r) for r in sampling.sample_by_class(df, "cls", ["id"], {"a": 150, "b": 20}).collect() if r[0] == "a"}
    assert alone == both and len(alone) == 150


# ---- duplicates and overlap -------------------------------------------------


def test_duplicates_and_overlap_by_brute_force(spark):
    rng = random.Random(2)
    make = lambda n: [(i, rng.choice([1, 2, None]), rng.choice(["x", None])) for i in range(n)]
    train, test = make(200), make(100)
    a = spark.createDataFrame(train, "id int, p int, q string")
    b = spark.createDataFrame(test, "id int, p int, q string")
    patterns = lambda rows: {r[1:] for r in rows}
    assert profiling.duplicate_count(a, ["id"]).first()[0] == 200 - len(patterns(train))
    assert profiling.duplicate_count(a).first()[0] == 0
    assert profiling.split_overlap(a, b).first()["overlapping_patterns"] == len(patterns(train) & patterns(test))
    leaked = profiling.leaked_rows(a, b, ["p", "q"])
    assert leaked.count() == sum(r[1:] in patterns(train) for r in test)
