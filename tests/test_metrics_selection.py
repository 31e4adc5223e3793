from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsieve.operators import metrics as me, thresholds as th
from flowsieve.schemas import THRESHOLDS


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        y = int(rng.random() < 0.6)
        rows.append((i, y, round(min(1.0, max(0.0, rng.gauss(0.4 + 0.3 * y, 0.2))), 2)))
    return rows, spark.createDataFrame(rows, "id int, y int, p double").repartition(5)


@pytest.mark.parametrize("mark", THRESHOLDS)
def test_sweep_identities_and_counts(scores, mark):
    rows, df = scores
    r = me.threshold_sweep(df, [mark]).first()
    tp = sum(y == 1 and p >= mark for _, y, p in rows)
    fp = sum(y == 0 and p >= mark for _, y, p in rows)
    pos = sum(y for _, y, _ in rows)
    assert (r["true_positives"], r["number_of_false_positives"]) == (tp, fp)
    assert r["number_of_false_negatives"] == pos - tp and r["total_samples"] == len(rows)
    assert r["false_positive_rate"] + r["specificity"] == pytest.approx(1, abs=2e-4)
    assert r["recall"] + r["false_negative_rate"] == pytest.approx(1, abs=2e-4)
    assert r["balanced_accuracy"] == pytest.approx((r["recall"] + r["specificity"]) / 2, abs=2e-4)
    if r["precision"] + r["recall"]:
        assert r["f1_score"] == pytest.approx(2 * r["precision"] * r["recall"] / (r["precision"] + r["recall"]), abs=5e-4)


def test_threshold_is_inclusive_and_nan_is_never_an_attack(spark):
    df = spark.createDataFrame([(1, 0.5), (1, float("nan")), (1, None), (0, 0.4999)], "y int, p double")
    r = me.confusion_binary(df).first()
    assert (r["tp"], r["fn"], r["fp"], r["tn"]) == (1, 2, 0, 1)


def test_zero_denominators_give_zero(spark):
    r = me.binary_metrics(spark.createDataFrame([(0, 0.1)], "y int, p double")).first()
    assert (r["precision"], r["recall"], r["f1_score"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def _auc(rows):
    pos = [p for _, y, p in rows if y]
    neg = [p for _, y, p in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def _average_precision(rows):
    pos, total = sum(y for _, y, _ in rows), 0.0
    for s in sorted({p for *_, p in rows}, reverse=True):
        at = [y for _, y, p in rows if p == s]
        above = [y for _, y, p in rows if p >= s]
        total += sum(at) / pos * sum(above) / len(above)
    return total


def test_ranking_areas_by_brute_force(scores):
    rows, df = scores
    r = me.ranking_areas(df).first()
    assert r["roc_auc"] == pytest.approx(_auc(rows), abs=1e-12)
    assert r["average_precision"] == pytest.approx(_average_precision(rows), abs=1e-12)


def test_areas_are_null_when_one_class_is_absent(spark):
    r = me.ranking_areas(spark.createDataFrame([(0, 0.3), (0, 0.4)], "y int, p double")).first()
    assert r["roc_auc"] is None and r["average_precision"] is None


def test_curves_have_anchors_and_the_same_area(scores):
    rows, df = scores
    points = sorted((r["fpr"], r["tpr"]) for r in me.roc_curve(df).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(_auc(rows), abs=1e-9)
    pr = me.pr_curve(df).collect()
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0 for r in pr)


# ---- multiclass -------------------------------------------------------------


@pytest.fixture(scope="module")
def multi(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 3, 400)
    probs = rng.random((400, 4)) + np.eye(4)[y] * 0.5
    rows = [(int(a), [float(v) for v in p]) for a, p in zip(y, probs, strict=True)]
    return y, probs, spark.createDataFrame(rows, "y int, probs array<double>")


CLASSES = ["a", "b", "c", "d"]


def test_multi_metrics_by_brute_force(multi):
    y, probs, df = multi
    yhat = probs.argmax(1)
    rec = {c: np.mean(yhat[y == c] == c) if (y == c).any() else 0.0 for c in range(4)}
    prec = {c: np.mean(y[yhat == c] == c) if (yhat == c).any() else 0.0 for c in range(4)}
    scored = me.with_prediction(df)
    seen = me.multi_metrics(scored, CLASSES).first()
    every = me.multi_metrics(scored, CLASSES, class_universe="all").first()
    universe = set(y) | set(yhat)
    assert seen["accuracy"] == pytest.approx(np.mean(y == yhat), abs=1e-4)
    assert seen["balanced_accuracy"] == pytest.approx(np.mean([rec[c] for c in set(y)]), abs=1e-4)
    assert seen["macro_precision"] == pytest.approx(np.mean([prec[c] for c in universe]), abs=1e-4)
    assert every["macro_recall"] == pytest.approx(np.mean(list(rec.values())), abs=1e-4)
    with pytest.raises(ValueError):
        me.multi_metrics(scored, CLASSES, class_universe="some")


def test_confusion_lists_unseen_classes(multi):
    y, probs, df = multi
    cells = {(r["y"], r["yhat"]): r["n_rows"] for r in me.confusion_multi(me.with_prediction(df), CLASSES).collect()}
    assert len(cells) == 16 and sum(cells.values()) == 400 and cells[(3, 0)] == 0


def test_log_loss_normalises_rows(multi):
    y, probs, df = multi
    share = probs / probs.sum(1, keepdims=True)
    expected = -np.mean(np.log(share[np.arange(len(y)), y]))
    assert me.log_loss(df).first()[0] == pytest.approx(expected, abs=1e-9)


def test_log_loss_of_a_certain_mistake_is_finite(spark):
    df = spark.createDataFrame([(0, [0.0, 1.0])], "y int, probs array<double>")
    assert me.log_loss(df).first()[0] == pytest.approx(-math.log(2.220446049250313e-16))


def test_ovr_auc_needs_every_class(multi, spark):
    y, probs, df = multi
    assert me.ovr_auc(df, CLASSES).first()[0] is None
    three = spark.createDataFrame([(int(a), [float(v) for v in p[:3]]) for a, p in zip(y, probs, strict=True)], df.schema)
    aucs = [_auc([(0, int(a == c), p[c]) for a, p in zip(y, probs, strict=True)]) for c in range(3)]
    assert me.ovr_auc(three, CLASSES[:3]).first()[0] == pytest.approx(np.mean(aucs), abs=1e-12)


def test_first_maximum_wins_ties(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],)], "probs array<double>")
    assert me.with_prediction(df).first()["yhat"] == 0


# ---- threshold and model choice --------------------------------------------


def _sweep(spark, rows):
    return spark.createDataFrame(rows, "threshold double, recall double, false_positive_rate double, f1_score double")


def test_selection_rule_follows_the_metrics(spark):
    rows = [(0.5, 0.98, 0.08, 0.96), (0.6, 0.95, 0.05, 0.96), (0.7, 0.92, 0.03, 0.96), (0.8, 0.88, 0.01, 0.94)]
    assert th.selected_value(_sweep(spark, rows)) == 0.7
    assert th.selected_value(_sweep(spark, [r for r in rows if r[0] < 0.7])) == 0.6


def test_selection_ties_and_fallback(spark):
    assert th.selected_value(_sweep(spark, [(0.5, 0.95, 0.03, 0.90), (0.6, 0.95, 0.03, 0.92)])) == 0.6
    assert th.selected_value(_sweep(spark, [(0.7, 0.8, 0.01, 0.9), (0.8, 0.6, 0.0, 0.7)])) == 0.7
    with pytest.raises(ValueError):
        th.selected_value(_sweep(spark, []))


def test_impact_without_false_positives_is_zero(spark):
    sweep = me.threshold_sweep(spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, p double"))
    assert me.threshold_impact(sweep).first()["false_positive_reduction_percent"] == 0.0


def test_best_binary_model(spark):
    df = spark.createDataFrame([("a", 0.9, 0.9, 0.9, 0.1), ("b", 0.9, 0.9, 0.9, 0.3)],
                               "model string, pr_auc double, recall double, f1_score double, false_positive_rate double")
    rows = {r["model"]: r for r in th.select_binary_model(df).collect()}
    assert rows["a"]["selected"] and not rows["b"]["selected"]
    assert rows["a"]["composite_score"] == pytest.approx(0.9 * 0.9 - 0.01)


def test_ovr_auc_computes_the_scores_of_a_row_once(spark, monkeypatch):
    """No filter ahead of the expansion repeats what makes the scores; rows without scores take no part."""
    plans = []
    plain = me.ranking_areas
    monkeypatch.setattr(me, "ranking_areas", lambda s, *a: plans.append(s._jdf.queryExecution().optimizedPlan().toString()) or plain(s, *a))
    rows = [(0, 0.9), (0, 0.4), (1, 0.3), (1, 0.6), (1, 0.1), (0, None)]
    df = spark.createDataFrame(rows, "y int, p double").withColumn(
        "probs", F.when(F.col("p").isNotNull(), F.transform(F.array("p", 1 - F.col("p")), lambda v: v * 1.0)))
    got = me.ovr_auc(df, ["a", "b"]).first().roc_auc_ovr_macro
    assert got == pytest.approx(5 / 6)
    assert plans[0].count("lambdafunction") == 1


def test_running_counts_compute_the_scores_once(spark):
    """Running sums and totals of ranges read the same counts; given cuts, a row is scored once."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        made.add(1)
        return i % 100 / 100

    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("y"), score("id").alias("p"))
    assert me.ranking_areas(df, cuts=[0.25, 0.5]).first().positives == 500
    assert made.value == 1000
