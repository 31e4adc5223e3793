"""Evaluation metrics over score sets.

Binary score sets carry a 0/1 label and the attack probability; multiclass ones
carry a class index and an array of class probabilities. A row counts as an
attack when its probability reaches the threshold (inclusive).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.functions.scale import stored
from flowsieve.functions.scalars import argmax, class_name, literal_array, ratio, round_share, round_to
from flowsieve.schemas import DEFAULT_THRESHOLD, OPERATIONAL_THRESHOLD, SEED, THRESHOLDS

_RANGES = 64  # of scores that are ordered apart; the last one also has the missing ones

RATE_NAMES = [
    "precision", "recall", "f1_score", "specificity", "false_positive_rate",
    "false_negative_rate", "balanced_accuracy", "accuracy",
]


def flagged(p: Column, threshold: float | Column) -> Column:
    """Attack decision; a missing or NaN score is never an attack."""
    return F.coalesce(~F.isnan(p) & (p >= threshold), F.lit(False))


# ---- binary -----------------------------------------------------------------


def binary_rates(digits: int = 4) -> dict[str, Column]:
    """Rounded rate columns over count columns tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    specificity = ratio(tn, tn + fp)
    raw = {
        "precision": precision,
        "recall": recall,
        "f1_score": ratio(2 * precision * recall, precision + recall),
        "specificity": specificity,
        "false_positive_rate": ratio(fp, fp + tn),
        "false_negative_rate": ratio(fn, fn + tp),
        "balanced_accuracy": (recall + specificity) / 2,
        "accuracy": ratio(tp + tn, tn + fp + fn + tp),
    }
    return {name: round_share(value, digits) for name, value in raw.items()}


def threshold_counts(
    scores: DataFrame, thresholds: Sequence[float], y: str = "y", p: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    """tn, fp, fn, tp for every threshold from one scan and one aggregate."""
    marks = sorted(float(t) for t in thresholds)
    attack = F.col(y) == 1
    tallies = []
    for i, mark in enumerate(marks):
        hit = flagged(F.col(p), mark)
        tallies += [F.count_if(hit & attack).alias(f"_tp{i}"), F.count_if(hit & ~attack).alias(f"_fp{i}")]
    wide = scores.groupBy(*by).agg(
        F.count_if(attack).alias("_p"), F.count_if(~attack).alias("_n"), *tallies
    )
    rows = F.array(*[
        F.struct(F.lit(mark).alias("threshold"), F.col(f"_tp{i}").alias("tp"), F.col(f"_fp{i}").alias("fp"))
        for i, mark in enumerate(marks)
    ])
    return wide.select(*by, "_p", "_n", F.inline(rows)).select(
        *by, "threshold", (F.col("_n") - F.col("fp")).alias("tn"), "fp",
        (F.col("_p") - F.col("tp")).alias("fn"), "tp",
    )


def confusion_binary(
    scores: DataFrame, threshold: float = DEFAULT_THRESHOLD, y: str = "y", p: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    return threshold_counts(scores, [threshold], y, p, by)


def binary_metrics(
    scores: DataFrame, threshold: float = DEFAULT_THRESHOLD, y: str = "y", p: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts and rates at one operating point."""
    counts = confusion_binary(scores, threshold, y, p, by)
    return counts.select(*counts.columns, *[c.alias(n) for n, c in binary_rates().items()])


def threshold_sweep(
    scores: DataFrame, thresholds: Sequence[float] = tuple(THRESHOLDS), y: str = "y", p: str = "p",
    by: Sequence[str] = (), default: float = DEFAULT_THRESHOLD, recommended: float = OPERATIONAL_THRESHOLD,
) -> DataFrame:
    """Every rate at every threshold, with the role of each operating point."""
    counts = threshold_counts(scores, thresholds, y, p, by)
    near = lambda value: F.abs(F.col("threshold") - F.lit(float(value))) < 1e-5
    return counts.select(
        *by,
        round_to("threshold", 2).alias("threshold"),
        *[c.alias(n) for n, c in binary_rates().items()],
        F.col("fp").alias("number_of_false_positives"),
        F.col("fn").alias("number_of_false_negatives"),
        F.col("tp").alias("true_positives"),
        F.col("tn").alias("true_negatives"),
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("total_samples"),
        near(default).alias("is_default"),
        near(recommended).alias("is_recommended"),
        F.when(near(default), "academic_default").when(near(recommended), "recommended_operational")
        .otherwise("alternative").alias("role"),
    )


def threshold_impact(
    sweep: DataFrame, chosen: float = OPERATIONAL_THRESHOLD, default: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """What moving from the default to the chosen threshold changes."""
    def at(mark: float, name: str) -> Column:
        return F.max(F.when(F.abs(F.col("threshold") - F.lit(float(mark))) < 1e-5, F.col(name)))

    def gain(name: str) -> Column:
        return round_to(at(chosen, name) - at(default, name), 4)

    fp = "number_of_false_positives"
    saved = at(default, fp) - at(chosen, fp)
    return sweep.agg(
        saved.alias("false_positive_reduction_count"),
        round_to(ratio(saved, at(default, fp)) * 100, 2).alias("false_positive_reduction_percent"),
        round_to(at(default, "false_positive_rate") - at(chosen, "false_positive_rate"), 4).alias("fpr_reduction"),
        gain("recall").alias("recall_delta"),
        gain("precision").alias("precision_gain"),
        gain("f1_score").alias("f1_gain"),
        gain("balanced_accuracy").alias("balanced_accuracy_gain"),
    )


# ---- ranking curves ---------------------------------------------------------


def score_cuts(scores: DataFrame, p: str = "p", share: float = 0.02) -> list[float]:
    """Scores that divide the rows into even ranges, from a sketch over a sample. They only balance the work."""
    marks = [i / _RANGES for i in range(1, _RANGES)]
    found = scores.sample(share, SEED).agg(F.percentile_approx(_known(p), marks, 1000)).first()[0]
    return sorted(set(found or []))


def _known(p: str) -> Column:
    return F.nanvl(F.col(p).cast("double"), F.lit(None).cast("double"))


def ranked_scores(
    scores: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), cuts: Sequence[float] | None = None,
) -> DataFrame:
    """One row per distinct score with running positive and negative counts.

    Counting per distinct score first makes ties exact and shrinks the data
    before anything is ordered. A NaN score is never an attack, so it ranks
    below all others, as a missing one does. ``cuts`` divide the scores into
    ranges (see :func:`score_cuts`): running sums are made inside a range and
    raised by the totals of the ranges above it, which read the same stored counts.
    """
    cuts = score_cuts(scores, p) if cuts is None else cuts
    above = sum(((F.col("score") < c).cast("int") for c in cuts), F.lit(0))
    base = scores.select(*by, _known(p).alias("score"), (F.col(y) == 1).alias("hit")).withColumn(
        "_range", F.coalesce(above, F.lit(len(cuts))))
    # Stored: the running sums and the totals each read it, and would each make the scores anew.
    per_score = stored(base.groupBy(*by, "_range", "score").agg(
        F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg")), "ranked")
    inside = Window.partitionBy(*by, "_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    higher = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = per_score.groupBy(*by, "_range").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))  # a row a range
    raised = totals.select(
        *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.col("_range").alias("_of"),
        *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"{c}_above") for c in ("_p", "_n")])
    summed = per_score.withColumns({"cum_pos": F.sum("pos").over(inside), "cum_neg": F.sum("neg").over(inside)})
    same = F.col("_range") == F.col("_of")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_by{i}"))
    return summed.join(raised, same).select(
        *by, "score", "pos", "neg", (F.col("cum_pos") + F.col("_p_above")).alias("cum_pos"), (F.col("cum_neg") + F.col("_n_above")).alias("cum_neg"))


def ranking_areas(
    scores: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Tie-correct ROC-AUC and step-sum average precision; null when undefined."""
    ranked = ranked_scores(scores, y, p, by, cuts)
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "cum_pos", "cum_neg"))
    sums = ranked.groupBy(*by).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.sum(neg * (tp - pos / 2)).alias("_area"),
        F.sum(pos * tp / (tp + fp)).alias("_precision"),
    )
    return sums.select(
        *by, "positives", "negatives",
        F.try_divide(F.col("_area"), F.col("positives").cast("double") * F.col("negatives")).alias("roc_auc"),
        F.try_divide(F.col("_precision"), F.col("positives").cast("double")).alias("average_precision"),
    )


def roc_curve(scores: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(fpr, tpr) at every distinct score plus the origin, at threshold infinity."""
    ranked = ranked_scores(scores, y, p)
    totals = ranked.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    points = ranked.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), totals.select("n").scalar().cast("double")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), totals.select("p").scalar().cast("double")).alias("tpr"),
    )
    origin = points.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(origin)


def pr_curve(scores: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(precision, recall) at every distinct score, the end anchor, and the prevalence baseline."""
    ranked = ranked_scores(scores, y, p)
    positives = ranked.agg(F.sum("pos").cast("double")).scalar()
    rows = ranked.agg(F.sum(F.col("pos") + F.col("neg")).cast("double")).scalar()
    points = ranked.select(
        F.col("score").alias("threshold"),
        ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.try_divide(F.col("cum_pos").cast("double"), positives).alias("recall"),
    )
    anchor = points.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(anchor).withColumn("baseline", F.try_divide(positives, rows))


# ---- multiclass -------------------------------------------------------------


def with_prediction(scores: DataFrame, probs: str = "probs", name: str = "yhat") -> DataFrame:
    return scores.withColumn(name, argmax(F.col(probs)))


def _class_grid(base: DataFrame, classes: Sequence[str], *names: str) -> DataFrame:
    """Every combination of class indexes under each row of a small base frame."""
    for name in names:
        base = base.select("*", F.explode(literal_array(range(len(classes)))).alias(name))
    return base


def confusion_multi(
    scores: DataFrame, classes: Sequence[str], y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()
) -> DataFrame:
    """Long k x k confusion matrix, zero cells included."""
    counts = scores.groupBy(*by, F.col(y).cast("int").alias("y"), F.col(yhat).cast("int").alias("yhat")).agg(
        F.count("*").alias("n_rows")
    )
    base = counts.select(*by).distinct() if by else scores.sparkSession.range(1).drop("id")
    cells = _class_grid(base, classes, "y", "yhat").select(
        *by, "y", "yhat", F.lit(0).cast("long").alias("n_rows"), F.lit(True).alias("_listed"))
    # Zero cells join by aggregation: a join would push null checks on y and yhat
    # down into the scoring expressions and evaluate them twice per row.
    both = counts.withColumn("_listed", F.lit(False)).unionByName(cells)
    summed = both.groupBy(*by, "y", "yhat").agg(F.sum("n_rows").alias("n_rows"), F.bool_or("_listed").alias("_listed"))
    return summed.filter("_listed").drop("_listed")


def per_class_metrics(
    scores: DataFrame, classes: Sequence[str], y: str = "y", yhat: str = "yhat", by: Sequence[str] = (),
    digits: int | None = 4,
) -> DataFrame:
    """Precision, recall, F1 and support of every class, seen or not."""
    cells = confusion_multi(scores, classes, y, yhat, by)
    sides = cells.select(*by, F.inline(F.array(
        F.struct(F.col("y").alias("cls"), F.col("n_rows").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("y") == F.col("yhat"), F.col("n_rows")).otherwise(0).alias("tp")),
        F.struct(F.col("yhat").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.col("n_rows").alias("predicted"), F.lit(0).cast("long").alias("tp")),
    )))
    sums = sides.groupBy(*by, "cls").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    precision = ratio(F.col("tp"), F.col("predicted"))
    recall = ratio(F.col("tp"), F.col("support"))
    f1 = ratio(2 * F.col("tp"), F.col("support") + F.col("predicted"))
    shown = (lambda c: round_share(c, digits)) if digits is not None else (lambda c: c)
    return sums.select(
        *by, "cls", class_name(F.col("cls"), classes).alias("class_name"),
        shown(precision).alias("precision"), shown(recall).alias("recall"), shown(f1).alias("f1"),
        "support", "predicted", "tp",
    )


def multi_metrics(
    scores: DataFrame, classes: Sequence[str], y: str = "y", yhat: str = "yhat", by: Sequence[str] = (),
    class_universe: str = "seen", digits: int = 4,
) -> DataFrame:
    """Accuracy, balanced accuracy, macro and weighted precision/recall/F1.

    ``class_universe="seen"`` averages classes found in labels or predictions,
    ``"all"`` averages every listed class.
    """
    if class_universe not in ("seen", "all"):
        raise ValueError(f"class_universe must be 'seen' or 'all', got {class_universe!r}")
    rows = per_class_metrics(scores, classes, y, yhat, by, digits=None)
    counted = F.lit(True) if class_universe == "all" else (F.col("support") + F.col("predicted")) > 0
    support = F.sum("support").cast("double")
    out = [
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.coalesce(F.avg(F.when(F.col("support") > 0, F.col("recall"))), F.lit(0.0)).alias("balanced_accuracy"),
    ]
    for name in ("precision", "recall", "f1"):
        out.append(F.coalesce(F.avg(F.when(counted, F.col(name))), F.lit(0.0)).alias(f"macro_{name}"))
        out.append(ratio(F.sum(F.col("support") * F.col(name)), support).alias(f"weighted_{name}"))
    summed = rows.groupBy(*by).agg(*out)
    return summed.select(*by, *[round_to(c, digits).alias(c) for c in summed.columns if c not in by])


def accuracy(scores: DataFrame, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """Share of equal label and prediction."""
    return scores.groupBy(*by).agg(F.avg((F.col(y) == F.col(yhat)).cast("int")).alias("accuracy"))


def ovr_auc(
    scores: DataFrame, classes: Sequence[str], y: str = "y", probs: str = "probs", by: Sequence[str] = ()
) -> DataFrame:
    """Macro one-vs-rest ROC-AUC; null unless every class has both outcomes."""
    def exploded(rows: DataFrame) -> DataFrame:
        # A plain posexplode would test the array in a filter first, which computes the scores of a row three times.
        pairs = rows.select(*by, F.col(y).alias("_y"), F.posexplode_outer(probs).alias("cls", "score")).filter("cls IS NOT NULL")
        return pairs.select(*by, "cls", "score", (F.col("_y") == F.col("cls")).cast("int").alias("hit"))

    cuts = score_cuts(exploded(scores.sample(0.02, SEED)), "score", 1.0)  # the sample comes before the k rows a row
    areas = ranking_areas(exploded(scores), "hit", "score", [*by, "cls"], cuts)
    return areas.groupBy(*by).agg(
        F.when(F.count("roc_auc") == len(classes), F.avg("roc_auc")).alias("roc_auc_ovr_macro")
    )


def log_loss(
    scores: DataFrame, y: str = "y", probs: str = "probs", by: Sequence[str] = (), eps: float = 2.220446049250313e-16
) -> DataFrame:
    """Mean negative log probability of the true class, rows normalised and clipped."""
    total = F.aggregate(probs, F.lit(0.0), lambda a, v: a + v)
    true = F.try_divide(F.try_element_at(F.col(probs), F.col(y).cast("int") + 1), total)
    clipped = F.greatest(F.least(true, F.lit(1.0 - eps)), F.lit(eps))
    return scores.groupBy(*by).agg(F.avg(-F.log(clipped)).alias("log_loss"))


def classification_report(
    scores: DataFrame, classes: Sequence[str], y: str = "y", yhat: str = "yhat", digits: int = 4
) -> DataFrame:
    """Per-class rows plus accuracy, macro-average and weighted-average rows."""
    rows = per_class_metrics(scores, classes, y, yhat, digits=None)
    support = F.sum("support")
    summary = rows.agg(
        ratio(F.sum("tp"), support).alias("acc"), support.alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[ratio(F.sum(F.col("support") * F.col(c)), support).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
    )

    def row(label: str, kind: str):
        value = (lambda c: F.col("acc")) if kind == "acc" else (lambda c: F.col(f"{kind}_{c}"))
        return F.struct(F.lit(label).alias("row"), *[value(c).alias(c) for c in ("precision", "recall", "f1")],
                        F.col("n").alias("support"))

    averages = summary.select(F.inline(F.array(
        row("accuracy", "acc"), row("macro avg", "m"), row("weighted avg", "w"))))
    report = rows.select(F.col("class_name").alias("row"), "precision", "recall", "f1", "support").unionByName(averages)
    return report.select("row", *[round_to(c, digits).alias(c) for c in ("precision", "recall", "f1")], "support")


def binary_report(scores: DataFrame, threshold: float = DEFAULT_THRESHOLD, y: str = "y", p: str = "p") -> DataFrame:
    """Classification report of a binary score set, both classes listed."""
    decided = scores.select(F.col(y).alias("y"), flagged(F.col(p), threshold).cast("int").alias("yhat"))
    return classification_report(decided, ["Normal", "Attack"])


def compare_binary(
    scores: DataFrame, by: Sequence[str], threshold: float = DEFAULT_THRESHOLD, y: str = "y", p: str = "p"
) -> DataFrame:
    """One comparison row per model (and split): counts, rates and ranking areas."""
    points = binary_metrics(scores, threshold, y, p, by)
    areas = ranking_areas(scores, y, p, by).select(
        *by, round_to("roc_auc", 4).alias("roc_auc"), round_to("average_precision", 4).alias("pr_auc")
    )
    return points.drop("threshold").join(areas, list(by))


def compare_multi(
    scores: DataFrame, classes: Sequence[str], by: Sequence[str], y: str = "y", probs: str = "probs",
    class_universe: str = "seen",
) -> DataFrame:
    """One comparison row per multiclass model (and split)."""
    predicted = with_prediction(scores, probs)
    rates = multi_metrics(predicted, classes, y, "yhat", by, class_universe)
    areas = ovr_auc(scores, classes, y, probs, by)
    losses = log_loss(scores, y, probs, by)
    return rates.join(areas, list(by)).join(losses, list(by)).select(
        *rates.columns, round_to("roc_auc_ovr_macro", 4).alias("roc_auc_ovr_macro"),
        round_to("log_loss", 4).alias("log_loss"),
    )
