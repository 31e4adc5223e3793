"""Registered queries: metrics, threshold and model selection, triage, feature transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowsieve.functions.scalars import round_to
from flowsieve.functions.scale import materialize, stored
from flowsieve.operators import cleaning, features as fe, feature_selection as fs, metrics as me, thresholds as th, triage as tr
from flowsieve.operators.explain import linear_contributions, mean_abs_attribution
from flowsieve.operators.neighbours import neighbour_information
from flowsieve.plans.catalog import query
from flowsieve.plans.views import CATEGORICAL, CLASS_LIST_SQL, CLASSES, NUMERIC, alerts, flows, flows_dirty, probs, splits, sql
from flowsieve.schemas import ACTIONS, SEVERITY, THRESHOLDS

# ---- binary metrics ---------------------------------------------------------


def _safe(top: str, bottom: str) -> str:
    return f"coalesce(({top})::DOUBLE / nullif(({bottom})::DOUBLE, 0), 0)"


_P, _R, _S = _safe("tp", "tp + fp"), _safe("tp", "tp + fn"), _safe("tn", "tn + fp")
_RATES = {
    "precision": _P, "recall": _R, "f1_score": _safe(f"2 * {_P} * {_R}", f"{_P} + {_R}"), "specificity": _S,
    "false_positive_rate": _safe("fp", "fp + tn"), "false_negative_rate": _safe("fn", "fn + tp"),
    "balanced_accuracy": f"(({_R}) + ({_S})) / 2", "accuracy": _safe("tp + tn", "tn + fp + fn + tp"),
}
_RATE_SQL = ", ".join(f"round({e}, 4) AS {n}" for n, e in _RATES.items())


def _counts(source: str, marks: list[float], by: str = "", p: str = "p") -> str:
    group = f"{by}, " if by else ""
    return f"""SELECT {group}threshold, count(*) FILTER (label = 0 AND {p} < threshold) AS tn,
    count(*) FILTER (label = 0 AND {p} >= threshold) AS fp, count(*) FILTER (label = 1 AND {p} < threshold) AS fn,
    count(*) FILTER (label = 1 AND {p} >= threshold) AS tp
    FROM {source}, (SELECT unnest({marks}::DOUBLE[]) AS threshold) GROUP BY {group}threshold"""


def _sweep(counts: str, by: str = "") -> str:
    group = f"{by}, " if by else ""
    return f"""SELECT {group}threshold, {_RATE_SQL}, fp AS number_of_false_positives, fn AS number_of_false_negatives,
    tp AS true_positives, tn AS true_negatives, tn + fp + fn + tp AS total_samples, threshold = 0.5 AS is_default,
    threshold = 0.8 AS is_recommended, CASE WHEN threshold = 0.5 THEN 'academic_default'
    WHEN threshold = 0.8 THEN 'recommended_operational' ELSE 'alternative' END AS role FROM ({counts})"""


_ALL_SWEEP = _sweep(_counts("flows", THRESHOLDS))


@query("confusion_binary", sql(f"SELECT * FROM ({_counts('flows', [0.5])})", "flows"))
def _confusion_binary(spark, sf):
    return me.confusion_binary(flows(spark, sf), y="label")


@query("binary_metrics", sql(f"SELECT *, {_RATE_SQL} FROM ({_counts('flows', [0.5], 'split')})", "flows"))
def _binary_metrics(spark, sf):
    return me.binary_metrics(flows(spark, sf), y="label", by=["split"])


@query("threshold_sweep", sql(_ALL_SWEEP, "flows"))
def _threshold_sweep(spark, sf):
    return me.threshold_sweep(flows(spark, sf), y="label")


_IMPACT = """
SELECT d.fp0 - c.fp0 AS false_positive_reduction_count,
       round(coalesce((d.fp0 - c.fp0)::DOUBLE / nullif(d.fp0, 0), 0) * 100, 2) AS false_positive_reduction_percent,
       round(d.fpr - c.fpr, 4) AS fpr_reduction, round(c.recall - d.recall, 4) AS recall_delta,
       round(c.precision - d.precision, 4) AS precision_gain, round(c.f1 - d.f1, 4) AS f1_gain,
       round(c.bal - d.bal, 4) AS balanced_accuracy_gain
FROM m d, m c WHERE d.threshold = 0.5 AND c.threshold = 0.8"""


@query("threshold_impact", sql(_IMPACT, "flows", m=f"""SELECT threshold, number_of_false_positives AS fp0,
    false_positive_rate AS fpr, recall, precision, f1_score AS f1, balanced_accuracy AS bal FROM ({_ALL_SWEEP})"""))
def _threshold_impact(spark, sf):
    return me.threshold_impact(me.threshold_sweep(flows(spark, sf), y="label"))


_PICK = """ORDER BY recall < 0.9, CASE WHEN recall >= 0.9 THEN false_positive_rate ELSE -recall END,
CASE WHEN recall >= 0.9 THEN -f1_score ELSE 0 END, threshold LIMIT 1"""


@query("threshold_select", sql(f"SELECT *, recall >= 0.9 AS meets_floor FROM m {_PICK}", "train", m=_sweep(_counts("train", THRESHOLDS))))
def _threshold_select(spark, sf):
    return th.select_threshold(me.threshold_sweep(splits(spark, sf)[0], y="label"))


@query("threshold_select_fallback", sql(f"SELECT *, recall >= 0.9 AS meets_floor FROM m {_PICK}", "train", m=_sweep(_counts("train", [0.7, 0.8, 0.9]))))
def _threshold_select_fallback(spark, sf):
    return th.select_threshold(me.threshold_sweep(splits(spark, sf)[0], [0.7, 0.8, 0.9], y="label"))


@query("threshold_report", sql(f"""
SELECT m.* EXCLUDE (is_recommended, role), m.threshold = s.threshold AS is_selected,
       CASE WHEN is_default THEN 'academic_default' WHEN m.threshold = s.threshold THEN 'selected_operational' ELSE 'alternative' END AS role
FROM (SELECT * EXCLUDE (split), CASE split WHEN 'train' THEN 'validation' ELSE 'test' END AS split FROM m) m, s""", "flows",
    m=_sweep(_counts("flows", THRESHOLDS, "split"), "split"), s=f"SELECT threshold FROM m WHERE split = 'train' {_PICK}"))
def _threshold_report(spark, sf):
    train, test = splits(spark, sf)
    return th.threshold_report(me.threshold_sweep(train, y="label"), me.threshold_sweep(test, y="label"))


# ---- ranking ----------------------------------------------------------------


def _ranked(source: str, y: str, p: str, by: str = "") -> str:
    group, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    over = f"OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"
    return f"""SELECT {group}score, pos, neg, sum(pos) {over} AS ctp, sum(neg) {over} AS cfp FROM (
    SELECT {group}{p} AS score, count(*) FILTER ({y}) AS pos, count(*) FILTER (NOT {y}) AS neg FROM {source} GROUP BY {group}{p})"""


_AUC = "sum(neg * (ctp - pos / 2::DOUBLE)) / nullif(sum(pos)::DOUBLE * sum(neg)::DOUBLE, 0)"
_AP = "sum(pos * ctp::DOUBLE / (ctp + cfp)) / nullif(sum(pos)::DOUBLE, 0)"


@query("roc_auc", sql(f"SELECT round({_AUC}, 6) AS roc_auc FROM r", "flows", r=_ranked("flows", "label = 1", "p")))
def _roc_auc(spark, sf):
    return me.ranking_areas(flows(spark, sf), "label", "p").select(round_to("roc_auc", 6).alias("roc_auc"))


@query("average_precision", sql(f"SELECT split, round({_AP}, 6) AS average_precision FROM r GROUP BY split", "flows", r=_ranked("flows", "label = 1", "p", "split")))
def _average_precision(spark, sf):
    return me.ranking_areas(flows(spark, sf), "label", "p", ["split"]).select("split", round_to("average_precision", 6).alias("average_precision"))


@query("roc_curve", sql("""
SELECT score AS threshold, round(cfp / (SELECT sum(neg) FROM r)::DOUBLE, 6) AS fpr, round(ctp / (SELECT sum(pos) FROM r)::DOUBLE, 6) AS tpr FROM r
UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0""", "flows", r=_ranked("flows", "label = 1", "p")))
def _roc_curve(spark, sf):
    return me.roc_curve(flows(spark, sf), "label").select("threshold", round_to("fpr", 6).alias("fpr"), round_to("tpr", 6).alias("tpr"))


@query("pr_curve", sql("""
SELECT score AS threshold, round(ctp / (ctp + cfp)::DOUBLE, 6) AS precision, round(ctp / b.p::DOUBLE, 6) AS recall, round(b.p / b.n::DOUBLE, 6) AS baseline FROM r, b
UNION ALL SELECT NULL, 1, 0, round(b.p / b.n::DOUBLE, 6) FROM b""", "flows", r=_ranked("flows", "label = 1", "p"),
    b="SELECT sum(pos) AS p, sum(pos) + sum(neg) AS n FROM r"))
def _pr_curve(spark, sf):
    return me.pr_curve(flows(spark, sf), "label").select("threshold", *[round_to(c, 6).alias(c) for c in ("precision", "recall", "baseline")])


# ---- multiclass -------------------------------------------------------------

_K = len(CLASSES)
_PRED = {
    "pred": "SELECT id, split, CAST(y AS INTEGER) AS y, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS yhat, probs FROM probs",
    "cls": f"SELECT CAST(unnest(range({_K})) AS INTEGER) AS cls",
    "pc": """SELECT cls, support, predicted, tp, coalesce(tp::DOUBLE / nullif(predicted, 0), 0) AS pr, coalesce(tp::DOUBLE / nullif(support, 0), 0) AS re,
       coalesce(2 * tp::DOUBLE / nullif(support + predicted, 0), 0) AS f1 FROM (
       SELECT cls, (SELECT count(*) FROM pred WHERE y = cls) AS support, (SELECT count(*) FROM pred WHERE yhat = cls) AS predicted,
              (SELECT count(*) FROM pred WHERE y = cls AND yhat = cls) AS tp FROM cls)""",
}
_MULTI = """SELECT round(sum(tp)::DOUBLE / sum(support), 4) AS accuracy, round(avg(re) FILTER (support > 0), 4) AS balanced_accuracy,
round(avg(pr) FILTER (support + predicted > 0), 4) AS macro_precision, round(sum(support * pr) / sum(support), 4) AS weighted_precision,
round(avg(re) FILTER (support + predicted > 0), 4) AS macro_recall, round(sum(support * re) / sum(support), 4) AS weighted_recall,
round(avg(f1) FILTER (support + predicted > 0), 4) AS macro_f1, round(sum(support * f1) / sum(support), 4) AS weighted_f1 FROM pc"""


@query("confusion_multi", sql("""
SELECT a.cls AS y, b.cls AS yhat, count(p.id) AS n_rows FROM cls a CROSS JOIN cls b
LEFT JOIN pred p ON p.y = a.cls AND p.yhat = b.cls GROUP BY a.cls, b.cls""", "probs", **_PRED))
def _confusion_multi(spark, sf):
    return me.confusion_multi(me.with_prediction(probs(spark, sf)), CLASSES)


@query("per_class_metrics", sql(f"""
SELECT cls, {CLASS_LIST_SQL}[cls + 1] AS class_name, round(pr, 4) AS precision, round(re, 4) AS recall, round(f1, 4) AS f1,
       support, predicted, tp FROM pc""", "probs", **_PRED))
def _per_class(spark, sf):
    return me.per_class_metrics(me.with_prediction(probs(spark, sf)), CLASSES)


@query("multi_metrics", sql(_MULTI, "probs", **_PRED))
def _multi_metrics(spark, sf):
    return me.multi_metrics(me.with_prediction(probs(spark, sf)), CLASSES)


@query("multi_accuracy", sql("SELECT split, round(avg(CASE WHEN y = yhat THEN 1 ELSE 0 END), 6) AS accuracy FROM pred GROUP BY split", "probs", **_PRED))
def _multi_accuracy(spark, sf):
    return me.accuracy(me.with_prediction(probs(spark, sf)), by=["split"]).withColumn("accuracy", round_to("accuracy", 6))


_OVR = f"SELECT CAST(unnest(range({_K})) AS INTEGER) AS cls, y, unnest(probs) AS v FROM pred"


@query("ovr_auc", sql("SELECT round(CASE WHEN count(a) = 10 THEN avg(a) END, 6) AS roc_auc_ovr_macro FROM (SELECT cls, " + _AUC + " AS a FROM r GROUP BY cls)",
                      "probs", **_PRED, e=_OVR, r=_ranked("e", "y = cls", "v", "cls")))
def _ovr_auc(spark, sf):
    return me.ovr_auc(probs(spark, sf), CLASSES).select(round_to("roc_auc_ovr_macro", 6).alias("roc_auc_ovr_macro"))


@query("log_loss", sql("SELECT round(avg(-ln(greatest(least(probs[y + 1] / list_sum(probs), 1 - 2.220446049250313e-16), 2.220446049250313e-16))), 6) AS log_loss FROM pred", "probs", **_PRED))
def _log_loss(spark, sf):
    return me.log_loss(probs(spark, sf)).select(round_to("log_loss", 6).alias("log_loss"))


@query("classification_report", sql("""
SELECT CASE cls WHEN 0 THEN 'Normal' ELSE 'Attack' END AS row, round(pr, 4) AS precision, round(re, 4) AS recall, round(f1, 4) AS f1, s AS support FROM m
UNION ALL SELECT 'accuracy', round(sum(t)::DOUBLE / sum(s), 4), round(sum(t)::DOUBLE / sum(s), 4), round(sum(t)::DOUBLE / sum(s), 4), CAST(sum(s) AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round(avg(pr), 4), round(avg(re), 4), round(avg(f1), 4), CAST(sum(s) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round(sum(s * pr) / sum(s), 4), round(sum(s * re) / sum(s), 4), round(sum(s * f1) / sum(s), 4), CAST(sum(s) AS BIGINT) FROM m
""", "flows", c="SELECT unnest([0, 1]) AS cls", d="SELECT label AS y, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS yhat FROM flows",
    q="""SELECT cls, (SELECT count(*) FROM d WHERE y = cls) AS s, (SELECT count(*) FROM d WHERE yhat = cls) AS g,
         (SELECT count(*) FROM d WHERE y = cls AND yhat = cls) AS t FROM c""",
    m="SELECT cls, s, t, t::DOUBLE / g AS pr, t::DOUBLE / s AS re, 2 * t::DOUBLE / (s + g) AS f1 FROM q"))
def _classification_report(spark, sf):
    return me.binary_report(flows(spark, sf), y="label")


# ---- model comparison and selection ----------------------------------------

_TWO = """SELECT 'direct' AS model, label, p FROM flows UNION ALL
SELECT 'size_only', label, round(least(sbytes / 100000, 1), 3) FROM flows"""
_COMPARED = f"""SELECT model, tn, fp, fn, tp, {_RATE_SQL}, round(a.auc, 4) AS roc_auc, round(a.ap, 4) AS pr_auc
FROM ({_counts('two', [0.5], 'model')}) JOIN (SELECT model, {_AUC} AS auc, {_AP} AS ap FROM r GROUP BY model) a USING (model)"""
_COMPARE_CTES = {"two": _TWO, "r": _ranked("two", "label = 1", "p", "model")}


def _two_models(spark, sf):
    pair = F.array(
        F.struct(F.lit("direct").alias("model"), F.col("p").alias("score")),
        F.struct(F.lit("size_only").alias("model"), round_to(F.least(F.col("sbytes") / 100000, F.lit(1.0)), 3).alias("score")))
    return flows(spark, sf).select("label", F.inline(pair)).withColumnRenamed("score", "p")


@query("model_comparison", sql(_COMPARED, "flows", **_COMPARE_CTES))
def _model_comparison(spark, sf):
    return me.compare_binary(_two_models(spark, sf), ["model"], y="label")


_COMPOSITE = "pr_auc * 0.35::DOUBLE + recall * 0.3::DOUBLE + f1_score * 0.25::DOUBLE - false_positive_rate * 0.1::DOUBLE"


@query("select_binary", sql(f"""
SELECT model, round(s, 4) AS composite_score, row_number() OVER (ORDER BY s DESC, model) = 1 AS selected
FROM (SELECT model, {_COMPOSITE} AS s FROM ({_COMPARED}))""", "flows", **_COMPARE_CTES))
def _select_binary(spark, sf):
    rows = me.compare_binary(_two_models(spark, sf), ["model"], y="label")
    return th.select_binary_model(rows).select("model", "composite_score", "selected")


def _two_multi(spark, sf):
    """Two multiclass score sets: the view's own and one with sharpened probabilities reversed for odd rows."""
    flat = F.transform("probs", lambda v: F.when(F.col("spkts") % 2 == 1, 1.0 - v).otherwise(v))
    pair = F.array(
        F.struct(F.lit("direct").alias("model"), F.col("probs").alias("scores")),
        F.struct(F.lit("reversed").alias("model"), flat.alias("scores")))
    return probs(spark, sf).select("y", F.inline(pair)).withColumnRenamed("scores", "probs")


_TWO_MULTI = {
    "two": """SELECT 'direct' AS model, CAST(y AS INTEGER) AS y, probs FROM probs UNION ALL SELECT 'reversed', CAST(y AS INTEGER),
      list_transform(probs, lambda v: CASE WHEN spkts % 2 = 1 THEN 1 - v ELSE v END) FROM probs""",
    "pred": "SELECT model, y, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS yhat, probs FROM two",
    "side": "SELECT model, y AS cls, 1 AS s, 0 AS g, CASE WHEN y = yhat THEN 1 ELSE 0 END AS t FROM pred UNION ALL SELECT model, yhat, 0, 1, 0 FROM pred",
    "pc": """SELECT model, cls, sum(s) AS support, sum(t)::DOUBLE / nullif(sum(g), 0) AS p0, coalesce(sum(t)::DOUBLE / nullif(sum(s), 0), 0) AS re,
      2 * sum(t)::DOUBLE / (sum(s) + sum(g)) AS f1 FROM side GROUP BY model, cls""",
    "agg": """SELECT model, round(avg(re) FILTER (support > 0), 4) AS bal, round(avg(re), 4) AS mre, round(avg(f1), 4) AS mf1,
      avg(round(re, 4)) FILTER (cls IN (0, 1, 8, 9)) AS rare FROM pc GROUP BY model""",
}


@query("select_multi", sql("""
SELECT model, mf1 AS macro_f1, mre AS macro_recall, bal AS balanced_accuracy, round(s, 4) AS composite_score,
       row_number() OVER (ORDER BY s DESC, model) = 1 AS selected
FROM (SELECT *, mf1 * 0.4::DOUBLE + mre * 0.25::DOUBLE + rare * 0.25::DOUBLE + bal * 0.1::DOUBLE AS s FROM agg)""", "probs", **_TWO_MULTI))
def _select_multi(spark, sf):
    scored = me.with_prediction(_two_multi(spark, sf))
    rows = me.multi_metrics(scored, CLASSES, by=["model"])
    chosen = th.select_multi_model(rows, me.per_class_metrics(scored, CLASSES, by=["model"]))
    return chosen.select("model", "macro_f1", "macro_recall", "balanced_accuracy", "composite_score", "selected")


@query("multi_comparison", sql("""
SELECT model, mf1 AS macro_f1, round(l, 4) AS log_loss, round(a, 4) AS roc_auc_ovr_macro FROM agg
JOIN (SELECT model, avg(-ln(greatest(probs[y + 1] / list_sum(probs), 2.220446049250313e-16))) AS l FROM two GROUP BY model) USING (model)
JOIN (SELECT model, avg(v) AS a FROM (SELECT model, cls, """ + _AUC + """ AS v FROM r GROUP BY model, cls) GROUP BY model) USING (model)""",
    "probs", **_TWO_MULTI, e=f"SELECT model, CAST(unnest(range({_K})) AS INTEGER) AS cls, y, unnest(probs) AS v FROM two",
    r=_ranked("e", "y = cls", "v", "model, cls")))
def _multi_comparison(spark, sf):
    return me.compare_multi(_two_multi(spark, sf), CLASSES, ["model"]).select("model", "macro_f1", "log_loss", "roc_auc_ovr_macro")


# ---- triage -----------------------------------------------------------------


def _case(key, mapping, default="''"):
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {default} END"


_NORMAL_AT = CLASSES.index("Normal") + 1


def _triage_sql(threshold: float) -> dict[str, str]:
    return {
        "masked": f"SELECT id, row_number() OVER (ORDER BY id, spkts, sbytes, rate, dur) - 1 AS record_index, p, probs, list_transform(probs, lambda v, i: CASE WHEN i = {_NORMAL_AT} THEN -1::DOUBLE ELSE v END) AS m FROM probs",
        "best": f"SELECT id, record_index, p, p >= {threshold} AS hit, {CLASS_LIST_SQL}[list_position(m, list_max(m))] AS kind, round(list_max(m), 4) AS mp FROM masked",
        "events0": f"""SELECT id, record_index, CASE WHEN hit THEN 'Attack' ELSE 'Normal' END AS prediction, CASE WHEN hit THEN kind ELSE 'Normal' END AS attack_type,
          round(p, 4) AS binary_probability, CAST({threshold} AS DOUBLE) AS binary_threshold, CASE WHEN hit THEN round(p, 4) ELSE round(1 - p, 4) END AS binary_confidence,
          CASE WHEN hit THEN mp END AS multiclass_probability, CASE WHEN hit THEN mp ELSE round(1 - p, 4) END AS confidence,
          CASE WHEN hit THEN {_case('kind', SEVERITY)} ELSE 'None' END AS severity,
          CASE WHEN hit THEN {_case('kind', ACTIONS)} ELSE '{ACTIONS['Normal']}' END AS recommended_action FROM best""",
    }


_EVENT = ["id", "prediction", "attack_type", "binary_probability", "binary_threshold", "binary_confidence",
          "multiclass_probability", "confidence", "severity", "recommended_action"]


@query("two_stage_triage", sql("SELECT * EXCLUDE (record_index) FROM events0", "probs", **_triage_sql(0.8)))
def _two_stage(spark, sf):
    return tr.triage(probs(spark, sf)).select(*_EVENT)


@query("two_stage_bypass", sql("SELECT * EXCLUDE (record_index) FROM events0", "probs", **_triage_sql(0.8)))
def _two_stage_bypass(spark, sf):
    staged = probs(spark, sf).withColumnRenamed("probs", "_model")
    return tr.triage_with_bypass(staged, lambda rows: rows.withColumn("probs", F.col("_model"))).select(*_EVENT)


@query("triage_override", sql("SELECT * EXCLUDE (record_index) FROM events0", "probs", **_triage_sql(0.6)))
def _triage_override(spark, sf):
    return tr.triage(probs(spark, sf), threshold=0.6).select(*_EVENT)


@query("harmonize_events", sql("""
SELECT event_id, prediction, prediction = 'Attack' AS is_attack, attack_type,
       CASE WHEN prediction = 'Attack' THEN attack_type END AS attack_category, binary_probability, binary_confidence,
       multiclass_probability, multiclass_probability AS multi_confidence, binary_threshold, confidence, severity, recommended_action
FROM alerts""", "alerts"))
def _harmonize(spark, sf):
    full = alerts(spark, sf)
    partial = full.select("event_id", "prediction", "attack_category", "binary_probability", "multiclass_probability")
    return tr.harmonize(partial)


# ---- feature transforms -----------------------------------------------------


@query("impute_median", sql("""
SELECT id, coalesce(spkts, (SELECT quantile_cont(spkts, 0.5) FROM cleaned WHERE split = 'train')) AS spkts,
       round(coalesce(sbytes, (SELECT quantile_cont(sbytes, 0.5) FROM cleaned WHERE split = 'train')), 4) AS sbytes FROM cleaned""", "cleaned"))
def _impute_median(spark, sf):
    clean = cleaning.clean_infinities(flows_dirty(spark, sf)).select("id", "spkts", "sbytes", "split")
    fitted = fe.medians(clean.filter("split = 'train'"), ["spkts", "sbytes"])
    return fe.impute(clean, fitted).select("id", "spkts", round_to("sbytes", 4).alias("sbytes"))


@query("impute_mode", sql("""
SELECT id, coalesce(service, (SELECT service FROM cleaned WHERE split = 'train' AND service IS NOT NULL
                              GROUP BY service ORDER BY count(*) DESC, service LIMIT 1)) AS service FROM cleaned""", "cleaned"))
def _impute_mode(spark, sf):
    raw = flows_dirty(spark, sf).select("id", "service", "split")
    common = {r["feature"]: r["value"] for r in fe.modes(raw.filter("split = 'train'"), ["service"]).collect()}
    return fe.impute(raw, common).select("id", "service")


@query("standardize", sql("SELECT id, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM train)) / (SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END FROM train), 4) AS {c}"
    for c in ("spkts", "sbytes", "rate", "dttl")) + " FROM flows", "train"))
def _standardize(spark, sf):
    columns = ["spkts", "sbytes", "rate", "dttl"]
    fitted = fe.moments(splits(spark, sf)[0], columns)
    out = fe.standardize(flows(spark, sf).select("id", *columns), fitted)
    return out.select("id", *[round_to(c, 4).alias(c) for c in columns])


@query("one_hot", sql("""
SELECT id, proto, CASE WHEN proto = 'A' THEN 1 ELSE 0 END AS "proto_A", CASE WHEN proto = 'N' THEN 1 ELSE 0 END AS "proto_N" FROM flows""", "flows"))
def _one_hot(spark, sf):
    train, both = splits(spark, sf)[0].filter("proto <> 'R'"), flows(spark, sf).select("id", "proto")
    return fe.one_hot(both, "proto", fe.categories(train, ["proto"])["proto"])


@query("label_encode", sql("SELECT id, CAST(y AS INTEGER) AS y FROM probs", "probs"))
def _label_encode(spark, sf):
    return fe.label_encode(flows(spark, sf), "attack_cat", CLASSES).select("id", "y")


@query("class_weights", sql("""
SELECT attack_cat, count(*) AS n_class, round((SELECT count(*) FROM train)::DOUBLE / ((SELECT count(DISTINCT attack_cat) FROM train) * count(*)), 6) AS weight
FROM train GROUP BY attack_cat""", "train"))
def _class_weights(spark, sf):
    return fe.class_weights(splits(spark, sf)[0], "attack_cat").withColumn("weight", round_to("weight", 6))


@query("pos_weight", sql("""
SELECT count(*) FILTER (label = 0) AS n_negative, count(*) FILTER (label = 1) AS n_positive,
       round(coalesce(count(*) FILTER (label = 0) / nullif(count(*) FILTER (label = 1), 0)::DOUBLE, 1), 5) AS pos_weight FROM train""", "train"))
def _pos_weight(spark, sf):
    return fe.pos_weight(splits(spark, sf)[0])


_SCALED = [f"({c} - (SELECT avg({c}) FROM train)) / (SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END FROM train)" for c in NUMERIC]


@query("feature_matrix", sql(f"SELECT id, CAST(y AS INTEGER) AS y, round({' + '.join(_SCALED)} + 3, 4) AS scaled_sum, round({' + '.join(NUMERIC)} + 3, 4) AS raw_sum FROM probs",
                             "train", "probs"))
def _feature_matrix(spark, sf):
    from pyspark.ml.functions import vector_to_array

    train = materialize(splits(spark, sf)[0].select(*NUMERIC, *CATEGORICAL))
    fitted = fe.fit_features(train, NUMERIC, CATEGORICAL)
    out = fe.label_encode(fitted.transform(flows(spark, sf)), "attack_cat", CLASSES)

    def total(v):
        return round_to(F.aggregate(vector_to_array(v), F.lit(0.0), lambda a, x: a + x), 4)

    return out.select("id", "y", total("f_scaled").alias("scaled_sum"), total("f_raw").alias("raw_sum"))


@query("feature_width", sql(f"""
SELECT {len(NUMERIC)} + count(DISTINCT proto) + count(DISTINCT service) + count(DISTINCT state) AS n_features FROM train""", "train"))
def _feature_width(spark, sf):
    train = stored(splits(spark, sf)[0].select(*NUMERIC, *CATEGORICAL), "train")  # a fit reads it several times
    fitted = fe.fit_features(train, NUMERIC, CATEGORICAL)
    return fe.feature_names_frame(fitted, spark).agg(F.count("*").alias("n_features"))


@query("select_variance", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(sqrt(var_pop({c})), 4) AS deviation, var_pop({c}) > 0.01 AS keep FROM train" for c in NUMERIC), "train"))
def _select_variance(spark, sf):
    rows = fs.select_variance(splits(spark, sf)[0], NUMERIC)
    return rows.select("feature", round_to(F.sqrt("variance"), 4).alias("deviation"), "keep")


def _later(columns):
    return " UNION ALL ".join(
        f"SELECT '{b}' AS feature, " + (" AND ".join(
            f"coalesce(abs(CASE WHEN var_pop({a}) > 0 AND var_pop({b}) > 0 THEN corr({a}, {b}) END) <= 0.95, true)" for a in columns[:i])
            or "count(*) > 0") + " AS keep FROM train" for i, b in enumerate(columns))


@query("select_correlation", sql(_later(NUMERIC), "train"))
def _select_correlation(spark, sf):
    return fs.select_correlation(splits(spark, sf)[0], NUMERIC)


def _mi_sql(columns, bins=10):
    edges = "[" + ", ".join(str(i / bins) for i in range(1, bins)) + "]"
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, len(list_filter((SELECT quantile_cont({c}, {edges}) FROM train), lambda e: {c} > e)) AS bin, label AS y FROM train" for c in columns)
    return {
        "cells": cells, "j": "SELECT feature, bin, y, count(*)::DOUBLE AS n FROM cells GROUP BY ALL",
        "mi": """SELECT feature, greatest(sum(n / t * ln(n * t / (nb * ny))), 0) AS v FROM (SELECT *, sum(n) OVER (PARTITION BY feature, bin) AS nb,
              sum(n) OVER (PARTITION BY feature, y) AS ny, sum(n) OVER (PARTITION BY feature) AS t FROM j) GROUP BY feature""",
    }


_MI_COLUMNS = ["spkts", "sbytes", "rate", "dbytes", "smean", "p"]


@query("mutual_information", sql("SELECT feature, round(v, 6) AS mutual_information FROM mi", "train", **_mi_sql(_MI_COLUMNS)))
def _mutual_information(spark, sf):
    train = materialize(splits(spark, sf)[0].select("label", *_MI_COLUMNS))
    out = fs.mutual_information(train, _MI_COLUMNS)
    return out.withColumn("mutual_information", round_to("mutual_information", 6))


def _psi(m: str) -> str:
    """Digamma of a count: twenty steps up, then its series."""
    x = f"({m} + 20)::DOUBLE"
    return f"(ln({x}) - 0.5 / {x} - 1 / (12 * {x} * {x}) + 1 / (120 * {x} * {x} * {x} * {x}) - list_sum(list_transform(range(20), lambda j: 1.0 / ({m} + j))))"


_NEAR_SQL = {
    "long": " UNION ALL ".join(f"SELECT '{c}' AS feature, label AS y, {c} + 0.0::DOUBLE AS v FROM train" for c in NUMERIC),
    "sized": "SELECT * FROM long JOIN (SELECT feature, y, count(*) AS of_class FROM long GROUP BY ALL) USING (feature, y) WHERE of_class > 1",
    "far": """SELECT *, least(3, of_class - 1) AS k, list_sort(list_filter([v - lag(v, 1) OVER w, v - lag(v, 2) OVER w, v - lag(v, 3) OVER w,
              lead(v, 1) OVER w - v, lead(v, 2) OVER w - v, lead(v, 3) OVER w - v], lambda d: d IS NOT NULL))[least(3, of_class - 1)] AS r
              FROM sized WINDOW w AS (PARTITION BY feature, y ORDER BY v)""",
    "upto": "SELECT feature, v AS x, sum(count(*)) OVER (PARTITION BY feature ORDER BY v) AS n FROM sized GROUP BY feature, v",
    "point": "SELECT feature, v, of_class, k, r, count(*) AS times FROM far GROUP BY ALL",
    # Below the upper end, less those up to the lower one; an interval of no width holds its own value.
    "counted": """SELECT p.*, coalesce(a.n, 0) - coalesce(b.n, 0) AS m FROM point p
                  ASOF LEFT JOIN upto a ON p.feature = a.feature AND CASE WHEN r > 0 THEN v + r ELSE nextafter(v, 'inf'::DOUBLE) END > a.x
                  ASOF LEFT JOIN upto b ON p.feature = b.feature AND CASE WHEN r > 0 THEN v - r ELSE nextafter(v, '-inf'::DOUBLE) END >= b.x""",
}


@query("neighbour_information", sql(f"""
SELECT feature, round(greatest({_psi("sum(times)")} + sum(times * ({_psi("k")} - {_psi("of_class")} - {_psi("m")})) / sum(times), 0), 6) AS mutual_information
FROM counted GROUP BY feature""", "train", **_NEAR_SQL))
def _neighbour_information(spark, sf):
    """All numeric columns of the training split by three neighbours."""
    out = neighbour_information(splits(spark, sf)[0], NUMERIC, "label")
    return out.withColumn("mutual_information", round_to("mutual_information", 6))


_SELECTABLE = ["spkts", "sbytes", "rate", "dbytes", "smean", "sttl", "sload", "dttl"]
_SURVIVORS = ["spkts", "sbytes", "dbytes", "smean", "sttl"]


@query("select_features", sql("SELECT feature FROM mi ORDER BY round(v, 9) DESC, feature LIMIT 3", "train", **_mi_sql(_SURVIVORS)))
def _select_features(spark, sf):
    train = materialize(splits(spark, sf)[0].select("label", *_SELECTABLE))
    chosen = fs.select_features(train, _SELECTABLE, k=3)
    return spark.createDataFrame([(c,) for c in chosen.selected], "feature string")


# ---- attribution ------------------------------------------------------------

_COEF = {"spkts": 0.5, "sbytes": -0.001, "sttl": 0.25, "rate": 3.0}


@query("mean_abs_attribution", sql(" UNION ALL ".join(
    f"SELECT attack_cat, '{c}' AS feature, round(avg(abs({w} * ({c} - (SELECT avg({c}) FROM train)))), 4) AS importance FROM flows GROUP BY attack_cat"
    for c, w in _COEF.items()), "train"))
def _mean_abs_attribution(spark, sf):
    train, _ = splits(spark, sf)
    means = {c: m for c, (m, _) in fe.moments(train, list(_COEF)).items()}
    parts = linear_contributions(flows(spark, sf), _COEF, means, ["attack_cat"])
    return mean_abs_attribution(parts, ["attack_cat"]).select("attack_cat", "feature", round_to("importance", 4).alias("importance"))
