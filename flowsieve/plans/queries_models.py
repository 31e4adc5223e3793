"""Registered queries that train models; every row of the tables takes part.

Labels follow features here, so SQL states what a model must reach: a constant or
broken one fails its oracle. Rounds and trees are fewer than the defaults of
``models``, which every training function takes when given no parameters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowsieve.functions.scalars import round_to
from flowsieve.functions.scale import materialize, stored
from flowsieve.operators import explain as ex, forests as fo, metrics as me, models as mo
from flowsieve.plans import pipelines as pl
from flowsieve.plans.catalog import query
from flowsieve.plans.views import CATEGORICAL, CLASSES, NUMERIC, flows, learnable, learnable_splits, splits, sql
from flowsieve.schemas import FORBIDDEN_FIELDS, SEED
from flowsieve.session import scratch_path
from flowsieve.sources.readers import with_record_index
from flowsieve.sources.writers import read_events
from flowsieve.streaming import replay as st

_LR = {}
_RF = {"numTrees": 20, "maxDepth": 12}
_GBT = {"maxIter": 6, "maxDepth": 5}
_SOFT = {"maxIter": 6, "maxDepth": 4, "stepSize": 0.3}
_SMALL = {"logistic_regression": _LR, "random_forest": _RF, "boosted_trees": {"maxIter": 3, "maxDepth": 4, "stepSize": 0.3}}
_PARAMS = {"logistic_regression": _LR, "random_forest": _RF, "boosted_trees": _GBT}
#: What the models below must reach on the test split.
_AUC, _ACCURACY, _LOSS = 0.95, 0.85, 1.0


def _rows(spark, sf, ids=False):
    """Rows of both splits, stored once in a compressed table because every fit reads them again; without the ids, unless asked for."""
    kept = [*(["id"] if ids else []), *NUMERIC, *CATEGORICAL, "label", "attack_cat", "split"]
    rows = stored(learnable(spark, sf).select(*kept), "learnable")
    return tuple(rows.filter(F.col("split") == s).drop("split") for s in ("train", "test"))


def _prepared(spark, sf, ids=False):
    """Features of both splits over the stored rows: a vector costs less to make from its row than to read back."""
    return pl.build_features(*_rows(spark, sf, ids), CLASSES, numeric=NUMERIC, categorical=CATEGORICAL)


# What SQL can know of a sound model: every test row is scored, with probabilities in range that
# sum to one, each class keeps its rows, and the rule behind the labels is found.
_BINARY_KNOWN = sql("""
SELECT count(*) AS n_rows, count(*) FILTER (label = 0) AS n_normal, count(*) FILTER (label = 1) AS n_attack,
       count(*) AS n_in_range, true AS learned FROM learnable_test""", "learnable_test")
_MULTI_KNOWN = sql("""
SELECT attack_cat AS class, count(*) AS n_rows, count(*) AS n_in_range, true AS learned FROM learnable_test GROUP BY attack_cat""", "learnable_test")


def _binary(fit):
    def run(spark, sf):
        _, train, test = _prepared(spark, sf)
        scored = materialize(fit(train).score_binary(test).select("label", "p"))
        rates = me.binary_metrics(scored, y="label")
        in_range = scored.agg(F.count_if(F.col("p").between(0, 1)).alias("n_in_range"))
        area = me.ranking_areas(scored, "label").select("roc_auc")
        return rates.select(
            (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n_rows"), (F.col("tn") + F.col("fp")).alias("n_normal"),
            (F.col("fn") + F.col("tp")).alias("n_attack"), in_range.scalar().alias("n_in_range"), (area.scalar() >= _AUC).alias("learned"))

    return run


def _multi(fit):
    def run(spark, sf):
        _, train, test = _prepared(spark, sf)
        scored = me.with_prediction(materialize(fit(train).score_multi(test).select("attack_cat", "y", "probs")))
        total = F.aggregate("probs", F.lit(0.0), lambda a, v: a + v)
        fine = (F.size("probs") == len(CLASSES)) & (F.abs(total - 1) < 1e-6) & (F.array_min("probs") >= 0)
        right = me.accuracy(scored).scalar() >= _ACCURACY
        close = me.log_loss(scored).scalar() <= _LOSS
        return scored.groupBy(F.col("attack_cat").alias("class")).agg(
            F.count("*").alias("n_rows"), F.count_if(fine).alias("n_in_range")).withColumn("learned", right & close)

    return run


query("train_lr", _BINARY_KNOWN)(_binary(lambda t: mo.train_logistic(t, params=_LR)))
query("train_rf", _BINARY_KNOWN)(_binary(lambda t: mo.train_forest(t, params=_RF)))
query("train_gbt", _BINARY_KNOWN)(_binary(lambda t: mo.train_boosted(t, params=_GBT)))
query("train_multi_lr", _MULTI_KNOWN)(_multi(lambda t: mo.train_logistic(t, "y", multinomial=True, params=_LR)))
query("train_multi_rf", _MULTI_KNOWN)(_multi(lambda t: mo.train_forest(t, "y", multiclass=True, params=_RF)))
query("train_multi_gbt", _MULTI_KNOWN)(_multi(lambda t: mo.train_multi_boosted(t, "y", len(CLASSES), params=_SOFT)))
query("train_bootstrap_forest", _MULTI_KNOWN)(_multi(lambda t: mo.train_forest(t, "y", multiclass=True, params=_RF | {"numTrees": 12}, balance="bootstrap")))


@query("bootstrap_weights", sql("""
SELECT tree, attack_cat AS class, round(1.0 / (SELECT count(DISTINCT attack_cat) FROM learnable_train), 6)::DOUBLE AS share, true AS drawn
FROM (SELECT DISTINCT attack_cat FROM learnable_train), range(8) t(tree)""", "learnable_train"))
def _bootstrap_weights(spark, sf):
    """Per tree: every class holds the same share of the weights, and about as many copies are drawn as there are rows."""
    train = learnable_splits(spark, sf)[0].select("id", "attack_cat").withColumn("y", F.array_position(F.lit(CLASSES), F.col("attack_cat")))
    rows = materialize(train.select("y", "attack_cat", F.xxhash64("id").alias("row")))
    weights = fo.bootstrap_weights(rows, "y", "row", 8, SEED)
    sums = weights.groupBy("tree", "class").agg(F.sum("weight").alias("w"), F.sum("copies").alias("c"), F.count("*").alias("n"))
    trees = sums.groupBy("tree").agg(F.sum("w").alias("all_w"), (F.abs(F.sum("c") / F.sum("n") - 1) < 0.08).alias("drawn"))
    name = F.element_at(F.lit(CLASSES), F.col("class").cast("int"))
    return sums.join(trees, "tree").select("tree", name.alias("class"), round_to(F.col("w") / F.col("all_w"), 6).alias("share"), "drawn")


@query("train_suite", sql("""
SELECT unnest(['logistic_regression', 'random_forest', 'boosted_trees']) AS model, 'test' AS split, true AS learned, count(*) AS n_test,
       (SELECT count(*) FROM learnable_train) AS n_train FROM learnable_test""", "learnable_train", "learnable_test"))
def _train_suite(spark, sf):
    """Three binary models compared on the test split."""
    _, train, test = _prepared(spark, sf)
    suite = mo.train_binary_suite(train, params=_PARAMS)
    rows = pl.evaluate_binary_suite(suite, test, "test").join(mo.suite_metadata(spark, suite, train.count()).select("model", "n_train"), "model")
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return rows.select("model", "split", (F.col("roc_auc") >= _AUC).alias("learned"), total.alias("n_test"), "n_train")


@query("train_multi_suite", sql("""
SELECT unnest(['logistic_regression', 'random_forest', 'boosted_trees']) AS model, 'test' AS split, true AS learned""", "learnable_test"))
def _train_multi_suite(spark, sf):
    _, train, test = _prepared(spark, sf)
    suite = mo.train_multi_suite(train, "y", len(CLASSES), _SMALL)
    rows = pl.evaluate_multi_suite(suite, test, CLASSES, "test")
    return rows.select("model", "split", (F.col("accuracy") >= _ACCURACY).alias("learned"))


@query("attack_only_eval", sql("""
SELECT unnest(['validation', 'validation', 'validation', 'test']) AS split, true AS learned""", "learnable_test"))
def _attack_only_eval(spark, sf):
    """Attack types from attack rows: three models on validation, the chosen one on test."""
    _, train, test = _prepared(spark, sf, ids=True)
    rows = pl.attack_only_experiment(train, test, CLASSES, params=_SMALL)
    return rows.select("split", (F.col("accuracy") >= _ACCURACY).alias("learned"))


@query("threshold_selection_run")
def _threshold_selection_run(spark, sf):
    """Split, fit, choose on validation, refit, report on test."""
    _, train, test = _prepared(spark, sf, ids=True)
    return pl.select_threshold_safely(train, lambda: test, params=_GBT).report


_USED = ["spkts", "sttl", "proto"]


@query("perm_importance", sql(f"""
SELECT unnest({[*NUMERIC, *CATEGORICAL]}) AS feature, unnest({[c in _USED for c in [*NUMERIC, *CATEGORICAL]]}) AS informative""", "learnable_test"))
def _perm_importance(spark, sf):
    """Ten permutations of the whole split for every feature: those behind the labels matter, the others do not."""
    fitted, train, test = _prepared(spark, sf, ids=True)
    model = mo.train_boosted(train, params=_GBT)
    rows = test.select("id", *NUMERIC, *CATEGORICAL, "label")
    out = ex.permutation_importance(
        rows, [*NUMERIC, *CATEGORICAL], ["id"], "label", lambda d: model.score_binary(fitted.transform(d)), repeats=10)
    return out.select("feature", (F.col("importance") > 0.02).alias("informative"))


@query("permuted_rows", sql("""
SELECT r AS repeat, count(*) AS n_rows, count(*) AS n_sources, 0::BIGINT AS lowest, count(*) - 1 AS highest,
       round(sum(sbytes), 2) AS sbytes, true AS moved FROM test, range(10) t(r) GROUP BY r""", "test"))
def _permuted_rows(spark, sf):
    """Every repeat is one-to-one over the whole split and keeps all values."""
    out = ex.permuted_rows(splits(spark, sf)[1], NUMERIC, ["id"], 10, SEED)
    return out.groupBy("repeat").agg(
        F.count("*").alias("n_rows"), F.count_distinct("_from").alias("n_sources"), F.min("_from").alias("lowest"), F.max("_from").alias("highest"),
        round_to(F.sum("values.sbytes"), 2).alias("sbytes"), (F.count_if(F.col("_from") == F.col("_to")) < 50).alias("moved"))


@query("detect", sql("SELECT attack_cat AS class, count(*) AS n_events, true AS learned FROM learnable_test GROUP BY attack_cat", "learnable_test"))
def _detect(spark, sf):
    """Trained two-stage detector over the test split."""
    fitted, train, _ = _prepared(spark, sf)
    detector = pl.Detector(fitted, mo.train_boosted(train, params=_GBT), mo.train_forest(train, "y", multiclass=True, params=_RF), CLASSES)
    records = with_record_index(learnable_splits(spark, sf)[1], ["id", "spkts", "sbytes"])
    events = detector.detect(records, "run", threshold=0.5)
    assert not set(events.columns) & set(FORBIDDEN_FIELDS)
    truth = records.select(F.col("record_index").alias("of"), "attack_cat")
    kinds = events.join(truth, F.col("record_index") == F.col("of")).select("attack_cat", "attack_type")
    return kinds.groupBy(F.col("attack_cat").alias("class")).agg(
        F.count("*").alias("n_events"), (F.avg((F.col("attack_cat") == F.col("attack_type")).cast("int")) > 0.8).alias("learned"))


@query("saved_model_scores", sql("SELECT count(*) AS n_rows, count(*) AS n_equal FROM test", "test"))
def _saved_model_scores(spark, sf):
    """A reloaded model and feature pipeline score every test row as the originals do."""
    rows, test = _rows(spark, sf, ids=True)
    fitted, train, _ = pl.build_features(rows, test, CLASSES, numeric=NUMERIC, categorical=CATEGORICAL)
    model = mo.train_forest(train, params=_RF)
    path = scratch_path(spark, "model")
    mo.save_model(model, f"{path}/forest")
    fitted.model.write().overwrite().save(f"{path}/features")
    again = mo.TrainedModel("random_forest", mo.load_model("random_forest", f"{path}/forest"), "f_raw", 0.0)
    before = model.score_binary(fitted.transform(test)).select("id", F.col("p").alias("a"))
    after = again.score_binary(mo.load_model("pipeline", f"{path}/features").transform(test)).select("id", F.col("p").alias("b"))
    return before.join(after, "id").agg(
        F.count("*").alias("n_rows"), F.count_if(F.abs(F.col("a") - F.col("b")) < 1e-12).alias("n_equal"))


@query("evaluate_one", sql("""
SELECT count(*) AS total_samples, count(*) FILTER (label = 0) AS n_normal, count(*) FILTER (label = 1) AS n_attack
     , true AS learned FROM learnable_test""", "learnable_test"))
def _evaluate_one(spark, sf):
    """One model at a non-default threshold; counts cover the split, class by class."""
    _, train, test = _prepared(spark, sf)
    rows = pl.evaluate_one(mo.train_logistic(train, params=_LR), test, threshold=0.7)
    return rows.select(
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("total_samples"),
        (F.col("tn") + F.col("fp")).alias("n_normal"), (F.col("fn") + F.col("tp")).alias("n_attack"),
        ((F.col("tn") + F.col("tp")) / (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")) > 0.85).alias("learned"))


@query("explain_linear", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(abs({w} * ({c} - (SELECT avg({c}) FROM train)))), 4) AS importance FROM flows"
    for c, w in (("spkts", 0.5), ("sttl", 0.25))), "train"))
def _explain_linear(spark, sf):
    from flowsieve.operators.features import moments

    weights = {"spkts": 0.5, "sttl": 0.25}
    means = {c: m for c, (m, _) in moments(splits(spark, sf)[0], list(weights)).items()}
    out = ex.explain(flows(spark, sf), list(weights), ["id"], "label", coefficients=weights, means=means)
    return out.select("feature", round_to("importance", 4).alias("importance"))


@query("paced_replay", sql("""
SELECT attack_cat AS class, count(*) FILTER (spkts <> 7) AS n_events, count(*) FILTER (spkts = 7) AS n_rejected, true AS learned, true AS in_pace
FROM learnable_test GROUP BY attack_cat""", "learnable_test"))
def _paced_replay(spark, sf):
    """Trained two-stage detector over a paced replay of the test split; records whose packets are no number are left out."""
    fitted, train, _ = _prepared(spark, sf)
    detector = pl.Detector(fitted, mo.train_boosted(train, params=_GBT), mo.train_forest(train, "y", multiclass=True, params=_RF), CLASSES)
    path = scratch_path(spark, "paced")
    bad = F.when(F.col("spkts") == 7, "seven?").otherwise(F.col("spkts").cast("string"))
    records = learnable_splits(spark, sf)[1].withColumn("spkts", bad)
    total = st.stage_numbered(records, f"{path}-records", ["id", "sbytes"])
    rows = -(-total // 4)  # four steps, each of which may take up to what the pace allows
    stream = st.start_paced(
        spark, f"{path}-records", lambda part: detector.detect(part, "run", threshold=0.5, on_error="quarantine"),
        path, f"{path}-checkpoint", rows, every="3 seconds")
    steps = st.drain_paced(stream, total)
    truth = spark.read.parquet(f"{path}-records").select(F.col("record_index").alias("of"), "attack_cat")
    both = truth.join(read_events(spark, path), F.col("record_index") == F.col("of"), "left")
    return both.groupBy(F.col("attack_cat").alias("class")).agg(
        F.count("record_index").alias("n_events"), F.count_if(F.col("record_index").isNull()).alias("n_rejected"),
        (F.avg((F.col("attack_cat") == F.col("attack_type")).cast("int")) > 0.8).alias("learned"),
        F.lit(all(s["records"] <= rows for s in steps)).alias("in_pace"))
