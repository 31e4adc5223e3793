"""End-to-end runs: preparation, suites, threshold selection, attack-only experiment, detection."""

from __future__ import annotations

import functools
import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowsieve import MODEL_VERSION
from flowsieve.functions.scale import materialize
from flowsieve.operators import cleaning, metrics, models, profiling, sampling, thresholds, triage, validation
from flowsieve.operators.features import FittedFeatures, fit_features, feature_names_frame, label_encode
from flowsieve.schemas import (
    NORMAL, OPERATIONAL_THRESHOLD, RARE_CATEGORIES, RECALL_FLOOR, SEED, THRESHOLDS, VALIDATION_FRACTION,
)
from flowsieve.sources import readers, writers

# ---- preparation ------------------------------------------------------------


def profile_splits(train: DataFrame, test: DataFrame, id_column: str = "id") -> DataFrame:
    """Profiles of both splits, one row each."""
    tagged = [f.withColumn("split", F.lit(n)) for n, f in (("train", train), ("test", test))]
    return profiling.split_profile(tagged[0].unionByName(tagged[1]), id_column, by="split")


def clean_to(df: DataFrame, path: str) -> int:
    """Clean a split into Parquet; fails if the row count changes."""
    seen = Observation()
    source = df.observe(seen, F.count("*").alias("n"))
    written = writers.write_table(cleaning.clean_split(source), path)
    cleaning.require_same_rows(seen.get["n"], written)
    return written


def prepare_csv(spark: SparkSession, train_csv: str, test_csv: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Read both raw splits, clean them to Parquet and return the cleaned tables."""
    train, test = readers.read_splits(spark, train_csv, test_csv)
    for name, frame in (("train", train), ("test", test)):
        clean_to(frame, f"{out}/{name}")
    return readers.read_table(spark, f"{out}/train"), readers.read_table(spark, f"{out}/test")


def build_features(
    train: DataFrame, test: DataFrame, classes: Sequence[str], category: str = "attack_cat", **fit_options
) -> tuple[FittedFeatures, DataFrame, DataFrame]:
    """Fit on train, transform both, add the class index ``y``."""
    fitted = fit_features(train, **fit_options)
    return fitted, *[label_encode(fitted.transform(f), category, classes) for f in (train, test)]


def save_features(fitted: FittedFeatures, train: DataFrame, test: DataFrame, path: str) -> None:
    """Pipeline, feature names and both feature tables."""
    spark = train.sparkSession
    fitted.model.write().overwrite().save(f"{path}/pipeline")
    columns = ["label", "y", "f_scaled", "f_raw"]
    for name, frame in (("train", train), ("test", test)):
        writers.write_features(frame.select(*[c for c in ("id", *columns) if c in frame.columns]),
                               feature_names_frame(fitted, spark), f"{path}/{name}")


def load_features(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Feature tables and names written by :func:`save_features`."""
    names = spark.read.json(f"{path}/train/names").orderBy("position").collect()
    train, test = (readers.read_table(spark, f"{path}/{n}/rows") for n in ("train", "test"))
    return train, test, [r["feature"] for r in names]


# ---- suites -----------------------------------------------------------------


def evaluate_binary_suite(
    suite: Mapping[str, models.TrainedModel], data: DataFrame, split: str, label: str = "label",
    threshold: float = 0.5,
) -> DataFrame:
    """Comparison rows of a binary suite on one split, with composite scores and scoring times.

    Each model scores the split once; all metrics read the stored scores.
    """
    scored, times = _timed_scores(suite, data, label)
    rows = metrics.compare_binary(scored, ["model"], threshold)
    return thresholds.select_binary_model(rows).join(times, "model").withColumn("split", F.lit(split))


def _timed_scores(
    suite: Mapping[str, models.TrainedModel], data: DataFrame, label: str, multi: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Stored scores of every model, and per model the seconds of scoring and microseconds per row."""
    parts, rows = [], []
    for name, trained in suite.items():
        started = time.perf_counter()
        part = materialize(models.score_suite({name: trained}, data, label, multi=multi))
        seconds = time.perf_counter() - started
        parts.append(part)
        rows.append((name, seconds, seconds / max(part.count(), 1) * 1e6))
    times = data.sparkSession.createDataFrame(rows, "model string, scoring_seconds double, micros_per_row double")
    return functools.reduce(DataFrame.unionByName, parts), times


def evaluate_multi_suite(
    suite: Mapping[str, models.TrainedModel], data: DataFrame, classes: Sequence[str], split: str,
    y: str = "y", class_universe: str = "seen", rare: Sequence[str] = tuple(RARE_CATEGORIES),
) -> DataFrame:
    """Comparison rows of a multiclass suite on one split, with composite scores."""
    scored, times = _timed_scores(suite, data, y, multi=True)
    scored = metrics.with_prediction(scored)
    rows = metrics.compare_multi(scored, classes, ["model"], class_universe=class_universe)
    per_class = metrics.per_class_metrics(scored, classes, by=["model"])
    return thresholds.select_multi_model(rows, per_class, rare).join(times, "model").withColumn("split", F.lit(split))


def evaluate_one(trained: models.TrainedModel, data: DataFrame, label: str = "label", threshold: float = 0.5) -> DataFrame:
    """Metrics of one binary model at the given threshold."""
    return metrics.binary_metrics(trained.score_binary(data), threshold, label)


def best_model(rows: DataFrame) -> str:
    return rows.filter("selected").first()["model"]


# ---- leakage-safe threshold selection --------------------------------------


@dataclass
class ThresholdRun:
    threshold: float
    report: DataFrame
    impact: DataFrame
    model: models.TrainedModel


def select_threshold_safely(
    train: DataFrame, load_test: Callable[[], DataFrame], ids: Sequence[str] = ("id",), label: str = "label",
    marks: Sequence[float] = tuple(THRESHOLDS), fraction: float = VALIDATION_FRACTION, seed: int = SEED,
    floor: float = RECALL_FLOOR, params: Mapping | None = None,
) -> ThresholdRun:
    """Split train, fit on one part, choose the threshold on the other, refit on all, then open test.

    The test split arrives through ``load_test``, called only after the choice is made.
    """
    parts = materialize(sampling.stratified_split(train, label, ids, fraction, seed))
    first = models.train_boosted(parts.filter("NOT is_validation"), label, weighted=False, params=params)
    validation_scores = first.score_binary(parts.filter("is_validation"))
    validation_sweep = materialize(metrics.threshold_sweep(validation_scores, marks, label))
    chosen = thresholds.selected_value(validation_sweep, floor)
    final = models.train_boosted(train, label, weighted=False, params=params)
    test_sweep = metrics.threshold_sweep(final.score_binary(load_test()), marks, label)
    report = thresholds.threshold_report(validation_sweep, test_sweep, floor)
    return ThresholdRun(chosen, report, metrics.threshold_impact(test_sweep, chosen), final)


def save_threshold(spark: SparkSession, run: ThresholdRun, path: str) -> None:
    """Report, impact and the metadata a detector reads its threshold from."""
    writers.write_metrics(run.report, f"{path}/report")
    writers.write_metrics(run.impact, f"{path}/impact")
    meta = json.dumps({"selected_threshold": run.threshold, "model_version": MODEL_VERSION})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


# ---- attack-only experiment -------------------------------------------------


def attack_only_experiment(
    train: DataFrame, test: DataFrame, classes: Sequence[str], ids: Sequence[str] = ("id",),
    category: str = "attack_cat", label: str = "label", params: Mapping[str, Mapping] | None = None,
    kinds: Sequence[str] = models.MODEL_KINDS, seed: int = SEED,
) -> DataFrame:
    """Train attack-type models on attack rows only; select on validation, then report test.

    ``train`` and ``test`` carry ``f_scaled`` and ``f_raw``. The test rows are
    scored for the winner of the validation split alone.
    """
    kinds_of_attack = [c for c in sorted(classes) if c != NORMAL]

    def attacks(frame: DataFrame) -> DataFrame:
        return label_encode(validation.attack_only(frame, label, category), category, kinds_of_attack)

    parts = materialize(sampling.stratified_split(attacks(train), category, ids, seed=seed))
    suite = models.train_multi_suite(parts.filter("NOT is_validation"), "y", len(kinds_of_attack), params, kinds)
    chosen = materialize(evaluate_multi_suite(
        suite, parts.filter("is_validation"), kinds_of_attack, "validation", class_universe="all"))
    winner = best_model(chosen)
    final = evaluate_multi_suite({winner: suite[winner]}, attacks(test), kinds_of_attack, "test", class_universe="all")
    return chosen.unionByName(final)


# ---- detection --------------------------------------------------------------


@dataclass
class Detector:
    """Features, both models and the threshold; scores batch and streaming frames alike."""

    features: FittedFeatures
    binary: models.TrainedModel
    multi: models.TrainedModel
    classes: list[str]
    threshold: float = OPERATIONAL_THRESHOLD

    def score(self, records: DataFrame) -> DataFrame:
        """Add ``p`` and ``probs``."""
        ready = self.features.transform(records)
        return self.multi.score_multi(self.binary.score_binary(ready)).drop("f_raw", "f_scaled")

    def detect(
        self, records: DataFrame, run_id: str, keys: Sequence[str] = ("record_index",), threshold: float | None = None,
        on_error: str = "fail",
    ) -> DataFrame:
        """Alert events for records that carry a ``record_index``. Ground truth is dropped first.

        Text that is no number stops the job or, with ``on_error="quarantine"``, drops the record.
        """
        scored = self.score(self._inputs(records, keys, on_error))
        mark = self.threshold if threshold is None else float(threshold)
        return triage.as_events(triage.triage(scored, self.classes, threshold=mark), run_id, keys=keys)

    def _inputs(self, records: DataFrame, keys: Sequence[str], on_error: str) -> DataFrame:
        required = [*self.features.numeric, *self.features.categorical]
        kept = list(dict.fromkeys([*keys, "record_index"]))
        return validation.checked_numbers(validation.strip_ground_truth(records, required, kept), self.features.numeric, on_error)

    def detect_flagged(
        self, records: DataFrame, run_id: str, keys: Sequence[str] = ("record_index",), on_error: str = "fail",
    ) -> DataFrame:
        """As :meth:`detect`, running the second model on flagged rows only."""
        ready = self.features.transform(self._inputs(records, keys, on_error))
        scored = materialize(self.binary.score_binary(ready))  # both branches read it
        staged = triage.triage_with_bypass(scored, self.multi.score_multi, self.classes, threshold=self.threshold)
        return triage.as_events(staged.drop("f_raw", "f_scaled"), run_id, keys=keys)

    def metadata(self, spark: SparkSession) -> DataFrame:
        row = (MODEL_VERSION, self.binary.kind, self.multi.kind, self.threshold,
               len(self.features.numeric) + len(self.features.categorical), len(self.classes), list(self.classes))
        return spark.createDataFrame([row], (
            "model_version string, binary_model string, multi_model string, binary_threshold double, "
            "n_features int, n_classes int, classes array<string>"))


def save_detector(detector: Detector, path: str) -> None:
    """Feature pipeline, both models and their metadata."""
    spark = SparkSession.active()
    detector.features.model.write().overwrite().save(f"{path}/features")
    models.save_model(detector.binary, f"{path}/binary")
    models.save_model(detector.multi, f"{path}/multi")
    features = detector.features
    about = {
        "selected_threshold": detector.threshold, "classes": detector.classes, "binary": detector.binary.kind,
        "multi": detector.multi.kind, "binary_input": detector.binary.features, "multi_input": detector.multi.features,
        "names": features.names, "numeric": features.numeric, "categorical": features.categorical,
    }
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_detector(spark: SparkSession, path: str, threshold: float | None = None) -> Detector:
    """A detector written by :func:`save_detector`; a missing one is an error."""
    readers.require_path(spark, path)
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    features = FittedFeatures(
        models.load_model("pipeline", f"{path}/features"), about["names"], about["numeric"], about["categorical"])
    multi_loader = "multi_boosted_trees" if about["multi"] == "boosted_trees" else about["multi"]
    binary = models.TrainedModel(about["binary"], models.load_model(about["binary"], f"{path}/binary"), about["binary_input"], 0.0)
    multi = models.TrainedModel(about["multi"], models.load_model(multi_loader, f"{path}/multi"), about["multi_input"], 0.0)
    mark = about["selected_threshold"] if threshold is None else threshold
    return Detector(features, binary, multi, about["classes"], mark)
