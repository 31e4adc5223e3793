"""Two-stage triage: scores in, alert events out. One set of expressions, batch or stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve import MODEL_VERSION
from flowsieve.functions.scalars import argmax, class_name, lookup, round_share, round_to, without_index
from flowsieve.functions.scale import broadcast_if_small
from flowsieve.operators.metrics import flagged
from flowsieve.schemas import (
    ACTIONS, CATEGORIES, DEFAULT_ACTION, DEFAULT_SEVERITY, NORMAL, OPERATIONAL_THRESHOLD, SEVERITY,
)

Scorer = Callable[[DataFrame], DataFrame]


def event_id(run_id: str, *keys: str) -> Column:
    """Repeatable event identity: a rerun of the same record overwrites itself."""
    return F.sha2(F.concat_ws("|", F.lit(run_id), *[F.col(k).cast("string") for k in keys]), 256)


def triage(
    scored: DataFrame, classes: Sequence[str] = tuple(sorted(CATEGORIES)), p: str = "p", probs: str = "probs",
    threshold: float | Column = OPERATIONAL_THRESHOLD, normal: str = NORMAL,
) -> DataFrame:
    """Add decision, attack type, confidences, severity and action to scored rows.

    Below the threshold stage two is ignored. Above it the type is the most
    probable class other than normal, the first one on ties.
    """
    classes = list(classes)
    mark = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    attack = flagged(F.col(p), mark)
    others = [c for c in classes if c != normal]
    rivals = without_index(F.col(probs), classes.index(normal)) if normal in classes else F.col(probs)
    staged = scored.withColumns({"_attack": attack, "_rivals": F.when(attack, rivals)})
    kind = F.when(F.col("_attack"), class_name(argmax(F.col("_rivals")), others)).otherwise(normal)
    stage_two = round_share(F.array_max("_rivals"))
    stage_one = round_share(F.when(F.col("_attack"), F.col(p)).otherwise(1.0 - F.col(p)))
    return staged.withColumns({
        "prediction": F.when(F.col("_attack"), "Attack").otherwise("Normal"),
        "attack_type": kind,
        "binary_probability": round_share(p),
        "binary_threshold": round_to(mark, 2),
        "binary_confidence": stage_one,
        "multiclass_probability": stage_two,
        "confidence": F.when(F.col("_attack"), stage_two).otherwise(stage_one),
        "severity": F.when(F.col("_attack"), lookup(SEVERITY, kind, DEFAULT_SEVERITY)).otherwise("None"),
        "recommended_action": F.when(F.col("_attack"), lookup(ACTIONS, kind, DEFAULT_ACTION)).otherwise(ACTIONS[NORMAL]),
        "is_attack": F.col("_attack"),
    }).drop("_attack", "_rivals")


def triage_with_bypass(
    scored: DataFrame, stage_two: Scorer, classes: Sequence[str] = tuple(sorted(CATEGORIES)), p: str = "p",
    probs: str = "probs", threshold: float = OPERATIONAL_THRESHOLD, normal: str = NORMAL,
) -> DataFrame:
    """As :func:`triage`, but only flagged rows pass through the stage-two model."""
    hit = flagged(F.col(p), threshold)
    alerts = stage_two(scored.filter(hit))
    quiet = scored.filter(~hit).withColumn(probs, F.lit(None).cast("array<double>"))
    return triage(alerts.unionByName(quiet, allowMissingColumns=True), classes, p, probs, threshold, normal)


def as_events(
    triaged: DataFrame, run_id: str, record_index: str = "record_index", keys: Sequence[str] = (),
    timestamp: Column | None = None,
) -> DataFrame:
    """Complete triaged rows to alert events: identity, time and provenance."""
    return triaged.withColumns({
        "event_id": event_id(run_id, *(keys or [record_index])),
        "timestamp": F.current_timestamp() if timestamp is None else timestamp,
        "model_version": F.lit(MODEL_VERSION),
        "record_index": F.col(record_index).cast("long"),
    })


def triage_lookup(events: DataFrame, dimension: DataFrame, key: str = "attack_type") -> DataFrame:
    """Severity and action from a dimension table, with defaults for unknown types."""
    return events.join(broadcast_if_small(dimension), key, "left").fillna(
        {"severity": DEFAULT_SEVERITY, "recommended_action": DEFAULT_ACTION})


def harmonize(events: DataFrame, threshold: float = OPERATIONAL_THRESHOLD) -> DataFrame:
    """Fill the two spellings of each event field from one another, then the defaults.

    A missing event id becomes a random one and a missing time the current one,
    where the table has such a column; store the result before reading it twice.
    """
    late = {"event_id": F.expr("uuid()"), "timestamp": F.current_timestamp()}
    events = events.withColumns({
        c: F.coalesce(F.col(c), v.cast(events.schema[c].dataType)) for c, v in late.items() if c in events.columns
    })
    wanted = {
        "is_attack": "boolean", "prediction": "string", "attack_type": "string", "attack_category": "string",
        "binary_probability": "double", "binary_confidence": "double", "multiclass_probability": "double",
        "multi_confidence": "double", "binary_threshold": "double", "confidence": "double",
        "severity": "string", "recommended_action": "string",
    }
    full = events.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in events.columns})
    c = F.col
    full = full.withColumn("is_attack", F.coalesce(c("is_attack"), c("prediction") == "Attack", F.lit(False)))
    attack = c("is_attack")
    full = full.withColumns({
        "prediction": F.coalesce(c("prediction"), F.when(attack, "Attack").otherwise("Normal")),
        "attack_type": F.coalesce(c("attack_type"), c("attack_category"), F.when(attack, "Attack").otherwise("Normal")),
        "binary_probability": F.coalesce(c("binary_probability"), c("binary_confidence")),
        "multiclass_probability": F.coalesce(c("multiclass_probability"), c("multi_confidence")),
        "binary_threshold": F.coalesce(c("binary_threshold"), F.lit(float(threshold))),
    })
    full = full.withColumns({
        "attack_category": F.coalesce(c("attack_category"), F.when(attack, c("attack_type"))),
        "binary_confidence": F.coalesce(
            c("binary_confidence"),
            F.when(attack, c("binary_probability")).otherwise(round_to(1.0 - c("binary_probability"), 4))),
        "multi_confidence": F.coalesce(c("multi_confidence"), c("multiclass_probability")),
    })
    full = full.withColumns({
        "confidence": F.coalesce(
            c("confidence"),
            F.when(attack, c("multiclass_probability")).otherwise(c("binary_confidence")), c("binary_confidence")),
        "severity": F.coalesce(
            c("severity"), lookup(SEVERITY, c("attack_type"), F.when(attack, "Critical").otherwise("None"))),
        "recommended_action": F.coalesce(
            c("recommended_action"), lookup(ACTIONS, c("attack_type"), ACTIONS[NORMAL])),
    })
    rounded = ["binary_probability", "binary_confidence", "multiclass_probability", "multi_confidence", "confidence"]
    return full.withColumns({n: round_to(c(n), 4) for n in rounded})


def alert_rows(events: DataFrame, src_ip: str = "srcip", dst_ip: str = "dstip") -> DataFrame:
    """The seven-column alert table."""
    return events.select(
        "timestamp", F.col(src_ip).alias("src_ip"), F.col(dst_ip).alias("dst_ip"), "proto",
        (F.col("prediction") == "Attack").alias("is_attack"),
        F.when(F.col("prediction") == "Attack", F.col("attack_type")).alias("attack_category"), "confidence",
    )
