"""Alert analytics over event tables; each is one aggregate and works on streams where noted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.functions.scalars import round_to

_ATTACK = "prediction = 'Attack'"


def summary_columns() -> list[Column]:
    """The summary aggregates; usable in batch and in a complete-mode stream."""
    attacks = F.count_if(F.col("prediction") == "Attack")
    critical = F.count_if(F.col("severity") == "Critical")
    high = F.count_if(F.col("severity") == "High")
    risk = (
        F.when(F.count("*") == 0, "—").when(critical > 0, "Critical").when(high > 0, "High")
        .when(attacks > 0, "Medium").otherwise("Normal")
    )
    return [
        F.count("*").alias("total"),
        (F.count("*") - attacks).alias("normal"),
        attacks.alias("attacks"),
        critical.alias("critical"),
        F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("avg_confidence"),
        risk.alias("risk_level"),
    ]


def alert_summary(events: DataFrame) -> DataFrame:
    """One row of totals and the overall risk level; zeros for an empty table."""
    return events.agg(*summary_columns())


def summary_rows(events: DataFrame, digits: int = 4) -> DataFrame:
    """The summary as (metric, value) text rows."""
    wide = alert_summary(events).withColumn("avg_confidence", F.format_number("avg_confidence", digits))
    names = ["total", "normal", "attacks", "critical", "avg_confidence", "risk_level"]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("string").alias("value")) for n in names])))


def counts_by(events: DataFrame, column: str) -> DataFrame:
    """Events per value of one column (prediction, severity, ...)."""
    return events.groupBy(column).agg(F.count("*").alias("n_events"))


def attacks_by_type(events: DataFrame) -> DataFrame:
    return counts_by(events.filter(_ATTACK), "attack_type")


def histogram(events: DataFrame, column: str, bins: int, by: str = "prediction", low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Fixed-width bins on [low, high]; the top edge belongs to the last bin."""
    width = (high - low) / bins
    index = F.least(F.floor((F.col(column) - low) * bins / (high - low)), F.lit(bins - 1)).cast("int")
    inside = events.filter(F.col(column).between(low, high))
    counts = inside.groupBy(by, index.alias("bin")).agg(F.count("*").alias("n_events"))
    return counts.withColumn("bin_start", round_to(F.col("bin") * width + low, 6))


def top_actions(events: DataFrame, k: int = 8, width: int = 55) -> DataFrame:
    """Most frequent recommended actions, text shortened for display."""
    counts = counts_by(events, "recommended_action").orderBy(F.desc("n_events"), "recommended_action").limit(k)
    return counts.select(
        F.concat(F.substring("recommended_action", 1, width), F.lit("…")).alias("action"), "n_events")


def latest_attacks(events: DataFrame, order: str = "timestamp", k: int = 5, tie: str = "event_id") -> DataFrame:
    """The newest attack events, newest first; a top-k, not a sort."""
    return events.filter(_ATTACK).orderBy(F.desc(order), F.desc(tie)).limit(k)


def timeline(events: DataFrame, text: str = "timestamp") -> DataFrame:
    """Parsed event times with probability and decision; unparseable times are left out."""
    parsed = F.try_to_timestamp(F.col(text).cast("string"))
    return events.withColumn("ts", parsed).filter("ts is not null").select("ts", "binary_probability", "prediction")


def timeline_counts(events: DataFrame, time: str = "timestamp", width: str = "1 hour") -> DataFrame:
    """Events per time window and decision; streams add a watermark first."""
    return events.groupBy(F.window(time, width).alias("w"), "prediction").agg(
        F.count("*").alias("n_events"), F.avg("binary_probability").alias("avg_probability")
    ).select(F.col("w.start").alias("window_start"), "prediction", "n_events", "avg_probability")


def detail(events: DataFrame, event_id: str) -> DataFrame:
    """One event by key; the predicate reaches the scan."""
    return events.filter(F.col("event_id") == event_id)


def newest_per_key(events: DataFrame, key: str = "event_id", order: tuple[str, ...] = ("batch_seq", "record_index")) -> DataFrame:
    """Latest row per key. A grouped maximum combines map-side, so a hot key stays cheap; a row is its own order, so it is shuffled once."""
    best = events.groupBy(key).agg(F.max(F.struct(*order, *[c for c in events.columns if c not in (key, *order)])).alias("row"))
    return best.select(key, "row.*").select(*events.columns)

