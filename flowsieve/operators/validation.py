"""Row validation as data: each rule adds a reason, rows split into good and rejected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.functions.scalars import round_to, strip_text
from flowsieve.schemas import CATEGORICAL_FEATURES, FORBIDDEN_FIELDS, NUMERIC_FEATURES, OUTPUT_FIELDS

REASONS = "reject_reasons"


def reasons(rules: Mapping[str, Column]) -> Column:
    """Array of the names of the rules a row breaks; a null condition is no breach."""
    return F.array_compact(F.array(*[
        F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()
    ]))


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Fail at plan time when a required feature column is absent."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing {len(absent)} required feature(s): {absent}")


def strip_ground_truth(df: DataFrame, required: Sequence[str] = (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES),
                       keep: Sequence[str] = ()) -> DataFrame:
    """Only the model's input columns (and bookkeeping keys); never a target column."""
    require_columns(df, required)
    kept = [c for c in keep if c not in required and c not in FORBIDDEN_FIELDS]
    return df.select(*kept, *required)


def validate_rows(df: DataFrame, numeric: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Reasons for text values that are not numbers; null and empty text pass as missing.

    ``required`` columns that are null mark a record without that feature,
    which is how a JSON stream shows an absent field.
    """
    rules = {f"missing:{c}": F.col(c).isNull() for c in required}
    for c in numeric:
        text = F.col(c).cast("string")
        rules[f"not_numeric:{c}"] = text.isNotNull() & (text != "") & text.try_cast("double").isNull()
    return df.withColumn(REASONS, reasons(rules))


def as_numbers(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Validated text to double; empty text becomes null."""
    return df.withColumns({c: F.nullif(F.col(c).cast("string"), F.lit("")).try_cast("double") for c in numeric})


def checked_numbers(df: DataFrame, numeric: Sequence[str], on_error: str = "fail") -> DataFrame:
    """Records with text in numeric columns validated, filtered by the policy and turned into numbers.

    Columns that are numbers already cost nothing.
    """
    text = [c for c in numeric if df.schema[c].dataType.typeName() == "string"]
    return as_numbers(apply_policy(validate_rows(df, text), on_error), text) if text else df


def validate_domain(
    df: DataFrame, ports: Sequence[str] = ("sport", "dsport"),
    non_negative: Sequence[str] = ("dur", "sbytes", "dbytes", "spkts", "dpkts"),
    label: str = "label", proto: str = "proto",
    required: Sequence[str] = ("proto", "dur", "sbytes", "dbytes", "spkts", "dpkts"),
) -> DataFrame:
    """Flow-record domain rules; the protocol is lower-cased and stripped of all blanks.

    A null in a required column that the table has is a breach.
    """
    rules = {f"missing:{c}": F.col(c).isNull() for c in required if c in df.columns}
    rules |= {f"port:{c}": ~F.col(c).between(0, 65535) for c in ports if c in df.columns}
    rules |= {f"negative:{c}": F.col(c) < 0 for c in non_negative if c in df.columns}
    if label in df.columns:
        rules[f"label:{label}"] = ~F.col(label).between(0, 1)
    out = df.withColumn(REASONS, reasons(rules))
    return out.withColumn(proto, F.lower(strip_text(F.col(proto)))) if proto in df.columns else out


def validate_probabilities(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Round probability columns, then flag values outside [0, 1]."""
    rounded = df.withColumns({c: round_to(F.col(c), digits) for c in columns})
    return rounded.withColumn(REASONS, reasons({f"range:{c}": ~F.col(c).between(0.0, 1.0) for c in columns}))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size(REASONS) == 0).drop(REASONS)


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size(REASONS) > 0)


def apply_policy(validated: DataFrame, on_error: str = "fail") -> DataFrame:
    """``"fail"`` stops the job at the first bad row; ``"quarantine"`` keeps good rows only."""
    if on_error == "quarantine":
        return accepted(validated)
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'quarantine', got {on_error!r}")
    message = F.concat(F.lit("invalid record: "), F.array_join(REASONS, ", "))
    guard = F.when(F.size(REASONS) == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return validated.filter(guard).drop(REASONS)


def quarantine_counts(validated: DataFrame) -> DataFrame:
    """Rows per reject reason."""
    return validated.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))


def attack_only(df: DataFrame, label: str = "label", category: str = "attack_cat", normal: str = "Normal") -> DataFrame:
    """Attack rows; a normal category among them stops the job."""
    clean = F.when(F.col(category) == normal, F.raise_error(F.lit("normal row labelled as attack")).cast("boolean"))
    return df.filter(F.col(label) == 1).filter(F.coalesce(clean, F.lit(True)))


def output_projection(events: DataFrame, fields: Sequence[str] = tuple(OUTPUT_FIELDS)) -> DataFrame:
    """The closed, ordered output schema; a ground-truth name is an error."""
    leaked = sorted(set(fields) & set(FORBIDDEN_FIELDS))
    if leaked:
        raise RuntimeError(f"forbidden ground-truth fields in output: {leaked}")
    require_columns(events, fields)
    return events.select(*fields)


def display_projection(events: DataFrame, fields: Sequence[str] = tuple(OUTPUT_FIELDS)) -> DataFrame:
    """Known output fields that exist, in order; anything else is dropped."""
    return events.select(*[c for c in fields if c in events.columns and c not in FORBIDDEN_FIELDS])
