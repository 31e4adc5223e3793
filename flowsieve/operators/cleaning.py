"""Quality cleaning. Every step is a projection: no row is ever dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.functions.scalars import finite_or_null, floating_columns, string_columns, strip_text
from flowsieve.schemas import NORMAL, NON_FEATURES

CORRECT_NAME, ALIAS_NAME = "Backdoor", "Backdoors"


def feature_columns(df: DataFrame, non_features: Sequence[str] = tuple(NON_FEATURES)) -> list[str]:
    return [c for c in df.columns if c not in non_features]


def project_features(df: DataFrame, non_features: Sequence[str] = tuple(NON_FEATURES)) -> DataFrame:
    """All columns but identifier and targets, order kept."""
    return df.select(*feature_columns(df, non_features))


def clean_infinities(df: DataFrame) -> DataFrame:
    """Infinite and NaN values of floating columns become null."""
    return df.withColumns({c: finite_or_null(F.col(c)) for c in floating_columns(df)})


def clean_strings(df: DataFrame, label: str = "label", null_token: str | None = None) -> DataFrame:
    """Strip text columns. ``null_token`` writes missing text as that literal instead of null."""
    def cleaned(name: str) -> Column:
        value = strip_text(F.col(name))
        return value if null_token is None else F.coalesce(value, F.lit(null_token))

    return df.withColumns({c: cleaned(c) for c in string_columns(df, exclude=[label])})


def parsed_label(df: DataFrame, label: str = "label") -> Column:
    """The label as 0 or 1; null when it is anything else."""
    if isinstance(df.schema[label].dataType, T.BooleanType):
        return F.col(label).cast("int")
    value = F.trim(F.col(label).cast("string")).try_cast("double")
    return F.when(value.isin(0.0, 1.0), value.cast("int"))


def label_violations(df: DataFrame, label: str = "label") -> DataFrame:
    """Counts of valid and invalid labels, without failing."""
    valid = parsed_label(df, label)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(valid == 0).alias("n_normal"),
        F.count_if(valid == 1).alias("n_attack"),
        F.count_if(valid.isNull()).alias("n_invalid"),
    )


def clean_label(df: DataFrame, label: str = "label") -> DataFrame:
    """Label to int; the job fails on the first value outside {0, 1}."""
    message = F.concat(F.lit("unexpected label: "), F.coalesce(F.col(label).cast("string"), F.lit("null")))
    valid = parsed_label(df, label)
    return df.withColumn(label, F.coalesce(valid, F.raise_error(message).cast("int")))


def clean_category(df: DataFrame, label: str = "label", category: str = "attack_cat", normal: str = NORMAL) -> DataFrame:
    """Rows labelled normal carry the normal category."""
    return df.withColumn(category, F.when(F.col(label) == 0, normal).otherwise(F.col(category)))


def rename_alias(
    df: DataFrame, category: str = "attack_cat", alias: str = ALIAS_NAME, correct: str = CORRECT_NAME,
    by: str | None = None,
) -> DataFrame:
    """Replace the alias by the correct name, in tables that lack the correct name.

    With ``by`` the rule is decided per split of a combined table. The decision
    is a scalar subquery: one small aggregate, no join.
    """
    has_correct = F.coalesce(F.bool_or(F.col(category) == correct), F.lit(False))
    if by is None:
        present = F.coalesce(df.agg(has_correct).scalar(), F.lit(False))
    else:
        flags = df.groupBy(by).agg(has_correct.alias("_has"))
        table = flags.agg(F.map_from_entries(F.collect_list(F.struct(by, "_has"))))
        present = F.coalesce(F.try_element_at(table.scalar(), F.col(by)), F.lit(False))
    return df.withColumn(
        category, F.when((F.col(category) == alias) & ~present, correct).otherwise(F.col(category))
    )


def clean_split(
    df: DataFrame, label: str = "label", category: str = "attack_cat", by: str | None = None,
    null_token: str | None = None,
) -> DataFrame:
    """The whole cleaning step."""
    out = clean_infinities(df)
    if label in df.columns:
        out = clean_label(out, label)
    out = clean_strings(out, label, null_token)
    if category in df.columns:
        if label in df.columns:
            out = clean_category(out, label, category)
        out = rename_alias(out, category, by=by)
    return out


def row_guard(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts on both sides of a step and whether they agree."""
    rows = before.agg(F.count("*").alias("rows_in")).withColumn("rows_out", after.agg(F.count("*")).scalar())
    return rows.withColumn("preserved", F.col("rows_in") == F.col("rows_out"))


def require_same_rows(rows_in: int, rows_out: int) -> None:
    if rows_in != rows_out:
        raise RuntimeError(f"row count changed during cleaning: {rows_in} in, {rows_out} out")
