"""Feature transforms fitted on the training split only.

Fitted state is a handful of numbers per column plus category lists, so
:func:`fit_features` yields an ordinary Spark ML ``PipelineModel`` that saves,
loads and transforms like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.functions.scalars import class_index, missing, numeric_columns, round_to, string_columns
from flowsieve.functions.scale import broadcast_if_small, materialize
from flowsieve.operators.exploration import NOISE
from flowsieve.operators.quantiles import approximate_median, exact_median
from flowsieve.schemas import NON_FEATURES

MAX_CATEGORIES = 100_000


def feature_types(train: DataFrame, exclude: Sequence[str] = tuple(NON_FEATURES)) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature columns, decided on the training schema alone."""
    return numeric_columns(train, exclude), string_columns(train, exclude)


def downcast(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Double to float, to halve storage."""
    return df.withColumns({c: F.col(c).cast("float") for c in columns})


# ---- fitted parameters ------------------------------------------------------


def medians(train: DataFrame, columns: Sequence[str], approx: bool = False) -> dict[str, float]:
    return approximate_median(train, columns) if approx else exact_median(train, columns)


def value_table(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (feature, value) of the categorical columns: one scan serves modes and categories."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    return train.select(F.inline(pairs)).filter("value is not null").groupBy("feature", "value").agg(F.count("*").alias("n"))


def modes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the smallest on ties, as rows (feature, value)."""
    return _modes(value_table(train, columns))


def _modes(counts: DataFrame) -> DataFrame:
    return counts.groupBy("feature").agg(F.min_by("value", F.struct((-F.col("n")).alias("a"), "value")).alias("value"))


def moments(train: DataFrame, columns: Sequence[str], fill: Mapping[str, float] | None = None) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column after imputation; zero deviation becomes one."""
    fill = fill or {}

    def value(c: str) -> Column:
        present = F.when(~missing(train, c), F.col(c).cast("double"))
        return F.coalesce(present, F.lit(fill[c])) if c in fill else present

    row = train.agg(*[f(value(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    found = {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(columns)}
    # A deviation that is only rounding noise counts as zero.
    return {c: (m, s if s > abs(m) * NOISE else 1.0) for c, (m, s) in found.items()}


def categories(train: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct values per column. Encodings are driver-side, so the count is checked first."""
    return _categories(value_table(train, columns), columns, limit)


def _categories(counts: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    rows = counts.select("feature", "value").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories to encode; hash or group the column first")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        found[r["feature"]].append(r["value"])
    return {c: sorted(v) for c, v in found.items()}


# ---- column transforms ------------------------------------------------------


def impute(df: DataFrame, fill: Mapping[str, float | str]) -> DataFrame:
    """Replace null (and NaN) by the fitted value."""
    return df.withColumns({
        c: F.when(missing(df, c), F.lit(v)).otherwise(F.col(c)).alias(c) for c, v in fill.items() if c in df.columns
    })


def standardize(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in fitted.items()})


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """0/1 columns ``column_value`` in sorted value order; an unseen value sets none."""
    hits = [F.coalesce(F.col(column) == v, F.lit(False)).cast("int").alias(f"{column}_{v}") for v in values]
    return df.select("*", *hits)


def label_encode(df: DataFrame, column: str, classes: Sequence[str], out: str = "y", strict: bool = True) -> DataFrame:
    """Alphabetical class index. In strict mode an unseen label stops the job."""
    ordered = sorted(classes)
    index = class_index(F.col(column), ordered)
    if strict:
        message = F.concat(F.lit("unseen label: "), F.coalesce(F.col(column), F.lit("null")))
        index = F.coalesce(index, F.raise_error(message).cast("int"))
    return df.withColumn(out, index)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class, ``n / (k * n_class)``."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_class"))
    totals = counts.agg(F.sum("n_class").cast("double").alias("n"), F.count("*").alias("k"))
    weight = totals.select("n").scalar() / (totals.select("k").scalar() * F.col("n_class"))
    return counts.withColumn("weight", weight)


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = broadcast_if_small(class_weights(df.select(label), label).select(label, F.col("weight").alias(out)))
    return df.join(weights, label)


def pos_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Negatives per positive, 1.0 without positives."""
    neg, pos = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    share = F.coalesce(F.try_divide(neg.cast("double"), pos.cast("double")), F.lit(1.0))
    return df.agg(neg.alias("n_negative"), pos.alias("n_positive"), round_to(share, 5).alias("pos_weight"))


# ---- the whole feature pipeline --------------------------------------------


@dataclass
class FittedFeatures:
    """A fitted feature pipeline and the names of its output positions."""

    model: PipelineModel
    names: list[str]
    numeric: list[str]
    categorical: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``f_raw`` and ``f_scaled`` vectors; rows and other columns are kept."""
        extra = set(self.model_columns) - set(df.columns)
        return self.model.transform(df).drop(*extra)

    @property
    def model_columns(self) -> list[str]:
        per_numeric = [f"{c}__{s}" for c in self.numeric for s in ("imputed", "scaled")]
        per_category = [f"{c}__{s}" for c in self.categorical for s in ("imputed", "index", "hot")]
        return per_numeric + per_category


def _literal(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_features(
    train: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None,
    exclude: Sequence[str] = tuple(NON_FEATURES), approx: bool = False,
) -> FittedFeatures:
    """Fit imputation, scaling and one-hot encoding on the training split.

    One fit serves both variants: the raw and the scaled vector share the
    imputed columns and the encoded block.
    """
    found_numeric, found_categorical = feature_types(train, exclude)
    numeric = list(numeric if numeric is not None else found_numeric)
    categorical = list(categorical if categorical is not None else found_categorical)
    fill = {c: 0.0 for c in numeric} | medians(train, numeric, approx) if numeric else {}
    scale = moments(train, numeric, fill) if numeric else {}
    counts = materialize(value_table(train, categorical)) if categorical else None
    common = {r["feature"]: r["value"] for r in _modes(counts).collect()} if categorical else {}

    imputed = [
        f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {_literal(fill[c])}) AS `{c}__imputed`" for c in numeric
    ] + [f"coalesce(`{c}`, {_quoted(common.get(c, ''))}) AS `{c}__imputed`" for c in categorical]
    scaled = [f"(`{c}__imputed` - {_literal(m)}) / {_literal(s)} AS `{c}__scaled`" for c, (m, s) in scale.items()]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(imputed)} FROM __THIS__")]
    if scaled:
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__"))
    names = list(numeric)
    hot = [f"{c}__hot" for c in categorical]
    if categorical:
        values = _categories(counts, categorical)
        for c in categorical:
            values[c] = values[c] or [common.get(c, "")]
        indexers = [
            StringIndexerModel.from_labels(
                values[c], inputCol=f"{c}__imputed", outputCol=f"{c}__index", handleInvalid="keep")
            for c in categorical
        ]
        encoder = OneHotEncoder(inputCols=[f"{c}__index" for c in categorical], outputCols=hot, dropLast=True)
        stages += [*indexers, encoder]
        names += [f"{c}_{v}" for c in categorical for v in values[c]]
    stages.append(VectorAssembler(inputCols=[f"{c}__imputed" for c in numeric] + hot, outputCol="f_raw"))
    stages.append(VectorAssembler(inputCols=[f"{c}__scaled" for c in numeric] + hot, outputCol="f_scaled"))
    return FittedFeatures(Pipeline(stages=stages).fit(train), names, numeric, categorical)


def feature_names_frame(fitted: FittedFeatures, spark) -> DataFrame:
    schema = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("feature", T.StringType())])
    return spark.createDataFrame(list(enumerate(fitted.names)), schema)
