"""Exploration: class balance, category drift, variance, description, correlation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.functions.scalars import literal_array, long_form, missing, percent, round_to
from flowsieve.functions.scale import tagged_counts
from flowsieve.operators.quantiles import exact_quantiles
from flowsieve.schemas import RARE_CATEGORIES

NOISE = 1e-10  # a deviation below this share of the mean is rounding noise: the column is constant


# ---- splits side by side ----------------------------------------------------


def target_compare(train: DataFrame, test: DataFrame, column: str = "attack_cat", digits: int = 3) -> DataFrame:
    """Counts and percentages per value in both splits; a value missing on one side counts zero.

    Percentages are of all rows, but rows without a value form no group.
    """
    counts = tagged_counts({"train": train, "test": test}, [column])
    totals = counts.agg(F.sum("n_train").alias("a"), F.sum("n_test").alias("b"))
    return counts.filter(F.col(column).isNotNull()).select(
        column,
        F.col("n_train").alias("train_count"),
        percent(F.col("n_train"), totals.select("a").scalar(), digits).alias("train_pct"),
        F.col("n_test").alias("test_count"),
        percent(F.col("n_test"), totals.select("b").scalar(), digits).alias("test_pct"),
    )


def binary_balance(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Normal and attack rows per split, percentages to two places."""
    return target_compare(train, test, label, 2)


def topk_compare(train: DataFrame, test: DataFrame, column: str, k: int = 8) -> DataFrame:
    """Train's k most frequent values with their counts in test."""
    counts = tagged_counts({"train": train, "test": test}, [column]).filter("n_train > 0")
    return counts.filter(F.col(column).isNotNull()).orderBy(F.desc("n_train"), column).limit(k).select(
        column, F.col("n_train").alias("train_count"), F.col("n_test").alias("test_count"))


def _long_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    return df.select(F.inline(pairs)).filter("value is not null")


def category_counts(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column and value: rows in train and in test."""
    frames = {"train": _long_categories(train, columns), "test": _long_categories(test, columns)}
    return tagged_counts(frames, ["column_name", "value"])


def domain_shift(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values found on one side only."""
    counts = category_counts(train, test, columns).filter("n_train = 0 or n_test = 0")
    side = F.when(F.col("n_train") == 0, "test_only").otherwise("train_only")
    return counts.select("column_name", "value", side.alias("side"), (F.col("n_train") + F.col("n_test")).alias("n_rows"))


def category_profile(train: DataFrame, test: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    """Distinct values and the most frequent ones, per column and split.

    The rank filter is pruned map-side to ``top`` rows per task and group.
    """
    counts = category_counts(train, test, columns)
    sides = counts.select("column_name", "value", F.inline(F.array(
        F.struct(F.lit("train").alias("split"), F.col("n_train").alias("n_rows")),
        F.struct(F.lit("test").alias("split"), F.col("n_test").alias("n_rows")),
    ))).filter("n_rows > 0")
    distinct = sides.groupBy("column_name", "split").agg(F.count("*").alias("n_distinct"))
    order = Window.partitionBy("column_name", "split").orderBy(F.desc("n_rows"), "value")
    best = sides.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(distinct, ["column_name", "split"]).select(
        "column_name", "split", "n_distinct", F.col("rank").cast("long").alias("rank"), "value", "n_rows")


def rare_classes(
    train: DataFrame, test: DataFrame, column: str = "attack_cat",
    names: Sequence[str] | None = tuple(RARE_CATEGORIES), below_pct: float = 2.0,
) -> DataFrame:
    """Counts, percentages, train/test ratio and priority tag of the listed classes.

    ``names=None`` takes every class; the tag marks those under ``below_pct`` of train.
    """
    rows = target_compare(train, test, column)
    share = F.try_divide(F.col("train_count") * 100.0, rows.agg(F.sum("train_count").cast("double")).scalar())
    tagged = rows.withColumns({
        "ratio_train_to_test": round_to(F.try_divide(F.col("train_count").cast("double"), F.col("test_count").cast("double")), 2),
        "priority": F.when(share < below_pct, "Rare").otherwise("Standard"),
    })
    return tagged if names is None else tagged.filter(F.col(column).isin(*names))


# ---- numeric columns --------------------------------------------------------


def _present(df: DataFrame, name: str) -> Column:
    return F.when(~missing(df, name), F.col(name).cast("double"))


def variances(df: DataFrame, columns: Sequence[str], population: bool = False) -> DataFrame:
    spread = F.var_pop if population else F.var_samp
    wide = df.agg(*[spread(_present(df, c)).alias(c) for c in columns])
    return long_form(wide, columns, "feature", "variance")


def variance_profile(df: DataFrame, columns: Sequence[str], k: int = 8, near_zero: float = 1e-4) -> DataFrame:
    """Lowest and highest sample variances, with near-zero ones flagged."""
    rows = variances(df, columns)
    low = rows.orderBy("variance", "feature").limit(k).select(
        F.lit("lowest").alias("side"), "feature", round_to("variance", 6).alias("variance"),
        (F.col("variance") < near_zero).alias("near_zero"))
    high = rows.orderBy(F.desc("variance"), "feature").limit(k).select(
        F.lit("highest").alias("side"), "feature", round_to("variance", 2).alias("variance"),
        (F.col("variance") < near_zero).alias("near_zero"))
    return low.unionByName(high)


def numeric_describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[
        F.struct(*[f(_present(df, c)).cast("double").alias(n) for n, f in stats.items()]).alias(c) for c in columns
    ])
    rows = long_form(wide, columns, "feature", "s").select(
        "feature", F.col("s.count").cast("long").alias("n_rows"), "s.mean", "s.std", "s.min", "s.max")
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("feature").agg(
        *[F.max(F.when(F.col("prob") == q, F.col("value"))).alias(n) for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return rows.join(quartiles, "feature", "left")


# ---- correlation ------------------------------------------------------------


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every column pair over the rows where both are present.

    One scan, at any number of columns: each task sums matrix products, with
    every value taken from the column's middle of the first batch, so that
    outliers in other pairs do not cost precision. Task sums are merged by
    their means. A pair with a column that is constant over its rows gives null.
    """
    k = len(columns)
    names = [f"v{i}" for i in range(k)]
    values = df.select(*[_present(df, c).alias(n) for c, n in zip(columns, names, strict=True)])
    parts = ("n", "mx", "my", "vx", "vy", "cxy")
    schema = "i int, j int, " + ", ".join(f"{c} double" for c in parts)

    def products(batches):
        i, j = np.triu_indices(k, 1)
        for batch in batches:
            x = batch.to_numpy(dtype="float64", na_value=np.nan)
            here = ~np.isnan(x)
            centre = np.array([np.median(x[here[:, c], c]) if here[:, c].any() else 0.0 for c in range(k)])
            z = np.where(here, x - centre, 0.0)
            mask = here.astype("float64")
            n = mask.T @ mask
            some = np.maximum(n, 1)
            mean = (z.T @ mask) / some  # of column i over the rows that column j shares with it
            spread = np.maximum((z * z).T @ mask - some * mean * mean, 0.0)
            cross = z.T @ z - some * mean * mean.T
            out = (n, mean + centre[:, None], mean.T + centre[None, :], spread, spread.T, cross)
            yield pd.DataFrame({"i": i, "j": j, **{c: v[i, j] for c, v in zip(parts, out, strict=True)}})

    sums = values.mapInPandas(products, schema)
    pair = Window.partitionBy("i", "j")
    total = F.sum("n").over(pair)
    centred = sums.withColumns({"gx": F.try_divide(F.sum(F.col("n") * F.col("mx")).over(pair), total), "gy": F.try_divide(F.sum(F.col("n") * F.col("my")).over(pair), total)})
    dx, dy, n = F.col("mx") - F.col("gx"), F.col("my") - F.col("gy"), F.col("n")
    merged = centred.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.first("gx").alias("gx"), F.first("gy").alias("gy"), F.sum(F.col("vx") + n * dx * dx).alias("vx"),
        F.sum(F.col("vy") + n * dy * dy).alias("vy"), F.sum(F.col("cxy") + n * dx * dy).alias("cxy"))
    moves = [F.sqrt(F.try_divide(F.col(v), F.col("n"))) > F.abs(F.col(m)) * NOISE for v, m in (("vx", "gx"), ("vy", "gy"))]
    label = literal_array(columns)
    return merged.select(
        "i", "j", F.element_at(label, F.col("i") + 1).alias("feature_1"), F.element_at(label, F.col("j") + 1).alias("feature_2"),
        F.when(moves[0] & moves[1], F.col("cxy") / F.sqrt(F.col("vx") * F.col("vy"))).alias("r"))


def corr_pairs(df: DataFrame, columns: Sequence[str], threshold: float = 0.90) -> DataFrame:
    """Pairs with absolute correlation at or above the threshold, strongest first."""
    strong = correlations(df, columns).filter(F.abs("r") >= threshold)
    shown = strong.select("feature_1", "feature_2", round_to("r", 4).alias("correlation"))
    return shown.orderBy(F.desc(F.abs("correlation")), "feature_1", "feature_2")


def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """The full matrix in long form; both triangles come from the same pass."""
    upper = correlations(df, columns).select("feature_1", "feature_2", round_to("r", digits).alias("correlation"))
    lower = F.struct(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2"), "correlation")
    same = F.struct("feature_1", "feature_2", "correlation")
    spans = df.agg(*[(F.min(_present(df, c)) < F.max(_present(df, c))).alias(c) for c in columns])
    diagonal = long_form(spans, columns, "feature_1", "moves").select(
        "feature_1", F.col("feature_1").alias("feature_2"), F.when(F.col("moves"), F.lit(1.0)).alias("correlation"))
    return upper.select(F.inline(F.array(same, lower))).unionByName(diagonal)
