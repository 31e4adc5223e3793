"""Feature selection on the training split: variance, correlation, mutual information."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.functions.scalars import missing, round_to
from flowsieve.operators.exploration import correlations, variances
from flowsieve.operators.neighbours import neighbour_information
from flowsieve.operators.quantiles import exact_quantiles

# Fixed values
VARIANCE_FLOOR = 0.01
CORRELATION_CEILING = 0.95
TOP_K = 40
BINS = 10


def select_variance(train: DataFrame, columns: Sequence[str], floor: float = VARIANCE_FLOOR) -> DataFrame:
    """Population variance per column and whether it exceeds the floor."""
    return variances(train, columns, population=True).select(
        "feature", "variance", (F.col("variance") > floor).alias("keep"))


def select_correlation(train: DataFrame, columns: Sequence[str], ceiling: float = CORRELATION_CEILING) -> DataFrame:
    """A column goes when it correlates above the ceiling with any earlier column, kept or not."""
    strong = F.abs("r") > ceiling
    worst = correlations(train, columns).groupBy(F.col("feature_2").alias("feature")).agg(
        F.max(F.when(strong, F.abs("r"))).alias("max_r"))
    names = train.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(worst, "feature", "left").select("feature", F.col("max_r").isNull().alias("keep"))


def mutual_information(train: DataFrame, columns: Sequence[str], label: str = "label", bins: int = BINS) -> DataFrame:
    """Binned mutual information (nats) of each column with the label.

    Bin edges are exact quantiles, at most ``bins - 1`` numbers per column; one
    contingency aggregate covers all columns and collapses map-side.
    """
    probs = [i / bins for i in range(1, bins)]
    edges: dict[str, list[float]] = {c: [] for c in columns}
    for r in exact_quantiles(train, columns, probs).collect():
        edges[r["feature"]].append(r["value"])

    def bin_of(c: str):
        value = F.col(c).cast("double")
        index = sum(((value > e).cast("int") for e in edges[c]), F.lit(0))
        return F.when(~missing(train, c), index)

    cells = F.array(*[F.struct(F.lit(c).alias("feature"), bin_of(c).alias("bin")) for c in columns])
    joint = train.select(F.col(label).alias("y"), F.inline(cells)).filter("bin is not null").groupBy(
        "feature", "bin", "y").agg(F.count("*").cast("double").alias("n"))
    by_bin = joint.groupBy("feature", "bin").agg(F.sum("n").alias("n_bin"))
    by_label = joint.groupBy("feature", "y").agg(F.sum("n").alias("n_y"))
    total = joint.groupBy("feature").agg(F.sum("n").alias("n_all"))
    table = joint.join(by_bin, ["feature", "bin"]).join(by_label, ["feature", "y"]).join(total, "feature")
    share = F.col("n") / F.col("n_all")
    term = share * F.log(F.col("n") * F.col("n_all") / (F.col("n_bin") * F.col("n_y")))
    return table.groupBy("feature").agg(F.greatest(F.sum(term), F.lit(0.0)).alias("mutual_information"))


@dataclass
class Selection:
    """Which columns survived each step."""

    after_variance: list[str]
    after_correlation: list[str]
    selected: list[str]

    def project(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return df.select(*keep, *self.selected)


def _kept(rows: DataFrame, columns: Sequence[str]) -> list[str]:
    good = {r["feature"] for r in rows.filter("keep").select("feature").collect()}
    return [c for c in columns if c in good]


def select_features(
    train: DataFrame, columns: Sequence[str], label: str = "label", k: int | None = TOP_K,
    floor: float = VARIANCE_FLOOR, ceiling: float = CORRELATION_CEILING, bins: int = BINS, method: str = "bins",
) -> Selection:
    """Variance filter, then correlation filter, then top-k by mutual information, of ``bins`` or of nearest ``neighbours``."""
    if method not in ("bins", "neighbours"):
        raise ValueError(f"method must be 'bins' or 'neighbours', got {method!r}")
    varied = _kept(select_variance(train, columns, floor), columns)
    apart = _kept(select_correlation(train, varied, ceiling), varied) if len(varied) > 1 else varied
    if k is None or not apart:
        return Selection(varied, apart, apart)
    scores = mutual_information(train, apart, label, bins) if method == "bins" else neighbour_information(train, apart, label)
    ranked = scores.orderBy(
        F.desc(round_to("mutual_information", 9)), "feature").limit(min(k, len(apart)))
    best = {r["feature"] for r in ranked.collect()}
    return Selection(varied, apart, [c for c in apart if c in best])
