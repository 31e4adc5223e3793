"""Nearest-neighbour mutual information of continuous columns with a class.

For a row with value x of class y, r is the distance to the k-th nearest other
row of its class, and m the number of rows of any class nearer than r. With the
digamma function, MI = psi(n) + mean psi(k) - mean psi(size of the class) - mean psi(m).
All columns go through one order: equal values are counted first, the counts are
range-partitioned, and each range gets the neighbours that lie beyond its edges.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.functions.scalars import missing
from flowsieve.functions.scale import materialize, running_totals

NEIGHBOURS = 3


def digamma(m: Column) -> Column:
    """The digamma function of a positive count: ten steps up, then its asymptotic series (error below 1e-12)."""
    x = m.cast("double") + 10
    steps = sum((1 / (m.cast("double") + j) for j in range(10)), F.lit(0.0))
    y = 1 / (x * x)
    return F.log(x) - 1 / (2 * x) - y * (F.lit(1 / 12) - y * (F.lit(1 / 120) - y * (F.lit(1 / 252) - y * F.lit(1 / 240)))) - steps


def _value_counts(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(feature, y, v, n) of the values that are present, classes of one row left out. Counted map-side."""
    cells = F.array(*[
        F.struct(F.lit(i).alias("feature"), F.when(~missing(df, c), F.col(c).cast("double")).alias("v")) for i, c in enumerate(columns)
    ])
    long = df.select(F.col(label).alias("y"), F.inline(cells)).filter("v is not null AND y is not null")
    counts = long.groupBy("feature", "y", "v").agg(F.count("*").alias("n"))
    # 0.0 and -0.0 are one value.
    counts = counts.withColumn("v", F.col("v") + 0.0)
    sizes = counts.groupBy("feature", "y").agg(F.sum("n").alias("of_class")).filter("of_class > 1")
    return counts.join(sizes, ["feature", "y"])


def _edges(ranged: DataFrame, k: int) -> DataFrame:
    """Per range and class its first and last k values: at most 2 k rows for each range and for each class."""
    keys = ["part", "feature", "y"]
    up, down = Window.partitionBy(*keys).orderBy("v"), Window.partitionBy(*keys).orderBy(F.desc("v"))
    ends = ranged.withColumns({"i": F.row_number().over(up), "j": F.row_number().over(down)})
    return ends.filter((F.col("i") <= k) | (F.col("j") <= k)).select(*keys, "v", "n")


def kth_distance(values: np.ndarray, counts: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Distance from each distinct value (ascending, with its number) to the k-th other one, equal values being at zero."""
    spread = int(k.max()) if len(k) else 0
    out = np.zeros(len(values))
    need = k - (counts - 1)  # still wanted beyond the value itself
    open_ = need > 0
    low, high = np.arange(len(values)) - 1, np.arange(len(values)) + 1
    for _ in range(spread):
        at = np.flatnonzero(open_)
        if not len(at):
            break
        left = np.where(low[at] >= 0, values[at] - values[np.maximum(low[at], 0)], np.inf)
        right = np.where(high[at] < len(values), values[np.minimum(high[at], len(values) - 1)] - values[at], np.inf)
        take = left <= right
        out[at] = np.where(take, left, right)
        need[at] -= np.where(take, counts[np.maximum(low[at], 0)], counts[np.minimum(high[at], len(values) - 1)])
        low[at], high[at] = np.where(take, low[at] - 1, low[at]), np.where(take, high[at], high[at] + 1)
        open_ = need > 0
    return out


def _radii(ranged: DataFrame, edges: list, k: int) -> DataFrame:
    """Adds ``r`` and ``k`` (at most the class without the row itself) to every (feature, y, v), range by range."""
    by_class: dict[tuple, list[tuple]] = {}
    for part, feature, y, v, n in edges:
        by_class.setdefault((feature, y), []).append((part, v, n))
    for rows in by_class.values():
        rows.sort()
    shipped = ranged.sparkSession.sparkContext.broadcast(by_class)
    names = ["feature", "y", "v", "n", "of_class"]
    kinds = ", ".join(f"{c} {ranged.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A range is never held whole: rows whose k next ones are not here yet wait, and k before them are kept.
        held, done = None, 0
        for b in itertools.chain(batches, [None]):
            if b is not None and not b.num_rows:
                continue
            rows = [held, *([pa.Table.from_batches([b])] if b is not None else [])]
            rows = [t for t in rows if t is not None]
            if not rows:
                return
            held = pa.concat_tables(rows).combine_chunks()
            ready = held.num_rows - (k if b is not None else 0)
            if ready <= done:
                continue
            feature, y = held["feature"].to_numpy(), np.array(held["y"].to_pylist(), object)
            v, n, size, part = (held[c].to_numpy() for c in ("v", "n", "of_class", "part"))
            new = np.flatnonzero((feature[1:] != feature[:-1]) | (y[1:] != y[:-1])) + 1
            r, wanted = np.zeros(len(v)), np.minimum(k, size - 1)
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(v)], strict=True):
                if hi <= done or lo >= ready:
                    continue
                # Neighbours in other ranges: the last k before this one and the first k behind it. Those of rows
                # that are still to come from this range are among the k held back.
                around = shipped.value.get((int(feature[lo]), y[lo]), [])
                before = [(x, c) for p, x, c in around if p < part[lo]][-k:]
                behind = [(x, c) for p, x, c in around if p > part[lo]][:k]
                first = lo == 0 and done > 0  # values before are held: k of them, or all there are
                before = before if not first or done < k else []
                values = np.array([*(x for x, _ in before), *v[lo:hi], *(x for x, _ in behind)])
                counts = np.array([*(c for _, c in before), *n[lo:hi], *(c for _, c in behind)])
                inside = slice(len(before), len(before) + hi - lo)
                r[lo:hi] = kth_distance(values, counts, np.full(len(values), wanted[lo]))[inside]
            out = held.slice(done, ready - done).combine_chunks()
            here = slice(done, ready)
            yield from pa.table([*(out[c] for c in names), pa.array(r[here]), pa.array(wanted[here])], names=[*names, "r", "k"]).to_batches()
            kept = max(0, ready - k)
            held, done = held.slice(kept), ready - kept

    return ranged.mapInArrow(run, f"{kinds}, r double, k long")


def neighbour_information(df: DataFrame, columns: Sequence[str], label: str, k: int = NEIGHBOURS) -> DataFrame:
    """(feature, mutual_information) in nats by the k nearest neighbours of each row in its class; not below zero.

    Missing values and rows without a class take no part; a class of one row
    of a column neither. Where k equal values of a class exist, r is zero and m
    counts the equal values. Rows at r itself are not counted, so ties at the k-th place are left out together.
    """
    counts = _value_counts(df, columns, label)
    ranged = counts.repartitionByRange("feature", "y", "v").sortWithinPartitions("feature", "y", "v")
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()))
    edges = [tuple(r) for r in _edges(ranged, k).collect()]  # a few rows for each range and class
    points = materialize(_radii(ranged, edges, k))
    # Ranks of both ends of each row's interval, in one order with the values: a value counts below an end if it is
    # less, and for an interval of no width if it is equal.
    inside = points.withColumns({"low": F.col("v") - F.col("r"), "high": F.col("v") + F.col("r")})
    flat = F.col("r") == 0
    marks = inside.select("feature", "y", "v", F.inline(F.array(
        F.struct(F.col("v").alias("x"), F.lit(1).alias("turn"), F.col("n").alias("n"), F.lit(0).alias("sign")),
        F.struct(F.col("high").alias("x"), F.when(flat, 2).otherwise(0).alias("turn"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("sign")),
        F.struct(F.col("low").alias("x"), F.when(flat, 0).otherwise(2).alias("turn"), F.lit(0).cast("long").alias("n"), F.lit(-1).alias("sign")),
    )))
    ranks = running_totals(marks, ["feature"], [F.col("x"), F.col("turn"), F.col("sign"), F.col("y"), F.col("v")], ["n"])
    within = ranks.filter("sign <> 0").groupBy("feature", "y", "v").agg(F.sum(F.col("sign") * F.col("cum_n")).alias("m"))
    both = points.join(within, ["feature", "y", "v"])
    weight = F.col("n").cast("double")
    sums = both.groupBy("feature").agg(
        F.sum("n").alias("rows"),
        F.sum(weight * (digamma(F.col("k")) - digamma(F.col("of_class")) - digamma(F.col("m")))).alias("total"),
    )
    names = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (i, c)])
    value = digamma(F.col("rows")) + F.col("total") / F.col("rows")
    return sums.select(names[F.col("feature")].alias("feature"), F.greatest(value, F.lit(0.0)).alias("mutual_information"))
