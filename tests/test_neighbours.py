"""Nearest-neighbour mutual information against a direct reading of the estimator."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsieve.operators import feature_selection as fs
from flowsieve.operators import neighbours as nb


def psi(m):
    """Digamma of a whole number: the harmonic number before it less Euler's constant."""
    return sum(1 / j for j in range(1, int(m))) - 0.57721566490153286


def by_hand(rows, k=3):
    rows = [(x, y) for x, y in rows if x is not None and not math.isnan(x) and y is not None]
    sizes = {c: sum(y == c for _, y in rows) for c in {y for _, y in rows}}
    rows = [(x, y) for x, y in rows if sizes[y] > 1]
    if not rows:
        return None
    xs, ys = np.array([x for x, _ in rows]), np.array([y for _, y in rows])
    total = 0.0
    for i in range(len(xs)):
        far = np.sort(np.delete(np.abs(xs - xs[i])[ys == ys[i]], np.flatnonzero(np.flatnonzero(ys == ys[i]) == i)))
        wanted = min(k, len(far))
        r = far[wanted - 1]
        m = ((xs > xs[i] - r) & (xs < xs[i] + r)).sum() if r > 0 else (xs == xs[i]).sum()
        total += psi(wanted) - psi(sizes[ys[i]]) - psi(m)
    return max(0.0, psi(len(xs)) + total / len(xs))


def made(n, seed=4):
    """Values with many ties, with few, and missing ones; a class of one row and one of two."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = rng.choice([0, 0, 0, 1, 1, 2])
        tied = float(rng.randrange(12) + 3 * y)
        fine = rng.randrange(1 << 20) / 1024 + 100 * y
        rows.append((tied, fine if i % 9 else None, float("nan") if i % 50 == 0 else float(i % 4), y))
    return [*rows, (1.0, 5.0, 2.0, 7), (2.0, 5.5, 1.0, 8), (9.0, 900.25, 1.0, 8), (3.0, 1.0, 1.0, None)]


@pytest.mark.parametrize("ranges", ["1", "7"])
def test_equals_the_estimator_row_by_row(spark, ranges):
    rows = made(2000)
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the ranges apart, however small
    try:
        df = spark.createDataFrame(rows, "tied double, fine double, flat double, y int")
        got = {r.feature: r.mutual_information for r in nb.neighbour_information(df, ["tied", "fine", "flat"], "y").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for at, name in enumerate(("tied", "fine", "flat")):
        assert got[name] == pytest.approx(by_hand([(r[at], r[3]) for r in rows]), abs=1e-9)
    assert got["fine"] > 0.05 > got["flat"]


def test_neighbours_are_carried_over_several_ranges(spark):
    """Ranges of one or two rows: the k-th neighbour lies some ranges away."""
    rows = [(float(x), x % 2) for x in range(12)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "x double, y int")
        got = nb.neighbour_information(df, ["x"], "y").first().mutual_information
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == pytest.approx(by_hand(rows), abs=1e-9)


@pytest.mark.parametrize("rows_a_batch", [1, 2, 5, 64])
def test_a_range_is_read_in_small_pieces(spark, rows_a_batch, monkeypatch):
    """However few rows arrive together, neighbours are found, and no more than k rows wait or are kept around a batch."""
    rows = made(300, 9)
    seen = []
    plain = nb.kth_distance
    monkeypatch.setattr(nb, "kth_distance", lambda v, c, k: seen.append(len(v)) or plain(v, c, k))
    ranged = spark.createDataFrame([(0, "a", float(x), 1 + x % 2, 60, 0) for x in range(40)],
                                   "feature int, y string, v double, n long, of_class long, part int").coalesce(1)
    caught = {}
    monkeypatch.setattr(type(ranged), "mapInArrow", lambda df, run, schema: caught.update(run=run) or df)
    nb._radii(ranged, [], 3)
    monkeypatch.undo()
    monkeypatch.setattr(nb, "kth_distance", lambda v, c, k: seen.append(len(v)) or plain(v, c, k))
    whole = ranged.toArrow()
    got = [r for b in caught["run"](iter(whole.to_batches(max_chunksize=rows_a_batch))) for r in b.column("r").to_pylist()]
    v, n = np.arange(40.0), 1 + np.arange(40) % 2
    assert got == plain(v, n, np.full(40, 3)).tolist()
    assert max(seen) <= rows_a_batch + 6
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
    try:
        df = spark.createDataFrame(rows, "tied double, fine double, flat double, y int")
        found = nb.neighbour_information(df, ["fine"], "y").first().mutual_information
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == pytest.approx(by_hand([(r[1], r[3]) for r in rows]), abs=1e-9)


def test_text_classes_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (1.0, None, "a"), (5.0, None, "b"), (6.0, None, "b")], "x double, none double, y string")
    got = {r.feature: r.mutual_information for r in nb.neighbour_information(df, ["x", "none"], "y").collect()}
    assert got == {"x": pytest.approx(by_hand([(1.0, 0), (1.0, 0), (5.0, 1), (6.0, 1)]))}
    assert nb.neighbour_information(df.limit(0), ["x"], "y").collect() == []


def test_digamma(spark):
    got = spark.range(1, 200).select("id", nb.digamma(F.col("id")).alias("p")).collect()
    assert all(r.p == pytest.approx(psi(r.id), abs=1e-12) for r in got)


def test_selection_by_neighbours(spark):
    rng = random.Random(1)
    rows = [(rng.random() + y, rng.random(), y) for y in (0, 1) for _ in range(200)]
    df = spark.createDataFrame(rows, "good double, noise double, y int")
    assert fs.select_features(df, ["good", "noise"], "y", k=1, floor=0.0, method="neighbours").selected == ["good"]
    with pytest.raises(ValueError):
        fs.select_features(df, ["good"], "y", method="other")
