"""Distribution helpers: ordered sums, row numbers, hot keys, size-checked broadcast.

Nothing here moves an unbounded group into one task. Steps that must agree
with each other across jobs read a reliable checkpoint, so a lost executor
cannot change a partitioning between the two reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.session import checkpoint_root, scratch_path

BROADCAST_ROWS = 100_000


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """As :func:`materialize`, in a compressed table under the scratch folder: for wide frames that grow with the input.

    A checkpoint holds every column uncompressed; of a table, later steps read the columns they use.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table that a frame keeps as ``stored_at``, as those of :func:`stored` and :func:`global_row_number`, once nothing reads it any more."""
    place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a frame after counting it; a larger one stays a shuffle join.

    The frame is checkpointed first so that counting it does not compute it twice.
    """
    fixed = materialize(df)
    return F.broadcast(fixed) if fixed.count() <= rows else fixed


def running_totals(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    """Inclusive running sums per group over a global order, as ``cum_<value>``.

    ``df`` holds one row per (group, order key). Rows are range-partitioned, so
    a group of any size spreads over many tasks; each range gets the totals of
    the ranges before it.
    """
    groups, values = list(groups), list(values)
    ranged = materialize(
        df.repartitionByRange(*[F.col(g) for g in groups], *order)
        .withColumn("_range", F.spark_partition_id())
    )
    keys = [*groups, "_range"]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = (
        Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        ranged.groupBy(*keys)
        .agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
        .select(*keys, *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_off_{v}") for v in values])
    )
    # The window and the join share one hash partitioning on (group, range).
    partial = ranged.select("*", *[F.sum(v).over(inside).alias(f"_in_{v}") for v in values])
    joined = partial.join(offsets, keys)
    return joined.select(
        *df.columns, *[(F.col(f"_in_{v}") + F.col(f"_off_{v}")).alias(f"cum_{v}") for v in values]
    )


def global_row_number(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Consecutive row numbers in a total order, without a one-task window.

    Rows with equal order keys follow the hash of their content, so the numbers
    do not depend on the partitioning; only equal rows are interchangeable. A
    random last range key spreads those over several ranges; it is fixed in a
    stored table first, so a retried task sends a row the same way.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    keys = [*order, F.col("_content"), F.col("_salt")]
    salted = stored(df.withColumns({"_content": content, "_salt": F.rand(7)}), "unnumbered")
    ranged = stored(
        salted
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_salt", "_content")
        .withColumn("_at", F.monotonically_increasing_id()), "ranged",
    )
    discard(salted)
    numbered = ranged.withColumn("_range", F.shiftright("_at", 33))
    sizes = numbered.groupBy("_range").count()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so the window and the broadcast are both tiny.
    offsets = sizes.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    out = (
        numbered.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_offset") + position + start)
        .drop("_range", "_at", "_offset")
    )
    out.stored_at = ranged.stored_at
    return out


def tagged_counts(frames: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of several frames counted per key in one null-safe shuffle.

    Gives ``n_<tag>`` for each frame. Partial aggregation collapses hot keys
    before the shuffle, which a join on the same keys would not do.
    """
    stacked = None
    for tag, frame in frames.items():
        part = frame.select(*keys, F.lit(tag).alias("_tag"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(*keys).agg(
        *[F.count_if(F.col("_tag") == tag).alias(f"n_{tag}") for tag in frames]
    )


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def semi_join_skew_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot_share: float = 0.001
) -> DataFrame:
    """Null-safe left semi join that survives hot keys on the left.

    Keys holding at least ``hot_share`` of the left rows number at most
    ``1/hot_share``, so their matches are broadcast; the rest are shuffled.
    """
    keys = list(keys)
    floor = left.count() * hot_share
    is_hot = F.col("n_left") >= floor
    matched = F.col("n_right") > 0
    counts = materialize(
        tagged_counts({"left": left, "right": right}, keys)
        .filter("n_left > 0").filter(is_hot | matched)
    )
    cold = counts.filter(~is_hot).select(*keys)
    if counts.filter(is_hot).isEmpty():
        return left.join(cold, null_safe(left, cold, keys), "left_semi")
    hot = F.broadcast(counts.filter(is_hot).select(*keys))
    hot_matches = F.broadcast(counts.filter(is_hot & matched).select(*keys))
    hot_rows = left.join(hot_matches, null_safe(left, hot_matches, keys), "left_semi")
    cold_rows = left.join(hot, null_safe(left, hot, keys), "left_anti")
    return hot_rows.unionByName(cold_rows.join(cold, null_safe(cold_rows, cold, keys), "left_semi"))
