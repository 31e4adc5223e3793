"""Rendezvous sharding: each key goes to the shard with the least weighted hash score.

A new shard only takes rows into itself; no row moves between old shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import fresh, save

_BITS = 52
#: Rows of a slot group: small enough for any task, large enough to keep the table of group sizes small.
GROUP_ROWS = 512
#: Copies numbered at once when equal rows are expanded again.
COPIES = 10_000


def hash52(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts joined by colons; null counts as empty."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key: the least of -ln(u) / weight, u the hash of key and shard in (0, 1). Ties: the lower shard."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive, one for each shard")
    scores = [
        F.struct((-F.log((hash52(key, F.lit(i)) + 0.5) / float(1 << _BITS)) / float(w)).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    return F.array_min(F.array(*scores))["shard"]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] = ()) -> DataFrame:
    """Every row with ``shard`` and, where more weights are given, ``grown_shard`` under them as well.

    Rows with equal keys, a null key included, share a shard. Input columns
    named shard or grown_shard are replaced. No shuffle.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("shard", "grown_shard")]
    out = df.select(*keep, rendezvous(F.col(f"`{key}`"), weights).alias("shard"))
    more = rendezvous(F.col(f"`{key}`"), [*weights, *grown]) if grown else F.lit(None).cast("int")
    return out.withColumn("grown_shard", more)


def number_slots(df: DataFrame, order: Sequence[str], shards: int) -> DataFrame:
    """Every row with a ``slot``, gapless from 0 in its shard.

    Slots follow a hash of the order columns, then these columns. Rows equal in
    all columns are counted before the shuffle and expanded after it, so one row
    repeated without end fills no task. Each shard is cut into groups of about
    ``GROUP_ROWS`` rows; groups start where the sizes of earlier ones add up to.
    An empty frame stays empty. An input column named slot is replaced.
    """
    columns = [c for c in df.columns if c.lower() != "slot"]
    mix, group, copies, start, chunk = fresh(df, "mix", "group", "copies", "start", "chunk")
    groups = max(1, -(-df.count() // (shards * GROUP_ROWS)))
    unique = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias(copies))
    unique = unique.withColumn(mix, hash52(*[F.col(f"`{c}`") for c in order]))
    unique = save(unique.withColumn(group, F.floor(F.col(mix) / float(1 << _BITS) * groups)), "slots")
    earlier = Window.partitionBy("shard").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        unique.groupBy("shard", group).agg(F.sum(copies).alias(start))
        .select("shard", group, F.coalesce(F.sum(start).over(earlier), F.lit(0)).alias(start))
    )
    inside = (
        Window.partitionBy("shard", group).orderBy(mix, *[F.col(f"`{c}`") for c in order], *[F.col(f"`{c}`") for c in columns if c not in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = unique.withColumn("slot", F.coalesce(F.sum(copies).over(inside), F.lit(0))).join(starts, ["shard", group])
    placed = placed.withColumn("slot", F.col("slot") + F.col(start))
    # Two steps, so that no row builds an array longer than COPIES.
    placed = placed.withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / COPIES))))
    last = F.least(F.col(copies) - 1, F.col(chunk) * COPIES + COPIES - 1)
    placed = placed.withColumn(chunk, F.explode(F.sequence(F.col(chunk) * COPIES, last)))
    return placed.select(*[f"`{c}`" for c in columns], (F.col("slot") + F.col(chunk)).alias("slot"))
