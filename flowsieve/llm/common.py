"""Helpers shared by the corpus operators: words, scratch tables, frequent items, column names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.session import scratch_path

# The six ASCII blanks. ``bytes.split()`` and ``bytes.strip()`` use exactly this set.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Cuts lineage, survives lost executors, and gives the planner true sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables made by :func:`save` that nothing reads any more, such as those of a round once the next is written."""
    for df in frames:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.saved_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of the frame has, compared as Spark compares them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an expression once, so a lambda that uses it does not compute it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each hold some ``size`` bytes, or are one longer text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths.astype(np.int64)) // size
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)


def frequent(counts: DataFrame, value: str, most: int) -> DataFrame:
    """Rows whose count reaches the lowest level at which at most ``most`` rows remain.

    Levels are eighths of a power of two. Only the level histogram, of at most
    some 500 rows, comes to the driver; ties are never split.
    """
    level = F.floor(F.log2(F.col(value).cast("double")) * 8)
    sizes = dict(counts.filter(F.col(value) > 0).groupBy(level.alias("level")).count().collect())
    lowest, total = None, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        lowest = at
    return counts.filter(level >= lowest) if lowest is not None else counts.limit(0)
