"""A keyed table in hash buckets, merged on write: a change reads and writes the buckets of its keys only.

Each merge writes the touched buckets whole, as ``version=<n>/bucket=<b>``, and
then a manifest that names the live version of every bucket. The manifest is
moved into place in one step, so readers see the table before or after a merge,
and a merge that fails leaves files no manifest names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.functions.scale import materialize
from flowsieve.sources.readers import exists

BUCKETS = 64
_MANIFESTS = "_manifests"


@dataclass
class Manifest:
    """Version of the table, its key and number of buckets, and the live version of each bucket."""

    version: int
    key: str
    buckets: int
    live: dict[int, int]

    def paths(self, path: str, only: list[int] | None = None) -> list[str]:
        wanted = sorted(self.live) if only is None else [b for b in sorted(only) if b in self.live]
        return [f"{path}/version={self.live[b]}/bucket={b}" for b in wanted]


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest of a table, or None where there is none."""
    folder = f"{path}/{_MANIFESTS}"
    if not exists(spark, folder):
        return None
    place, system = _system(spark, folder)
    versions = [int(n[:-5]) for s in system.listStatus(place) if (n := s.getPath().getName()).endswith(".json")]
    if not versions:
        return None
    found = json.loads("".join(r["value"] for r in spark.read.text(f"{folder}/{max(versions)}.json").collect()))
    return Manifest(max(versions), found["key"], found["buckets"], {int(b): v for b, v in found["live"].items()})


def _publish(spark: SparkSession, path: str, new: Manifest) -> None:
    body = json.dumps({"key": new.key, "buckets": new.buckets, "live": new.live})
    draft, system = _system(spark, f"{path}/{_MANIFESTS}/.{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(body.encode()))
    out.close()
    target, _ = _system(spark, f"{path}/{_MANIFESTS}/{new.version}.json")
    if system.exists(target) or not system.rename(draft, target):
        raise RuntimeError(f"another merge made version {new.version} first: {path}")


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def merge_rows(updates: DataFrame, path: str, key: str, order: Column | None = None, buckets: int = BUCKETS) -> list[int]:
    """Insert or replace rows by ``key``; the buckets that were read and written.

    Within the updates the row that is last by ``order`` wins (any one without
    it). A new table gets ``buckets`` buckets; an old one keeps its own. Rows
    without a key are left out.
    """
    spark, old = updates.sparkSession, manifest(updates.sparkSession, path)
    if old is not None and old.key != key:
        raise ValueError(f"the table is keyed by {old.key!r}, not by {key!r}")
    count = old.buckets if old else buckets
    rows = updates.filter(F.col(key).isNotNull())
    rank = F.struct(order) if order is not None else F.struct(F.lit(0))
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*updates.columns), rank).alias("_row")).select("_row.*")
    newest = materialize(newest.withColumn("bucket", bucket_of(F.col(key), count)))
    touched = sorted(r["bucket"] for r in newest.select("bucket").distinct().collect())  # at most the number of buckets
    if not touched:
        return []
    merged = newest
    paths = old.paths(path, touched) if old else []
    if paths:
        kept = spark.read.option("basePath", path).parquet(*paths).drop("version", "bucket")
        kept = kept.join(newest.select(key), key, "left_anti")
        merged = newest.unionByName(kept.withColumn("bucket", bucket_of(F.col(key), count)), allowMissingColumns=True)
    version = old.version + 1 if old else 0
    merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={version}")
    live = (old.live if old else {}) | dict.fromkeys(touched, version)
    _publish(spark, path, Manifest(version, key, count, live))
    return touched


def read_rows(spark: SparkSession, path: str, keys: list | None = None) -> DataFrame:
    """The table as of its newest manifest; with ``keys`` only their buckets are read, and only their rows returned."""
    now = manifest(spark, path)
    if now is None:
        raise FileNotFoundError(path)
    only = None
    if keys is not None:
        wanted = spark.createDataFrame([(k,) for k in keys], f"k {'string' if keys and isinstance(keys[0], str) else 'long'}")
        only = [r["b"] for r in wanted.select(bucket_of(F.col("k"), now.buckets).alias("b")).distinct().collect()]
    paths = now.paths(path, only) or now.paths(path)[:1]
    out = spark.read.option("basePath", path).parquet(*paths).drop("version", "bucket")
    return out if keys is None else out.filter(F.col(now.key).isin(list(keys)))
