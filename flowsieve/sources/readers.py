"""Sources: flow tables, scenarios, metric files, file manifests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.functions.scalars import floating_columns
from flowsieve.functions.scale import global_row_number, materialize
from flowsieve.schemas import FLOW_SCHEMA, OPERATIONAL_THRESHOLD

# The tokens a data-frame CSV reader takes as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

#: Bytes of a file read at once.
PIECE = 1 << 20


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def readiness(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Which named artefacts are in place."""
    return spark.createDataFrame([(n, exists(spark, p)) for n, p in paths.items()], "artefact string, present boolean")


def require_path(spark: SparkSession, path: str) -> None:
    if not exists(spark, path):
        raise FileNotFoundError(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = FLOW_SCHEMA, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a header and declared types: no inference pass over the data.

    Columns are taken by their header names, in any order; others are left out.
    Missing-value tokens become null; ``-`` is a value of its own.
    """
    require_path(spark, path)
    raw = spark.read.csv(path, header=True, mode=mode, enforceSchema=False)

    def typed(f: T.StructField) -> Column:
        value = F.when(~F.col(f.name).isin(*MISSING_TOKENS), F.col(f.name))
        if isinstance(f.dataType, T.StringType):
            return value.alias(f.name)
        return (value.cast(f.dataType) if mode == "FAILFAST" else value.try_cast(f.dataType)).alias(f.name)

    return raw.select(*[typed(f) for f in schema.fields])


def read_splits(spark: SparkSession, train: str, test: str, schema: T.StructType = FLOW_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """The two raw CSV splits."""
    return read_csv(spark, train, schema), read_csv(spark, test, schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table or feature table; filters and columns push into the scan."""
    require_path(spark, path)
    return spark.read.parquet(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing notion: NaN becomes null."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floating_columns(df)})


def head(df: DataFrame, order: Sequence[str], limit: int | None = None) -> DataFrame:
    """First rows in the given order; no limit, or one below 1, keeps all rows."""
    return df if limit is None or limit <= 0 else df.orderBy(*order).limit(limit)


def read_scenario(spark: SparkSession, path: str, order: Sequence[str], limit: int | None = None) -> DataFrame:
    """A scenario table; missing or empty is an error."""
    df = read_table(spark, path)
    if df.isEmpty():
        raise ValueError(f"scenario is empty: {path}")
    return head(df, order, limit)


def with_record_index(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Zero-based ``record_index`` in a declared order."""
    return global_row_number(df, [F.col(c) for c in order], "record_index")


def read_json_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Metadata JSON; a missing or corrupt file yields no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    bad = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    df = spark.read.schema(bad).json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
    return df.filter(F.col("_corrupt").isNull()).drop("_corrupt")


def read_threshold(spark: SparkSession, path: str, default: float = OPERATIONAL_THRESHOLD) -> float:
    """The selected threshold stored by the selection run, or the default."""
    schema = T.StructType([T.StructField("selected_threshold", T.DoubleType())])
    row = read_json_or_empty(spark, path, schema).first()
    return default if row is None or row["selected_threshold"] is None else float(row["selected_threshold"])


def read_csv_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Metric CSV, whole or not at all: a missing file, a short row or a bad cell yields no rows.

    The file is read once, into the shared scratch folder, so a fault shows here.
    """
    try:
        return materialize(read_csv(spark, path, schema))
    except (FileNotFoundError, PySparkException, Py4JJavaError):
        return spark.createDataFrame([], schema)


def file_manifest(spark: SparkSession, path: str, pattern: str = "*", hash_bytes: int = 1 << 30) -> DataFrame:
    """Name, size and SHA-256 per file, hashed where the file is read.

    On a file system that workers open themselves, files of any size are read a piece at
    a time, and contents never become a cell. In a store that only Spark reads a file is one
    cell, so files above ``hash_bytes`` get a null hash there; they are listed all the same.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
        hashed = files.select("path", "length").mapInArrow(_hashed_files, "path string, length long, sha256 string")
    else:
        small, large = files.filter(F.col("length") <= hash_bytes), files.filter(F.col("length") > hash_bytes)
        hashed = small.withColumn("sha256", F.sha2("content", 256)).drop("content")
        hashed = hashed.unionByName(large.drop("content").withColumn("sha256", F.lit(None).cast("string")))
    return hashed.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "path",
        F.col("length").alias("size_bytes"), F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"), "sha256",
    )


def _hashed_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Local files (path, length) with their hash, a piece in memory at a time. A path is ``file:`` and the plain name."""
    for b in batches:
        found = []
        for path in b.column("path").to_pylist():
            name, digest = path.removeprefix("file:"), hashlib.sha256()
            with open(f"/{name.lstrip('/')}", "rb", buffering=0) as file:
                while piece := file.read(PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([b.column("path"), b.column("length"), pa.array(found, pa.string())], names=["path", "length", "sha256"])


def list_sources(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """File names and sizes, sorted; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("size_bytes")
    ).orderBy("file_name")

