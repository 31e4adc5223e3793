"""Table profiles: shape, missing values, infinities, duplicates, target counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.functions.scalars import floating_columns, long_form, missing, percent
from flowsieve.functions.scale import semi_join_skew_safe, tagged_counts


def value_counts(df: DataFrame, column: str, digits: int = 3, drop_missing: bool = False) -> DataFrame:
    """Rows and percentage per value; missing is a value unless dropped.

    The total is a scalar subquery over the counts, so the table is scanned once.
    """
    source = df.filter(F.col(column).isNotNull()) if drop_missing else df
    counts = source.groupBy(column).agg(F.count("*").alias("n_rows"))
    total = (df if drop_missing else counts).agg(F.count("*") if drop_missing else F.sum("n_rows")).scalar()
    return counts.withColumn("pct", percent(F.col("n_rows"), total, digits))


def target_distribution(df: DataFrame, targets: Sequence[str] = ("label", "attack_cat"), digits: int = 3) -> DataFrame:
    """Counts and percentages of several targets in one pass, in long form."""
    pairs = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("string").alias("value")) for t in targets])
    counts = df.select(F.inline(pairs)).groupBy("target", "value").agg(F.count("*").alias("n_rows"))
    total = counts.filter(F.col("target") == targets[0]).agg(F.sum("n_rows")).scalar()
    return counts.withColumn("pct", percent(F.col("n_rows"), total, digits))


def null_profile(df: DataFrame, only_nonzero: bool = True) -> DataFrame:
    """Missing values per column, from one wide aggregate."""
    wide = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in df.columns])
    rows = long_form(wide, df.columns, "column_name", "n_missing")
    return rows.filter("n_missing > 0") if only_nonzero else rows


def inf_profile(df: DataFrame, only_nonzero: bool = True) -> DataFrame:
    """Infinite values per floating column, from one wide aggregate."""
    names = floating_columns(df)
    wide = df.agg(*[F.count_if(F.abs(F.col(c)) == float("inf")).alias(c) for c in names])
    rows = long_form(wide, names, "column_name", "n_infinite")
    return rows.filter("n_infinite > 0") if only_nonzero else rows


def duplicate_count(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each identical group.

    Grouping on the row itself is exact and null-safe, and copies collapse in
    the map-side partial aggregate before the shuffle.
    """
    keys = [c for c in df.columns if c not in ignore]
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def _digest(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Keys to group on in place of the columns: two 64-bit hashes that tell rows apart as the values themselves would.

    Nulls leave a hash as it is, so each value goes with a mark; 0.0 and -0.0 are one value. Nested columns stay as they are.
    """
    plain = [f for f in df.schema.fields if f.name in keys and (isinstance(f.dataType, T.NumericType) or f.dataType in _HASHED)]
    marked = [x for f in plain for x in (F.col(f.name).isNull(), F.col(f.name) + 0.0 if f.name in floating_columns(df) else F.col(f.name))]
    nested = [F.col(k) for k in keys if k not in {f.name for f in plain}]
    return [*(F.xxhash64(F.lit(i), *marked).alias(f"_h{i}") for i in (1, 2)), *nested]


_HASHED = (T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BinaryType())


def split_profile(df: DataFrame, id_column: str = "id", by: str | None = None) -> DataFrame:
    """Rows, columns, missing, infinite and duplicate totals; one row per split with ``by``.

    Equal rows are found by a digest of 128 bits, so what is shuffled does not grow with the width of a row.
    """
    body = [c for c in df.columns if c != by]
    groups = [by] if by else []

    def total(terms):
        out = F.lit(0).cast("long")
        for term in terms:
            out = out + F.count_if(term)
        return out

    def duplicates(name: str, keys: Sequence[str]) -> DataFrame:
        per_row = df.groupBy(*groups, *_digest(df, keys)).agg(F.count("*").alias("_n"))
        return per_row.groupBy(*groups).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias(name))

    wide = df.groupBy(*groups).agg(
        F.count("*").alias("n_rows"),
        F.lit(len(body)).cast("long").alias("n_columns"),
        total(missing(df, c) for c in body).alias("total_missing"),
        total(F.abs(F.col(c)) == float("inf") for c in floating_columns(df) if c != by).alias("total_infinite"),
    )
    exact = duplicates("exact_duplicates", body)
    loose = duplicates("duplicates_without_id", [c for c in body if c != id_column])
    if by:  # one row per split on every side
        return wide.join(exact, by).join(loose, by)
    return wide.withColumns({"exact_duplicates": exact.scalar(), "duplicates_without_id": loose.scalar()})


def clean_audit(before: DataFrame, after: DataFrame, by: str, id_column: str = "id") -> DataFrame:
    """Profiles before and after cleaning, tagged with their stage."""
    return (
        split_profile(before, id_column, by).withColumn("stage", F.lit("before"))
        .unionByName(split_profile(after, id_column, by).withColumn("stage", F.lit("after")))
    )


def column_types(df: DataFrame) -> DataFrame:
    """Column name, position and type as rows."""
    rows = [(name, i, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "column_name string, position int, data_type string")


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two tables side by side, with one-sided, order and type differences marked."""
    a = column_types(left).withColumnsRenamed({"position": "left_position", "data_type": "left_type"})
    b = column_types(right).withColumnsRenamed({"position": "right_position", "data_type": "right_type"})
    status = (
        F.when(F.col("right_type").isNull(), "left_only")
        .when(F.col("left_type").isNull(), "right_only")
        .when(F.col("left_type") != F.col("right_type"), "type_mismatch")
        .when(F.col("left_position") != F.col("right_position"), "order_mismatch")
        .otherwise("match")
    )
    return a.join(b, "column_name", "full_outer").withColumn("status", status)


def split_overlap(train: DataFrame, test: DataFrame, ignore: Sequence[str] = ("id",)) -> DataFrame:
    """Number of distinct row patterns that occur in both splits (null-safe)."""
    keys = [c for c in train.columns if c in test.columns and c not in ignore]
    both = tagged_counts({"train": train, "test": test}, keys).filter("n_train > 0 and n_test > 0")
    return both.agg(F.count("*").alias("overlapping_patterns")).withColumn(
        "compared_columns", F.lit(len(keys)).cast("long"))


def leaked_rows(train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Test rows whose pattern occurs in train."""
    return semi_join_skew_safe(test, train, keys)


def subset_check(sample: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many distinct sample keys the source lacks; zero means containment."""
    counts = tagged_counts({"sample": sample, "source": source}, keys).filter("n_sample > 0")
    return counts.agg(
        F.count("*").alias("n_keys"), F.count_if(F.col("n_source") == 0).alias("n_outside")
    ).withColumn("contained", F.col("n_outside") == 0)


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n_rows"))
