"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)

# Fixed value: the characters a text strip removes, as a regex class.
_BLANK = r"[\s\x1c-\x1f]"
_EDGES = f"(?U)^{_BLANK}+|{_BLANK}+$"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields 0.0 on a zero denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def round_to(value: Column | str, digits: int) -> Column:
    """Round half away from zero on the scaled binary value.

    ``F.round`` rounds the shortest decimal text of a double, which moves values
    like 0.66475 (stored just below) up; scaling first rounds what is stored, and
    stays numeric inside codegen.
    """
    number = (F.col(value) if isinstance(value, str) else value).cast("double")
    scaled = F.abs(number) * (10.0 ** digits)
    rounded = F.signum(number) * F.floor(scaled + 0.5) / (10.0 ** digits) + 0.0
    return F.when(scaled < 2.0 ** 52, rounded).otherwise(number)


def round_share(value: Column | str, digits: int = 4) -> Column:
    """:func:`round_to` for values that are never negative; NaN becomes null.

    It names its argument once, which keeps generated code small in hot paths.
    """
    number = F.nanvl(F.col(value) if isinstance(value, str) else value, F.lit(None).cast("double"))
    return F.floor(number * (10.0 ** digits) + 0.5) / (10.0 ** digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return round_share(ratio(part, whole) * 100, digits)


def finite_or_null(value: Column) -> Column:
    """Infinities and NaN become null; finite values pass through."""
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def strip_text(value: Column) -> Column:
    """Remove blanks of every kind (tabs, newlines too) from both ends."""
    return F.regexp_replace(value, _EDGES, "")


def missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating columns."""
    absent = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, FLOATING):
        absent = absent | F.isnan(name)
    return absent


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in skip]


def order_key(seed: int | str, *columns: str | Column) -> Column:
    """Portable pseudo-random sort key: md5 of ``seed:col|col``, as hex text."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("|", *parts)))


def lookup(table: Mapping[str, str], key: Column, default: Column | str | None) -> Column:
    """Literal-map lookup with a default."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), fallback)


def argmax(values: Column) -> Column:
    """Zero-based index of the first maximum of an array."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def without_index(values: Column, index: int) -> Column:
    """The array without one position."""
    return F.concat(F.slice(values, 1, index), F.slice(values, index + 2, F.greatest(F.size(values), F.lit(0))))


def literal_array(values: Iterable) -> Column:
    return F.array(*[F.lit(v) for v in values])


def class_name(index: Column, classes: Iterable[str]) -> Column:
    """Decode a zero-based class index."""
    return F.try_element_at(literal_array(classes), index + 1)


def class_index(name: Column, classes: Iterable[str]) -> Column:
    """Encode a class name; null when it is not in the list."""
    position = F.array_position(literal_array(classes), name)
    return F.when(position > 0, (position - 1).cast("int"))


def long_form(df: DataFrame, columns: Iterable[str], key: str, value: str, cast: str | None = None) -> DataFrame:
    """Wide one-row (or narrow) frame to ``(key, value)`` rows, other columns kept."""
    names = list(columns)
    kept = [c for c in df.columns if c not in names]
    pairs = [F.struct(F.lit(n).alias(key), (F.col(n).cast(cast) if cast else F.col(n)).alias(value)) for n in names]
    return df.select(*kept, F.inline(F.array(*pairs)))
