"""Column expressions shared by the plans. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Novelty factors applied to a score, by minutes already watched.
NOVELTY_UNSEEN = 1.25
NOVELTY_SAMPLED = 1.12
NOVELTY_WATCHED = 1.00
NOVELTY_HEAVY = 0.65
SAMPLED_BELOW_MINUTES = 30
HEAVY_ABOVE_MINUTES = 90


def full_name(first: Column, last: Column) -> Column:
    """Two names with a space between; NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def divide(numerator: Column, denominator: Column) -> Column:
    """Double division; a zero denominator gives NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Double division that falls back to 0 when the denominator is not positive."""
    return F.when(denominator > 0, divide(numerator, denominator)).otherwise(F.lit(0.0))


def half_even(value: Column, digits: int = 2) -> Column:
    return F.bround(value, digits)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a number on one or both sides; NULL stays NULL."""
    out = value
    if low is not None:
        out = F.when(out < F.lit(low), F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > F.lit(high), F.lit(high)).otherwise(out)
    return out


def nan_to_null(value: Column, dtype: T.DataType) -> Column:
    """Replace NaN by NULL in floats, also inside arrays and structs."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(value), F.lit(None).cast(dtype)).otherwise(value)
    if isinstance(dtype, T.ArrayType) and _holds_float(dtype):
        return F.transform(value, lambda item: nan_to_null(item, dtype.elementType))
    if isinstance(dtype, T.StructType) and _holds_float(dtype):
        rebuilt = F.struct(
            *[nan_to_null(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        )
        return F.when(value.isNotNull(), rebuilt)
    return value


def _holds_float(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_float(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_float(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def to_number(value: Column) -> Column:
    """Read a value as double; anything that is not a number becomes NULL.

    Type suffixes and hexadecimal forms, which the cast would take, are no numbers.
    """
    number = value.try_cast("double")
    literal = value.cast("string").rlike(r"(?i)^\s*[+-]?(0x.*|.*[0-9.][df])\s*$")
    return F.when(~F.isnan(number) & ~literal, number)


def to_key(value: Column, dtype: T.DataType) -> Column:
    """Read a value as an integer key, cutting fractions off; bad values become NULL.

    Integer columns never pass through double, so 64-bit keys stay exact.
    """
    if isinstance(dtype, T.IntegralType):
        return value.cast("bigint")
    via_double = to_number(value).try_cast("bigint")
    if isinstance(dtype, T.StringType):
        return F.coalesce(value.try_cast("bigint"), via_double)
    return via_double


def whole_key(value: Column, dtype: T.DataType) -> Column:
    """Like ``to_key`` but text must spell a whole number, as catalogue keys do."""
    if isinstance(dtype, T.StringType):
        return value.try_cast("bigint")
    return to_key(value, dtype)


def first_truthy(columns: list[Column], empty: object) -> Column:
    """First column that is neither NULL nor ``empty``; the last one is taken as it is."""
    head = [F.nullif(c, F.lit(empty)) for c in columns[:-1]]
    return F.coalesce(*head, columns[-1])


def is_truthy(value: Column, dtype: T.DataType) -> Column:
    """Neither NULL, nor an empty text, nor zero."""
    empty = F.lit("") if isinstance(dtype, T.StringType) else F.lit(0)
    return F.coalesce(value != empty, F.lit(False))


def novelty_factor(minutes: Column) -> Column:
    return (
        F.when(minutes == 0, F.lit(NOVELTY_UNSEEN))
        .when(minutes < SAMPLED_BELOW_MINUTES, F.lit(NOVELTY_SAMPLED))
        .when(minutes <= HEAVY_ABOVE_MINUTES, F.lit(NOVELTY_WATCHED))
        .otherwise(F.lit(NOVELTY_HEAVY))
    )


def _blank_to_null(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\r\f\v"))
    return F.when(trimmed != "", trimmed)


def spelled(value: Column, dtype: T.DataType) -> Column:
    """Text of a scalar: True and False, and doubles without an exponent from 0.0001 to
    under 1e16, in absolute value; beyond that as 1e+16 or 1.5e-05."""
    text = value.cast("string")
    if isinstance(dtype, T.BooleanType):
        return F.initcap(text)
    if not isinstance(dtype, (T.DoubleType, T.FloatType)):
        return text
    size = F.abs(value.cast("double"))
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0*$", "$1")
    short = F.regexp_replace(F.regexp_replace(text, r"(\.0)?E(\d)", "e+$2"), r"(\.0)?E-", "e-")
    padded = F.regexp_replace(short, r"e([+-])(\d)$", "e$10$2")
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(text.contains("E") & (size >= 1e-4) & (size < 1e16), plain)
        .otherwise(padded)
    )


def flat_text(value: Column, dtype: T.DataType) -> Column:
    """Spell a scalar, struct or (nested) list as text; NULL and empty parts vanish.

    A struct gives its direct scalar fields only, a list gives every element in turn.
    """
    if isinstance(dtype, (T.StringType, T.NumericType, T.BooleanType)):
        return F.coalesce(spelled(value, dtype), F.lit(""))
    if isinstance(dtype, T.StructType):
        scalars = [
            spelled(value[f.name], f.dataType)
            for f in dtype.fields
            if isinstance(f.dataType, (T.StringType, T.NumericType, T.BooleanType))
        ]
        return F.concat_ws(" ", *scalars) if scalars else F.lit("")
    if isinstance(dtype, T.ArrayType):
        parts = F.transform(value, lambda item: flat_text(item, dtype.elementType))
        return F.coalesce(F.array_join(F.filter(parts, lambda part: part != ""), " "), F.lit(""))
    return F.lit("")


def join_parts(parts: list[Column], fallback: Column) -> Column:
    """Trimmed non-blank parts with single spaces between; ``fallback`` when none is left."""
    return F.coalesce(F.nullif(F.concat_ws(" ", *[_blank_to_null(p) for p in parts]), F.lit("")), fallback)


def shorten(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def default_title(key: Column) -> Column:
    return F.concat(F.lit("Content "), key.cast("string"))


def date_key(ts: Column) -> Column:
    """Timestamp to an integer yyyymmdd key."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
