"""Type coercion as column expressions: text or any scalar to a logical type, bad input to null.

ANSI mode raises on a bad plain ``cast``, and ``try_cast`` alone accepts text a data file never means as a number
(``1d``), keeps ``NaN`` as a value and truncates fractions. The builders here guard the text first, so the result is
the same with ANSI mode on or off, and everything stays inside generated code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.names import col
from ledgermill.spec import TableSpec, spark_type

# The accepted spellings of numbers in text.
NUMBER_TEXT = r"^[ \t\r\n]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n]*$"
WHOLE_TEXT = r"^[ \t\r\n]*[+-]?[0-9]+[ \t\r\n]*$"
INFINITY_TEXT = r"(?i)^[ \t\r\n]*[+-]?inf(inity)?[ \t\r\n]*$"
ISO_DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# Numbers too short to overflow, and whole numbers sure to fit 64 bits: nearly all text takes these quick paths.
_SHORT_NUMBER = r"^[ \t\r\n]*[+-]?([0-9]{1,200}\.?[0-9]{0,100}|\.[0-9]{1,100})([eE][+-]?[0-9]{1,2})?[ \t\r\n]*$"
_SHORT_WHOLE = r"^[ \t\r\n]*[+-]?[0-9]{1,18}[ \t\r\n]*$"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType)
_LONG_MIN, _LONG_LIMIT = -(2.0**63), 2.0**63


def _double_of_text(c: Column) -> Column:
    """Text as a double; null unless it spells a finite number (or an infinity by name).

    Casts trim white space themselves, so the text is matched once and cast once on the quick path.
    """
    number = c.try_cast("double")
    return (
        F.when(c.rlike(_SHORT_NUMBER), number)
        .when(c.rlike(INFINITY_TEXT), number)
        .when(c.rlike(NUMBER_TEXT), F.when(F.abs(number) < F.lit(float("inf")), number))
    )


def without_nan(c: Column, source: T.DataType) -> Column:
    """The column with NaN read as null."""
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return F.nanvl(c, F.lit(None).cast(source))
    return c


def to_double(c: Column, source: T.DataType) -> Column:
    """Number as a 64-bit float; unparseable text and NaN become null."""
    if isinstance(source, T.StringType):
        return _double_of_text(c)
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return without_nan(c, source).cast("double")
    if isinstance(source, _INTEGRAL + (T.DecimalType, T.BooleanType)):
        return c.cast("double")
    if isinstance(source, T.NullType):
        return F.lit(None).cast("double")
    raise ValueError(f"Cannot read {source.simpleString()} as a number")


def _whole_of_double(d: Column) -> Column:
    fits = (d == F.floor(d)) & (d >= F.lit(_LONG_MIN)) & (d < F.lit(_LONG_LIMIT))
    return F.when(fits, d.try_cast("bigint"))


def to_long(c: Column, source: T.DataType) -> Column:
    """Whole number as 64 bits; unparseable text becomes null, and so does a value :func:`not_whole` flags.

    Digits-only text goes straight to ``bigint``, so whole numbers above 2**53 keep every digit.
    """
    if isinstance(source, T.StringType):
        return (
            F.when(c.rlike(_SHORT_WHOLE), c.try_cast("bigint"))
            .when(c.rlike(WHOLE_TEXT), F.coalesce(c.try_cast("bigint"), _whole_of_double(c.try_cast("double"))))
            .when(c.rlike(NUMBER_TEXT), _whole_of_double(c.try_cast("double")))
        )
    if isinstance(source, _FRACTIONAL):
        if isinstance(source, T.DecimalType):
            return F.when(c == F.floor(c), c.try_cast("bigint"))
        return _whole_of_double(c.cast("double"))
    if isinstance(source, _INTEGRAL + (T.BooleanType,)):
        return c.cast("bigint")
    if isinstance(source, T.NullType):
        return F.lit(None).cast("bigint")
    raise ValueError(f"Cannot read {source.simpleString()} as a whole number")


def not_whole(c: Column, source: T.DataType) -> Column:
    """True where the value is a number that a 64-bit whole number cannot hold (a fraction, an infinity, too big)."""
    if isinstance(source, T.StringType):
        number = ~c.rlike(_SHORT_WHOLE) & (c.rlike(NUMBER_TEXT) | c.rlike(INFINITY_TEXT))
        return number & to_double(c, source).isNotNull() & to_long(c, source).isNull()
    if isinstance(source, _FRACTIONAL):
        return without_nan(c, source).isNotNull() & to_long(c, source).isNull()
    return F.lit(False)


def to_date(c: Column, source: T.DataType, fmt: str | None = None) -> Column:
    """Date; unparseable text becomes null. Text is ISO ``yyyy-MM-dd`` unless a pattern is given."""
    if isinstance(source, T.StringType):
        if fmt:
            return F.try_to_timestamp(c, F.lit(fmt)).cast("date")
        return F.when(c.rlike(ISO_DATE_TEXT), c.try_cast("date"))
    if isinstance(source, (T.DateType,) + _TIMES):
        return c.cast("date")
    if isinstance(source, T.NullType):
        return F.lit(None).cast("date")
    raise ValueError(f"Cannot read {source.simpleString()} as a date")


def to_timestamp(c: Column, source: T.DataType, fmt: str | None = None) -> Column:
    """Timestamp; unparseable text becomes null."""
    if isinstance(source, T.StringType):
        return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    if isinstance(source, (T.DateType,) + _TIMES):
        return c.cast("timestamp")
    if isinstance(source, T.NullType):
        return F.lit(None).cast("timestamp")
    raise ValueError(f"Cannot read {source.simpleString()} as a timestamp")


def _double_text(c: Column) -> Column:
    """Double as text with a plain decimal point from 1e-4 up to 1e16 and ``1e+16`` style outside."""
    text = c.cast("string")
    size = F.abs(c)
    # a decimal of the text keeps its digits; what follows the last digit that counts is cut
    plain = F.regexp_extract(text.try_cast(T.DecimalType(38, 22)).cast("string"), r"^(-?[0-9]+\.[0-9]+?)0*$", 1)
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    digits = F.format_string("%02d", F.abs(power))
    scientific = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), digits)
    return (
        F.when((size >= 1e-3) & (size < 1e7) | (size == 0), text)
        .when(F.isnan(c), F.lit(None).cast("string"))
        .when(size == F.lit(float("inf")), F.when(c > 0, "inf").otherwise("-inf"))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def to_text(c: Column, source: T.DataType) -> Column:
    """Text; null stays null. Booleans read ``True``/``False`` and floats keep a plain decimal point."""
    if isinstance(source, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if isinstance(source, T.DoubleType):
        return _double_text(c)
    if isinstance(source, T.FloatType):
        return _double_text(c.cast("string").cast("double"))
    return c.cast("string")


def to_logical(c: Column, source: T.DataType, logical: str, fmt: str | None = None) -> Column:
    """Coerce one column to a logical type name."""
    target = spark_type(logical)
    if isinstance(target, T.DateType):
        return to_date(c, source, fmt)
    if isinstance(target, T.TimestampType):
        return to_timestamp(c, source, fmt)
    if isinstance(target, T.LongType):
        return to_long(c, source)
    if isinstance(target, T.DoubleType):
        return to_double(c, source)
    if isinstance(target, T.StringType):
        return to_text(c, source)
    if isinstance(target, _INTEGRAL):
        return to_long(c, source).try_cast(target)
    if isinstance(target, T.FloatType):
        return to_double(c, source).try_cast(target)
    return c.try_cast(target)


def to_spark_type(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Coerce one column to a Spark type, bad input to null: the rule for aligning a stored table to new data."""
    if source == target:
        return c
    by_type = {
        T.DateType: to_date,
        T.TimestampType: to_timestamp,
        T.LongType: to_long,
        T.DoubleType: to_double,
        T.StringType: to_text,
    }
    for kind, convert in by_type.items():
        if isinstance(target, kind):
            return convert(c, source)
    if isinstance(target, _INTEGRAL):
        return to_long(c, source).try_cast(target)
    return c.try_cast(target)


def enforce_types(df: DataFrame, types: Mapping[str, str] | TableSpec) -> DataFrame:
    """Cast every column to its declared logical type; a column without a declared type is an error.

    A fraction in a whole-number column fails the query, as a silent null would lose data.
    """
    formats: Mapping[str, str | None] = {}
    if isinstance(types, TableSpec):
        formats = {c.name: c.format for c in types.columns}
        types = types.types
    undeclared = [c for c in df.columns if c not in types]
    if undeclared:
        raise ValueError(f"No declared type for columns {undeclared}")
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        typed = to_logical(c, f.dataType, types[f.name], formats.get(f.name))
        if isinstance(spark_type(types[f.name]), _INTEGRAL) and isinstance(f.dataType, (T.StringType,) + _FRACTIONAL):
            message = F.concat(F.lit(f"Column {f.name!r} holds a number that is not whole: "), c.cast("string"))
            typed = F.when(not_whole(c, f.dataType), F.raise_error(message).cast("bigint")).otherwise(typed)
        out.append(typed.alias(f.name))
    return df.select(*out)
