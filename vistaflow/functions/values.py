"""Column expressions that turn typed values into text or JSON-ready values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029\u3000"


def strip(col: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.btrim(col, F.lit(WHITESPACE))


def iso_text(col: Column, data_type: T.DataType) -> Column:
    """ISO form of a date or timestamp: no fraction when it is zero, else six digits."""
    text = col.cast("string")
    if not isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return text
    day, clock = F.substr(text, F.lit(1), F.lit(10)), F.substr(text, F.lit(12))
    iso = F.concat(day, F.lit("T"), clock)
    iso = F.when(F.length(text) > 19, F.rpad(iso, 26, "0")).otherwise(iso)
    if isinstance(data_type, T.TimestampType):
        iso = F.concat(iso, F.date_format(col, "xxx"))
    return iso


def iso_with_offset(instant: Column, offset_minutes: Column) -> Column:
    """ISO text of an instant at its own wall clock, e.g. ``2026-05-04T09:00:00-05:00``.

    ``instant`` is a zone-less timestamp in UTC; ``offset_minutes`` is the stored offset.
    """
    wall = instant + F.make_dt_interval(mins=offset_minutes)
    size = F.abs(offset_minutes)
    return F.concat(
        iso_text(wall, T.TimestampNTZType()),
        F.when(offset_minutes < 0, "-").otherwise("+"),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def null_if_nan(col: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def null_if_blank(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def plain_text(col: Column, data_type: T.DataType) -> Column:
    """Text as it goes into keys and titles; NaN counts as missing."""
    return null_if_nan(col, data_type).cast("string")


def property_text(col: Column, data_type: T.DataType) -> Column:
    """Text as it goes into custom properties: dates in ISO form."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return iso_text(col, data_type)
    return plain_text(col, data_type)


def body_value(col: Column, data_type: T.DataType) -> Column:
    """Value as it goes into a JSON body: dates ISO, NaN null, odd types as text."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return iso_text(col, data_type)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return null_if_nan(col, data_type)
    if isinstance(data_type, T.DecimalType):
        return col.cast("double")
    if isinstance(data_type, (T.StringType, T.BooleanType, T.IntegralType)):
        return col
    return col.cast("string")


def response_value(col: Column, data_type: T.DataType) -> Column:
    """Value as a query response shows it: bytes as UTF-8, dates ISO, decimals double."""
    if isinstance(data_type, T.BinaryType):
        return F.make_valid_utf8(col.cast("string"))
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return iso_text(col, data_type)
    if isinstance(data_type, T.DecimalType):
        return col.cast("double")
    return col
