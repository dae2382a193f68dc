"""Projection and output shaping of query results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaflow.functions.documents import kept_columns
from vistaflow.functions.values import response_value
from vistaflow.operators.filters import resolve


def column_list(text: str | Iterable[str] | None) -> list[str]:
    """Names of a comma-separated select list; blanks dropped, an empty list is an error."""
    if text is None:
        return []
    parts = text.split(",") if isinstance(text, str) else list(text)
    names = [p.strip() for p in parts if p.strip()]
    if not names:
        raise ValueError("the select list names no column")
    return names


def select_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns in order; a repeated name counts once."""
    fields = dict.fromkeys(resolve(df, n, "select column").name for n in names)
    return df.select(*[F.col(f"`{n}`") for n in fields])


def without_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """All columns but the named ones; names match exactly and unknown ones are ignored."""
    drop = set(names)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in drop])


def without_matching(df: DataFrame, patterns: Iterable[str]) -> DataFrame:
    """All columns but those that match a case-insensitive name pattern."""
    return df.select(*[F.col(f"`{c}`") for c in kept_columns(df.columns, patterns)])


def coerce_output(df: DataFrame) -> DataFrame:
    """Every column as a response shows it (see functions.values.response_value)."""
    return df.select(
        *[response_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def envelope(df: DataFrame, limit: int | None) -> DataFrame:
    """One row: number of result rows, and whether more may exist beyond the limit."""
    more = F.col("row_count") == limit if limit is not None else F.lit(False)
    return df.agg(F.count("*").alias("row_count")).withColumn("maybe_more", more)
