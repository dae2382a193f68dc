"""JSON exports of rows and documents, written in parallel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaflow.functions.values import body_value
from vistaflow.operators.shaping import without_columns


def export_rows(df: DataFrame, path: str, excluded: Iterable[str] = ()) -> None:
    """Write the rows of a view without the excluded columns; odd types go out as text."""
    kept = without_columns(df, excluded)
    fields = [body_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in kept.schema]
    kept.select(*fields).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_profile(profile: DataFrame, path: str) -> None:
    """Write a schema profile as JSON."""
    profile.write.mode("overwrite").option("ignoreNullFields", False).json(path)
