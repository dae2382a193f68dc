"""Where views come from: parquet folders, catalog tables, or a database over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from vistaflow.model import ViewDef, require_identifier
from vistaflow.sources.catalog import ViewCatalog

Loader = Callable[[], DataFrame]


def parquet_view(spark: SparkSession, path: str) -> Loader:
    return lambda: spark.read.parquet(path)


def table_view(spark: SparkSession, schema: str, view_name: str) -> Loader:
    """A table or view of the session catalog."""
    name = f"{require_identifier(schema, 'schema')}.{require_identifier(view_name, 'view name')}"
    return lambda: spark.table(name)


def jdbc_options(
    url: str,
    schema: str,
    view_name: str,
    *,
    split_column: str | None = None,
    lower: str = "",
    upper: str = "",
    splits: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read; ``split_column`` makes ``splits`` tasks read in parallel.

    Filters, selected columns and limits are sent to the database by Spark.
    """
    require_identifier(schema, "schema")
    require_identifier(view_name, "view name")
    options = {"url": url, "dbtable": f"{schema}.{view_name}", "fetchsize": str(fetch_size)}
    if split_column:
        options |= {
            "partitionColumn": require_identifier(split_column, "split column"),
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(splits),
        }
    return options


def jdbc_view(spark: SparkSession, options: dict[str, str]) -> Loader:
    return lambda: spark.read.format("jdbc").options(**options).load()


def table_catalog(
    spark: SparkSession, views: Iterable[ViewDef], default_schema: str
) -> ViewCatalog:
    """All views as tables of the session catalog; a view's own schema beats the default."""
    out = ViewCatalog(spark)
    for view in views:
        out.register(view, table_view(spark, view.schema or default_schema, view.view_name))
    return out
