"""Full, capped and incremental scans of a view, and the watermark they leave behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaflow.model import ViewDef


def watermark_literal(df: DataFrame, column: str, since: str) -> Column:
    """The saved text watermark in the column's own type, so the filter is pushed down."""
    return F.lit(since).cast(df.schema[column].dataType)


def window_start(df: DataFrame, view: ViewDef, since: str) -> Column:
    """Rows above this are read: the saved watermark, less the view's overlap.

    A constant in the column's own type, so the filter is pushed down.
    """
    column = view.watermark_column
    saved = watermark_literal(df, column, since)
    if view.overlap is None:
        return saved
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        lag = F.lit(view.overlap).cast(kind)
    else:
        lag = F.lit(view.overlap).cast("interval")
        lag = F.when(lag.isNull(), F.raise_error(F.lit(f"{view.overlap!r} is no interval"))).otherwise(lag)
    return (saved - lag).cast(kind)


def scan(
    df: DataFrame, view: ViewDef, *, since: str | None = None, row_limit: int = 0
) -> DataFrame:
    """Rows of a view: all of them, or those strictly newer than ``since``.

    A view with an ``overlap`` also gives the rows that lie at most so far before ``since``;
    a cap then counts the newer rows only, so that capped runs get on.

    With ``row_limit`` the oldest rows come first and ties at the cut are all read, so the
    saved watermark never skips an unread row. Rows without a watermark are read by full
    scans only, all of them and beside the cap, so capped runs always get on. Without a
    watermark column the cap is a plain limit and ``since`` is ignored.
    """
    limit = max(0, row_limit)
    wm = view.watermark_column if view.watermark_column in df.columns else None
    if wm is None:
        return df.limit(limit) if limit else df
    rows = df
    if since is not None:
        rows = rows.where(F.col(wm) > window_start(df, view, since))
    if not limit:
        return rows
    dated = rows.where(F.col(wm).isNotNull())
    if since is not None:
        dated = dated.where(F.col(wm) > watermark_literal(df, wm, since))
    cut = dated.select(wm).orderBy(wm).limit(limit).agg(F.max(wm).alias("cut"))
    within = F.col(wm) <= cut.scalar()
    if since is not None and view.overlap is not None:
        within = within | (F.col(wm) <= watermark_literal(df, wm, since))
    return rows.where(within if since is not None else F.col(wm).isNull() | within)


def watermark_text(column: str) -> Column:
    """Newest watermark as text with microseconds; null when there are no rows."""
    return F.max(column).cast("string")


def newest_watermark(df: DataFrame, view: ViewDef) -> DataFrame:
    """One row: view name and newest watermark of the rows given."""
    wm = view.watermark_column
    value = watermark_text(wm) if wm and wm in df.columns else F.lit(None).cast("string")
    return df.agg(F.lit(view.view_name).alias("view_name"), value.alias("watermark"))
