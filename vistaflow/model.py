"""Declarative records shared by every job: views, filters and the document schema."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

IDENTIFIER = re.compile(r"[A-Za-z0-9_]+")

PROPERTY = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]
)

# The reader list itself is a table (one row per user, see operators.access); a document
# names it by id, so that documents do not grow with the number of users.
PERMISSIONS = T.StructType(
    [
        T.StructField("allow_anonymous_access", T.BooleanType()),
        T.StructField("acl_id", T.StringType()),
    ]
)

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("object_type", T.StringType()),
        T.StructField("datasource", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("view_url", T.StringType()),
        T.StructField("created_at", T.LongType()),
        T.StructField("updated_at", T.LongType()),
        T.StructField("body", T.StringType()),
        T.StructField("custom_properties", T.ArrayType(PROPERTY)),
        T.StructField("permissions", PERMISSIONS),
    ]
)


def require_identifier(name: Any, what: str) -> str:
    """Return ``name`` if it holds only letters, digits and underscores."""
    if not isinstance(name, str) or not IDENTIFIER.fullmatch(name):
        raise ValueError(f"{what} {name!r} is no plain name")
    return name


@dataclass(frozen=True)
class Filter:
    """One condition on one column; a list of them is a conjunction."""

    column: str
    op: str
    value: Any = None


@dataclass(frozen=True)
class ViewDef:
    """A view in the catalog and how its rows become documents.

    ``id_columns`` (composite key) beats ``id_column``. ``order_columns`` give the rows a
    total order: it decides which duplicate is the last one and what position a row has.
    ``overlap`` reads rows again that lie at most so far behind the saved watermark, so that late
    ones come in: an interval ('7 days') for dates and times, a number for other columns.
    ``complete_keys`` states that every row has a key: a row without one is then an error
    and reading ids alone touches the key columns alone. ``build`` replaces the generic
    row-to-document mapping: it is called as ``build(df, datasource=..., acl_id=...)``, gives
    rows of ``DOCUMENT_SCHEMA``, and column exclusion and URL settings do not apply to it.
    """

    view_name: str
    object_type: str
    id_column: str = ""
    id_columns: tuple[str, ...] = ()
    title_columns: tuple[str, ...] = ()
    property_columns: tuple[str, ...] = ()
    watermark_column: str | None = None
    order_columns: tuple[str, ...] = ()
    complete_keys: bool = False
    overlap: str | None = None
    schema: str | None = None
    enabled: bool = True
    build: Callable[..., DataFrame] | None = field(default=None, compare=False)

    @property
    def key_columns(self) -> tuple[str, ...]:
        return self.id_columns or ((self.id_column,) if self.id_column else ())


@dataclass(frozen=True)
class DocumentOptions:
    """Settings of one run that apply to every view built by the generic mapping.

    ``run_epoch`` is the time put on documents, in seconds; None is the time of the query.
    """

    datasource: str = "views"
    run_epoch: int | None = None
    exclude_columns: tuple[str, ...] = ()
    view_url: str = ""
    view_url_base: str = ""
