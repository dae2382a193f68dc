"""Column expressions for the parts of a document: key, id, title, URL, properties, body."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaflow.functions.values import body_value, null_if_blank, plain_text, property_text
from vistaflow.model import PROPERTY

TITLE_SEPARATOR = " – "


def _present(df: DataFrame, columns: Iterable[str]) -> list[tuple[str, Column, object]]:
    """The named columns that exist in ``df``; document columns match by exact name."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [(c, F.col(f"`{c}`"), types[c]) for c in columns if c in types]


def row_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Trimmed key parts joined by ``:``; null and blank parts are left out."""
    parts = [
        null_if_blank(col) if isinstance(dt, T.StringType) else plain_text(col, dt)
        for _, col, dt in _present(df, columns)
    ]
    return F.concat_ws(":", *parts) if parts else F.lit("")


def document_id(object_type: str, key: Column, fallback: Column) -> Column:
    return F.concat(F.lit(f"{object_type}:"), key_or(key, fallback))


def key_or(key: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(key, F.lit("")), fallback.cast("string"))


def content_key(df: DataFrame) -> Column:
    """A key from the whole row, the same on every run; for rows without a key."""
    names = sorted(df.columns)
    fields = [F.col(f"`{c}`").cast("string") for c in names]
    return F.sha2(F.to_json(F.struct(*[f.alias(n) for f, n in zip(fields, names)])), 256)


def title(df: DataFrame, columns: Sequence[str], doc_id: Column) -> Column:
    """Non-null title parts joined by an en dash (blanks stay); the id when there is none."""
    parts = [plain_text(col, dt) for _, col, dt in _present(df, columns)]
    if not parts:
        return doc_id
    return F.when(F.coalesce(*parts).isNull(), doc_id).otherwise(
        F.concat_ws(TITLE_SEPARATOR, *parts)
    )


def view_url(object_type: str, key: Column, *, fixed: str = "", base: str = "") -> Column:
    """One fixed URL for all rows, else ``{base}/{type}/{key}``, else null."""
    base = (base or "").rstrip("/")
    if fixed:
        return F.lit(fixed.strip() or None).cast("string")
    if base:
        return null_if_blank(F.concat(F.lit(f"{base}/{object_type}/"), key))
    return F.lit(None).cast("string")


def custom_properties(df: DataFrame, columns: Sequence[str]) -> Column:
    """Array of (name, text) for the non-null property columns, in declared order.

    Short arrays are joined rather than one array filtered: that stays in generated code.
    """
    nothing = F.array().cast(f"array<{PROPERTY.simpleString()}>")
    parts = []
    for name, col, dt in _present(df, columns):
        text = property_text(col, dt)
        item = F.struct(F.lit(name).alias("name"), text.alias("value"))
        parts.append(F.when(text.isNotNull(), F.array(item)).otherwise(nothing))
    return F.concat(*parts) if parts else nothing


def kept_columns(columns: Iterable[str], exclude: Iterable[str]) -> list[str]:
    """Columns that match none of the case-insensitive name patterns."""
    patterns = [p.strip().lower() for p in exclude if p.strip()]
    return [c for c in columns if not any(fnmatch.fnmatchcase(c.lower(), p) for p in patterns)]


def body(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """JSON object of the kept columns with sorted keys; nulls stay as nulls."""
    kept = _present(df, sorted(kept_columns(df.columns, exclude)))
    if not kept:
        return F.lit("{}")
    fields = [body_value(col, dt).alias(name) for name, col, dt in kept]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
