"""Typed filters: each condition becomes a Catalyst predicate that reaches the scan."""

from __future__ import annotations

import json
import operator
from collections.abc import Callable, Iterable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaflow.model import Filter, require_identifier
from vistaflow.operators.lookup import BROADCAST_ROWS

# Values a list may hold before it is compared by a semi-join instead of an IN predicate.
IN_LIST_LIMIT = 1000

COMPARE: dict[str, Callable[[Any, Any], Column]] = {
    "eq": operator.eq,
    "ne": operator.ne,
    "gt": operator.gt,
    "gte": operator.ge,
    "lt": operator.lt,
    "lte": operator.le,
}
TEXT: dict[str, Callable[[Column, str], Column]] = {
    "contains": lambda col, v: F.contains(col, F.lit(v)),
    "startswith": lambda col, v: col.startswith(v),
    "endswith": lambda col, v: col.endswith(v),
}
NULLS: dict[str, Callable[[Column], Column]] = {
    "is_null": Column.isNull,
    "is_not_null": Column.isNotNull,
}
OPS = sorted([*COMPARE, *TEXT, *NULLS, "between", "in"])


def resolve(df: DataFrame, name: str, what: str = "column") -> T.StructField:
    """The field called ``name`` in any case, or ValueError."""
    require_identifier(name, what)
    for f in df.schema.fields:
        if f.name.lower() == name.lower():
            return f
    raise ValueError(f"Unknown {what} {name!r}.")


def as_filters(given: str | Iterable[Filter | dict] | None) -> list[Filter]:
    """Filters from JSON text, dicts or Filter records, with op and value shape checked."""
    if given is None or (isinstance(given, str) and not given.strip()):
        return []
    items = json.loads(given) if isinstance(given, str) else given
    if isinstance(items, dict) or not isinstance(items, Iterable):
        raise ValueError("a list of filters is needed.")
    return [_checked(i) for i in items]


def _checked(item: Filter | dict) -> Filter:
    if isinstance(item, dict):
        item = Filter(item.get("column"), item.get("op"), item.get("value"))
    if not isinstance(item, Filter):
        raise ValueError("a filter needs a column and an op.")
    require_identifier(item.column, "filter column")
    op, value = item.op, item.value
    if not isinstance(op, str):
        raise ValueError(f"op {op!r} is no text.")
    if op in COMPARE:
        good = value is not None and not isinstance(value, (list, tuple, dict))
    elif op in TEXT:
        good = isinstance(value, str)
    elif op == "between":
        good = isinstance(value, (list, tuple)) and len(value) == 2 and plain_values(value)
    elif op == "in":
        good = isinstance(value, (list, tuple)) and len(value) >= 1 and plain_values(value)
    elif op in NULLS:
        good = True
    else:
        raise ValueError(f"op must be one of: {', '.join(OPS)}.")
    if not good:
        raise ValueError(f"value {value!r} does not fit op {op!r}.")
    return item


def plain_values(values: Iterable[Any]) -> bool:
    return not any(isinstance(v, (list, tuple, dict, set)) for v in values)


def typed(value: Any, data_type: T.DataType) -> Column:
    """A literal compared in the column's type: text is cast, numbers stay and widen."""
    if isinstance(value, str) and not isinstance(data_type, T.StringType):
        return F.lit(value).cast(data_type)
    return F.lit(value)


def predicate(df: DataFrame, f: Filter) -> Column:
    field = resolve(df, f.column, "filter column")
    col, dt = F.col(f"`{field.name}`"), field.dataType
    if f.op in NULLS:
        return NULLS[f.op](col)
    if f.op in TEXT:
        return TEXT[f.op](col if isinstance(dt, T.StringType) else col.cast("string"), f.value)
    if f.op == "between":
        return col.between(typed(f.value[0], dt), typed(f.value[1], dt))
    if f.op == "in":
        return col.isin(*[typed(v, dt) for v in f.value])
    return COMPARE[f.op](col, typed(f.value, dt))


def apply_filters(df: DataFrame, filters: Iterable[Filter]) -> DataFrame:
    """Rows for which every filter holds; a null value fails all but ``is_null``."""
    filters = list(filters)
    long_lists = [f for f in filters if f.op == "in" and len(f.value) > IN_LIST_LIMIT]
    preds = [predicate(df, f) for f in filters if f not in long_lists]
    out = df.where(reduce(operator.and_, preds)) if preds else df
    for f in long_lists:
        out = _in_list(out, f)
    return out


def value_frame(df: DataFrame, values: Iterable[Any], data_type: T.DataType) -> DataFrame:
    """Values as rows, typed one by one as :func:`typed` does, then widened together.

    Null equals nothing, so it is left out.
    """
    kinds: dict[type, list] = {}
    for v in dict.fromkeys(values):
        if v is not None:
            kinds.setdefault(type(v), []).append((v,))
    frames = []
    for kind, rows in sorted(kinds.items(), key=lambda k: k[0].__name__):
        frame = df.sparkSession.createDataFrame(rows, ["v"])
        text = kind is str and not isinstance(data_type, T.StringType)
        frames.append(frame.select(F.col("v").cast(data_type).alias("v")) if text else frame)
    if not frames:
        return df.sparkSession.createDataFrame([], T.StructType([T.StructField("v", data_type)]))
    return reduce(DataFrame.union, frames)


def _in_list(df: DataFrame, f: Filter) -> DataFrame:
    """A long value list as a semi-join, broadcast if the request lists few enough."""
    field = resolve(df, f.column, "filter column")
    values = value_frame(df, f.value, field.dataType)
    if len(f.value) <= BROADCAST_ROWS:
        values = F.broadcast(values)
    return df.join(values, df[field.name] == values["v"], "left_semi")
