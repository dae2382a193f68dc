"""Registry of views: name -> lazy DataFrame plus its definition."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vistaflow.model import ViewDef

VIEW_LIST = T.StructType([T.StructField("view_name", T.StringType(), False)])
COLUMN_LIST = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("is_nullable", T.StringType(), False),
    ]
)


class ViewCatalog:
    """The views a run knows about, in catalog order.

    A loader is called on each read, so a view may be parquet, a table or a JDBC source;
    nothing is read before an action.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._loaders: dict[str, Callable[[], DataFrame]] = {}
        self._defs: dict[str, ViewDef] = {}

    def register(self, view: ViewDef | str, loader: Callable[[], DataFrame]) -> None:
        name = view if isinstance(view, str) else view.view_name
        self._loaders[name] = loader
        if isinstance(view, ViewDef):
            self._defs[name] = view

    def has(self, view_name: str) -> bool:
        return view_name in self._loaders

    def frame(self, view_name: str) -> DataFrame:
        if view_name not in self._loaders:
            raise LookupError(f"View {view_name!r} not found.")
        return self._loaders[view_name]()

    def definition(self, view_name: str) -> ViewDef:
        if view_name not in self._defs:
            raise LookupError(f"View {view_name!r} has no catalog entry.")
        return self._defs[view_name]

    def definitions(self, *, enabled_only: bool = True) -> list[ViewDef]:
        return [d for d in self._defs.values() if d.enabled or not enabled_only]

    def enabled(self) -> dict[str, DataFrame]:
        """One lazy full scan per enabled entry, in catalog order."""
        return {d.view_name: self.frame(d.view_name) for d in self.definitions()}

    def view_names(self) -> list[str]:
        return sorted(self._loaders)

    def list_views(self) -> DataFrame:
        """Names of all registered views, sorted."""
        return self.spark.createDataFrame([(n,) for n in self.view_names()], VIEW_LIST)

    def list_columns(self, view_name: str) -> DataFrame:
        """Name, type and nullability of each column, in ordinal order."""
        return self.spark.createDataFrame(column_rows(self.frame(view_name)), COLUMN_LIST)


def column_rows(df: DataFrame) -> Iterable[tuple[int, str, str, str]]:
    return [
        (i, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO")
        for i, f in enumerate(df.schema.fields, start=1)
    ]
