"""Named queries over a folder of tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def report(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its oracle where plain SQL can express it."""

    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


# The sample views as SQL, for use in FROM clauses.
ORDER_CUSTOMER = (
    "(SELECT o.*, c_name, c_nationkey, c_mktsegment "
    "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"
)
LINEITEM_ORDER = (
    "(SELECT l.*, o_orderdate, o_orderstatus, o_orderpriority "
    "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"
)
DOCUMENT_LABEL = (
    "(SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id)"
)
ISO_TS = "replace(left(CAST({0} AS VARCHAR), 19), ' ', 'T')"
ISO_TS_MICRO = (
    "CASE WHEN strftime({0}, '%f') = '000000' THEN strftime({0}, '%Y-%m-%dT%H:%M:%S') "
    "ELSE strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') END"
)
EMAIL = "lower('User' || CAST(user_id AS VARCHAR) || '@Example.com')"
# The newest row of each line item key, as the sample view orders its rows.
LAST_LINEITEM = (
    "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    "ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM "
    + LINEITEM_ORDER
    + ") WHERE rn = 1)"
)
