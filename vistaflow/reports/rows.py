"""Scans, filters, projections, sorts, limits and aggregates on the sample views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaflow.model import Filter
from vistaflow.operators.shaping import (
    coerce_output,
    envelope,
    without_columns,
    without_matching,
)
from vistaflow.plans.query import aggregate, query
from vistaflow.plans.requests import AccessRules, ViewRequests
from vistaflow.reports.registry import (
    DOCUMENT_LABEL,
    ISO_TS_MICRO,
    LINEITEM_ORDER,
    ORDER_CUSTOMER,
    report,
)
from vistaflow.sources.sample import VIEW, catalog
from vistaflow.sources.scan import scan


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return catalog(spark, folder).frame(name)


# --- scans ----------------------------------------------------------------------------


@report("scan_full", f"SELECT * FROM {LINEITEM_ORDER}")
def scan_full(spark, folder):
    return scan(view(spark, folder, "v_Lineitem_Order"), VIEW["v_Lineitem_Order"])


@report(
    "scan_capped",
    f"""
    WITH newer AS (SELECT * FROM {ORDER_CUSTOMER} WHERE o_orderdate > TIMESTAMP '2000-01-01')
    SELECT * FROM newer WHERE o_orderdate <=
      (SELECT max(o_orderdate) FROM (SELECT o_orderdate FROM newer ORDER BY o_orderdate LIMIT 100))
    """,
)
def scan_capped(spark, folder):
    """The cap of a test run; ties at the cut are read as well."""
    df = view(spark, folder, "v_Order_Customer")
    return scan(df, VIEW["v_Order_Customer"], since="2000-01-01 00:00:00", row_limit=100)


@report(
    "scan_incremental",
    f"SELECT * FROM {ORDER_CUSTOMER} WHERE o_orderdate > TIMESTAMP '2000-12-01'",
)
def scan_incremental(spark, folder):
    df = view(spark, folder, "v_Order_Customer")
    return scan(df, VIEW["v_Order_Customer"], since="2000-12-01 00:00:00")


@report(
    "catalog_enabled",
    f"""
    SELECT 'v_Customer' AS view_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'v_Order_Customer', count(*) FROM {ORDER_CUSTOMER}
    UNION ALL SELECT 'v_Lineitem_Order', count(*) FROM {LINEITEM_ORDER}
    UNION ALL SELECT 'v_Event', count(*) FROM events
    UNION ALL SELECT 'v_Document_Label', count(*) FROM {DOCUMENT_LABEL}
    """,
)
def catalog_enabled(spark, folder):
    out = None
    for name, df in catalog(spark, folder).enabled().items():
        part = df.agg(F.lit(name).alias("view_name"), F.count("*").alias("row_count"))
        out = part if out is None else out.unionByName(part)
    return out


@report("join_left", f"SELECT doc_id, source, quality, toxic FROM {DOCUMENT_LABEL}")
def join_left(spark, folder):
    df = view(spark, folder, "v_Document_Label")
    return df.select("doc_id", "source", "quality", "toxic")


@report(
    "join_inner",
    f"SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, o_orderstatus FROM {LINEITEM_ORDER}",
)
def join_inner(spark, folder):
    df = view(spark, folder, "v_Lineitem_Order")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "o_orderstatus")


# --- projections ----------------------------------------------------------------------


@report("query_all", f"SELECT * FROM {DOCUMENT_LABEL}")
def query_all(spark, folder):
    return query(view(spark, folder, "v_Document_Label"), limit=None)


@report("query_select", f"SELECT o_orderkey, c_name, o_orderdate FROM {ORDER_CUSTOMER}")
def query_select(spark, folder):
    df = view(spark, folder, "v_Order_Customer")
    return query(df, select="o_orderkey, c_name,, O_ORDERDATE, o_orderkey", limit=None)


@report(
    "exclude_glob",
    f"SELECT l_orderkey, l_linenumber, l_shipdate, o_orderpriority FROM {LINEITEM_ORDER}",
)
def exclude_glob(spark, folder):
    patterns = ["L_[ps]*KEY", "l_[edt]*", "l_quantit?", "*STATUS", "l_returnflag", "o_orderdate", " "]
    return without_matching(view(spark, folder, "v_Lineitem_Order"), patterns)


@report(
    "export_drop_columns",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def export_drop_columns(spark, folder):
    return without_columns(view(spark, folder, "v_Event"), ["props", "ts", "no_such_column"])


@report(
    "coerce_output",
    f"""
    SELECT event_id, {ISO_TS_MICRO.format('ts')} AS ts, CAST(ts AS DATE)::VARCHAR AS day,
           event_type AS raw, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value
    FROM events
    """,
)
def coerce_events(spark, folder):
    df = view(spark, folder, "v_Event").select(
        "event_id",
        "ts",
        F.to_date("ts").alias("day"),
        F.encode("event_type", "utf-8").alias("raw"),
        F.col("value").cast("decimal(18,2)").alias("value"),
    )
    return coerce_output(df)


@report(
    "request_query",
    f"""
    SELECT o_orderkey, {ISO_TS_MICRO.format('o_orderdate')} AS o_orderdate, c_mktsegment
    FROM {ORDER_CUSTOMER} WHERE o_orderstatus = 'F'
    """,
)
def request_query(spark, folder):
    """A permitted request, the view's name in another case: values as a response shows them."""
    grants = spark.createDataFrame([("v_order_customer", "ada@example.org")], "view string, email string")
    calls = ViewRequests(catalog(spark, folder), AccessRules(grants))
    return calls.query(
        " Ada@Example.org", "V_ORDER_customer", filters=[Filter("o_orderstatus", "eq", "F")],
        select="o_orderkey, o_orderdate, c_mktsegment", limit=None,
    )


@report(
    "query_envelope",
    f"""
    SELECT least(2000, count(*)) AS row_count, count(*) >= 2000 AS maybe_more
    FROM {ORDER_CUSTOMER} WHERE o_orderstatus = 'F'
    """,
)
def query_envelope(spark, folder):
    df = view(spark, folder, "v_Order_Customer")
    rows = query(df, filters=[Filter("o_orderstatus", "eq", "F")], limit=2000)
    return envelope(rows, 2000)


# --- filters --------------------------------------------------------------------------

FILTERS = {
    "filter_eq": ("v_Order_Customer", "o_orderkey, o_orderstatus", ("o_orderstatus", "eq", "F")),
    "filter_ne": ("v_Document_Label", "doc_id, quality", ("quality", "ne", 1)),
    "filter_gt": ("v_Order_Customer", "o_orderkey, o_totalprice", ("o_totalprice", "gt", 250000)),
    "filter_gte": ("v_Lineitem_Order", "l_orderkey, l_partkey, l_quantity", ("l_quantity", "gte", 21)),
    "filter_lt": ("v_Lineitem_Order", "l_orderkey, l_partkey, l_discount", ("l_discount", "lt", 0.05)),
    "filter_lte": ("v_Customer", "c_custkey, c_nationkey", ("c_nationkey", "lte", 5)),
    "filter_between": (
        "v_Order_Customer",
        "o_orderkey, o_orderdate",
        ("o_orderdate", "between", ["1997-01-01", "1997-12-31"]),
    ),
    "filter_in": (
        "v_Order_Customer",
        "o_orderkey, c_mktsegment",
        ("c_mktsegment", "in", ["BUILDING", "MACHINERY"]),
    ),
    "filter_is_null": ("v_Document_Label", "doc_id, lang", ("quality", "is_null", None)),
    "filter_is_not_null": ("v_Document_Label", "doc_id, quality", ("quality", "is_not_null", None)),
    "filter_contains": ("v_Document_Label", "doc_id, n_chars", ("text", "contains", "tion")),
    "filter_startswith": ("v_Document_Label", "doc_id, n_chars", ("text", "startswith", "The ")),
    "filter_endswith": ("v_Document_Label", "doc_id, n_chars", ("text", "endswith", "ing.")),
    "filter_date_text": ("v_Event", "event_id, ts", ("ts", "gte", "2024-01-15T12:00:00")),
}
FILTER_SQL = {
    "filter_eq": f"{ORDER_CUSTOMER} WHERE o_orderstatus = 'F'",
    "filter_ne": f"{DOCUMENT_LABEL} WHERE quality <> 1",
    "filter_gt": f"{ORDER_CUSTOMER} WHERE o_totalprice > 250000",
    "filter_gte": f"{LINEITEM_ORDER} WHERE l_quantity >= 21",
    "filter_lt": f"{LINEITEM_ORDER} WHERE l_discount < CAST(0.05 AS DOUBLE)",
    "filter_lte": "customer WHERE c_nationkey <= 5",
    "filter_between": f"{ORDER_CUSTOMER} WHERE o_orderdate BETWEEN '1997-01-01' AND '1997-12-31'",
    "filter_in": f"{ORDER_CUSTOMER} WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
    "filter_is_null": f"{DOCUMENT_LABEL} WHERE quality IS NULL",
    "filter_is_not_null": f"{DOCUMENT_LABEL} WHERE quality IS NOT NULL",
    "filter_contains": f"{DOCUMENT_LABEL} WHERE contains(text, 'tion')",
    "filter_startswith": f"{DOCUMENT_LABEL} WHERE starts_with(text, 'The ')",
    "filter_endswith": f"{DOCUMENT_LABEL} WHERE suffix(text, 'ing.')",
    "filter_date_text": "events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00'",
}


def _register_filter(name: str) -> None:
    source, columns, condition = FILTERS[name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = view(spark, folder, source)
        return query(df, filters=[Filter(*condition)], select=columns, limit=None)

    report(name, f"SELECT {columns} FROM {FILTER_SQL[name]}")(run)


for _name in FILTERS:
    _register_filter(_name)


@report(
    "filter_multi_and",
    f"""
    SELECT l_orderkey, l_partkey, l_quantity FROM {LINEITEM_ORDER}
    WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_quantity < 24
      AND l_discount BETWEEN CAST(0.05 AS DOUBLE) AND CAST(0.07 AS DOUBLE)
      AND o_orderstatus IN ('F', 'O')
    """,
)
def filter_multi_and(spark, folder):
    conditions = (
        '[{"column": "l_shipdate", "op": "gte", "value": "1996-01-01"},'
        ' {"column": "l_quantity", "op": "lt", "value": 24},'
        ' {"column": "l_discount", "op": "between", "value": [0.05, 0.07]},'
        ' {"column": "o_orderstatus", "op": "in", "value": ["F", "O"]}]'
    )
    df = view(spark, folder, "v_Lineitem_Order")
    return query(df, filters=conditions, select="l_orderkey, l_partkey, l_quantity", limit=None)


@report(
    "filter_legacy",
    f"SELECT o_orderkey, o_custkey FROM {ORDER_CUSTOMER} WHERE o_custkey = 7",
)
def filter_legacy(spark, folder):
    return query(
        view(spark, folder, "v_Order_Customer"),
        filters="[]",
        filter_by_column="o_custkey",
        filter_value="7",
        select="o_orderkey, o_custkey",
        limit=None,
    )


# --- sorts, limits, distinct ------------------------------------------------------------


@report("sort_asc", "SELECT event_id, value, ts FROM events ORDER BY ts")
def sort_asc(spark, folder):
    df = view(spark, folder, "v_Event")
    return query(df, sort_by_column="ts", select="event_id, value, ts", limit=None)


@report(
    "sort_desc",
    f"SELECT doc_id, quality FROM {DOCUMENT_LABEL} ORDER BY quality DESC NULLS LAST",
)
def sort_desc(spark, folder):
    df = view(spark, folder, "v_Document_Label")
    return query(
        df, sort_by_column="quality", sort_order="DESC", select="doc_id, quality", limit=None
    )


@report("query_limit", f"SELECT least(500, count(*)) AS row_count FROM {LINEITEM_ORDER}")
def query_limit(spark, folder):
    """The default limit without a sort: which rows come is open, how many is not."""
    rows = query(view(spark, folder, "v_Lineitem_Order"))
    return rows.agg(F.count("*").alias("row_count"))


@report(
    "query_topk",
    """
    SELECT event_id, ts, value FROM events
    WHERE event_type = 'purchase' ORDER BY ts DESC LIMIT 100
    """,
)
def query_topk(spark, folder):
    return query(
        view(spark, folder, "v_Event"),
        filters=[Filter("event_type", "eq", "purchase")],
        sort_by_column="ts",
        sort_order="desc",
        select="event_id, ts, value",
        limit=100,
    )


@report(
    "query_distinct",
    f"SELECT DISTINCT c_name FROM {ORDER_CUSTOMER} WHERE c_name IS NOT NULL ORDER BY 1 LIMIT 500",
)
def query_distinct(spark, folder):
    return query(view(spark, folder, "v_Order_Customer"), distinct_column="c_name")


@report(
    "query_distinct_filtered",
    f"""
    SELECT DISTINCT quality FROM {DOCUMENT_LABEL}
    WHERE quality IS NOT NULL AND lang = 'en' ORDER BY 1
    """,
)
def query_distinct_filtered(spark, folder):
    return query(
        view(spark, folder, "v_Document_Label"),
        distinct_column="quality",
        filters=[Filter("lang", "eq", "en")],
        limit=None,
    )


# --- aggregates ------------------------------------------------------------------------


@report("agg_count", f"SELECT count(*) AS count FROM {LINEITEM_ORDER}")
def agg_count(spark, folder):
    return aggregate(view(spark, folder, "v_Lineitem_Order"), "COUNT")


@report("agg_sum", f"SELECT round(sum(l_extendedprice), 2) AS sum FROM {LINEITEM_ORDER}")
def agg_sum(spark, folder):
    df = view(spark, folder, "v_Lineitem_Order")
    out = aggregate(df, "sum", agg_column="l_extendedprice")
    return out.select(F.round("sum", 2).alias("sum"))


@report("agg_avg", f"SELECT round(avg(quality), 6) AS avg FROM {DOCUMENT_LABEL}")
def agg_avg(spark, folder):
    out = aggregate(view(spark, folder, "v_Document_Label"), "avg", agg_column="quality")
    return out.select(F.round("avg", 6).alias("avg"))


@report("agg_min", "SELECT min(ts) AS min FROM events")
def agg_min(spark, folder):
    return aggregate(view(spark, folder, "v_Event"), "min", agg_column="ts")


@report("agg_max", f"SELECT max(c_name) AS max FROM {ORDER_CUSTOMER}")
def agg_max(spark, folder):
    return aggregate(view(spark, folder, "v_Order_Customer"), "max", agg_column="c_name")


@report(
    "agg_grouped_count",
    f"SELECT quality, count(*) AS count FROM {DOCUMENT_LABEL} GROUP BY quality",
)
def agg_grouped_count(spark, folder):
    return aggregate(view(spark, folder, "v_Document_Label"), "count", group_by_column="quality")


@report(
    "agg_grouped_sum",
    f"""
    SELECT c_mktsegment, round(sum(o_totalprice), 2) AS sum
    FROM {ORDER_CUSTOMER} GROUP BY c_mktsegment
    """,
)
def agg_grouped_sum(spark, folder):
    df = view(spark, folder, "v_Order_Customer")
    out = aggregate(df, "sum", agg_column="o_totalprice", group_by_column="c_mktsegment")
    return out.withColumn("sum", F.round("sum", 2))


@report(
    "agg_grouped_avg",
    f"""
    SELECT o_orderpriority, round(avg(l_quantity), 4) AS avg
    FROM {LINEITEM_ORDER} GROUP BY o_orderpriority
    """,
)
def agg_grouped_avg(spark, folder):
    df = view(spark, folder, "v_Lineitem_Order")
    out = aggregate(df, "avg", agg_column="l_quantity", group_by_column="o_orderpriority")
    return out.withColumn("avg", F.round("avg", 4))


@report(
    "agg_grouped_min",
    f"SELECT o_custkey, min(o_orderdate) AS min FROM {ORDER_CUSTOMER} GROUP BY o_custkey",
)
def agg_grouped_min(spark, folder):
    df = view(spark, folder, "v_Order_Customer")
    return aggregate(df, "min", agg_column="o_orderdate", group_by_column="o_custkey")


@report(
    "agg_grouped_max",
    f"SELECT lang, max(n_chars) AS max FROM {DOCUMENT_LABEL} GROUP BY lang",
)
def agg_grouped_max(spark, folder):
    df = view(spark, folder, "v_Document_Label")
    return aggregate(df, "max", agg_column="n_chars", group_by_column="lang")


@report(
    "agg_filtered",
    f"""
    SELECT c_mktsegment, round(sum(o_totalprice), 2) AS sum FROM {ORDER_CUSTOMER}
    WHERE o_orderdate BETWEEN '1996-01-01' AND '1998-12-31' GROUP BY c_mktsegment
    """,
)
def agg_filtered(spark, folder):
    out = aggregate(
        view(spark, folder, "v_Order_Customer"),
        "sum",
        agg_column="o_totalprice",
        group_by_column="c_mktsegment",
        filters=[Filter("o_orderdate", "between", ["1996-01-01", "1998-12-31"])],
    )
    return out.withColumn("sum", F.round("sum", 2))
