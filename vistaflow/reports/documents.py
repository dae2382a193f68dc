"""Documents built from the sample views: keys, titles, bodies, de-duplication, index states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaflow.functions import documents as D
from vistaflow.functions.names import host_of, label_of, object_type_of, url_pattern
from vistaflow.model import DocumentOptions, ViewDef
from vistaflow.operators.access import attach_readers, reader_list
from vistaflow.operators.dedupe import duplicate_report
from vistaflow.operators.position import page_plan, page_size, with_pages, with_position
from vistaflow.operators.quality import (
    declared_properties,
    document_counts,
    property_use,
    violations,
)
from vistaflow.operators.upsert import diff, upsert
from vistaflow.plans.documents import (
    build_documents,
    documents_of_all_rows,
    permissions,
    preview,
    union_documents,
    with_anonymous_default,
)
from vistaflow.plans.index import find_document
from vistaflow.reports.people import superusers, users
from vistaflow.reports.registry import (
    DOCUMENT_LABEL,
    ISO_TS,
    ISO_TS_MICRO,
    LAST_LINEITEM,
    LINEITEM_ORDER,
    ORDER_CUSTOMER,
    report,
)
from vistaflow.sources.sample import VIEW, VIEWS, catalog, table

BASE = "https://search.example.org/"
OPTIONS = DocumentOptions(datasource="sample", view_url_base=BASE)
LABEL_URL = "https://search.example.org/documentLabel/"


def docs_of(spark: SparkSession, folder: str, name: str, **kwargs) -> DataFrame:
    return build_documents(catalog(spark, folder).frame(name), VIEW[name], OPTIONS, **kwargs)


def all_documents(spark: SparkSession, folder: str, **kwargs) -> DataFrame:
    names = catalog(spark, folder).enabled()
    return union_documents([docs_of(spark, folder, n, **kwargs) for n in names])


def body_field(name: str, kind: str = "string"):
    return F.get_json_object("body", f"$.{name}").cast(kind).alias(name)


# Documents of all enabled views as SQL: catalog place, type, id and title.
def _all_docs_sql(lineitem: str) -> str:
    return f"""
    SELECT 0 AS view_ord, 'customer' AS object_type, 'customer:' || c_custkey AS id,
           c_name || ' – ' || c_mktsegment AS title FROM customer
    UNION ALL SELECT 1, 'orderCustomer', 'orderCustomer:' || o_orderkey,
           concat_ws(' – ', c_name, o_orderpriority) FROM {ORDER_CUSTOMER}
    UNION ALL SELECT 2, 'lineitemOrder', 'lineitemOrder:' || l_orderkey || ':' || l_linenumber,
           o_orderpriority || ' – ' || l_returnflag || ' – ' || l_linestatus FROM {lineitem}
    UNION ALL SELECT 3, 'event', 'event:' || event_id, event_type || ' – ' || user_id FROM events
    UNION ALL SELECT 4, 'documentLabel', 'documentLabel:' || doc_id,
           concat_ws(' – ', source, quality, lang) FROM {DOCUMENT_LABEL}
    """


@report(
    "doc_key",
    f"""
    SELECT doc_id, concat_ws(':', quality, nullif(trim(lang), ''), toxic) AS row_key
    FROM {DOCUMENT_LABEL}
    """,
)
def doc_key(spark, folder):
    df = catalog(spark, folder).frame("v_Document_Label")
    key = D.row_key(df, ("quality", "lang", "no_such_column", "toxic"))
    return df.select("doc_id", key.alias("row_key"))


@report(
    "doc_id",
    f"""
    SELECT doc_id, 'labelled:' || coalesce(CAST(quality AS VARCHAR),
           CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR)) AS id
    FROM {DOCUMENT_LABEL}
    """,
)
def doc_id(spark, folder):
    """Rows without a key take their position among all rows."""
    view = ViewDef("v_Document_Label", "labelled", "quality", order_columns=("doc_id",))
    df = catalog(spark, folder).frame("v_Document_Label").drop("text")
    docs = documents_of_all_rows(df, view)
    return docs.select(body_field("doc_id", "long"), "id")


@report(
    "doc_title",
    f"""
    SELECT doc_id, coalesce(nullif(concat_ws(' – ', quality, toxic), ''),
           'documentLabel:' || doc_id) AS title
    FROM {DOCUMENT_LABEL}
    """,
)
def doc_title(spark, folder):
    df = catalog(spark, folder).frame("v_Document_Label")
    doc_id = D.document_id("documentLabel", D.row_key(df, ("doc_id",)), F.lit(0))
    return df.select("doc_id", D.title(df, ("quality", "toxic"), doc_id).alias("title"))


@report(
    "doc_url",
    f"SELECT 'documentLabel:' || doc_id AS id, '{LABEL_URL}' || doc_id AS view_url FROM documents",
)
def doc_url(spark, folder):
    return docs_of(spark, folder, "v_Document_Label").select("id", "view_url")


@report(
    "doc_url_fixed",
    "SELECT 'event:' || event_id AS id, 'https://home.example.org/#/start' AS view_url FROM events",
)
def doc_url_fixed(spark, folder):
    options = DocumentOptions(view_url=" https://home.example.org/#/start ", view_url_base=BASE)
    df = catalog(spark, folder).frame("v_Event")
    return build_documents(df, VIEW["v_Event"], options).select("id", "view_url")


@report(
    "doc_properties",
    f"""
    WITH d AS (SELECT 'documentLabel:' || doc_id AS id, lang, source, quality, toxic
               FROM {DOCUMENT_LABEL}),
         o AS (SELECT 'orderCustomer:' || o_orderkey AS id, * FROM {ORDER_CUSTOMER})
    SELECT id, 1 AS place, 'lang' AS name, lang AS value FROM d
    UNION ALL SELECT id, 2, 'source', source FROM d
    UNION ALL SELECT id, 3, 'quality', CAST(quality AS VARCHAR) FROM d WHERE quality IS NOT NULL
    UNION ALL SELECT id, 4, 'toxic', CAST(toxic AS VARCHAR) FROM d WHERE toxic IS NOT NULL
    UNION ALL SELECT id, 1, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM o
    UNION ALL SELECT id, 2, 'o_orderstatus', o_orderstatus FROM o
    UNION ALL SELECT id, 3, 'o_orderdate', {ISO_TS.format('o_orderdate')} FROM o
    UNION ALL SELECT id, 4, 'c_mktsegment', c_mktsegment FROM o WHERE c_mktsegment IS NOT NULL
    """,
)
def doc_properties(spark, folder):
    docs = docs_of(spark, folder, "v_Document_Label").unionByName(
        docs_of(spark, folder, "v_Order_Customer")
    )
    listed = docs.select("id", F.posexplode("custom_properties").alias("place", "p"))
    return listed.select("id", (F.col("place") + 1).alias("place"), "p.name", "p.value")


@report(
    "doc_body",
    f"""
    SELECT 'documentLabel:' || doc_id AS id, doc_id, lang, text, quality, toxic
    FROM {DOCUMENT_LABEL}
    """,
)
def doc_body(spark, folder):
    docs = docs_of(spark, folder, "v_Document_Label")
    return docs.select(
        "id",
        body_field("doc_id", "long"),
        body_field("lang"),
        body_field("text"),
        body_field("quality", "int"),
        body_field("toxic", "int"),
    )


@report(
    "doc_preview",
    f"""
    SELECT 'event:' || event_id AS id, event_type || ' – ' || user_id AS title,
           '{BASE}event/' || event_id AS "viewUrl", 3 AS properties, event_id, user_id,
           {ISO_TS_MICRO.format('ts')} AS ts, value, props
    FROM events
    """,
)
def doc_preview(spark, folder):
    seen = preview(docs_of(spark, folder, "v_Event"))

    def field(name: str, kind: str):
        return F.variant_get("body", f"$.{name}", kind).alias(name)

    return seen.select(
        "id",
        "title",
        "viewUrl",
        F.size("customProperties").alias("properties"),
        field("event_id", "long"),
        field("user_id", "long"),
        field("ts", "string"),
        field("value", "double"),
        field("props", "string"),
    )


@report("union_documents", _all_docs_sql(LINEITEM_ORDER))
def union_of_documents(spark, folder):
    return all_documents(spark, folder).select("view_ord", "object_type", "id", "title")


@report(
    "dedupe_last_wins",
    f"""
    SELECT 'lineitemOrder:' || l_orderkey || ':' || l_linenumber AS id, l_partkey, l_suppkey,
           {ISO_TS.format('l_shipdate')} AS l_shipdate
    FROM {LAST_LINEITEM}
    """,
)
def dedupe_last_wins(spark, folder):
    docs = docs_of(spark, folder, "v_Lineitem_Order", keep_last=True)
    return docs.select(
        "id", body_field("l_partkey", "long"), body_field("l_suppkey", "long"), body_field("l_shipdate")
    )


@report(
    "dup_report",
    """
    SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_count,
           CAST(sum(n - 1) AS BIGINT) AS dropped
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    """,
)
def dup_report(spark, folder):
    rows = table(spark, folder, "lineitem").count()
    return duplicate_report(docs_of(spark, folder, "v_Lineitem_Order"), "id", rows)


@report(
    "doc_counts",
    f"""
    SELECT object_type, count(DISTINCT id) AS documents
    FROM ({_all_docs_sql(LINEITEM_ORDER)}) GROUP BY object_type
    """,
)
def doc_counts(spark, folder):
    return document_counts(all_documents(spark, folder, keep_last=True))


@report(
    "doc_lookup",
    f"""
    SELECT 'orderCustomer' AS object_type, 'orderCustomer:77' AS id,
           c_name || ' – ' || o_orderpriority AS title
    FROM {ORDER_CUSTOMER} WHERE o_orderkey = 77
    """,
)
def doc_lookup(spark, folder):
    docs = all_documents(spark, folder)
    found = find_document(docs, "orderCustomer", "orderCustomer:77")
    return found.select("object_type", "id", "title")


@report(
    "custom_builder",
    f"""
    SELECT 'day:' || strftime(o_orderdate, '%Y-%m-%d') AS id, count(*) || ' orders' AS title,
           'daily' AS object_type
    FROM {ORDER_CUSTOMER} GROUP BY o_orderdate
    """,
)
def custom_builder(spark, folder):
    """A builder of its own: one document per day instead of one per row."""

    def per_day(df: DataFrame, *, datasource: str, acl_id: str | None) -> DataFrame:
        days = df.groupBy("o_orderdate").agg(F.count("*").alias("n"))
        nothing = F.lit(None).cast("string")
        return days.select(
            F.lit("daily").alias("object_type"),
            F.lit(datasource).alias("datasource"),
            F.concat(F.lit("day:"), F.col("o_orderdate").cast("date").cast("string")).alias("id"),
            F.concat(F.col("n").cast("string"), F.lit(" orders")).alias("title"),
            nothing.alias("view_url"),
            F.lit(0).alias("created_at"),
            F.lit(0).alias("updated_at"),
            F.to_json(F.struct("n")).alias("body"),
            F.array().cast("array<struct<name:string,value:string>>").alias("custom_properties"),
            permissions(acl_id).alias("permissions"),
        )

    view = ViewDef("v_Order_Customer", "daily", build=per_day)
    docs = build_documents(catalog(spark, folder).frame("v_Order_Customer"), view)
    return docs.select("id", "title", "object_type")


# --- positions and pages ------------------------------------------------------------------


@report(
    "row_position",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
           row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                              l_shipdate) - 1 AS position
    FROM lineitem
    """,
)
def row_position(spark, folder):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return with_position(table(spark, folder, "lineitem").select(*order), order)


@report(
    "upload_pages",
    """
    WITH p AS (SELECT (row_number() OVER (ORDER BY id) - 1) // 500 AS page
               FROM (SELECT 'event:' || event_id AS id FROM events))
    SELECT page, count(*) AS rows, page = 0 AS is_first,
           page = (SELECT max(page) FROM p) AS is_last, page = 0 AS restart
    FROM p GROUP BY page
    """,
)
def upload_pages(spark, folder):
    ids = docs_of(spark, folder, "v_Event").select("id")
    return page_plan(with_pages(ids, "id", page_size(1000, upsert=True)))


# --- index states ---------------------------------------------------------------------------


@report(
    "index_upsert",
    f"""
    SELECT 'orderCustomer:' || o_orderkey AS id,
           CASE WHEN o_orderdate > TIMESTAMP '2000-06-01' THEN o_orderstatus
                ELSE c_name || ' – ' || o_orderpriority END AS title
    FROM {ORDER_CUSTOMER}
    """,
)
def index_upsert(spark, folder):
    """An index up to a date; a later batch updates some of it and adds the rest."""
    rows = catalog(spark, folder).frame("v_Order_Customer")
    view = VIEW["v_Order_Customer"]
    changed = ViewDef("v_Order_Customer", "orderCustomer", "o_orderkey", (), ("o_orderstatus",))
    existing = build_documents(rows.where("o_orderdate <= '2000-12-01'"), view, OPTIONS)
    changes = build_documents(rows.where("o_orderdate > '2000-06-01'"), changed, OPTIONS)
    return upsert(existing, changes).select("id", "title")


@report(
    "index_diff",
    f"""
    SELECT 'orderCustomer:' || o_orderkey AS id,
           CASE WHEN o_orderdate > TIMESTAMP '2000-12-01' THEN 'inserted'
                WHEN o_orderdate < TIMESTAMP '1995-07-01' THEN 'deleted'
                WHEN c_mktsegment = 'BUILDING' THEN 'updated' ELSE 'unchanged' END AS status
    FROM {ORDER_CUSTOMER}
    """,
)
def index_diff(spark, folder):
    rows = catalog(spark, folder).frame("v_Order_Customer")
    view = VIEW["v_Order_Customer"]
    old = build_documents(rows.where("o_orderdate <= '2000-12-01'"), view, OPTIONS)
    moved = F.when(F.col("c_mktsegment") == "BUILDING", "moved").otherwise(F.col("o_orderpriority"))
    newer = rows.where("o_orderdate >= '1995-07-01'").withColumn("o_orderpriority", moved)
    return diff(old, build_documents(newer, view, OPTIONS))


# --- access on documents ----------------------------------------------------------------------


@report(
    "acl_anonymous_default",
    f"""
    SELECT 'documentLabel:' || doc_id AS id, quality IS NULL AS allow_anonymous_access,
           CASE WHEN quality IS NOT NULL THEN 'labelled' END AS acl_id
    FROM {DOCUMENT_LABEL}
    """,
)
def acl_anonymous_default(spark, folder):
    rows = catalog(spark, folder).frame("v_Document_Label")
    view = VIEW["v_Document_Label"]
    listed = build_documents(rows.where("quality IS NOT NULL"), view, OPTIONS, acl_id="labelled")
    bare = build_documents(rows.where("quality IS NULL"), view, OPTIONS)
    docs = with_anonymous_default(listed.unionByName(bare))
    return docs.select("id", "permissions.allow_anonymous_access", "permissions.acl_id")


@report(
    "doc_with_acl",
    f"""
    SELECT id, 'event-users' AS acl_id FROM
    (SELECT 'documentLabel:' || doc_id AS id FROM {DOCUMENT_LABEL})
    """,
)
def doc_with_acl(spark, folder):
    """Documents name their reader list; the list is a table (see acl_merge)."""
    readers = reader_list(users(spark, folder), superusers(spark, folder))
    docs = attach_readers(docs_of(spark, folder, "v_Document_Label"), readers, "event-users")
    return docs.select("id", "permissions.acl_id")


# --- conformance ------------------------------------------------------------------------------


@report(
    "property_definitions",
    f"""
    WITH c AS (SELECT * FROM customer), o AS (SELECT * FROM {ORDER_CUSTOMER}),
         l AS (SELECT * FROM {LINEITEM_ORDER}), d AS (SELECT * FROM {DOCUMENT_LABEL})
    SELECT 'customer' AS object_type, 1 AS place, 'c_custkey' AS name, count(c_custkey) AS documents FROM c
    UNION ALL SELECT 'customer', 2, 'c_nationkey', count(c_nationkey) FROM c
    UNION ALL SELECT 'customer', 3, 'c_mktsegment', count(c_mktsegment) FROM c
    UNION ALL SELECT 'orderCustomer', 1, 'o_custkey', count(o_custkey) FROM o
    UNION ALL SELECT 'orderCustomer', 2, 'o_orderstatus', count(o_orderstatus) FROM o
    UNION ALL SELECT 'orderCustomer', 3, 'o_orderdate', count(o_orderdate) FROM o
    UNION ALL SELECT 'orderCustomer', 4, 'c_mktsegment', count(c_mktsegment) FROM o
    UNION ALL SELECT 'lineitemOrder', 1, 'l_orderkey', count(l_orderkey) FROM l
    UNION ALL SELECT 'lineitemOrder', 2, 'l_partkey', count(l_partkey) FROM l
    UNION ALL SELECT 'lineitemOrder', 3, 'l_shipdate', count(l_shipdate) FROM l
    UNION ALL SELECT 'event', 1, 'user_id', count(user_id) FROM events
    UNION ALL SELECT 'event', 2, 'event_type', count(event_type) FROM events
    UNION ALL SELECT 'event', 3, 'ts', count(ts) FROM events
    UNION ALL SELECT 'documentLabel', 1, 'lang', count(lang) FROM d
    UNION ALL SELECT 'documentLabel', 2, 'source', count(source) FROM d
    UNION ALL SELECT 'documentLabel', 3, 'quality', count(quality) FROM d
    UNION ALL SELECT 'documentLabel', 4, 'toxic', count(toxic) FROM d
    """,
)
def property_definitions(spark, folder):
    return property_use(all_documents(spark, folder), declared_properties(VIEWS))


@report(
    "doc_violations",
    f"""
    WITH d AS (SELECT 'documentLabel:' || doc_id AS id, * FROM {DOCUMENT_LABEL}),
         e AS (SELECT 'event:' || event_id AS id, * FROM events),
         l AS (SELECT 'lineitemOrder:' || l_orderkey || ':' || l_linenumber AS id FROM lineitem)
    SELECT id, 'undeclared_property' AS rule, 'quality' AS detail FROM d WHERE quality IS NOT NULL
    UNION ALL SELECT id, 'no_permissions', NULL FROM d
    UNION ALL SELECT id, 'url_mismatch', 'http://other.example.org/event/' || event_id FROM e
    UNION ALL SELECT id, 'undeclared_type', 'lineitemOrder' FROM l
    UNION ALL SELECT id, 'blank_url', NULL FROM l
    UNION ALL SELECT id, 'undeclared_property', unnest(['l_orderkey', 'l_partkey', 'l_shipdate']) FROM l
    UNION ALL SELECT id, 'duplicate_id', CAST(count(*) AS VARCHAR) FROM l GROUP BY id HAVING count(*) > 1
    """,
)
def doc_violations(spark, folder):
    views = catalog(spark, folder)
    events = DocumentOptions(view_url_base="http://other.example.org")
    docs = union_documents(
        [
            build_documents(views.frame("v_Document_Label"), VIEW["v_Document_Label"], OPTIONS),
            build_documents(views.frame("v_Event"), VIEW["v_Event"], events, acl_id="all"),
            build_documents(
                views.frame("v_Lineitem_Order"), VIEW["v_Lineitem_Order"], acl_id="all"
            ),
        ]
    )
    declared = {
        "documentLabel": ["lang", "source", "toxic"],
        "event": ["user_id", "event_type", "ts"],
    }
    rows = sum(table(spark, folder, t).count() for t in ("documents", "events", "lineitem"))
    return violations(docs, declared, url_pattern(base=BASE), rows)


@report(
    "url_conformance",
    "SELECT page_id, url, regexp_matches(url, '^https://[a-z]+\\.th.*') AS matches FROM pages",
)
def url_conformance(spark, folder):
    pattern = url_pattern(fixed=r"https://[a-z]+\.th#/home")
    pages = table(spark, folder, "pages")
    return pages.select("page_id", "url", F.col("url").rlike(f"^{pattern}").alias("matches"))


@report(
    "url_host",
    """
    WITH h AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS host FROM pages)
    SELECT page_id, CASE WHEN suffix(host, '.example.com') THEN left(host, len(host) - 12)
                         WHEN suffix(host, '.com') THEN left(host, len(host) - 4)
                         WHEN suffix(host, '.example.net') THEN left(host, len(host) - 12)
                         ELSE host END AS host
    FROM h
    """,
)
def url_host(spark, folder):
    suffixes = (".example.com", ".com", ".example.net")
    pages = table(spark, folder, "pages")
    return pages.select("page_id", host_of(F.col("url"), suffixes).alias("host"))


# --- names ------------------------------------------------------------------------------------

_VIEW_NAME_SQL = "'V_' || upper(p_name[1]) || p_name[2:] || '_' || p_type || '  _' || p_size"


def _view_names(spark, folder):
    """Names in the style of views, one per part: ``V_Small ring_ECONOMY  _11``."""
    part = table(spark, folder, "part")
    head = F.upper(F.substr("p_name", F.lit(1), F.lit(1)))
    name = F.concat(
        F.lit("V_"),
        head,
        F.substr("p_name", F.lit(2)),
        F.lit("_"),
        "p_type",
        F.lit("  _"),
        F.col("p_size").cast("string"),
    )
    return part.select("p_partkey", name.alias("view_name"))


@report(
    "name_to_object_type",
    f"""
    WITH n AS (SELECT p_partkey, {_VIEW_NAME_SQL} AS view_name FROM part),
         j AS (SELECT *, regexp_replace(view_name[3:], '[_ ]+', '', 'g') AS joined FROM n)
    SELECT p_partkey, view_name, lower(joined[1]) || joined[2:] AS object_type FROM j
    """,
)
def name_to_object_type(spark, folder):
    names = _view_names(spark, folder)
    return names.select("*", object_type_of(F.col("view_name")).alias("object_type"))


@report(
    "name_to_label",
    """
    WITH n AS (SELECT p_partkey, lower(p_type[1]) || lower(p_type[2:]) || upper(p_name[1])
                      || replace(p_name[2:], ' ', '_') AS name FROM part),
         w AS (SELECT *, string_split(trim(regexp_replace(replace(name, '_', ' '),
                      '([A-Z])', ' \\1', 'g')), ' ') AS words FROM n)
    SELECT p_partkey, name,
           array_to_string(list_transform(words, lambda x: upper(x[1]) || lower(x[2:])), ' ') AS label
    FROM w
    """,
)
def name_to_label(spark, folder):
    head = F.upper(F.substr("p_name", F.lit(1), F.lit(1)))
    tail = F.replace(F.substr("p_name", F.lit(2)), F.lit(" "), F.lit("_"))
    names = table(spark, folder, "part").select(
        "p_partkey", F.concat(F.lower("p_type"), head, tail).alias("name")
    )
    return names.select("*", label_of(F.col("name")).alias("label"))
