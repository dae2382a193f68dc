"""Health, profiles, cross references and failure reports on the sample views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaflow.functions.render import RESOLUTIONS, rendered, with_resolution
from vistaflow.functions.values import iso_text
from vistaflow.model import ViewDef
from vistaflow.operators import quality as Q
from vistaflow.reports.registry import (
    DOCUMENT_LABEL,
    ISO_TS_MICRO,
    LINEITEM_ORDER,
    ORDER_CUSTOMER,
    report,
)
from vistaflow.sources.sample import VIEWS, catalog, document_label, error_message, error_rows, table

# Kinds of failure by event type; the last one is not a known kind.
KINDS = {"error": "view_fetch", "view": "api_request", "click": "db_connection", "signup": "other"}


@report(
    "view_row_counts",
    f"""
    SELECT 'v_Customer' AS view_name, count(*) AS row_count, false AS failed FROM customer
    UNION ALL SELECT 'v_Order_Customer', count(*), false FROM {ORDER_CUSTOMER}
    UNION ALL SELECT 'v_Lineitem_Order', count(*), false FROM {LINEITEM_ORDER}
    UNION ALL SELECT 'v_Event', count(*), false FROM events
    UNION ALL SELECT 'v_Document_Label', count(*), false FROM {DOCUMENT_LABEL}
    UNION ALL SELECT 'v_Page', count(*), false FROM pages
    UNION ALL SELECT 'v_Part', count(*), false FROM part
    UNION ALL SELECT 'v_Missing', NULL, true
    """,
)
def view_row_counts(spark, folder):
    views = catalog(spark, folder)
    views.register("v_Missing", lambda: table(spark, folder, "no_such_table"))
    names = [v.view_name for v in VIEWS] + ["v_Missing"]
    counts = Q.view_row_counts(views, names)
    return counts.select("view_name", "row_count", F.col("error").isNotNull().alias("failed"))


@report(
    "view_health",
    f"""
    SELECT 'v_Lineitem_Order' AS view_name, true AS ok, 14 AS column_count, row_count,
           CAST(0 AS BIGINT) AS null_keys, duplicate_keys, newest_watermark
    FROM (SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_keys,
                 CAST(max(m) AS VARCHAR) AS newest_watermark
          FROM (SELECT count(*) AS n, max(l_shipdate) AS m FROM {LINEITEM_ORDER}
                GROUP BY l_orderkey, l_linenumber))
    UNION ALL
    SELECT 'v_Document_Label', true, 7, count(*), count(*) - count(quality),
           count(quality) - count(DISTINCT quality), NULL FROM {DOCUMENT_LABEL}
    UNION ALL
    SELECT 'v_Missing', false, NULL, NULL, NULL, NULL, NULL
    """,
)
def view_health(spark, folder):
    views = catalog(spark, folder)
    missing = ViewDef("v_Missing", "missing", "id")
    views.register(missing, lambda: table(spark, folder, "no_such_table"))
    labelled = ViewDef("v_Document_Label", "labelled", "quality")
    health = Q.view_health(views, [views.definition("v_Lineitem_Order"), labelled, missing])
    return health.drop("error")


@report(
    "profile_columns",
    f"""
    WITH d AS (SELECT * FROM {DOCUMENT_LABEL}), n AS (SELECT count(*) AS row_count FROM d)
    SELECT 1 AS ordinal, 'doc_id' AS column_name, 'bigint' AS data_type, row_count,
           CAST(0 AS BIGINT) AS null_count, CAST(NULL AS DOUBLE) AS mean_length FROM n
    UNION ALL SELECT 2, 'text', 'string', row_count, (SELECT count(*) - count(text) FROM d),
           (SELECT sum(len(text)) / count(text) FROM d) FROM n
    UNION ALL SELECT 3, 'lang', 'string', row_count, (SELECT count(*) - count(lang) FROM d),
           (SELECT sum(len(lang)) / count(lang) FROM d) FROM n
    UNION ALL SELECT 4, 'source', 'string', row_count, (SELECT count(*) - count(source) FROM d),
           (SELECT sum(len(source)) / count(source) FROM d) FROM n
    UNION ALL SELECT 5, 'n_chars', 'bigint', row_count, (SELECT count(*) - count(n_chars) FROM d), NULL FROM n
    UNION ALL SELECT 6, 'quality', 'int', row_count, (SELECT count(*) - count(quality) FROM d), NULL FROM n
    UNION ALL SELECT 7, 'toxic', 'int', row_count, (SELECT count(*) - count(toxic) FROM d), NULL FROM n
    """,
)
def profile_columns(spark, folder):
    return Q.profile(document_label(spark, folder)).drop("is_nullable")


@report(
    "profile_guess",
    """
    SELECT 'v_Event' AS view_name, 'id' AS role, 'event_id' AS column_name, count(*) AS row_count,
           count(*) - count(event_id) AS null_count, count(DISTINCT event_id) AS distinct_count,
           CAST(min(event_id) AS VARCHAR) AS low, CAST(max(event_id) AS VARCHAR) AS high,
           CAST(NULL AS DOUBLE) AS mean_length FROM events
    UNION ALL
    SELECT 'v_Event', 'title', 'event_type', count(*), count(*) - count(event_type), NULL, NULL,
           NULL, avg(len(event_type)) FROM events
    UNION ALL
    SELECT 'v_Event', 'watermark', 'ts', count(*), count(*) - count(ts), count(DISTINCT ts),
           CAST(min(ts) AS VARCHAR), CAST(max(ts) AS VARCHAR), NULL FROM events
    """,
)
def profile_guess(spark, folder):
    return Q.measured_guesses(catalog(spark, folder).frame("v_Event"), "v_Event")


@report(
    "text_cross_refs",
    """
    WITH n AS (SELECT DISTINCT lang AS name FROM documents),
         w AS (SELECT DISTINCT doc_id,
                      unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+')) AS word
               FROM documents)
    SELECT doc_id, name FROM w JOIN n ON word = lower(name)
    """,
)
def text_cross_refs(spark, folder):
    """Language codes that occur as whole words in the texts."""
    documents = table(spark, folder, "documents")
    return Q.cross_references(documents, "doc_id", "text", documents.select("lang"))


_PHRASES_SQL = """
    (SELECT DISTINCT w[i] || ' ' || w[i + 1] AS name
     FROM (SELECT regexp_extract_all(text, '[a-z]+ [a-z]+ [a-z]+', 0)[1] AS s FROM benchmark),
          (SELECT unnest([1, 2]) AS i), LATERAL (SELECT string_split(s, ' ') AS w)
     WHERE s IS NOT NULL)
"""


@report(
    "text_phrase_refs",
    f"""
    WITH t AS (SELECT doc_id, regexp_extract_all(
                   lower(text), '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+') AS l FROM documents),
         g AS (SELECT DISTINCT doc_id, unnest(list_transform(
                   range(1, len(l) - 1), lambda i: l[i] || l[i + 1] || l[i + 2])) AS s FROM t)
    SELECT doc_id, name FROM g JOIN {_PHRASES_SQL} ON s = name
    """,
)
def text_phrase_refs(spark, folder):
    """Phrases of two words, taken from the benchmark, that occur in the texts."""
    sample = F.regexp_extract("text", "[a-z]+ [a-z]+ [a-z]+", 0)
    words = F.split(sample, " ")
    pair = F.explode(F.array(*[F.concat_ws(" ", words[i], words[i + 1]) for i in (0, 1)]))
    phrases = table(spark, folder, "benchmark").where(sample != "").select(pair.alias("name"))
    return Q.cross_references(table(spark, folder, "documents"), "doc_id", "text", phrases)


_MISSING_SQL = """
    (SELECT '[Store' || json_extract_string(props, '$.k') || '].dbo.T' || user_id AS name
     FROM events WHERE event_type IN ('error', 'view')
     UNION ALL SELECT 'dbo.T' || user_id FROM events WHERE event_type = 'view')
"""


@report("missing_objects", f"SELECT name, count(*) AS count FROM {_MISSING_SQL} GROUP BY name")
def missing_objects(spark, folder):
    return Q.missing_objects(error_rows(spark, folder), "message")


@report(
    "missing_databases",
    f"""
    SELECT replace(replace(split_part(name, '.', 1), '[', ''), ']', '') AS name, count(*) AS count
    FROM {_MISSING_SQL} WHERE name LIKE '%.%.%' GROUP BY 1
    """,
)
def missing_databases(spark, folder):
    return Q.missing_databases(error_rows(spark, folder), "message")


# --- failure events -----------------------------------------------------------------------

_KIND_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in KINDS.items()) + " ELSE event_type END"
_RESOLUTION_SQL = (
    "CASE " + _KIND_SQL + " "
    + " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in RESOLUTIONS.items())
    + f" ELSE '{RESOLUTIONS['unexpected']}' END"
)


def failures(spark, folder) -> DataFrame:
    """One failure event per sample event, with a message, a run id and at times a detail."""
    kind = F.col("event_type")
    for event_type, name in KINDS.items():
        kind = F.when(F.col("event_type") == event_type, name).otherwise(kind)
    events = table(spark, folder, "events")
    return events.select(
        "event_id",
        F.lit("sample <a&b>").alias("connector"),
        kind.alias("error_type"),
        error_message().alias("message"),
        iso_text(F.col("ts"), events.schema["ts"].dataType).alias("timestamp"),
        F.when(F.col("value") > 10, F.concat(F.lit("run-"), F.col("user_id"))).alias("run_id"),
        F.when(F.col("value") > 20, F.col("props")).alias("detail"),
    )


@report(
    "event_resolution",
    f"SELECT event_id, {_KIND_SQL} AS error_type, {_RESOLUTION_SQL} AS resolution FROM events",
)
def event_resolution(spark, folder):
    events = with_resolution(failures(spark, folder))
    return events.select("event_id", "error_type", "resolution")


_FAILURE_SQL = f"""
    (SELECT event_id, {_KIND_SQL} AS kind, {_RESOLUTION_SQL} AS fix,
            {ISO_TS_MICRO.format('ts')} AS at_time,
            CASE event_type
              WHEN 'error' THEN '4413: ' || long_name
              WHEN 'view' THEN 'Invalid object name ''dbo.T' || user_id || '''. ' || long_name
              ELSE 'done <' || event_type || '> & ok' END AS message,
            CASE WHEN value > 10 THEN 'run-' || user_id END AS run_id,
            CASE WHEN value > 20 THEN props END AS detail
     FROM (SELECT *, 'invalid object name ''[Store' || json_extract_string(props, '$.k')
                  || '].dbo.T' || user_id || '''' AS long_name FROM events))
"""
_ESC = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@report(
    "event_render",
    f"""
    WITH f AS (SELECT *, '[sample <a&b>] ' || kind || ' failure' AS subject FROM {_FAILURE_SQL})
    SELECT event_id, subject,
      'Connector:   sample <a&b>' || chr(10) || 'Error type:  ' || kind || chr(10)
      || 'Timestamp:   ' || at_time || chr(10) || 'Message:     ' || message || chr(10) || chr(10)
      || 'Recommended resolution:' || chr(10) || '  ' || fix
      || coalesce(chr(10) || chr(10) || 'Run ID: ' || run_id, '')
      || coalesce(chr(10) || chr(10) || 'Detail:' || chr(10) || detail, '') AS text,
      '<h3>' || {_ESC.format('subject')} || '</h3><table>'
      || '<tr><td>Connector</td><td>sample &lt;a&amp;b&gt;</td></tr>'
      || '<tr><td>Error type</td><td>' || kind || '</td></tr>'
      || '<tr><td>Timestamp</td><td>' || at_time || '</td></tr>'
      || '<tr><td>Message</td><td>' || {_ESC.format('message')} || '</td></tr>'
      || '<tr><td>Recommended resolution</td><td>' || {_ESC.format('fix')} || '</td></tr>'
      || coalesce('<tr><td>Run ID</td><td>' || run_id || '</td></tr>', '')
      || '</table>' || coalesce('<pre>' || {_ESC.format('detail')} || '</pre>', '') AS html,
      ':rotating_light: *' || subject || '*' || chr(10) || '*Error type:* ' || kind || chr(10)
      || '*Message:* ' || message || chr(10) || '*Recommended resolution:* ' || fix
      || coalesce(chr(10) || '*Run ID:* ' || run_id, '') AS chat
    FROM f
    """,
)
def event_render(spark, folder):
    """All events; a kind without a resolution of its own gets the fallback."""
    return rendered(failures(spark, folder)).select("event_id", "subject", "text", "html", "chat")
