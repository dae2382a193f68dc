"""Failure events as text: subject, plain text, HTML and chat message columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What to do about each kind of failure; unknown kinds get the last one.
RESOLUTIONS = {
    "db_connection": "Check that the database can be reached and that the login is right.",
    "index_prereqs": "Set the data source and the index location, or run in preview mode.",
    "view_fetch": "Check that the view can be read here; the other views were still indexed.",
    "user_indexing": "Check the user table's location and rights, then run again.",
    "document_indexing": "Check the index location, its quota and rights, then run again.",
    "api_startup": "Check the settings the query service starts with and the database.",
    "api_request": "Check the database and the log of the failing query.",
    "unexpected": "Read the log for the cause; pass it on if it stays unclear.",
}
DEFAULT_KIND = "unexpected"


# The labels and layout of the texts below are fixed values.


def with_resolution(
    events: DataFrame, resolutions: Mapping[str, str] = RESOLUTIONS
) -> DataFrame:
    """Add ``resolution`` by ``error_type``; the map is configuration, a few entries long."""
    pairs = [F.lit(x) for item in resolutions.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), F.col("error_type"))
    return events.withColumn("resolution", F.coalesce(found, F.lit(resolutions[DEFAULT_KIND])))


def escaped(text: Column) -> Column:
    """Text with ``&``, ``<`` and ``>`` made safe for HTML."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def subject() -> Column:
    return F.concat(
        F.lit("["), F.col("connector"), F.lit("] "), F.col("error_type"), F.lit(" failure")
    )


def plain_text() -> Column:
    """All fields of an event, one per line; run id and detail only when present."""
    lines = [
        F.concat(F.lit("Connector:   "), F.col("connector")),
        F.concat(F.lit("Error type:  "), F.col("error_type")),
        F.concat(F.lit("Timestamp:   "), F.col("timestamp")),
        F.concat(F.lit("Message:     "), F.col("message")),
        F.lit(""),
        F.concat(F.lit("Recommended resolution:\n  "), F.col("resolution")),
        F.when(F.col("run_id") != "", F.concat(F.lit("\nRun ID: "), F.col("run_id"))),
        F.when(F.col("detail") != "", F.concat(F.lit("\nDetail:\n"), F.col("detail"))),
    ]
    return F.concat_ws("\n", *lines)


def html() -> Column:
    """A heading, a table of the fields and the detail, all escaped."""

    def row(label: str, value: Column) -> Column:
        cells = [F.lit(f"<tr><td>{label}</td><td>"), escaped(value), F.lit("</td></tr>")]
        return F.concat(*cells)

    rows = [
        row("Connector", F.col("connector")),
        row("Error type", F.col("error_type")),
        row("Timestamp", F.col("timestamp")),
        row("Message", F.col("message")),
        row("Recommended resolution", F.col("resolution")),
        F.when(F.col("run_id") != "", row("Run ID", F.col("run_id"))),
    ]
    detail = F.concat(F.lit("<pre>"), escaped(F.col("detail")), F.lit("</pre>"))
    return F.concat_ws(
        "",
        F.concat(F.lit("<h3>"), escaped(subject()), F.lit("</h3>")),
        F.lit("<table>"),
        *rows,
        F.lit("</table>"),
        F.when(F.col("detail") != "", detail),
    )


def chat() -> Column:
    lines = [
        F.concat(F.lit(":rotating_light: *"), subject(), F.lit("*")),
        F.concat(F.lit("*Error type:* "), F.col("error_type")),
        F.concat(F.lit("*Message:* "), F.col("message")),
        F.concat(F.lit("*Recommended resolution:* "), F.col("resolution")),
        F.when(F.col("run_id") != "", F.concat(F.lit("*Run ID:* "), F.col("run_id"))),
    ]
    return F.concat_ws("\n", *lines)


def rendered(events: DataFrame) -> DataFrame:
    """Events with their resolution and all renderings."""
    return with_resolution(events).withColumns(
        {"subject": subject(), "text": plain_text(), "html": html(), "chat": chat()}
    )
