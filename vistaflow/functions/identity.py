"""Emails, user ids and display names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vistaflow.functions.values import null_if_blank, strip


def normalized(text: Column) -> Column:
    """Trimmed lower-case form of an email or view name; null stays null."""
    return F.lower(strip(text.cast("string")))


def user_id(email: Column) -> Column:
    """Hex SHA-256 of the normalized email."""
    return F.sha2(normalized(email), 256)


def display_name(name: Column, email: Column) -> Column:
    return F.coalesce(null_if_blank(name), email)


def emails_in_json(text: Column) -> Column:
    """Normalized emails of a JSON array of strings, in order.

    Entries that are not strings or are blank are left out; text that is not a JSON
    array gives an empty array.
    """
    items = F.try_variant_get(F.try_parse_json(strip(text)), "$", "array<variant>")
    strings = F.transform(
        F.filter(items, lambda v: F.schema_of_variant(v) == "STRING"),
        lambda v: normalized(F.variant_get(v, "$", "string")),
    )
    return F.coalesce(F.filter(strings, lambda e: e != ""), F.array().cast("array<string>"))
