"""Names, labels, hosts and object parts as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vistaflow.functions.values import strip


def object_type_of(view_name: Column) -> Column:
    """``v_OrderLine`` -> ``orderLine``; ``record`` when nothing is left."""
    bare = F.regexp_replace(view_name, r"^[vV]_", "")
    joined = F.regexp_replace(bare, r"[_\s]+", "")
    lowered = F.concat(F.lower(F.substr(joined, F.lit(1), F.lit(1))), F.substr(joined, F.lit(2)))
    return F.when(joined == "", "record").otherwise(lowered)


def label_of(name: Column) -> Column:
    """``orderLine`` or ``order_line`` -> ``Order Line``."""
    parted = F.translate(name, "_", " ")
    spaced = F.regexp_replace(parted, "([A-Z])", " $1")  # a capital begins a word
    words = F.split(strip(spaced), r"(?<=\P{L})")
    return F.array_join(F.transform(words, _capitalized), "")


def _capitalized(word: Column) -> Column:
    head = F.upper(F.substr(word, F.lit(1), F.lit(1)))
    return F.concat(head, F.lower(F.substr(word, F.lit(2))))


def host_of(url: Column, suffixes: Sequence[str] = ()) -> Column:
    """Host of a pasted URL without scheme, path and the first matching suffix."""
    text = strip(F.coalesce(url, F.lit("")))
    after_scheme = F.when(
        F.contains(text, F.lit("://")), F.regexp_extract(text, r"(?s)^.*?://(.*)$", 1)
    ).otherwise(text)
    host = F.substring_index(after_scheme, "/", 1)
    out = host
    for suffix in reversed(suffixes):
        short = F.substr(host, F.lit(1), F.length(host) - len(suffix))
        out = F.when(host.endswith(suffix), short).otherwise(out)
    return out


def url_pattern(fixed: str = "", base: str = "") -> str:
    """The pattern document URLs must match: the fixed URL up to ``#``/``?``, or the base."""
    if fixed:
        return fixed.split("#", 1)[0].split("?", 1)[0].rstrip("/") + ".*"
    return base.strip().rstrip("/") + "/.*"


def missing_object_names(message: Column) -> Column:
    """Every object an error text calls invalid."""
    return F.regexp_extract_all(message, F.lit("(?i)Invalid object name '([^']+)'"), 1)


def database_part(object_name: Column) -> Column:
    """Database of a three- or four-part name without brackets; null for shorter names."""
    parts = F.split(object_name, r"\.")
    first = F.regexp_replace(F.element_at(parts, 1), r"^[\[\]]+|[\[\]]+$", "")
    return F.when(F.size(parts) >= 3, F.nullif(first, F.lit("")))
