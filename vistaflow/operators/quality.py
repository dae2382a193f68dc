"""Health, profile and conformance reports over views and documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaflow.functions import documents as D
from vistaflow.functions.names import database_part, missing_object_names
from vistaflow.model import ViewDef
from vistaflow.operators.dedupe import duplicate_keys
from vistaflow.operators.lookup import BROADCAST_ROWS, lookup
from vistaflow.session import staged
from vistaflow.sources.catalog import ViewCatalog

# Fragments of column names that suggest a title or a change date.
TITLE_HINTS = ("name", "title", "subject", "firstname", "lastname", "company", "event")
WATERMARK_HINTS = ("modif", "updat", "chang", "lastmod")

HEALTH_SCHEMA = T.StructType(
    [
        T.StructField("view_name", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("column_count", T.IntegerType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("null_keys", T.LongType()),
        T.StructField("duplicate_keys", T.LongType()),
        T.StructField("newest_watermark", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
COUNT_SCHEMA = T.StructType(
    [
        T.StructField("view_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


def _zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def health_plan(df: DataFrame, view: ViewDef) -> DataFrame:
    """One row of key and watermark facts; rows are combined per key before the shuffle."""
    wm = view.watermark_column
    newest = F.max(wm) if wm and wm in df.columns else F.max(F.lit(None).cast("string"))
    keyed = df.withColumn("_key", D.row_key(df, view.key_columns))
    per_key = keyed.groupBy("_key").agg(F.count("*").alias("n"), newest.alias("wm"))
    has_key = F.col("_key") != ""
    return per_key.agg(
        _zero_if_null(F.sum("n")).alias("row_count"),
        _zero_if_null(F.sum(F.when(~has_key, F.col("n")))).alias("null_keys"),
        _zero_if_null(F.sum(F.when(has_key, F.col("n") - 1))).alias("duplicate_keys"),
        F.max("wm").cast("string").alias("newest_watermark"),
    )


def view_health(catalog: ViewCatalog, views: Sequence[ViewDef]) -> DataFrame:
    """Health of each view. Every view is its own job: a broken one is a row, not a stop."""
    rows = []
    for view in views:
        try:
            df = catalog.frame(view.view_name)
            facts = health_plan(df, view).first()
            rows.append((view.view_name, True, len(df.columns), *facts, None))
        except Exception as exc:  # noqa: BLE001 - every kind of failure is reported
            rows.append((view.view_name, False, *[None] * 5, _one_line(exc)))
    return catalog.spark.createDataFrame(rows, HEALTH_SCHEMA)


def view_row_counts(catalog: ViewCatalog, names: Sequence[str]) -> DataFrame:
    """Row count of each view, or the error that counting it gave."""
    rows = []
    for name in names:
        try:
            rows.append((name, catalog.frame(name).count(), None))
        except Exception as exc:  # noqa: BLE001 - every kind of failure is reported
            rows.append((name, None, _one_line(exc)))
    return catalog.spark.createDataFrame(rows, COUNT_SCHEMA)


def _one_line(exc: Exception) -> str:
    return str(exc).replace("\n", " ").strip()


def document_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("object_type").agg(F.count("*").alias("documents"))


# --- profile and guesses ------------------------------------------------------------


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, nulls, mean text length; one pass and no shuffle of rows."""
    fields = df.schema.fields
    aggs = [F.count("*").alias("rows")]
    for i, f in enumerate(fields):
        col = F.col(f"`{f.name}`")
        aggs.append(F.count(col).alias(f"n{i}"))
        length = F.length(col) if isinstance(f.dataType, T.StringType) else F.lit(None)
        aggs.append(F.sum(length.cast("long")).alias(f"len{i}"))
    totals = df.agg(*aggs)
    lines = [
        F.struct(
            F.lit(i + 1).alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit("YES" if f.nullable else "NO").alias("is_nullable"),
            F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
            (F.col(f"len{i}") / F.nullif(F.col(f"n{i}"), F.lit(0))).alias("mean_length"),
        )
        for i, f in enumerate(fields)
    ]
    return totals.select(F.inline(F.array(*lines)))


def guess_id(schema: T.StructType) -> str:
    """First column whose name ends in ``id``, else the first column."""
    named = [f.name for f in schema.fields if f.name.lower().endswith("id")]
    return (named or schema.fieldNames() or [""])[0]


def guess_titles(schema: T.StructType) -> list[str]:
    """First two text columns with a title hint in their name."""
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return [n for n in texts if any(h in n.lower() for h in TITLE_HINTS)][:2]


def guess_watermark(schema: T.StructType) -> str | None:
    """First date-like column with a change hint, else the first date-like column."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    dates = [f.name for f in schema.fields if isinstance(f.dataType, kinds)]
    hinted = [n for n in dates if any(h in n.lower() for h in WATERMARK_HINTS)]
    return (hinted or dates or [None])[0]


def measured_guesses(df: DataFrame, view_name: str) -> DataFrame:
    """The guessed columns of a view, each with facts that confirm or refute the guess."""
    if not df.columns:
        raise ValueError(f"view {view_name!r} has no columns")
    parts = [_value_facts(df, view_name, "id", guess_id(df.schema))]
    parts += [_title_facts(df, view_name, name) for name in guess_titles(df.schema)]
    watermark = guess_watermark(df.schema)
    if watermark:
        parts.append(_value_facts(df, view_name, "watermark", watermark))
    return reduce(DataFrame.unionByName, parts)


def _value_facts(df: DataFrame, view_name: str, role: str, name: str) -> DataFrame:
    """Nulls, distinct values and range of a key or watermark; counted per value first."""
    per_value = df.groupBy(F.col(f"`{name}`").alias("v")).agg(F.count("*").alias("n"))
    facts = per_value.agg(
        _zero_if_null(F.sum("n")).alias("row_count"),
        _zero_if_null(F.sum(F.when(F.col("v").isNull(), F.col("n")))).alias("null_count"),
        F.count("v").alias("distinct_count"),
        F.min("v").cast("string").alias("low"),
        F.max("v").cast("string").alias("high"),
    )
    return facts.select(
        F.lit(view_name).alias("view_name"),
        F.lit(role).alias("role"),
        F.lit(name).alias("column_name"),
        "*",
        F.lit(None).cast("double").alias("mean_length"),
    )


def _title_facts(df: DataFrame, view_name: str, name: str) -> DataFrame:
    """Nulls and mean length of a title column; one pass, nothing grouped."""
    col = F.col(f"`{name}`")
    nothing = F.lit(None).cast("string")
    return df.agg(
        F.count("*").alias("row_count"),
        (F.count("*") - F.count(col)).alias("null_count"),
        F.avg(F.length(col)).alias("mean_length"),
    ).select(
        F.lit(view_name).alias("view_name"),
        F.lit("title").alias("role"),
        F.lit(name).alias("column_name"),
        "row_count",
        "null_count",
        F.lit(None).cast("long").alias("distinct_count"),
        nothing.alias("low"),
        nothing.alias("high"),
        "mean_length",
    )


# --- conformance -----------------------------------------------------------------------


def declared_properties(views: Sequence[ViewDef]) -> dict[str, list[str]]:
    """Property names of each enabled object type, in order of first declaration."""
    declared: dict[str, list[str]] = {}
    for view in views:
        if view.enabled:
            names = declared.setdefault(view.object_type, [])
            names.extend(c for c in dict.fromkeys(view.property_columns) if c not in names)
    return declared


def property_use(docs: DataFrame, declared: Mapping[str, Sequence[str]]) -> DataFrame:
    """Declared properties by type and place, with the number of documents that carry each."""
    spark = docs.sparkSession
    rows = [(t, i, n) for t, names in declared.items() for i, n in enumerate(names, start=1)]
    definitions = spark.createDataFrame(rows, "object_type string, place int, name string")
    names = F.array_distinct("custom_properties.name")
    used = docs.select("object_type", F.explode(names).alias("name"))
    counts = used.groupBy("object_type", "name").agg(F.count("*").alias("documents"))
    out = definitions.join(counts, ["object_type", "name"], "left")
    return out.withColumn("documents", _zero_if_null(F.col("documents")))


def violations(
    docs: DataFrame,
    declared: Mapping[str, Sequence[str]],
    url_pattern: str,
    rows: int | None = None,
) -> DataFrame:
    """Rows (id, rule, detail) for everything an index would refuse.

    All rules about one document are tested in one pass; only ids are shuffled, to find
    those that occur twice. ``rows`` is about the number of documents (see ``key_counts``).
    """
    known = F.lit(None).cast("array<string>")
    for object_type, names in declared.items():
        listed = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        known = F.when(F.col("object_type") == object_type, listed).otherwise(known)
    undeclared = F.array_except(
        F.col("custom_properties.name"), F.coalesce(known, F.array().cast("array<string>"))
    )
    url = F.col("view_url")

    none = F.array().cast("array<struct<rule:string,detail:string>>")

    def found(test: Column, rule: str, detail: Column) -> Column:
        item = F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))
        return F.when(test, F.array(item)).otherwise(none)

    # Conditional one-entry arrays and arrays_zip, unlike lambdas, stay in generated code.
    repeated_rule = F.array_repeat(F.lit("undeclared_property"), F.size(undeclared))
    broken = F.concat(
        found(known.isNull(), "undeclared_type", F.col("object_type")),
        found(F.coalesce(F.trim(url), F.lit("")) == "", "blank_url", url),
        found(~url.rlike(f"^{url_pattern}"), "url_mismatch", url),
        found(F.col("permissions").isNull(), "no_permissions", F.lit(None)),
        F.arrays_zip(repeated_rule.alias("rule"), undeclared.alias("detail")),
    )
    per_document = docs.select("id", F.inline(broken))
    repeated = duplicate_keys(docs, "id", rows).select(
        "id", F.lit("duplicate_id").alias("rule"), F.col("copies").cast("string").alias("detail")
    )
    return per_document.unionByName(repeated)


# --- texts ------------------------------------------------------------------------------


WORD, OTHER = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"


def cross_references(
    texts: DataFrame, id_column: str, text_column: str, names: DataFrame
) -> DataFrame:
    """(id, name) for every name that occurs in a text as a whole word, in any case.

    Each distinct word of a text is matched with the names by an equal join, so texts and names
    are never paired blindly. For names of several words, the stretches of as many words are
    matched beside them, with what lies between the words, in the same pass over the texts.
    Only names that begin or end with another sign are looked for in the text again, and only
    where their first word was found.
    """
    name = F.col(names.columns[0])
    first_word = F.lower(F.regexp_extract(name, f"({WORD}+)", 1))
    wanted = names.select(name.alias("name"), first_word.alias("word")).where("word <> ''").distinct()
    inner = F.regexp("name", F.lit(f"(?s)^{WORD}(.*{WORD})?$"))
    words = F.when(inner, F.size(F.regexp_extract_all("name", F.lit(f"({WORD}+)"), 1))).otherwise(0)
    key = F.when(inner, F.lower("name")).otherwise(F.col("word"))
    wanted = staged(wanted.select("name", words.alias("words"), key.alias("stretch")), "names")
    facts = wanted.agg(F.count("*").alias("rows"), F.collect_set("words").alias("sizes")).first()
    sizes = sorted({n or 1 for n in facts["sizes"]} or {1})
    found = lookup(
        word_stretches(texts, id_column, text_column, sizes),
        wanted,
        ["stretch"],
        "inner",
        small=facts["rows"] <= BROADCAST_ROWS,
    )
    hits = found.where("words > 0").select(id_column, "name")
    if 0 not in facts["sizes"]:
        return hits
    candidates = found.where("words = 0").select(id_column, "name")
    checked = candidates.join(texts.select(id_column, text_column), id_column)
    checked = checked.where(F.regexp(F.col(text_column), whole_word_pattern(F.col("name"))))
    return hits.unionByName(checked.select(id_column, "name"))


def word_stretches(
    texts: DataFrame, id_column: str, text_column: str, sizes: Sequence[int]
) -> DataFrame:
    """(id, stretch): the distinct stretches of so many words of each text, in lower case.

    What lies between the words is part of a stretch.
    """
    tail = F.regexp_replace(F.lower(text_column), f"^{OTHER}+", "")
    if list(sizes) == [1]:
        words = F.array_distinct(F.regexp_extract_all(tail, F.lit(f"({WORD}+)"), 1))
        return texts.select(id_column, F.explode(words).alias("stretch"))

    def of(size: int) -> list[Column]:
        """The stretches from word 0, size, ... on, from word 1, size + 1, ... on, and so forth."""
        stretch = f"({WORD}++(?:{OTHER}++{WORD}++){{{size - 1}}})"
        later = [F.regexp_replace(tail, f"^(?:{WORD}++{OTHER}++){{{k}}}", "") for k in range(1, size)]
        return [F.regexp_extract_all(rest, F.lit(stretch), 1) for rest in (tail, *later)]

    stretches = F.array_distinct(F.concat(*[part for n in sizes for part in of(n)]))
    return texts.select(id_column, F.explode(stretches).alias("stretch"))


def whole_word_pattern(name: Column) -> Column:
    """Pattern for ``name`` in any case with a word boundary at both ends."""
    before = F.when(F.regexp(name, F.lit(f"^{WORD}")), f"(?<!{WORD})").otherwise(f"(?<={WORD})")
    after = F.when(F.regexp(name, F.lit(f"{WORD}$")), f"(?!{WORD})").otherwise(f"(?={WORD})")
    return F.concat(F.lit("(?iu)"), before, F.lit(r"\Q"), name, F.lit(r"\E"), after)


def missing_objects(messages: DataFrame, column: str) -> DataFrame:
    """Objects that error texts call invalid, with counts, most frequent first."""
    names = messages.select(F.explode(missing_object_names(F.col(column))).alias("name"))
    counted = names.groupBy("name").agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "name")


def missing_databases(messages: DataFrame, column: str) -> DataFrame:
    """Databases those objects belong to, with counts, most frequent first."""
    counted = missing_objects(messages, column).select(
        database_part(F.col("name")).alias("name"), "count"
    )
    total = counted.where("name IS NOT NULL").groupBy("name").agg(F.sum("count").alias("count"))
    return total.orderBy(F.desc("count"), "name")
