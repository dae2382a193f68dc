"""Reports, names, cross references and event texts."""

import re

import pytest
from pyspark.sql import functions as F

from vistaflow.functions import names as N
from vistaflow.functions.render import RESOLUTIONS, rendered
from vistaflow.model import DocumentOptions, ViewDef
from vistaflow.operators import quality as Q
from vistaflow.plans.documents import build_documents
from vistaflow.plans.exports import export_profile
from vistaflow.sources.catalog import ViewCatalog


def mapped(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_object_types(spark):
    given = ["v_PersonContact", "V_order_line", "Plain", "v_", "v_ _", "x_v_Y", "v_A b"]
    assert mapped(spark, N.object_type_of, given) == [
        "personContact", "orderline", "plain", "record", "record", "xvY", "ab"
    ]


def test_labels(spark):
    given = ["personContact", "order_line", "URLName", "level2x", "Already Spaced", ""]
    want = ["Person Contact", "Order Line", "U R L Name", "Level2X", "Already  Spaced", ""]
    assert mapped(spark, N.label_of, given) == want


def test_hosts(spark):
    def host(col):
        return N.host_of(col, ("-be.search.example", ".search.example"))

    given = ["https://ab12-be.search.example/api/v1/", " ab12 ", "x.search.example", "http://a/b://c", None]
    assert mapped(spark, host, given) == ["ab12", "ab12", "x", "a", ""]


def test_url_pattern():
    assert N.url_pattern(fixed="http://app/#/home") == "http://app.*"
    assert N.url_pattern(fixed="http://app/x?y=1") == "http://app/x.*"
    assert N.url_pattern(base=" https://e.example/ ") == "https://e.example/.*"


def test_missing_objects_and_databases(spark):
    texts = [
        "Invalid object name 'Image.dbo.Picture'. INVALID OBJECT NAME '[Image].dbo.Other'",
        "Invalid object name 'Image.dbo.Picture'",
        "Invalid object name 'dbo.Local' and 'Not.this.one'",
        "Invalid object name '[].dbo.X'",
        "all good",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    assert [tuple(r) for r in Q.missing_objects(df, "m").collect()] == [
        ("Image.dbo.Picture", 2), ("[Image].dbo.Other", 1), ("[].dbo.X", 1), ("dbo.Local", 1)
    ]
    assert [tuple(r) for r in Q.missing_databases(df, "m").collect()] == [("Image", 3)]


def test_cross_references_equal_brute_force(spark):
    texts = {
        1: "SELECT * FROM Image.dbo.Picture JOIN crm ON 1",
        2: "imagery and my-db, pre_Image",
        3: "Über IMAGE; the My-DB and my db",
        4: "straße Straße x+y MY-DB.",
        5: "",
        6: None,
        7: "the the The " * 50,
    }
    names = ["Image", "CRM", "my-db", "x+y", "über", "straße", "the", "a.b", "my"]
    df = spark.createDataFrame(list(texts.items()), "id int, body string")
    given = spark.createDataFrame([(n,) for n in names], "n string")
    got = {tuple(r) for r in Q.cross_references(df, "id", "body", given).collect()}
    want = {
        (i, n) for i, t in texts.items() for n in names
        if re.search(rf"\b{re.escape(n)}\b", t or "", re.I)
    }
    assert got == want
    phrases = ["my db", "image, the", "select * from image", "JOIN crm ON 1", "the the", "db.", "Straße straße x", "x", "the the the the"]
    more = spark.createDataFrame([(n,) for n in [*names, *phrases, "my db"]], "n string")
    found = [tuple(r) for r in Q.cross_references(df, "id", "body", more).collect()]
    every = {
        (i, n) for i, t in texts.items() for n in [*names, *phrases]
        if re.search(rf"\b{re.escape(n)}\b", t or "", re.I)
    }
    assert set(found) == every and len(found) == len(every) and (2, "image, the") not in every
    plan = Q.cross_references(df, "id", "body", given.where("n <> 'x'"))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("LogicalRDD") == 1  # texts are read once
    single = given.where("n NOT LIKE '%-%' AND n NOT LIKE '%+%' AND n NOT LIKE '%.%'")
    rows = [tuple(r) for r in Q.cross_references(df, "id", "body", single).collect()]
    assert set(rows) == {w for w in want if re.fullmatch(r"\w+", w[1])} and len(rows) == len(set(rows))


def test_stretches_of_words_need_no_step_for_each_word(spark):
    """Stretches from every word on, of the wanted sizes only, by expressions that compile."""
    texts = {1: "a b, a b  c-d a", 2: "x", 3: None, 4: "  É é_1 É!", 5: "a b c d e f g " * 9}
    df = spark.createDataFrame(list(texts.items()), "id int, body string")
    for sizes in ([2], [1, 3], [4]):
        found = Q.word_stretches(df, "id", "body", sizes)
        want = set()
        for i, text in texts.items():
            parts = re.findall(r"\w+|\W+", re.sub(r"^\W+", "", (text or "").lower()))
            words = len(parts[::2])
            want |= {(i, "".join(parts[2 * k : 2 * (k + n) - 1])) for n in sizes for k in range(words - n + 1)}
        got = [tuple(r) for r in found.collect()]
        assert set(got) == want and len(got) == len(want)
        assert "lambdafunction" not in found._jdf.queryExecution().optimizedPlan().toString()
    names = spark.createDataFrame([("a b",), ("c-d a",)], "n string")
    assert {tuple(r) for r in Q.cross_references(df, "id", "body", names).collect()} == {
        (1, "a b"), (1, "c-d a"), (5, "a b")}


SCHEMA = "FirstName string, PersonID int, StartDate date, CompanyTitle string, LastUpdated timestamp_ntz, EventX int"


def test_guesses(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert Q.guess_id(schema) == "PersonID"
    assert Q.guess_titles(schema) == ["FirstName", "CompanyTitle"]
    assert Q.guess_watermark(schema) == "LastUpdated"
    plain = spark.createDataFrame([], "a int, d date").schema
    assert (Q.guess_id(plain), Q.guess_titles(plain), Q.guess_watermark(plain)) == ("a", [], "d")
    assert Q.guess_watermark(spark.createDataFrame([], "a int").schema) is None


def test_measured_guesses(spark):
    rows = [("x", 1, None, None, None, 1), ("yyy", 1, None, None, None, 2), (None, None, None, None, None, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["role"], r["column_name"]): r for r in Q.measured_guesses(df, "v").collect()}
    assert set(got) == {
        ("id", "PersonID"), ("title", "FirstName"), ("title", "CompanyTitle"), ("watermark", "LastUpdated")
    }
    key = got["id", "PersonID"]
    assert (key["row_count"], key["null_count"], key["distinct_count"], key["high"]) == (3, 1, 1, "1")
    assert got["title", "FirstName"]["mean_length"] == 2.0
    assert got["watermark", "LastUpdated"]["null_count"] == 3


def test_profile(spark, tmp_path):
    df = spark.createDataFrame([("ab", 1), (None, 2), ("abcd", None)], "t string, n int")
    got = [tuple(r) for r in Q.profile(df).orderBy("ordinal").collect()]
    assert got == [(1, "t", "string", "YES", 3, 1, 3.0), (2, "n", "int", "YES", 3, 1, None)]
    export_profile(Q.profile(df), str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).count() == 2


@pytest.fixture(scope="module")
def catalog(spark):
    def broken():
        raise RuntimeError("cannot\nbind")

    out = ViewCatalog(spark)
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "id int, w string")
    out.register(ViewDef("v_Good", "good", "id", watermark_column="w"), lambda: rows)
    out.register(ViewDef("v_Bad", "bad", "id"), broken)
    out.register(ViewDef("v_Empty", "empty", "id"), lambda: rows.where("false"))
    return out


def test_health(catalog):
    got = [tuple(r) for r in Q.view_health(catalog, catalog.definitions()).collect()]
    assert got == [
        ("v_Good", True, 2, 4, 1, 1, "d", None),
        ("v_Bad", False, None, None, None, None, None, "cannot bind"),
        ("v_Empty", True, 2, 0, 0, 0, None, None),
    ]


def test_row_counts(catalog):
    got = [tuple(r) for r in Q.view_row_counts(catalog, ["v_Good", "v_Bad", "v_None"]).collect()]
    assert got[:2] == [("v_Good", 4, None), ("v_Bad", None, "cannot bind")]
    assert got[2][1] is None and "not found" in got[2][2]


def test_declared_properties_and_use(spark):
    views = [
        ViewDef("a", "t", "id", property_columns=("x", "y", "x")),
        ViewDef("b", "t", "id", property_columns=("z", "y")),
        ViewDef("c", "off", "id", property_columns=("q",), enabled=False),
    ]
    declared = Q.declared_properties(views)
    assert declared == {"t": ["x", "y", "z"]}
    df = spark.createDataFrame([(1, 5, None), (2, None, None)], "id int, x int, y int")
    docs = build_documents(df, views[0])
    got = sorted(tuple(r) for r in Q.property_use(docs, declared).collect())
    assert got == [("t", "x", 1, 1), ("t", "y", 2, 0), ("t", "z", 3, 0)]


def test_violations(spark):
    view = ViewDef("a", "t", "id", property_columns=("x", "y"))
    df = spark.createDataFrame([(1, 5, 6), (1, 5, None)], "id int, x int, y int")
    docs = build_documents(df, view, DocumentOptions(view_url_base="https://e"), acl_id="all")
    bare = build_documents(df.limit(1), ViewDef("b", "u", "x"))
    found = Q.violations(docs.unionByName(bare), {"t": ["x"]}, N.url_pattern(base="https://e"))
    assert sorted((r["id"], r["rule"], r["detail"] or "") for r in found.collect()) == [
        ("t:1", "duplicate_id", "2"),
        ("t:1", "undeclared_property", "y"),
        ("u:5", "blank_url", ""),
        ("u:5", "no_permissions", ""),
        ("u:5", "undeclared_type", "u"),
    ]


def test_event_texts(spark):
    schema = "connector string, error_type string, message string, timestamp string, run_id string, detail string"
    rows = [("c<1>", "view_fetch", "a & b", "T", "r1", "<trace>"), ("c", "who_knows", "m", "T", None, "")]
    first, second = rendered(spark.createDataFrame(rows, schema)).collect()
    assert first["subject"] == "[c<1>] view_fetch failure"
    assert first["resolution"] == RESOLUTIONS["view_fetch"]
    assert second["resolution"] == RESOLUTIONS["unexpected"]
    assert first["text"].splitlines() == [
        "Connector:   c<1>", "Error type:  view_fetch", "Timestamp:   T", "Message:     a & b", "",
        "Recommended resolution:", "  " + RESOLUTIONS["view_fetch"], "", "Run ID: r1", "", "Detail:", "<trace>",
    ]
    assert second["text"].endswith("Recommended resolution:\n  " + RESOLUTIONS["unexpected"])
    assert "c&lt;1&gt;" in first["html"] and "<pre>&lt;trace&gt;</pre>" in first["html"]
    assert "a &amp; b" in first["html"] and "<pre>" not in second["html"]
    assert first["chat"].endswith("*Run ID:* r1") and "Run ID" not in second["chat"]
