"""Row-to-document cases: ids, titles, URLs, bodies, properties, de-duplication."""

import datetime
import decimal
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaflow.functions import documents as D
from vistaflow.functions.values import iso_text, iso_with_offset
from vistaflow.model import DOCUMENT_SCHEMA, DocumentOptions, ViewDef
from vistaflow.operators.dedupe import (
    COUNTED_ROWS,
    duplicate_keys,
    duplicate_report,
    key_counts,
    last_wins,
    tasks_for,
)
from vistaflow.plans.documents import (
    build_documents,
    documents_of_all_rows,
    lacks_keys,
    needed_columns,
    preview,
    with_anonymous_default,
)

PEOPLE = ViewDef("v_Person", "person", "PersonID", title_columns=("FirstName", "LastName"))


def docs(df, view=PEOPLE, options=DocumentOptions(), **kwargs):
    return build_documents(df, view, options, **kwargs).collect()


def test_basic_rows(spark):
    df = spark.createDataFrame([(1, "Ada", "Lovelace"), (2, "Alan", "Turing")],
                               "PersonID long, FirstName string, LastName string")
    out = sorted(docs(df), key=lambda d: d["id"])
    assert [d["id"] for d in out] == ["person:1", "person:2"]
    assert [d["title"] for d in out] == ["Ada – Lovelace", "Alan – Turing"]
    assert json.loads(out[0]["body"]) == {"FirstName": "Ada", "LastName": "Lovelace", "PersonID": 1}
    assert build_documents(df, PEOPLE).schema.simpleString() == DOCUMENT_SCHEMA.simpleString()


def test_no_key_column_uses_position(spark):
    view = ViewDef("v", "person", "PersonID", order_columns=("FirstName",))
    df = spark.createDataFrame([("NoId",), ("Other",)], "FirstName string")
    assert lacks_keys(df, view)
    out = documents_of_all_rows(df, view).collect()
    assert sorted((d["id"], d["title"]) for d in out) == [
        ("person:0", "person:0"), ("person:1", "person:1")
    ]


def test_no_key_and_no_order_uses_content(spark):
    df = spark.createDataFrame([("NoId",), ("Other",)], "FirstName string")
    first, again = ({d["id"] for d in docs(df)} for _ in range(2))
    assert len(first) == 2 and first == again


def test_copies_of_a_row_without_a_key_are_all_kept(spark):
    rows = [(None, "same")] * 300 + [(None, f"n{i}") for i in range(50)] + [(7, "keyed")]
    df = spark.createDataFrame(rows, "PersonID int, FirstName string").repartition(8)
    one, two = (documents_of_all_rows(df, PEOPLE, keep_last=True).collect() for _ in range(2))
    assert len({d["id"] for d in one}) == len(one) == 351
    assert {d["id"] for d in one} == {d["id"] for d in two}
    assert sum(d["title"] == "same" for d in one) == 300
    distinct = spark.createDataFrame([(None, "a"), (None, "b")], "PersonID int, FirstName string")
    assert {d["id"] for d in documents_of_all_rows(distinct, PEOPLE).collect()} == {
        d["id"] for d in docs(distinct)
    }


def test_complete_keys_fail_on_a_missing_key(spark):
    view = ViewDef("v", "person", "PersonID", complete_keys=True)
    df = spark.createDataFrame([(1,), (None,)], "PersonID long")
    with pytest.raises(Exception, match="row without a key"):
        docs(df, view)


def test_rows_dealt_by_a_key_column_are_not_dealt_again(spark):
    """The last row of each key is picked where a join has put it: two shuffles, not three."""
    view = ViewDef("v", "line", id_columns=("k", "n"), order_columns=("x",), complete_keys=True)
    lines = spark.range(400).selectExpr("id % 50 AS k", "id % 3 AS n", "id AS x")
    heads = spark.range(50).selectExpr("id AS k", "id AS h")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = build_documents(lines.join(heads, "k"), view, keep_last=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {d["id"]: json.loads(d["body"])["x"] for d in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2
    assert got == {f"line:{i % 50}:{i % 3}": i for i in range(400)} and len(got) == 150


def test_keys_with_null_parts_are_compared_as_keys(spark):
    view = ViewDef("v", "line", id_columns=("k", "n"), order_columns=("x",), complete_keys=True)
    df = spark.createDataFrame([(None, 5, 1), (5, None, 2), (5, 6, 3), (5, 6, 4)], "k long, n long, x int")
    got = {d["id"]: json.loads(d["body"])["x"] for d in docs(df, view, keep_last=True)}
    assert got == {"line:5": 2, "line:5:6": 4} and len(docs(df, view, keep_last=True)) == 2


def test_composite_key_skips_null_and_blank(spark):
    view = ViewDef("v", "travel", "Record", ("PersonID", "Event", "Record"))
    rows = [(1, "EV26", "AA100"), (1, "EV26", "AA200"), (2, None, " X "), (3, "  ", None)]
    df = spark.createDataFrame(rows, "PersonID int, Event string, Record string")
    assert sorted(d["id"] for d in docs(df, view)) == [
        "travel:1:EV26:AA100", "travel:1:EV26:AA200", "travel:2:X", "travel:3"
    ]


def test_nan_key_and_title_count_as_missing(spark):
    view = ViewDef("v", "n", "a", ("a", "b"), ("a", "b"))
    df = spark.createDataFrame([(float("nan"), 7)], "a double, b int")
    (d,) = docs(df, view)
    assert (d["id"], d["title"]) == ("n:7", "7")
    assert json.loads(d["body"]) == {"a": None, "b": 7}


def test_blank_title_part_is_kept(spark):
    df = spark.createDataFrame([(1, "", "L")], "PersonID int, FirstName string, LastName string")
    assert docs(df)[0]["title"] == " – L"


def test_body_values(spark):
    schema = ("PersonID int, day date, at timestamp_ntz, part timestamp_ntz, amount decimal(18,2),"
              " score double, ok boolean, missing string, raw binary")
    when = datetime.datetime(2025, 1, 1)
    row = (1, when.date(), when, when.replace(microsecond=500000), decimal.Decimal("3.50"), 3.5,
           True, None, bytearray(b"x"))
    (d,) = docs(spark.createDataFrame([row], schema))
    assert json.loads(d["body"]) == {
        "PersonID": 1, "day": "2025-01-01", "at": "2025-01-01T00:00:00",
        "part": "2025-01-01T00:00:00.500000", "amount": 3.5, "score": 3.5, "ok": True,
        "missing": None, "raw": "x",
    }
    assert list(json.loads(d["body"])) == sorted(json.loads(d["body"]))


def test_iso_of_instants_and_offsets(spark):
    df = spark.sql("SELECT timestamp'2026-05-04 09:00:00Z' AS t, "
                   "timestamp_ntz'2026-05-04 14:00:00.25' AS n, -330 AS m")
    row = df.select(
        iso_text(F.col("t"), T.TimestampType()), iso_with_offset(F.col("n"), F.col("m"))
    ).first()
    assert tuple(row) == ("2026-05-04T09:00:00+00:00", "2026-05-04T08:30:00.250000-05:30")


def test_urls(spark):
    df = spark.createDataFrame([(7,)], "PersonID int")

    def url(**kwargs):
        return docs(df, options=DocumentOptions(**kwargs))[0]["view_url"]

    assert url(view_url_base="https://x.example/") == "https://x.example/person/7"
    assert url(view_url="https://x.example/#/home", view_url_base="https://y") == (
        "https://x.example/#/home"
    )
    assert url() is None
    assert url(view_url="  ") is None


def test_properties(spark):
    view = ViewDef("v", "p", "id", property_columns=("id", "gone", "day", "empty", "name"))
    df = spark.createDataFrame(
        [(1, datetime.date(2025, 3, 4), None, "n")], "id int, day date, empty string, name string"
    )
    (d,) = docs(df, view)
    assert [tuple(p) for p in d["custom_properties"]] == [
        ("id", "1"), ("day", "2025-03-04"), ("name", "n")
    ]
    assert docs(df, ViewDef("v", "p", "id"))[0]["custom_properties"] == []


def test_exclusion_touches_the_body_only(spark):
    schema = "PersonID int, FirstName string, LicenseName string, LicenseState string, DOB date, Diet string"
    df = spark.createDataFrame([(1, "Ada", "a", "b", None, "none")], schema)
    options = DocumentOptions(exclude_columns=("license*", "dob", " ", "first????"))
    (d,) = docs(df, options=options)
    assert set(json.loads(d["body"])) == {"PersonID", "Diet"}
    assert d["title"] == "Ada"
    assert D.kept_columns(["A1", "A2", "B"], ["a[1]"]) == ["A2", "B"]


def test_needed_columns_drop_what_is_excluded(spark):
    df = spark.createDataFrame([(1, "x", "y")], "PersonID int, Secret string, LastName string")
    kept = needed_columns(df, PEOPLE, DocumentOptions(exclude_columns=("secret", "lastname")))
    assert kept.columns == ["PersonID", "LastName"]


def test_permissions(spark):
    df = spark.createDataFrame([(1,)], "PersonID int")
    assert docs(df)[0]["permissions"] is None
    assert docs(df, acl_id="all")[0]["permissions"]["acl_id"] == "all"
    opened = with_anonymous_default(build_documents(df, PEOPLE)).first()
    assert opened["permissions"]["allow_anonymous_access"] is True


def test_last_row_of_an_id_wins(spark):
    view = ViewDef("v", "p", "id", title_columns=("t",), watermark_column="w", order_columns=("o",))
    df = spark.createDataFrame(
        [(1, 1, 1, "old"), (1, 2, 1, "new"), (1, 2, 0, "mid"), (2, None, 5, "only")],
        "id int, w int, o int, t string",
    )
    out = docs(df, view, keep_last=True)
    assert {d["id"]: d["title"] for d in out} == {"p:1": "new", "p:2": "only"}


def test_dedupe_is_idempotent_and_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "id string, n int")
    once = last_wins(df, "id", ["n"])
    assert sorted(once.collect()) == sorted(last_wins(once, "id", ["n"]).collect())
    assert tuple(duplicate_report(df, "id").first()) == (3, 2, 1)
    assert [tuple(r) for r in duplicate_keys(df, "id").collect()] == [("a", 2)]
    assert tuple(duplicate_report(df.where("false"), "id").first()) == (0, 0, 0)


def test_keys_are_counted_in_tasks_that_do_not_grow_with_the_table(spark):
    """No task keeps a table of all keys of its split: they are dealt first, by enough tasks."""
    assert tasks_for(0) == tasks_for(8 * COUNTED_ROWS) == 8
    assert all(n / tasks_for(n) <= COUNTED_ROWS for n in (4_000_001, 42_000_000, 252_000_000))
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', if(id = 1, null, string(id div 2))) AS k")
    want = Counter(r["k"] for r in df.collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        for rows in (None, 10 * COUNTED_ROWS):
            assert {r["k"]: r["copies"] for r in key_counts(df, "k", rows).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    counts = key_counts(df, "k", 10 * COUNTED_ROWS)
    above, below = counts._jdf.queryExecution().executedPlan().toString().split("Exchange hash")
    assert "Aggregate" in above and "Aggregate" not in below and ", 10)" in below.splitlines()[0]


def test_colliding_composite_keys_are_reported(spark):
    view = ViewDef("v", "p", id_columns=("a", "b", "c"))
    df = spark.createDataFrame([(1, None, 2), (1, 2, None)], "a int, b int, c int")
    assert tuple(duplicate_report(build_documents(df, view), "id").first()) == (2, 1, 1)


def test_custom_builder_is_checked(spark):
    df = spark.createDataFrame([(1,)], "PersonID int")
    with pytest.raises(ValueError, match="lacks document columns"):
        build_documents(df, ViewDef("v", "p", build=lambda d, **_: d))


def test_custom_builder_gets_datasource_and_readers(spark):
    def build(df, *, datasource, acl_id):
        inner = ViewDef("v", "inner", "PersonID")
        return build_documents(df, inner, DocumentOptions(datasource), acl_id=acl_id)

    df = spark.createDataFrame([(1,), (1,)], "PersonID int")
    options = DocumentOptions("crm", exclude_columns=("*",))
    (d,) = docs(df, ViewDef("v", "p", build=build), options, acl_id="all", keep_last=True)
    assert (d["id"], d["datasource"], d["permissions"]["acl_id"]) == ("inner:1", "crm", "all")
    assert json.loads(d["body"]) == {"PersonID": 1}


def test_preview(spark):
    view = ViewDef("v", "p", id_columns=("a", "b"), property_columns=("b",))
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    out = preview(build_documents(df, view, DocumentOptions(view_url_base="https://e")))
    row = json.loads(out.select(F.to_json(F.struct("*"))).first()[0])
    assert row == {
        "id": "p:1:x", "title": "p:1:x", "viewUrl": "https://e/p/1:x",
        "customProperties": [{"name": "b", "value": "x"}], "body": {"a": 1, "b": "x"},
    }
