"""Users, superusers, reader lists and access decisions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from vistaflow.operators import access as A
from vistaflow.sources import access as S


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def users(spark):
    rows = [
        ("A@acme.example ", "Readers", None, 1),
        ("a@acme.example", "Analysts", " Ada ", 2),
        ("a@acme.example", "Analysts", "Later", 3),
        ("b@acme.example", " ", None, 4),
        ("b@acme.example", "Readers", "", 5),
        (" ", "Readers", "x", 6),
        (None, "Readers", "x", 7),
    ]
    df = spark.createDataFrame(rows, "Email string, G string, N string, o int")
    return A.users_with_groups(
        S.memberships(df, email="Email", group="G", name="N", order=F.col("o"))
    )


def test_users(users):
    got = {r["email"]: r for r in users.collect()}
    assert set(got) == {"a@acme.example", "b@acme.example"}
    assert got["a@acme.example"]["groups"] == ["Analysts", "Readers"]
    assert got["a@acme.example"]["name"] == "Ada"
    assert got["b@acme.example"]["name"] is None
    assert got["b@acme.example"]["groups"] == ["Readers"]
    assert got["a@acme.example"]["datasource_user_id"] == sha("a@acme.example")


def test_display_names(users):
    got = {r["email"]: r["name"] for r in A.indexable_users(users).collect()}
    assert got == {"a@acme.example": "Ada", "b@acme.example": "b@acme.example"}


@pytest.mark.parametrize(
    "raw, expected",
    [
        ('[" X@Y.example", "x@y.example", 5, "", null, ["n"], "z@y.example"]',
         ["x@y.example", "z@y.example"]),
        ('{"a": 1}', []),
        ('"x@y.example"', []),
        ("[broken", []),
        ("", []),
        ("  [ ] ", []),
        (None, []),
    ],
)
def test_superuser_texts(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw string")
    got = S.superusers(df, "raw").collect()
    assert sorted(r["email"] for r in got) == expected
    assert all(r["datasource_user_id"] == sha(r["email"]) for r in got)


def superusers(spark, *emails):
    return spark.createDataFrame([(sha(e), e) for e in emails], "datasource_user_id string, email string")


def test_superusers_are_added_once(spark, users):
    extra = superusers(spark, "a@acme.example", "root@acme.example")
    got = A.with_superusers(A.indexable_users(users), extra).collect()
    assert sorted(r["email"] for r in got) == ["a@acme.example", "b@acme.example", "root@acme.example"]
    root = next(r for r in got if r["email"] == "root@acme.example")
    assert (root["name"], root["is_active"]) == ("root@acme.example", True)


def test_superuser_known_by_email_under_another_id(spark):
    known = spark.createDataFrame(
        [("other-id", "Root@acme.example", "R", True)],
        "user_id string, email string, name string, is_active boolean",
    )
    got = A.with_superusers(known, superusers(spark, "root@acme.example")).collect()
    assert [r["user_id"] for r in got] == ["other-id"]


def test_reader_list_first_wins(spark):
    schema = "datasource_user_id string, email string"
    base = spark.createDataFrame([("1", "a"), (" 2", "b"), ("", "c"), ("4", " ")], schema)
    extra = spark.createDataFrame([("2", "other"), ("3", "d")], schema)
    got = A.reader_list(base, extra).collect()
    assert sorted((r["datasource_user_id"], r["email"]) for r in got) == [
        (" 2", "b"), ("1", "a"), ("3", "d")
    ]


def test_empty_reader_list_leaves_permissions_null(spark):
    docs = spark.createDataFrame([("d",)], "id string")
    readers = superusers(spark, "x@y.example")
    assert A.attach_readers(docs, readers, "all").first()["permissions"]["acl_id"] == "all"
    assert A.attach_readers(docs, readers.where("false"), "all").first()["permissions"] is None


@pytest.fixture(scope="module")
def grants(spark):
    rows = [("v_Company", "A@x.example"), ("v_Company", " c@x.example "), ("V_Company", "a@x.example"),
            ("v_Person", "a@x.example"), (None, "a@x.example"), ("v_Person", "  ")]
    return S.grants(spark.createDataFrame(rows, "V string, E string"), view="V", email="E")


def test_grants(grants):
    got = [tuple(r) for r in A.grants_by_view(grants).collect()]
    assert got == [
        ("v_company", "a@x.example", 2), ("v_company", "c@x.example", 1), ("v_person", "a@x.example", 1)
    ]


REQUESTS = [
    (1, "V_COMPANY", " C@x.example"),
    (2, "v_Person", "c@x.example"),
    (3, "v_Other", "a@x.example"),
    (4, "v_Other", "Root@x.example"),
    (5, "v_person", None),
]


def test_audit_equals_the_single_rule(spark, grants):
    requests = spark.createDataFrame(REQUESTS, "n int, view_name string, user_email string")
    requests = requests.selectExpr("*", "'kept' AS email")
    supers = superusers(spark, "root@x.example")
    got = {r["n"]: (r["allowed"], r["reason"]) for r in A.audit(requests, grants, supers).collect()}
    assert got == {
        1: (True, "granted"), 2: (False, "not_granted"), 3: (False, "view_not_listed"),
        4: (True, "superuser"), 5: (False, "not_granted"),
    }
    for n, view, email in REQUESTS[:4]:
        assert A.may_access(email, view, grants, ["ROOT@x.example"]) == got[n][0]
    everyone = A.audit(requests, grants, supers, all_access=True).collect()
    assert all(r["allowed"] for r in everyone)
    assert A.may_access("z", "v", grants, all_access=True)
    kept = A.granted_requests(requests, grants).collect()
    assert [(r["n"], r["email"]) for r in kept] == [(1, "kept")]


def test_group_policy(spark, users):
    rules = {"company": ["Analysts"], "person": ["Readers", "Other"], "closed": []}
    got = {(r["email"], r["object_type"]): r["allowed"] for r in A.kinds_by_user(users, rules).collect()}
    assert got[("a@acme.example", "company")] and not got[("b@acme.example", "company")]
    assert got[("b@acme.example", "person")] and not got[("a@acme.example", "closed")]
    docs = spark.createDataFrame(
        [("1", "company"), ("2", "person"), ("3", "closed"), ("4", "unknown")],
        "id string, object_type string",
    )

    def seen(email):
        return sorted(r["id"] for r in A.documents_for_user(docs, users, email, rules).collect())

    assert seen(" A@acme.example") == ["1", "2"]
    assert seen("b@acme.example") == ["2"]
    assert seen("nobody@acme.example") == []


@pytest.mark.parametrize("listed", [0, 1000])
def test_policies_as_a_table_give_what_lists_give(spark, monkeypatch, listed):
    """Thousands of groups, users without any, and types that nobody may read."""
    monkeypatch.setattr(A, "LISTED_KINDS", listed)
    people = [(f"u{i}@x.org", [f"g{k}" for k in range(i, 3000, 97)] or None) for i in range(40)]
    people += [("none@x.org", []), ("null@x.org", None)]
    frame = spark.createDataFrame(people, "email string, groups array<string>")
    allowed = {f"t{k}": [f"g{n}" for n in range(k, 3000, 53 + k)] for k in range(6)} | {"closed": []}
    policy = spark.createDataFrame(
        [(t, g) for t, names in allowed.items() for g in [*names, *names[:1]]], "object_type string, `group` string")
    got = sorted(tuple(r) for r in A.permitted_kinds(frame, policy).collect())
    lists = A.kinds_by_user(frame, allowed).where("allowed").select("email", "object_type")
    assert got == sorted(tuple(r) for r in lists.collect()) and got
    docs = spark.createDataFrame([(f"t{k}", f"t{k}:1") for k in range(6)] + [("closed", "c"), ("new", "n")], "object_type string, id string")
    for email in ("U3@x.org ", "none@x.org", "stranger@x.org"):
        by_table = sorted(r["id"] for r in A.permitted_documents(docs, frame, email, policy).collect())
        assert by_table == sorted(r["id"] for r in A.documents_for_user(docs, frame, email, allowed).collect())
