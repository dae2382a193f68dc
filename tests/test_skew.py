"""One key holds a third of all rows: results are whole and equal brute force."""

import random
from collections import Counter, defaultdict

import pytest

from vistaflow.model import ViewDef
from vistaflow.operators import access as A
from vistaflow.operators.dedupe import duplicate_report, first_wins, last_wins
from vistaflow.operators.upsert import upsert
from vistaflow.plans.documents import build_documents
from vistaflow.plans.query import aggregate
from vistaflow.sources import access as S

N = 6000


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [(0 if i % 3 == 0 else rng.randrange(1, 900), i, rng.randrange(4)) for i in range(N)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k int, n int, g int").repartition(16)


@pytest.fixture(autouse=True)
def split_early(spark):
    """Shuffle joins only, and partitions count as skewed at once."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k in values:
        spark.conf.unset(k)


def test_last_and_first(df, rows):
    last, first = {}, {}
    for k, n, _ in rows:
        last[k] = max(n, last.get(k, -1))
        first[k] = min(n, first.get(k, N))
    assert {r["k"]: r["n"] for r in last_wins(df, "k", ["n"]).collect()} == last
    assert {r["k"]: r["n"] for r in first_wins(df, "k", ["n"]).collect()} == first
    assert tuple(duplicate_report(df, "k").first()) == (N, len(last), N - len(last))


def test_documents_keep_the_last_row(df, rows):
    view = ViewDef("v", "t", "k", title_columns=("n",), order_columns=("n",))
    want = {f"t:{k}": str(max(n for j, n, _ in rows if j == k)) for k in {r[0] for r in rows}}
    docs = build_documents(df, view, keep_last=True)
    assert {r["id"]: r["title"] for r in docs.collect()} == want


def test_groups(df, rows):
    want = Counter(k for k, _, _ in rows)
    got = aggregate(df, "count", group_by_column="k").collect()
    assert {r["k"]: r["count"] for r in got} == want


def test_audit_and_grants(spark, df, rows):
    requests = df.selectExpr(
        "n", "concat('V_', g) AS view_name", "concat('User', k, '@x.example') AS user_email"
    )
    given = [(f"v_{g}", f"user{k}@x.example") for k, _, g in rows if (k + g) % 2 == 0]
    grants = S.grants(spark.createDataFrame(given, "v string, e string"), view="v", email="e")
    supers = spark.createDataFrame([("user7@x.example",)], "email string")
    pairs = set(given)
    got = {r["n"]: r["allowed"] for r in A.audit(requests, grants, supers).collect()}
    assert got == {n: k == 7 or (f"v_{g}", f"user{k}@x.example") in pairs for k, n, g in rows}
    times = {(r["view"], r["email"]): r["times"] for r in A.grants_by_view(grants).collect()}
    assert times == Counter(given)


def test_users(df, rows):
    members = S.memberships(
        df.selectExpr("concat('u', k) AS e", "concat('g', g) AS grp", "concat('N', n) AS nm", "n AS o"),
        email="e", group="grp", name="nm",
    )
    want = defaultdict(set)
    for k, _, g in rows:
        want[f"u{k}"].add(f"g{g}")
    got = A.users_with_groups(members).collect()
    assert {r["email"]: set(r["groups"]) for r in got} == want


def test_upsert_with_shuffle(spark):
    old = spark.range(3000).selectExpr("concat('d', id) AS id", "'old' AS title")
    new = spark.range(2500, 4000).selectExpr("concat('d', id) AS id", "'new' AS title")
    got = Counter(r["title"] for r in upsert(old, new).collect())
    assert got == {"old": 2500, "new": 1500}
