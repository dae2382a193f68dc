"""Calls on named views behind the access rules, and the session helpers."""

import pytest

from vistaflow import AccessRules, Filter, ViewCatalog, ViewRequests
from vistaflow.operators.position import with_pages
from vistaflow.plans.users import replace_users, user_table
from vistaflow.model import ViewDef
from vistaflow.sources.readers import jdbc_options, parquet_view, table_catalog
from vistaflow.session import RECOMMENDED, new_folder, shared_folder, sized_settings, staged


@pytest.fixture(scope="module")
def catalog(spark):
    out = ViewCatalog(spark)
    out.register("v_Lots", lambda: spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"))
    out.register("v_Other", lambda: spark.range(3).toDF("id"))
    return out


def test_calls_need_a_grant(spark, catalog):
    grants = spark.createDataFrame([("v_lots", "a@x.example")], "view string, email string")
    calls = ViewRequests(catalog, AccessRules(grants, ("root@x.example",)))
    assert calls.query("A@x.example ", "v_Lots", filters=[Filter("id", "gt", 1)]).count() == 1
    assert calls.aggregate("a@x.example", "v_Lots", "count").first()[0] == 2
    assert calls.columns("ROOT@x.example", "v_Other").count() == 1
    assert [r[0] for r in calls.views().collect()] == ["v_Lots", "v_Other"]
    assert calls.query("a@x.example", "V_LOTS", limit=1).count() == 1
    assert tuple(calls.query_envelope("a@x.example", "v_lots", limit=1).first()) == (1, True)
    assert tuple(calls.query_envelope("a@x.example", "v_lots").first()) == (2, False)
    with pytest.raises(PermissionError):
        calls.query("a@x.example", "v_Other")
    with pytest.raises(PermissionError):
        calls.columns("a@x.example", "v_Gone")
    with pytest.raises(LookupError):
        calls.query("root@x.example", "v_Gone")
    with pytest.raises(ValueError):
        calls.query("root@x.example", "v_Lots; x")


def test_rules_without_grants(catalog):
    assert ViewRequests(catalog, AccessRules(all_access=True)).query("x", "v_Lots").count() == 2
    assert AccessRules(superusers=("R@x",)).allow("r@x ", "v_Lots")
    assert not AccessRules().allow("r@x", "v_Lots")


def test_user_list_is_replaced_but_never_emptied(spark, tmp_path):
    table = user_table(spark, str(tmp_path / "users"))
    rows = [(str(i), f"u{i}@x", f"U{i}", True) for i in range(5)]
    users = spark.createDataFrame(rows, table.schema)
    assert replace_users(table, users)
    assert replace_users(table, users.where("user_id > '2'"))
    assert not replace_users(table, users.where("false"))
    assert sorted(r["user_id"] for r in table.read().collect()) == ["3", "4"]
    assert {r["page"] for r in with_pages(users, "user_id", 2).collect()} == {0, 1, 2}


def test_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert staged(spark.range(7), "t").count() == 7


def test_table_catalog(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS rpt")
    spark.range(4).toDF("id").write.mode("overwrite").saveAsTable("rpt.v_One")
    spark.range(2).toDF("id").write.mode("overwrite").saveAsTable("default.v_Two")
    views = [ViewDef("v_One", "one", "id", schema="rpt"), ViewDef("v_Two", "two", "id")]
    found = table_catalog(spark, views, "default")
    assert {n: df.count() for n, df in found.enabled().items()} == {"v_One": 4, "v_Two": 2}


def test_parquet_view(spark, tmp_path):
    load = parquet_view(spark, str(tmp_path / "p"))
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert load().count() == 3


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "rpt", "v_One")
    assert plain == {"url": "jdbc:x", "dbtable": "rpt.v_One", "fetchsize": "10000"}
    split = jdbc_options("jdbc:x", "rpt", "v_One", split_column="id", lower="0", upper="9", splits=4)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "rpt", "v_One; DROP")


def test_sized_settings():
    small, large = sized_settings(1, 8), sized_settings(100 * 10**12, 4000)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert small[key] == "16"
    assert int(large[key]) == 100_000
    assert sized_settings(10**12, 8)[key] == "7451"
    assert RECOMMENDED["spark.sql.adaptive.skewJoin.enabled"] == "true"
