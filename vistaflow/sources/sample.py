"""Views over the star-schema and text tables of a folder of parquet files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaflow.model import ViewDef
from vistaflow.sources.catalog import ViewCatalog

VIEWS = (
    ViewDef(
        "v_Customer",
        "customer",
        id_column="c_custkey",
        title_columns=("c_name", "c_mktsegment"),
        property_columns=("c_custkey", "c_nationkey", "c_mktsegment"),
        order_columns=("c_custkey",),
        complete_keys=True,
    ),
    ViewDef(
        "v_Order_Customer",
        "orderCustomer",
        id_column="o_orderkey",
        title_columns=("c_name", "o_orderpriority"),
        property_columns=("o_custkey", "o_orderstatus", "o_orderdate", "c_mktsegment"),
        watermark_column="o_orderdate",
        order_columns=("o_orderkey",),
        complete_keys=True,
    ),
    ViewDef(
        "v_Lineitem_Order",
        "lineitemOrder",
        id_columns=("l_orderkey", "l_linenumber"),
        title_columns=("o_orderpriority", "l_returnflag", "l_linestatus"),
        property_columns=("l_orderkey", "l_partkey", "l_shipdate"),
        watermark_column="l_shipdate",
        order_columns=("l_partkey", "l_suppkey"),
        complete_keys=True,
    ),
    ViewDef(
        "v_Event",
        "event",
        id_column="event_id",
        title_columns=("event_type", "user_id"),
        property_columns=("user_id", "event_type", "ts"),
        watermark_column="ts",
        order_columns=("event_id",),
        complete_keys=True,
    ),
    ViewDef(
        "v_Document_Label",
        "documentLabel",
        id_column="doc_id",
        title_columns=("source", "quality", "lang"),
        property_columns=("lang", "source", "quality", "toxic"),
        order_columns=("doc_id",),
        complete_keys=True,
    ),
    ViewDef("v_Page", "page", id_column="page_id", title_columns=("url",), enabled=False),
    ViewDef("v_Part", "part", id_column="p_partkey", title_columns=("p_name",), enabled=False),
)
VIEW = {v.view_name: v for v in VIEWS}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_customer(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    dim = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    joined = orders.join(dim, orders.o_custkey == dim.c_custkey, "left")
    return joined.drop("c_custkey")


def lineitem_order(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    head = orders.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    return lines.join(head, lines.l_orderkey == head.o_orderkey, "inner").drop("o_orderkey")


def document_label(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").join(
        table(spark, folder, "labels"), "doc_id", "left"
    )


def catalog(spark: SparkSession, folder: str) -> ViewCatalog:
    """All sample views, enabled or not, in catalog order."""
    loaders = {
        "v_Customer": lambda: table(spark, folder, "customer"),
        "v_Order_Customer": lambda: order_customer(spark, folder),
        "v_Lineitem_Order": lambda: lineitem_order(spark, folder),
        "v_Event": lambda: table(spark, folder, "events"),
        "v_Document_Label": lambda: document_label(spark, folder),
        "v_Page": lambda: table(spark, folder, "pages"),
        "v_Part": lambda: table(spark, folder, "part"),
    }
    out = ViewCatalog(spark)
    for view in VIEWS:
        out.register(view, loaders[view.view_name])
    return out


def group_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Directory rows (Email, GroupName, DisplayName, ord): one per event of a user.

    Users have all groups, half of them or none by their number; every fifth has no name.
    """
    events = table(spark, folder, "events")
    user, kind = F.col("user_id").cast("string"), F.col("user_id") % 4
    signed_up = (F.col("event_type") == "signup") & (F.col("user_id") % 5 != 0)
    named = F.when(signed_up, F.concat(F.lit(" User "), user))
    reads = F.col("event_type").isin("view", "click") & kind.isin(1, 2)
    buys = F.col("event_type").isin("purchase", "signup") & kind.isin(2, 3)
    return events.select(
        F.concat(F.lit(" User"), user, F.lit("@Example.com ")).alias("Email"),
        F.when(reads | buys, F.col("event_type")).alias("GroupName"),
        named.alias("DisplayName"),
        F.col("event_id").alias("ord"),
    )


def grant_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Permission rows (ViewName, Email): one per purchase, the view named by its day."""
    bought = table(spark, folder, "events").where(F.col("event_type") == "purchase")
    return bought.select(
        F.concat(F.lit("v_Day"), F.dayofmonth("ts").cast("string")).alias("ViewName"),
        F.concat(F.lit("User"), F.col("user_id").cast("string"), F.lit("@Example.com ")).alias("Email"),
    )


def request_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A log of view requests: every event is one; nobody is granted the views of the night."""
    part = F.when(F.hour("ts") < 3, "V_NIGHT").otherwise("V_DAY")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("request_id"),
        F.concat(part, F.dayofmonth("ts").cast("string")).alias("view_name"),
        F.concat(F.lit(" USER"), F.col("user_id").cast("string"), F.lit("@example.COM")).alias("user_email"),
    )


def superuser_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Settings texts: a JSON array with an email, a number and a blank; some are broken.

    A fifth of the emails belong to users, half of those without a name; the others are in
    no directory.
    """
    errors = table(spark, folder, "events").where(F.col("event_type") == "error")
    user = F.col("user_id").cast("string")
    owner = F.when((F.col("user_id") % 10).isin(0, 3), "User").otherwise("Ops")
    mail = F.concat(owner, user, F.lit("@Example.com "))
    good = F.concat(F.lit('["'), mail, F.lit('", '), user, F.lit(', " "]'))
    broken = F.concat(F.lit('["broken'), user)
    return errors.select(F.when(F.col("value") < 20, good).otherwise(broken).alias("raw"))


def error_message() -> Column:
    """Failure message of an event; errors and views name missing objects."""
    number = F.get_json_object("props", "$.k")
    user = F.col("user_id").cast("string")
    long_name = F.concat(F.lit("invalid object name '[Store"), number, F.lit("].dbo.T"), user, F.lit("'"))
    short_name = F.concat(F.lit("Invalid object name 'dbo.T"), user, F.lit("'."))
    return (
        F.when(F.col("event_type") == "error", F.concat(F.lit("4413: "), long_name))
        .when(F.col("event_type") == "view", F.concat(short_name, F.lit(" "), long_name))
        .otherwise(F.concat(F.lit("done <"), F.col("event_type"), F.lit("> & ok")))
    )


def error_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Failure messages that name missing objects, one per event."""
    events = table(spark, folder, "events")
    return events.select("event_id", "event_type", error_message().alias("message"))
