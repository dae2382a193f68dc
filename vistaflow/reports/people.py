"""Users, superusers and grants of the sample tables, as plans and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaflow.operators import access as A
from vistaflow.reports.registry import EMAIL
from vistaflow.sources import access as S
from vistaflow.sources.sample import grant_rows, group_rows, superuser_rows

USERS_SQL = f"""
    (SELECT {EMAIL} AS email,
            coalesce(list_sort(list(DISTINCT event_type) FILTER (
                WHERE (event_type IN ('view', 'click') AND user_id % 4 IN (1, 2))
                   OR (event_type IN ('purchase', 'signup') AND user_id % 4 IN (2, 3)))),
                CAST([] AS VARCHAR[])) AS groups,
            max(CASE WHEN event_type = 'signup' AND user_id % 5 <> 0 THEN 'User ' || user_id END) AS name
     FROM events GROUP BY ALL)
"""
SUPERUSERS_SQL = """
    (SELECT DISTINCT lower(CASE WHEN user_id % 10 IN (0, 3) THEN 'User' ELSE 'Ops' END
                           || user_id || '@Example.com') AS email
     FROM events WHERE event_type = 'error' AND value < 20)
"""
GRANTS_SQL = f"""
    (SELECT 'v_day' || day(ts) AS view, {EMAIL} AS email FROM events WHERE event_type = 'purchase')
"""


def users(spark: SparkSession, folder: str) -> DataFrame:
    members = S.memberships(
        group_rows(spark, folder),
        email="Email",
        group="GroupName",
        name="DisplayName",
        order=F.col("ord"),
    )
    return A.users_with_groups(members)


def superusers(spark: SparkSession, folder: str) -> DataFrame:
    return S.superusers(superuser_rows(spark, folder), "raw")


def grants(spark: SparkSession, folder: str) -> DataFrame:
    return S.grants(grant_rows(spark, folder), view="ViewName", email="Email")
