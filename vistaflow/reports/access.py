"""Users, grants and access decisions over the sample groups, grants and request log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaflow.functions.identity import normalized, user_id
from vistaflow.operators import access as A
from vistaflow.operators.lookup import lookup
from vistaflow.reports.documents import all_documents
from vistaflow.reports.people import (
    GRANTS_SQL,
    SUPERUSERS_SQL,
    USERS_SQL,
    grants,
    superusers,
    users,
)
from vistaflow.reports.registry import DOCUMENT_LABEL, EMAIL, report
from vistaflow.sources.sample import group_rows, order_customer, request_rows, table

ALLOWED = {
    "event": ["purchase", "signup"],
    "documentLabel": ["click"],
    "customer": [],
    "orderCustomer": ["view", "nobody"],
}

REQUESTED = "CASE WHEN hour(ts) < 3 THEN 'V_NIGHT' ELSE 'V_DAY' END || day(ts)"


@report("grants_normalized", f"SELECT * FROM {GRANTS_SQL}")
def grants_normalized(spark, folder):
    return grants(spark, folder)


@report(
    "grants_by_view",
    f"SELECT view, email, count(*) AS times FROM {GRANTS_SQL} GROUP BY view, email",
)
def grants_by_view(spark, folder):
    return A.grants_by_view(grants(spark, folder))


@report(
    "superusers_from_json",
    f"SELECT sha256(email) AS datasource_user_id, email FROM {SUPERUSERS_SQL}",
)
def superusers_from_json(spark, folder):
    return superusers(spark, folder)


@report(
    "users_with_groups",
    f"""
    SELECT sha256(email) AS datasource_user_id, email, array_to_string(groups, ',') AS groups,
           len(groups) AS group_count
    FROM {USERS_SQL}
    """,
)
def users_with_groups(spark, folder):
    return users(spark, folder).select(
        "datasource_user_id",
        "email",
        F.array_join("groups", ",").alias("groups"),
        F.size("groups").cast("long").alias("group_count"),
    )


@report("users_first_name", f"SELECT email, name FROM {USERS_SQL}")
def users_first_name(spark, folder):
    return users(spark, folder).select("email", "name")


@report(
    "user_ids",
    f"SELECT event_id, {EMAIL} AS email, sha256({EMAIL}) AS datasource_user_id FROM events",
)
def user_ids(spark, folder):
    rows = group_rows(spark, folder)
    return rows.select(
        F.col("ord").alias("event_id"),
        normalized(F.col("Email")).alias("email"),
        user_id(F.col("Email")).alias("datasource_user_id"),
    )


@report(
    "users_display",
    f"""
    SELECT sha256(email) AS user_id, email, coalesce(name, email) AS name, true AS is_active
    FROM {USERS_SQL}
    """,
)
def users_display(spark, folder):
    return A.indexable_users(users(spark, folder))


@report(
    "users_plus_superusers",
    f"""
    WITH u AS (SELECT * FROM {USERS_SQL} WHERE name IS NOT NULL),
         s AS (SELECT * FROM {SUPERUSERS_SQL})
    SELECT sha256(email) AS user_id, email, name, true AS is_active FROM u
    UNION ALL
    SELECT sha256(email), email, email, true FROM s WHERE email NOT IN (SELECT email FROM u)
    """,
)
def users_plus_superusers(spark, folder):
    """Users who signed up, and the superusers who did not."""
    signed_up = users(spark, folder).where("name IS NOT NULL")
    return A.with_superusers(A.indexable_users(signed_up), superusers(spark, folder))


@report(
    "acl_merge",
    f"""
    WITH u AS (SELECT email FROM {USERS_SQL} WHERE name IS NOT NULL)
    SELECT sha256(email) AS datasource_user_id, email, 0 AS source FROM u
    UNION ALL
    SELECT sha256(email), email, 1 FROM {SUPERUSERS_SQL}
    WHERE email NOT IN (SELECT email FROM u)
    """,
)
def acl_merge(spark, folder):
    signed_up = users(spark, folder).where("name IS NOT NULL")
    return A.reader_list(signed_up, superusers(spark, folder))


@report(
    "access_allowed",
    f"""
    SELECT event_id AS request_id, {REQUESTED} AS view_name,
           ' USER' || user_id || '@example.COM' AS user_email
    FROM events e
    WHERE EXISTS (SELECT 1 FROM {GRANTS_SQL} g
                  WHERE g.view = lower({REQUESTED}) AND g.email = {EMAIL})
    """,
)
def access_allowed(spark, folder):
    return A.granted_requests(request_rows(spark, folder), grants(spark, folder))


@report(
    "access_audit",
    f"""
    WITH g AS (SELECT DISTINCT * FROM {GRANTS_SQL}),
         r AS (SELECT event_id, lower({REQUESTED}) AS v, {EMAIL} AS m, user_id, ts FROM events),
         x AS (SELECT r.*, CASE WHEN m IN (SELECT email FROM {SUPERUSERS_SQL}) THEN 'superuser'
                    WHEN (v, m) IN (SELECT (view, email) FROM g) THEN 'granted'
                    WHEN v IN (SELECT view FROM g) THEN 'not_granted'
                    ELSE 'view_not_listed' END AS reason FROM r)
    SELECT event_id AS request_id, {REQUESTED} AS view_name,
           ' USER' || user_id || '@example.COM' AS user_email,
           reason IN ('superuser', 'granted') AS allowed, reason
    FROM x
    """,
)
def access_audit(spark, folder):
    return A.audit(request_rows(spark, folder), grants(spark, folder), superusers(spark, folder))


@report(
    "policy_by_group",
    f"""
    SELECT email, 'event' AS object_type, list_has_any(groups, ['purchase', 'signup']) AS allowed
    FROM {USERS_SQL}
    UNION ALL SELECT email, 'documentLabel', list_has_any(groups, ['click']) FROM {USERS_SQL}
    UNION ALL SELECT email, 'customer', false FROM {USERS_SQL}
    UNION ALL SELECT email, 'orderCustomer', list_has_any(groups, ['view', 'nobody'])
    FROM {USERS_SQL}
    """,
)
def policy_by_group(spark, folder):
    return A.kinds_by_user(users(spark, folder), ALLOWED)


@report(
    "docs_visible_to_user",
    f"""
    WITH u AS (SELECT groups FROM {USERS_SQL} WHERE email = 'user7@example.com')
    SELECT 'event:' || event_id AS id FROM events
    WHERE (SELECT list_has_any(groups, ['purchase', 'signup']) FROM u)
    UNION ALL SELECT 'documentLabel:' || doc_id FROM {DOCUMENT_LABEL}
    WHERE (SELECT list_has_any(groups, ['click']) FROM u)
    UNION ALL SELECT 'orderCustomer:' || o_orderkey FROM orders
    WHERE (SELECT list_has_any(groups, ['view', 'nobody']) FROM u)
    """,
)
def docs_visible_to_user(spark, folder):
    docs = all_documents(spark, folder)
    seen = A.documents_for_user(docs, users(spark, folder), "User7@Example.com", ALLOWED)
    return seen.select("id")


# Who may read what as a table: types by user number, groups by what those users did.
POLICY_SQL = (
    "(SELECT DISTINCT CASE user_id % 4 WHEN 0 THEN 'event' WHEN 1 THEN 'documentLabel' "
    "WHEN 2 THEN 'customer' ELSE 'orderCustomer' END AS object_type, event_type AS grp "
    "FROM events WHERE user_id % 9 = 0)"
)


def _policy(spark: SparkSession, folder: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("event", "documentLabel", "customer", "orderCustomer")])
    events = table(spark, folder, "events").where("user_id % 9 = 0")
    kind = F.element_at(kinds, (F.col("user_id") % 4 + 1).cast("int"))
    return events.select(kind.alias("object_type"), F.col("event_type").alias("group"))


@report(
    "policy_table",
    f"""
    SELECT DISTINCT email, object_type
    FROM (SELECT email, unnest(groups) AS grp FROM {USERS_SQL}) JOIN {POLICY_SQL} USING (grp)
    """,
)
def policy_table(spark, folder):
    """Types that users may read, by a policy that is a table."""
    return A.permitted_kinds(users(spark, folder), _policy(spark, folder))


@report(
    "docs_visible_by_policy_table",
    f"""
    WITH k AS (SELECT DISTINCT object_type
               FROM (SELECT unnest(groups) AS grp FROM {USERS_SQL} WHERE email = 'user7@example.com')
               JOIN {POLICY_SQL} USING (grp))
    SELECT 'event:' || event_id AS id FROM events WHERE 'event' IN (FROM k)
    UNION ALL SELECT 'documentLabel:' || doc_id FROM {DOCUMENT_LABEL}
    WHERE 'documentLabel' IN (FROM k)
    UNION ALL SELECT 'orderCustomer:' || o_orderkey FROM orders WHERE 'orderCustomer' IN (FROM k)
    """,
)
def docs_visible_by_policy_table(spark, folder):
    docs = all_documents(spark, folder).where("object_type IN ('event', 'documentLabel', 'orderCustomer')")
    policy = _policy(spark, folder)
    return A.permitted_documents(docs, users(spark, folder), "User7@Example.com", policy).select("id")


@report(
    "scope_current",
    """
    SELECT o_orderkey, o_custkey, c_nationkey FROM orders
    JOIN customer ON o_custkey = c_custkey
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
                          WHERE r_name = 'ASIA')
    """,
)
def scope_current(spark, folder):
    """Facts of the current master rows only; nations of one region play the master."""
    region = table(spark, folder, "region").where("r_name = 'ASIA'")
    nation = table(spark, folder, "nation")
    current = nation.join(region, nation.n_regionkey == region.r_regionkey, "left_semi").select(
        F.col("n_nationkey").alias("c_nationkey")
    )
    facts = order_customer(spark, folder).select("o_orderkey", "o_custkey", "c_nationkey")
    return lookup(facts, current, ["c_nationkey"], "left_semi")
