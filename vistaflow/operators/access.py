"""Users, reader lists and access decisions as joins over whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaflow.functions.identity import display_name, normalized, user_id
from vistaflow.functions.values import strip
from vistaflow.operators.dedupe import first_wins
from vistaflow.operators.lookup import lookup, within_rows
from vistaflow.session import staged


def users_with_groups(members: DataFrame) -> DataFrame:
    """One user per email: id, first non-blank name, sorted distinct non-blank groups.

    ``members`` comes from sources.access.memberships, which has already folded repeats,
    so a user's rows here are at most as many as their distinct groups and names.
    """
    named = F.when(F.col("name") != "", F.struct("ord", "name"))
    grouped = F.when(F.col("group") != "", F.col("group"))
    users = members.groupBy("email").agg(
        F.min(named)["name"].alias("name"),
        F.array_sort(F.collect_set(grouped)).alias("groups"),
    )
    return users.select(user_id(F.col("email")).alias("datasource_user_id"), "*")


def indexable_users(users: DataFrame) -> DataFrame:
    """Users as they are written to the index; rows without id or email are dropped."""
    uid, email = strip(F.col("datasource_user_id")), strip(F.col("email"))
    rows = users.where((uid != "") & (email != ""))
    return rows.select(
        uid.alias("user_id"),
        email.alias("email"),
        display_name(F.col("name"), email).alias("name"),
        F.lit(True).alias("is_active"),
    )


def with_superusers(users: DataFrame, superusers: DataFrame) -> DataFrame:
    """Indexable users plus the superusers whose id and email are not yet among them."""
    extra = superusers.select(
        strip(F.col("datasource_user_id")).alias("user_id"), strip(F.col("email")).alias("email")
    ).where("user_id <> '' AND email <> ''")
    extra = extra.withColumn("_mail", F.lower("email"))
    extra = extra.dropDuplicates(["user_id"]).dropDuplicates(["_mail"]).drop("_mail")
    extra = staged(extra, "superusers")  # read three times below
    # Users are read once and, when superusers are few, not shuffled: each side is looked up
    # by id and by email in one join.
    wanted = extra.select("user_id", F.explode(_user_keys()).alias("_key"))
    known = users.select(F.explode(_user_keys()).alias("_key"))
    met = lookup(known, wanted, ["_key"], "inner")
    missing = extra.join(met.select("user_id").distinct(), "user_id", "left_anti")
    name, active = F.col("email").alias("name"), F.lit(True).alias("is_active")
    return users.unionByName(missing.select("user_id", "email", name, active))


def _user_keys() -> Column:
    """What identifies a user: the id, and the email in any case."""
    mail = F.lower(strip(F.col("email")))
    return F.array(F.concat(F.lit("id:"), "user_id"), F.concat(F.lit("mail:"), mail))


def reader_list(base: DataFrame, extra: DataFrame) -> DataFrame:
    """The access list: base users, then extra ones; the first of each trimmed id wins."""
    rows = [
        part.select(
            strip(F.col("datasource_user_id")).alias("key"),
            "datasource_user_id",
            "email",
            F.lit(source).alias("source"),
        )
        for source, part in enumerate([base, extra])
    ]
    usable = rows[0].unionByName(rows[1]).where((F.col("key") != "") & (strip(F.col("email")) != ""))
    return first_wins(usable, "key", ["source", "email"]).drop("key")


def attach_readers(docs: DataFrame, readers: DataFrame, acl_id: str) -> DataFrame:
    """Put a reader list on every document by id; an empty list leaves permissions null.

    The list stays a table of its own: copying every user into every document would make
    the index grow with users times documents.
    """
    count = readers.agg(F.count("*").alias("readers")).scalar()
    given = F.struct(F.lit(False).alias("allow_anonymous_access"), F.lit(acl_id).alias("acl_id"))
    return docs.withColumn("permissions", F.when(count > 0, given))


def grants_by_view(grants: DataFrame) -> DataFrame:
    """Grants of each view as rows (view, email, times), in order of view and email.

    Repeats are kept as a count, so a view that holds most grants is never one long list.
    """
    counted = grants.groupBy("view", "email").agg(F.count("*").alias("times"))
    return counted.orderBy("view", "email")


def granted_requests(requests: DataFrame, grants: DataFrame) -> DataFrame:
    """Requests whose (view, email) pair is granted; both are compared normalized."""
    pairs = staged(_pairs(grants), "grants")
    keyed = _normalized_requests(requests)
    kept = lookup(keyed, pairs, ["_view", "_email"], "left_semi")
    return kept.select(*requests.columns)


def _pairs(grants: DataFrame) -> DataFrame:
    return grants.select(F.col("view").alias("_view"), F.col("email").alias("_email")).distinct()


def _normalized_requests(requests: DataFrame) -> DataFrame:
    """Requests with join keys under names of their own; other columns stay as they are."""
    return requests.withColumns(
        {"_view": F.lower("view_name"), "_email": normalized(F.col("user_email"))}
    )


def audit(
    requests: DataFrame, grants: DataFrame, superusers: DataFrame, *, all_access: bool = False
) -> DataFrame:
    """Each request with the decision and its reason.

    All-access beats superuser beats grant; a view without any grant denies everyone. Grants
    and superusers are folded once and stored; by the size of the files Spark decides whether
    to broadcast them, in which case requests are not shuffled.
    """
    if all_access:
        return requests.withColumns({"allowed": F.lit(True), "reason": F.lit("all_access")})
    pairs = staged(_pairs(grants), "grants")
    views = pairs.select("_view").distinct()
    supers = staged(
        superusers.select(normalized(F.col("email")).alias("_email")).distinct(), "superusers"
    )
    out = _normalized_requests(requests)
    for dim, flag in ((supers, "_super"), (pairs, "_granted"), (views, "_listed")):
        keys = dim.columns
        out = lookup(out, dim.withColumn(flag, F.lit(True)), keys)
    reason = (
        F.when(F.col("_super"), "superuser")
        .when(F.col("_granted"), "granted")
        .when(F.col("_listed"), "not_granted")
        .otherwise("view_not_listed")
    )
    out = out.withColumn("reason", reason)
    out = out.withColumn("allowed", F.col("reason").isin("superuser", "granted"))
    return out.select(*requests.columns, "allowed", "reason")


def may_access(
    user_email: str,
    view_name: str,
    grants: DataFrame,
    superusers: Iterable[str] = (),
    *,
    all_access: bool = False,
) -> bool:
    """The decision for one request; stops at the first matching grant."""
    email = user_email.strip().lower()
    if all_access or email in {s.strip().lower() for s in superusers}:
        return True
    pair = (F.col("view") == view_name.lower()) & (F.col("email") == email)
    return not grants.where(pair).isEmpty()


def _groups(names: Iterable[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def kinds_by_user(users: DataFrame, allowed: Mapping[str, Iterable[str]]) -> DataFrame:
    """For each user and object type: is one of the user's groups allowed to read it?

    ``allowed`` is configuration, one entry per object type; no groups means no access.
    """
    rules = [
        F.struct(
            F.lit(kind).alias("object_type"),
            F.arrays_overlap("groups", _groups(names)).alias("allowed"),
        )
        for kind, names in allowed.items()
    ]
    return users.select("email", F.inline(F.array(*rules)))


def documents_for_user(
    docs: DataFrame, users: DataFrame, email: str, allowed: Mapping[str, Iterable[str]]
) -> DataFrame:
    """Documents one user may read by group policy; unknown users and types are denied.

    The types are fetched first, so the scans of views the user may not read are left out
    of the plan.
    """
    user = users.where(F.col("email") == email.strip().lower())
    # At most one row per configured object type.
    kinds = kinds_by_user(user, allowed).where("allowed").select("object_type").distinct()
    return docs.where(F.col("object_type").isin([r["object_type"] for r in kinds.collect()]))


LISTED_KINDS = 1000


def permitted_kinds(users: DataFrame, policy: DataFrame) -> DataFrame:
    """(email, object_type) for every type that some group of the user may read.

    ``policy`` is a table (object_type, group) of any size. Groups are rows here, so that a
    user with many groups and a type with many readers are an equal join, not a comparison of
    lists; a user without groups, or a type without rows, gives nothing.
    """
    held = users.select("email", F.explode("groups").alias("group")).distinct()
    return lookup(held, policy.select("object_type", "group").distinct(), ["group"], "inner").select(
        "email", "object_type"
    ).distinct()


def permitted_documents(
    docs: DataFrame, users: DataFrame, email: str, policy: DataFrame
) -> DataFrame:
    """As :func:`documents_for_user`, with the policy as a table of groups.

    Up to ``LISTED_KINDS`` types are fetched and tested by a list, so that the scans of other
    views are left out of the plan; more are a semi-join.
    """
    user = users.where(F.col("email") == email.strip().lower())
    kinds = permitted_kinds(user, policy).select("object_type").distinct()
    if within_rows(kinds, LISTED_KINDS):
        return docs.where(F.col("object_type").isin([r["object_type"] for r in kinds.collect()]))
    return lookup(docs, kinds, ["object_type"], "left_semi")
