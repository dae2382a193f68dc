"""The users and reader lists of the index: replaced as a whole, users never by an empty list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaflow.operators.access import indexable_users, reader_list, with_superusers
from vistaflow.session import staged
from vistaflow.sources.files import VersionedTable

USER_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)
READER_SCHEMA = T.StructType(
    [
        T.StructField("acl_id", T.StringType()),
        T.StructField("datasource_user_id", T.StringType()),
        T.StructField("email", T.StringType()),
    ]
)


def user_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, USER_SCHEMA, "parquet")


def reader_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, READER_SCHEMA, "parquet")


def replace_users(table: VersionedTable, users: DataFrame) -> bool:
    """Write the whole user list; without any user the old list stays. True if written."""
    if users.isEmpty():
        return False
    table.replace(users.select(*USER_SCHEMA.fieldNames()))
    return True


@dataclass(frozen=True)
class Directory:
    """Who may read a run's documents, and where that is written.

    ``users`` and ``superusers`` have datasource_user_id and email, users a name as well.
    """

    users: DataFrame
    superusers: DataFrame
    user_table: VersionedTable
    reader_table: VersionedTable

    def write(self, acl_id: str) -> None:
        """The reader list under this id, then the users; superusers are added to both."""
        users = staged(self.users, "users")  # read for the list and for the users
        readers = reader_list(users, self.superusers).withColumn("acl_id", F.lit(acl_id))
        self.reader_table.replace(readers.select(*READER_SCHEMA.fieldNames()))
        replace_users(self.user_table, with_superusers(indexable_users(users), self.superusers))

    def has_readers(self, acl_id: str) -> bool:
        """True if the newest complete list under this id is not empty."""
        return not self.reader_table.read().where(F.col("acl_id") == acl_id).isEmpty()


def expand_readers(docs: DataFrame, readers: DataFrame) -> DataFrame:
    """One row (id, datasource_user_id, email) for every reader of the given documents.

    For a few documents on request; the index itself keeps lists apart from documents.
    """
    named = docs.select("id", F.col("permissions.acl_id").alias("acl_id"))
    return named.join(readers, "acl_id").select("id", "datasource_user_id", "email")
