"""The document index: batches appended per view, resolved to the newest version of each id.

An incremental run writes only its own documents; nothing already indexed is rewritten. A
document that its view no longer gives gets a row that says so in the run's batch.
Readers see the batches the sync state names, so a batch of a run that failed before it
saved its state stays invisible and is overwritten by the next attempt.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from hashlib import md5
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaflow.model import DOCUMENT_SCHEMA, require_identifier
from vistaflow.operators.dedupe import last_of_copies, last_wins
from vistaflow.operators.lookup import within_rows
from vistaflow.operators.upsert import content_digest, upsert
from vistaflow.plans.state import ViewState
from vistaflow.sources.files import folder_names, remove

STORED = T.StructType(
    [
        *DOCUMENT_SCHEMA.fields,
        T.StructField("digest", T.StringType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("batch", T.LongType()),
    ]
)


# Bodies repeat their column names and digests are hex: entropy coding halves them.
CODEC = "zstd"
BUCKET_ROWS, LEAST_BUCKETS = 200_000, 8


def buckets_for(rows: int) -> int:
    """Buckets for a base of about ``rows`` documents, so that no bucket grows with the table."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


class DocumentIndex:
    """Documents below ``root``.

    With ``buckets`` the first batch of each view is stored in that many buckets by id. Changes
    of any size then merge with it without moving it: only they are shuffled, to its buckets.
    A search for one id opens one bucket. Choose as many as give files of some hundred MB.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 0) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def _view_folder(self, view: str) -> str:
        return f"{self.root}/view={require_identifier(view, 'view name')}"

    def write_batch(self, view: str, batch: int, docs: DataFrame, base: bool = False) -> int:
        """Write one batch of documents with unique ids; returns their number.

        Writing the same batch again replaces it, so a retried run changes nothing. A digest
        of each document is stored beside it, so that later runs need not read its body to
        see whether it has changed. ``base`` is for a view's first batch, which may have buckets.
        """
        folder = f"{self._view_folder(view)}/batch={batch}"
        stored = docs.withColumn("digest", content_digest(docs))
        if "deleted" not in stored.columns:
            stored = stored.withColumn("deleted", F.lit(False))
        if base and self.buckets:
            remove(self.spark, folder)  # a table cannot be made over what a broken run left
            stored = stored.select(*STORED.names[:-1]).repartition(self.buckets, "id")
            name = f"base_{uuid4().hex}"
            writer = stored.write.format("parquet").bucketBy(self.buckets, "id").sortBy("id")
            writer.option("path", folder).option("compression", CODEC).saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")  # the name only; its files stay
        else:
            stored.write.mode("overwrite").parquet(folder, compression=CODEC)
        return self.spark.read.schema(DOCUMENT_SCHEMA).parquet(folder).count()

    def _bucketed(self, view: str, batch: int, buckets: int) -> DataFrame:
        """A batch in buckets, under a name that this session knows it by."""
        folder = f"{self._view_folder(view)}/batch={batch}"
        name = f"base_{md5(folder.encode(), usedforsecurity=False).hexdigest()}_{buckets}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED.fields[:-1])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def new_state(self, view: str) -> ViewState:
        """State of a view that has none saved; its first batch comes after all folders there.

        If the state was lost, the batches that it named are left as they are.
        """
        names = folder_names(self.spark, self._view_folder(view))
        used = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
        first = max(used, default=-1) + 1
        return ViewState(view, base_batch=first, last_batch=first - 1)

    def batches(self, view: str, first: int, last: int) -> DataFrame:
        if last < first:
            return self.spark.createDataFrame([], STORED)
        folder = self._view_folder(view)
        paths = [f"{folder}/batch={b}" for b in range(first, last + 1)]
        return self.spark.read.schema(STORED).option("basePath", folder).parquet(*paths)

    def view_documents(self, state: ViewState) -> DataFrame:
        """Newest version of each document of one view."""
        return self._newest(state).drop("digest")

    def _newest(self, state: ViewState) -> DataFrame:
        if state.base_buckets and state.last_batch >= state.base_batch:
            base = self._bucketed(state.view, state.base_batch, state.base_buckets)
        else:
            last = min(state.base_batch, state.last_batch)
            base = self.batches(state.view, state.base_batch, last).drop("batch")
        if state.last_batch <= state.base_batch:
            return base.drop("deleted")
        changed = self.batches(state.view, state.base_batch + 1, state.last_batch)
        small = within_rows(changed.select("id"))
        if state.base_buckets and not small:
            changed = changed.repartition(state.base_buckets, "id")  # to where their ids' buckets are
        if state.last_batch > state.base_batch + 1:  # the ids of one batch are unique
            changed = last_wins(changed, "id", ["batch"])
        newest = changed.drop("batch")
        merged = upsert(base, newest, small=small)
        return merged.where(~F.coalesce("deleted", F.lit(False))).drop("deleted")

    def changed_documents(
        self, state: ViewState, docs: DataFrame, *, deletes: bool = False
    ) -> DataFrame:
        """The documents that are new or differ from what the index holds of one view.

        With ``deletes``, ``docs`` is all that the view gives: an id of the index that is not
        among them comes as a row with ``deleted`` set. Only ids and stored digests of the
        index are read and shuffled.
        """
        current = self._newest(state).select("id", F.col("digest").alias("_old"))
        marked = docs.withColumn("_new", content_digest(docs))
        marked = marked.join(current, "id", "full_outer" if deletes else "left")
        differs = ~F.col("_old").eqNullSafe(F.col("_new"))
        return marked.where(differs).select(*docs.columns, F.col("_new").isNull().alias("deleted"))

    def remove_before(self, view: str, batch: int) -> None:
        """Delete the batches of a view before this one, which no state may name any more."""
        folder = self._view_folder(view)
        for name in folder_names(self.spark, folder):
            number = name.removeprefix("batch=")
            if number.isdigit() and int(number) < batch:
                remove(self.spark, f"{folder}/{name}")

    def documents(self, states: dict[str, ViewState]) -> DataFrame:
        """Current documents of all views, one for each id.

        Where views give the same id, because they share an object type or a builder names
        documents freely, the newest run wins, and within a run the later view of the catalog.
        """
        parts = [
            self.view_documents(s).withColumn("view_ord", F.lit(s.place)) for s in states.values()
        ]
        if not parts:
            return self.spark.createDataFrame([], DOCUMENT_SCHEMA)
        if len(parts) == 1:
            return parts[0].drop("view_ord")
        mixed = reduce(DataFrame.unionByName, parts)
        return last_of_copies(mixed, "id", ["updated_at", "view_ord"]).drop("view_ord")

    def compact(self, state: ViewState) -> ViewState:
        """Fold a view's batches into one; the returned state must be saved to take effect."""
        batch = state.last_batch + 1
        self.write_batch(state.view, batch, self.view_documents(state), base=True)
        return replace(state, base_batch=batch, last_batch=batch, base_buckets=self.buckets)


def find_document(docs: DataFrame, object_type: str, doc_id: str) -> DataFrame:
    """The document with this type and id; both conditions reach the scan."""
    return docs.where((docs["object_type"] == object_type) & (docs["id"] == doc_id))
