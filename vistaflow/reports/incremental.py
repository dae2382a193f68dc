"""Runs of the indexing job over the sample views: full, incremental, repeated, streamed."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaflow.model import DocumentOptions, ViewDef
from vistaflow.operators.upsert import diff
from vistaflow.plans.index import DocumentIndex, buckets_for
from vistaflow.plans.run import RunSettings, run_index
from vistaflow.plans.state import SyncState, merge_state, state_frame
from vistaflow.plans.users import Directory, reader_table, user_table
from vistaflow.reports.people import SUPERUSERS_SQL, USERS_SQL, superusers, users
from vistaflow.reports.registry import (
    DOCUMENT_LABEL,
    LAST_LINEITEM,
    LINEITEM_ORDER,
    ORDER_CUSTOMER,
    report,
)
from vistaflow.session import new_folder, staged
from vistaflow.sources.catalog import ViewCatalog
from vistaflow.sources.sample import VIEW, catalog, table
from vistaflow.sources.scan import newest_watermark
from vistaflow.streaming.upserts import stream_documents, stream_state

CUT = "2000-12-01"
OPTIONS = DocumentOptions(datasource="sample", view_url_base="https://search.example.org")
SETTINGS = RunSettings(acl_id="all", options=OPTIONS)


class Job:
    """An index and a state in a new folder, and the catalog a run reads."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        root = new_folder(spark, "index")
        self.spark = spark
        self.views = catalog(spark, folder)
        self.index = DocumentIndex(spark, f"{root}/documents")
        self.state = SyncState(spark, f"{root}/state")
        self.users = user_table(spark, f"{root}/users")
        self.readers = reader_table(spark, f"{root}/readers")

    def run(
        self,
        sources: dict[str | ViewDef, DataFrame],
        settings: RunSettings = SETTINGS,
        directory: Directory | None = None,
    ):
        """One run over the views, named or defined, with the rows given for each."""
        chosen = ViewCatalog(self.spark)
        for view, df in sources.items():
            known = self.views.definition(view) if isinstance(view, str) else view
            chosen.register(known, lambda df=df: df)
        return run_index(chosen, self.state, self.index, settings, directory=directory)

    def documents(self) -> DataFrame:
        return self.index.documents(self.state.load())


@report(
    "watermark_max",
    f"""
    SELECT 'v_Customer' AS view_name, NULL AS watermark
    UNION ALL SELECT 'v_Order_Customer', CAST(max(o_orderdate) AS VARCHAR) FROM {ORDER_CUSTOMER}
    UNION ALL SELECT 'v_Lineitem_Order', CAST(max(l_shipdate) AS VARCHAR) FROM {LINEITEM_ORDER}
    UNION ALL SELECT 'v_Event', CAST(max(ts) AS VARCHAR) FROM events
    UNION ALL SELECT 'v_Document_Label', NULL
    """,
)
def watermark_max(spark, folder):
    out = None
    for name, df in catalog(spark, folder).enabled().items():
        part = newest_watermark(df, VIEW[name])
        out = part if out is None else out.unionByName(part)
    return out


@report(
    "sync_state_table",
    f"""
    SELECT 'v_Lineitem_Order' AS view, CAST(max(l_shipdate) AS VARCHAR) AS watermark,
           count(*) AS count, CAST(0 AS BIGINT) AS base_batch, CAST(0 AS BIGINT) AS last_batch
    FROM {LINEITEM_ORDER}
    UNION ALL SELECT 'v_Event', CAST(max(ts) AS VARCHAR), count(*), 0, 0 FROM events
    UNION ALL SELECT 'v_Customer', NULL, NULL, 0, 0
    """,
)
def sync_state_table(spark, folder):
    """State as read back after a first run; a view without a watermark has none."""
    job = Job(spark, folder)
    names = ("v_Lineitem_Order", "v_Event", "v_Customer")
    job.run({n: job.views.frame(n) for n in names})
    return state_frame(spark, job.state.load()).drop("last_run", "base_buckets", "place")


@report(
    "sync_state_merge",
    """
    SELECT 'v_' || event_type AS view,
           CAST(coalesce(max(ts) FILTER (WHERE ts > '2024-01-15' AND event_type <> 'error'),
                         max(ts) FILTER (WHERE ts <= '2024-01-15')) AS VARCHAR) AS watermark,
           CASE WHEN event_type <> 'error' THEN count(*) FILTER (WHERE ts > '2024-01-15')
                ELSE count(*) FILTER (WHERE ts <= '2024-01-15') END AS count
    FROM events GROUP BY event_type
    """,
)
def sync_state_merge(spark, folder):
    """Every event type plays a view; one of them fails in the second run."""
    events = table(spark, folder, "events")
    failed = F.col("event_type") == "error"

    def state(rows: DataFrame, watermark) -> DataFrame:
        by_view = rows.groupBy(F.concat(F.lit("v_"), "event_type").alias("view"))
        return by_view.agg(
            F.max(watermark).cast("string").alias("watermark"), F.count("*").alias("count")
        )

    old = state(events.where("ts <= '2024-01-15'"), F.col("ts"))
    new = state(events.where("ts > '2024-01-15'"), F.when(~failed, F.col("ts")))
    return merge_state(old, new)


@report(
    "run_report",
    f"""
    SELECT 'v_Lineitem_Order' AS view, 'full' AS mode, true AS ok, count(*) AS records,
           count(DISTINCT (l_orderkey, l_linenumber)) AS documents,
           CAST(max(l_shipdate) AS VARCHAR) AS watermark, NULL AS error_type
    FROM {LINEITEM_ORDER}
    UNION ALL SELECT 'v_Event', 'full', false, 0, 0, NULL, 'view_fetch'
    UNION ALL SELECT 'v_Document_Label', 'full', true, count(*), count(*), NULL, NULL FROM documents
    """,
)
def run_report(spark, folder):
    """The middle view cannot be read; the other two are indexed."""
    job = Job(spark, folder)
    broken = job.views.frame("v_Event").withColumn("ts", F.raise_error(F.lit("cannot bind")))
    sources = {
        "v_Lineitem_Order": job.views.frame("v_Lineitem_Order"),
        "v_Event": broken.withColumn("ts", F.col("ts").cast("timestamp_ntz")),
        "v_Document_Label": job.views.frame("v_Document_Label"),
    }
    return job.run(sources).frame(spark).drop("since", "error", "written")


@report(
    "incremental_run",
    f"""
    SELECT 'v_Order_Customer' AS view, 'incremental' AS mode,
           CAST(max(o_orderdate) FILTER (WHERE o_orderdate <= '{CUT}') AS VARCHAR) AS since,
           count(*) FILTER (WHERE o_orderdate > '{CUT}') AS records,
           count(*) FILTER (WHERE o_orderdate > '{CUT}') AS documents,
           CAST(max(o_orderdate) AS VARCHAR) AS watermark
    FROM {ORDER_CUSTOMER}
    UNION ALL
    SELECT 'v_Document_Label', 'full', NULL, count(*), count(*), NULL FROM documents
    """,
)
def incremental_run(spark, folder):
    """Second of two runs; orders arrived since, labels have no watermark."""
    job = Job(spark, folder)
    orders, labels = (job.views.frame(n) for n in ("v_Order_Customer", "v_Document_Label"))
    job.run({"v_Order_Customer": orders.where(f"o_orderdate <= '{CUT}'"), "v_Document_Label": labels})
    second = job.run({"v_Order_Customer": orders, "v_Document_Label": labels})
    return second.frame(spark).drop("ok", "error", "error_type", "written")


@report(
    "incremental_rerun_idempotent",
    f"""
    SELECT 'lineitemOrder:' || l_orderkey || ':' || l_linenumber AS id,
           o_orderpriority || ' – ' || l_returnflag || ' – ' || l_linestatus AS title
    FROM {LAST_LINEITEM}
    """,
)
def incremental_rerun_idempotent(spark, folder):
    """The second run is done twice, the first time without saving its state."""
    job = Job(spark, folder)
    lines = job.views.frame("v_Lineitem_Order")
    job.run({"v_Lineitem_Order": lines.where("l_shipdate <= '2000-12-01'")})
    before = job.state.load()
    job.run({"v_Lineitem_Order": lines})
    job.state.save(before)
    job.run({"v_Lineitem_Order": lines})
    return job.documents().select("id", "title")


@report(
    "incremental_late_rows",
    f"""
    SELECT 'orderCustomer:' || o_orderkey AS id FROM {ORDER_CUSTOMER}
    WHERE o_orderdate > '{CUT}' OR o_orderstatus <> 'P'
    """,
)
def incremental_late_rows(spark, folder):
    """Rows that arrive late, at or below the saved watermark, are never read."""
    job = Job(spark, folder)
    orders = job.views.frame("v_Order_Customer")
    job.run({"v_Order_Customer": orders.where(f"o_orderdate <= '{CUT}' AND o_orderstatus <> 'P'")})
    job.run({"v_Order_Customer": orders})
    return job.documents().select("id")


OVERLAP = "60 days"
# The newest order of the first of two runs, in which orders of one status are late.
FIRST_RUN = f"o_orderdate <= '{CUT}' AND o_orderstatus <> 'P'"
SAVED = f"(SELECT max(o_orderdate) FROM {ORDER_CUSTOMER} WHERE {FIRST_RUN})"


def _overlapping_runs(spark: SparkSession, folder: str):
    """Two runs of a view with an overlap, the first without its late rows, and a third one."""
    job = Job(spark, folder)
    view = replace(job.views.definition("v_Order_Customer"), overlap=OVERLAP)
    orders = job.views.frame("v_Order_Customer")
    return job, [job.run({view: rows}) for rows in (orders.where(FIRST_RUN), orders, orders)]


@report(
    "incremental_overlap",
    f"""
    SELECT 'orderCustomer:' || o_orderkey AS id FROM {ORDER_CUSTOMER}
    WHERE ({FIRST_RUN}) OR o_orderdate > {SAVED} - INTERVAL {OVERLAP}
    """,
)
def incremental_overlap(spark, folder):
    """Late rows within the overlap come in, those before it do not."""
    job, _ = _overlapping_runs(spark, folder)
    return job.documents().select("id")


@report(
    "incremental_overlap_report",
    f"""
    SELECT 2 AS run, 'incremental' AS mode, count(*) AS records,
           count(*) FILTER (WHERE NOT ({FIRST_RUN})) AS written,
           (SELECT CAST(max(o_orderdate) AS VARCHAR) FROM {ORDER_CUSTOMER}) AS watermark
    FROM {ORDER_CUSTOMER} WHERE o_orderdate > {SAVED} - INTERVAL {OVERLAP}
    UNION ALL
    SELECT 3, 'incremental', count(*), 0, CAST(max(o_orderdate) AS VARCHAR) FROM {ORDER_CUSTOMER}
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM {ORDER_CUSTOMER}) - INTERVAL {OVERLAP}
    """,
)
def incremental_overlap_report(spark, folder):
    """What is read again and unchanged is not written again."""
    _, reports = _overlapping_runs(spark, folder)
    out = None
    for number, seen in enumerate(reports[1:], start=2):
        seen = seen.frame(spark).select(F.lit(number).alias("run"), "mode", "records", "written", "watermark")
        out = seen if out is None else out.unionByName(seen)
    return out


@report(
    "index_deletes",
    f"""
    SELECT 'documentLabel:' || doc_id AS id,
           CASE WHEN quality = 0 THEN 'deleted' WHEN quality = 1 THEN 'updated'
                ELSE 'unchanged' END AS status
    FROM {DOCUMENT_LABEL}
    """,
)
def index_deletes(spark, folder):
    """A view read as a whole loses rows at its source and changes others: the index follows."""
    job = Job(spark, folder)
    rows = job.views.frame("v_Document_Label")
    job.run({"v_Document_Label": rows})
    before = job.documents()
    changed = F.when(F.col("quality") == 1, F.lit("changed")).otherwise(F.col("source"))
    job.run({"v_Document_Label": rows.where("quality IS NULL OR quality <> 0").withColumn("source", changed)})
    return diff(before, job.documents())


@report(
    "index_bucketed",
    f"""
    SELECT 'orderCustomer:' || o_orderkey AS id, o_orderstatus AS status FROM {ORDER_CUSTOMER}
    """,
)
def index_bucketed(spark, folder):
    """A base in buckets and two runs of changes on top of it, merged."""
    job = Job(spark, folder)
    job.index.buckets = buckets_for(table(spark, folder, "orders").count())
    orders = job.views.frame("v_Order_Customer")
    early = orders.where(f"o_orderdate <= '{CUT}'").withColumn("o_orderstatus", F.lit("?"))
    view = replace(job.views.definition("v_Order_Customer"), watermark_column=None)
    later = orders.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    for rows in (early, later, orders):
        job.run({view: rows})
    return job.documents().select("id", F.get_json_object("body", "$.o_orderstatus").alias("status"))


@report(
    "index_replace",
    f"""
    SELECT 'orderCustomer:' || o_orderkey AS id FROM {ORDER_CUSTOMER} WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'documentLabel:' || doc_id FROM documents
    """,
)
def index_replace(spark, folder):
    """A full refresh: one view is replaced, one cannot be read and keeps its documents."""
    job = Job(spark, folder)
    orders, labels = (job.views.frame(n) for n in ("v_Order_Customer", "v_Document_Label"))
    job.run({"v_Order_Customer": orders, "v_Document_Label": labels})
    broken = labels.withColumn("doc_id", F.raise_error(F.lit("cannot bind")).cast("long"))
    refresh = RunSettings(full_refresh=True, acl_id="all", options=OPTIONS)
    job.run(
        {"v_Order_Customer": orders.where("o_orderstatus = 'O'"), "v_Document_Label": broken},
        refresh,
    )
    return job.documents().select("id")


@report(
    "stream_upsert",
    """
    SELECT 'user:' || user_id AS name, arg_max(event_type, ts) AS title, 'all' AS acl_id
    FROM events WHERE event_type <> 'error' GROUP BY user_id
    UNION ALL SELECT 'nobody', event_type, 'all' FROM events WHERE event_type = 'error'
    """,
)
def stream_upsert(spark, folder):
    """Newest event of each user, in three micro-batches; errors are rows without a key."""
    view = ViewDef(
        "v_User_Now", "user", "user_id", (), ("event_type",), (), "ts", ("event_id",)
    )
    root = new_folder(spark, "stream")
    index = DocumentIndex(spark, f"{root}/documents")
    user = F.when(F.col("event_type") != "error", F.col("user_id"))
    events = table(spark, folder, "events").withColumn("user_id", user)
    parts = ["ts < '2024-01-11'", "ts >= '2024-01-11' AND ts < '2024-01-21'", "ts >= '2024-01-21'"]
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 10_000)
    for part in parts:
        events.where(part).write.mode("append").parquet(f"{root}/feed")
        job = stream_documents(
            rows.parquet(f"{root}/feed"), view, index, f"{root}/checkpoint", OPTIONS, acl_id="all"
        )
        job.awaitTermination()
    docs = index.view_documents(stream_state(index, view, f"{root}/checkpoint"))
    named = F.when(F.col("id").rlike("^user:[0-9]{1,18}$"), F.col("id")).otherwise("nobody")
    return docs.select(named.alias("name"), "title", "permissions.acl_id")


@report(
    "incremental_unchanged_view",
    f"""
    SELECT 1 AS run, count(*) AS records, count(*) AS documents, count(*) AS written
    FROM {DOCUMENT_LABEL}
    UNION ALL SELECT 2, count(*), count(*), 0 FROM {DOCUMENT_LABEL}
    UNION ALL SELECT 3, count(*), count(*), count(*) FILTER (WHERE quality < 0.5)
    FROM {DOCUMENT_LABEL}
    """,
)
def incremental_unchanged_view(spark, folder):
    """A view without a watermark: the same rows again write nothing, changed rows only themselves."""
    job = Job(spark, folder)
    rows = job.views.frame("v_Document_Label")
    low = F.col("quality") < 0.5
    changed = rows.withColumn("source", F.when(low, F.lit("changed")).otherwise(F.col("source")))
    out = None
    for number, df in enumerate((rows, rows, changed), start=1):
        seen = job.run({"v_Document_Label": df}).frame(spark)
        seen = seen.select(F.lit(number).alias("run"), "records", "documents", "written")
        out = seen if out is None else out.unionByName(seen)
    return out


@report(
    "index_compacted",
    f"""
    SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS documents,
           count(DISTINCT (l_orderkey, l_linenumber)) AS stored FROM {LINEITEM_ORDER}
    """,
)
def index_compacted(spark, folder):
    """Runs that fold batches at once, and a last one that removes those no state names."""
    job = Job(spark, folder)
    lines = job.views.frame("v_Lineitem_Order")
    settings = RunSettings(acl_id="all", options=OPTIONS, compact_after=0)
    for rows in (lines.where("l_shipdate <= '1998-12-01'"), lines, lines):
        job.run({"v_Lineitem_Order": rows}, settings)
    stored = spark.read.parquet(f"{job.index.root}/view=v_Lineitem_Order")
    stored = stored.agg(F.count("*").alias("stored"))
    counted = job.documents().agg(F.count("*").alias("documents"))
    return counted.select("documents", stored.scalar().alias("stored"))


@report(
    "scan_capped_drained",
    f"""
    SELECT 'capped:' || doc_id AS id FROM {DOCUMENT_LABEL}
    """,
)
def scan_capped_drained(spark, folder):
    """Capped runs until nothing is left give all rows, with more null watermarks than the cap."""
    view = ViewDef(
        "v_Capped", "capped", "doc_id", watermark_column="mark", order_columns=("doc_id",)
    )
    job = Job(spark, folder)
    rows = job.views.frame("v_Document_Label")
    rows = rows.withColumn("mark", F.when(F.col("quality") >= 0.5, F.col("doc_id")))
    rows = staged(rows.select("doc_id", "quality", "mark"), "capped")  # read by every run
    cap = max(1, rows.where("mark IS NOT NULL").count() // 4)
    settings = RunSettings(acl_id="all", options=OPTIONS, row_limit=cap)
    while any(r.written for r in job.run({view: rows}, settings).results):
        pass
    return job.documents().select("id")


@report(
    "incremental_keyless_rows",
    f"""
    SELECT doc_id, quality IS NULL AS keyless FROM {DOCUMENT_LABEL}
    WHERE quality IS NULL
    UNION ALL
    SELECT arg_max(doc_id, doc_id), false FROM {DOCUMENT_LABEL}
    WHERE quality IS NOT NULL GROUP BY quality
    """,
)
def incremental_keyless_rows(spark, folder):
    """Two runs over rows keyed by a column that is often null; every row without a key stays."""
    view = ViewDef(
        "v_Keyless", "keyless", "quality", watermark_column="doc_id", order_columns=("doc_id",)
    )
    job = Job(spark, folder)
    rows = job.views.frame("v_Document_Label")
    half = rows.agg((F.max("doc_id") / 2).cast("long")).scalar()
    job.run({view: rows.where(F.col("doc_id") <= half)})
    job.run({view: rows})
    found = F.get_json_object("body", "$.doc_id").cast("long").alias("doc_id")
    return job.documents().select(found, F.get_json_object("body", "$.quality").isNull().alias("keyless"))


def _directory(job: Job, folder: str) -> Directory:
    named = users(job.spark, folder).where("name IS NOT NULL")
    return Directory(named, superusers(job.spark, folder), job.users, job.readers)


@report(
    "run_users",
    f"""
    WITH u AS (SELECT * FROM {USERS_SQL} WHERE name IS NOT NULL)
    SELECT sha256(email) AS user_id, email, name, true AS is_active FROM u
    UNION ALL SELECT sha256(email), email, email, true FROM {SUPERUSERS_SQL}
    WHERE email NOT IN (SELECT email FROM u)
    """,
)
def run_users(spark, folder):
    """The user list a run has written, superusers included, read back."""
    job = Job(spark, folder)
    job.run({"v_Event": job.views.frame("v_Event")}, directory=_directory(job, folder))
    return job.users.read()


@report(
    "run_readers",
    f"""
    WITH u AS (SELECT email FROM {USERS_SQL} WHERE name IS NOT NULL),
         r AS (SELECT email FROM u UNION ALL
               SELECT email FROM {SUPERUSERS_SQL} WHERE email NOT IN (SELECT email FROM u))
    SELECT 'all' AS acl_id, sha256(email) AS datasource_user_id, email,
           (SELECT count(*) FROM {ORDER_CUSTOMER}) AS documents
    FROM r
    """,
)
def run_readers(spark, folder):
    """The reader list a run has written, and how many documents name it."""
    job = Job(spark, folder)
    job.run({"v_Order_Customer": job.views.frame("v_Order_Customer")}, directory=_directory(job, folder))
    named = job.documents().groupBy("permissions.acl_id").agg(F.count("*").alias("documents"))
    return job.readers.read().join(named, "acl_id")
