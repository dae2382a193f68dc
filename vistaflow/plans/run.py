"""One run of the indexing job: every view read, shaped, written, then the state saved."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass, field, replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaflow.model import DocumentOptions, ViewDef
from vistaflow.plans.documents import (
    build_documents,
    name_rows,
    needed_columns,
    preview,
    with_anonymous_default,
)
from vistaflow.plans.index import DocumentIndex
from vistaflow.plans.state import SyncState, ViewState
from vistaflow.plans.users import Directory
from vistaflow.session import staging
from vistaflow.sources.catalog import ViewCatalog
from vistaflow.sources.scan import scan, watermark_literal, watermark_text

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("view", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("since", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("records", T.LongType()),
        T.StructField("documents", T.LongType()),
        T.StructField("written", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("error_type", T.StringType()),
    ]
)


ALL_READERS = "all"
FAILED = {"view_fetch": "failed to fetch/build", "document_indexing": "was not written"}
EVENT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("connector", "error_type", "message", "timestamp", "run_id", "detail")
    ]
)


@dataclass(frozen=True)
class ViewResult:
    """Outcome of one view; ``records - documents`` is the number of dropped duplicates.

    ``written`` counts the documents that were new, changed or gone and so went to the index.
    ``error_type`` tells a view that cannot be read or shaped (view_fetch) from an index
    that cannot be written (document_indexing).
    """

    view: str
    mode: str
    since: str | None
    ok: bool
    records: int = 0
    documents: int = 0
    written: int = 0
    watermark: str | None = None
    error: str | None = None
    error_type: str | None = None


@dataclass(frozen=True)
class RunSettings:
    """How a run reads and writes.

    ``incremental=False`` ignores saved watermarks and saves none. ``full_refresh`` reads
    everything and replaces each view's documents. ``acl_id`` names the reader list put on
    documents; without one ``allow_anonymous`` opens them to everyone. A view with more than
    ``compact_after`` batches on top of its base is folded into one.
    """

    incremental: bool = True
    full_refresh: bool = False
    row_limit: int = 0
    acl_id: str | None = None
    allow_anonymous: bool = False
    parallel_views: int = 1
    compact_after: int = 20
    options: DocumentOptions = field(default_factory=DocumentOptions)


@dataclass(frozen=True)
class RunReport:
    """What became of every view; ``user_error`` is set if the user list was not written.

    A run is ``ok`` though views could not be read, but not if users or documents could not
    be written.
    """

    results: tuple[ViewResult, ...]
    user_error: str | None = None

    @property
    def ok(self) -> bool:
        unwritten = any(r.error_type == "document_indexing" for r in self.results)
        return self.user_error is None and not unwritten

    @property
    def failed_views(self) -> list[str]:
        return [r.view for r in self.results if not r.ok]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([astuple(r) for r in self.results], REPORT_SCHEMA)

    def failures(
        self, spark: SparkSession, connector: str, run_id: str, at: datetime
    ) -> DataFrame:
        """Failure events of the run, ready for functions.render.rendered."""
        found = [
            (r.error_type, f"View {r.view} {FAILED[r.error_type]}: {r.error}")
            for r in self.results
            if not r.ok
        ]
        if self.user_error is not None:
            found.append(("user_indexing", self.user_error))
        rows = [(connector, kind, text, at.isoformat(), run_id, None) for kind, text in found]
        return spark.createDataFrame(rows, EVENT_SCHEMA)


def observed_rows(
    df: DataFrame, view: ViewDef, since: str | None = None
) -> tuple[DataFrame, Observation]:
    """The rows with their count and newest watermark taken in the pass that writes them."""
    observation = Observation()
    return df.observe(observation, *_metrics(df, view, since)), observation


def _metrics(df: DataFrame, view: ViewDef, since: str | None = None) -> list[Column]:
    """Count and newest watermark; where rows are read again it never falls behind ``since``."""
    wm = view.watermark_column
    if not wm or wm not in df.columns:
        newest = F.max(F.lit(None).cast("string"))
    elif since is not None and view.overlap is not None:
        newest = F.greatest(F.max(wm), watermark_literal(df, wm, since)).cast("string")
    else:
        newest = watermark_text(wm)
    return [F.count("*").alias("records"), newest.alias("watermark")]


def read_metrics(view: ViewDef, seen: Observation, written: int) -> dict:
    """Row count and newest watermark of a finished write.

    No documents means no rows (a custom builder aside). Spark may then have folded the
    plan to nothing and observed nothing.
    """
    if written == 0 and view.build is None:
        return {"records": 0, "watermark": None}
    return seen.get


def view_documents(
    df: DataFrame,
    view: ViewDef,
    since: str | None,
    settings: RunSettings,
    *,
    positions: bool = True,
) -> tuple[DataFrame, Observation]:
    """Lazy documents of one view with the observation of the rows they come from."""
    rows = scan(
        needed_columns(df, view, settings.options),
        view,
        since=since,
        row_limit=settings.row_limit,
    )
    # An incremental run adds to earlier documents, so its names must not depend on rank.
    rows, row_name = name_rows(rows, view, positions=positions)
    rows, observation = observed_rows(rows, view, since)
    docs = build_documents(
        rows,
        view,
        settings.options,
        acl_id=settings.acl_id,
        row_name=row_name,
        keep_last=True,
    )
    if settings.allow_anonymous:
        docs = with_anonymous_default(docs)
    return docs, observation


def _counts(rows: DataFrame, view: ViewDef, since: str | None = None) -> dict:
    """Row count and newest watermark in a pass of their own, over the watermark only."""
    return rows.agg(*_metrics(rows, view, since)).first().asDict()


def _each_view(
    views: list[ViewDef], settings: RunSettings, one: Callable[[ViewDef], ViewResult]
) -> tuple[ViewResult, ...]:
    with ThreadPoolExecutor(max(1, settings.parallel_views)) as pool:
        return tuple(pool.map(one, views))


def run_index(
    catalog: ViewCatalog,
    state: SyncState,
    index: DocumentIndex,
    settings: RunSettings = RunSettings(),
    *,
    write_users: Callable[[], None] | None = None,
    directory: Directory | None = None,
    now: Callable[[], datetime] = lambda: datetime.now(tz=UTC),
) -> RunReport:
    """Read, shape and write every enabled view, then save the state.

    Each view is its own job: one that fails is reported and keeps its old documents. A
    full refresh replaces the documents of the views it read, unless no view gave any. The
    state is saved last, so a run that dies before that is simply done again. If the user
    list cannot be written, documents go out but no watermark moves.

    ``directory`` gives users and superusers: the reader list ``settings.acl_id`` and the user
    list are written before documents, which name the list unless it is empty.

    A view that is read as a whole though it has documents already (it has no watermark), or
    again in part (it has an overlap), writes only those that are new or have changed, and the ids of those that a whole reading
    no longer gives. Batches that neither the state nor
    the one before names are removed, so a reader of the previous state can still finish.
    """
    settings = _timed(settings, now())
    saved = state.load()
    known = {
        v.view_name: saved.get(v.view_name) or index.new_state(v.view_name)
        for v in catalog.definitions()
    }
    use_saved = settings.incremental and not settings.full_refresh
    user_error = _attempt(write_users)
    if directory is not None:
        acl_id = settings.acl_id or ALL_READERS
        with staging(index.spark):
            user_error = user_error or _attempt(lambda: directory.write(acl_id))
        known_list = acl_id if directory.has_readers(acl_id) else None
        # A list that could not be written must not open documents to everyone.
        anonymous = settings.allow_anonymous and user_error is None
        settings = replace(settings, acl_id=known_list, allow_anonymous=anonymous)

    def one(view: ViewDef) -> ViewResult:
        name = view.view_name
        old = known[name]
        since = old.watermark if use_saved else None
        mode = "incremental" if since else "full"
        again = since is None or view.overlap is not None
        diffs = use_saved and again and old.last_batch >= old.base_batch
        docs = None
        with staging(index.spark):
            try:
                docs, seen = view_documents(
                    catalog.frame(name), view, since, settings, positions=not use_saved
                )
                if diffs:
                    return _write_changes(catalog, index, view, old, settings, docs, seen, since)
                first = settings.full_refresh or old.last_batch < old.base_batch
                written = index.write_batch(name, old.last_batch + 1, docs, base=first)
                metrics = read_metrics(view, seen, written)
                found, newest = metrics["records"], metrics["watermark"]
                return ViewResult(name, mode, since, True, found, written, written, newest)
            except Exception as exc:  # noqa: BLE001 - one bad view must not stop the others
                text = str(exc).split("\n", 1)[0]
                kind = _failure(docs)
                return ViewResult(name, mode, since, False, error=text, error_type=kind)

    results = _each_view(catalog.definitions(), settings, one)
    moved = use_saved and any(r.ok and r.records and r.watermark for r in results)
    if moved or any(r.documents for r in results):
        users_ok = user_error is None
        stamp = now().isoformat()
        views = _next_state(saved, known, results, settings, stamp, users_ok, index.buckets)
        for name, new in views.items():
            if new.last_batch - new.base_batch > settings.compact_after:
                views[name] = index.compact(new)
        state.save(views)
    for name, before in saved.items():
        index.remove_before(name, before.base_batch)
    return RunReport(results, user_error)


def _write_changes(
    catalog: ViewCatalog,
    index: DocumentIndex,
    view: ViewDef,
    old: ViewState,
    settings: RunSettings,
    docs: DataFrame,
    seen: Observation,
    since: str | None,
) -> ViewResult:
    """Write what differs from the index; the rest of what was read again stays.

    Of a view that was read as a whole and without a cap, documents that no row gives any
    more are removed.
    """
    name, mode = view.view_name, "incremental" if since else "full"
    counted = Observation()
    docs = docs.observe(counted, F.count("*").alias("documents"))
    whole = since is None and not settings.row_limit
    changed = index.changed_documents(old, docs, deletes=whole)
    written = index.write_batch(name, old.last_batch + 1, changed)
    rows = scan(catalog.frame(name), view, since=since, row_limit=settings.row_limit)
    if (written == 0 and view.build is not None) or rows.isEmpty():
        # Spark may have folded documents that are none to nothing and observed nothing.
        metrics, documents = _counts(rows, view, since), docs.count()
    else:
        metrics, documents = seen.get, counted.get["documents"]
    found, newest = metrics["records"], metrics["watermark"]
    return ViewResult(name, mode, since, True, found, documents, written, newest)


def _timed(settings: RunSettings, start: datetime) -> RunSettings:
    """The settings with one document time for the whole run."""
    if settings.options.run_epoch is not None:
        return settings
    return replace(settings, options=replace(settings.options, run_epoch=int(start.timestamp())))


def _attempt(action: Callable[[], None] | None) -> str | None:
    """The error the action gave, if any; documents are written all the same."""
    try:
        if action is not None:
            action()
        return None
    except Exception as exc:  # noqa: BLE001 - reported, not raised
        return str(exc)


def _failure(docs: DataFrame | None) -> str:
    """What a view failed at: its documents, or only their writing. A pass after a failure."""
    try:
        if docs is None:
            return "view_fetch"
        docs.write.format("noop").mode("overwrite").save()
        return "document_indexing"
    except Exception:  # noqa: BLE001 - the first error is the one reported
        return "view_fetch"


def _next_state(
    saved: dict[str, ViewState],
    known: dict[str, ViewState],
    results: tuple[ViewResult, ...],
    settings: RunSettings,
    stamp: str,
    users_ok: bool,
    buckets: int,
) -> dict[str, ViewState]:
    views = dict(saved)
    for place, r in enumerate(results):
        if not r.ok or not (r.documents or r.records or r.written or settings.full_refresh):
            continue  # failed, or nothing new: the old entry stays
        old = new = known[r.view]
        if r.written or settings.full_refresh:
            batch = old.last_batch + 1
            empty = old.last_batch < old.base_batch
            new = replace(old, last_batch=batch)
            if settings.full_refresh or empty:
                new = replace(new, base_batch=batch, base_buckets=buckets)
        new = replace(new, place=place)
        if settings.incremental and users_ok and r.watermark is not None:
            new = replace(new, watermark=r.watermark, count=r.records, last_run=stamp)
        views[r.view] = new
    return views


def run_preview(
    catalog: ViewCatalog, path: str, settings: RunSettings = RunSettings(incremental=False)
) -> RunReport:
    """Dry run: previews of all views as JSON files; no index, no state."""

    def one(view: ViewDef) -> ViewResult:
        name = view.view_name
        try:
            docs, seen = view_documents(catalog.frame(name), view, None, settings)
            folder = f"{path}/view={name}"
            text = preview(docs).select(F.to_json(F.struct("*")).alias("value"))
            text.write.mode("overwrite").text(folder)
            written = catalog.spark.read.text(folder).count()
            metrics = read_metrics(view, seen, written)
            found, newest = metrics["records"], metrics["watermark"]
            return ViewResult(name, "preview", None, True, found, written, written, newest)
        except Exception as exc:  # noqa: BLE001 - one bad view must not stop the others
            text = str(exc).split("\n", 1)[0]
            return ViewResult(
                name, "preview", None, False, error=text, error_type="view_fetch"
            )

    return RunReport(_each_view(catalog.definitions(), settings, one))
