"""Scans, state, the index and whole runs."""

import datetime
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from vistaflow.functions.render import RESOLUTIONS, rendered
from vistaflow.model import DocumentOptions, ViewDef
from vistaflow.operators.upsert import diff, upsert
from vistaflow.plans.documents import build_documents
from vistaflow.plans.index import DocumentIndex, buckets_for, find_document
from vistaflow.plans.run import RunSettings, run_index, run_preview
from vistaflow.plans.state import SyncState, ViewState
from vistaflow.plans.users import Directory, expand_readers, reader_table, user_table
from vistaflow.sources.catalog import ViewCatalog
from vistaflow.sources.files import VersionedTable, folder_names
from vistaflow.sources.scan import newest_watermark, scan

VIEW = ViewDef(
    "v_Company", "company", "CompanyID", title_columns=("Name",),
    watermark_column="Modified", order_columns=("CompanyID",),
)
SCHEMA = "CompanyID int, Name string, Modified timestamp_ntz"


def at(day):
    return datetime.datetime(2026, 5, day, 9)


@pytest.fixture(scope="module")
def company(spark):
    rows = [(1, "a", at(1)), (2, "b", at(4)), (3, "c", at(4)), (4, "d", at(6)), (5, "e", None)]
    return spark.createDataFrame(rows, SCHEMA)


def keys(df):
    return sorted(r["CompanyID"] for r in df.collect())


@pytest.mark.parametrize(
    "since, cap, expected",
    [
        (None, 0, [1, 2, 3, 4, 5]),
        (None, -3, [1, 2, 3, 4, 5]),
        ("2026-05-01 09:00:00", 0, [2, 3, 4]),
        ("2026-05-01 09:00:00", 1, [2, 3]),
        ("2026-05-01 09:00:00", 3, [2, 3, 4]),
        ("2026-05-06 09:00:00", 0, []),
        (None, 1, [1, 5]),
        (None, 3, [1, 2, 3, 5]),
        (None, 99, [1, 2, 3, 4, 5]),
    ],
)
def test_scan(company, since, cap, expected):
    assert keys(scan(company, VIEW, since=since, row_limit=cap)) == expected


def test_capped_runs_get_past_rows_without_a_watermark(spark):
    rows = [(i, "x", None) for i in range(5)] + [(10 + i, "y", at(i + 1)) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    since, read = None, []
    for _ in range(5):
        part = scan(df, VIEW, since=since, row_limit=2)
        read += keys(part)
        since = newest_watermark(part, VIEW).first()["watermark"] or since
    assert sorted(read) == keys(df)


def test_scan_without_watermark(company):
    view = ViewDef("v", "c", "CompanyID")
    assert len(keys(scan(company, view, since="2026-05-01", row_limit=2))) == 2
    assert keys(scan(company, view, since="2030-01-01")) == [1, 2, 3, 4, 5]


def test_newest_watermark(company):
    assert newest_watermark(company, VIEW).first()["watermark"] == "2026-05-06 09:00:00"
    assert newest_watermark(company.where("false"), VIEW).first()["watermark"] is None
    assert newest_watermark(company, ViewDef("v", "c", "CompanyID")).first()["watermark"] is None


def documents(spark, ids, title):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    empty = F.array().cast("array<struct<name:string,value:string>>")
    return df.select("id", F.lit(title).alias("title"), F.lit("{}").alias("body"), empty.alias("custom_properties"))


@pytest.mark.parametrize("small", [True, False])
def test_upsert_twice_is_upsert_once(spark, small):
    old, new = documents(spark, "abc", "old"), documents(spark, "cd", "new")
    once = upsert(old, new, small=small)
    got = sorted((r["id"], r["title"]) for r in once.collect())
    assert got == [("a", "old"), ("b", "old"), ("c", "new"), ("d", "new")]
    assert sorted((r["id"], r["title"]) for r in upsert(once, new, small=small).collect()) == got


def test_diff(spark):
    old, new = documents(spark, "ab", "x"), documents(spark, "c", "x")
    new = new.unionByName(documents(spark, "b", "y")).unionByName(documents(spark, "a", "x"))
    got = {r["id"]: r["status"] for r in diff(old.unionByName(documents(spark, "z", "x")), new).collect()}
    assert got == {"a": "unchanged", "b": "updated", "c": "inserted", "z": "deleted"}


def test_versioned_table_ignores_unfinished_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), spark.range(1).schema, "parquet")
    assert table.read().count() == 0
    table.replace(spark.range(3))
    (tmp_path / "t" / "version=7").mkdir()
    assert table.read().count() == 3
    table.replace(spark.range(5))
    assert table.versions() == [0, 7, 8]
    assert table.read().count() == 5


def test_state_round_trip(spark, tmp_path):
    state = SyncState(spark, str(tmp_path / "s"))
    assert state.load() == {}
    saved = {"v": ViewState("v", "2026-05-04 09:00:00.123456", 3, "now", 0, 2), "w": ViewState("w")}
    state.save(saved)
    assert state.load() == saved


class Job:
    def __init__(self, spark, path):
        self.spark = spark
        self.state = SyncState(spark, f"{path}/state")
        self.index = DocumentIndex(spark, f"{path}/index")

    def run(self, views, settings=RunSettings(), **kwargs):
        catalog = ViewCatalog(self.spark)
        for view, df in views:
            catalog.register(view, df if callable(df) else (lambda df=df: df))
        return run_index(catalog, self.state, self.index, settings, **kwargs)

    def found(self):
        docs = self.index.documents(self.state.load())
        return sorted((r["id"], r["title"]) for r in docs.collect())


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, tmp_path)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_full_run_equals_incremental_runs(spark, company, tmp_path):
    whole, steps = Job(spark, tmp_path / "a"), Job(spark, tmp_path / "b")
    dated = company.where("Modified IS NOT NULL")
    whole.run([(VIEW, dated)])
    for day in (1, 4, 30):
        steps.run([(VIEW, dated.where(F.col("Modified") <= F.lit(at(day))))])
    assert whole.found() == steps.found()
    assert len(whole.found()) == 4
    assert whole.state.load()["v_Company"].watermark == steps.state.load()["v_Company"].watermark


def test_incremental_run_updates_and_adds(spark, job):
    first = job.run([(VIEW, frame(spark, (1, "a", at(1)), (2, "b", at(2))))])
    assert first.results[0].mode == "full" and first.results[0].watermark == "2026-05-02 09:00:00"
    second = job.run([(VIEW, frame(spark, (1, "late", at(2)), (2, "B", at(3)), (3, "c", at(4))))])
    assert (second.results[0].mode, second.results[0].records) == ("incremental", 2)
    assert job.found() == [("company:1", "a"), ("company:2", "B"), ("company:3", "c")]
    state = job.state.load()["v_Company"]
    assert (state.watermark, state.count) == ("2026-05-04 09:00:00", 2)


def test_run_without_new_rows_keeps_the_watermark(spark, job):
    rows = frame(spark, (1, "a", at(1)))
    job.run([(VIEW, rows)])
    before = job.state.load()
    report = job.run([(VIEW, rows)])
    assert report.results[0].records == 0
    assert job.state.load() == before


def test_one_failing_view_does_not_stop_the_others(spark, job):
    def broken():
        raise RuntimeError("cannot bind")

    rows = frame(spark, (1, "a", at(1)))
    others = [ViewDef(f"v_{n}", n, "CompanyID") for n in ("one", "two", "three")]
    report = job.run([(others[0], rows), (others[1], broken), (others[2], rows)],
                     RunSettings(parallel_views=3))
    assert report.failed_views == ["v_two"]
    assert [r.documents for r in report.results] == [1, 0, 1]
    assert "cannot bind" in report.results[1].error
    assert [i for i, _ in job.found()] == ["one:1", "three:1"]
    assert report.frame(spark).count() == 3 and report.ok
    (event,) = rendered(report.failures(spark, "crm", "r1", at(9))).collect()
    assert event["subject"] == "[crm] view_fetch failure"
    assert event["message"] == "View v_two failed to fetch/build: cannot bind"
    assert event["resolution"] == RESOLUTIONS["view_fetch"] and "r1" in event["chat"]


def test_full_refresh_replaces_and_moves_the_watermark(spark, job):
    job.run([(VIEW, frame(spark, (1, "a", at(1)), (2, "b", at(5))))])
    refresh = RunSettings(full_refresh=True)
    job.run([(VIEW, frame(spark, (1, "A", at(3))))], refresh)
    assert job.found() == [("company:1", "A")]
    assert job.state.load()["v_Company"].watermark == "2026-05-03 09:00:00"


def test_empty_view_is_emptied_but_an_empty_run_is_a_no_op(spark, job):
    other = ViewDef("v_Other", "other", "CompanyID")
    rows = frame(spark, (1, "a", at(1)))
    job.run([(VIEW, rows), (other, rows)])
    refresh = RunSettings(full_refresh=True)
    job.run([(VIEW, rows.where("false")), (other, rows)], refresh)
    assert [i for i, _ in job.found()] == ["other:1"]
    job.run([(VIEW, rows.where("false")), (other, rows.where("false"))], refresh)
    assert [i for i, _ in job.found()] == ["other:1"]


def test_unsaved_run_is_invisible_and_repeated(spark, job):
    job.run([(VIEW, frame(spark, (1, "a", at(1))))])
    job.index.write_batch("v_Company", 1, job.index.batches("v_Company", 0, 0).drop("batch"))
    assert len(job.found()) == 1
    job.run([(VIEW, frame(spark, (1, "a", at(1)), (2, "b", at(2))))])
    assert job.found() == [("company:1", "a"), ("company:2", "b")]


def test_unwritten_documents_fail_the_run(spark, job, monkeypatch):
    def full(*_, **__):
        raise OSError("no space")

    monkeypatch.setattr(job.index, "write_batch", full)
    report = job.run([(VIEW, frame(spark, (1, "a", at(1))))])
    assert not report.ok and report.results[0].error_type == "document_indexing"
    (event,) = rendered(report.failures(spark, "crm", "r1", at(9))).collect()
    assert event["resolution"] == RESOLUTIONS["document_indexing"] and "no space" in event["message"]
    assert job.state.load() == {}


def test_lost_state_leaves_the_old_batches(spark, job, tmp_path):
    job.run([(VIEW, frame(spark, (1, "a", at(1))))])
    before = job.state.load()
    job.state = SyncState(spark, str(tmp_path / "lost"))
    job.run([(VIEW, frame(spark, (1, "b", at(1))))])
    assert job.found() == [("company:1", "b")]
    assert [r["title"] for r in job.index.documents(before).collect()] == ["a"]


def test_user_failure_keeps_the_watermark_but_not_the_documents(spark, job):
    def fail():
        raise OSError("no rights")

    rows = frame(spark, (1, "a", at(1)))
    report = job.run([(VIEW, rows)], write_users=fail)
    assert not report.ok and report.user_error == "no rights"
    assert job.found() == [("company:1", "a")]
    assert job.state.load()["v_Company"].watermark is None
    job.run([(VIEW, rows)])
    assert job.found() == [("company:1", "a")]


def test_watermarks_are_off_without_incremental(spark, job):
    rows = frame(spark, (1, "a", at(1)))
    job.run([(VIEW, rows)], RunSettings(incremental=False))
    report = job.run([(VIEW, rows)], RunSettings(incremental=False))
    assert report.results[0].mode == "full"
    assert job.state.load()["v_Company"].watermark is None


def test_duplicates_and_late_ties(spark, job):
    rows = frame(spark, (1, "old", at(1)), (1, "new", at(2)))
    report = job.run([(VIEW, rows)])
    assert (report.results[0].records, report.results[0].documents) == (2, 1)
    assert job.found() == [("company:1", "new")]


def test_views_that_share_a_type_give_one_document_per_id(spark, job):
    first = ViewDef("v_A", "same", "CompanyID", title_columns=("Name",), watermark_column="Modified")
    second = ViewDef("v_B", "same", "CompanyID", title_columns=("Name",), watermark_column="Modified")

    def found():
        docs = job.index.documents(job.state.load())
        return sorted((r["id"], r["title"]) for r in docs.collect())

    a, b = frame(spark, (1, "a", at(1)), (2, "a", at(1))), frame(spark, (2, "b", at(1)), (3, "b", at(1)))
    job.run([(first, a), (second, b)], now=lambda: at(10))
    assert found() == [("same:1", "a"), ("same:2", "b"), ("same:3", "b")]
    job.run([(first, frame(spark, (2, "A", at(2)))), (second, b)], now=lambda: at(11))
    assert found() == [("same:1", "a"), ("same:2", "A"), ("same:3", "b")]


def test_rows_without_keys_are_numbered(spark, job):
    view = ViewDef("v_N", "n", "CompanyID", title_columns=("Name",), order_columns=("Name",))
    rows = frame(spark, (None, "b", None), (None, "a", None), (7, "c", None))
    report = job.run([(view, rows)], RunSettings(incremental=False, full_refresh=True))
    assert report.results[0].records == 3
    assert job.found() == [("n:0", "a"), ("n:1", "b"), ("n:7", "c")]


def test_rows_without_keys_survive_later_runs(spark, job):
    view = replace(VIEW, order_columns=("Name",))
    job.run([(view, frame(spark, (None, "first", at(1)), (None, "second", at(2))))])
    job.run([(view, frame(spark, (None, "third", at(3)), (None, "third", at(3))))])
    assert [title for _, title in job.found()].count("third") == 2
    assert {title for _, title in job.found()} == {"first", "second", "third"}


def test_a_watermark_moves_without_documents(spark, job):
    job.run([(VIEW, frame(spark, (1, "a", at(1))))])
    nothing = replace(VIEW, build=lambda df, **_: build_documents(df, VIEW).where("id = 'none'"))
    for day in (2, 3):
        job.run([(nothing, frame(spark, (day, "b", at(day))))])
    assert job.state.load()["v_Company"].watermark.startswith("2026-05-03")
    assert [title for _, title in job.found()] == ["a"]


def test_compaction_keeps_the_documents(spark, job):
    for day in (1, 2, 3):
        job.run([(VIEW, frame(spark, (day % 2, f"t{day}", at(day))))])
    before = job.found()
    state = job.state.load()
    job.state.save({v: job.index.compact(s) for v, s in state.items()})
    assert job.found() == before
    compacted = job.state.load()["v_Company"]
    assert compacted.base_batch == compacted.last_batch == 3


def test_one_batch_of_changes_is_merged_without_ranking(spark, tmp_path):
    """Ids of one batch are unique; batches are stored with an entropy coder."""
    index = DocumentIndex(spark, f"{tmp_path}/index")
    rows = spark.range(100).selectExpr("int(id) AS CompanyID", "'x' AS Name", "timestamp_ntz'2026-05-01' AS Modified")
    for batch in range(3):
        later = build_documents(rows.where(f"CompanyID >= {40 * batch}").withColumn("Name", F.lit(f"n{batch}")), VIEW)
        index.write_batch("v_Company", batch, later)
    files = folder_names(spark, f"{tmp_path}/index/view=v_Company/batch=1")
    assert any(".zstd." in f for f in files)
    for last, names in ((1, {"n0": 40, "n1": 60}), (2, {"n0": 40, "n1": 40, "n2": 20})):
        merged = index.view_documents(ViewState("v_Company", base_batch=0, last_batch=last))
        assert ("Window" in merged._jdf.queryExecution().optimizedPlan().toString()) == (last == 2)
        assert dict(merged.groupBy("title").count().collect()) == names


def test_preview_writes_no_index_and_no_state(spark, job, tmp_path, company):
    catalog = ViewCatalog(spark)
    catalog.register(VIEW, lambda: company)
    settings = RunSettings(options=DocumentOptions(view_url="https://e/#/home"))
    report = run_preview(catalog, str(tmp_path / "out"), settings)
    assert report.results[0].documents == 5
    lines = spark.read.text(str(tmp_path / "out" / "view=v_Company")).collect()
    first = next(d for d in map(json.loads, (r[0] for r in lines)) if d["id"] == "company:1")
    assert first["viewUrl"] == "https://e/#/home" and first["body"]["Name"] == "a"
    assert job.state.load() == {} and job.found() == []


def test_catalog(spark, company):
    catalog = ViewCatalog(spark)
    catalog.register(VIEW, lambda: company)
    catalog.register(ViewDef("v_Off", "off", "id", enabled=False), lambda: company)
    catalog.register("v_Adhoc", lambda: company)
    assert list(catalog.enabled()) == ["v_Company"]
    assert [r[0] for r in catalog.list_views().collect()] == ["v_Adhoc", "v_Company", "v_Off"]
    columns = catalog.list_columns("v_Company").orderBy("ordinal").collect()
    assert [tuple(r) for r in columns] == [
        (1, "CompanyID", "int", "YES"), (2, "Name", "string", "YES"), (3, "Modified", "timestamp_ntz", "YES")
    ]
    with pytest.raises(LookupError):
        catalog.list_columns("v_None")


def run_plain(spark, tmp_path, rows, settings=RunSettings(acl_id="all"), directory=None, view=None):
    """One run over a view without a watermark; returns the result and the job's parts."""
    view = view or ViewDef("v_Plain", "plain", "CompanyID", title_columns=("Name",))
    catalog = ViewCatalog(spark)
    catalog.register(view, lambda: spark.createDataFrame(rows, "CompanyID int, Name string"))
    state = SyncState(spark, f"{tmp_path}/state")
    index = DocumentIndex(spark, f"{tmp_path}/documents")
    report = run_index(catalog, state, index, settings, directory=directory)
    return report, state, index


def test_a_view_without_watermark_writes_only_changes(spark, tmp_path):
    rows = [(1, "a"), (2, "b"), (3, None)]
    first, state, _ = run_plain(spark, tmp_path, rows)
    assert (first.results[0].documents, first.results[0].written) == (3, 3)
    again, state, _ = run_plain(spark, tmp_path, rows)
    assert (again.results[0].records, again.results[0].documents, again.results[0].written) == (3, 3, 0)
    assert state.load()["v_Plain"].last_batch == 0
    more, state, index = run_plain(spark, tmp_path, [(1, "x"), (2, "b"), (4, "d")])
    assert more.results[0].written == 3  # one new, one changed, one gone
    docs = index.documents(state.load())
    assert sorted((r["id"], r["title"]) for r in docs.select("id", "title").collect()) == [
        ("plain:1", "x"), ("plain:2", "b"), ("plain:4", "d"),
    ]
    empty, state, index = run_plain(spark, tmp_path, [])
    assert empty.ok and (empty.results[0].records, empty.results[0].documents) == (0, 0)
    assert index.documents(state.load()).count() == 3  # no view gave anything


def test_copies_of_keyless_rows_are_not_written_twice(spark, tmp_path):
    rows = [(None, "a"), (None, "a"), (None, "b"), (7, "c")]
    run_plain(spark, tmp_path, rows)
    again, state, index = run_plain(spark, tmp_path, rows)
    assert again.results[0].written == 0
    assert index.documents(state.load()).count() == 4


def test_folding_leaves_one_batch_and_no_staged_table(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(folder_names(spark, shared))
    settings = RunSettings(acl_id="all", compact_after=1)
    for n in range(4):
        rows = [(None, "k"), (None, "k"), *[(i, f"name {n}") for i in range(3)]]
        _, state, index = run_plain(spark, tmp_path, rows, settings)
    saved = state.load()["v_Plain"]
    assert saved.last_batch - saved.base_batch <= 1
    run_plain(spark, tmp_path, rows, settings)
    left = folder_names(spark, f"{tmp_path}/documents/view=v_Plain")
    assert min(int(n.removeprefix("batch=")) for n in left) == saved.base_batch
    titles = index.documents(state.load()).select("title").collect()
    assert sorted(r["title"] for r in titles if r["title"].startswith("name")) == ["name 3"] * 3
    assert set(folder_names(spark, shared)) == before


def people(spark, tmp_path, users, superusers):
    schema = "datasource_user_id string, email string, name string"
    return Directory(
        spark.createDataFrame(users, schema),
        spark.createDataFrame(superusers, "datasource_user_id string, email string"),
        user_table(spark, f"{tmp_path}/users"),
        reader_table(spark, f"{tmp_path}/readers"),
    )


def test_a_run_writes_users_and_readers(spark, tmp_path):
    who = people(spark, tmp_path, [("1", "a@x", None), ("2", " ", "B")], [("1", "a@x"), ("9", "z@x")])
    _, state, index = run_plain(spark, tmp_path, [(1, "a")], RunSettings(), who)
    assert sorted(r["email"] for r in who.user_table.read().collect()) == ["a@x", "z@x"]
    docs = index.documents(state.load())
    assert docs.select("permissions.acl_id").first()["acl_id"] == "all"
    readers = expand_readers(docs, who.reader_table.read())
    assert sorted(tuple(r) for r in readers.collect()) == [
        ("plain:1", "1", "a@x"), ("plain:1", "9", "z@x"),
    ]


def test_an_empty_reader_list_leaves_permissions_open_to_the_default(spark, tmp_path):
    who = people(spark, tmp_path, [], [])
    _, state, index = run_plain(spark, tmp_path, [(1, "a")], RunSettings(acl_id="all"), who)
    assert index.documents(state.load()).first()["permissions"] is None
    assert who.user_table.read().count() == 0


def test_an_unreadable_directory_opens_nothing(spark, tmp_path):
    who = people(spark, tmp_path, [("1", "a@x", None)], [])
    broken = who.users.withColumn("email", F.raise_error(F.lit("no directory")).cast("string"))
    who = replace(who, users=broken)
    settings = RunSettings(allow_anonymous=True)
    report, state, index = run_plain(spark, tmp_path, [(1, "a")], settings, who)
    assert not report.ok and "no directory" in report.user_error
    assert index.documents(state.load()).first()["permissions"] is None


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_late_rows_within_the_overlap_come_in(spark, job):
    view = replace(VIEW, overlap="2 days")
    job.run([(view, frame(spark, (1, "a", at(10))))])
    rows = frame(spark, (1, "a", at(10)), (2, "late", at(9)), (3, "too late", at(7)))
    second = job.run([(view, rows)]).results[0]
    assert (second.mode, second.records, second.documents, second.written) == ("incremental", 2, 2, 1)
    assert job.found() == [("company:1", "a"), ("company:2", "late")]
    third = job.run([(view, rows)]).results[0]
    assert (third.records, third.written) == (2, 0)
    # Without its newest row a source does not move the watermark back.
    fourth = job.run([(view, frame(spark, (2, "late", at(9))))]).results[0]
    assert fourth.watermark == job.state.load()["v_Company"].watermark == "2026-05-10 09:00:00"
    assert job.found() == [("company:1", "a"), ("company:2", "late")]


def test_a_late_old_version_does_not_replace_the_newest(spark, job):
    view = replace(VIEW, overlap="2 days")
    job.run([(view, frame(spark, (1, "new", at(10))))])
    job.run([(view, frame(spark, (1, "new", at(10)), (1, "old", at(9))))])
    assert job.found() == [("company:1", "new")]


def test_capped_runs_with_an_overlap_get_on(spark, job):
    view = replace(VIEW, overlap="30 days")
    rows = frame(spark, *((i, f"n{i}", at(i)) for i in range(1, 13)))
    for _ in range(5):
        job.run([(view, rows)], RunSettings(row_limit=3))
    assert len(job.found()) == 12


@pytest.mark.parametrize("kind, since, overlap, start", [
    ("int", "100", "7", "93"), ("bigint", "100", "7", "93"), ("double", "1.5", "0.5", "1.0"), ("date", "2026-05-10", "3 days", "2026-05-07"),
    ("timestamp", "2026-05-10 09:00:00", "1 hour", "2026-05-10 08:00:00"), ("timestamp_ntz", "2026-05-10 09:00:00", "1 month", "2026-04-10 09:00:00"),
])
def test_the_overlap_is_pushed_down(spark, tmp_path, kind, since, overlap, start):
    view = replace(VIEW, watermark_column="m", overlap=overlap)
    spark.sql(f"SELECT CAST('{start}' AS {kind}) m, 'at' n UNION ALL SELECT CAST('{since}' AS {kind}), 'since'").write.parquet(f"{tmp_path}/m")
    stored = spark.read.parquet(f"{tmp_path}/m")
    rows = scan(stored, view, since=since)
    assert [r["n"] for r in rows.collect()] == ["since"]
    assert "GreaterThan(m," in physical(rows)


def test_an_overlap_that_is_no_interval_is_an_error(spark):
    with pytest.raises(Exception, match="no interval|INTERVAL"):
        scan(frame(spark, (1, "a", at(1))), replace(VIEW, overlap="some"), since="2026-05-10 09:00:00").collect()


def test_rows_gone_at_the_source_are_removed(spark, job):
    view = replace(VIEW, watermark_column=None)
    job.run([(view, frame(spark, (1, "a", at(1)), (2, "b", at(1)), (3, "c", at(1))))])
    second = job.run([(view, frame(spark, (1, "a", at(1)), (3, "C", at(1))))]).results[0]
    assert (second.documents, second.written) == (2, 2)
    assert job.found() == [("company:1", "a"), ("company:3", "C")]
    job.run([(view, frame(spark, (1, "a", at(1)), (2, "again", at(1)), (3, "C", at(1))))])
    assert job.found() == [("company:1", "a"), ("company:2", "again"), ("company:3", "C")]


def test_capped_or_failed_readings_remove_nothing(spark, job):
    view = replace(VIEW, watermark_column=None)
    rows = frame(spark, (1, "a", at(1)), (2, "b", at(1)))
    job.run([(view, rows)])
    job.run([(view, rows)], RunSettings(row_limit=1))
    broken = rows.withColumn("Name", F.raise_error(F.lit("gone")))
    job.run([(view, broken)])
    assert job.found() == [("company:1", "a"), ("company:2", "b")]


def test_an_empty_view_is_emptied_beside_others(spark, job):
    """As with a full refresh, nothing is removed if no view gives any document."""
    first = replace(VIEW, watermark_column=None)
    other = replace(first, view_name="v_Other", object_type="other")
    rows, none = frame(spark, (1, "a", at(1))), frame(spark, (1, "a", at(1))).where("CompanyID > 1")
    job.run([(first, rows), (other, rows)])
    job.run([(first, none), (other, none)])
    assert len(job.found()) == 2
    job.run([(first, none), (other, rows)])
    assert job.found() == [("other:1", "a")]


def test_ids_of_builders_are_compared_across_views(spark, job):
    def named(title):
        return lambda df, **_: build_documents(df, VIEW).withColumn("id", F.lit("own")).withColumn("title", F.lit(title))

    views = [ViewDef(f"v_{t}", t, "CompanyID", watermark_column="Modified", build=named(t)) for t in ("one", "two")]
    job.run([(v, frame(spark, (1, "a", at(1)))) for v in views], RunSettings(options=DocumentOptions(run_epoch=5)))
    assert job.found() == [("own", "two")]


def test_changes_of_any_size_leave_a_bucketed_base_in_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("vistaflow.plans.index.within_rows", lambda *_: False)
    index = DocumentIndex(spark, f"{tmp_path}/index", buckets=4)
    rows = frame(spark, *((i, f"n{i}", at(1)) for i in range(200)))
    docs = build_documents(rows, VIEW, DocumentOptions(run_epoch=1))
    index.write_batch("v_Company", 0, docs, base=True)
    index.write_batch("v_Company", 1, docs.where("id < 'company:150'").withColumn("title", F.lit("new")))
    state = ViewState("v_Company", base_batch=0, last_batch=1, base_buckets=4)
    merged = index.view_documents(state)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(index.view_documents(state))
        # The base is scanned by bucket right under the join; only changes are exchanged.
        base = plan[: plan.index("Bucketed: true")]
        assert "Exchange" not in base[base.rindex("SortMergeJoin"):]
        assert "SelectedBucketsCount: 4 out of 4" in plan
        one = physical(find_document(merged, "company", "company:7"))
        assert "SelectedBucketsCount: 1 out of 4" in one
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r["id"]: r["title"] for r in merged.collect()}
    assert len(got) == 200 and sum(t == "new" for t in got.values()) == sum(i < "company:150" for i in got)
    folded = index.compact(state)
    assert folded.base_buckets == 4 and index.view_documents(folded).count() == 200
    index.write_batch("v_Company", folded.base_batch, docs, base=True)  # a repeated base replaces itself
    assert index.view_documents(folded).where("title = 'new'").count() == 0


def test_buckets_hold_no_more_rows_as_a_table_grows():
    assert buckets_for(0) == buckets_for(1_600_000) == 8
    assert all(rows / buckets_for(rows) <= 200_000 for rows in (1_600_001, 9_000_000, 54_000_000))


def test_states_of_earlier_versions_are_read(spark, tmp_path):
    state = SyncState(spark, f"{tmp_path}/state")
    state.table.replace(spark.createDataFrame([("v", "w", 1, "now", 0, 2)],
                        "view string, watermark string, count long, last_run string, base_batch long, last_batch long"))
    assert state.load() == {"v": ViewState("v", "w", 1, "now", 0, 2)}
