"""The micro-batch form of the indexing job."""

import datetime

from vistaflow.model import ViewDef
from vistaflow.plans.index import DocumentIndex
from vistaflow.streaming.upserts import committed_epoch, stream_documents, stream_state

VIEW = ViewDef("v_S", "s", "id", title_columns=("t",), watermark_column="w", order_columns=("id",))
SCHEMA = "id int, t string, w timestamp_ntz"


def test_second_run_reads_new_files_only(spark, tmp_path):
    index = DocumentIndex(spark, str(tmp_path / "index"))
    checkpoint, source = str(tmp_path / "checkpoint"), str(tmp_path / "in")

    def arrive(*rows):
        stamped = [(i, t, datetime.datetime(2026, 1, d)) for i, t, d in rows]
        spark.createDataFrame(stamped, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run(**kwargs):
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        shift = kwargs.get("shift", 0)
        stream_documents(stream, VIEW, index, checkpoint, shift=shift).awaitTermination()
        docs = index.view_documents(stream_state(index, VIEW, checkpoint, **kwargs))
        return sorted((r["id"], r["title"]) for r in docs.collect())

    assert committed_epoch(spark, checkpoint) == -1
    arrive((1, "a", 1), (1, "b", 2), (2, "c", 1))
    assert run() == [("s:1", "b"), ("s:2", "c")]
    assert run() == [("s:1", "b"), ("s:2", "c")]
    assert committed_epoch(spark, checkpoint) == 0
    arrive((2, "C", 3), (3, "d", 3))
    assert run() == [("s:1", "b"), ("s:2", "C"), ("s:3", "d")]
    assert index.batches("v_S", 1, 1).count() == 2

    folded = index.compact(stream_state(index, VIEW, checkpoint))
    assert (folded.base_batch, folded.last_batch) == (2, 2)
    after = {"base_batch": folded.base_batch, "shift": 1}
    assert run(**after) == [("s:1", "b"), ("s:2", "C"), ("s:3", "d")]
    arrive((3, "D", 4), (4, "e", 4))
    assert run(**after) == [("s:1", "b"), ("s:2", "C"), ("s:3", "D"), ("s:4", "e")]
    assert index.batches("v_S", 3, 3).count() == 2
