"""The indexing job as a micro-batch stream: new files in, newest documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vistaflow.model import DocumentOptions, ViewDef
from vistaflow.plans.documents import needed_columns, shaped_documents
from vistaflow.plans.index import DocumentIndex
from vistaflow.plans.state import ViewState
from vistaflow.sources.files import folder_names


def stream_documents(
    rows: DataFrame,
    view: ViewDef,
    index: DocumentIndex,
    checkpoint: str,
    options: DocumentOptions = DocumentOptions(),
    *,
    shift: int = 0,
    acl_id: str | None = None,
    allow_anonymous: bool = False,
) -> StreamingQuery:
    """Upsert the documents of all rows that have arrived, then stop.

    The epoch is the batch number of the index: an epoch that is run again after a failure
    replaces its own batch. The checkpoint is the commit; there is no second state to keep.
    ``shift`` is the number of compactions so far; each took one batch number. Rows are named
    and opened as in an incremental run: ``acl_id`` names their reader list.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        docs = shaped_documents(
            batch, view, options, acl_id=acl_id, allow_anonymous=allow_anonymous
        )
        index.write_batch(view.view_name, epoch + shift, docs)

    return (
        needed_columns(rows, view, options)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def committed_epoch(spark: SparkSession, checkpoint: str) -> int:
    """The last epoch the stream's checkpoint holds as done; -1 before the first."""
    names = folder_names(spark, f"{checkpoint}/commits")
    return max((int(n) for n in names if n.isdigit()), default=-1)


def stream_state(
    index: DocumentIndex, view: ViewDef, checkpoint: str, *, base_batch: int = 0, shift: int = 0
) -> ViewState:
    """The batches of a view fed by a stream with this checkpoint.

    ``index.compact`` folds them into one; go on with its base batch and a higher shift.
    """
    last = committed_epoch(index.spark, checkpoint) + shift
    return ViewState(view.view_name, base_batch=base_batch, last_batch=last)
