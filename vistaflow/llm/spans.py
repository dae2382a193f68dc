"""Spans found in texts: kinds, positions and their written form."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vistaflow.llm.arrow_text import record_batch, slices


class Span(NamedTuple):
    """``kind`` found in text[start:end], in code points."""

    kind: str
    start: int
    end: int


def written(spans: Iterable[Span], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then kind as listed, then end, joined by commas."""
    order = {kind: i for i, kind in enumerate(kinds)}
    ranked = sorted(spans, key=lambda s: (s.start, order[s.kind], s.end))
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in ranked)


def scan_spans(docs: DataFrame, find: Callable[[str], tuple[list[Span], list[Span]]],
               base: tuple[str, ...], kinds: tuple[str, ...], id_col: str,
               text_col: str) -> DataFrame:
    """One row per row: id, n_<base kind>, base_sha256, spans; ``find`` gives base and added."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType),
        *(StructField(f"n_{kind}", LongType()) for kind in base),
        StructField("base_sha256", StringType()), StructField("spans", StringType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in slices(batches, text_col):
            columns = {f.name: [] for f in out} | {id_col: batch.column(id_col)}
            for text in batch.column(text_col).to_pylist():
                found, added = find(text) if text else ([], [])
                for kind in base:
                    columns[f"n_{kind}"].append(sum(s.kind == kind for s in found))
                line = written(found, kinds)
                columns["base_sha256"].append(hashlib.sha256(line.encode()).hexdigest())
                columns["spans"].append(written([*found, *added], kinds) if added else line)
            yield record_batch(columns, out)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
