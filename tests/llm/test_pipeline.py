"""The pipeline on a small folder, stage by stage against what it must keep."""

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402


def test_stages(spark, tmp_path):
    random.seed(17)
    words = [f"w{i}" for i in range(500)]

    def text(n=60, extra=()):
        return " ".join([*random.choices(words, k=n), *extra])

    docs = [(i, text(extra=["nastiness", "horridly"] * 3 if i % 10 == 0 else ())) for i in range(300)]
    base, passage = text(), text(15)
    docs += [(1001, base), (1002, base), (1003, base + " tail"), (1004, text(20) + " " + passage), (1005, ""), (1006, None)]
    docs = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(docs, schema)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, kept = frame, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == frame.columns, name
        kept.append({r["doc_id"] for r in now.collect()})
    clean = {i for i in range(300) if i % 10}
    assert kept[0] == clean | {1001, 1002, 1003, 1004, 1005, 1006}
    assert kept[1] == clean | {1002, 1003, 1004, 1006}
    assert kept[2] == clean | {1002, 1004, 1006}
    assert kept[3] == clean | {1002, 1006}
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in final} == kept[3]
    empty = frame.filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_repeated_ids(spark, tmp_path):
    """Rows of one id with different texts are judged one by one; of equal rows one stays."""
    random.seed(23)
    clean, leaked, other = (" ".join(f"{random.choice('abcdef')}{random.randrange(900)}" for _ in range(40)) for _ in range(3))
    near = clean + " tail"
    rows = [(1, clean), (1, leaked), (2, leaked), (3, clean), (3, clean), (1, other), (1, other), (None, other),
            (None, "alone text here"), (None, "alone text here"), (4, near), (5, None), (6, "")]
    schema = "doc_id long, text string, _key int, keep_id int"
    docs = spark.createDataFrame([(i, t, 5, 6) for i, t in rows], schema)
    spark.createDataFrame([(1, leaked)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def kept(stage, frame):
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns
        return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)

    once = sorted([(2, leaked), (3, clean), (1, other), (None, "alone text here"), (4, near), (6, "")], key=repr)
    assert kept(corpus_pipeline.drop_exact_copies, docs) == once
    unique = spark.createDataFrame([(1, t, 5, 6) if t in (leaked, clean) else (i, t, 5, 6) for i, t in once], schema)
    assert kept(corpus_pipeline.drop_near_copies, unique) == sorted(
        [(1, leaked), (1, clean), (1, other), (None, "alone text here"), (6, "")], key=repr)
    assert kept(corpus_pipeline.drop_benchmark_passages, unique) == sorted(
        [(1, clean), (1, other), (None, "alone text here"), (4, near), (6, "")], key=repr)
