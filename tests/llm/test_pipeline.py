"""The pipeline: decisions take effect, columns hold, stages agree with plain versions."""

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from quire.llm import pii
from quire.llm.common import table
from tests.llm.test_text_operators import hits_by_hand, spans_by_hand


def test_stages(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    columns, bench = docs.columns, [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    ids = {}
    for number, (name, stage) in enumerate(pipeline.STAGES):
        before = docs
        docs = stage(spark, before, sf)
        if number < len(pipeline.STAGES) - 1:
            assert docs.columns == columns
        docs.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        ids[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "decontamination":
            held = {r["doc_id"]: r["text"] for r in before.collect()}
            assert set(ids[name]) == {i for i, t in held.items() if not hits_by_hand(t, bench)[1]}
        if name == "pii":
            assert set(ids[name]) == set(ids["decontamination"])
            for i, t in ids[name].items():
                assert not spans_by_hand(t) or ids["decontamination"][i] != t
                if not pii._ANCHOR.search(ids["decontamination"][i]):
                    assert t == ids["decontamination"][i]
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "mixing"]
    last = docs.toPandas()
    assert (last["taken"] > 0).all() and (last["taken"] <= 2 * last["size"]).all()


def test_run_on_nothing(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        table(spark, "/root/testdata/sf0.001", t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


#: Every name that some stage uses for itself.
INTERNAL = (
    "items", "spans", "n_hit", "n_words", "score", "predicted", "y", "m_id", "m_tie", "_tie", "tie", "spread", "rank", "bucket", "start", "block", "words", "fp", "keys", "root", "node", "n_id", "n_tie", "j_id", "j_tie", "stays", "n",
    "f_id", "f_tie", "first", "__quality", "chosen_id", "body", "one", "source_size", "g_source", "kind", "base_spans", "__aside_0", "__aside_3", "a.dot", "draws", "shard",
)


def test_stages_keep_columns_of_any_name(spark, sf):
    docs = table(spark, sf, "documents").where("doc_id < 60")
    odd = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in INTERNAL])
    assert len(odd.columns) == len(docs.columns) + len(INTERNAL)
    for name, stage in pipeline.STAGES:
        got = stage(spark, odd, sf)
        assert got.columns[: len(odd.columns)] == odd.columns and [f.dataType for f in got.schema][: len(odd.columns)] == [f.dataType for f in odd.schema], name
        rows = got.select("doc_id", *[F.col(f"`{c}`") for c in INTERNAL]).collect()
        assert rows and all(r[c] == f"{c}:{r['doc_id']}" for r in rows for c in INTERNAL), name
        plain = stage(spark, docs, sf)
        assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in plain.select("doc_id").collect()}, name


def test_stages_on_nulls_ties_and_repeated_rows(spark, sf):
    rows = [(1, "a plain text of some words"), (1, "a plain text of some words"), (2, None), (2, None), (None, "a text without an id"), (None, None), (3, ""), (4, " "), (5, "long " * 30_000), (6, "mail x@example.org")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES:
        got = stage(spark, docs, sf)
        assert got.columns[:5] == docs.columns and 0 <= got.count() <= len(rows), name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
