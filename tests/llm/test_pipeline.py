from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from shelfwise.llm.common import stage
from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGE, rows_of, texts_of
from tests.llm.test_jaccard import brute as brute_groups
from tests.llm.test_phrases import brute as brute_hits
from tests.llm.test_quality_pii import contract_spans


def test_each_stage_on_what_the_last_one_kept(spark, documents):
    docs, seen = documents.select(*pipeline.COLUMNS), []
    items = rows_of(spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text"))
    for _, apply in pipeline.STAGES:
        seen.append(texts_of(docs) if "text" in docs.columns else None)
        docs = stage(apply(spark, docs, SF_SMALL), "test")
        if len(seen) < len(pipeline.STAGES):
            assert docs.columns == list(pipeline.COLUMNS)
    scored, grouped, clean, plain = seen[1:]
    assert 0.7 * len(seen[0]) < len(scored) < len(seen[0])
    first = {i for i, _, c in brute_groups(scored, 5, 80) if i == c}
    assert {i for i, _ in grouped} == first
    dirty = {r[0] for r in brute_hits(grouped, items, 13) if r[-1]}
    assert sorted(i for i, _ in clean) == sorted(i for i, _ in grouped if i not in dirty)
    assert [i for i, _ in sorted(plain)] == [i for i, _ in sorted(clean)]
    before = dict(clean)
    for i, text in plain:
        assert not contract_spans(text)
        assert text == before[i] or contract_spans(before[i])
    assert {r["doc_id"] for r in docs.collect()} == {i for i, _ in plain}


def test_edge_rows_and_empty_tables_go_through_every_stage(spark, edge, nothing, tmp_path):
    """Nulls, blanks, ties, repeated rows, a null id, long texts and clashing columns."""
    rows = edge.withColumns({"lang": F.lit(None).cast("string"), "source": F.col("label"), "n_chars": F.length("text")})
    for name, docs in (("edge", rows), ("nothing", nothing)):
        root = f"{tmp_path}/{name}"
        docs.withColumn("n_chars", F.col("n_chars").cast("long")).write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
        out = pipeline.run(spark, root).collect()
        gone = {i for i, _, c in brute_groups(EDGE, 5, 80) if i is not None and i != c} if name == "edge" else set()
        left = [i for i, _ in EDGE if i not in gone] if name == "edge" else []
        whole = [r["doc_id"] for r in out if r["piece"] == 0]
        assert sorted(map(str, whole)) == sorted(map(str, left))
        assert all(r["length"] <= 4096 for r in out)
