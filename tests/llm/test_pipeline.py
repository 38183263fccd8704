from __future__ import annotations

import corpus_pipeline
from saldora.llm import neardup
from saldora.llm.decontaminate import contamination
from saldora.llm.rows import table
from saldora.llm.secrets import scan_secrets

from tests_llm_helpers import rows


def test_stages_in_turn(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = (before, docs)
        if name != "mixing":
            assert docs.columns == columns
    before, after = seen["near_duplicates"]
    classes = rows(neardup.near_duplicate_classes(before))
    assert sorted(r["doc_id"] for r in rows(after)) == sorted({r["class_id"] for r in classes})
    before, after = seen["decontamination"]
    clean = [r["doc_id"] for r in rows(contamination(before, table(spark, sf_dir, "benchmark"))) if not r["n_hit"]]
    assert sorted(r["doc_id"] for r in rows(after)) == sorted(clean)
    before, after = seen["secrets"]
    assert before.count() == after.count()
    assert not any(r["spans"] for r in rows(scan_secrets(after)))
    before, after = seen["mixing"]
    assert before.count() == after.count()
    whole = rows(corpus_pipeline.run(spark, sf_dir))
    assert sorted(map(str, whole)) == sorted(map(str, rows(after)))


def test_empty_documents_go_through(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert rows(docs) == []
