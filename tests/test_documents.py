"""Term counts of documents are made where the documents lie."""

import re

from tastegrid.operators import text
from tastegrid.plans import catalog


def test_texts_are_dealt_by_document_before_they_are_cut(spark, tmp_path, monkeypatch):
    rows = [(i, "a b a c") for i in range(20)] + [(None, "x"), (None, "x y"), (3, "a d"), (21, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    stored = []
    monkeypatch.setattr(text, "materialize", lambda df: stored.append(df) or df)
    assert catalog.Domain(spark, str(tmp_path)).document_weights.filter("doc_id = 3").count() == 4
    plan = stored[0]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(doc_id#\d+L?, ", plan)) == 1
    assert not re.search(r"hashpartitioning\(doc_id#\d+L?, term", plan)
    counts = {(r.doc_id, r.term): r.tf for r in stored[0].collect()}
    assert counts[(3, "a")] == 3 and counts[(3, "d")] == 1 and counts[(None, "x")] == 2 and counts[(21, "")] == 1
