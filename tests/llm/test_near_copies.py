"""Texts that share a doc_id are judged on their own; one of equal rows is picked map-side."""

from __future__ import annotations

import corpus_pipeline


def test_texts_of_a_repeated_id_are_judged_alone(spark):
    texts = ["one two three four five six", "other words here and now again", "one two three four five six", "", None]
    rows = [(1, t, {"k": t or ""}) for t in texts] + [(2, "third text of seven words it has", None), (3, texts[1], None), (0, texts[0], None), (None, texts[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,string>")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and kept.columns == docs.columns
    got = [(r["doc_id"], r["text"], r["extra"]) for r in kept.collect()]
    # the copies under ids 0 and 3 tie nothing but themselves together; a null id stays
    want = [(0, texts[0], None), (1, texts[1], {"k": texts[1]}), (1, "", {"k": ""}), (1, None, {"k": ""}), (2, "third text of seven words it has", None), (None, texts[0], None)]
    assert sorted(got, key=str) == sorted(want, key=str)
