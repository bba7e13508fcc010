"""Each stage on its own input, and the whole on the smallest tables."""

import numpy as np

import corpus_pipeline
from lexispark.llm import decontaminate, langid, quality
from lexispark.llm.common import table

from .helpers import SF
from .test_decontaminate import brute as leaks
from .test_neardup import brute as classes


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "decontamination", "sentencepiece"]
    step = dict(corpus_pipeline.STAGES)
    cols = docs.columns

    model = langid.train(langid.training_rows(docs))
    found = {r.doc_id: r for r in langid.predict(docs.select("doc_id", "text"), model).collect()}
    kept = step["language"](spark, docs, SF)
    assert kept.columns == cols and {r.doc_id for r in kept.collect()} == {d for d, r in found.items() if r.lang_pred != "und" and r.fit >= -np.log(model.letters)}

    scored = {r.doc_id: r.keep for r in quality.classify(docs, table(spark, SF, "labels")).collect()}
    kept = step["quality"](spark, docs, SF)
    assert kept.columns == cols and {r.doc_id for r in kept.collect()} == {d for d, k in scored.items() if k}

    given = [tuple(r) for r in docs.collect()]
    kept = step["near_duplicates"](spark, docs, SF)
    assert kept.columns == cols and {r.doc_id for r in kept.collect()} == {c for c, _, _ in classes(given).values()}

    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    kept = step["decontamination"](spark, docs, SF)
    assert kept.columns == cols and {r.doc_id for r in kept.collect()} == {r[0] for r in leaks(given, items) if not r[5]}
    assert decontaminate.report(docs, table(spark, SF, "benchmark")).where("contaminated").count() > 0


def test_run_is_the_stages_one_after_the_other(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "sample", "ids", "logp", "log_inclusion", "decoded"]
    got = out.collect()
    ids = {r.doc_id for r in got}
    assert 0 < len(ids) < 200 and all(r.decoded for r in got)
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert ids == {r.doc_id for r in docs.collect()}


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
