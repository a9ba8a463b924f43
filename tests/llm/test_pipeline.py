"""The pipeline against its stages' definitions, applied by brute force where that is possible."""

import math

from test_operators import AWKWARD, check_packing
from test_overlap import brute_kept

import corpus_pipeline
from terrace.llm import language, registry, toxicity
from terrace.llm.common import stored, table

DATA = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, DATA, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    identified = stages["language"](spark, docs, DATA)
    assert identified.columns == docs.columns
    expected = {r["doc_id"] for r in language.document_languages(docs).where("accepted").collect()}
    assert {r["doc_id"] for r in identified.collect()} == expected

    civil = stages["toxicity"](spark, identified, DATA)
    assert civil.columns == docs.columns
    toxic = {r["doc_id"] for r in toxicity.toxicity(identified, table(spark, DATA, "labels")).where("predicted = 1").collect()}
    expected -= toxic
    assert toxic and {r["doc_id"] for r in civil.collect()} == expected

    single = stages["near_duplicates"](spark, civil, DATA)
    assert single.columns == docs.columns
    first = brute_kept({k: texts[k] for k in expected})
    assert {r["doc_id"] for r in single.collect()} == first < expected

    rows = corpus_pipeline.run(spark, DATA).collect()
    n, total = check_packing(rows, {k: texts[k] for k in first}, 2048)
    assert n <= math.ceil(total / 2048) * 1.02 + 1


def test_every_operator_is_registered():
    numbers = {int(n[2:].split("_")[0]) for n in registry.queries() if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in registry.queries()


def test_stages_on_awkward_tables(spark):
    """Null, empty, long and repeated texts, extra columns, and an empty table: stages keep the columns and don't crash."""
    rows = [(i, t, None if i % 5 == 0 else "en", "s", 0, "x", "y") for i, t in enumerate([*AWKWARD, *AWKWARD])] + [(None, "the same text of some words", None, None, None, None, None), (3, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, node string")
    for d in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            before, d = d, stored(stage(spark, d, DATA), name)
            if name != "packing":
                assert d.columns == docs.columns and d.count() <= before.count()
        assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(d.columns)
        assert d.count() == 0 or {r["doc_id"] for r in d.collect()} <= {r["doc_id"] for r in docs.collect()}
