"""What toxicity learns: held-out ranking at each size, the choice of entries, exceptions, and a plain recount."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import toxicity


def ranking(rows):
    """Share of (toxic, clean) pairs that are in order; ties count half."""
    a, b = (np.array([r["score"] for r in rows if r["toxic"] == k]) for k in (1, 0))
    return float(((a[:, None] > b) + 0.5 * (a[:, None] == b)).mean())


@pytest.mark.parametrize(("size", "least"), [("sf0.001", 0.75), ("sf0.01", 0.81), ("sf0.1", 0.95)])
def test_held_out_ranking(spark, size, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert ranking(rows) >= least
    assert sum(r["predicted"] and not r["toxic"] for r in rows) <= 0.01 * len(rows)
    model = toxicity.learn(docs, labels, list(toxicity.EXCEPTIONS))
    assert {"trash", "scum", "loser", "moron"} <= set(model.lexicon)
    for text in ("", "the world of words and work", "the trash can by the pond scum and a clownfish"):
        assert model.score(text.encode()) < toxicity.THRESHOLD
    assert model.score(b"what trash, you scum and loser") > 0.9


def labelled(spark, rows):
    docs = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(rows)], "doc_id long, text string")
    return docs, spark.createDataFrame([(k, 0, y) for k, (_, y) in enumerate(rows)], "doc_id long, quality int, toxic int")


def test_a_shared_beginning_needs_more_than_one_word(spark):
    rows = [("worthless thing", 1)] * 40 + [("worker and world", 0)] * 6 + [("a calm day", 0)] * 200 + [("muttering", 1), ("mutters", 1), ("muttered", 1)] * 12
    model = toxicity.learn(*labelled(spark, rows))
    assert "worthless" in model.lexicon and not {"wor", "wort", "work"} & set(model.lexicon)
    assert any("mutt" in x for x in model.lexicon)


def test_exceptions_are_learnt(spark):
    rows = [("you clown", 1), ("clowns you are", 1)] * 30 + [("the clownfish swims", 0)] * 8 + [("a class clown again", 0)] * 8 + [("a quiet day", 0)] * 300
    model = toxicity.learn(*labelled(spark, rows))
    assert "clown" in model.lexicon and "clownfish" in model.exceptions and "class clown" in model.exceptions
    assert model.score(b"the clownfish swims") == model.score(b"") == model.score(b"class clown") < model.score(b"clown")


def test_entries_by_a_recount(spark):
    """The bound of the evidence and the entries from plain counts over the same rows."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    sample = [(toxicity.folded((r["text"] or "").encode()).split(), r["toxic"]) for r in toxicity.labelled_sample(docs, labels).collect()]
    counts = {1: Counter(), 0: Counter()}
    for words, toxic in sample:
        counts[toxic].update({w[:n] for w in words for n in range(4, min(12, len(w)) + 1) if len(w) >= 4})
    share = (sum(y for _, y in sample) + 0.5) / (len(sample) + 1)

    def ratio(t, c):
        if t <= (t + c) * share:
            return 0.0
        return t * math.log(t / (t + c) / share) + (c * math.log(c / (t + c) / (1 - share)) if c else 0)

    every = {s: ratio(counts[1][s], counts[0][s]) for s in {*counts[1], *counts[0]} if ratio(counts[1][s] + counts[0][s], 0) >= math.log(1000)}
    ranked = sorted((math.floor(v * 20) / 20 for v in every.values()), reverse=True)
    fit = [v for k, v in enumerate(ranked, 1) if (k == len(ranked) or ranked[k] < v) and math.erfc(math.sqrt(v)) / 2 <= 0.05 * k / len(ranked)]
    stems = spark.createDataFrame([(s, counts[1][s], counts[0][s]) for s in {*counts[1], *counts[0]}], "stem string, t long, c long")
    stems = stems.withColumn("evidence", toxicity.evidence(F.col("t"), F.col("c"), share))
    assert toxicity.least_evidence(stems, share) == pytest.approx(min(fit))
    lexicon = toxicity.learn(docs, labels).lexicon
    assert lexicon and all(every[s] >= min(fit) for s in lexicon)


@pytest.mark.parametrize("rows", [[], [("one", 1)], [("one", 0)] * 3, [("same words", 1), ("same words", 0)], [(None, 1), ("", 0)]])
def test_small_and_one_sided_samples(spark, rows):
    docs, labels = labelled(spark, rows)
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
