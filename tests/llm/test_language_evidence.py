"""Posteriors against a brute-force computation, known shares, and hosts that hold most rows."""

import math

import pytest
from pyspark.sql import functions as F

from terrace.llm import language

DATA = "/root/testdata/sf0.001"


def brute_posteriors(model, rows, values):
    """Posteriors of rows (text, then values by name in the order of ``values``: declared, suffix, domain, host)."""
    n = len(model.languages)

    def normal(logs):
        top = max(logs)
        w = [math.exp(x - top) for x in logs]
        return [x / sum(w) for x in w]

    texts, own = [], []
    for text, *_ in rows:
        grams = [g for w in (text or "").split() for g in language.trigrams(w.lower())]
        scale = min(1.0, language.INDEPENDENT / max(1, len(grams)))
        texts.append([scale * sum(model.logs[model.place.get(g, 0)][k] for g in grams) for k in range(n)])
        own.append(normal(texts[-1]) if grams else None)
    out = []
    for i, row in enumerate(rows):
        others = [j for j in range(len(rows)) if j != i and own[j]]
        mass = [1 + sum(own[j][k] for j in others) for k in range(n)]
        base = [x / sum(mass) for x in mass]

        def given(position, above, weight, i=i, row=row, others=others):
            if row[position] is None or not any(own[j] and rows[j][position] == row[position] for j in range(len(rows))):
                return above
            same = [j for j in others if rows[j][position] == row[position]]
            return [(sum(own[j][k] for j in same) + weight * above[k]) / (len(same) + weight) for k in range(n)]

        logs, prior = list(texts[i]), base
        for position, name in enumerate(values, 1):
            if name in ("declared", "suffix"):
                logs = [x + math.log(q / b) for x, q, b in zip(logs, given(position, base, language.VALUE_WEIGHT), base, strict=True)]
        for name, weight in (("domain", language.DOMAIN_WEIGHT), ("host", language.HOST_WEIGHT)):
            if name in values:
                prior = given(values.index(name) + 1, prior, weight)
        out.append(normal([x + math.log(p) for x, p in zip(logs, prior, strict=True)]))
    return out


@pytest.mark.parametrize("sent", [50_000, 3])
def test_posteriors(spark, monkeypatch, sent):
    monkeypatch.setattr(language, "SENT_ROWS", sent)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language.learn(docs)
    words = [r["text"].split()[:12] for r in docs.where("length(text) > 200").orderBy("doc_id").limit(40).collect()]
    rows = []
    for k, w in enumerate(words):
        text = None if k % 13 == 0 else " ".join(w[: k % 12])
        rows.append((k, text, [None, "en", "fr"][k % 3], [None, "de"][k % 2], None if k % 7 == 0 else f"d{k % 4}", None if k % 5 == 0 else "hot" if k % 3 else f"h{k % 8}"))
    rows += [(100, rows[5][1], *rows[5][2:])]
    df = spark.createDataFrame(rows, "id long, text string, declared string, suffix string, domain string, host string")
    stored = language.stored(language.with_text_evidence(df, model), "evidence")
    found = {r["id"]: r for r in language.identify(stored, model, "declared", "suffix", "host", "domain").collect()}
    expected = brute_posteriors(model, [r[1:] for r in rows], ["declared", "suffix", "domain", "host"])
    assert len(found) == len(rows)
    for row, p in zip(rows, expected, strict=True):
        if row[1] and row[1].strip():
            assert found[row[0]]["posterior"] == pytest.approx(max(p), rel=1e-4)
            assert found[row[0]]["lang"] == model.languages[p.index(max(p))] or sorted(p)[-2] == pytest.approx(max(p), rel=1e-4)
        else:
            assert found[row[0]]["lang"] == "und" and not found[row[0]]["accepted"]
    assert found[100]["posterior"] == found[5]["posterior"]


def test_each_language_is_learnt_and_unknown_text_goes(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rare = spark.createDataFrame([(10_000 + k, "тёмная ночь только пули свистят по степи", "ru") for k in range(4)], "doc_id long, text string, lang string")
    many = docs.select("doc_id", "text", "lang").unionByName(rare)
    assert "ru" in language.learn(many, rows=40).languages
    unknown = spark.createDataFrame([(1, "これは日本語の文章です 言語が違います", "x", "s"), (2, "the house and the garden of the man", "x", "s")], "doc_id long, text string, lang string, source string")
    model = language.learn(docs)
    rows = unknown.select("doc_id", F.col("source").alias("host"), "text")
    found = {r["doc_id"]: r["accepted"] for r in language.identify(language.stored(language.with_text_evidence(rows, model), "e"), model, host="host").collect()}
    assert not found[1]


def test_awkward_pages(spark):
    schema = "page_id long, url string, html string, lang string, host string, _p int, accepted string"
    page = "<html lang=en><p>" + "the house and the garden " * 20_000
    rows = [(1, "http://a.b.example.org/x", page, None, "h", 1, "x"), (1, "http://a.b.example.org/x", page, None, "h", 1, "x"), (2, None, None, "q", None, None, None), (3, "no address", "", None, None, None, None), (None, "http://x.org", "<p>bonjour", None, None, None, None)]
    found = language.page_languages(spark.createDataFrame(rows, schema), spark.read.parquet(f"{DATA}/documents.parquet"))
    assert found.columns == ["page_id", "lang", "posterior", "accepted", "declared"]
    assert len({tuple(r) for r in found.where("page_id = 1").collect()}) == 1 and found.count() == 5
