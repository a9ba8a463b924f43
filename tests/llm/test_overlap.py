"""The near-duplicates stage against brute force at five words and similarity 0.8."""

import re
from itertools import combinations

import pytest

import corpus_pipeline
from terrace.llm import overlap


def brute_set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(texts):
    """The doc_ids (of distinct documents) that are the smallest of their component."""
    sets, root = {k: brute_set(x) for k, x in texts.items()}, {k: k for k in texts}
    for a, b in combinations(sorted(texts), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if r == high else r for k, r in root.items()}
    return {k for k, r in root.items() if k == r}


def check(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = [r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect()]
    assert sorted(kept) == sorted(brute_kept(texts))
    return kept


def test_given_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    kept = check(spark, texts)
    assert {1, 6} <= set(kept) and not {145, 177} & set(kept)  # similarity 0.83, more than 3 bits


@pytest.mark.parametrize(("small", "part"), [(16, 2048), (2, 6)])
def test_chains_edges_and_groups(spark, monkeypatch, small, part):
    monkeypatch.setattr(overlap, "SAMPLE_ROWS", 60)
    monkeypatch.setattr(overlap, "SMALL", small)  # keys of few texts are compared in place
    monkeypatch.setattr(overlap, "PART", part)  # and split into cells
    texts = {0: None, 1: "", 2: " \n", 3: "a", 4: "A", 5: "a b c d", 6: "a b c d e"}
    words = [f"w{k}" for k in range(104)]
    for k in range(8):  # a chain whose ends are unlike
        texts[10 + k] = " ".join(words[3 * k :] + [f"x{j}" for j in range(3 * k)])
    for k in range(9, 30):  # exactly 0.8 and beside it: 18 of 20 + n shingles
        texts[20 + k] = " ".join([f"y{j}" for j in range(22)] + [f"z{k}{j}" for j in range(k % 5)])
    for k in range(60):  # many that share a passage
        texts[100 + k] = " ".join([f"p{j}" for j in range(40)] + [f"q{k}.{j}" for j in range(k % 14)])
    check(spark, texts)


def test_no_task_holds_a_crowded_key(spark, monkeypatch):
    """A key outside the sample's sight is dealt out by its exact count: no cell gets more than two parts of it."""
    monkeypatch.setattr(overlap, "SAMPLE_ROWS", 2)
    monkeypatch.setattr(overlap, "SMALL", 3)
    monkeypatch.setattr(overlap, "PART", 8)
    seen = []
    whole = overlap.crowded_candidates

    def counted(rows, firsts):
        cells = rows.groupBy("key").agg({"parts": "max", "node": "count"}).collect()
        seen.extend((r["count(node)"], r["max(parts)"]) for r in cells)
        return whole(rows, firsts)

    monkeypatch.setattr(overlap, "crowded_candidates", counted)
    passage = " ".join(f"p{j}" for j in range(12))
    check(spark, {k: passage + " " + " ".join(f"q{k}.{j}" for j in range(2 + k % 9)) for k in range(90)})
    assert max(n for n, _ in seen) > 60 and all(parts >= n / 8 for n, parts in seen)
