"""The audit of sources against plain dictionaries, and on awkward tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, n long, p long, block string, parts int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=10, ranks=10):
    docs, count, groups = defaultdict(set), defaultdict(Counter), set()
    for k, (text, lang, source) in enumerate((r[0] or "", r[1] or "", r[2] or "") for r in rows):
        groups.add((lang, source))
        for w in TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text)):
            docs[lang, w].add(k)
            count[lang, source][w] += 1
            count[lang, None][w] += 1
    out = []
    for lang, source in groups:
        kept = [w for (g, w), of in docs.items() if g == lang and len(of) >= least]
        total = lambda s: sum(count[lang, s][w] for w in kept)  # noqa: B023, E731
        p = lambda s, w: 1 + 10**9 * (count[lang, s][w] + 2) // (total(s) + 2 * len(kept))  # noqa: B023, E731
        own, every = {w: p(source, w) for w in kept}, {w: p(None, w) for w in kept}
        pairs = []
        for other in (s for g, s in groups if g == lang and s != source):
            q = {w: p(other, w) for w in kept}
            pairs.append((-sum((own[w] - q[w]) ** 2 // (own[w] + q[w]) for w in kept), other.encode()))
        telling = [(-((own[w] - every[w]) ** 2 // (own[w] + every[w])), w.encode()) for w in kept if count[lang, source][w] and own[w] > every[w]]
        for part, found, most in (("pair", pairs, None), ("term", telling, ranks)):
            out += [(lang, source, part, item.decode(), -v, k) for k, (v, item) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, g, s, 0, "x", 1, 2, "y", 3) for i, (t, g, s) in enumerate(rows)], SCHEMA)
    got = divergence.audit(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def made(n, seed=3):
    random.seed(seed)
    words = ["alpha", "BETA", "gamma", "é", "日本", "İ", "delta", "x"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    for k in range(n):
        lang = random.choice(["en", "de", None])
        source = f"s{min(random.randrange(40), 24)}"
        yield "".join(w + random.choice(" ,\n\x1c0_") for w in random.choices(words, range(len(words), 0, -1), k=random.randrange(40))), lang, source


@pytest.mark.parametrize(("block", "side"), [(1 << 15, 32), (7, 3)])
def test_like_brute_force(spark, monkeypatch, block, side):
    monkeypatch.setattr(divergence, "BLOCK", block)  # many blocks
    monkeypatch.setattr(divergence, "SIDE", side)  # columns dealt out in cells
    check(spark, list(made(300)))


def test_awkward_rows(spark):
    few = [("alone in its language", "xx", "a"), (None, "xx", "b"), ("", None, None), ("1 2 3", "", "q"), ("ÀÉ  \x00 é", None, "z\u0000")]
    check(spark, few)  # no kept terms: values of 0
    check(spark, [("one word", "en", "a")] * 10 + [(None, "en", "b"), ("9", "en", "c"), ("word " * 20_000, "en", "a"), ("a" * 50_000, "en", "d")])
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


runs = st.lists(st.integers(1, 5), min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(runs, runs)
def test_intersected_runs(p, q):
    n = min(len(p), len(q))
    p, q = p[:n], q[:n]

    def encoded(x):
        ends = np.array([k + 1 for k in range(n) if k == n - 1 or x[k] != x[k + 1]])
        return ends, np.array(x)[ends - 1]

    assert divergence.compared(encoded(p), encoded(q)) == sum((a - b) ** 2 // (a + b) for a, b in zip(p, q, strict=True))


def test_order_lengthens_runs(spark):
    """The vocabulary's order makes fewer runs than the terms' own order would."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = divergence.term_counts(docs).where("term is not null")
    kept = counts.groupBy("lang", "term").agg({"docs": "sum"}).where("`sum(docs)` >= 10").select("lang", "term")
    cells = counts.join(kept, ["lang", "term"]).cache()
    groups = cells.groupBy("lang", "source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "total").selectExpr("*", "0L as rest")
    placed = divergence.ordered_terms(cells, groups)
    assert placed.count() == kept.count() and placed.select("block", "at").distinct().count() == kept.count()
    cells = cells.selectExpr("lang", "source", "term", "n as p")
    plain = kept.orderBy("lang", "term").toPandas()
    plain["at"] = plain.groupby("lang").cumcount().astype("int32")
    plain["block"] = plain["lang"].astype("category").cat.codes.astype("int64")
    runs_of = lambda terms: divergence.run_columns(cells, groups, terms).selectExpr("sum(size(ends)) as n").first()["n"]
    by_term = runs_of(spark.createDataFrame(plain[["lang", "term", "block", "at"]]).selectExpr("lang", "term", "block", "cast(at as int) as at"))
    assert runs_of(placed) < 0.9 * by_term
