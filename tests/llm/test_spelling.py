"""Spelling variants against a comparison of all words, and on awkward tables."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import spelling

SCHEMA = "doc_id long, text string, word string, n string, node int, form int, way int, depth int"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(rows):
    count = Counter()
    for doc, text in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            r = "".join(c.lower() if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if doc is None else doc}:{r}".encode())
            count[r if h % 199 else r[: h % len(r)] + r[h % len(r) + 1 :]] += 1
    n = {w: k for w, k in count.items() if len(w) >= 6 and k >= 5}
    by_gap = {}
    for w in n:
        for k in range(len(w) + 1):
            by_gap.setdefault(w[:k] + w[k + 1 :], set()).add(w)
    nears = {w: set() for w in n}
    for some in by_gap.values():
        for a in some:
            nears[a] |= {b for b in some if near(a, b)}
    form = {w: m for w, of in nears.items() if of and n[m := min(of, key=lambda x: (-n[x], x))] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w, ""), root(w), n[w], len(nears[w]), n[form[w]] if w in form else -1) for w in n)


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", "y", 1, 2, 3, 4) for i, t in rows], SCHEMA)
    got = spelling.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in got.collect())
    assert found == brute(rows)
    return found


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = check(spark, rows)
    assert any(form and form != root for _, form, root, *_ in found)


@pytest.mark.parametrize("levels", [1, 4])
def test_dense_words(spark, monkeypatch, levels):
    """Many words of few letters: each is near to dozens of others; chains of forms over several steps."""
    monkeypatch.setattr(spelling, "LEVELS", levels)
    random.seed(7)
    words = list({"".join(random.choices("aabé", k=random.randint(6, 9))) for _ in range(700)})
    rows = [(k, " ".join(random.choices(words, range(1, len(words) + 1), k=200))) for k in range(60)]
    chain = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcqezyx"]
    rows += [(100 + k, f"{w} " * 5 * 6**k) for k, w in enumerate(chain)]
    found = check(spark, rows)
    assert ("abcdefgh", "abcdefgx", "abcqezyx") in {f[:3] for f in found}


def test_awkward_rows(spark):
    rows = [(None, "straße " * 6 + "Straßen " * 40), (0, None), (1, ""), (2, "1 2 _"), (3, "ÀÉÎÕÜß " * 9 + "àéîõüß " * 9), (4, "x÷×yzab " * 5), (5, "abcdefĀghijkl日本mnopqr " * 5), (6, "a" * 50_000), (6, "a" * 50_000)]
    rows += [(7, "prefix " * 50 + "prefixe " * 5 + "refix " * 9), (8, "word\x00worded " * 7)] + [(9, ("b" * 40 + " ") * 5), (9, ("b" * 41 + " ") * 30)]
    check(spark, rows)
    check(spark, [(1, "no word is frequent enough here")])
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_word(spark):
    check(spark, [(k, "single") for k in range(8)])


def test_no_state_starts_at_the_root(spark):
    """Branches begin at the middle of a word, so that a shared beginning of all words costs little."""
    words = spark.createDataFrame([(f"commonbeginning{k:03d}",) for k in range(300)], "word string")
    assert spelling.near_words(words).count() == 300 * (2 + 9 + 9)


@settings(max_examples=300, deadline=None)
@given(st.text("abÀÿĀ日A1 ", max_size=30))
def test_runs(text):
    expected = ["".join(c.lower() if "A" <= c <= "Z" else c for c in r) for r in re.findall("[A-Za-zÀ-ÿ]+", text)]
    assert [r.decode("latin-1") for r in spelling.runs(text)] == expected
