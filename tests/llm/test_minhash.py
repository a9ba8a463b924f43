"""MinHash near-duplicates against brute force on full sets, and on awkward tables."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from terrace.llm import minhash

SCHEMA = "doc_id long, text string, lang string, node long, size string, mins string, key int, kept int"


def brute_set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of every row."""
    sets = [brute_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    out = [(doc, len(sets[k]), least.get(find(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows)]
    return sorted(((*r, r[0] == r[2]) for r in out), key=repr)


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", 1, "x", "y", 2, 3) for i, t in rows], SCHEMA)
    got = minhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def groups():
    """Chains, groups of near copies, and texts just beside the limit."""
    random.seed(5)
    words = [f"w{k}" for k in range(120)]
    rows = [(500 + k, " ".join(words[2 * k :] + [f"x{j}" for j in range(2 * k)])) for k in range(10)]  # a chain whose ends are unlike
    for n in range(10):  # 17 of 20 + n shingles
        rows.append((600 + n, " ".join([f"y{j}" for j in range(19)] + [f"z{n}.{j}" for j in range(n)])))
    base = [f"b{k}" for k in range(150)]
    for k in range(60):  # near copies: up to four words are other ones
        copy = list(base)
        for at in random.sample(range(150), k % 5):
            copy[at] = f"c{k}.{at}"
        rows.append((700 + k, " ".join(copy)))
    for k in range(60):  # share most, but not enough
        rows.append((800 + k, " ".join([f"d{j}" for j in range(70)] + [f"e{k}.{j}" for j in range(12 + k % 6)])))
    return rows


@pytest.mark.parametrize(("part", "each", "held"), [(2048, 256, 1 << 16), (7, 3, 50)])
def test_like_brute_force(spark, monkeypatch, part, each, held):
    monkeypatch.setattr(minhash, "PART", part)  # crowded keys are split into cells
    monkeypatch.setattr(minhash, "EACH", each)
    monkeypatch.setattr(minhash, "HELD", held)
    check(spark, groups())


def test_later_rounds_alone(spark, monkeypatch):
    """The third round alone finds all links: no head is met before."""
    monkeypatch.setattr(minhash, "heads", lambda shared: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(minhash, "PART", 9)
    check(spark, groups())


def test_awkward_rows(spark):
    long = "word " * 30_000
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "a"), (4, "A"), (5, "a b"), (6, "A\x0bB "), (7, "a b c"), (7, "a b c"), (7, "other text of this id"), (None, "a b c"), (None, "alone without id here"), (None, None)]
    rows += [(20, long), (21, long + "end"), (22, "x" * 60_000), (23, "É é"), (24, "é é"), (25, "x\x1cy z"), (26, "x y z")]
    check(spark, rows)
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    check(spark, [(k, "the same text in every row") for k in range(50)])


def test_minhashes_estimate_similarity():
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 1 << 63, n, np.uint64) for n in (7000, 1500, 1500))  # similarity 0.7
    found = [minhash.minhashes([np.unique(np.r_[both[k::10], a[k::10]]), np.unique(np.r_[both[k::10], b[k::10]])]) for k in range(10)]
    assert abs(np.mean([(x[0] == x[1]).mean() for x in found]) - 0.7) < 0.08


def test_tables_are_pairs_of_pieces(spark):
    mins = spark.createDataFrame([(list(range(36)),), ([*range(18), *range(100, 118)],), ([0, 1, *range(200, 216), 18, 19, *range(300, 316)],)], "mins array<int>")
    first, second, third = ([*r["k"]] for r in mins.select(minhash.table_keys(mins["mins"]).alias("k")).collect())
    assert len(set(first)) == minhash.TABLES**2 and not set(first) & set(second)  # a piece of one collection alone makes no key
    assert set(first) & set(third) == {first[0]}
