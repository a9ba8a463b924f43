"""Each operator against a brute-force version, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from terrace.llm import bpe, components, html_text, language, media, packing, simhash, token_store, tokens, topk, toxicity, url_filter
from terrace.llm.common import new_path

PATH = tokens.default_tokenizer()
LIBRARY = tokens.load_tokenizer(PATH)

AWKWARD = [
    None,
    "",
    " \n\t ",
    "a",
    "The quick brown fox jumps over the lazy dog.",
    "The quick brown fox jumps over the lazy dog.",
    "THE QUICK brown fox  jumps over the lazy dog.",
    "ΑΣ Σ İstanbul é naïve 日本語 🙂🙂 x\x1cy\x85z\xa0w",
    "<|endoftext|> it's <|startoftext|>we'll </w> <|ENDOFTEXT|>",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa!!!!!!!!!!!!!!!!!!12345",
    "word " * 30_000,
    "x" * 60_000,
]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, fp string, length int, ids string, _kept int, _score int, label int"


def table(spark, texts):
    return spark.createDataFrame([(i, t, None if i % 5 == 0 else "en", None if i % 3 == 0 else f"s{i % 2}", 0, "x", "y", 1, "z", 2, 3, 4) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def awkward(spark):
    return table(spark, AWKWARD)


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


# 1


def brute_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {p: find(p) for p in root}


def test_simhash(spark, awkward, sample):
    for docs in (awkward, sample):
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        prints = {k: brute_fingerprint(t) for k, t in texts.items()}
        roots = brute_components(set(prints.values()))
        least = {}
        for k in sorted(prints):
            least.setdefault(roots[prints[k]], k)
        found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
        assert found == {k: (f"{p:016x}", least[roots[p]]) for k, p in prints.items()}


def test_simhash_cells_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 16)
    rng = random.Random(3)
    centers = [rng.getrandbits(64) for _ in range(4)]
    prints = {c for c in centers} | {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for c in centers for _ in range(150)} | {rng.getrandbits(64) for _ in range(100)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fp long")
    found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in components.components(simhash.link_forest(df)).collect()}
    groups, expected = {}, {}
    for p, r in brute_components(prints).items():
        expected.setdefault(r, set()).add(p)
    for p in prints:
        groups.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_gray_tree():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (600, 3)).astype(np.uint64)
    prints = np.unique(np.concatenate([base, np.repeat(base, 15) ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]]))
    tree = simhash.GrayTree(prints)
    q, leaf = tree.within(prints, 3)
    expected = np.argwhere(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    assert {*zip(q.tolist(), leaf.tolist(), strict=True)} == {*map(tuple, expected.tolist())}


def test_long_chain_is_one_component(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(pairs).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {1001: 1000}


def test_keep_one(spark, awkward):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert {0, 3, 4} <= {r["doc_id"] for r in kept.collect()} and not {1, 2, 5, 6} & {r["doc_id"] for r in kept.collect()}


# 2


def test_language(spark, awkward):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.document_languages(docs).join(docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out")), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and sum(r["lang"] == r["declared"] for r in out) >= 0.98 * len(out)
    assert language.keep_identified(docs).count() >= 0.99 * len(rows)
    found = {r["doc_id"]: r for r in language.document_languages(awkward).collect()}
    assert len(found) == len(AWKWARD) and {found[k]["lang"] for k in (0, 1, 2)} == {"und"} and not found[0]["accepted"]
    assert language.keep_identified(awkward).columns == awkward.columns


def test_language_evidence_is_fused(spark):
    pages = spark.createDataFrame([(i, f"https://h{i % 2}.example.org/x", f'<html lang="{"fr" if i % 2 else "en"}"><p>{"le la est une dans" if i % 2 else "the and of that this"} {i}') for i in range(40)] + [(40, None, None), (41, "https://h1.example.org/y", '<html lang="fr"><p>zzz')], "page_id long, url string, html string")
    docs = spark.createDataFrame([(i, ("le la est une dans pour " if i % 2 else "the and of that this with ") * 3, "fr" if i % 2 else "en") for i in range(80)], "doc_id long, text string, lang string")
    found = {r["page_id"]: r for r in language.page_languages(pages, docs).collect()}
    assert all(found[i]["lang"] == ("fr" if i % 2 else "en") for i in range(40))
    assert found[41]["lang"] == "fr" and found[40]["lang"] == "und" and found[40]["declared"] is None


# 3, 8


def test_bpe_is_the_librarys(spark, awkward, sample):
    for docs in (awkward, sample.limit(40)):
        found = {r["doc_id"]: r for r in bpe.encode_decode(docs, PATH).collect()}
        digests = {r["doc_id"]: r for r in bpe.digests(docs, PATH).collect()}
        for r in docs.collect():
            ids = ids_of(r["text"])
            row, digest = found[r["doc_id"]], digests[r["doc_id"]]
            assert (row["n_tokens"], row["ids"]) == (len(ids), " ".join(map(str, ids)))
            assert row["decoded"] == LIBRARY.decode(ids, skip_special_tokens=False)
            assert digest["ids_sha256"] == hashlib.sha256(row["ids"].encode()).hexdigest() and digest["decoded_sha256"] == hashlib.sha256(row["decoded"].encode()).hexdigest()


def merged(parts, merges):
    """Byte-pair encoding by definition: the best pair, left to right, until none is left."""
    while found := [k for k, m in enumerate(merges) if m in zip(parts, parts[1:], strict=False)]:
        out = []
        for p in parts:
            if out and (out[-1], p) == merges[found[0]] and not out[-1].startswith("\0"):
                out[-1] = "\0" + out[-1] + p  # isn't merged again in this round
            else:
                out.append(p)
        parts = [p.lstrip("\0") for p in out]
    return parts


def test_automaton_on_a_small_merge_list():
    merges = [("a", "a"), ("aa", "a"), ("a", "b</w>"), ("b", "a"), ("ba", "ba"), ("aa", "b"), ("b", "b"), ("aab", "baba")]
    vocab = {s: i for i, s in enumerate(dict.fromkeys(["a", "b", "a</w>", "b</w>", *(x + y for x, y in merges)]))}
    automaton = bpe.Automaton(vocab, merges)
    for n in range(1, 13):
        for code in range(2**n):
            word = "".join("ab"[code >> k & 1] for k in range(n))
            assert automaton.path(word + bpe.END) == [vocab[p] for p in merged([*word[:-1], word[-1] + "</w>"], merges)], word


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_store(spark, awkward, encoding):
    path = new_path(spark, "tokens")
    token_store.write_tokens(awkward, path, PATH, encoding=encoding, row_group_bytes=1 << 20, page_bytes=1 << 14)
    stored = token_store.read_tokens(spark, path)
    found, start = {r["doc_id"]: r for r in token_store.checksums(stored).collect()}, 0
    ids = {r["doc_id"]: list(r["ids"]) for r in stored.collect()}
    for k, text in enumerate(AWKWARD):
        want = [*ids_of(text), 1]
        assert ids[k] == want
        assert tuple(found[k])[1:] == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)


def test_token_store_pages_can_be_skipped(spark, sample):
    import pyarrow.parquet as pq

    path = new_path(spark, "tokens")
    token_store.write_tokens(sample, path, PATH, encoding="delta")
    from pathlib import Path

    file = next(f for f in Path(path.removeprefix("file:")).glob("*.parquet") if pq.ParquetFile(f).metadata.num_rows)
    column = {c.path_in_schema: c for c in (pq.ParquetFile(file).metadata.row_group(0).column(k) for k in range(5))}
    assert column["doc_id"].has_column_index and column["ids.list.element"].has_offset_index and "DELTA_BINARY_PACKED" in column["ids.list.element"].encodings


# 4


def brute_top(ids, x, queries, k):
    out = set()
    for q in queries:
        rest = sorted((-int(x[q] @ x[c]), ids[c]) for c in range(len(ids)) if ids[c] != ids[q])[:k]
        out |= {(ids[q], rank + 1, i, -s) for rank, (s, i) in enumerate(rest)}
    return out


@pytest.mark.parametrize("block", [64, 4096])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 16)).round(1)
    v[100:200] = v[7]  # ties
    df = spark.createDataFrame([(i, [float(c) for c in r], "x") for i, r in enumerate(v)] + [(900, None, "x"), (950, [math.nan] * 16, "x"), (951, [None] * 16, "x"), (952, [1.0], "x")], "vec_id long, embedding array<double>, score string")
    found = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    assert found == brute_top([*range(400)], np.floor(256 * v).astype(np.int64), range(0, 400, 50), 5)


def test_top_k_needs_fewer_products(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.floor(256 * np.array([r[1] for r in rows], float)).astype(np.int64)
    index, q = topk.Index(ids, x), x[:128]
    a, b, score, used = index.search(ids[:128], q, np.full(128, -np.inf), 5)
    exact = np.where(ids[:128, None] == ids, -(1 << 60), q @ x.T)
    assert (score.reshape(128, 5) == -np.sort(-exact, axis=1)[:, :5]).all() and (exact[a, index.ids[b]] == score).all()
    least = score.reshape(128, 5)[:, -1].astype(float)
    again = index.search(ids[:128], q, least, 5)
    assert (again[2] == score).all() and again[3] < 0.7 * 128 * x.size and used < 128 * x.size


def test_top_k_awkward(spark):
    rng = np.random.default_rng(6)
    good = [(k // 2, [float(c) for c in r], True) for k, r in enumerate(rng.normal(size=(60, 4)))]  # each id twice
    odd = [(100 + k, [1.0] * 3, True) for k in range(30)] + [(200 + k, [], True) for k in range(50)] + [(300, [0.0, -math.inf, 1.0, 1.0], None), (301, [-0.0] * 4, True)]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>, rank boolean")
    found = sorted(tuple(r) for r in topk.top_k(df, F.col("rank") & (F.col("vec_id") < 100), 3).collect())
    x = [(i, np.floor(256 * np.array(v))) for i, v, _ in good + odd if len(v) == 4 and i != 300]
    expected = []
    for i in range(30):
        best = sorted((-int(a @ b), j) for q, a in x if q == i for j, b in x if j != i)[:3]
        expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert found == expected
    assert topk.top_k(df.where("size(embedding) = 0"), F.lit(True)).count() == 0


def test_top_k_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema), F.col("vec_id") % 50 == 0).count() == 0
    assert [tuple(r) for r in topk.top_k(spark.createDataFrame([(0, [1.0]), (3, [0.0]), (2, [-1.0])], schema), F.col("vec_id") % 50 == 0).orderBy("rank").collect()] == [(0, 1, 3, 0), (0, 2, 2, -65536)]


# 5


def test_url_lists(spark):
    d = lambda s: __import__("datetime").date.fromisoformat(s)
    entries = spark.createDataFrame(
        [("domain:bad.org", "block", "add", d("2024-01-10")), ("domain:bad.org", "block", "remove", d("2024-02-10")), ("host:ok.bad.org", "allow", "add", d("2024-01-20")), ("host:x.org", "block", "add", d("2024-01-01")), ("host:x.org", "block", "remove", d("2024-01-01")), (None, "block", "add", d("2024-01-01")), ("path:x.org/ads", "block", "add", None), ("path:x.org/ads", "block", "add", d("2024-01-05"))],
        "key string, label string, action string, day date",
    )
    cases = [("https://a.bad.org/x", "2024-01-09", "none"), ("https://a.bad.org/x", "2024-01-10", "block"), ("https://a.bad.org/x", "2024-02-10", "none"), ("http://u:p@OK.bad.org:80/", "2024-01-19", "block"), ("http://u:p@OK.bad.org:80/", "2024-01-20", "allow"), ("https://x.org/", "2024-01-01", "none"), ("https://x.org/ads?q", "2024-01-05", "block"), ("https://x.org/ads?q", "2024-01-04", "none"), ("no url", "2024-01-10", "none"), (None, "2024-01-10", "none"), ("https://a.bad.org/x", None, "none"), ("https://a.bad.org/x", "2024-01-10", "block")]
    captures = spark.createDataFrame([(min(i, 11), u, x and d(x), "k") for i, (u, x, _) in enumerate(cases)], "capture_id long, url string, day date, key string")
    found = sorted((r["capture_id"], r["decision"]) for r in url_filter.apply_lists(captures, entries).collect())
    assert found == [(i, c[2]) for i, c in enumerate(cases)]
    plan = url_filter.apply_lists(captures, entries)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)


# 6


def test_media(spark, awkward):
    found = {r["doc_id"]: r for r in media.digests(awkward).collect()}
    for k, text in enumerate(AWKWARD):
        raw = (text or "").encode()
        payload = raw + b"\xff" * ((-len(raw)) % 576 or (0 if raw else 576))
        r, wav = found[k], media.to_wav(payload)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(wav), hashlib.sha256(wav).hexdigest()) and media.from_wav(wav) == payload
    assert found[4]["feature"] == found[5]["feature"] and found[10]["feature"] != found[11]["feature"]
    arrays = {r["doc_id"]: r for r in media.with_fingerprints(media.with_media(awkward)).collect()}
    assert len(arrays[10]["times"]) == len(arrays[10]["codes"]) > 100


def test_peaks_find_a_tone():
    t = np.arange(8000)
    tone = (128 + 100 * np.sin(2 * np.pi * 1000 * t / media.RATE)).astype(np.uint8)
    _, bins = media.peaks(tone)
    assert 1000 * media.FRAME // media.RATE in bins.tolist() and len(set(bins.tolist())) < 12


def brute_fingerprint_of_sound(samples):
    n = (len(samples) - media.FRAME) // media.HOP + 1
    s = media.spectrogram(samples, 0, n)
    found = []
    for t in range(n):
        for b in range(media.LOWEST, s.shape[1]):
            around = s[max(0, t - media.FRAMES) : t + media.FRAMES + 1, max(media.LOWEST, b - media.BINS) : b + media.BINS + 1]
            if s[t, b] == around.max() and s[t, b] > media.SHARE * s[t].max():
                found.append((t, b))
    pairs = []
    for t, b in found:
        later = [(u, c) for u, c in found if u > t][: media.FAN]
        pairs += [(t, b << 20 | c << 8 | u - t) for u, c in later if u - t <= media.REACH]
    pairs.sort()
    return [t - (pairs[k - 1][0] if k else 0) for k, (t, _) in enumerate(pairs)], [c for _, c in pairs]


def test_fingerprints_against_brute_force(sample, monkeypatch):
    texts = [*AWKWARD[:10], *(r["text"] for r in sample.select("text").limit(12).collect())]
    for block in (4, 2048):
        monkeypatch.setattr(media, "BLOCK", block)
        for text in texts:
            raw = (text or "").encode()[:6000]
            samples = np.frombuffer(raw + b"\xff" * ((-len(raw)) % 576 or (0 if raw else 576)), np.uint8)
            times, codes = media.fingerprint(samples)
            assert (times.tolist(), codes.tolist()) == brute_fingerprint_of_sound(samples)


# 7


def check_packing(rows, texts, capacity):
    sequences, total = {}, 0
    for r in rows:
        ids = np.array([*ids_of(texts[r["doc_id"]]), 0][r["start"] : r["start"] + r["length"]], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"] and r["start"] == capacity * r["piece"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        total += r["length"]
    for parts in sequences.values():
        assert sum(n for _, n in parts) <= capacity
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
    assert total == sum(len(ids_of(t)) + 1 for t in texts.values())
    return len(sequences), total


def test_packing(spark, awkward, sample):
    for docs in (awkward, sample):
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        n, total = check_packing(packing.pack_documents(docs, PATH).collect(), texts, 2048)
        assert n <= math.ceil(total / 2048) * 1.02 + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_under_every_constraint(rule):
    rng = random.Random(2)
    histogram = {}
    for _ in range(3000):
        n = rng.choice([rng.randint(1, 100), rng.randint(1, 600)])
        histogram[n] = histogram.get(n, 0) + 1
    capacity = packing.Capacity(1000, 7, 400_000, (1.0, 0.5, 0.5), rule)
    bins, numbers = {}, {}
    for length, a, b, first, offset in packing.plan(histogram, capacity):
        for k in range(a, b):
            bins.setdefault(first + k - a, []).append((offset, length))
            numbers.setdefault(length, []).append(k)
    assert all(sorted(v) == [*range(histogram[n])] for n, v in numbers.items()) and set(numbers) == set(histogram)
    for parts in bins.values():
        assert len(parts) <= 7 and sum(n for _, n in parts) <= 1000 and sum(n * n for _, n in parts) <= capacity.attention


# 9


def test_toxicity(spark, awkward):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hits = sum(r["predicted"] == r["toxic"] for r in rows)
    assert hits >= 0.97 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in toxicity.toxicity(docs, labels).select("doc_id", "held_out").limit(50).collect())
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(awkward, empty).count() == len(AWKWARD)
    kept = toxicity.keep_civil(awkward, spark.createDataFrame([(4, 1, None), (7, 1, 1), (5, 1, 0)], empty.schema))
    assert kept.columns == awkward.columns


def brute_features(model, text):
    """Word by word: the heaviest entry that a word begins with, unless an exception lies around it."""
    s = toxicity.folded(text)
    hidden = []
    for phrase in model.exceptions:
        p, at = toxicity.folded(phrase.encode()), 0
        while (at := s.find(p, at)) >= 0:
            hidden.append((at, at + len(p)))
            at += 1
    total = 0.0
    for at in [k for k, c in enumerate(s) if c == " "]:
        fits = [w for stem, w in model.lexicon.items() if s.startswith(stem, at + 1) and not any(a <= at and at + 1 + len(stem) <= b for a, b in hidden)]
        total += max(fits, default=0.0)
    return math.log1p(total), 100 * total / (20 + s.count(" "))


def test_matching_against_brute_force(spark, sample):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    learnt = toxicity.learn(docs, labels)
    texts = [r["text"] for r in docs.join(labels.where("toxic = 1"), "doc_id", "left_semi").limit(60).collect()] + [r["text"] for r in sample.limit(60).collect()] + AWKWARD[:10]
    made = toxicity.Model({"idiot": 3.0, "idi": 1.0, "clown": 2.0, "fool": 1.5}, ["clownfish", "no idiot", "fool of", "of fools"], (-3.0, 2.0, 1.0))
    texts += ["no idiot idiots no idiot", "fool of fools", "clownfish clown", "idi idiot fool of fools of", "IDIOT" * 3, " idiot"]
    for model in (learnt, made):
        for text in texts:
            raw = (text or "").encode()
            assert model.features(raw) == pytest.approx(brute_features(model, raw))
            z = model.coefficients[0] + model.coefficients[1] * brute_features(model, raw)[0] + model.coefficients[2] * math.log1p(brute_features(model, raw)[1])
            assert model.score(raw) == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))))


def test_conflicting_and_repeated_labels(spark):
    docs = spark.createDataFrame([(k, f"you {'wretch' if k % 2 else 'friend'} number w{k}") for k in range(400)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(400)] + [(1, 1, 0), (2, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 800 and all(r["predicted"] == r["doc_id"] % 2 for r in rows)
    assert len({(r["doc_id"], r["score"]) for r in rows}) == 400


def test_folding_and_exceptions():
    model = toxicity.Model({"idiot": 3.0, "clown": 2.0}, ["clownfish", "no idiot"], (-3.0, 2.0, 1.0))
    clean = model.score(b"")
    for text in ("What an 1d10t!", "ＩＤＩＯＴ", "аn іdіоt", "id​iot", "IDIOTS"):
        assert model.score(text.encode()) > 0.5, text
    for text in ("the clownfish swims", "he is no idiot.", "video titles", None or ""):
        assert model.score(text.encode()) == clean, text


# 10


def test_html(spark):
    tree = html_text.train(html_text.labelled())
    page = '<html><head><title>t</title><style>p{}</style></head><body><header><a href=/>Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="cookie-notice">We use cookies on this site for many purposes indeed.</div><div id=ad-1>Buy now and save a lot of money today, friends.</div><article><h1>Title &amp; more</h1><p>First\n  paragraph &lt;b&gt; <a href="x">link</a> here.<p>Second<br>one.</article><aside>Aside text that is long enough to be a paragraph.</aside><section class="comments"><p>I disagree with this article very much indeed.</p></section><form>Name<input></form><footer>&copy; me</footer><script>var t="</p>";</script></body>'
    assert html_text.main_text(page, tree) == "Title & more First paragraph <b> link here. Second one."
    df = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<p>a < b", "x"), (4, "u", "<p>a < b", "x"), (5, "u", "<" * 50_000, "x"), (6, "u", "<p>" + "word " * 100_000, "x")], "page_id long, url string, html string, text string")
    found = html_text.extract(df).collect()
    assert len(found) == 7 and {r["page_id"]: r["text"] for r in found if r["page_id"] in (2, 3)} == {2: "", 3: ""}
    assert all(r["n_chars"] == len(r["text"]) for r in found) and next(r for r in found if r["page_id"] == 6)["n_chars"] == 499_999


# all


def test_empty_tables(spark, awkward):
    none = awkward.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert simhash.near_duplicates(none).count() == language.document_languages(none).count() == bpe.digests(none, PATH).count() == 0
    assert media.digests(none).count() == packing.pack_documents(none, PATH).count() == token_store.store_and_check(none, PATH).count() == toxicity.toxicity(none, labels).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages).count() == url_filter.filter_pages(pages).count() == language.page_languages(pages, none).count() == 0


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "the same text of some words", "en", "a"), (3, "the same text of some words", "en", "a"), (3, "the same text of some words", None, None), (2, None, None, None)], "doc_id long, text string, lang string, source string")
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(docs).collect()) == [(-1, 3), (2, 2), (3, 3), (3, 3)]
    assert packing.pack_documents(docs, PATH).count() == 4 and bpe.digests(docs, PATH).count() == 4 and media.digests(docs).count() == 4
    assert token_store.store_and_check(docs, PATH).count() == 4 and language.document_languages(docs).count() == 4
    assert sorted((r["doc_id"] or -1) for r in simhash.keep_one(docs).select("doc_id").collect()) == [2, 3, 3]
