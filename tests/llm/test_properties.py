"""Properties over random input, without Spark."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import bpe, html_text, media, packing, tokens

PATH = tokens.default_tokenizer()
LIBRARY = tokens.load_tokenizer(PATH)
PIECES = st.sampled_from(["the", "The", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "</w>", "12", " ", "\n", " ", "\x1f", ".", ",", "!!", "é", "é", "ß", "İ", "ΑΣ", "ſ", "K", "日本", "🙂", "_", "aaab", "un", "ing", "-", "­", "​"])
TEXTS = st.one_of(st.text(max_size=60), st.lists(PIECES, max_size=25).map("".join), st.text("abcdefghijklmnopqrstuvwxyz ", max_size=80)).map(lambda s: s.encode("utf-8", "ignore").decode())


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=6))
def test_encoders_agree_with_the_library(texts):
    ids, begin = tokens.encoder(PATH)(pa.array(texts))
    starts, number, distinct = tokens.chunks_of(pa.array(texts))
    parts = bpe.codec(PATH)(distinct)
    for k, text in enumerate(texts):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        own = [parts[n] for n in number[starts[k] : starts[k + 1]]]
        assert ids[begin[k] : begin[k + 1]].tolist() == want
        assert [int(i) for p in own for i in p[1].split()] == want
        assert b"".join(p[2] for p in own)[:-1].decode() == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 300), st.integers(1, 40), max_size=30), st.integers(1, 6), st.sampled_from(["norm", "dot"]))
def test_plans_place_each_piece_once_within_capacity(histogram, pieces, rule):
    capacity = packing.Capacity(300, pieces, 90_000, (1.0, 0.3, 0.3), rule)
    bins, seen = {}, {n: [] for n in histogram}
    for length, a, b, first, offset in packing.plan(histogram, capacity):
        for k in range(a, b):
            bins.setdefault(first + k - a, []).append((offset, length))
            seen[length].append(k)
    assert all(sorted(v) == [*range(histogram[n])] for n, v in seen.items())
    for parts in bins.values():
        ends = 0
        for offset, n in sorted(parts):
            assert offset == ends
            ends += n
        assert ends <= 300 and len(parts) <= pieces


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=3000))
def test_wav_round_trip(data):
    payload = data + b"\xff" * ((-len(data)) % 576 or (0 if data else 576))
    assert media.from_wav(media.to_wav(payload)) == payload
    times, codes = media.fingerprint(np.frombuffer(payload, np.uint8))
    assert len(times) == len(codes) and (times >= 0).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<a href=x>", "</a>", "<script>", "</script>", "<!--", "-->", "<article>", "</article>", "text", " ", "&amp;", "&#x26;", "<", ">", '"', "<br/>", "<li", "é"]), max_size=40).map("".join))
def test_any_markup_gives_text(source):
    tree = html_text.train(html_text.labelled())
    text = html_text.main_text(source, tree)
    assert text == " ".join(text.split()) and "<script" not in text
