"""Operator 3: byte-pair encoding and decoding by a tokenization automaton.

The automaton starts with one state that every token's arc leads back to. Each merge (u, v) -> w,
in order of priority, applies a gadget: the state that u's arcs lead to is copied without its v
arc, u's arcs lead to the copy, and each state that has a u arc gets a w arc to where v's arc led.
So all arcs of a token lead to one state, and an arc for w is there where one for u was at that time:
what a gadget takes from a state are v's arc and those of the tokens grown from v by later merges on its right. In the
preorder of the trees that left parts make, with children by age, these are two runs of numbers.

The compiled table holds for each state the bounds of the runs that it lacks; a state that w's arcs lead
to starts with what v's state lacked when w was made. Tokens with equal rows share their state. A transition
looks the token's number up in the state's row: it is there unless an odd number of bounds lie before it.

A word's token sequence is the one path through the automaton that spells it; decoding follows the arcs of ids and
emits their labels.

Defined results: a null text is an empty one; an empty text, or one of white space alone, has no
ids and decodes to the empty text; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.tokens import MARKS, ChunkMemo, chunks_of, in_letters, latin_word, load_tokenizer, text_blocks

#: Stands for the end of a word inside the automaton; byte-level text never holds it.
END = "\ue000"
#: Words kept by a worker.
WORDS_KEPT = 100_000


class Automaton:
    """Deterministic automaton over token arcs, compiled from a merge list; state 0 is the start."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = "</w>"):
        self.label = {i: s for s, i in vocab.items()}
        n = max(vocab.values(), default=-1) + 1
        made = {a + c for a, c in merges}
        form = {i: s[: -len(end)] + END if s.endswith(end) and len(s) > len(end) else s for s, i in vocab.items() if s not in made}
        gadgets = []
        for a, c in merges:
            u, v, w = vocab[a], vocab[c], vocab[a + c]
            form[w] = form[u] + form[v]
            gadgets.append((u, v, w))
        self.spelled = {s: i for i, s in form.items()}
        self.longest = max(map(len, self.spelled), default=1)
        self.place, runs = _runs(n, gadgets)
        self.state, self.rows = _rows(n, gadgets, runs, {i for i, s in form.items() if s.endswith(END)})
        self.trie = ahocorasick.Automaton()
        for x in self.spelled:
            self.trie.add_word(x, True)

    def step(self, state: int, token: int) -> int:
        """The state that the token's arc leads to, -1 if there is no such arc."""
        return -1 if bisect_right(self.rows[state], self.place[token]) & 1 else self.state[token]

    def path(self, word: str) -> list[int]:
        """Tokens of a word in byte-level letters, its last letter followed by END."""
        spelled, step, n = self.spelled, self.step, len(word)
        out: list[int] = []
        ends, states = [0], [0]  # where each token of out ends, and the states on the way
        dead = set()
        length = self.reach(word, 0)
        while True:
            at, state, to = ends[-1], states[-1], -1
            while length:
                t = spelled.get(word[at : at + length])
                if t is not None and (to := step(state, t)) >= 0 and not (dead and (at + length, t) in dead):
                    break
                length -= 1
            if length:
                out.append(t)
                ends.append(at + length)
                states.append(to)
                if at + length == n:
                    return out
                length = self.reach(word, at + length)
            else:  # no arc leads on from here: the token before must be shorter
                if not out:
                    raise ValueError(f"no path spells {word!r}")
                dead.add((at, out.pop()))
                ends.pop()
                states.pop()
                length = at - ends[-1] - 1

    def reach(self, word: str, at: int) -> int:
        """Letters from ``at`` on along which some token is spelled: no token is longer."""
        return self.trie.longest_prefix(word[at : at + self.longest])


def _runs(n: int, gadgets: list[tuple[int, int, int]]) -> tuple[list[int], list[tuple[int, int, int, int]]]:
    """Each token's preorder number, and the two runs (from, to, from, to) of numbers that each gadget takes from a state."""
    children: list[list[int]] = [[] for _ in range(n)]
    born = [0] * n
    for k, (u, _, w) in enumerate(gadgets):
        children[u].append(w)  # in order of age
        born[w] = k
    place, last = [0] * n, [0] * n
    has_parent = {w for _, _, w in gadgets}
    number = 0
    stack = [x for x in range(n) if x not in has_parent]
    while stack:
        x = stack.pop()
        if x < 0:
            last[~x] = number
            continue
        place[x] = number
        number += 1
        stack.append(~x)
        stack += reversed(children[x])
    runs = []
    for k, (_, v, _) in enumerate(gadgets):
        later = children[v][bisect_left(children[v], k, key=born.__getitem__) :]
        runs.append((place[v], place[v] + 1, place[later[0]] if later else last[v], last[v]))
    return place, runs


def _rows(n: int, gadgets: list[tuple[int, int, int]], runs: list[tuple[int, int, int, int]], final: set[int]) -> tuple[list[int], list[array]]:
    """Each token's state, and the bounds of what each state lacks: 0 is the start, 1 the end, which has no arcs."""
    own: list[list[int]] = [[] for _ in range(n)]
    part: dict[int, tuple[int, int]] = {}  # right part and gadget of a token
    for k, (u, v, w) in enumerate(gadgets):
        own[u].append(k)
        part[w] = (v, k)
    table = np.array(runs, np.int64).reshape(-1, 2, 2)
    rows, numbers = [array("I"), array("I", [0])], {b"": 0}
    state = [1] * n
    lacks: dict[int, np.ndarray] = {}  # gadgets that took something from the state of a token
    for x in [x for x in range(n) if x not in part] + [w for _, _, w in gadgets]:
        if x in final:
            continue
        taken = np.array(own[x], np.int64)
        if x in part:
            v, k = part[x]
            taken = np.concatenate([taken, lacks[v][lacks[v] < k]])
        lacks[x] = taken
        found = table[taken].reshape(-1, 2)
        found = found[np.argsort(found[:, 0], kind="stable")]
        upto = np.maximum.accumulate(found[:, 1])
        apart = np.flatnonzero(found[1:, 0] > upto[:-1])
        bounds = np.column_stack([found[np.r_[0, apart + 1], 0], upto[np.r_[apart, len(upto) - 1]]]).ravel().astype(np.uint32) if len(found) else np.zeros(0, np.uint32)
        row = bounds.tobytes()
        if row not in numbers:
            numbers[row] = len(rows)
            rows.append(array("I", row))
        state[x] = numbers[row]
    return state, rows


@lru_cache(maxsize=2)
def codec(path: str):
    """Function from the UTF-8 bytes of a text to the parts (count, decimal ids, arc labels) of its chunks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    library = load_tokenizer(path)
    model = spec["model"]
    automaton = Automaton(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    labels = automaton.label | {i: s for s, i in special.items()}
    cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
    words: dict[str, list[int]] = {}

    def word_ids(word: str) -> list[int]:
        ids = words.get(word)
        if ids is None:
            ids = automaton.path(word + END)
            if len(words) >= WORDS_KEPT:
                words.clear()
            if len(word) < 40:
                words[word] = ids
        return ids

    def plain(text: str) -> list[int]:
        split = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text)) if text else []
        return [i for word, _ in split for i in word_ids(word)]

    def encode(text: str) -> list[int]:
        if "<|" not in text:
            return plain(text)
        ids, at = [], 0
        for m in cut.finditer(text):
            ids += [*plain(text[at : m.start()]), special[m[0]]]
            at = m.end()
        return ids + plain(text[at:])

    marks = {m: plain(m) for m in MARKS} | {"": []}

    def compute(chunks: list[bytes]) -> list[tuple[int, bytes, bytes]]:
        out = []
        for c in chunks:
            s = c.decode("utf-8", "replace")
            split = latin_word(s)
            ids = word_ids(in_letters(split[0])) + marks[split[1]] if split else encode(s)
            out.append((len(ids), "".join(f"{i} " for i in ids).encode(), "".join(f"{labels[i]} " for i in ids).encode()))
        return out

    return ChunkMemo(compute).of


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text: id, n_tokens, ids (decimal, joined by one space), decoded."""
    return _run(docs, tokenizer, id_col, text_col, f"{id_col} long, n_tokens long, ids string, decoded string", False)


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_decode``, with SHA-256 digests in place of the two texts."""
    return _run(docs, tokenizer, id_col, text_col, f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string", True)


def _run(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, schema: str, digest: bool) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = codec(tokenizer)
        for batch in (x for b in batches for x in text_blocks(b, text_col)):
            begin, number, distinct = chunks_of(batch.column(1))
            ns, ids, labels = zip(*values(distinct), strict=True) if distinct else ((), (), ())
            upto = np.concatenate([[0], np.cumsum(np.array(ns, dtype=np.int64)[number])]) if distinct else np.zeros(1, np.int64)
            n_tokens, texts = np.diff(upto[begin]), ([], [])
            for a, b in zip(begin[:-1], begin[1:], strict=True):
                own = number[a:b].tolist()
                for out, parts in zip(texts, (ids, labels), strict=True):
                    x = b"".join([parts[k] for k in own])[:-1]
                    out.append(hashlib.sha256(x).hexdigest() if digest else x.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_tokens, pa.int64()), *(pa.array(x, pa.string()) for x in texts)], names)

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(rows, schema)
