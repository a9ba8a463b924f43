"""Token ids of whole texts by the tokenizers library, with a memo of white-space separated chunks.

The public tokenizer drops white space, and no token, pattern or normal form spans it, so the ids
of a text are those of its chunks in order. A batch of texts is split and its chunks are made
distinct by Arrow; each worker asks the library only for chunks that it hasn't met lately.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from terrace.llm.common import release

#: Chunks in a generation of a worker's memo, which keeps two. Longer chunks aren't kept.
MEMO_CHUNKS, MEMO_BYTES = 160_000, 40
#: Bytes of text that are split at a time (a longer text alone).
BLOCK_BYTES = 10 << 20
#: A letter followed by one of these always ends a pre-token, and each is a pre-token if it ends its chunk.
MARKS = ".,;:!?"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for letters from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def latin_word(chunk: str) -> tuple[str, str] | None:
    """(normalised word, mark or nothing) of a chunk that is one Latin word, else None: ask the library then."""
    word, mark = (chunk[:-1], chunk[-1]) if chunk and chunk[-1] in MARKS else (chunk, "")
    if not word.isascii():
        word = unicodedata.normalize("NFC", word)
        if max(word) >= "ɐ" or "İ" in word:
            return None
    return (word.lower(), mark) if word.isalpha() else None


def in_letters(word: str) -> str:
    """A word in the byte-level alphabet."""
    if word.isascii():
        return word
    table = byte_letters()
    return "".join(table[b] for b in word.encode())


class ChunkMemo:
    """Values of chunks, computed in batches by ``compute``; those met lately are kept, in two generations."""

    def __init__(self, compute: Callable[[list[bytes]], list], kept: int = MEMO_CHUNKS):
        self.compute, self.kept, self.known, self.older = compute, kept, {}, {}

    def of(self, chunks: list[bytes]) -> list:
        if len(self.known) > self.kept:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = list(map(known.get, chunks))
        new = []
        for k in [k for k, v in enumerate(found) if v is None]:
            v = older.get(chunks[k])
            if v is None:
                new.append(k)
            else:
                found[k] = known[chunks[k]] = v
        if new:
            for k, v in zip(new, self.compute([chunks[k] for k in new]), strict=True):
                found[k] = v
                if len(chunks[k]) <= MEMO_BYTES:
                    known[chunks[k]] = v
        return found


def text_blocks(batch: pa.RecordBatch, name: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, at most about ``size`` bytes of text at a time; null texts become empty ones."""
    at = batch.schema.get_field_index(name)
    texts = pc.fill_null(batch.column(at), "")
    batch = batch.set_column(at, name, texts)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    release()


def chunks_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(where each text's chunks begin, one more than texts; the number of each chunk; the distinct chunks)."""
    lower = texts if pc.any(pc.match_substring(texts, "<|")).as_py() else pc.ascii_lower(texts)  # special tokens keep their case
    lists = pc.ascii_split_whitespace(lower)
    coded = lists.flatten().dictionary_encode()
    offsets = np.asarray(lists.offsets)
    return offsets - offsets[0], np.asarray(coded.indices), coded.dictionary.cast(pa.binary()).to_pylist()


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Function from texts without nulls to (all their ids, where each text's ids begin, one more than texts).

    An empty text, or one of white space alone, has no ids.
    """
    t = load_tokenizer(path)
    marks = {m: np.array(t.encode(m, add_special_tokens=False).ids, dtype="<u4").tobytes() for m in MARKS} | {"": b""}
    model = t.model

    def compute(chunks: list[bytes]) -> list[bytes]:
        out, rest = [], []
        words: dict[str, bytes] = {}  # a word comes with and without marks
        for k, c in enumerate(chunks):
            s = c.decode("utf-8", "replace")
            if split := latin_word(s):
                word, mark = split
                ids = words.get(word) or (memo.known.get(c[:-1]) if mark else None)
                if ids is None:
                    ids = array("I", [x.id for x in model.tokenize(in_letters(word))]).tobytes()
                words[word] = ids
                out.append(ids + marks[mark])
            else:
                out.append(b"")
                rest.append((k, s))
        for (k, _), e in zip(rest, t.encode_batch_fast([s for _, s in rest], add_special_tokens=False), strict=True):
            out[k] = np.array(e.ids, dtype="<u4").tobytes()
        return out

    memo = ChunkMemo(compute)

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        begin, number, distinct = chunks_of(texts)
        found = memo.of(distinct)
        sizes = np.fromiter((len(x) // 4 for x in found), np.int64, len(found))
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(found), "<u4"))
        ids = np.asarray(lists.take(pa.array(number)).flatten())
        upto = np.concatenate([[0], np.cumsum(sizes[number])])
        return ids, upto[begin]

    return encode
