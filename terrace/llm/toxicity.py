"""Operator 9: toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding lowers case, maps homoglyphs and full-width letters to Latin ones, drops invisible
characters, undoes digit and symbol substitutions and turns other ASCII marks into blanks. The
lexicon holds beginnings of words with their log odds, learnt from labelled rows. Which beginnings are taken is a question
of their number too: the likelihood ratios of all that could be telling are ranked, and the bound is where the
share of beginnings expected by chance falls to FALSE_SHARE, at every size of sample. A beginning that several words
share must be telling without the commonest of them. Exceptions are words of
clean rows that start like a lexicon entry and phrases of two words around one, if clean rows hold them much oftener than
the entry tells, and given phrases; they hide the matches inside them. The score is a logistic function of
the weights found, as a sum and by length.

Defined results: null and empty texts score as texts without matches; with no labelled rows
nothing matches and the score is the smoothed base rate; repeated rows score alike; a label that
is null or conflicts with another row of its doc_id counts as each row says; extra columns are kept
or ignored as the function says.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import binary_rows, free_name, slices, stored

#: Labelled rows that the lexicon and the score are fitted on, at most.
SAMPLE_ROWS = 20_000
#: Lexicon: letters of a beginning; least odds; share of entries that chance may bring; chance below which one beginning is telling; rows that make an exception.
STEM_LETTERS, LEAST_ODDS, FALSE_SHARE, TELLING, LEAST_ROWS = (4, 12), 12.0, 0.05, 0.001, 3
#: Phrases in which words of the lexicon are harmless.
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "clownfish", "rodeo clown", "scum line", "pond scum", "sore loser", "stupid mistake")
#: A score from here on is toxic.
THRESHOLD = 0.3

# Letters that look like Latin ones, and substitutions inside words.
HOMOGLYPHS = {"а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"

_LOOKALIKE = {ord(k): v for k, v in HOMOGLYPHS.items()} | {ord(k.upper()): v for k, v in HOMOGLYPHS.items()} | {0xFF01 + k: chr(0x21 + k) for k in range(94)} | {ord(c): None for c in INVISIBLE}
_UNUSUAL = re.compile(f"[Ͱ-ԯ！-～{INVISIBLE}]")
_ASCII = bytes(ord(SUBSTITUTIONS.get(chr(b), chr(b) if chr(b).isalnum() else " ")) if b < 128 else b for b in range(256))


def folded(text: bytes) -> str:
    """The folded text between blanks."""
    s = text.decode("utf-8", "replace")
    if not s.isascii() and _UNUSUAL.search(s):
        s = s.translate(_LOOKALIKE)
    return f" {s.lower().encode('utf-8', 'replace').translate(_ASCII).decode('utf-8', 'replace')} "


@dataclass
class Model:
    """Weights by beginning of a word, phrases that excuse what lies in them, and the logistic coefficients."""

    lexicon: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, ...] = (-2.0, 1.0, 1.0)

    def __post_init__(self) -> None:
        self._automaton = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    def matches(self, s: str) -> dict[int, float]:
        """Where entries begin in a folded text, outside exceptions, and their weights."""
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for stem, weight in self.lexicon.items():
                self._automaton.add_word(f" {stem}", (len(stem), weight))
            for phrase in self.exceptions:
                p = folded(phrase.encode())
                self._automaton.add_word(p, (len(p) - 1, None))
            self._automaton.make_automaton()
        best: dict[int, float] = {}
        if not len(self._automaton):
            return best
        hits, hidden = [], []
        for end, (length, weight) in self._automaton.iter(s):
            (hits if weight is not None else hidden).append((end - length, end, weight))
        if hidden:
            hidden.sort()
            starts, reach = [a for a, _, _ in hidden], list(accumulate((b for _, b, _ in hidden), max))
            hits = [h for h in hits if not (k := bisect_right(starts, h[0])) or reach[k - 1] < h[1]]
        for a, _, w in hits:
            best[a] = max(w, best.get(a, 0.0))
        return best

    def features(self, text: bytes) -> tuple[float, float]:
        """(log of 1 + the sum of weights, weights for a hundred words)."""
        s = folded(text)
        total = sum(self.matches(s).values())
        return float(np.log1p(total)), 100 * total / (20 + s.count(" "))

    def score(self, text: bytes) -> float:
        a, b = self.features(text)
        z = self.coefficients[0] + self.coefficients[1] * a + self.coefficients[2] * np.log1p(b)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and toxic of at most about ``rows`` labelled rows outside the held-out fold, chosen by a hash of their id."""
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    step = -(-max(1, known.count()) // rows)
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    # at most about `rows` ids, so the broadcast is bounded by that parameter
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low, high = STEM_LETTERS
    for batch in slices(batches):
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(binary_rows(batch, "text"), batch.column(1).to_pylist(), strict=True):
            words = {w for w in folded(text).split() if len(w) >= low}
            found[1 if toxic else 0].update({w[:n] for w in words for n in range(low, min(high, len(w)) + 1)})
        for toxic, n in found.items():
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([toxic] * len(n), pa.int32()), pa.array(list(n.values()), pa.int64())], ["stem", "toxic", "n"])


def _phrases(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbouring words of which one is matched, by label, and how many rows hold each."""
    for batch in slices(batches):
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(binary_rows(batch, "text"), batch.column(1).to_pylist(), strict=True):
            s = folded(text)
            pairs = set()
            for at in model.matches(s):
                word = s[at + 1 : s.index(" ", at + 1)]
                before, after = s[:at].rsplit(None, 1)[-1:], s[at + 1 + len(word) :].split(None, 1)[:1]
                pairs |= {f"{x} {word}" for x in before} | {f"{word} {x}" for x in after}
            found[1 if toxic else 0].update(pairs)
        for toxic, n in found.items():
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([toxic] * len(n), pa.int32()), pa.array(list(n.values()), pa.int64())], ["stem", "toxic", "n"])


def _by_label(counted: DataFrame) -> DataFrame:
    """stem, and the toxic (t) and clean (c) rows that hold it."""
    n = {k: F.sum(F.when(F.col("toxic") == v, F.col("n")).otherwise(0)).alias(k) for k, v in (("t", 1), ("c", 0))}
    return counted.groupBy("stem").agg(*n.values())


def _words_behind(batches: Iterator[pa.RecordBatch], stems: set[str]) -> Iterator[pa.RecordBatch]:
    """The words that begin with each of ``stems``, by label, and how many rows hold them."""
    low, high = STEM_LETTERS
    for batch in slices(batches):
        found: Counter = Counter()
        for text, toxic in zip(binary_rows(batch, "text"), batch.column(1).to_pylist(), strict=True):
            found.update({(w[:n], w, 1 if toxic else 0) for w in set(folded(text).split()) for n in range(low, min(high, len(w)) + 1) if w[:n] in stems})
        if found:
            stem, word, toxic = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(stem, pa.string()), pa.array(word, pa.string()), pa.array(toxic, pa.int32()), pa.array(list(found.values()), pa.int64())], ["stem", "word", "toxic", "n"])


def evidence(t: Column, c: Column, share: float) -> Column:
    """Log likelihood ratio of t toxic and c clean rows against rows toxic by ``share``; 0 where they are less toxic."""
    rows = t + c
    part = lambda n, p: F.when(n > 0, n * F.log(n / rows / F.lit(p))).otherwise(0.0)
    return F.when(t > rows * share, part(t, share) + part(c, 1 - share)).otherwise(0.0)


def could_tell(share: float) -> Column:
    """Whether a beginning has so many rows that it would be telling if all were toxic."""
    return evidence(F.col("t") + F.col("c"), F.lit(0), share) >= math.log(1 / TELLING)


def least_evidence(counts: DataFrame, share: float) -> float:
    """The likelihood ratio from which on no more than FALSE_SHARE of the beginnings are expected by chance.

    Beginnings that couldn't tell aren't asked. The driver gets a histogram.
    """
    chance = lambda v: math.erfc(math.sqrt(v)) / 2
    could = counts.where(could_tell(share))
    step = 20
    bins = {r["bin"]: r["n"] for r in could.groupBy(F.floor(F.col("evidence") * step).alias("bin")).agg(F.count("*").alias("n")).collect()}
    asked, above, least = sum(bins.values()), 0, math.inf
    for k in sorted(bins, reverse=True):
        above += bins[k]
        if chance(k / step) <= FALSE_SHARE * above / asked:
            least = k / step
    return least


def _entry(model: Model, word: str) -> float:
    """The weight of the entry that a word begins with, or 0."""
    return max((w for n in range(STEM_LETTERS[0], min(STEM_LETTERS[1], len(word)) + 1) if (w := model.lexicon.get(word[:n]))), default=0.0)


def milder(t: int, c: int, share: float, weight: float) -> float:
    """Log likelihood ratio of t toxic and c clean rows against the share of toxic rows that an entry of this weight tells; 0 unless lower."""
    told = 1 / (1 + math.exp(-weight) * (1 - share) / share)
    own = t / (t + c)
    if own >= told:
        return 0.0
    return (t * math.log(own / told) if t else 0.0) + c * math.log((1 - own) / (1 - told))


def learn(docs: DataFrame, labels: DataFrame, exceptions: list[str] | None = None) -> Model:
    """A model from the labelled rows outside the held-out fold."""
    sample = stored(labelled_sample(docs, labels), "labelled")
    size = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    share = (bad + 0.5) / (bad + good + 1)
    odds = ((F.col("t") + 0.5) / (bad + 1)) / ((F.col("c") + 0.5) / (good + 1))
    counts = _by_label(sample.mapInArrow(_stems, "stem string, toxic int, n long"))
    counts = stored(counts.withColumns({"odds": odds, "evidence": evidence(F.col("t"), F.col("c"), share)}), "stems")
    model = Model({}, list(exceptions or []))
    if bad and good:
        least = least_evidence(counts, share)
        # the sample bounds the entries, and the words behind them
        strong = {r["stem"]: (r["t"], r["w"]) for r in counts.where(could_tell(share) & (F.col("evidence") >= least) & (F.col("odds") >= LEAST_ODDS)).select("stem", "t", F.log("odds").alias("w")).collect()}
        behind = sample.mapInArrow(lambda batches: _words_behind(batches, set(strong)), "stem string, word string, toxic int, n long")
        n = {k: F.sum(F.when(F.col("toxic") == v, F.col("n")).otherwise(0)).alias(k) for k, v in (("t", 1), ("c", 0))}
        words = behind.groupBy("stem", "word").agg(*n.values()).groupBy("stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.max(F.struct((F.col("t") + F.col("c")).alias("n"), "word", "t", "c")).alias("top"))
        rest = evidence(F.col("t") - F.col("top.t"), F.col("c") - F.col("top.c"), share)
        own = (F.length("top.word") == F.length("stem")) | (F.length("stem") == STEM_LETTERS[1]) | (F.col("t") + F.col("c") == F.col("top.n"))
        shared = words.where(own | (rest >= math.log(1 / TELLING) / 2)).select("stem").collect()
        model.lexicon = _choose({r["stem"]: strong[r["stem"]] for r in shared})
        starts = F.lit(False)  # a word of clean rows that starts like an entry is an exception
        for n in sorted({len(x) for x in model.lexicon}):
            starts = starts | F.substring("stem", 1, n).isin([x for x in model.lexicon if len(x) == n])
        few = (F.col("c") >= LEAST_ROWS) & (F.col("odds") < 1)
        excused = [r for r in counts.where(starts & few).collect() if r["stem"] not in model.lexicon]
        model.exceptions += sorted(r["stem"] for r in excused if milder(r["t"], r["c"], share, _entry(model, r["stem"])) >= math.log(1 / TELLING))
        pairs = _by_label(sample.mapInArrow(lambda batches: _phrases(batches, model), "stem string, toxic int, n long"))
        mild = pairs.where((F.col("c") >= LEAST_ROWS) & (F.col("c") * bad >= F.col("t") * good)).collect()
        model.exceptions += sorted(r["stem"] for r in mild if milder(r["t"], r["c"], share, max(_entry(model, w) for w in r["stem"].split())) >= math.log(1 / TELLING))
        model.__post_init__()
        model.coefficients = _fit(sample, model)
    elif bad or good:
        model.coefficients = (float(np.log(share / (1 - share))), 0.0, 0.0)
    return model


def _choose(strong: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Entries so that none starts like another: the longest beginning that loses hardly any rows."""
    chosen: dict[str, float] = {}
    longer = {x[:-1] for x, (n, _) in strong.items() if x[:-1] in strong and n >= 0.95 * strong[x[:-1]][0]}
    for stem in sorted(strong, key=len):
        if stem not in longer and not any(stem[:n] in chosen for n in range(STEM_LETTERS[0], len(stem))):
            chosen[stem] = strong[stem][1]
    return chosen


def _fit(sample: DataFrame, model: Model) -> tuple[float, ...]:
    """Logistic coefficients from the features of the sample, whose size is bounded."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b = zip(*(model.features(x) for x in binary_rows(batch, "text")), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.float64()), pa.array(np.log1p(b), pa.float64()), batch.column(1)], ["a", "b", "toxic"])

    data = np.array([tuple(r) for r in sample.mapInArrow(rows, "a double, b double, toxic int").collect()])
    x, y = np.column_stack([np.ones(len(data)), data[:, :2]]), (data[:, 2] > 0).astype(float)
    beta = np.zeros(3)
    for _ in range(30):  # Newton steps of ridge-penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * beta
        beta = beta + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), slope)
    return tuple(map(float, beta))


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of ``text`` as column ``name``, which replaces one so called."""
    docs = docs.drop(name).withColumn("text", F.col("text").cast("string"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [model.score(x) for x in binary_rows(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(rows, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), learn(docs, labels, list(EXCEPTIONS)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't predicted toxic, with their columns."""
    score = free_name(docs, "_score")
    return with_scores(docs, learn(docs, labels, list(EXCEPTIONS)), score).where(F.col(score) < THRESHOLD).drop(score)
