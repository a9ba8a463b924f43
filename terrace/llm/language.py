"""Operator 2: language identification by Bayesian evidence fusion.

Evidence of a text's language: letter trigrams of its words, the language its markup declares, the
suffix of its address, and its host. The trigram likelihoods are learnt from a bounded labelled
sample of each language. A first pass gives each row a posterior by its text alone; grouped aggregation of these
says how far declarations and suffixes are to be trusted, and gives each host a prior
that is smoothed towards its domain's, which is smoothed towards that of the whole table. All of these
leave the row's own posterior out, so its text counts once. The final posterior is their product.

Defined results: a text without a letter trigram has the language "und" and isn't accepted, nor is one most of whose
trigrams no language of the sample has; null
texts, declarations, suffixes and hosts are no evidence; repeated rows get equal results; an empty
table gives an empty result; with no labelled rows every text is "und".
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import binary_rows, semi_join, slices, stored
from terrace.llm.tokens import ChunkMemo, chunks_of, text_blocks
from terrace.llm.toxicity import held_out

#: Labelled rows that the likelihoods are learnt from, at most, in equal parts for the languages.
SAMPLE_ROWS = 4_000
#: Text counts as so many independent trigrams at most; rows that the table's shares count as in what is told of a value, a domain and a host.
INDEPENDENT, VALUE_WEIGHT, DOMAIN_WEIGHT, HOST_WEIGHT = 40.0, 5.0, 50.0, 20.0
#: Chunks whose trigrams are looked up at a time; chunks that a worker keeps.
COUNTED, KEPT = 10_000, 100_000
#: A language is accepted from this posterior on, if this share of the trigrams is known.
LEAST_POSTERIOR, LEAST_KNOWN = 0.5, 0.5
#: Bytes of text that are split at a time.
BLOCK_BYTES = 4 << 20
#: Rows of an evidence table that are sent to every executor at most.
SENT_ROWS = 50_000


def trigrams(word: str) -> list[str]:
    """Letter trigrams of a word between blanks, its other characters left out."""
    w = f" {word if word.isalpha() else ''.join(c for c in word if c.isalpha())} ".lower()
    return [w[i : i + 3] for i in range(len(w) - 2)] if len(w) > 2 else []


class Likelihoods:
    """Log probabilities of trigrams by language."""

    def __init__(self, counts: dict[str, Counter]):
        self.languages = sorted(counts)
        every = sorted({g for c in counts.values() for g in c})
        table = np.array([[counts[la][g] for la in self.languages] for g in every], dtype=float).reshape(len(every), len(self.languages))
        total = table.sum(axis=0) + 0.5 * (len(every) + 1)
        self.place = {g: k + 1 for k, g in enumerate(every)}
        #: Row 0: a trigram that wasn't seen.
        self.logs = np.vstack([np.log(0.5 / total), np.log((table + 0.5) / total)])

    def chunks(self, chunks: list[bytes]) -> list[bytes]:
        """(number of trigrams, number of known ones, log probability by language) of each chunk, as packed floats."""
        if len(chunks) > COUNTED:
            return [x for k in range(0, len(chunks), COUNTED) for x in self.chunks(chunks[k : k + COUNTED])]
        place, at, ends = self.place, [], []
        for c in chunks:
            at += [place.get(g, 0) for g in trigrams(c.decode("utf-8", "replace"))]
            ends.append(len(at))
        at = np.array(at, dtype=np.int64)
        each = np.column_stack([np.ones(len(at)), at > 0, self.logs[at]])
        upto = np.vstack([np.zeros(each.shape[1]), np.cumsum(each, axis=0)])
        ends = np.array(ends, dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        packed = (upto[ends] - upto[starts]).astype("<f4")
        return [x.tobytes() for x in packed]


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Likelihoods:
    """Likelihoods from at most about ``rows`` rows of ``docs`` (doc_id, text, lang) outside the held-out fold.

    Each language has the same share of the sample, small ones all their rows; the driver gets one row a language.
    """
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang").where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    share = max(1, rows // max(1, len(sizes)))
    steps = F.create_map(*(F.lit(x) for la, n in sorted(sizes.items()) for x in (la, -(-n // share)))) if sizes else F.lit(None).cast("map<string,int>")
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.element_at(steps, F.col("lang"))) == 0).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: dict[str, Counter] = {}
            for text, la in zip(binary_rows(batch, "text"), batch.column(1).to_pylist(), strict=True):
                words = Counter(text.decode("utf-8", "replace").split())
                of = found.setdefault(la, Counter())
                for w, n in words.items():
                    for g in trigrams(w):
                        of[g] += n
            flat = [(la, g, n) for la, c in found.items() for g, n in c.items()]
            if flat:
                a, b, c = zip(*flat, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c, pa.int64())], ["lang", "gram", "n"])

    summed = sample.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, Counter] = {}
    for r in summed.collect():
        counts.setdefault(r["lang"], Counter())[r["gram"]] = r["n"]
    return Likelihoods(counts)


def with_text_evidence(rows: DataFrame, model: Likelihoods, text_col: str = "text") -> DataFrame:
    """All columns of ``rows`` but the text's, and ``_grams``, ``_known``, ``_logs`` (of the text by language)."""
    kept = [f for f in rows.schema.fields if f.name != text_col]
    rows = rows.select(*(f.name for f in kept), F.col(text_col).cast("string").alias(text_col))
    width = len(model.languages) + 2

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = ChunkMemo(model.chunks, KEPT)
        for batch in (x for b in batches for x in text_blocks(b, text_col, BLOCK_BYTES)):
            begin, number, distinct = chunks_of(batch.column(len(kept)))
            table = np.frombuffer(b"".join(memo.of(distinct)), "<f4").reshape(-1, width).astype(np.float64)
            sums = np.zeros((batch.num_rows, width))
            for k in range(width):
                upto = np.concatenate([[0.0], np.cumsum(table[number, k])])
                sums[:, k] = upto[begin[1:]] - upto[begin[:-1]]
            logs = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * (width - 2), pa.array(sums[:, 2:].ravel()))
            numbers = [pa.array(np.rint(sums[:, k]).astype(np.int64)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *numbers, logs], [*(f.name for f in kept), "_grams", "_known", "_logs"])

    return rows.mapInArrow(score, T.StructType([*kept, T.StructField("_grams", T.LongType()), T.StructField("_known", T.LongType()), T.StructField("_logs", T.ArrayType(T.DoubleType()))]))


def _posterior(logs: Column) -> Column:
    """Log weights to probabilities."""
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def _sums(n: int) -> list[Column]:
    return [F.sum(F.get("_p", F.lit(k))).alias(f"s{k}") for k in range(n)]


def _told(rows: DataFrame, first: DataFrame, name: str, n: int) -> DataFrame:
    """``rows`` with the number (_n_name) and summed posteriors (_s_name) of the rows of ``first`` that have their value, null for no value.

    The table has one row a value. A small one is sent to all executors; of a larger one, the values of very many
    rows are, and those of few rows join by shuffle, so that no value gathers its rows in one task.
    """
    counts, sums = f"_n_{name}", f"_s_{name}"
    by = stored(first.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias(counts), F.array(*_sums(n)).alias(sums)), "evidence")
    size = by.agg(F.count("*").alias("n"), F.sum(counts).alias("rows")).first()
    if size["n"] <= SENT_ROWS:
        return rows.join(F.broadcast(by), name, "left")
    heavy = by.where(F.col(counts) >= size["rows"] / SENT_ROWS)
    hot = rows.join(F.broadcast(heavy), name)
    cold = rows.where(F.col(name).isNotNull()).join(F.broadcast(heavy.select(name)), name, "left_anti").join(by, name, "left")
    none = rows.where(F.col(name).isNull()).withColumns({counts: F.lit(None).cast("long"), sums: F.lit(None).cast("array<double>")})
    return hot.unionByName(cold).unionByName(none)


def identify(rows: DataFrame, model: Likelihoods, declared: str | None = None, suffix: str | None = None, host: str | None = None, domain: str | None = None) -> DataFrame:
    """``rows`` (already with text evidence and stored) with lang, posterior and accepted in place of the evidence.

    The names are those of the columns that hold the declared language, the address suffix, the host
    and the host's domain.
    """
    n = len(model.languages)
    if not n:
        return rows.drop("_grams", "_known", "_logs").withColumns({"lang": F.lit("und"), "posterior": F.lit(0.0), "accepted": F.lit(False)})
    scale = F.least(F.lit(1.0), F.lit(INDEPENDENT) / F.greatest(F.col("_grams"), F.lit(1)))
    told = F.col("_grams") > 0
    rows = rows.withColumn("_text", F.transform("_logs", lambda x: x * scale))
    # the row's own part of all sums: its posterior by text alone, nothing without a trigram
    rows = rows.withColumn("_p", F.when(told, _posterior(F.col("_text"))).otherwise(F.array_repeat(F.lit(0.0), n))).withColumn("_one", told.cast("int"))
    first = rows.where("_grams > 0")
    table = first.agg(*_sums(n)).first()
    every = F.array(*(F.lit((table[k] or 0.0) + 1.0) for k in range(n)))
    rows = rows.withColumn("_base", F.zip_with(every, "_p", lambda s, p: s - p))
    rows = rows.withColumn("_base", F.transform("_base", lambda x: x / F.aggregate("_base", F.lit(0.0), lambda a, b: a + b)))

    def of_value(name: str, above: Column, weight: float) -> Column:
        """P(language | value) by the other rows, smoothed towards ``above``."""
        others = F.zip_with(f"_s_{name}", "_p", lambda s, p: F.greatest(s - p, F.lit(0.0)))
        found = F.zip_with(others, above, lambda s, q: (s + weight * q) / (F.col(f"_n_{name}") - F.col("_one") + weight))
        return F.when(F.col(f"_n_{name}").isNull(), above).otherwise(found)

    logs, prior = F.col("_text"), F.col("_base")
    for name in (declared, suffix):
        if name:
            rows = _told(rows, first, name, n)
            told_by = F.zip_with(of_value(name, F.col("_base"), VALUE_WEIGHT), "_base", lambda a, b: F.log(a / b))
            logs = F.zip_with(logs, told_by, lambda a, b: a + b)
    for name, weight in ((domain, DOMAIN_WEIGHT), (host, HOST_WEIGHT)):
        if name:
            rows = _told(rows, first, name, n)
            prior = of_value(name, prior, weight)
    rows = rows.withColumn("_logs", F.zip_with(logs, prior, lambda a, p: a + F.log(p))).withColumn("_p", _posterior(F.col("_logs")))
    best = F.array_max("_p")
    found = F.when(told, F.element_at(F.array(*(F.lit(x) for x in model.languages)), F.array_position("_p", best).cast("int"))).otherwise("und")
    known = F.col("_known") >= LEAST_KNOWN * F.col("_grams")
    rows = rows.withColumns({"lang": found, "posterior": F.when(told, best).otherwise(0.0), "accepted": told & known & (best >= LEAST_POSTERIOR)})
    return rows.drop(*[c for c in rows.columns if c.startswith("_")])


def document_languages(docs: DataFrame) -> DataFrame:
    """doc_id, lang, posterior, accepted, declared of every document, its source being its host.

    The ``lang`` of a document is what the likelihoods are learnt from, so it is no evidence of its own row.
    """
    model = learn(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("declared"), F.col("source").alias("host"), "text")
    return identify(stored(with_text_evidence(rows, model), "languages"), model, host="host").select("doc_id", "lang", "posterior", "accepted", "declared")


def page_languages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, posterior, accepted, declared of every page, by all four kinds of evidence."""
    model = learn(docs)
    html = F.col("html").cast("string")
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style|title)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>|&#?\w+;", " ")
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"^\w+://([^/:?#]+)", 1))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)), F.lit("")).alias("declared"),
        F.nullif(F.substring_index(host, ".", -1), F.lit("")).alias("suffix"),
        F.nullif(F.nullif(F.substring_index(host, ".", -3), F.lit("")), host).alias("domain"),  # none of a host that is its own
        F.nullif(host, F.lit("")).alias("host"),
        bare.alias("text"),
    )
    found = identify(stored(with_text_evidence(rows, model), "languages"), model, "declared", "suffix", "host", "domain")
    return found.select("page_id", "lang", "posterior", "accepted", "declared")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is accepted, with their columns as they were."""
    return semi_join(docs, document_languages(docs).where("accepted").select("doc_id"))
