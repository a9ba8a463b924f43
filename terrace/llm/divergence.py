"""Operator 13: audit of how the sources of a language differ, on run-length encoded count columns.

Terms are counted for each (language, source) group. The kept vocabulary of a language is put in an order
that lets equal counts lie side by side: by the counts in its largest sources, and whatever terms have
the same counts everywhere together. In that order each group is a column of probabilities, encoded as
runs. Two groups are compared by intersecting the bounds of their runs: one term of the divergence a piece,
multiplied by the piece's length.

The vocabulary is cut into blocks of bounded length, each of which is compared by itself and adds to the
sums; the columns of one block are dealt out in cells where a language has many sources. All arithmetic is
in whole numbers.

Defined results: null text, language and source read as ''; a group without terms counts each term 0
times; a language without kept terms has pairs of value 0 and no terms; repeated rows count each;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored
from terrace.llm.tokens import text_blocks

#: Documents of a language that make a term kept; the whole of a probability; ranks of terms.
LEAST_DOCS, WHOLE, TERMS = 10, 1_000_000_000, 10
#: Terms in a block of the vocabulary; columns of a block that a cell takes from either side; sources whose counts order the terms.
BLOCK, SIDE, LEADING = 1 << 15, 32, 8
#: Bytes of text that are counted at a time.
BLOCK_BYTES = 8 << 20

# letters and all beyond ASCII make terms; everything else is blank
_TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_lists(texts: pa.Array) -> pa.ListArray:
    """The terms of each text, in order; empty ones among them at blanks at the ends."""
    texts = pa.concat_arrays([texts.cast(pa.string())])
    _, offsets, data = texts.buffers()
    if data is None:
        return pc.ascii_split_whitespace(texts)
    plain = pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(data.to_pybytes().translate(_TERM_BYTES)), offset=texts.offset)
    return pc.ascii_split_whitespace(plain)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it); for each group also a row without term."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for b in batches for x in text_blocks(b, "text", BLOCK_BYTES)):
            lists = term_lists(batch.column(2))
            coded = lists.flatten().dictionary_encode()
            words = len(coded.dictionary)
            lang, source = (batch.column(k).dictionary_encode() for k in (0, 1))
            group = np.asarray(lang.indices).astype(np.int64) * len(source.dictionary) + np.asarray(source.indices)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            code = np.asarray(coded.indices).astype(np.int64)
            real = np.asarray(pc.greater(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False), bool)[code] if words else np.zeros(0, bool)
            doc, code = doc[real], code[real]
            in_doc, n = np.unique(doc * max(words, 1) + code, return_counts=True)  # once a document
            doc, code = np.divmod(in_doc, max(words, 1))
            key, at = np.unique(group[doc] * max(words, 1) + code, return_inverse=True)
            total = np.bincount(at, n, len(key)).astype(np.int64)
            docs_with = np.bincount(at, minlength=len(key)).astype(np.int64)
            group_of, code = np.divmod(key, max(words, 1))
            present = np.unique(group)
            group_of = np.r_[group_of, present]
            none = len(present)
            term = pa.concat_arrays([coded.dictionary.take(pa.array(code)), pa.nulls(none, pa.string())])
            of_lang, of_source = np.divmod(group_of, len(source.dictionary))
            columns = [lang.dictionary.take(pa.array(of_lang)), source.dictionary.take(pa.array(of_source)), term, pa.array(np.r_[total, np.zeros(none, np.int64)]), pa.array(np.r_[docs_with, np.zeros(none, np.int64)])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = read.mapInArrow(rows, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE * (n + 2) / (total + 2 * terms)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", F.lit(WHOLE).cast("decimal(10,0)") * (wide(n) + 2), wide(total) + wide(terms) * 2) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def ordered_terms(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, term, block and at (place in it) of every kept term, those of like counts side by side.

    The terms are sorted by their counts in the language's LEADING largest sources, then by a checksum of all
    counts, so that equal rows of the table of counts are neighbours.
    """
    largest = groups.withColumn("leading", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("total"), "source"))).where(F.col("leading") <= LEADING)
    placed = cells.join(largest.select("lang", "source", "leading"), ["lang", "source"], "left")
    counts = [F.coalesce(F.sum(F.when(F.col("leading") == k, F.col("n"))), F.lit(0)).alias(f"c{k}") for k in range(1, LEADING + 1)]
    alike = F.sum(F.xxhash64("source", "n").bitwiseAND(F.lit((1 << 40) - 1))).alias("alike")
    keyed = placed.groupBy("lang", "term").agg(*counts, F.sum("n").alias("n"), alike)
    order = ["lang", *(f"c{k}" for k in range(1, LEADING + 1)), "n", "alike", "term"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, last, at, block = TaskContext.get().partitionId() << 32, None, 0, 0
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            number = np.asarray(lang.indices)
            places, blocks = np.empty(len(number), np.int32), np.empty(len(number), np.int64)
            edges = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else []
            for a, b in zip(edges, [*edges[1:], len(number)], strict=True):
                name = lang.dictionary[number[a]].as_py()
                if name != last:
                    block, at, last = block + 1, 0, name
                place = at + np.arange(b - a)
                places[a:b], blocks[a:b] = place % BLOCK, first + block + place // BLOCK
                at += b - a
                block, at = block + at // BLOCK, at % BLOCK
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blocks), pa.array(places)], ["lang", "term", "block", "at"])

    laid = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("lang", "term")
    return stored(laid.mapInArrow(rows, "lang string, term string, block long, at int"), "vocabulary")


def run_columns(cells: DataFrame, groups: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, block, source, ends and values: the run-length encoded column of every group in every block.

    ``cells``: lang, source, term, p; ``groups``: lang, source, rest (p of terms that the group lacks).
    """
    blocks = terms.groupBy("lang", "block").agg(F.count("*").cast("int").alias("length"))
    begun = groups.join(blocks, "lang").select("lang", "block", "source", F.lit(-1).alias("at"), F.col("rest").alias("p"), "length")
    known = cells.join(terms, ["lang", "term"]).select("lang", "block", "source", "at", "p", F.lit(0).alias("length"))
    laid = begun.unionByName(known).repartition("lang", "block", "source").sortWithinPartitions("lang", "block", "source", "at")

    def encoded(names: tuple, at: np.ndarray, p: np.ndarray, length: int) -> tuple:
        """One column: the cells of one group in one block, the first of which tells the rest and the length."""
        rest, at, p = p[0], at[1:], p[1:]
        ends, values = np.empty(2 * len(at) + 1, np.int32), np.empty(2 * len(at) + 1, np.int64)
        ends[0:-1:2], values[0:-1:2], ends[1:-1:2], values[1:-1:2] = at, rest, at + 1, p  # up to a cell the rest, then the cell
        ends[-1], values[-1] = length, rest
        real = np.diff(np.r_[0, ends]) > 0
        ends, values = ends[real], values[real]
        last = np.r_[values[1:] != values[:-1], True][: len(values)]
        return (*names, ends[last], values[last])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple]) -> pa.RecordBatch:
            lang, block, source, ends, values = zip(*found, strict=True)
            offsets = pa.array(np.cumsum([0, *map(len, ends)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (ends, values)]
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(block, pa.int64()), pa.array(source, pa.string()), *lists], ["lang", "block", "source", "ends", "values"])

        def closed(names: tuple, held: list[tuple]) -> tuple:
            return encoded(names, *(np.concatenate(x) for x in zip(*(h[:2] for h in held), strict=True)), held[0][2])

        names, held = None, []  # the column that is open, at most one block long
        for batch in batches:
            if not batch.num_rows:
                continue
            at, p, length = (np.asarray(batch.column(k)) for k in (3, 4, 5))
            starts = np.flatnonzero(at == -1)
            found = []
            cut = [0, *starts, batch.num_rows] if not len(starts) or starts[0] else [*starts, batch.num_rows]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if at[a] == -1:  # another column begins
                    if held:
                        found.append(closed(names, held))
                    names, held = tuple(batch.column(k)[int(a)].as_py() for k in range(3)), []
                held.append((at[a:b], p[a:b], int(length[a])))
            if found:
                yield out(found)
        if held:
            yield out([closed(names, held)])

    return stored(laid.mapInArrow(rows, "lang string, block long, source string, ends array<int>, values array<long>"), "columns")


def compared(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of the divergence of two columns, given as (ends, values) of their runs."""
    (ends_a, p), (ends_b, q) = a, b
    ends = np.union1d(ends_a, ends_b)
    p, q = p[np.searchsorted(ends_a, ends)], q[np.searchsorted(ends_b, ends)]
    return int(((p - q) * (p - q) // (p + q) * np.diff(np.r_[0, ends])).sum())


def pair_sums(columns: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (source < item) and value summed over all blocks."""
    parts = groups.groupBy("lang").agg(F.ceil(F.count("*") / SIDE).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("source"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    celled = columns.join(parts, "lang").withColumn("own", own).withColumn("other", other)
    cell = (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).cast("long").alias("cell")
    laid = celled.select("lang", "block", cell, "own", "source", "ends", "values").repartition("lang", "block", "cell").sortWithinPartitions("lang", "block", "cell", "source")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: tuple, held: list[tuple]) -> Iterator[pa.RecordBatch]:
            apart = len({own for own, *_ in held}) > 1  # a cell of two parts leaves the pairs inside either to others
            found = [(held[i][1], held[k][1], compared(held[i][2:], held[k][2:])) for i in range(len(held)) for k in range(i + 1, len(held)) if not apart or held[i][0] != held[k][0]]
            if found:
                a, b, v = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(a), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(v, pa.int64())], ["lang", "source", "item", "value"])

        key, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                now = tuple(batch.column(c)[k].as_py() for c in range(3))
                if now != key:
                    yield from out(key, held)
                    key, held = now, []
                ends, values = (batch.column(c)[k].values for c in (5, 6))
                held.append((batch.column(3)[k].as_py(), batch.column(4)[k].as_py(), np.array(ends), np.array(values)))
        yield from out(key, held)

    summed = laid.mapInArrow(rows, "lang string, source string, item string, value long")
    return summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, terms: int = TERMS) -> DataFrame:
    """lang, source, part ("pair" or "term"), item, value, rank: for each group all other sources of its language, and the terms that it has oftenest beyond its share."""
    counts = stored(term_counts(docs), "counts")
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(F.col("docs") >= least_docs)
    kept = stored(kept.select("lang", "term", "n_lang"), "kept")
    cells = stored(counts.where("term is not null").select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "cells")

    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "terms", "total_lang"])
    groups = stored(groups.withColumn("rest", F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms")))), "groups")
    # a group's numbers ride along with its cells
    priced = cells.join(groups.drop("rest"), ["lang", "source"])
    priced = priced.select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("n_lang"), F.col("total_lang"), F.col("terms")).alias("q"))

    vocabulary = ordered_terms(cells, groups)
    columns = run_columns(priced.select("lang", "source", "term", "p"), groups.where("terms > 0").select("lang", "source", "rest"), vocabulary)
    half = stored(pair_sums(columns, groups), "pairs")
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    every = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = every.join(both, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    telling = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    telling = telling.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(telling)


#: The same by joins of plain counts.
AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY ALL HAVING count(DISTINCT k) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN kept ON w.lang = kept.lang AND w.term = kept.term GROUP BY ALL),
t AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY ALL),
cell AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (coalesce(t.n, 0) + 2 * v.v) AS p, 1 + (1000000000 * (kept.n + 2)) // (v.n + 2 * v.v) AS q
  FROM g JOIN kept ON g.lang = kept.lang JOIN v ON v.lang = g.lang
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM cell WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= 10
"""
