"""Operator 1: SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints within ``distance`` differing bits agree on at least two of five bit blocks, so the
topmost nodes of the index are the masked patterns of two blocks, and these are the shuffle keys:
ten of them for each distinct fingerprint. Below a node its fingerprints are sorted by Gray rank,
which puts like ones side by side; groups of neighbours share masked bit patterns, which are
factored into parent nodes. A search walks down with the differences found so far and drops every
group whose shared bits alone exceed the distance.

Equal fingerprints are one node, so copies cost nothing. A node with very many fingerprints is
split into cells, one for each pair of its parts. A cell keeps a spanning forest of its links, not
its pairs, and the components of all forests are found by star contraction.

Defined results: a null or empty text has fingerprint zero, linked like any other; repeated rows
and equal texts share a component; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import binary_rows, semi_join, slices, stored
from terrace.llm.components import components

DISTANCE = 3
SEED = 42
#: Bit blocks of a fingerprint: (lowest bit, bits). Any two that agree make a key.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints in a part of a split node; children of a node of the index; queries searched at a time.
PART, FAN, QUERIES = 4096, 8, 1024
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed number."""
    words = text.lower().split()  # of bytes: A-Z alone are lowered, ASCII white space alone splits
    if not words:
        return 0
    join, digest = b" ".join, xxhash.xxh64_intdigest
    parts = map(join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) > shingle else [join(words)]
    return majority(np.fromiter((digest(s, SEED) for s in parts), np.uint64))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), COUNTED):
        ones += np.unpackbits(h[at : at + COUNTED].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint (long) of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [fingerprint(x) for x in binary_rows(batch, text_col)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], [id_col, "fp"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(rows, f"{id_col} long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in Gray order, to be compared as signed numbers."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def node_keys(fp: Column) -> Column:
    """Array of the keys of the topmost nodes that a fingerprint belongs to."""
    block = [F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) for low, bits in BLOCKS]
    keys = [F.lit(n << 26).cast("long") + block[i] * (1 << 13) + block[j] for n, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))]
    return F.array(*keys)


class GrayTree:
    """Hierarchical index over fingerprints in Gray order: each level factors what FAN neighbours share."""

    def __init__(self, prints: np.ndarray):
        every, any_ = prints, prints  # bits set in all, in some of a node's fingerprints
        shared = [np.full(len(prints), ~np.uint64(0))]
        pattern = [prints]
        while len(every) > FAN:
            at = np.arange(0, len(every), FAN)
            every, any_ = np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(any_, at)
            shared.append(every | ~any_)
            pattern.append(every)
        # a node compares the bits that it shares and its parent doesn't
        self.levels = [(p, m & ~np.repeat(up, FAN)[: len(m)]) for p, m, up in zip(pattern, shared, shared[1:], strict=False)]
        self.levels.append((pattern[-1], shared[-1]))

    def within(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, leaf number) of all that differ in at most ``distance`` bits."""
        pattern, mask = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(pattern))
        node = np.tile(np.arange(len(pattern)), len(queries))
        differing = np.zeros(len(q), np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            pattern, mask = self.levels[depth]
            differing = differing + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            kept = differing <= distance
            q, node, differing = q[kept], node[kept], differing[kept]
            if depth:
                below = len(self.levels[depth - 1][0])
                children = node[:, None] * FAN + np.arange(FAN)
                real = children < below
                q, differing = np.repeat(q, FAN)[real.ravel()], np.repeat(differing, FAN)[real.ravel()]
                node = children[real]
        return q, node


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels, each the smallest of its component, after the links (a, b)."""
    label = label.copy()
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of those links (a, b), given in order of preference, that make a spanning forest of n nodes."""
    label, kept = np.arange(n), np.zeros(0, np.int64)
    while True:
        left = np.flatnonzero(label[a] != label[b])
        if not len(left):
            return kept
        first = np.full(n, len(a))
        np.minimum.at(first, label[a[left]], left)
        np.minimum.at(first, label[b[left]], left)
        kept = np.union1d(kept, first[first < len(a)])
        label = _joined(np.arange(n), a[kept], b[kept])


def forest(prints: np.ndarray, distance: int, own_links: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, another of its component) for all but one of each component of a cell.

    ``own_links``: the two are within the distance, the nearest first.
    """
    tree = GrayTree(prints)
    found = [tree.within(prints[at : at + QUERIES], distance) for at in range(0, len(prints), QUERIES)]
    a = np.concatenate([q + k * QUERIES for k, (q, _) in enumerate(found)])
    b = np.concatenate([leaf for _, leaf in found])
    linked = a > b
    a, b = a[linked], b[linked]
    if own_links:
        nearest = np.argsort(np.bitwise_count(prints[a] ^ prints[b]), kind="stable")
        a, b = a[nearest], b[nearest]
        kept = spanning(len(prints), a, b)
        return prints[a[kept]], prints[b[kept]]
    label = _joined(np.arange(len(prints)), a, b)
    child = np.flatnonzero(label != np.arange(len(prints)))
    return prints[child], prints[label[child]]


def _links(batches: Iterator[pa.RecordBatch], distance: int, own_links: bool) -> Iterator[pa.RecordBatch]:
    """Forests of the runs of one (key, cell) in sorted rows."""

    def out(runs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if runs:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*(forest(r, distance, own_links) for r in runs), strict=True))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    last, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, cell, fp = (np.asarray(c) for c in batch.columns)
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
        ends = np.r_[starts[1:], len(key)]
        fp = fp.view(np.uint64)
        if last == (key[0], cell[0]):
            held.append(fp[: ends[0]])
            if len(ends) == 1:
                continue
            starts, ends = starts[1:], ends[1:]
        runs = [np.concatenate(held)] if sum(map(len, held)) > 1 else []
        many = np.flatnonzero(ends - starts > 1)
        runs += [fp[starts[k] : ends[k]] for k in many if k < len(starts) - 1]
        last, held = (key[-1], cell[-1]), [fp[starts[-1] :].copy()]
        yield from out(runs)
    if sum(map(len, held)) > 1:
        yield from out([np.concatenate(held)])


def link_forest(prints: DataFrame, distance: int = DISTANCE, own_links: bool = False) -> DataFrame:
    """Pairs (a, b) of fingerprints that connect whatever of ``prints`` (distinct fp) is within the distance.

    ``own_links``: each pair itself is within the distance.
    """
    keyed = prints.select("fp", F.explode(node_keys(F.col("fp"))).alias("key"))
    crowded = keyed.groupBy("key").count().where(F.col("count") > PART).select("key", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    celled = keyed.join(crowded, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", own).withColumn("other", other)
    celled = celled.select("key", (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).cast("long").alias("cell"), "fp")
    laid = celled.repartition("key", "cell").sortWithinPartitions("key", "cell", gray_rank(F.col("fp")))
    return laid.mapInArrow(lambda batches: _links(batches, distance, own_links), "a long, b long")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that links reach) of every document."""
    marked = stored(fingerprints(docs), "fingerprints")
    prints = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("doc")), "prints")
    roots = components(link_forest(prints))
    placed = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "doc", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("doc").alias("component_id"))
    of_print = placed.join(least, "root").select("fp", "component_id")
    return marked.join(of_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The documents without those that another one of their component, with a smaller doc_id, stands for.

    Rows that share a doc_id count as one document.
    """
    return semi_join(docs, near_duplicates(docs, distance).where("doc_id <=> component_id").select("doc_id"))
