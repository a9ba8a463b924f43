"""Operator 11: MinHash near-duplicates by tensored banding.

Two small collections of TABLES pieces, each of two minhashes, are made for every distinct set of shingles. The keys of
the tables are the pairs of a piece of the first and one of the second collection: 2 * 2 * TABLES minhashes
make TABLES * TABLES tables of four minhashes each, where tables of their own would need 4 * TABLES * TABLES.
Two sets of similarity j share a table with probability (1 - (1 - j*j) ** TABLES) ** 2: at 0.85 all but
one pair in 50,000, before the chains that connect most of them anyway.

Links are confirmed on full sets, in rounds. In the first each set meets that table head which it shares most tables
with. From then on what still shares a table with another component is compared in place, in cells by pieces of the
first collection, with those that also agree in one of the second: by sizes and minhashes, then by the LOW lowest
hashes of both sets. In two rounds each set meets those that are most alike, which connects most of a large
group; in the last all meet that may be similar, each pair given out once.

Equal sets are one node, so copies cost nothing. A key of very many nodes never gathers in one task: heads are
minima, joins on keys may be split, and comparisons are dealt out in cells by exact counts.

Defined results: null and empty texts have no shingles and are linked with nothing, each its own component;
repeated rows and equal sets share a component; rows without doc_id don't count as the smallest; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import release, slices, stored
from terrace.llm.components import components
from terrace.llm.overlap import node_of, placed, shingles, whole_runs
from terrace.llm.tokens import text_blocks

#: Words of a shingle; least similarity in hundredths; pieces of a collection.
SHINGLE, NEAR, OF, TABLES = 3, 85, 100, 9
MINHASHES = 4 * TABLES
#: Equal minhashes that make a pair worth a comparison of its lowest hashes: at a similarity of 0.85 one pair in 10**7 has fewer.
ALIKE = MINHASHES // 2
#: Lowest hashes of a set that are kept, and hits among the LOW lowest of both that make a pair worth its full sets: at 0.85 three pairs in 10**6 have fewer.
LOW, HITS = 256, 190
#: Nodes of a key that are compared in one task from either side; comparisons held at a time; sets that are compared with one in one task.
PART, HELD, EACH = 2048, 1 << 16, 256
#: Bytes of text whose shingles are made at a time.
BLOCK_BYTES = 4 << 20

_SEEDS = np.random.default_rng(42).integers(1, 1 << 63, (MINHASHES, 2), np.uint64) | np.uint64(1)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """The minhashes of sets of shingle hashes, none of them empty, a row each."""
    out = np.empty((len(sets), MINHASHES), np.uint32)
    if sets:
        h, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
        for k, (flip, odd) in enumerate(_SEEDS):
            mixed = (h ^ flip) * odd
            mixed ^= mixed >> np.uint64(29)
            mixed *= odd
            out[:, k] = np.minimum.reduceat((mixed >> np.uint64(32)).astype(np.uint32), starts)
    return out


def lowest(found: np.ndarray) -> bytes:
    """The upper halves of the lowest hashes of an ascending set."""
    return (found[:LOW] >> np.uint64(32)).astype("<u4").tobytes()


def alike(low: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How similar the pairs (a, b) are by their lowest hashes, in parts of LOW; -1 where they can't be similar enough.

    ``low``: a row for each set, filled up with the greatest number. Of two sets that are no larger than LOW this is exact.
    """
    both = np.sort(np.concatenate([low[a], low[b]], axis=1), axis=1)
    same = np.zeros(both.shape, bool)
    same[:, 1:] = both[:, 1:] == both[:, :-1]
    real = both < np.uint32(0xFFFFFFFF)
    place = np.cumsum(~same & real, axis=1)  # of a hash in the union
    whole = (size[a] <= LOW) & (size[b] <= LOW)
    upto = real & (whole[:, None] | (place <= LOW))
    hits, union = (same & upto).sum(axis=1), (~same & upto).sum(axis=1)
    fit = np.where(whole, OF * hits >= NEAR * union, hits >= HITS)
    return np.where(fit, hits * LOW // np.maximum(union, 1), -1)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def marks(docs: DataFrame) -> DataFrame:
    """doc_id, node (number of the set), size, minhashes and lowest hashes of every row; no minhashes where the set is empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for b in batches for x in text_blocks(b, "text", BLOCK_BYTES)):
            sets = [np.unique(h) for h in shingles(batch.column(1), SHINGLE)]
            size = np.array([len(x) for x in sets], np.int64)
            mins = minhashes([x for x in sets if len(x)])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.r_[0, np.where(size > 0, MINHASHES, 0)]).astype(np.int32)), pa.array(mins.view(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(node_of, sets), pa.int64()), pa.array(size), lists, pa.array([lowest(x) for x in sets], pa.binary())], ["doc_id", "node", "size", "mins", "low"])

    return _texts(docs).mapInArrow(rows, "doc_id long, node long, size long, mins array<int>, low binary")


def table_keys(mins: Column) -> Column:
    """The keys of all tables: each piece of the first collection with each of the second."""
    piece = lambda k: F.xxhash64(F.lit(k), mins[2 * k], mins[2 * k + 1])
    first, second = (F.array(*map(piece, range(at, at + TABLES))) for at in (0, TABLES))
    return F.flatten(F.transform(first, lambda a: F.transform(second, lambda b: F.xxhash64(a, b))))


def shared_keys(nodes: DataFrame) -> DataFrame:
    """key, node and head (the key's smallest node) wherever several nodes share a key."""
    keyed = nodes.select("node", F.explode(table_keys(F.col("mins"))).alias("key"))
    crowd = keyed.groupBy("key").agg(F.count("*").alias("nodes"), F.min("node").alias("head")).where("nodes > 1")
    return keyed.join(crowd.drop("nodes"), "key")


def heads(shared: DataFrame) -> DataFrame:
    """For each node the head of another one's tables that it meets in most: pairs (a, b)."""
    met = shared.where("node <> head").groupBy("node", "head").count()
    return met.groupBy("node").agg(F.max(F.struct("count", "head")).alias("most")).select(F.col("node").alias("a"), F.col("most.head").alias("b"))


def apart(shared: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the nodes that share a key with another component: piece (its number), key, nodes (of the key), node, root, size, mins, low.

    Keys are the pieces of the first collection here: who shares a table shares one of them.
    """
    rooted = placed(shared.drop("head"), roots)
    mixed = rooted.groupBy("key").agg(F.min("root").alias("first"), F.max("root").alias("last")).where("first <> last")
    asked = stored(rooted.join(mixed.select("key"), "key", "left_semi").select("node", "root").distinct(), "asked")
    piece = F.transform(F.sequence(F.lit(0), F.lit(TABLES - 1)), lambda k: F.xxhash64(k, F.get("mins", 2 * k), F.get("mins", 2 * k + 1)))
    keyed = nodes.select("node", "mins").join(asked, "node").select("node", "root", F.posexplode(piece).alias("piece", "key"))
    crowd = keyed.groupBy("key").agg(F.min("root").alias("first"), F.max("root").alias("last"), F.count("*").alias("nodes")).where("first <> last")
    return keyed.join(crowd.select("key", "nodes"), "key").join(nodes.select("node", "size", "mins", "low"), "node")


def candidates(wide: DataFrame, best: bool) -> DataFrame:
    """Pairs (a, b) of nodes of different components that share a table and may be similar.

    ``wide``: rows of ``apart``. Of a cell's nodes, those outside the commonest component are compared with all. ``best``: for each
    of these the one of that component and the one of others that are most alike; else all pairs, once each.
    """
    wide = wide.withColumn("parts", F.ceil(F.col("nodes") / PART).cast("int"))
    own, other = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    celled = wide.withColumn("own", own).withColumn("other", other)
    cell = (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).cast("long").alias("cell")
    laid = celled.select("key", cell, "piece", "own", "node", "root", "size", "mins", "low").repartition("key", "cell").sortWithinPartitions("key", "cell", "root", "node")

    def compared(i: int, own: np.ndarray, node: np.ndarray, root: np.ndarray, size: np.ndarray, mins: np.ndarray, low: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        values, counts = np.unique(root, return_counts=True)
        asking = root != values[counts.argmax()]
        asks = np.flatnonzero(asking)
        piece = np.ascontiguousarray(mins).view(np.uint64)
        step = max(1, HELD // len(node))
        for block in (asks[at : at + step] for at in range(0, len(asks), step)):
            fit = (root[block, None] != root) & (OF * np.minimum(size[block, None], size) >= NEAR * np.maximum(size[block, None], size))
            if own.min() != own.max():
                fit &= own[block, None] != own
            if not best:
                fit &= ~asking | (block[:, None] < np.arange(len(node)))  # two that ask meet once
            a, b = np.nonzero(fit)
            a = block[a]
            same = piece[a] == piece[b]
            kept = (same[:, :TABLES].argmax(axis=1) == i) & same[:, TABLES:].any(axis=1)
            a, b = a[kept], b[kept]
            kept = (mins[a] == mins[b]).sum(axis=1) >= ALIKE
            a, b = a[kept], b[kept]
            near = np.concatenate([np.zeros(0, np.int64), *(alike(low, size, a[k : k + 4096], b[k : k + 4096]) for k in range(0, len(a), 4096))])
            a, b, near = a[near >= 0], b[near >= 0], near[near >= 0]
            if best:
                order = np.lexsort((-near, asking[b], a))
                a, b, near = a[order], b[order], near[order]
                kept = np.r_[True, (a[1:] != a[:-1]) | (asking[b[1:]] != asking[b[:-1]])][: len(a)]
                a, b, near = a[kept], b[kept], near[kept]
            yield node[a], node[b], near, asking[b]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, (_, _, piece, own, node, root, size, mins, low) in whole_runs(batches, 2):
            for x, y in zip(starts[:-1], starts[1:], strict=True):
                if root[x] != root[y - 1]:
                    lows = np.full((y - x, LOW), 0xFFFFFFFF, np.uint32)
                    for k, held in enumerate(low[x:y]):
                        lows[k, : len(held) // 4] = np.frombuffer(held, "<u4")
                    for a, b, near, asked in compared(int(piece[x]), own[x:y], node[x:y], root[x:y], size[x:y], np.stack(mins[x:y]), lows):
                        if len(a):
                            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(near.astype(np.int32)), pa.array(asked)], ["a", "b", "alike", "asked"])
        release()

    found = laid.mapInArrow(rows, "a long, b long, alike int, asked boolean")
    if best:
        found = found.groupBy("a", "asked").agg(F.max(F.struct("alike", "b")).alias("most")).select("a", F.col("most.b").alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= NEAR * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b; distinct and stored) whose full sets are similar, stored.

    The sets to compare with one b come to it in cells of about EACH, so that its own set is sent once a cell.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for b in batches for x in text_blocks(b, "text", BLOCK_BYTES)):
            sets = [np.unique(h) for h in shingles(batch.column(1), SHINGLE)]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, sets), pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "found"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.zeros(0, np.uint64)
        for batch in slices(batches):
            links = []
            for b, a, found in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                now = np.frombuffer(found.as_buffer(), np.uint64)
                if a is None:
                    one = now.copy()
                elif similar(one, now):
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])
        release()

    asked = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "asked")
    of = nodes.join(asked, "node").select("node", F.col("doc").alias("_doc"))
    # rows that share a doc_id can have other texts
    texts = _texts(docs).join(of.select("_doc").distinct(), F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    sets = stored(texts.mapInArrow(made, "node long, found binary").join(asked, "node", "left_semi").dropDuplicates(["node"]), "sets")
    cells = pairs.groupBy("b").agg(F.ceil(F.count("*") / EACH).cast("int").alias("cells"))
    ask = pairs.join(cells, "b").select("b", F.pmod(F.xxhash64("a"), F.col("cells")).cast("int").alias("cell"), "a")
    ask = ask.join(sets.withColumnRenamed("node", "a"), "a").select("b", "cell", "a", "found")
    ones = cells.join(sets.withColumnRenamed("node", "b"), "b").select("b", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.lit(None).cast("long").alias("a"), "found")
    laid = ask.unionByName(ones).repartition("b", "cell").sortWithinPartitions("b", "cell", F.asc_nulls_first("a"))
    return stored(laid.mapInArrow(decide, "a long, b long"), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach), kept (whether it is that one) of every document."""
    marked = stored(marks(docs), "marks")
    nodes = marked.where("size > 0").groupBy("node").agg(F.min("doc_id").alias("doc"), F.first("size").alias("size"), F.first("mins").alias("mins"), F.first("low").alias("low"))
    nodes = stored(nodes, "nodes")
    shared = stored(shared_keys(nodes), "shared")

    tested = stored(heads(shared), "pairs")
    links = confirmed(tested, nodes, docs)
    roots = components(links)
    for best in (True, True, False):
        found = candidates(apart(shared, nodes, roots), best)
        met = tested.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        pairs = stored(found.join(met, (F.least("a", "b") == F.col("x")) & (F.greatest("a", "b") == F.col("y")), "left_anti"), "pairs")
        tested, links = tested.union(pairs), links.union(confirmed(pairs, nodes, docs))
        roots = components(links)

    whole = placed(nodes.select("node", "doc"), roots)
    least = whole.groupBy("root").agg(F.min("doc").alias("component_id"))
    of_node = whole.join(least, "root").select("node", "component_id")
    joined = marked.select("doc_id", "node", "size").join(of_node, "node", "left")
    component = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


#: The same by a join of all shingles and a recursive search, for small tables.
NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT k, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) <= 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s FROM w),
node AS (SELECT s, min(doc_id) AS doc, min(k) AS node, len(s) AS size FROM s WHERE len(s) > 0 GROUP BY s),
flat AS (SELECT node, size, unnest(s) AS shingle FROM node),
pair AS (SELECT a.node AS a, b.node AS b FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.node <> b.node GROUP BY a.node, b.node, a.size, b.size HAVING 100 * count(*) >= 85 * (a.size + b.size - count(*))),
reach AS (SELECT node AS a, node AS b FROM node UNION SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a),
comp AS (SELECT reach.a AS node, min(node.doc) AS component_id FROM reach JOIN node ON reach.b = node.node GROUP BY reach.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE comp.component_id END AS component_id, s.doc_id IS NOT DISTINCT FROM CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE comp.component_id END AS kept
FROM s LEFT JOIN node ON s.s = node.s LEFT JOIN comp ON node.node = comp.node
"""
