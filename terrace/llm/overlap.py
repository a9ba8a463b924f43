"""Operator 1 as the pipeline's stage: near-duplicates at five words and a Jaccard similarity of 0.8.

Texts that similar differ in 8 of 64 SimHash bits in the middle and in up to 16, beyond what block keys can
guarantee. So the stage takes two steps, and decides every link by the exact similarity of the
sets of shingles:

1. The Gray-order index of ``simhash`` over five-word fingerprints finds the links of at most three bits. In a
   large group of copies each text has many neighbours that near, so a spanning forest of these links
   joins most of the group.
2. The links beyond are found by shingles, between different components alone. In any common order of all shingles the
   first n - ceil(0.8 n) + 1 of a text's n hold one that a similar text has among its own first ones. The order
   is that of hashes, with the shingles that are frequent in a sample last, which changes the number of
   candidates but not what is found. A text meets those with the nearest fingerprints first; whatever
   components are still apart then are compared whole. Parity bits, one to two a shingle, rule out most
   pairs before sets are sent: sets differ in no fewer shingles than their bits.

Equal sets are one node, so copies cost nothing.

Defined results: as for operator 1, a null or empty text is linked like any other (to those without
words), and rows that share a doc_id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import anti_join, fresh, passing, release, semi_join, slices, stored
from terrace.llm.components import components
from terrace.llm.simhash import link_forest, majority
from terrace.llm.tokens import text_blocks

SHINGLE, SEED, DISTANCE = 5, 42, 3
#: Least similarity, as a fraction of whole numbers.
NEAR, OF = 4, 5
#: Documents that frequent shingles are counted in, documents of these that make one frequent, and shingles at most.
SAMPLE_ROWS, FREQUENT, MOST = 10_000, 3, 200_000
#: Texts of one key that are compared in one task; a key of more is split into cells. Comparisons held at a time.
PART, HELD = 2048, 1 << 18
#: Bytes of text whose shingles are made at a time.
BLOCK_BYTES = 1 << 20
#: How texts meet by their keys, pass by pass (see ``candidates``); what passes before have joined isn't compared again.
MEETINGS = ("one", "all")
#: Texts of a key up to which their pairs are given out; those of more are compared in place.
SMALL = 16
_ODD = tuple(np.uint64(x | 1) for x in (0x9E3779B97F4A7C14, 0xBF58476D1CE4E5B8, 0x94D049BB133111EA))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _ODD[1]
    h = (h ^ (h >> np.uint64(27))) * _ODD[2]
    return h ^ (h >> np.uint64(31))


def shingles(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The hashes of each text's word shingles, in order and with repeats; of the whole sequence where it is shorter.

    Words end at ASCII white space and A-Z are lowered. A shingle's hash is mixed from the XXH64 of its words.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    of_word = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    number = np.asarray(coded.indices)
    real = np.fromiter((len(w) > 0 for w in words), bool, len(words))[number]
    upto = np.concatenate([[0], np.cumsum(real)])
    begin = upto[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
    h = of_word[number[real]]
    every = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        every = _mixed(every + h[k : k + len(every)] + _ODD[0])
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(every[a : b - size + 1])
        else:
            out.append(np.array([xxhash.xxh64_intdigest(h[a:b].tobytes(), SEED)] if b > a else [], np.uint64))
    return out


def node_of(found: np.ndarray) -> int:
    """The number of a set of shingles, signed."""
    return xxhash.xxh64_intdigest(found.tobytes(), SEED) - (1 << 63)


def prefix(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first shingles of a set, one of which any similar set has among its own."""
    if not len(found):
        return found
    if len(frequent):
        late = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found
        found = np.concatenate([found[~late], found[late]])
    return found[: len(found) - -(-NEAR * len(found) // OF) + 1]


def parities(found: np.ndarray) -> np.ndarray:
    """A set's parity bits, one to two for each shingle: whether an odd number of shingles falls to a bit.

    Sets differ in as many shingles at least as their bits do, also when bits are folded, so bits alone rule pairs out.
    """
    width = max(64, 1 << max(0, len(found) - 1).bit_length())
    odd = np.bincount((found % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The parity bits that the set has in so many words of 64, as many as ``bits`` has or fewer."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def most_apart(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """How many shingles may be in one of two similar sets alone."""
    return size_a + size_b - 2 * -(-NEAR * (size_a + size_b) // (NEAR + OF))


def near_by_bits(bits: list[np.ndarray], a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the parity bits of sets number a and b let them be similar."""
    words = np.array([len(x) for x in bits])
    of_pair, allowed = np.minimum(words[a], words[b]), most_apart(size[a], size[b])
    near = np.zeros(len(a), bool)
    for n in np.unique(of_pair).tolist():
        mine = np.flatnonzero(of_pair == n)
        held = np.union1d(a[mine], b[mine])
        table = np.stack([folded(bits[k], n) for k in held.tolist()])
        for at in range(0, len(mine), max(1, HELD // n)):
            some = mine[at : at + max(1, HELD // n)]
            x, y = table[np.searchsorted(held, a[some])], table[np.searchsorted(held, b[some])]
            near[some] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= allowed[some]
    return near


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= NEAR * (len(a) + len(b) - both)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles of many documents of a bounded sample, ascending."""
    step = -(-max(1, docs.count()) // SAMPLE_ROWS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for b in batches for x in text_blocks(b, "text", BLOCK_BYTES)):
            found = np.concatenate([np.zeros(0, np.uint64), *map(np.unique, shingles(batch.column(1)))])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["key"])

    sample = _texts(docs).where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    counted = sample.mapInArrow(rows, "key long").groupBy("key").count().where(F.col("count") >= FREQUENT)
    kept = counted.orderBy(F.desc("count"), "key").limit(MOST).collect()
    return np.sort(np.array([r["key"] for r in kept], np.int64).view(np.uint64))


def marks(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """doc_id, node, fingerprint, size, parity bits and keys of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        for batch in (x for b in batches for x in text_blocks(b, "text", BLOCK_BYTES)):
            out: list[tuple] = []
            for h in shingles(batch.column(1)):
                found = np.unique(h)
                out.append((node_of(found), majority(h) if len(h) else 0, len(found), parities(found).tobytes(), prefix(found, frequent).view(np.int64)))
            node, fp, size, bits, keys = zip(*out, strict=True) if out else ((), (), (), (), ())
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (node, fp, size)), pa.array(bits, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "fp", "size", "bits", "keys"])

    return _texts(docs).mapInArrow(rows, "doc_id long, node long, fp long, size long, bits binary, keys array<long>")


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(where runs begin and the last ends, columns) of sorted rows; runs agree in the first ``keys`` columns and aren't torn."""
    held: list[list[np.ndarray]] = []
    for columns in ([c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches if batch.num_rows):
        last = held[-1] if held else columns
        if held and all(h[-1] == c[-1] for h, c in zip(last[:keys], columns, strict=False)):
            held.append(columns)  # of one run
            continue
        columns = [np.concatenate(x) for x in zip(*held, columns, strict=True)]
        n = len(columns[0])
        new = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:keys]])]
        starts = np.flatnonzero(new)
        if len(starts) > 1:
            yield starts, [c[: starts[-1]] for c in columns]
        held = [[c[starts[-1] : n].copy() for c in columns]]
    if held:
        columns = [np.concatenate(x) for x in zip(*held, strict=True)]
        yield np.array([0, len(columns[0])]), columns


def shared_keys(marked: DataFrame, nodes: DataFrame) -> DataFrame:
    """key, node and leads wherever a key is held by several nodes.

    A key ``leads`` a node if it is among the first ones, one of which any similar set of no smaller size has
    among its own keys; so of two texts the smaller's key must lead.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # the row before, and whether it was given out
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, leads = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if last is not None:
                key, node, leads = np.r_[last[0], key], np.r_[last[1], node], np.r_[last[2], leads]
            fresh = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
            given = last is not None and last[3]
            key, node, leads = key[fresh], node[fresh], leads[fresh]
            with_next = np.r_[key[1:] == key[:-1], False]
            out = with_next | np.r_[False, with_next[:-1]]
            last = (key[-1], node[-1], leads[-1], bool(out[-1]) or given and len(key) == 1)
            if given:
                out[0] = False
            yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(node[out]), pa.array(leads[out])], ["key", "node", "leads"])

    first = nodes.select("doc")
    leading = F.col("size") - F.ceil(F.col("size") * (2 * NEAR) / (NEAR + OF)) + 1
    keyed = semi_join(marked.select("doc_id", "node", "size", "keys"), first).select("node", leading.alias("leading"), F.posexplode("keys").alias("at", "key"))
    keyed = keyed.select("key", "node", (F.col("at") < F.col("leading")).alias("leads"))
    return keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(rows, "key long, node long, leads boolean")


def candidates(shared: DataFrame, meets: str) -> DataFrame:
    """Pairs (a, b) of nodes of different components that share a key and may be similar by their sizes.

    ``shared``: key, parts, node, leads, fp, size, root. A text ``meets`` by each of its keys the text of "one" other component
    whose fingerprint is nearest, or "all" of other components.
    """
    whole = meets == "all"
    own, other = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    celled = shared.withColumn("own", own).withColumn("other", other)
    cell = (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).cast("long").alias("cell")
    laid = celled.select("key", cell, "node", F.col("leads").cast("int").alias("leads"), "fp", "size", "root").repartition("key", "cell").sortWithinPartitions("key", "cell", "root", "node")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, (_, _, node, leads, fp, size, root) in whole_runs(batches, 2):
            n = np.diff(starts)
            begin, count = np.repeat(starts[:-1], n), np.repeat(n, n)
            upto = np.concatenate([[0], np.cumsum(count)])
            at = 0
            while at < len(node):
                to = max(at + 1, int(np.searchsorted(upto, upto[at] + HELD, side="right")) - 1)
                a = np.repeat(np.arange(at, to), count[at:to])
                b = np.arange(len(a)) - np.repeat(upto[at:to] - upto[at], count[at:to]) + np.repeat(begin[at:to], count[at:to])
                fit = (root[a] < root[b] if whole else root[a] != root[b]) & (OF * np.minimum(size[a], size[b]) >= NEAR * np.maximum(size[a], size[b]))
                fit &= np.where((size[a] < size[b]) | (size[a] == size[b]) & (node[a] < node[b]), leads[a], leads[b]) > 0
                a, b = a[fit], b[fit]
                if len(a) and not whole:
                    edges = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True])
                    far = np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)).astype(np.int64) << 32 | b
                    kept = far == np.repeat(np.minimum.reduceat(far, edges[:-1]), np.diff(edges))
                    a, b = a[kept], b[kept]
                if len(a):
                    two = np.unique(np.column_stack([np.minimum(node[a], node[b]), np.maximum(node[a], node[b])]), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1])], ["a", "b"])
                at = to
        release()

    return laid.mapInArrow(rows, "a long, b long").distinct()


def crowded_candidates(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """As ``candidates`` for all, of keys of very many texts: pairs that their parity bits let be similar.

    ``rows``: as there; ``firsts``: node, bits. Of a key's texts, those outside the commonest component are compared with all.
    """
    own, other = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    wide = rows.join(firsts, "node").withColumn("own", own).withColumn("other", other)
    cell = (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).cast("long").alias("cell")
    laid = wide.select("key", cell, "own", "node", F.col("leads").cast("int").alias("leads"), "size", "root", "bits").repartition("key", "cell").sortWithinPartitions("key", "cell", "root", "node")

    def compared(own: np.ndarray, node: np.ndarray, leads: np.ndarray, size: np.ndarray, root: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        values, counts = np.unique(root, return_counts=True)
        asks = np.flatnonzero(root != values[counts.argmax()])
        asking = np.isin(np.arange(len(node)), asks)
        bits = [np.frombuffer(x, np.uint64) for x in bits]
        for at in range(0, len(asks), max(1, HELD // len(node))):
            block = asks[at : at + max(1, HELD // len(node)), None]
            smaller = (size[block] < size) | (size[block] == size) & (node[block] < node)  # the asking one
            fit = np.where(smaller, leads[block], leads) > 0
            fit &= (root[block] != root) & (OF * np.minimum(size[block], size) >= NEAR * np.maximum(size[block], size))
            if own.min() != own.max():
                fit &= own[block] != own
            fit &= ~asking | (block < np.arange(len(node)))  # two that ask meet once
            a, b = np.nonzero(fit)
            a = block[a, 0]
            near = near_by_bits(bits, a, b, size)
            yield node[a[near]], node[b[near]]

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, (_, _, own, node, leads, size, root, bits) in whole_runs(batches, 2):
            for x, y in zip(starts[:-1], starts[1:], strict=True):
                if root[x] != root[y - 1]:
                    for a, b in compared(*(c[x:y] for c in (own, node, leads, size, root, bits))):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
        release()

    return laid.mapInArrow(pairs_of, "a long, b long")


def _with_both(pairs: DataFrame, of_node: DataFrame) -> DataFrame:
    """The pairs with the columns of ``of_node`` for a and for b."""
    for side in ("a", "b"):
        pairs = pairs.join(of_node.toDF(*(f"{c}_{side}" for c in of_node.columns)).withColumnRenamed(f"node_{side}", side), side)
    return pairs


def verified(pairs: DataFrame, marked: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b; distinct and stored) whose sets of shingles are similar, stored.

    Parity bits rule most others out, so that few whole sets are sent.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        for batch in (x for b in batches for x in text_blocks(b, "text", BLOCK_BYTES)):
            sets = [np.unique(h) for h in shingles(batch.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, sets), pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "found"])

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            of = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            bits = [np.frombuffer(x, np.uint64) for side in ("bits_a", "bits_b") for x in of[side].to_pylist()]
            size, at = np.r_[of["size_a"].to_numpy(), of["size_b"].to_numpy()], np.arange(batch.num_rows)
            yield batch.select(["a", "b"]).filter(pa.array(near_by_bits(bits, at, at + batch.num_rows, size)))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(k).to_pylist()] for k in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array([similar(x, y) for x, y in zip(a, b, strict=True)], pa.bool_()))
        release()

    def asked(of: DataFrame) -> DataFrame:
        return of.select(F.explode(F.array("a", "b")).alias("node"))

    with passing(docs.sparkSession) as keep:
        first = stored(semi_join(marked.select("node", "size", "bits"), asked(pairs), "node").dropDuplicates(["node"]), "first")
        pairs = stored(_with_both(pairs, first).mapInArrow(possible, "a long, b long"), "possible")
        of = stored(nodes.join(asked(pairs).distinct(), "node").select("node", F.col("doc").alias("doc_id")), "asked")
        # rows that share a doc_id can have other texts
        made = semi_join(_texts(docs), of.select("doc_id")).mapInArrow(rows, "node long, found binary")
        sets = stored(semi_join(made, of.select("node"), "node").dropDuplicates(["node"]), "sets")
        both = _with_both(pairs, sets).select("a", "b", "found_a", "found_b")
        return keep(stored(both.mapInArrow(decide, "a long, b long"), "links"))


def placed(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    return nodes.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").withColumn("root", F.coalesce("root", "node")).drop("_node")


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs of nodes that connect those whose fingerprints the Gray-order index links."""
    prints = stored(nodes.groupBy("fp").agg(F.min("node").alias("least")), "prints")
    equal = nodes.join(prints, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    apart = link_forest(prints, DISTANCE, True)
    apart = apart.join(prints.toDF("a", "_a"), "a").join(prints.toDF("b", "_b"), "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
    return equal.union(apart).distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, component_id (smallest doc_id that chains of similar texts reach) of every document, stored."""
    spark = docs.sparkSession
    with passing(spark) as keep:
        marked = stored(marks(docs, frequent_shingles(docs)), "marks")
        nodes = stored(marked.groupBy("node").agg(F.min("doc_id").alias("doc"), F.first("fp").alias("fp"), F.first("size").alias("size")), "nodes")

        tested = stored(simhash_pairs(nodes), "pairs")
        links = verified(tested, marked, nodes, docs)
        shared = stored(shared_keys(marked, nodes), "shared")
        counts = shared.groupBy("key").count().where(F.col("count") > SMALL)
        crowd = stored(counts.select("key", F.ceil(F.col("count") / PART).cast("int").alias("parts")), "crowd")
        shared = shared.join(crowd, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        crowd = crowd.select("key")
        roots = components(links)
        for meets in MEETINGS:
            with passing(spark) as pass_on:
                rows = shared.join(placed(nodes.drop("doc"), roots), "node")
                if meets == "one":
                    found = candidates(rows, meets)
                else:
                    crowded_rows = stored(semi_join(rows, crowd, "key"), "crowded")
                    firsts = semi_join(marked.select("node", "bits"), crowded_rows.select("node"), "node").dropDuplicates(["node"])
                    found = candidates(anti_join(rows, crowd, "key"), meets).union(crowded_candidates(crowded_rows, firsts)).distinct()
                pairs = pass_on(stored(found.join(tested, ["a", "b"], "left_anti"), "pairs"))
            tested = tested.union(pairs)
            links = links.union(verified(pairs, marked, nodes, docs))
            roots = components(links)

        whole = placed(nodes.select("node", "doc"), roots)
        least = whole.groupBy("root").agg(F.min("doc").alias("component_id"))
        copies = marked.select("doc_id", "node").join(whole.join(least, "root").select("node", "component_id"), "node").select("doc_id", "component_id")
        return keep(stored(copies, "copies"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that another one of their component, with a smaller doc_id, stands for."""
    of_doc = near_copies(docs).groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays"))
    return anti_join(docs, of_doc.where("not stays").select("doc_id"))
