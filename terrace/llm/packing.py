"""Operator 7: best-fit packing of token pieces into sequences under vector capacities.

A sequence holds at most so many tokens, so many pieces, and so much attention cost (the sum of
squared piece lengths). What a piece demands follows from its length alone, so the search runs on
the histogram of lengths, whose size is bounded by the token capacity and not by the corpus:
lengths in descending order, each to the open bins where it fits best, by smallest norm of the
weighted residual or by largest weighted dot-product of demand and residual, else to new bins.
Bins with one history form a class and are handled together. The result is a small plan, from which
each piece finds its sequence and offset by its number among the pieces of its length.

Defined results: a null text is an empty one, whose only token is the end id; repeated rows are
packed each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import fresh, stored
from terrace.llm.tokens import encoder, text_blocks

#: Bytes of text that are encoded at a time.
BLOCK_BYTES = 2 << 20


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence, and how the best bin is chosen.

    The default piece and attention limits follow from the token limit, so they cost no sequence; by
    their weights they decide between bins of like room.
    """

    tokens: int = 2048
    pieces: int = 2048
    attention: int = 2048**2
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
    rule: str = "norm"  # or "dot"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.pieces, self.attention], dtype=np.int64)


def demand(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], dtype=np.int64)


def plan(histogram: dict[int, int], capacity: Capacity) -> list[tuple[int, int, int, int, int]]:
    """(length, from, to, first sequence, offset): pieces number from..to-1 of that length go each to
    the sequence as many after the first, at that offset."""
    limits, weights = capacity.limits(), np.array(capacity.weights)
    residual, bins = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
    history: list[tuple[int, int, int]] = []  # of each class: class it came from, length, copies

    def add(came_from: int, left: np.ndarray, n: int, length: int, copies: int) -> None:
        nonlocal residual, bins
        residual, bins = np.vstack([residual, left]), np.append(bins, n)
        history.append((came_from, length, copies))

    for length in sorted(histogram, reverse=True):
        need, left = demand(length), histogram[length]
        if (need > limits).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity")
        while left:
            fits = np.flatnonzero((bins > 0) & (residual >= need).all(axis=1))
            if len(fits):
                scaled, asked = residual[fits] / limits, need / limits
                score = (((scaled - asked) * weights) ** 2).sum(axis=1) if capacity.rule == "norm" else -(scaled * asked * weights).sum(axis=1)
                at = int(fits[np.argmin(score)])
                room, open_bins = residual[at], int(bins[at])
            else:
                at, room, open_bins = -1, limits, left
            # by the norm, a bin that got one is the best for the next; by the dot-product the others of its class are
            copies = int((room // need).min()) if capacity.rule == "norm" or at < 0 else 1
            full, rest = divmod(left, copies)
            if full >= open_bins:
                full, rest = open_bins, 0
            if full:
                add(at, room - copies * need, full, length, copies)
            if rest:
                add(at, room - rest * need, 1, length, rest)
            if at >= 0:
                bins[at] -= full + bool(rest)
            left -= full * copies + rest

    out, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for c in np.flatnonzero(bins):
        n, offset, at = int(bins[c]), 0, int(c)
        while at >= 0:
            at, length, copies = history[at]
            for _ in range(copies):
                out.append((length, taken[length], taken[length] + n, sequence, offset))
                taken[length] += n
                offset += length
        sequence += n
    return out


def token_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' token ids with the end id, cut at ``size`` tokens: id, piece, start, length, ids_crc32, part.

    ``part`` is the task that made a row: pieces of one length are numbered part by part.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        encode = encoder(tokenizer)
        for batch in (x for b in batches for x in text_blocks(b, text_col, BLOCK_BYTES)):
            ids, begin = encode(batch.column(1))
            whole = np.insert(ids, begin[1:], end_id).astype("<u4")
            begin = begin + np.arange(len(begin))
            counts = -(-np.diff(begin) // size)  # each document has one id at least
            owner = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            first = begin[owner] + piece * size
            last = np.minimum(first + size, begin[owner + 1])
            view = memoryview(whole).cast("B") if len(whole) else memoryview(b"")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(piece * size, pa.int64()), pa.array(last - first, pa.int64()), pa.array(crc, pa.int64())],
                [id_col, "piece", "start", "length", "ids_crc32"],
            )

    cut = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(rows, f"{id_col} long, piece int, start long, length long, ids_crc32 long")
    return cut.withColumn("part", F.spark_partition_id())


def pack(pieces: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """``pieces`` (with length and part; already stored) with sequence_id and offset, without part.

    The driver gets one row for each length that occurs, and sends the plan, which is no larger. Rows are dealt by
    the task that made them: numbers within a length are local to its rows plus the counts of the tasks before, which
    come first in the stream, so no length gathers in one place.
    """
    by_part = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    kept = [f for f in pieces.schema.fields if f.name != "part"]
    names = [f.name for f in kept]
    at_length = names.index("length")
    before = by_part.select("part", F.lit(0).alias("_kind"), F.coalesce(earlier, F.lit(0)).alias("_before"), *((F.col(f.name) if f.name == "length" else F.lit(None).cast(f.dataType)).alias(f.name) for f in kept))
    rows = before.union(pieces.select("part", F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_before"), *names))
    rows = rows.repartition("part").sortWithinPartitions("part", "_kind", *names)

    steps = np.array(sorted((length, start, first, offset) for length, start, _, first, offset in plan(histogram, capacity)), np.int64).reshape(-1, 4)
    starts = steps[:, 0] * (1 << 44) + steps[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = None, np.zeros(capacity.tokens + 1, np.int64)  # of the next piece of each length
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, kinds, lengths = np.asarray(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(3 + at_length))
            edges = np.flatnonzero(np.r_[True, (parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1]), True])
            for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if parts[start] != part:
                    part = parts[start]
                    number[:] = 0
                own = lengths[start:stop]
                if kinds[start] == 0:
                    number[own] = batch.column(2).slice(start, stop - start).to_numpy()
                    continue
                order = np.argsort(own, kind="stable")
                same = own[order]
                first = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
                many = np.diff(np.r_[first, len(same)])
                local = np.empty(len(own), np.int64)
                local[order] = np.arange(len(own)) - np.repeat(first, many)
                mine = number[own] + local
                number[same[first]] += many
                step = np.searchsorted(starts, own * (1 << 44) + mine, side="right") - 1
                sequence = steps[step, 2] + mine - steps[step, 1]
                piece = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*piece.columns[3:], pa.array(sequence), pa.array(steps[step, 3])], [*names, "sequence_id", "offset"])

    return rows.mapInArrow(place, T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity()) -> DataFrame:
    """Cuts and packs documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stored(token_pieces(docs, tokenizer, capacity.tokens), "pieces"), capacity)
