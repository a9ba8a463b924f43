"""Operator 12: spelling variants by a relational trie frontier.

The vocabulary's trie is a table of edges (node, letter, child), one of the words and one of the words
reversed. A frontier of states (word, position, node, edits) is joined with the edges of one depth after
another. Words walk down their own path without edits; at each node a letter may be inserted, or another
one taken instead of the word's own, which makes a state with one edit that follows exact letters from
there. Where a state with one edit ends at a word, the two are near. Deletions are insertions as
the other word sees them.

Of two near words the part before the edit or the part after it is at least half of the shorter one, so words walk
their first half without edits in either trie: branches begin deep, where nodes have few children, and
never at the root. An edge to a child below which there is one word alone carries that word, so what is left of it
is compared at once; the levels end with the longest beginning that two words share.

Defined results: a null or empty text has no words, a null doc_id reads as an empty text in the
hash; repeated rows count each; words without near ones have no form and are their own root; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stored
from terrace.llm.tokens import text_blocks

#: A run loses a letter where this divides its hash; letters and occurrences of a word; times that a form is oftener.
LOSES, LETTERS, LEAST, OFTENER = 199, 6, 5, 5
#: Levels of the trie that one job walks; bytes of text whose words are counted at a time.
LEVELS, BLOCK_BYTES = 4, 4 << 20

# ASCII letters and U+00C0 to U+00FF make runs, only A-Z are lowered; whatever Latin-1 lacks is a question mark, so a blank
_RUN_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))


def runs(text: str) -> list[bytes]:
    """The lower-cased runs of a text in Latin-1, where each code point is a byte."""
    return text.encode("latin-1", "replace").translate(_RUN_BYTES).split()


def spelt(run: bytes, start: int) -> bytes:
    """A run as it is counted; ``start`` is the checksum of what its hash begins with."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    return run if h % LOSES else run[: (k := h % len(run))] + run[k + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n of all words of enough letters and occurrences."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for b in batches for x in text_blocks(b, "text", BLOCK_BYTES)):
            found: Counter[bytes] = Counter()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(r for r in runs(text) if len(r) >= LETTERS).items():
                    found[spelt(run, start)] += n
            words = [w for w in found if len(w) >= LETTERS]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array([found[w] for w in words], pa.int64())], ["word", "n"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def both_ways(words: DataFrame) -> DataFrame:
    """way and word, spelt from its beginning (way 0) and from its end (1)."""
    return words.select(F.explode(F.array(F.struct(F.lit(0).alias("way"), "word"), F.struct(F.lit(1).alias("way"), F.reverse("word").alias("word")))).alias("w")).select("w.*")


def edges(words: DataFrame) -> DataFrame:
    """The tries of ``words`` (way, word): depth, way, node, letter, child, ends, only.

    A node is the spelling that leads to it; ``ends``: the child is a word; ``only``: the word below the
    child if there is just one. Below such a child there are no more edges.
    """
    prefix = lambda n: F.substring("word", 1, n)
    steps = words.select("way", "word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("depth"))
    nodes = steps.groupBy("way", "depth", prefix(F.col("depth")).alias("child")).agg(F.count("*").alias("below"), F.min("word").alias("least"))
    nodes = stored(nodes.withColumn("node", F.expr("substring(child, 1, depth - 1)")), "nodes")
    branching = nodes.where("below > 1").select("way", F.col("child").alias("node")).union(words.select("way", F.lit("").alias("node")).distinct())
    made = nodes.join(branching, ["way", "node"]).select(
        (F.col("depth") - 1).alias("depth"), "way", "node", F.expr("substring(child, depth, 1)").alias("letter"), "child", (F.col("least") == F.col("child")).alias("ends"), F.when(F.col("below") == 1, F.col("least")).alias("only")
    )  # the least word below a node is the node itself where that is a word
    return stored(made.sortWithinPartitions("depth"), "edges")


def _letter(word: Column, at: Column) -> Column:
    """The letter of ``word`` at ``at``, counted from 0; '' at its end."""
    return F.substring(word, at + 1, F.lit(1))


def _level(frontier: DataFrame, words: DataFrame, trie: DataFrame, depth: int) -> DataFrame:
    """The frontier at the next depth.

    ``frontier``: way, word, position, node, found; states have one edit and no word found yet, and what has found
    one stays as it is. Words without edits are at their own node.
    """
    here = trie.where(F.col("depth") == depth).select("way", "node", "letter", "child", "ends", "only")
    to = here.toDF("_way", "_node", "_letter", "child", "ends", "only")
    open_ = F.col("found").isNull()
    asked = F.when(open_, _letter(F.col("word"), F.col("position")))  # no edge has a null letter
    walked = frontier.withColumn("asked", asked).join(to, (F.col("way") == F.col("_way")) & (F.col("node") == F.col("_node")) & (F.col("asked") == F.col("_letter")), "left").where(~open_ | F.col("child").isNotNull())
    walked = walked.select("way", "word", F.when(open_, F.col("position") + 1).alias("position"), "child", "ends", "only", "found")

    whole = words.where((F.floor(F.length("word") / 2) <= depth) & (F.length("word") >= depth)).select("way", "word", F.lit(depth).alias("position"), F.substring("word", 1, depth).alias("node"))
    own = _letter(F.col("word"), F.col("position"))
    inserted, replaced = F.col("position"), F.when((own != "") & (F.col("letter") > own), F.col("position") + 1)
    edited = whole.join(here, ["way", "node"]).where(F.col("letter") != own).withColumn("position", F.explode(F.array_compact(F.array(inserted, replaced))))

    reached = walked.union(edited.select("way", "word", "position", "child", "ends", "only", F.lit(None).cast("string").alias("found")))
    rest = F.expr("substring(word, position + 1)")
    near = F.when(F.col("only").isNotNull(), F.expr("substring(only, length(child) + 1)") == rest).otherwise(F.col("ends") & (rest == ""))
    reached = reached.withColumn("found", F.coalesce("found", F.when(near, F.coalesce("only", "child"))))
    # what has found its word is dealt by that word from now on
    return reached.where("found IS NOT NULL OR only IS NULL").select("way", "word", "position", F.coalesce("found", "child").alias("node"), "found")


def near_words(words: DataFrame) -> DataFrame:
    """word and near, both ways round, of all that differ by one inserted, deleted or replaced letter."""
    words = stored(both_ways(words), "words")
    trie = edges(words)
    deepest = trie.agg(F.max("depth").alias("depth")).first()["depth"]
    spark = words.sparkSession
    frontier = spark.createDataFrame([], "way int, word string, position int, node string, found string")
    pairs = frontier.select("way", "word", "found")
    for first in range(0, -1 if deepest is None else deepest + 1, LEVELS):
        for depth in range(first, min(first + LEVELS, deepest + 1)):
            frontier = _level(frontier, words, trie, depth)
        walked = stored(frontier, "frontier")
        pairs = pairs.union(walked.where("found IS NOT NULL").select("way", "word", "found"))
        frontier = walked.where("found IS NULL")
    forwards = lambda c: F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c))
    pairs = pairs.select(forwards("word").alias("a"), forwards("found").alias("b"))
    return pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("p")).select("p.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word and root of the words of ``forms`` (word, form) by pointer doubling.

    A form is OFTENER times as frequent, so chains are short; each round halves them.
    """
    rooted = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = rooted.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        further = stored(rooted.join(up, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        rooted = further.drop("moved")
        if not further.where("moved").limit(1).count():
            return rooted


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = stored(word_counts(docs), "counts")
    near = stored(near_words(words.select("word")), "near")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("near").alias("word"))).alias("best")
    of_word = near.join(words.withColumnRenamed("word", "near"), "near").groupBy("word").agg(F.count("*").alias("n_near"), best)
    taken = -F.col("best.n") >= OFTENER * F.col("n")
    formed = words.join(of_word, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("best.word")).alias("form"), F.when(taken, -F.col("best.n")).alias("form_n"))
    formed = stored(formed, "forms")
    rooted = roots(formed.where("form IS NOT NULL"))
    return formed.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
