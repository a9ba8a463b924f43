"""What the near-duplicates stage keeps on disk and sends: parity bits for first shingles, nothing past its end."""

import os
from glob import glob

import numpy as np
import pytest

from terrace.llm import overlap
from terrace.llm.common import new_path, passing, shared_dir, stored
from terrace.llm.components import components


def folder(spark):
    return shared_dir(spark).removeprefix("file:")


def there(spark):
    return set(os.listdir(folder(spark))) if os.path.isdir(folder(spark)) else set()


def test_steps_of_the_stage_go_when_it_ends(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(k % 3, 40))) for k in range(12)], "doc_id long, text string")
    before = there(spark)
    kept = overlap.keep_one(docs)
    assert {x.rsplit("-", 1)[0] for x in there(spark) - before} <= {"copies", "ids"}
    assert sorted(r["doc_id"] for r in kept.collect()) == [0]


def test_rounds_of_components_go(spark):
    before = there(spark)
    found = components(spark.createDataFrame([(k, k + 1) for k in range(20)], "a long, b long"))
    assert len(there(spark) - before) == 1
    assert {(r["node"], r["root"]) for r in found.collect()} == {(k, 0) for k in range(1, 21)}


def test_what_is_kept_passes_outward_and_errors_clear_up(spark):
    before = there(spark)
    with pytest.raises(ZeroDivisionError), passing(spark):
        with passing(spark) as keep:
            keep(stored(spark.range(3), "inner"))
            stored(spark.range(3), "gone")
        assert {x.rsplit("-", 1)[0] for x in there(spark) - before} == {"inner"}
        raise ZeroDivisionError
    assert there(spark) == before
    assert stored(spark.range(3), "lasts").count() == 3 and len(there(spark) - before) == 1
    assert new_path(spark, "other")  # a path alone makes nothing
    assert len(there(spark) - before) == 1


def test_shuffles_go_with_their_query(spark):
    def shuffles():
        return set(glob(f"{spark.conf.get('spark.local.dir')}/**/shuffle_*.data", recursive=True))

    before, was = shuffles(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    out = stored(spark.range(1000).repartition(3, "id").groupBy("id").count(), "counts")
    assert not shuffles() - before
    assert out.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == was


def test_long_texts_send_few_bytes_by_a_crowded_key(spark, monkeypatch):
    monkeypatch.setattr(overlap, "SAMPLE_ROWS", 1)
    monkeypatch.setattr(overlap, "SMALL", 2)
    sent, whole = [], overlap.crowded_candidates

    def measured(rows, firsts):
        sent.extend(sum(len(x) * (1 if isinstance(x, (bytes, bytearray)) else 8) for x in r if hasattr(x, "__len__")) for r in firsts.collect())
        return whole(rows, firsts)

    monkeypatch.setattr(overlap, "crowded_candidates", measured)
    passage = " ".join(f"p{j}" for j in range(200))
    docs = spark.createDataFrame([(k, passage + " " + " ".join(f"q{k}.{j}" for j in range(1300))) for k in range(12)], "doc_id long, text string")
    assert overlap.keep_one(docs).count() == 12
    assert sent and max(sent) <= 1500 / 4  # two bits a shingle at most; first shingles are eight bytes for one in five


def test_bits_rule_out_no_similar_pair():
    rng, rejected = np.random.default_rng(5), 0
    for n in (1, 2, 5, 19, 63, 64, 65, 130, 700, 2050):
        for less in {0, 1, n // 9, n // 5, n // 3, n}:
            for more in {0, 1, n // 9, n // 5, n // 3, n}:
                every = rng.integers(0, 1 << 64, n + more, np.uint64)
                a, b = np.unique(every[:n]), np.unique(every[less:])
                near = overlap.near_by_bits([overlap.parities(a), overlap.parities(b)], np.array([0]), np.array([1]), np.array([len(a), len(b)]))[0]
                assert near or not overlap.similar(a, b)
                rejected += not near
    assert rejected > 100
