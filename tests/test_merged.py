"""The table merged on read: bytes written, repeated batches, orders of batches, compaction, layout."""

import random

import pytest

from terrace.sources import merged
from terrace.sources.merged import MergedTable

SCHEMA = "k int, name string, v int, version int"


def size(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_batch_writes_its_own_bytes(spark, tmp_path):
    table = MergedTable(spark, f"{tmp_path}/t", frame(spark, []).schema, ["k"], "version")
    random.seed(1)
    table.merge(frame(spark, [(k, "".join(random.choices("abcdefgh", k=40)), k, 1) for k in range(50_000)]), 0)
    whole = size(tmp_path)
    for n in range(1, 4):
        before = size(tmp_path)
        assert table.merge(frame(spark, [(k, "changed", n, n + 1) for k in range(n, 50_000, 5000)]), n)
        assert size(tmp_path) - before < whole / 100
    assert not table.merge(frame(spark, [(1, "again", 0, 99)]), 3)  # committed before
    found = table.read()
    assert found.count() == 50_000 and found.where("name = 'changed'").count() == 30


@pytest.mark.parametrize("mode", ["update", "ignore"])
@pytest.mark.parametrize("fan", [2, 100])
def test_like_a_dictionary(spark, tmp_path, monkeypatch, mode, fan):
    monkeypatch.setattr(merged, "FAN", fan)  # with and without compaction
    monkeypatch.setattr(merged, "FILE_BYTES", 500)
    random.seed(fan)
    table = MergedTable(spark, f"{tmp_path}/t", frame(spark, []).schema, ["k", "name"], "version" if mode == "update" else None, mode)
    expected = {}
    for n in range(9):
        batch = {}
        for _ in range(20):
            k = random.choice([None, *range(12)]), random.choice([None, "a", "b"])
            batch[k] = (*k, random.randrange(1000), random.choice([None, *range(6)]))
        table.merge(frame(spark, [*batch.values()]), n)
        for k, row in batch.items():
            old = expected.get(k)
            if old is None or (mode == "update" and (-1 if row[3] is None else row[3]) >= (-1 if old[3] is None else old[3])):
                expected[k] = row
    assert rows_of(table.read()) == sorted(expected.values(), key=repr)
    assert rows_of(table.read(3, 7)) == sorted((r for r in expected.values() if r[0] is not None and 3 <= r[0] <= 7), key=repr)
    assert len(table.manifest().runs) == (9 if fan == 100 else len(table.manifest().runs))
    if fan == 2:
        assert len(table.manifest().runs) < 5 and len([*(tmp_path / "t").glob("run-*")]) < 9  # replaced runs go
    assert len([*(tmp_path / "t" / "_manifest").glob("*.json")]) == 2  # the listing doesn't grow


def test_repeated_keys_and_empty_batches(spark, tmp_path):
    table = MergedTable(spark, f"{tmp_path}/t", frame(spark, []).schema, ["k"], "version")
    assert rows_of(table.read()) == []
    table.merge(frame(spark, [(1, "x", 1, 1), (1, "y", 2, 3), (1, "z", 3, 2)]), 0, "one")
    table.merge(frame(spark, []), 1, "one")
    table.merge(frame(spark, [(2, "w", 4, 1)]), 0, "other")  # each writer counts its own batches
    assert rows_of(table.read()) == [(1, "y", 2, 3), (2, "w", 4, 1)]
    assert len(table.manifest().runs) == 2


def test_ranges_open_few_runs(spark, tmp_path):
    table = MergedTable(spark, f"{tmp_path}/t", frame(spark, []).schema, ["k"], "version")
    for n in range(5):
        table.merge(frame(spark, [(k, "x", n, 1) for k in range(100 * n, 100 * n + 100)]), n)
    found = table.read(210, 290)
    assert found.count() == 81 and len({f.rsplit("/", 2)[-2] for f in found.inputFiles()}) == 1
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,210), LessThanOrEqual(k,290)]" in found._jdf.queryExecution().toString()


def test_another_layout_is_refused(spark, tmp_path):
    shape = frame(spark, []).schema
    MergedTable(spark, f"{tmp_path}/t", shape, ["k"], "version").merge(frame(spark, [(1, "x", 1, 1)]), 0)
    for keys, version, mode in ((["name"], "version", "update"), (["k"], None, "update"), (["k"], "version", "ignore")):
        with pytest.raises(ValueError, match="was written as"):
            MergedTable(spark, f"{tmp_path}/t", shape, keys, version, mode)
    with pytest.raises(ValueError, match="unknown mode"):
        MergedTable(spark, f"{tmp_path}/t", shape, ["k"], mode="replace")
