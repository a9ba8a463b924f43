"""A field at any depth: arrays, objects in the field's own value, texts that don't parse."""

import json

from terrace.operators import nested


def brute(value, field, depth=1):
    pairs = value.items() if isinstance(value, dict) else [(None, v) for v in value] if isinstance(value, list) else []
    for key, inner in pairs:
        if key == field:
            yield depth, json.dumps(inner, separators=(",", ":"))
        yield from brute(inner, field, depth + 1)


def test_any_depth(spark):
    deep = {"iso": 0}
    for k in range(20):
        deep = [{"a": deep, "iso": {"iso": k}}]
    values = [deep, {"iso": None}, {"iso": [1, {"iso": "x"}]}, {"iso.x": 1, "ISO": 2}, [], {}, 5, "iso", None, [[[{"iso": True}]]]]
    texts = [(k, json.dumps(v)) for k, v in enumerate(values)] + [(90, "{broken"), (91, None), (92, "")]
    df = spark.createDataFrame(texts, "k int, j string")
    found = sorted((r["k"], r["depth"], r["value"]) for r in nested.find_field(df, "j", "iso", ["k"]).collect())
    expected = sorted((k, *x) for k, v in enumerate(values) for x in brute(v, "iso"))
    assert found == expected and max(d for _, d, _ in found) > 30
    cut = sorted((r["k"], r["depth"], r["value"]) for r in nested.find_field(df, "j", "iso", ["k"], 3).collect())
    assert cut == [x for x in expected if x[1] <= 3]


def test_texts_are_read_once(spark, tmp_path):
    spark.createDataFrame([(1, '{"a":{"iso":1}}')], "k int, j string").write.parquet(f"{tmp_path}/t")
    found = nested.find_field(spark.read.parquet(f"{tmp_path}/t"), "j", "iso", ["k"])
    assert not any(str(tmp_path / "t") in f for f in found.inputFiles()) and found.count() == 1


def test_texts_of_a_small_file_are_dealt_out(spark, monkeypatch):
    plans, real = [], nested.stored
    monkeypatch.setattr(nested, "stored", lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, label))
    assert nested.find_field(spark.createDataFrame([(1, '{"a":{"iso":1}}')], "k int, j string"), "j", "iso", ["k"]).count() == 1
    assert "RepartitionByExpression" in plans[0]
