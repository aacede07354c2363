import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm import mixing
from lexspark.llm.mixing import mix, op9_mixing, splitting_tree, targets


def test_targets_are_capped_and_reshared():
    assert targets({"a": 100, "b": 100, "c": 100}) == {"a": 200, "b": pytest.approx(50 * 250 / 150), "c": pytest.approx(100 * 250 / 150)}
    t = targets({"a": 10, "b": 1000, None: 0})
    assert t["a"] == 20 and t["b"] == pytest.approx(1495) and t[None] == 0
    assert targets({}) == {}


def test_tree_keeps_quotas():
    q = np.array([100, 3, 0, 57])
    t = splitting_tree(q, 7)
    assert (t.sum(0) == q).all() and abs(t.sum(1) - q.sum() / 7).max() <= 2 and (splitting_tree(q, 7) == t).all()


def rows(n=3000):
    return [(i, "w " * (1 + i * 37 % 90), ["a", "b", "c", None, "hot", "hot", "hot"][i % 7]) for i in range(n)]


def test_taken_words_come_near_the_targets(documents):
    got = op9_mixing(documents(rows())).collect()
    by = {}
    for (i, _, source), r in zip(rows(), sorted(got, key=lambda r: r.doc_id), strict=True):
        assert r.size == 1 + i * 37 % 90 and r.taken in (0, r.size, 2 * r.size)
        s = by.setdefault(source, [0, 0, r.target, r.source_size])
        s[0] += r.size
        s[1] += r.taken
    want = targets({k: v[0] for k, v in by.items()})
    for k, (size, taken, target, said) in by.items():
        assert size == said and target == pytest.approx(want[k]) and abs(taken - target) <= 45
    assert sorted(map(tuple, got)) == sorted(map(tuple, op9_mixing(documents(rows()).repartition(5)).collect()))


def test_mixture_holds_what_is_taken(documents):
    d = documents(rows(700))
    m = mix(d, 4)
    count = {}
    for r in m.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert m.columns == [*d.columns, "_mx_shard"] and count == {r.doc_id: r.taken // r.size for r in op9_mixing(d).collect() if r.taken}


def test_edges(documents):
    assert op9_mixing(documents([])).collect() == [] and mix(documents([])).collect() == []
    got = op9_mixing(documents([(None, None, None), (1, "", "a"), (1, "x y", "a"), (1, "x y", "a"), (2, "w " * 20_000, "b")])).collect()
    assert len(got) == 5 and all(r.taken <= 2 * r.size for r in got)
    assert {(r.doc_id, r.size) for r in got} == {(None, 0), (1, 0), (1, 2), (2, 20_000)}


def test_taken_words_are_those_of_the_mixed_rows(documents, monkeypatch):
    trees, mixed = [], mixing._mixed
    monkeypatch.setattr(mixing, "splitting_tree", lambda *a: trees.append(a) or splitting_tree(*a))
    whole = {r.doc_id: r.taken for r in op9_mixing(documents(rows(400))).collect()}
    assert trees and sum(whole.values()) > 0
    monkeypatch.setattr(mixing, "_mixed", lambda *a: mixed(*a).filter("row.doc_id % 2 = 0"))
    assert {r.doc_id: r.taken for r in op9_mixing(documents(rows(400))).collect()} == {i: n * (i % 2 == 0) for i, n in whole.items()}


def test_each_shard_holds_each_source_by_its_target(documents):
    d = documents([(i, "w " * (1 + i * 37 % 9), source) for i, _, source in rows(42_000)])
    got = {(r.source, r._mx_shard): r.words for r in mix(d, 3).withColumn("n", F.size(mixing.words_of(F.col("text")))).groupBy("source", "_mx_shard").agg(F.sum("n").alias("words")).collect()}
    want = {r.source: r.target for r in op9_mixing(d).select("doc_id", "target").join(d.select("doc_id", "source"), "doc_id").select("source", "target").distinct().collect()}
    assert len(got) == 3 * len(want) and max(abs(n / (want[s] / 3) - 1) for (s, _), n in got.items()) < 0.3
    # of a source taken 1.3 times, no shard gets both copies of its blocks much oftener than the others
    assert max(abs(got["hot", k] / (want["hot"] / 3) - 1) for k in range(3)) < 0.2


def test_columns_with_the_names_of_its_own(spark):
    names = "_mx_k _mx_source _mx_size _mx_hash _mx_shard _mx_shard_ _mx_block _ed_k _dr_k _px_hash row n count key".split()
    rows_ = [(i, "w " * (1 + i % 9), "ab"[i % 2], *[777 + i] * len(names)) for i in range(300)]
    d = spark.createDataFrame(rows_, "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in names))
    m = mix(d, 3)
    assert m.columns == [*d.columns, "_mx_shard__"]
    got = m.collect()
    assert got and all(set(r[3:-1]) == {777 + r.doc_id} and 0 <= r["_mx_shard__"] < 3 for r in got)
    count = {r.doc_id: r.taken // r.size for r in op9_mixing(d).collect() if r.taken}
    assert len(got) == sum(count.values())


def test_repeated_rows_reach_their_target(documents):
    """Source b is one document a thousand times; its rows are drawn like any other's."""
    many = [(i, "w " * 10, "ac"[i % 2]) for i in range(400)] + [(9999, "w " * 10, "b")] * 1000 + [(9998, None, "b"), (9997, "w " * 10, "c"), (9997, "w " * 10, "a")]
    d = documents(many)
    got = op9_mixing(d).collect()
    by = {}
    for r in got:
        s = by.setdefault((r.source_size, r.target), 0)
        by[r.source_size, r.target] = s + r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    want = targets({"a": 2010, "b": 10_000, "c": 2010})
    assert sorted(t for _, t in by) == pytest.approx(sorted(want.values())) or len(by) < 3
    assert all(abs(taken - n * target) <= 5 * n for (size, target), taken in by.items() for n in [2 if size == 2010 and want["a"] == want["c"] else 1])
    again = op9_mixing(d.repartition(7)).collect()
    assert sorted((r.doc_id, r.size, r.taken) for r in got) == sorted((r.doc_id, r.size, r.taken) for r in again)


def test_a_shard_is_a_partition(documents):
    d = mix(documents(rows(900)), 5)
    parts = {(r._mx_shard, r.p) for r in d.select("_mx_shard", F.spark_partition_id().alias("p")).distinct().collect()}
    assert len(parts) == 5 == len({p for _, p in parts})
