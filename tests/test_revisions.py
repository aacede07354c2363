"""Registered queries over revisions: both versions of an order in one pass, with the revisions that each version has alone."""

import os

import pytest
from pyspark.sql import functions as F

from lexspark.functions.canonical import canonical_text
from lexspark.operators import release
from lexspark.plans import revisions

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def test_both_versions_have_the_revisions_of_each(spark):
    d = revisions.both_revisions(spark, SF)
    for name, day in (("then", revisions.DAY), ("now", None)):
        want = {(r.release_id, r.concept_id, r.revision) for r in revisions.leaves(revisions.entries(spark, SF, day)).collect()}
        assert {(r.release_id, r.concept_id, r[name]) for r in d.collect()} == want


@pytest.mark.parametrize("name", ["release_manifests", "changed_nodes"])
def test_line_items_are_read_once(spark, monkeypatch, name):
    reads, read = [], revisions.read
    monkeypatch.setattr(revisions, "read", lambda s, at, table: reads.append(table) or read(s, at, table))
    getattr(revisions, name)(spark, SF)
    assert reads.count("lineitem") == 1


def test_scalars_are_as_json_has_them(spark):
    texts = ["", "plain", 'a"b', "a\\b", "a/b", "\t", "a\n", "é", "\x7f", "[]{}", None]
    d = spark.createDataFrame([(t, k, k % 2 == 0) for k, t in enumerate(texts)], "t string, k long, b boolean")
    json = lambda c: F.substr(F.to_json(F.array(c)), F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    for f in d.schema.fields:
        c = F.col(f.name)
        assert d.filter(~canonical_text(c, f.dataType).eqNullSafe(F.when(c.isNotNull(), json(c)))).count() == 0


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_the_root_of_a_small_tree_is_made_in_one_row(spark, depth):
    rows = [("a", str(k % 40), "r" if k % 3 else None) for k in range(60)] + [("b", None, "x"), ("b", "", "y"), ("b", "q", "")]
    d = spark.createDataFrame(rows, "release_id string, key string, revision string")
    counted = d.groupBy("release_id", "key", "revision").agg(F.count("*").alias("n")).groupBy("release_id").agg(F.collect_list(release.leaf_item(F.col("key"), F.col("revision"), F.col("n"))).alias("items"))
    want = {tuple(r) for r in release.root(release.revision_tree(d, by=["release_id"], depth=depth), ["release_id"]).collect()}
    assert {tuple(r) for r in counted.select("release_id", release.root_of(F.col("items"), depth)).collect()} == want
    assert spark.range(1).select(release.root_of(F.array().cast("array<string>"), depth)).first()[0] is None


def test_states_of_releases_are_made_in_a_row_each(spark, tmp_path):
    # Leaves were rows of their own, grouped by tree, node and root: eight aggregates, and an entry's tree was made three times.
    revisions.both_revisions(spark, SF).select("release_id", "concept_id", "status", *[F.unhex(c).alias(c) for c in ("then", "now")], "lines").write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")
    made = revisions.bound_states(spark, SF, orders)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 3
    for v in ("then", "now"):
        entry = orders.select("release_id", F.col("concept_id").alias("key"), F.lower(F.hex(v)).alias("revision"))
        want = {tuple(r) for r in release.root(release.revision_tree(entry, by=["release_id"], depth=1), ["release_id"]).collect()}
        assert {(r.release_id, r.registry_revision) for r in made.filter(made.version == v).collect()} == want
