import json
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from lexspark.operators.integrate import Integration, PatchRefused, Rules, changes, integrate, patch_findings, patched, unrelated_changes
from lexspark.plans import integration
from lexspark.plans.queries import ORACLE_SQL
from lexspark.sources.versions import TableSet, VersionConflict

SCHEMA = "concept_id string, pivot string, target string, status string, extra int"
HOW = Integration({"records": Rules(evidence="status = 'P'"), "generated": Rules(), "catalog": Rules(), "quality": Rules(drift=False)})
PATCHES = "concept_id string, pivot string, old string, new string"


@pytest.fixture
def store(spark, tmp_path):
    s = TableSet(spark, f"file://{tmp_path}/set")
    rows = [("a", "A", "x", "P", 1), ("b", "B", "y", "P", 2), ("c", "C", None, "P", 3), ("a2", "A", "x", "V", 4)]
    tables = {name: spark.createDataFrame(rows, SCHEMA) for name in HOW.tables}
    tables["quality"] = tables["quality"].withColumn("target", F.lit("q"))
    assert s.version() == 0 and s.write(tables) == 1
    return s


def rows_of(store, name, version=None):
    return {r.concept_id: (r.pivot, r.target, r.status, r.extra) for r in store.read(name, version).collect()}


def test_all_tables_change_together(spark, store):
    p = spark.createDataFrame([("a", "A", "x", "x2"), ("c", "C", None, "z")], PATCHES)
    assert integrate(store, p, HOW) == 2
    for name in HOW.tables:
        now, before = rows_of(store, name), rows_of(store, name, 1)
        assert now == before | {"a": ("A", "x2", "P", 1), "c": ("C", "z", "P", 3)}
    assert {(r.table, r["rows"], r.changed) for r in changes(store.tables(1), store.tables(2), HOW).collect()} == {(t, 4, 2) for t in HOW.tables}
    assert integrate(store, p, HOW) == 3  # applied already: nothing differs
    assert rows_of(store, "records") == rows_of(store, "records", 2)


@pytest.mark.parametrize(
    ("patch", "table", "value", "code"),
    [
        (("b", "B", "y", "y2"), "catalog", "drifted", "drift"), (("b", "Other", "y", "y2"), None, None, "identity-mismatch"), (("zz", "Z", "y", "y2"), None, None, "missing-record"),
        (("b", "B", "y", " "), None, None, "blank-value"), (("b", "B", "y", "y"), None, None, "unchanged-value"), (("a2", "A", "x", "n"), None, None, "evidence-mismatch"),
    ],
)
def test_one_finding_leaves_all_tables(spark, store, patch, table, value, code):
    if table:
        store.write({table: store.read(table).withColumn("target", F.when(F.col("concept_id") == "b", value).otherwise(F.col("target")))})
    base = store.version()
    p = spark.createDataFrame([("a", "A", "x", "x2"), patch], PATCHES)
    assert code in {r.code for r in patch_findings(store.tables(), p, HOW).collect()}
    with pytest.raises(PatchRefused, match="patches refused"):
        integrate(store, p, HOW)
    assert store.version() == base and rows_of(store, "records")["a"][1] == "x"


def test_failure_between_two_tables(spark, store, monkeypatch):
    """The third table's write fails: readers still see the first version of all four."""
    from lexspark.operators import integrate as module

    real = module.patched

    def broken(*a):
        out = real(*a)
        out["catalog"] = out["catalog"].withColumn("target", F.when(F.col("concept_id") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("target")))
        return out

    monkeypatch.setattr(module, "patched", broken)
    p = spark.createDataFrame([("a", "A", "x", "x2")], PATCHES)
    with pytest.raises(Exception, match="lost"):
        integrate(store, p, HOW)
    assert store.version() == 1 and all(rows_of(store, t)["a"][1] in ("x", "q") for t in HOW.tables)
    monkeypatch.setattr(module, "patched", real)
    assert integrate(store, p, HOW) == 2 and all(rows_of(store, t)["a"][1] == "x2" for t in HOW.tables)


def test_a_result_that_is_not_as_it_should_be_is_refused(spark, store, monkeypatch):
    from lexspark.operators import integrate as module

    real = module.patched
    p = spark.createDataFrame([("a", "A", "x", "x2")], PATCHES)
    for spoil, code in (
        (lambda d: d.withColumn("extra", F.col("extra") + 1), "unrelated-change"), (lambda d: d.filter("concept_id <> 'b'"), "unrelated-change"),
        (lambda d: d.withColumn("target", F.when(F.col("concept_id") == "b", "w").otherwise(F.col("target"))), "unrelated-change"), (lambda d: d.withColumn("target", F.lit(None).cast("string")), "patch-not-applied"),
    ):
        monkeypatch.setattr(module, "patched", lambda *a, spoil=spoil: real(*a) | {"generated": spoil(real(*a)["generated"])})
        assert code in {r.code for r in unrelated_changes(store.tables(), module.patched(store.tables(), p, HOW), p, HOW).collect()}
        with pytest.raises(PatchRefused, match="result refused"):
            integrate(store, p, HOW)
    assert store.version() == 1


def test_later_patches_are_left_alone(spark, store):
    later = spark.createDataFrame([("a", "A", "x2", "x3")], PATCHES)
    integrate(store, spark.createDataFrame([("a", "A", "x", "x3")], PATCHES), HOW)
    first = spark.createDataFrame([("a", "A", "x", "x2"), ("b", "B", "y", "y2")], PATCHES)
    assert {r.code for r in patch_findings(store.tables(), first, HOW).collect()} == {"drift"}
    integrate(store, first, HOW, later)
    assert {rows_of(store, t)["a"][1] for t in HOW.tables} == {"x3"} and {rows_of(store, t)["b"][1] for t in HOW.tables} == {"y2"}


def test_of_two_writers_one_is_refused(spark, store):
    staged = store.stage({"records": store.read("records").limit(1)})
    store.write({"catalog": store.read("catalog").limit(2)}, base=1)
    with pytest.raises(VersionConflict):
        store.commit(staged, 1)
    assert store.version() == 2 and store.read("records").count() == 4 and store.read("catalog").count() == 2
    assert json.loads(json.dumps(store.manifest()))["version"] == 2


def test_empty_patches(spark, store):
    none = spark.createDataFrame([], PATCHES)
    assert patch_findings(store.tables(), none, HOW).collect() == [] and integrate(store, none, HOW) == 2
    assert rows_of(store, "quality") == rows_of(store, "quality", 1)


def tied_tables(spark, at):
    """Parts and line items whose averages are the limits, but for the rounding of a sum of doubles; keys of parts are not dense."""
    parts = [(k, f"red ring {k}", "Brand#1", "PROMO", k % 50, 900.0 + k) for k in range(0, 400, 4)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{at}/part.parquet")
    taxes = [(0.0, 0.06, 0.08, 0.08), (0.08, 0.08, 0.06, 0.0), (0.03, 0.01, 0.05), (0.05, 0.01, 0.03), (0.01, 0.02, 0.06, 0.03)]
    lines = [(k, "FO"[k // 4 % 2], 30.0, (0.052, 0.05, 0.054)[n % 3], tax, datetime(2000, 1, 1)) for k, *_ in parts for n, tax in enumerate(taxes[k // 4 % 5])]
    spark.createDataFrame(lines, "l_partkey long, l_linestatus string, l_quantity double, l_discount double, l_tax double, l_shipdate timestamp").coalesce(1).write.parquet(f"{at}/lineitem.parquet")
    return at


def test_averages_at_the_limits_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    at = tied_tables(spark, str(tmp_path))
    p = integration.part_patches(spark, at)
    assert p.filter("new = ' '").count() == 0 and p.filter("old = 'else'").count() == 0 and p.filter("new = old").count() == 0
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet/*.parquet'")
    for q in (integration.patch_batch_findings, integration.integrated_tables):
        want = con.execute(ORACLE_SQL[q.__name__])
        names = [c[0] for c in want.description]
        assert sorted(q(spark, at).select(*names).collect()) == sorted(want.fetchall())


def test_patches_are_made_once(spark, store):
    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            made.add(batch.num_rows)
            yield batch

    p = spark.createDataFrame([("a", "A", "x", "x2")], PATCHES).mapInArrow(count, PATCHES)
    assert integrate(store, p, HOW) == 2 and made.value == 1


def test_patches_meet_all_tables_once_and_no_table_is_broadcast(spark, tmp_path):
    # Each of seven parts of the findings read the line items again, and parts went to the driver whole.
    plan = integration.patch_batch_findings(spark, tied_tables(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("struct<l_partkey") == 1 and plan.count("SortMergeJoin") == 2
    store = TableSet(spark, f"file://{tmp_path}/set")
    tables = {name: spark.createDataFrame([("a", "A", "x", "P", 1)], SCHEMA) for name in HOW.tables}
    store.write(tables)
    p, later = spark.createDataFrame([("a", "A", "x", "y")], PATCHES), spark.createDataFrame([("b", "B", "x", "y")], PATCHES)
    for d in (*patched(store.tables(), p, HOW, later).values(), unrelated_changes(store.tables(), tables, p, HOW, later), patch_findings(store.tables(), p, HOW, later)):
        assert "Broadcast" not in d._jdf.queryExecution().executedPlan().toString()


def test_repeated_rows_of_tables_are_each_told(spark):
    patches = spark.createDataFrame([("a", "A", "x", " "), ("a", "A", "x", "x"), (None, "N", "x", "y")], PATCHES)
    rows = [("a", "A", "x", "P", 1), ("a", "B", "x", "V", 2), ("a", "B", "z", None, 3)]
    tables = {name: spark.createDataFrame(rows, SCHEMA) for name in HOW.tables}
    tables["catalog"] = tables["catalog"].limit(0)
    got = sorted((r.entity_id or "", r.table, r.code) for r in patch_findings(tables, patches, HOW).collect())
    want = [("", t, "missing-record") for t in HOW.tables] + [("a", "", c) for c in ("duplicate-id", "blank-value", "unchanged-value")] + [("a", "catalog", "missing-record")]
    want += [("a", t, "identity-mismatch") for t in ("records", "generated", "quality")] * 2 + [("a", t, "drift") for t in ("records", "generated")] + [("a", "records", "evidence-mismatch")] * 2
    assert got == sorted(want)
