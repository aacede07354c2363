"""Every registered query with SQL against DuckDB on the smallest driver tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from lexspark.plans import files, gates, integration, queries, records, reviews, revisions, untyped  # noqa: F401  they, and what they build on, register theirs

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else v if isinstance(v, (int, bool, str)) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    want = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in sorted(df.columns)]
    got = Counter(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    assert got == Counter(tuple(plain(r[k]) for k in order) for r in want.fetchall())


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE_SQL)


def test_entry_works_without_the_optional_subpackage(spark, monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "lexspark.llm", None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    import __spark_entry__ as entry

    assert not any(q.startswith("op") for q in entry.queries() if q[2:3].isdigit()) and entry.entry(spark).count() > 0
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)


def test_audits_come_from_one_join(spark):
    from lexspark.plans import gates

    plan = gates.tables(spark, SF)["audits"].select("concept_id", "type", "claim_ids")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("lineitem.parquet") <= 1 and plan.count("Aggregate") == 1


@pytest.mark.parametrize("name, most", [("gated_release", 28), ("unreleased_terms", 33)])
def test_release_sends_claims_by_their_concept_once(spark, name, most):
    # As at size, where nothing is broadcast; there were 64 and 69 shuffles.
    from lexspark.plans.queries import QUERIES

    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plan.count("Exchange hashpartitioning") <= most, plan.count("Exchange hashpartitioning")


def test_blocks_of_a_stream_are_made_once(spark):
    from lexspark.plans.queries import QUERIES

    # Names, duplicates and rows each read the lines again before.
    plan = QUERIES["rebuilt_rows"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_translations_are_sent_twice_and_parts_are_not_broadcast(spark):
    from lexspark.plans.queries import QUERIES

    # Records went by their id three times more: to be made distinct, to share their findings and to get them back.
    plan = QUERIES["repaired_translations"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("ShuffledHashJoin") == 2 and plan.count("lineitem.parquet") <= 1
    assert plan.count("REPARTITION_BY_NUM") == 2 and plan.count("Exchange hashpartitioning") == 5  # two of parts, and one of the rules' words
