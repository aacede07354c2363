"""Jobs on many rows of one key: whole results, and no shuffle of the key's pairs."""

import pytest
from pyspark.sql import functions as F

from lexspark.operators import match, search


def rows_shuffled(spark, df):
    """The rows of a result, and how many rows were written to shuffles for it."""
    sc = spark.sparkContext

    def written():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before = written()
    rows = df.collect()
    return rows, written() - before


def test_terms_of_one_name_and_queries_of_one_text(spark, monkeypatch):
    ranked, first_k = [], search.first_k
    monkeypatch.setattr(search, "first_k", lambda df, *rest: ranked.append(df.count()) or first_k(df, *rest))
    names = ["red ring", "hot ring", "ring", "Red  Ring", "pin"]
    t = spark.range(1500).select(F.col("id").alias("concept_id"), F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 5 + 1).cast("int")).alias("display_name"), (-F.col("id")).alias("pos"))
    t = t.withColumn("key", F.lower(F.regexp_replace("display_name", " +", " ")))
    t = t.union(t.filter("concept_id < 50")).union(t.filter("concept_id < 50").withColumn("key", F.lit("a second ring")))
    texts = ["ring", "r", "in", "hot ri", "pin", "none", " "]
    q = spark.range(700).select(F.col("id").alias("query_id"), F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % 7 + 1).cast("int")).alias("query"))
    got = search.batch_search(t, q, 4).collect()
    hits = {text: sorted({(len(r.display_name), r.pos, r.concept_id, r.display_name) for r in t.collect() if text in r.key})[:4] for text in texts if text.strip()}
    want = {(r.query_id, k + 1, h[2], h[3]) for r in q.collect() for k, h in enumerate(hits.get(r["query"], []))}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert sum(ranked) < 2_000  # 700 queries have over 300,000 hits


@pytest.mark.parametrize("several", [False, True])
def test_partners_are_counted_without_pairs(spark, several):
    atoms = "atom_id long, identifier string, release string, suppressed boolean"
    a = [(k, "hot", "r1", [False, None][k % 2]) for k in range(400)] + [(500, "x", "r1", False), (501, "x", "r1", True), (502, "x", "r0", False), (503, None, "r1", False), (504, "alone", "r1", False), (500, "x", "r1", False), (None, "x", "r1", False)]
    b = [(k, "hot", "r1", False) for k in range(400)] + [(600, "x", "r1", False), (601, None, "r1", False)]
    if several:
        a, b = a + [(1, "x", "r1", False), (1, "y", "r1", False), (505, "y", "r1", False)], b + [(7, "x", "r1", False), (7, "y", "r1", False), (602, "y", "r1", False)]
    got, shuffled = rows_shuffled(spark, match.shared_identifier_bridge(spark.createDataFrame(a, atoms), spark.createDataFrame(b, atoms), "r1"))
    live = lambda rows: {(x, i) for x, i, r, s in rows if r == "r1" and not s and i is not None and x is not None}
    pairs = {(x, y, i) for x, i in live(a) for y, j in live(b) if i == j}
    left, right = {}, {}
    for x, y, _ in pairs:
        left.setdefault(x, set()).add(y)
        right.setdefault(y, set()).add(x)
    assert sorted(tuple(r[c] for c in ("left_id", "right_id", "identifier", "left_partners", "right_partners", "status")) for r in got) == sorted((x, y, i, len(left[x]), len(right[y]), "REVIEW_ONLY") for x, y, i in pairs)
    assert shuffled < 60_000  # 160,000 pairs


def test_keys_and_pairs_are_met_in_many_tasks(spark):
    """The session has 4 shuffle partitions here; a task's share must not follow from that number."""
    from lexspark.operators import match

    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    e = spark.createDataFrame([("E1", ("Bone", ["bone", "Os"]), ["C1"], [])], "evidence_id string, pivot struct<preferred: string, aliases: array<string>>, terminology_ids array<string>, source_codes array<string>")
    c = spark.createDataFrame([("C1", "bone"), ("C2", "os")], "concept_id string, name string")
    m = match.match_entities(c, match.build_keys(e))
    assert sorted((r.concept_id, r.evidence_id, r.reasons) for r in m.collect()) == [("C1", "E1", ["exact", "terminology_id"]), ("C2", "E1", ["exact"])]
    assert plan(m).count(f", {match.KEY_TASKS}") >= 3 and plan(m).count("Join ") == 1
    p = match.sided_siblings(spark.createDataFrame([(1, "bone"), (2, "left bone")], "concept_id long, name string"), spark.createDataFrame([(1, 7), (2, 7)], "concept_id long, element_id long"), ["left"])
    assert p.collect() == [(1, 2)] and plan(p).count(f", {match.KEY_TASKS}") >= 3
