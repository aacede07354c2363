"""Registered queries of the release gates over a registry that orders, line items, suppliers and customers make.

An order is an entry, its line items are claims, mappings and conflicts, suppliers are sources and
customers reviewers. What is wrong with a row follows from its columns, and the SQL joins the same
tables and applies each gate's conditions to them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.operators import registry
from lexspark.plans.queries import query, read

CAPABILITIES = {"identity": "identity", "target-preferred": "target_preferred"}
NOMENCLATURES = {"NOM": "identity"}
AUDITS = ("source-verification", "medical-review")

#: Columns by expressions in the SQL that Spark and DuckDB share.
SOURCE = {
    "id": "concat('N', s_suppkey)", "class": "CASE WHEN s_nationkey < 15 THEN 'target-authoritative' WHEN s_nationkey < 18 THEN 'nomenclature' WHEN s_nationkey < 20 THEN 'machine-generated' ELSE 'secondary-reference' END", "revision": "concat('r', s_nationkey)",
    "authority_tier": "CASE WHEN s_acctbal < 0 THEN 'discovery-only' WHEN s_acctbal < 500 THEN 'rejected' ELSE 'authoritative' END", "access_status": "CASE WHEN s_acctbal > 9000 THEN 'METADATA_ONLY' ELSE 'FULL_ACCESS' END", "locator_capability": "CASE WHEN s_nationkey IN (4, 9, 16) THEN 'PLATE' ELSE 'PAGE' END",
    "identity_verified": "s_acctbal > 100", "full_text_available": "s_acctbal < 8800", "content_inspected": "s_acctbal NOT BETWEEN 3000 AND 3500", "audit_status": "CASE WHEN s_acctbal < 8000 THEN 'VERIFIED' ELSE 'UNVERIFIED' END",
    "can_identity": "s_nationkey <> 3", "can_target": "s_nationkey < 14",
}
CLAIM = {
    "concept_id": "CAST(l_orderkey AS STRING)", "id": "concat(l_linenumber, '-', l_partkey, '-', l_suppkey)", "type": "CASE l_returnflag WHEN 'R' THEN 'identity' WHEN 'A' THEN 'target-preferred' ELSE 'third-preferred' END",
    "target": "CASE WHEN l_tax > 0.06 THEN 'other' WHEN l_returnflag = 'R' THEN CAST(l_orderkey AS STRING) ELSE o_orderpriority END", "source_id": "concat('N', l_suppkey)", "source_revision": "CASE WHEN l_discount < 0.09 THEN concat('r', s_nationkey) ELSE 'old' END",
    "page": "CASE WHEN l_quantity > 4 THEN CAST(l_quantity AS INT) END", "plate": "CASE WHEN l_linestatus = 'F' THEN 'p' ELSE ' ' END", "nomenclature_id": "CASE WHEN l_quantity < 20 THEN CAST(l_orderkey AS STRING) END",
    "evidence_disposition": "CASE WHEN l_tax < 0.07 THEN 'SUPPORTED' ELSE 'CANDIDATE' END", "review_state": "CASE WHEN l_discount > 0.01 THEN 'VERIFIED' ELSE 'PENDING' END",
}
MAPPING = {
    "concept_id": "CAST(l_orderkey AS STRING)", "id": "concat('m', l_linenumber)", "namespace": "CASE WHEN l_quantity < 25 THEN 'nom' ELSE 'LOCAL' END", "identifier": "CAST(l_orderkey AS STRING)", "source_revision": "concat('r', s_nationkey)",
    "relation": "CASE WHEN l_tax > 0.07 THEN 'related' ELSE 'exact' END", "disposition": "CASE WHEN l_discount < 0.08 THEN 'VERIFIED' ELSE 'CANDIDATE' END", "claim_id": "concat(l_linenumber, '-', l_partkey, '-', l_suppkey)", "other_id": "CASE WHEN l_quantity > 45 THEN concat(l_linenumber + 1, '-', l_partkey, '-', l_suppkey) END",
}
ENTRY = {
    "concept_id": "CAST(o_orderkey AS STRING)", "preferred": "concat(o_orderpriority, ' ')", "mapping_status": "CASE o_orderstatus WHEN 'F' THEN 'MAPPED' WHEN 'O' THEN 'UNMAPPED' ELSE 'REJECTED' END", "mapping_disposition": "CASE WHEN o_totalprice > 200000 THEN 'CONFIRMED_NO_EQUIVALENT' ELSE 'UNRESOLVED' END", "revision": "concat('v', o_orderpriority)",
}
AUDIT = {
    "status": "CASE WHEN o_totalprice > 20000 THEN 'PASSED' ELSE 'PENDING' END", "decision": "CASE o_orderpriority WHEN '5-LOW' THEN 'REJECT' ELSE 'APPROVE' END", "reviewer_id": "CAST(o_custkey AS STRING)", "reviewed_at": "CASE WHEN o_totalprice > 40000 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) ELSE ' ' END",
    "entry_revision": "CASE WHEN o_totalprice < 450000 THEN concat('v', o_orderpriority) ELSE 'v0' END", "automated": "o_totalprice > 430000",
}
CONFLICT = {
    "concept_id": "CAST(l_orderkey AS STRING)", "id": "concat('x', l_linenumber)", "status": "CASE l_returnflag WHEN 'R' THEN 'OPEN' WHEN 'A' THEN 'ADJUDICATED' ELSE 'REJECTED' END", "decision": "CASE WHEN l_tax > 0.02 THEN 'd' ELSE '' END", "rationale": "'because'", "reviewer_id": "CAST(o_custkey AS STRING)",
    "entry_revision": "CASE WHEN l_discount > 0.02 THEN concat('v', o_orderpriority) ELSE 'v0' END", "claim_id": "concat(l_linenumber, '-', l_partkey, '-', l_suppkey)",
}
REVIEWER = {"id": "CAST(c_custkey AS STRING)", "status": "CASE c_mktsegment WHEN 'BUILDING' THEN 'INACTIVE' ELSE 'ACTIVE' END", "everything": "c_nationkey < 18"}


def _made(df, columns: dict):
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def tables(spark, sf_dir):
    """The registry's tables. A reviewer's scope is everything, or nothing."""
    s, o, c = (read(spark, sf_dir, n) for n in ("supplier", "orders", "customer"))
    # Orders are joined by the text of their key, which is the concept's id, so that what is joined lies by concept already.
    key = lambda c: F.col(c).cast("string")
    supplied = read(spark, sf_dir, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    li = supplied.join(o, key("l_orderkey") == key("o_orderkey"))
    names = lambda *c: F.array_compact(F.array(*c))
    sources = _made(s, SOURCE)
    caps = F.struct(F.col("can_identity").alias("identity"), F.lit(False).alias("canonical"), F.col("can_target").alias("target_preferred"), F.lit(True).alias("corroboration"), (F.col("class") == "machine-generated").alias("machine_discovery"))
    claims = _made(li, CLAIM)
    none = F.lit(None).cast("string")
    at = F.struct("page", "plate", none.alias("entry_id"), "nomenclature_id", none.alias("chapter"), none.alias("section"), none.alias("table"), none.alias("url"))
    of = supplied.groupBy(key("l_orderkey").alias("_of")).agg(F.collect_list(F.struct(F.expr(CLAIM["id"]).alias("id"), F.expr("l_quantity < 49").alias("some"))).alias("ids"))
    lists = (F.transform("ids", lambda x: x["id"]), F.transform(F.filter("ids", lambda x: x["some"]), lambda x: x["id"]))
    # Both kinds of audits come from one join of orders with their claims.
    kinds = F.explode(F.array(*[F.struct(F.lit(kind).alias("type"), ids.alias("claim_ids")) for kind, ids in zip(AUDITS, lists, strict=True)]))
    audits = o.join(of, key("o_orderkey") == F.col("_of")).select(F.expr(ENTRY["concept_id"]).alias("concept_id"), *[F.expr(e).alias(k) for k, e in AUDIT.items()], kinds.alias("a")).select("*", "a.type", "a.claim_ids").drop("a")
    return {
        "sources": sources.select("*", caps.alias("capabilities"), F.struct(F.col("audit_status").alias("status")).alias("audit")), "claims": claims.select("*", at.alias("locator")).drop("page", "plate", "nomenclature_id"),
        "entries": _made(o, ENTRY).select("*", F.struct("preferred").alias("target")), "mappings": _made(li.filter("l_linestatus = 'F'"), MAPPING).select("*", names("claim_id", "other_id").alias("evidence_claim_ids")),
        "audits": audits, "conflicts": _made(li.filter("l_quantity > 47"), CONFLICT).select("*", F.array("claim_id").alias("claim_ids")),
        "reviewers": _made(c, REVIEWER).select("*", F.when(F.col("everything"), F.array(F.lit("*"))).otherwise(F.array().cast("array<string>")).alias("authorization_scope")),
    }


def _cte(columns: dict, rows: str) -> str:
    return "(SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {rows})"


LI = "(SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)"
GATED = f"""src AS {_cte(SOURCE, 'supplier')}, ent AS {_cte(ENTRY, 'orders')}, rev AS {_cte(REVIEWER, 'customer')},
cl AS (SELECT c.*, coalesce(c.evidence_disposition = 'SUPPORTED' AND c.review_state = 'VERIFIED' AND s.identity_verified AND s.authority_tier = 'authoritative' AND s.access_status = 'FULL_ACCESS' AND s.full_text_available AND s.content_inspected
AND CASE s.locator_capability WHEN 'PAGE' THEN coalesce(page > 0, false) ELSE trim(plate) <> '' END AND s.audit_status = 'VERIFIED' AND s.class <> 'machine-generated' AND s.revision = c.source_revision
AND CASE c.type WHEN 'identity' THEN s.can_identity WHEN 'target-preferred' THEN s.can_target ELSE true END AND (coalesce(page > 0, false) OR trim(plate) <> '' OR nomenclature_id IS NOT NULL)
AND (c.type <> 'target-preferred' OR s.class = 'target-authoritative') AND (c.type <> 'third-preferred' OR s.class = 'nomenclature'), false) AS approved FROM {_cte(CLAIM, LI)} c LEFT JOIN src s ON s.id = c.source_id)"""
MAPPED = f"""mp AS {_cte(MAPPING, "(SELECT * FROM " + LI + " WHERE l_linestatus = 'F')")}, ev AS (SELECT concept_id, id, namespace, identifier, source_revision, relation, disposition, unnest(list_filter([claim_id, other_id], lambda x: x IS NOT NULL)) AS claim_id FROM mp),
okm AS (SELECT e.concept_id, e.id, bool_and(coalesce(c.approved AND c.target = e.identifier AND c.source_revision = e.source_revision AND (upper(e.namespace) <> 'NOM' OR (c.type = 'identity' AND coalesce(c.nomenclature_id = e.identifier, false))), false)) AS ok
FROM ev e LEFT JOIN cl c ON c.concept_id = e.concept_id AND c.id = e.claim_id WHERE e.relation = 'exact' AND e.disposition = 'VERIFIED' GROUP BY e.concept_id, e.id, e.namespace, e.identifier),
mg AS (SELECT concept_id, CASE mapping_status WHEN 'MAPPED' THEN concept_id IN (SELECT concept_id FROM okm WHERE ok) WHEN 'UNMAPPED' THEN mapping_disposition = 'CONFIRMED_NO_EQUIVALENT' AND concept_id IN (SELECT concept_id FROM cl WHERE approved AND type = 'identity' AND target = concept_id) ELSE false END AS mapping_ok FROM ent)"""
AUDITED = f"""must AS (SELECT concept_id, list(DISTINCT id) AS ids FROM cl WHERE type IN ('identity', 'target-preferred') GROUP BY 1), held AS (SELECT l_orderkey, list(CASE WHEN l_quantity < 49 THEN id END) FILTER (l_quantity < 49) AS some_ids, list(id) AS all_ids FROM (SELECT *, {CLAIM['id']} AS id FROM {LI}) GROUP BY 1),
au AS (SELECT {ENTRY['concept_id']} AS concept_id, t.type, {', '.join(f'{e} AS {k}' for k, e in AUDIT.items())}, coalesce(CASE t.type WHEN 'source-verification' THEN all_ids ELSE some_ids END, []) AS claim_ids FROM orders JOIN held ON l_orderkey = o_orderkey, (VALUES ('source-verification'), ('medical-review')) AS t(type)),
ag AS (SELECT a.concept_id, a.type, bool_or(coalesce(a.status = 'PASSED' AND a.decision = 'APPROVE' AND trim(a.reviewed_at) <> '' AND a.entry_revision = e.revision AND NOT a.automated AND r.status = 'ACTIVE' AND (r.everything OR len(a.claim_ids) = 0) AND len(a.claim_ids) > 0
AND len(m.ids) > 0 AND len(list_filter(m.ids, lambda x: NOT list_contains(a.claim_ids, x))) = 0, false)) AS audit_ok FROM au a JOIN ent e ON e.concept_id = a.concept_id LEFT JOIN must m ON m.concept_id = a.concept_id LEFT JOIN rev r ON r.id = a.reviewer_id GROUP BY 1, 2)"""
SETTLED = f"""xs AS {_cte(CONFLICT, "(SELECT * FROM " + LI + " WHERE l_quantity > 47)")},
xg AS (SELECT e.concept_id, coalesce(bool_and(x.status = 'REJECTED' OR coalesce(x.status = 'ADJUDICATED' AND trim(x.decision) <> '' AND r.status = 'ACTIVE' AND r.everything AND x.entry_revision = e.revision, false)) FILTER (x.concept_id IS NOT NULL), true) AS conflicts_ok
FROM ent e LEFT JOIN xs x ON x.concept_id = e.concept_id LEFT JOIN rev r ON r.id = x.reviewer_id GROUP BY 1)"""


@query(f"WITH {GATED} SELECT concept_id, id, approved FROM cl")
def gated_claims(spark, sf_dir):
    """Claims that their source, revision, capability, place, review and evidence let through."""
    t = tables(spark, sf_dir)
    return registry.claim_gate(t["claims"], t["sources"], CAPABILITIES).select("concept_id", "id", "approved")


@query(f"WITH {GATED}, {MAPPED} SELECT concept_id, mapping_ok FROM mg")
def gated_mappings(spark, sf_dir):
    """Entries with a verified mapping all of whose evidence is approved and exact, or confirmed to have none."""
    t = tables(spark, sf_dir)
    return registry.mapping_gate(t["entries"], t["mappings"], registry.claim_gate(t["claims"], t["sources"], CAPABILITIES), NOMENCLATURES)


@query(f"WITH {GATED}, {AUDITED} SELECT concept_id, type, audit_ok FROM ag")
def gated_audits(spark, sf_dir):
    """Audits by active, authorised people, of the current revision, that cover all needed claims."""
    t = tables(spark, sf_dir)
    return registry.audit_gate(t["entries"], t["audits"], t["reviewers"], t["claims"], list(CAPABILITIES))


@query(f"WITH {GATED}, {SETTLED} SELECT concept_id, conflicts_ok FROM xg")
def gated_conflicts(spark, sf_dir):
    """Entries whose conflicts are all rejected, or adjudicated for the current revision by an active, authorised reviewer."""
    t = tables(spark, sf_dir)
    return registry.conflict_gate(t["entries"], t["conflicts"], t["reviewers"])


@query(f"""WITH {GATED}, {MAPPED}, {AUDITED}, {SETTLED}, g AS (SELECT e.concept_id, e.concept_id IN (SELECT c.concept_id FROM cl c JOIN ent n ON n.concept_id = c.concept_id WHERE approved AND type = 'target-preferred' AND target = trim(n.preferred)) AS term_ok, mapping_ok,
(SELECT count(*) FROM ag WHERE ag.concept_id = e.concept_id AND audit_ok) = 2 AS audits_ok, conflicts_ok FROM ent e JOIN mg ON mg.concept_id = e.concept_id JOIN xg ON xg.concept_id = e.concept_id)
SELECT *, term_ok AND mapping_ok AND audits_ok AND conflicts_ok AS released FROM g""")
def gated_release(spark, sf_dir):
    """Entries that every gate lets through."""
    return registry.release_gate(tables(spark, sf_dir), CAPABILITIES, NOMENCLATURES)


@query(f"""WITH {GATED}, {MAPPED}, {AUDITED}, {SETTLED}, g AS (SELECT e.concept_id, o_totalprice, o_orderstatus, e.concept_id IN (SELECT c.concept_id FROM cl c JOIN ent n ON n.concept_id = c.concept_id WHERE approved AND type = 'target-preferred' AND target = trim(n.preferred)) AND mapping_ok AND (SELECT count(*) FROM ag WHERE ag.concept_id = e.concept_id AND audit_ok) = 2 AND conflicts_ok AS released
FROM ent e JOIN orders ON o_orderkey::VARCHAR = e.concept_id JOIN mg ON mg.concept_id = e.concept_id JOIN xg ON xg.concept_id = e.concept_id)
SELECT 'unreleased-search-term' AS code, concept_id AS entity_id, 'warning' AS severity FROM g WHERE NOT released UNION ALL SELECT 'unreleased-third', concept_id, 'warning' FROM g WHERE o_totalprice > 300000 AND o_orderstatus <> 'F'""")
def unreleased_terms(spark, sf_dir):
    """Entries with a term in a language in which they are not released."""
    t = tables(spark, sf_dir)
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("concept_id"), F.struct(F.when(F.col("o_totalprice") > 300000, "os").alias("preferred")).alias("third"), (F.col("o_orderstatus") == "F").alias("_third"))
    entries = t["entries"].select("concept_id", "target").join(o, "concept_id")
    released = registry.release_gate(t, CAPABILITIES, NOMENCLATURES).filter("released").select("concept_id", F.lit("target").alias("language"))
    released = released.union(o.filter("_third").select("concept_id", F.lit("third")))
    return registry.readiness_findings(entries, released).select("code", "entity_id", "severity")
