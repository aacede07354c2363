"""Registered queries over records: readers' columns, contracts, fail-closed rows, guards, patches, and all rules of a registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import compose, consensus, evidence, match, metrics, patch, reconstruct, registry, report, rules, snapshot
from lexspark.plans.further import CAPABILITIES, PARTS, parts, supplier_registry
from lexspark.plans.queries import query, read
from lexspark.sources import io

LINES = """(SELECT doc_id, k, replace(replace(t, chr(9), ' '), chr(92), '/') AS t FROM (SELECT doc_id, unnest(generate_series(0, len(a) - 1)) AS k, unnest(a) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL)))"""


def lines(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "t"))
    return d.select("doc_id", F.col("k").cast("long").alias("k"), F.translate("t", "\t\\", " /").alias("t"))


@query(f"SELECT doc_id, k, CASE WHEN k % 3 = 0 THEN k::INT END AS line, md5(t) AS text_md5, CASE WHEN k % 5 = 0 THEN (k + 1)::INT END AS page, k % 5 <> 0 AS unescaped FROM {LINES}")
def rendered_lines(spark, sf_dir):
    r"""A3, A4: numbered lines of a rendered stream, page markers, literal \n made line ends."""
    d = lines(spark, sf_dir)
    k = F.col("k")
    got = io.split_rendered(F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit("\t"), "t")).otherwise(F.col("t")))
    marked = F.when(k % 5 == 0, F.concat(F.lit("=== PDF_PAGE "), (k + 1).cast("string"), F.lit(" ==="))).otherwise(F.concat("t", F.lit("\\n"), "t"))
    return d.select("doc_id", "k", got["line"].alias("line"), F.md5(got["text"]).alias("text_md5"), io.page_of_marker(marked).alias("page"), (io.unescape_lines(marked) == F.concat("t", F.lit("\n"), "t")).alias("unescaped"))


@query("""SELECT l_orderkey AS concept_id, l_linenumber || '/' || l_partkey || '/' || l_suppkey AS id, l_returnflag AS type, NULL AS code FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, NULL, NULL, 'entry-key-mismatch' FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 = 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def nested_registry(spark, sf_dir):
    """A5: a nested registry's released entries taken apart, and keys that do not name their entry."""
    li = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("concept_id")).agg(F.collect_list(F.struct(F.concat_ws("/", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.col("l_returnflag").alias("type"))).alias("claims"))  # an order's lines
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("concept_id"), F.when(F.col("o_orderkey") % 5 == 0, -1).otherwise(F.col("o_orderkey")).alias("key"), F.when(F.col("o_orderstatus") == "F", "RELEASED").otherwise("DRAFT").alias("release_status"))
    none = F.array().cast("array<struct<id:string>>")
    nested = o.join(li, "concept_id").select("*", none.alias("conflicts"), none.alias("audits"), F.struct(none.alias("mappings")).alias("mapping"))
    t = io.explode_registry(nested)
    bad = io.key_mismatches(t["entries"])
    return t["claims"].select("concept_id", "id", "type", F.lit(None).cast("string").alias("code")).union(bad.select("concept_id", F.lit(None).cast("string"), F.lit(None).cast("string"), "code"))


@query("""SELECT coalesce(a.p, b.p) AS path, CASE WHEN b.p IS NULL THEN 'MISSING' WHEN a.p IS NULL THEN 'NEW' WHEN a.h = b.h THEN 'MATCH' ELSE 'DELTA' END AS state
FROM (SELECT 'f' || doc_id AS p, md5(text) AS h FROM documents) a FULL JOIN (SELECT 'f' || (d.doc_id + 2) AS p, coalesce((SELECT md5(text) FROM documents x WHERE x.doc_id = d.doc_id + 2 AND d.doc_id % 3 > 0), 'other') AS h FROM documents d) b ON a.p = b.p""")
def manifest_states(spark, sf_dir):
    """Files against a planned baseline."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    a = d.select(F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path"), F.col("h").alias("sha256"))
    moved = d.select((F.col("doc_id") + 2).alias("doc_id"), (F.col("doc_id") % 3 > 0).alias("same")).join(d, "doc_id", "left")
    b = moved.select(F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path"), F.coalesce(F.when(F.col("same"), F.col("h")), F.lit("other")).alias("sha256"))
    return io.compare_manifest(a, b).select("path", "state")


@query("""SELECT o_orderkey AS row_id, concat_ws(',', CASE WHEN o_totalprice <= 50000 THEN 'large' END, CASE WHEN o_orderstatus <> 'F' THEN 'status' END) AS blockers, CASE WHEN o_totalprice <= 50000 OR o_orderstatus <> 'F' THEN 'BLOCKED' ELSE 'IDENTITY_REVIEW' END AS disposition,
sha256('A:' || o_orderkey || ':says') AS hash, 'side=UNKNOWN,version=UNKNOWN' AS scopes FROM orders""")
def adapted_rows(spark, sf_dir):
    """Rows that fail closed, with blockers, an evidence reference and unknown scopes."""
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "row_id")
    out = rules.adapt_rows(o, {"status": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 50000}, "A", "says", "open", ["side", "version"])
    return out.select("row_id", F.array_join("blockers", ",").alias("blockers"), "disposition", F.col("evidence_ref.hash").alias("hash"), F.array_join(F.transform("scope_checks", lambda s: F.concat_ws("=", s["scope"], s["state"])), ",").alias("scopes"))


@query(f"""SELECT id AS row_id, 'pivot' AS kind, head AS value, sha256(id || ':pivot:' || head) AS fact_id FROM {PARTS} UNION ALL SELECT id, 'target', rest, sha256(id || ':target:' || rest) FROM {PARTS}
UNION ALL SELECT id, 'candidate', head || ' = ' || rest, sha256(id || ':' || head || ':' || rest) FROM {PARTS}""")
def facts_and_candidates(spark, sf_dir):
    """Two endpoint facts and one discovery candidate a row."""
    r = parts(spark, sf_dir).select(F.col("id").alias("row_id"), F.col("head").alias("pivot"), F.col("rest").alias("target"))
    c = rules.discovery_candidates(r).select("row_id", F.lit("candidate"), F.concat_ws(" = ", "pivot", "target"), "candidate_id")
    return rules.endpoint_facts(r).withColumnRenamed("endpoint", "kind").union(c)


@query("""SELECT o_orderkey AS row_id, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def aligned_lists(spark, sf_dir):
    """Lists aligned by row id."""
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "row_id")
    return rules.join_by_row_id(o.select("row_id", "o_orderstatus"), o.filter("row_id % 2 = 0").select("row_id", "o_orderpriority"))


@query("""SELECT c_name AS entity_id, unnest(list_filter([CASE WHEN c_custkey % 2 = 0 THEN 'missing-source_id' END, CASE WHEN c_custkey % 3 = 0 THEN 'missing-locator' END, CASE WHEN c_custkey % 5 = 0 THEN 'invalid-laterality' END, CASE WHEN c_custkey % 7 = 0 THEN 'blank-pivot-alias' END, CASE WHEN c_custkey % 11 = 0 THEN 'blank-source_codes' END], lambda x: x IS NOT NULL)) AS code FROM customer""")
def attestation_contract(spark, sf_dir):
    """What the contract of attestations finds wrong."""
    k, none = F.col("c_custkey"), F.array().cast("array<string>")
    term = lambda bad: F.struct(F.lit("x").alias("preferred"), F.when(bad, F.array(F.lit(" "))).otherwise(none).alias("aliases"))
    a = read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("source_term_raw"), F.when(k % 2 != 0, "s").alias("source_id"), F.lit("r").alias("source_revision"), F.when(k % 3 != 0, F.struct(F.lit(1).alias("page"))).alias("locator"), F.when(k % 5 == 0, "upwards").otherwise("left").alias("laterality"),
        term(k % 7 == 0).alias("pivot"), term(F.lit(False)).alias("third"), term(F.lit(False)).alias("target"), none.alias("directional_qualifiers"), F.when(k % 11 == 0, F.array(F.lit(""))).otherwise(none).alias("source_codes"), none.alias("terminology_ids"))
    return evidence.validate_attestations(a).select("entity_id", "code")


@query("""SELECT DISTINCT 'UNRESOLVED' AS state, l_suppkey AS source_id, NULL AS said FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 <> 0)
UNION ALL SELECT DISTINCT 'STALE', l_suppkey, (l_linenumber % 3)::VARCHAR FROM lineitem JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 7 <> 0 WHERE s_nationkey % 3 <> l_linenumber % 3""")
def unresolved_and_stale(spark, sf_dir):
    """Sources that nothing describes, and revisions that differ."""
    catalog = read(spark, sf_dir, "supplier").filter("s_suppkey % 7 <> 0").select(F.col("s_suppkey").alias("id"), (F.col("s_nationkey") % 3).cast("string").alias("revision"))
    a = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source_id"), (F.col("l_linenumber") % 3).cast("string").alias("source_revision"))
    gone = evidence.unresolved_sources(a, catalog).select(F.lit("UNRESOLVED").alias("state"), "source_id", F.lit(None).cast("string").alias("said"))
    return gone.union(evidence.revision_mismatches(a, catalog).select(F.lit("STALE"), "source_id", "source_revision"))


@query("""SELECT o_orderkey AS concept_id, o_custkey AS evidence_id, o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 3 = 0 OR o_orderstatus = 'P' AS unsafe FROM orders""")
def unsafe_matches(spark, sf_dir):
    """C4: matches that must not become claims."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    m = o.select(k.alias("concept_id"), F.col("o_custkey").alias("evidence_id"), (k % 5 != 0).alias("known"), (k % 7 != 0).alias("revision_matches"), F.when(k % 3 == 0, F.array(F.lit("source_code"))).otherwise(F.array(F.lit("exact"), F.lit("source_code"))).alias("reasons"))
    flags = o.select(k.alias("concept_id"), F.col("o_custkey").alias("evidence_id"), F.when(F.col("o_orderstatus") == "P", "SIDE").otherwise("HARMLESS").alias("code"))
    return evidence.unsafe(m, flags, ["SIDE"]).select("concept_id", "evidence_id", "unsafe")


@query("""SELECT o_orderkey AS concept_id, CASE WHEN b = 'HIGH_CONSENSUS_CANDIDATE' AND NOT (o_custkey % 2 = 0 AND o_custkey % 3 > 0) THEN 'VARIANT_REVIEW' ELSE b END AS bucket
FROM (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN 'SOURCE_GAP' WHEN o_orderkey % 4 = 1 THEN 'IDENTITY_GAP' ELSE 'HIGH_CONSENSUS_CANDIDATE' END AS b FROM orders)""")
def guarded_buckets(spark, sf_dir):
    """Buckets fixed by bindings, and high consensus only with independent agreement."""
    o = read(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    d = o.select(k.alias("concept_id"), F.when(k % 4 == 1, "IDENTITY_GAP").otherwise("HIGH_CONSENSUS_CANDIDATE").alias("bucket"))
    bound = o.filter(k % 4 == 0).select(k.alias("concept_id"), F.lit("SOURCE_GAP").alias("bound_bucket"))
    a = o.select(k.alias("concept_id"), F.when(c % 2 == 0, "AGREED").otherwise("CONFLICT").alias("status"), F.lit(3).alias("sources"), F.when(c % 3 == 0, 1).otherwise(2).alias("institutions"))
    return consensus.apply_guards(d, bound, a).select("concept_id", "bucket")


@query("""SELECT source, lang, min(doc_id) AS doc_id FROM documents GROUP BY 1, 2""")
def first_rows(spark, sf_dir):
    """F8: the first row of each key."""
    return snapshot.first_wins(read(spark, sf_dir, "documents").select("source", "lang", "doc_id"), ["source", "lang"], "doc_id")


@query("""SELECT d.doc_id AS entity_id, unnest(list_filter([CASE WHEN NOT known THEN 'unknown-id' END, CASE WHEN doc_id % 3 = 0 THEN 'duplicate-id' END, CASE WHEN doc_id % 4 = 0 THEN 'blank-value' END, CASE WHEN doc_id % 5 = 0 AND doc_id % 4 > 0 THEN 'unchanged-value' END, CASE WHEN known AND lang <> 'en' AND NOT (doc_id % 4 > 0 AND doc_id % 5 > 0 AND lang = 'x') THEN 'drift' END], lambda x: x IS NOT NULL)) AS code
FROM (SELECT l.doc_id + 3 AS doc_id, x.doc_id IS NOT NULL AS known, lang FROM (SELECT DISTINCT doc_id FROM labels) l LEFT JOIN (SELECT doc_id, any_value(lang) AS lang FROM documents GROUP BY 1) x ON x.doc_id = l.doc_id + 3) d""")
def patch_findings(spark, sf_dir):
    """What is wrong with a batch of patches."""
    k = F.col("doc_id")
    p = read(spark, sf_dir, "labels").select((k + 3).alias("doc_id")).distinct()
    new = F.when(k % 4 == 0, " ").when(k % 5 == 0, "en").otherwise("x")
    p = p.select(k.alias("concept_id"), F.lit("en").alias("old"), new.alias("new"), F.lit(1).alias("patch_set"), F.explode(F.when(k % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("again")).drop("again")
    d = read(spark, sf_dir, "documents").groupBy(k.alias("concept_id")).agg(F.any_value("lang").alias("target"))
    return patch.validate_patches(d, p).select("entity_id", "code")


@query("""SELECT (o_orderkey % 5000)::VARCHAR AS entry_id, string_agg(DISTINCT '2.' || (o_custkey % 8), ',' ORDER BY '2.' || (o_custkey % 8)) AS versions, 'II' AS parts, CASE WHEN bool_or(o_orderkey % 2 = 0) THEN 'latin' ELSE '' END AS actions FROM orders GROUP BY 1""")
def errata_entries(spark, sf_dir):
    """L4: errata lines to entries, with versions, parts and actions."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    doc = (F.col("o_custkey") % 8).cast("string")
    body = o.select(doc.alias("doc_id"), F.explode(F.array(F.struct((2 * k).alias("line"), F.concat((k % 5000).cast("string"), F.lit(" something")).alias("text")), F.struct((2 * k + 1).alias("line"), F.when(k % 2 == 0, "Latin term corrected").otherwise("no action").alias("text")))).alias("l")).select("doc_id", "l.*")
    heads = o.select(doc.alias("doc_id")).distinct().select("doc_id", F.explode(F.array(F.struct(F.lit(-2).cast("long").alias("line"), F.concat(F.lit("Corrections in version 2."), "doc_id").alias("text")), F.struct(F.lit(-1).cast("long").alias("line"), F.lit("PART II").alias("text")))).alias("l")).select("doc_id", "l.*")
    e = reconstruct.parse_errata(heads.union(body), [("latin term corrected", "latin")])
    return e.select("entry_id", *[F.array_join(c, ",").alias(c) for c in ("versions", "parts", "actions")])


@query(f"""SELECT 'age' AS rule_id, head AS modifier, count(*) OVER () > 1 AS enabled, head AS word FROM (SELECT DISTINCT head FROM {PARTS} WHERE head IN ('old', 'new', 'hot'))""")
def ordinal_rules(spark, sf_dir):
    """Every pair of a rule's ordinals mined; enabled if each has one word."""
    p = parts(spark, sf_dir).select("name", F.concat_ws(" ", "rest", "head").alias("term")).distinct()
    pairs = compose.ordinal_pairs(spark, ["old", "new", "hot"], "age")
    return compose.enable_ordinals(compose.mine_pairs(p, pairs), 1)


FINDINGS = """SELECT code, entity_id FROM (
SELECT 'access-status-full-text-conflict' AS code, 'N' || n_nationkey AS entity_id FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT 'access-status-inspection-conflict', 'N' || n_nationkey FROM nation WHERE n_nationkey % 5 = 0
UNION ALL SELECT 'identity-without-verified-audit', 'N' || n_nationkey FROM nation WHERE n_nationkey % 7 = 0
UNION ALL SELECT 'source-evidence-unusable', 'S' || s_suppkey || '/' || c FROM supplier, (VALUES ('c1'), ('c2')) v(c) WHERE s_nationkey % 5 = 0 OR s_suppkey % 13 = 0
UNION ALL SELECT 'unreproducible-claim', 'S' || s_suppkey || '/' || c FROM supplier, (VALUES ('c1'), ('c2')) v(c) WHERE s_suppkey % 13 = 0
UNION ALL SELECT 'preferred-claim-target-mismatch', 'S' || s_suppkey || '/c2' FROM supplier
UNION ALL SELECT 'stale-approval', 'S' || s_suppkey || '/' || t FROM supplier, (VALUES ('source-verification'), ('medical-review')) v(t) WHERE s_suppkey % 23 = 0
UNION ALL SELECT 'inactive-reviewer', 'S' || s_suppkey || '/' || t FROM supplier, (VALUES ('source-verification'), ('medical-review')) v(t) WHERE s_suppkey % 10 = 9
UNION ALL SELECT 'medical-review-requires-human', 'S' || s_suppkey || '/medical-review' FROM supplier WHERE s_suppkey % 19 = 0
UNION ALL SELECT unnest(['conflict-awaiting-adjudication', 'open-conflict-preferred-term']), 'S' || s_suppkey || '/x1' FROM supplier WHERE s_suppkey % 12 = 0
UNION ALL SELECT 'entry-key-mismatch', 'S' || s_suppkey FROM supplier WHERE s_suppkey % 4 = 0 UNION ALL SELECT 'orphan-concept-id', 'S' || s_suppkey FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT 'pivot-snapshot-mismatch', 'S' || s_suppkey FROM supplier WHERE s_suppkey % 5 > 0 AND s_suppkey % 3 = 0 UNION ALL SELECT 'mesh-membership-mismatch', 'S' || s_suppkey || '/zz' FROM supplier WHERE s_suppkey % 5 > 0 AND s_suppkey % 7 = 0
UNION ALL SELECT 'duplicate-normalized-term', 'S' || s_suppkey FROM supplier WHERE s_suppkey % 9 = 0 UNION ALL SELECT unnest(['unapproved-search-form', 'unapproved-search-form']), 'S' || s_suppkey || '/' || unnest(['Ab', 'ab']) FROM supplier WHERE s_suppkey % 9 = 0
UNION ALL SELECT unnest(['invalid-ascii-search-form', 'unapproved-search-form']), unnest(['S' || s_suppkey, 'S' || s_suppkey || '/é']) FROM supplier WHERE s_suppkey % 8 = 1)"""


@query(FINDINGS)
def registry_findings(spark, sf_dir):
    """Every rule over all tables of a registry."""
    t = supplier_registry(spark, sf_dir)
    k = F.substring("concept_id", 2, 20).cast("long")
    none = F.lit(None).cast("string")
    empty = F.array().cast("array<string>")
    t["sources"] = t["sources"].select(*[c for c in t["sources"].columns if c != "audit"], F.lit("t").alias("title"), none.alias("url"), none.alias("access_copy_of"), F.struct(F.col("audit.status").alias("status"), F.lit("2024-01-01").alias("verified_at"), F.lit("who").alias("verified_by")).alias("audit"))
    t["reviewers"] = t["reviewers"].select("*", F.lit("n").alias("display_name"), F.lit("r").alias("role"), F.lit("git:a").alias("evidence_ref"))
    name = F.trim("target.preferred")
    t["concepts"] = t["entries"].filter(k % 5 != 0).select("concept_id", F.when(k % 3 == 0, "older").otherwise(name).alias("name"), F.array(F.lit("e")).alias("elements"))
    e = t["entries"].select("concept_id", "mapping_status", "mapping_disposition", "revision", F.when(k % 4 == 0, "other").otherwise(F.col("concept_id")).alias("key0"), F.struct(name.alias("preferred"), F.when(k % 9 == 0, F.array(F.lit("Ab"), F.lit("ab"))).otherwise(empty).alias("aliases")).alias("pivot"), F.struct(F.col("target.preferred").alias("preferred"), empty.alias("aliases"), F.when(k % 8 == 1, F.array(F.lit("é"))).otherwise(empty).alias("ascii_forms")).alias("target"), F.when(k % 7 == 0, F.array(F.lit("e"), F.lit("zz"))).otherwise(F.array(F.lit("e"))).alias("elements"))
    t["entries"] = e.withColumn("key", F.when(k % 4 == 0, F.concat(F.lit("not "), "concept_id")).otherwise(F.col("concept_id"))).drop("key0")
    return registry.validate(t, CAPABILITIES, list(CAPABILITIES)).select("code", "entity_id")


@query(f"SELECT id, head AS tag, CASE WHEN rest IN ('ring', 'bolt') THEN rest END AS category FROM {PARTS}")
def tagged_heads(spark, sf_dir):
    """The first tag with a prefix, and the first category by priority."""
    p = parts(spark, sf_dir)
    tags = F.array(F.concat(F.lit("category:"), "rest"), F.concat(F.lit("head:"), "head"))
    return p.select("id", T.first_with_prefix(tags, "head").alias("tag"), T.first_of(tags, "category", ["bolt", "ring"]).alias("category"))


@query(r"""SELECT doc_id, k + 1 AS line, sha256(h || ':' || (k + 1) || ':' || sha256(t)) AS row_id FROM (SELECT doc_id, h, unnest(generate_series(0, len(a) - 1)) AS k, unnest(a) AS t
FROM (SELECT doc_id, sha256(text) AS h, string_split_regex(text, '\r?\n') AS a FROM documents WHERE text IS NOT NULL)) WHERE t <> ''""")
def raw_lines(spark, sf_dir):
    """A2: lines with numbers, and ids that a file's hash, the number and the line's hash make."""
    d = io.number_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return d.select("doc_id", F.col("line").cast("long").alias("line"), "row_id")


@query("""SELECT * FROM (SELECT 'X' || c_custkey AS concept_id, c_custkey AS evidence_id, array_to_string(list_filter([CASE WHEN c_custkey % 3 = 0 THEN 'exact' END, CASE WHEN c_custkey % 3 = 1 THEN 'normalised' END,
CASE WHEN c_custkey % 5 = 0 THEN 'source_code' END, CASE WHEN c_custkey % 4 = 0 THEN 'terminology_id' END], lambda x: x IS NOT NULL), ',') AS reasons FROM customer) WHERE reasons <> ''""")
def match_reasons(spark, sf_dir):
    """Matches by folded names that are not exact already, by id and by code."""
    c = read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")
    k, none = F.col("k"), F.array().cast("array<string>")
    name = F.when(k % 3 == 0, F.col("c_name")).when(k % 3 == 1, F.translate("c_name", "Cu", "Ćú")).otherwise(F.concat(F.lit("other "), k.cast("string")))
    code = lambda p, on: F.when(k % on == 0, F.array(F.concat(F.lit(p), k.cast("string")))).otherwise(none)
    e = c.select(k.alias("evidence_id"), F.struct(name.alias("preferred"), none.alias("aliases")).alias("pivot"), code("x", 4).alias("terminology_ids"), code(" X", 5).alias("source_codes"))
    m = match.match_entities(c.select(F.concat(F.lit("X"), k.cast("string")).alias("concept_id"), F.col("c_name").alias("name")), match.build_keys(e))
    return m.select("concept_id", "evidence_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"""SELECT head AS kind, rest AS component, count(DISTINCT p_brand) AS realisations, count(DISTINCT p_partkey) AS evidence, count(DISTINCT p_brand) > 1 AS ambiguous,
array_to_string(list_sort(list_distinct(list(p_brand)))[1:20], ',') AS examples FROM part JOIN {PARTS} ON id = p_partkey GROUP BY 1, 2""")
def component_lexicon(spark, sf_dir):
    """Realisations and evidence of each component, the first 20 examples, ambiguity."""
    p = parts(spark, sf_dir).join(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand"), "id")
    claims = p.select(F.col("head").alias("kind"), F.col("rest").alias("component"), F.col("p_brand").alias("term"), F.col("id").alias("evidence_id"))
    shown = report.truncated_lists(claims, ["kind", "component"], "term", 20)
    return compose.lexicon_summary(claims).join(shown, ["kind", "component"]).select("kind", "component", "realisations", "evidence", "ambiguous", F.array_join("shown", ",").alias("examples"))


@query("""SELECT c_mktsegment, array_to_string(list(w ORDER BY length(w) DESC, w)[1:8], ',') AS shown, count(*) AS "values", greatest(count(*) - 8, 0) AS more
FROM (SELECT DISTINCT c_mktsegment, (c_custkey * c_custkey)::VARCHAR AS w FROM customer) GROUP BY 1""")
def longest_first(spark, sf_dir):
    """The longest names first, eight of them, and how many more."""
    c = read(spark, sf_dir, "customer").select("c_mktsegment", (F.col("c_custkey") * F.col("c_custkey")).cast("string").alias("w"))
    t = report.truncated_lists(c, ["c_mktsegment"], "w", 8, [F.length("w").desc()])
    return t.select("c_mktsegment", F.array_join("shown", ",").alias("shown"), "values", "more")


@query("""SELECT p_partkey AS id, contains(p_name, 'ring') OR contains(p_name, 'old') OR contains(p_name, 'hot w') AS blacklisted FROM part""")
def blacklisted_names(spark, sf_dir):
    """Names that hold a forbidden string."""
    return parts(spark, sf_dir).select("id", T.contains_any("name", ["Ring", "öld", "HOT  w"]).alias("blacklisted"))


@query("""SELECT v.category, coalesce(n, 0) AS "rows" FROM (VALUES ('FINISHED'), ('OPEN'), ('LARGE'), ('NONE'), ('SEVERAL')) AS v(category) LEFT JOIN (SELECT CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_totalprice > 100000 THEN 'LARGE' ELSE 'NONE' END
WHEN o_totalprice > 100000 THEN 'SEVERAL' WHEN o_orderstatus = 'F' THEN 'FINISHED' ELSE 'OPEN' END AS category, count(*) AS n FROM orders GROUP BY 1) c ON c.category = v.category""")
def row_ledger(spark, sf_dir):
    """Every row in one category, or told as in none or several."""
    s = F.col("o_orderstatus")
    return metrics.exclusive_categories(read(spark, sf_dir, "orders"), {"FINISHED": s == "F", "OPEN": s == "O", "LARGE": F.col("o_totalprice") > 100000})


@query("""WITH s AS (SELECT o_orderkey AS id, (o_orderkey % 2 = 0)::INT + (o_orderkey % 3 = 0)::INT AS sets FROM orders)
SELECT id AS concept_id, sets::BIGINT AS sets, CASE WHEN sets > 1 AND id % 5 > 0 THEN 'EXPECTED_OVERLAP' WHEN sets > 1 THEN 'UNEXPECTED_OVERLAP' WHEN id % 4 = 1 THEN 'MISSING_OVERLAP' ELSE 'SINGLE' END AS state, NULL AS side FROM s WHERE sets > 0 OR id % 4 = 1
UNION ALL SELECT id, NULL, NULL, CASE WHEN id % 2 = 0 THEN 'LEFT' ELSE 'RIGHT' END FROM s WHERE sets = 1""")
def joined_patches(spark, sf_dir):
    """H3, H4: patch sets put together, with the overlap that is expected, and what one set alone has."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("concept_id"))
    k, none = F.col("concept_id"), F.lit(None).cast("string")
    a, b = o.filter(k % 2 == 0), o.filter(k % 3 == 0)
    joined = patch.joined_sets(a.withColumn("patch_set", F.lit(1)).union(b.withColumn("patch_set", F.lit(2))), o.filter(((k % 6 == 0) & (k % 5 > 0)) | (k % 4 == 1)))
    return joined.withColumn("side", none).union(patch.set_difference(a, b).select("concept_id", F.lit(None).cast("long"), none, "side"))


@query("""SELECT o_custkey::VARCHAR AS component, arg_max(t, layer) AS term, max(layer) AS layer FROM (SELECT o_custkey, o_orderstatus AS layer, min(o_orderpriority) AS t FROM orders GROUP BY 1, 2) GROUP BY 1""")
def verified_lexicon(spark, sf_dir):
    """Verified terms, later layers over earlier ones."""
    return compose.verified_lexicon(read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("component"), F.col("o_orderpriority").alias("term"), F.col("o_orderstatus").alias("layer")))


@query("""SELECT v.tier, coalesce(n, 0) AS "rows", coalesce(k, 0) AS targets, coalesce(b, 0) AS overlap, coalesce(k, 0) - coalesce(b, 0) AS gain FROM (VALUES ('PROMOTED'), ('REVIEW'), ('BLOCKED'), ('DUPLICATE')) AS v(tier)
LEFT JOIN (SELECT CASE WHEN l_returnflag = 'R' THEN 'BLOCKED' WHEN l_quantity > 25 THEN 'PROMOTED' ELSE 'REVIEW' END AS tier, count(*) AS n, count(DISTINCT l_partkey) AS k, count(DISTINCT CASE WHEN p_size < 20 THEN l_partkey END) AS b FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1) c ON c.tier = v.tier""")
def promoted_rows(spark, sf_dir):
    """One disposition a row, and the targets that promoted rows add to a frozen baseline."""
    tier = F.when(F.col("l_returnflag") == "R", "BLOCKED").when(F.col("l_quantity") > 25, "PROMOTED").otherwise("REVIEW")
    d = read(spark, sf_dir, "lineitem").select(tier.alias("tier"), F.concat_ws(":", "l_orderkey", "l_linenumber").alias("row_id"), F.col("l_partkey").alias("target_id"))
    frozen = read(spark, sf_dir, "part").filter("p_size < 20").select(F.col("p_partkey").alias("target_id"))
    return metrics.tier_coverage(d, ["PROMOTED", "REVIEW", "BLOCKED", "DUPLICATE"], frozen)


@query("""SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def corpus_by_source(spark, sf_dir):
    """A corpus written as JSON lines, a folder for each source, and read back."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = io.shared_path(spark, "by-source")
    io.write_by_source(c, path, "c_mktsegment")
    return io.read_by_source(spark, path, "c_custkey long, c_name string, c_mktsegment string")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'A01.' || o_orderkey % 7 END AS code,
CASE o_orderkey % 5 WHEN 0 THEN 'Neck ' || o_orderkey WHEN 1 THEN 'part' WHEN 2 THEN 'OF it' WHEN 3 THEN '## title ' || o_orderkey ELSE 'see A01.2 headless' END AS rest,
CASE WHEN o_orderkey % 5 = 2 THEN (o_orderkey % 10)::VARCHAR END AS counter, o_orderkey % 5 = 3 AS header, o_orderkey % 5 IN (0, 2) AS residue FROM orders""")
def line_kinds(spark, sf_dir):
    """A code at the line's start, counters, headers, and pivot words left in a target."""
    k = F.col("o_orderkey")
    n = k.cast("string")
    code = F.concat(F.lit("A01."), (k % 7).cast("string"))
    text = F.when(k % 5 == 0, F.concat(F.lit(" * "), code, F.lit("  Neck "), n)).when(k % 5 == 1, F.concat(code, F.lit(" part "))).when(k % 5 == 2, F.concat((k % 10).cast("string"), F.lit("  OF it")))
    text = text.when(k % 5 == 3, F.concat(F.lit("## title "), n)).otherwise("see A01.2 headless")
    f = reconstruct.line_facts(text, r"A\d{2}\.\d", r"^(\d)(?:\s+(.*))?$", [r"^##"], r"\b(?:of|neck|head)\b")
    return read(spark, sf_dir, "orders").select(k.alias("id"), f.alias("f")).select("id", "f.*")


@query("""SELECT total, named, round(100 * named / total, 2) AS named_pct, errors, changed_files, errors = 0 AND changed_files = 0 AS safe FROM
(SELECT count(*) AS total, count(*) FILTER (s_suppkey % 3 = 0) AS named FROM supplier), (SELECT count(*) FILTER (o_orderstatus <> 'F') AS errors FROM orders),
(SELECT count(*) FILTER (p_partkey % 5 = 0 OR p_partkey % 7 = 0) AS changed_files FROM part)""")
def release_safety(spark, sf_dir):
    """Counters over a registry, its errors, and protected files that are not as planned."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select(k.cast("string").alias("path"), F.md5("p_name").alias("sha256"), k)
    planned = p.filter(k % 7 > 0).withColumn("sha256", F.when(k % 5 == 0, "other").otherwise(F.col("sha256")))
    found = read(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "F", "warning").otherwise("error").alias("severity"))
    return metrics.release_safety(read(spark, sf_dir, "supplier"), {"named": F.col("s_suppkey") % 3 == 0}, found, io.compare_manifest(planned, p))
