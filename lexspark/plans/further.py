"""Further registered queries: keys and variants, repair and quality states, the release gate, rebuilt rows, registry rules.

Parts stand for named entities, suppliers for entries of a registry, nations for its sources. Which
field of a row is wrong follows from its number, so that every branch is met at any scale.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import compose, consensus, metrics, quality, reconstruct, registry, search, targets
from lexspark.plans.queries import query, read

SIDES = [("left", ["small"]), ("right", ["large"])]
FAMILIES = [("ROUND", r"ring|nut"), ("LONG", r"bolt|pin")]


def parts(spark, sf_dir):
    """id, name, head, rest of every part."""
    return compose.head_and_rest(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


PARTS = "(SELECT p_partkey AS id, p_name AS name, split_part(p_name, ' ', 1) AS head, split_part(p_name, ' ', 2) AS rest FROM part)"


@query(r"""WITH d AS (SELECT c_custkey AS id, '  ' || c_name || ' –  “' || c_mktsegment || '” ‘' || c_nationkey || '’ ( Part ) , Tail ; End  ' AS s FROM customer),
e AS (SELECT *, trim(regexp_replace(lower(s), '\s+', ' ', 'g')) AS exact, trim(regexp_replace(regexp_replace(replace(s, '–', '-'), '\s*-\s*', '-', 'g'), '\s+', ' ', 'g')) AS agreed FROM d),
t AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(exact, ' *([,;:]) *', '\1 ', 'g'), '\( *(.*?) *\)', '(\1)', 'g'), '\s+', ' ', 'g')) AS tight FROM e)
SELECT id, exact, replace(replace(replace(replace(replace(exact, '–', '-'), '“', '"'), '”', '"'), '‘', ''''), '’', '''') AS scope_safe,
trim(regexp_replace(regexp_replace(lower(agreed), '[-,.;:()\[\]/]+', ' ', 'g'), '\s+', ' ', 'g')) AS surface, trim(regexp_replace(regexp_replace(lower(s), '[()\[\],.;:/–-]+', ' ', 'g'), '\s+', ' ', 'g')) AS pivot,
regexp_replace(trim(regexp_replace(s, '\s+', ' ', 'g')), ' ([,.;:)])', '\1', 'g') AS clean, tight, trim(regexp_replace(regexp_replace(tight, '\([^)]*\)', ' ', 'g'), '\s+', ' ', 'g')) AS bare FROM t""")
def name_keys(spark, sf_dir):
    """The keys of a name with dashes, quotes, brackets and odd spaces."""
    c = read(spark, sf_dir, "customer")
    s = F.concat(F.lit("  "), "c_name", F.lit(" –  “"), "c_mktsegment", F.lit("” ‘"), F.col("c_nationkey").cast("string"), F.lit("’ ( Part ) , Tail ; End  "))
    d = c.select(F.col("c_custkey").alias("id"), s.alias("s"))
    pair = T.match_key_pair("s")
    return d.select("id", T.exact_key("s").alias("exact"), T.scope_safe_key("s").alias("scope_safe"), T.surface_key("s").alias("surface"), T.pivot_key("s").alias("pivot"), T.clean_target("s").alias("clean"), F.get(pair, F.lit(0)).alias("tight"), F.get(pair, F.lit(1)).alias("bare"))


@query(f"""WITH f AS (SELECT id, unnest([name, regexp_replace(name, ' (ring|bolt)$', ''), regexp_replace(name, '^(small|large) ', ''), regexp_replace(regexp_replace(name, ' (ring|bolt)$', ''), '^(small|large) ', '')]) AS value, unnest([1, 2, 3, 4]) AS i FROM {PARTS})
SELECT id, row_number() OVER (PARTITION BY id ORDER BY min(i))::INT AS tier, value FROM f WHERE value <> '' GROUP BY id, value""")
def alias_variants(spark, sf_dir):
    """Variants of a name in order, each once."""
    v = T.alias_variants("name", "^(small|large) ", " (ring|bolt)$")
    return parts(spark, sf_dir).select("id", F.explode(v).alias("v")).select("id", "v.tier", "v.value")


@query(f"""SELECT id, CASE head WHEN 'small' THEN 'left' WHEN 'large' THEN 'right' ELSE 'unsided' END AS laterality, CASE WHEN head IN ('small', 'large') THEN rest ELSE name END AS base,
CASE WHEN regexp_matches(name, 'ring|nut') THEN 'ROUND' WHEN regexp_matches(name, 'bolt|pin') THEN 'LONG' ELSE 'OTHER' END AS family, head IN ('old', 'new') AS cue, CASE WHEN head = 'hot' THEN 'of ' || rest ELSE name END AS wrapped, head = 'cold' AS changed,
head || ' ' || rest AS words, 'P' AS prefix, id::VARCHAR AS hint FROM {PARTS}""".replace("CASE WHEN head = 'hot' THEN 'of ' || rest ELSE name END AS wrapped", "CASE WHEN head = 'cold' THEN rest ELSE name END AS unwrapped"))
def name_facts(spark, sf_dir):
    """What a name says by rules."""
    p = parts(spark, sf_dir)
    w = T.strip_wrapper("name", "^cold (.*)$")
    return p.select(
        "id", T.laterality_of("name", SIDES).alias("laterality"), T.base_name("name", ["small", "large"]).alias("base"), T.first_rule("name", FAMILIES, "OTHER").alias("family"), targets.name_cue("name", "^(old|new) ").alias("cue"),
        w["value"].alias("unwrapped"), w["changed"].alias("changed"), F.array_join(T.tokens("name"), " ").alias("words"), T.id_prefix(F.concat(F.lit("P."), F.col("id").cast("string"))).alias("prefix"), T.id_hint(F.concat(F.lit("see id="), F.col("id").cast("string")), r"id=(\d+)").alias("hint"))


@query(f"""SELECT id, array_to_string(list_filter([head, rest, 'part'], lambda x: NOT list_contains(['part', 'ring', 'small'], x)), ' ') AS only_here, array_to_string(list_filter(['small', 'old'], lambda x: contains(name, x)), ' ') AS guarded,
CASE WHEN id % 3 = 0 THEN 'pre-' || head || ' ' || rest || ',' ELSE 'pre ' || head || ' ' || rest || ',' END AS joined, contains(' ' || name || ' ', ' ring ') AS has_ring FROM {PARTS}""")
def word_lists(spark, sf_dir):
    """Multiset difference, joined fragments, phrases, protected words."""
    p = parts(spark, sf_dir)
    pieces = F.array(F.when(F.col("id") % 3 == 0, "pre-").otherwise("pre"), F.col("head"), F.concat("rest", F.lit(" ,")))
    return p.select("id", F.array_join(T.multiset_diff(F.array("head", "rest", F.lit("part")), F.array(*[F.lit(x) for x in ("part", "ring", "small")])), " ").alias("only_here"), F.array_join(T.protected("name", ["small", "old"]), " ").alias("guarded"), T.join_fragments(pieces).alias("joined"), T.has_phrase("name", F.lit("ring")).alias("has_ring"))


@query(f"""WITH t AS (SELECT id, unnest([name, CASE WHEN id % 2 = 0 THEN 'alias ' || id ELSE ' ' END]) AS term, 'term' AS kind FROM {PARTS} UNION ALL SELECT id, unnest(['other ' || rest, head]), 'synonym' FROM {PARTS})
SELECT id, kind, term FROM t WHERE trim(term) <> ''""")
def terms_and_synonyms(spark, sf_dir):
    """Preferred terms with aliases, and synonyms split and made distinct."""
    p = parts(spark, sf_dir)
    aliases = F.array(F.when(F.col("id") % 2 == 0, F.concat(F.lit("alias "), F.col("id").cast("string"))).otherwise(" "), F.lit(None).cast("string"))
    said = F.concat(F.lit(" other  "), "rest", F.lit("; ;"), "head", F.lit(";"), "name", F.lit(" ; other "), "rest")
    a = p.select("id", F.lit("term").alias("kind"), F.explode(T.terms("name", aliases)).alias("term"))
    return a.union(p.select("id", F.lit("synonym"), F.explode(T.split_synonyms(said, "name"))))


@query("""SELECT o_orderkey AS id, o_orderkey % 3 = 0 AS placeholder, o_orderkey % 2 = 0 AS iso_date, o_orderkey % 5 <> 0 AS url, o_orderkey % 7 <> 0 OR o_orderkey % 4 = 0 AS exact_locator, o_orderkey % 7 <> 0 AS page_supported FROM orders""")
def field_checks(spark, sf_dir):
    """Stand-ins, dates, addresses, locators."""
    k = F.col("o_orderkey")
    none = F.lit(None).cast("string")
    at = F.struct(F.when(k % 7 != 0, 3).alias("page"), F.when(k % 4 == 0, "s").alias("section"), *[none.alias(c) for c in ("plate", "entry_id", "nomenclature_id", "chapter", "table", "url")])
    return read(spark, sf_dir, "orders").select(
        k.alias("id"), T.is_placeholder(F.when(k % 3 == 0, " TBD ").otherwise("done")).alias("placeholder"), T.is_iso_date(F.when(k % 2 == 0, "2024-02-29").otherwise("2023-02-29")).alias("iso_date"),
        T.is_url(F.when(k % 5 != 0, "https://x.org/a").otherwise("ftp://x")).alias("url"), T.exact_locator(at).alias("exact_locator"), T.locator_supported(F.lit("PAGE"), at).alias("page_supported"))


REPAIRED = f"""SELECT id, CASE id % 5 WHEN 0 THEN rest || ' ' || head WHEN 1 THEN 'core ' || rest WHEN 2 THEN 'vena ' || rest WHEN 3 THEN rest || ' end' ELSE 'a ' || rest END AS repaired,
CASE id % 5 WHEN 0 THEN 'DROP_CONNECTOR' WHEN 1 THEN 'MOVE_HEAD' WHEN 2 THEN 'FIX_TERM' WHEN 3 THEN 'DEDUPLICATE_HEAD' ELSE 'LOWER_INTERIOR' END AS actions FROM {PARTS}"""


def broken(p):
    """Strings that each need one repair."""
    k, rest = F.col("id") % 5, F.col("rest")
    return F.when(k == 0, F.concat_ws(" ", rest, F.lit("o"), "head")).when(k == 1, F.concat_ws(" ", rest, F.lit("core"))).when(k == 2, F.concat_ws(" ", F.lit("vein"), rest)).when(k == 3, F.concat_ws(" ", rest, rest, F.lit("end"))).otherwise(F.concat_ws(" ", F.lit("a"), F.initcap(rest)))


HOW = {"connector": "o", "heads": ("core",), "replacements": (("vein", "vena"),)}


@query(REPAIRED)
def repairs(spark, sf_dir):
    """Strings repaired step by step, with the log of what was done."""
    p = parts(spark, sf_dir)
    return quality.repair(p.withColumn("target", broken(p)), **HOW).select("id", "repaired", F.array_join("actions", ",").alias("actions"))


@query(f"""WITH r AS ({REPAIRED}), s AS (SELECT p.id, repaired, CASE WHEN p.id % 7 = 0 THEN 'CONFLICT_PRESERVED' WHEN p.id % 5 NOT IN (3, 4) THEN 'CLEAR' WHEN p.id % 2 = 0 THEN 'RETAIN' ELSE 'REPAIRED' END AS status,
CASE p.id % 5 WHEN 0 THEN rest || ' o ' || head WHEN 1 THEN rest || ' core' WHEN 2 THEN 'vein ' || rest WHEN 3 THEN rest || ' ' || rest || ' end' ELSE 'a ' || upper(rest[1]) || rest[2:] END AS target FROM {PARTS} p JOIN r ON r.id = p.id)
SELECT id AS concept_id, status, CASE WHEN status = 'REPAIRED' THEN repaired ELSE target END AS target, CASE id % 5 WHEN 3 THEN 'REPEATED_WORD' WHEN 4 THEN 'INTERIOR_CAPITAL' END AS before FROM s""")
def quality_states(spark, sf_dir):
    """Clear, repaired, retained or preserved; only a repair that clears all findings changes a string."""
    p = parts(spark, sf_dir)
    r = p.select(F.col("id").alias("concept_id"), F.col("name").alias("pivot"), broken(p).alias("target"), (F.col("id") % 2 != 0).alias("generated"), (F.col("id") % 7 == 0).alias("conflict"))
    table = spark.createDataFrame([("FORBIDDEN", "no such word", None, "x")], "code string, when_pivot string, needs string, forbids string")
    return quality.qa_status(r, table, **HOW).select("concept_id", "status", "target", F.array_join("before", ",").alias("before"))


CAPABILITIES = {"identity": "identity", "target-preferred": "target_preferred"}


def supplier_registry(spark, sf_dir):
    """A registry of suppliers, evidenced by nations: a table a kind."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("n"), F.col("s_name").alias("name"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("concept_id"))
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"))
    k, none = F.col("k"), F.lit(None).cast("string")
    text = lambda c: F.concat(F.lit("N"), F.col(c).cast("string"))
    sources = n.select(
        text("n").alias("id"), F.lit("target-authoritative").alias("class"), F.lit("r1").alias("revision"), F.lit("authoritative").alias("authority_tier"), F.when(F.col("n") % 5 == 0, "METADATA_ONLY").otherwise("FULL_ACCESS").alias("access_status"),
        F.lit("PAGE").alias("locator_capability"), F.lit(True).alias("identity_verified"), F.lit(True).alias("full_text_available"), F.lit(True).alias("content_inspected"),
        F.struct(*[F.lit(c in CAPABILITIES.values()).alias(c) for c in ("identity", "canonical", "target_preferred", "corroboration", "machine_discovery")]).alias("capabilities"), F.struct(F.when(F.col("n") % 7 == 0, "UNVERIFIED").otherwise("VERIFIED").alias("status")).alias("audit"))
    at = F.struct(F.when(k % 13 != 0, 1).alias("page"), *[none.alias(c) for c in ("plate", "entry_id", "nomenclature_id", "chapter", "section", "table", "url")])
    claim = F.explode(F.array(F.struct(F.lit("c1").alias("id"), F.lit("identity").alias("type"), F.col("concept_id").alias("target")), F.struct(F.lit("c2").alias("id"), F.lit("target-preferred").alias("type"), F.col("name").alias("target"))))
    claims = s.select("concept_id", "name", text("n").alias("source_id"), F.lit("r1").alias("source_revision"), at.alias("locator"), F.lit("SUPPORTED").alias("evidence_disposition"), F.when(k % 11 == 0, "PENDING").otherwise("VERIFIED").alias("review_state"))
    claims = claims.select("*", claim.alias("c")).select("concept_id", "source_id", "source_revision", "locator", "evidence_disposition", "review_state", "c.*")
    entries = s.select("concept_id", F.struct(F.concat(F.lit(" "), F.col("name")).alias("preferred")).alias("target"), F.when(k % 2 == 0, "MAPPED").otherwise("UNMAPPED").alias("mapping_status"), F.when(k % 3 != 0, "CONFIRMED_NO_EQUIVALENT").otherwise("UNRESOLVED").alias("mapping_disposition"), F.lit("v2").alias("revision"))
    mappings = s.filter("k % 2 = 0").select("concept_id", F.lit("m1").alias("id"), F.lit("LOCAL").alias("namespace"), F.col("concept_id").alias("identifier"), F.lit("r1").alias("source_revision"), F.lit("exact").alias("relation"), F.when(k % 17 == 0, "CANDIDATE").otherwise("VERIFIED").alias("disposition"), F.array(F.lit("c1")).alias("evidence_claim_ids"))
    audits = s.select("concept_id", F.explode(F.array(F.lit("source-verification"), F.lit("medical-review"))).alias("type"), F.lit("PASSED").alias("status"), F.lit("APPROVE").alias("decision"), F.concat(F.lit("R"), (k % 10).cast("string")).alias("reviewer_id"), F.lit("2024-01-01").alias("reviewed_at"), F.when(k % 23 == 0, "v1").otherwise("v2").alias("entry_revision"), F.array(F.lit("c1"), F.lit("c2")).alias("claim_ids"), (k % 19 == 0).alias("automated"))
    reviewers = s.select((k % 10).alias("r")).distinct().select(F.concat(F.lit("R"), F.col("r").cast("string")).alias("id"), F.when(F.col("r") == 9, "INACTIVE").otherwise("ACTIVE").alias("status"), F.array(F.lit("*")).alias("authorization_scope"))
    conflicts = s.filter("k % 6 = 0").select("concept_id", F.lit("x1").alias("id"), F.when(k % 12 == 0, "OPEN").otherwise("REJECTED").alias("status"), none.alias("decision"), none.alias("rationale"), F.lit("R1").alias("reviewer_id"), F.lit("v2").alias("entry_revision"), F.array(F.lit("c1")).alias("claim_ids"))
    return {"sources": sources, "claims": claims, "entries": entries, "mappings": mappings, "audits": audits, "reviewers": reviewers, "conflicts": conflicts}


GATES = """(SELECT s_suppkey AS k, 'S' || s_suppkey AS concept_id, s_name, s_nationkey % 5 <> 0 AND s_nationkey % 7 <> 0 AND s_suppkey % 11 <> 0 AND s_suppkey % 13 <> 0 AS approved,
s_suppkey % 10 <> 9 AND s_suppkey % 19 <> 0 AND s_suppkey % 23 <> 0 AS audited FROM supplier)"""


@query(f"SELECT concept_id, unnest(['c1', 'c2']) AS id, approved FROM {GATES}")
def claim_approvals(spark, sf_dir):
    """Claims from a usable source, verified, at an exact place."""
    t = supplier_registry(spark, sf_dir)
    return registry.claim_gate(t["claims"], t["sources"], CAPABILITIES).select("concept_id", "id", "approved")


@query(f"SELECT concept_id, CASE WHEN k % 2 = 0 THEN k % 17 <> 0 AND approved ELSE k % 3 <> 0 AND approved END AS mapping_ok FROM {GATES}")
def mapping_approvals(spark, sf_dir):
    """Mappings whose evidence is approved, or confirmed to have no equivalent."""
    t = supplier_registry(spark, sf_dir)
    return registry.mapping_gate(t["entries"], t["mappings"], registry.claim_gate(t["claims"], t["sources"], CAPABILITIES), {})


@query(f"SELECT concept_id, unnest(['source-verification', 'medical-review']) AS type, audited AS audit_ok FROM {GATES}")
def audit_approvals(spark, sf_dir):
    """Audits by active people for the current revision."""
    t = supplier_registry(spark, sf_dir)
    return registry.audit_gate(t["entries"], t["audits"], t["reviewers"], t["claims"], list(CAPABILITIES))


@query(f"SELECT concept_id, k % 12 <> 0 AS conflicts_ok FROM {GATES}")
def conflict_states(spark, sf_dir):
    """Conflicts settled or rejected."""
    t = supplier_registry(spark, sf_dir)
    return registry.conflict_gate(t["entries"], t["conflicts"], t["reviewers"])


@query(f"""SELECT concept_id, approved AS term_ok, approved AND CASE WHEN k % 2 = 0 THEN k % 17 <> 0 ELSE k % 3 <> 0 END AS mapping_ok, audited AS audits_ok, k % 12 <> 0 AS conflicts_ok,
approved AND CASE WHEN k % 2 = 0 THEN k % 17 <> 0 ELSE k % 3 <> 0 END AND audited AND k % 12 <> 0 AS released FROM {GATES}""")
def release_gate(spark, sf_dir):
    """Released only if every gate is open."""
    return registry.release_gate(supplier_registry(spark, sf_dir), CAPABILITIES, {})


@query(f"""SELECT DISTINCT concept_id, term, lower(term) AS key FROM (SELECT concept_id, unnest([s_name, concept_id, 'shown ' || k]) AS term FROM {GATES} UNION ALL SELECT concept_id, s_name FROM {GATES} WHERE approved
UNION ALL SELECT concept_id, 'X' || k FROM {GATES} WHERE approved AND k % 2 = 0 AND k % 17 <> 0 UNION ALL SELECT concept_id, 'E' || k FROM {GATES} g JOIN supplier s ON s_suppkey = k WHERE approved AND s_acctbal > 0 AND s_nationkey > 3)""")
def search_surface(spark, sf_dir):
    """Names, ids and shown names; aliases, mapped identifiers and element ids only with an approved claim of their own."""
    t = supplier_registry(spark, sf_dir)
    c = t["entries"].select("concept_id", F.trim("target.preferred").alias("name"))
    number = F.substring("concept_id", 2, 20)
    s = read(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("concept_id"), "s_acctbal", "s_nationkey")
    # Claims of their own for the mapped identifier, of everyone, and for the element, of those with an account in credit.
    first = t["claims"].filter("id = 'c1'")
    claims = t["claims"].unionByName(first.withColumns({"id": F.lit("c3"), "target": F.concat(F.lit("X"), number)}))
    claims = claims.unionByName(first.join(s.filter("s_acctbal > 0").select("concept_id"), "concept_id", "left_semi").withColumns({"id": F.lit("c4"), "target": F.concat(F.lit("E"), number)}))
    gated = registry.claim_gate(claims, t["sources"], CAPABILITIES)
    mappings = registry.approved_mappings(t["mappings"].withColumns({"identifier": F.concat(F.lit("X"), number), "evidence_claim_ids": F.array(F.lit("c3"))}), gated, {})
    elements = s.filter("s_nationkey > 3").select("concept_id", F.concat(F.lit("E"), number).alias("element_id"))
    display = c.select("concept_id", F.concat(F.lit("shown "), number).alias("display_name"))
    aliases = c.select("concept_id", F.lit("target-preferred").alias("type"), F.col("name").alias("target")).union(c.select("concept_id", F.lit("identity"), F.lit("never approved")))
    return registry.search_terms(c, display, aliases, gated, mappings, elements)


@query("""SELECT code, entity_id FROM (SELECT unnest(list_filter([CASE WHEN k % 4 = 0 THEN 'invalid-reviewer-identity' END, CASE WHEN k % 5 = 0 THEN 'invalid-reviewer-status' END, CASE WHEN k % 6 = 0 THEN 'invalid-reviewer-evidence' END], lambda x: x IS NOT NULL)) AS code, k::VARCHAR AS entity_id FROM (SELECT s_suppkey AS k FROM supplier))
UNION ALL SELECT 'duplicate-reviewer-id', s_suppkey::VARCHAR FROM supplier WHERE s_suppkey % 9 = 0
UNION ALL SELECT unnest(list_filter([CASE WHEN k % 4 = 1 THEN 'invalid-candidate-origin-method' END, CASE WHEN k % 5 = 2 THEN 'invalid-candidate-origin-date' END, CASE WHEN n % 5 = 0 THEN 'unresolved-candidate-origin-source' END], lambda x: x IS NOT NULL)), 'S' || k || '/o1' FROM (SELECT s_suppkey AS k, s_nationkey AS n FROM supplier)
UNION ALL SELECT unnest(list_filter([CASE WHEN k % 4 = 2 THEN 'invalid-research-row' END, CASE WHEN k % 5 = 3 THEN 'invalid-research-bucket' END, CASE WHEN k % 6 = 4 THEN 'invalid-research-candidate-term' END], lambda x: x IS NOT NULL)), 'S' || k FROM (SELECT s_suppkey AS k FROM supplier)""")
def people_and_origins(spark, sf_dir):
    """K3, K8: reviewers, candidate origins, research dispositions."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("n"))
    k, none = F.col("k"), F.lit(None).cast("string")
    r = s.withColumn("again", F.explode(F.when(k % 9 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).select(
        k.cast("string").alias("id"), F.when((k % 4 == 0) & (F.col("again") == 1), " ").otherwise("x").alias("display_name"), F.lit("r").alias("role"), F.when((k % 5 == 0) & (F.col("again") == 1), "AWAY").otherwise("ACTIVE").alias("status"), F.when((k % 6 == 0) & (F.col("again") == 1), "on paper").otherwise("git:abc").alias("evidence_ref"))
    o = s.select(F.concat(F.lit("S"), k.cast("string")).alias("concept_id"), F.lit("o1").alias("id"), F.when(k % 4 == 1, "oracle").otherwise("human").alias("method"), F.when(k % 5 == 2, "2024-13-01").otherwise("2024-01-01").alias("created_at"), F.concat(F.lit("N"), F.col("n").cast("string")).alias("source_id"))
    known = read(spark, sf_dir, "nation").filter("n_nationkey % 5 <> 0").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"))
    q = s.select(F.concat(F.lit("S"), k.cast("string")).alias("concept_id"), F.lit("a").alias("artifact"), F.when(k % 4 == 2, 0).otherwise(7).alias("row"), F.when(k % 5 == 3, "?").otherwise("GAP").alias("bucket"), F.when(k % 6 == 4, " ").alias("candidate_term"), none.alias("suggested_form"))
    found = registry.validate({"reviewers": r}, {}, []).union(registry.origin_findings(o, known)).union(registry.research_findings(q, ["GAP"]))
    return found.select("code", "entity_id")


@query("""WITH t AS (SELECT p_name AS key, count(DISTINCT p_partkey) AS n, count(DISTINCT CASE WHEN p_size % 2 = 0 THEN p_partkey END) AS r, bool_and(p_retailprice > 950) FILTER (p_size % 2 = 0) AS ok FROM part GROUP BY 1)
SELECT 'normalized-alias-collision' AS code, key AS entity_id, 'warning' AS severity FROM t WHERE n > 1 UNION ALL SELECT 'release-normalized-alias-collision', key, 'error' FROM t WHERE r > 1 AND NOT ok""")
def term_collisions(spark, sf_dir):
    """Search terms on several concepts, an error among released ones unless permitted."""
    p = read(spark, sf_dir, "part").withColumn("concept_id", F.col("p_partkey").cast("string"))
    t = p.select("concept_id", F.col("p_name").alias("term"), T.fold_key("p_name").alias("key"))
    out = registry.collision_findings(t, p.filter("p_size % 2 = 0").select("concept_id"), p.filter("p_retailprice > 950").select("concept_id", F.col("p_name").alias("term")))
    return out.select("code", "entity_id", "severity")


@query("""SELECT 'release-' || c_name || '-mismatch' AS code, c_name AS entity_id FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0""")
def release_bindings(spark, sf_dir):
    """Bindings of a manifest against current revisions: changed and missing ones."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    bound = c.filter(k % 5 != 0).select(F.col("c_name").alias("name"), k.cast("string").alias("value"))
    now = c.select(F.col("c_name").alias("name"), F.when(k % 3 == 0, "changed").otherwise(k.cast("string")).alias("value"))
    return registry.release_findings(bound, now).select("code", "entity_id")


@query("""SELECT s_suppkey::VARCHAR AS entity_id, unnest(list_filter([CASE WHEN s_suppkey % 7 = 0 THEN 'pilot-unknown-concept' END, CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 3 = 0 THEN 'pilot-elements-differ' END, CASE WHEN s_suppkey % 4 = 0 THEN 'pilot-unsupported-tag' END, CASE WHEN s_suppkey % 5 = 0 THEN 'pilot-forbidden-field' END], lambda x: x IS NOT NULL)) AS code FROM supplier""")
def pilot_sample(spark, sf_dir):
    """A frozen sample against the concepts."""
    k = F.col("s_suppkey")
    s = read(spark, sf_dir, "supplier")
    pilot = s.select(k.cast("string").alias("concept_id"), F.lit("left hand").alias("name"), F.array(k.cast("string"), F.lit("e")).alias("elements"), F.when(k % 4 == 0, F.array(F.lit("right"))).otherwise(F.array(F.lit("left"))).alias("tags"), F.when(k % 5 == 0, "term").alias("target"))
    concepts = s.filter(k % 7 != 0).select(k.cast("string").alias("concept_id"), F.array(k.cast("string"), F.when(k % 3 == 0, "other").otherwise("e")).alias("elements"))
    return registry.pilot_findings(pilot, concepts, {"left": "left", "right": "right"}, ["target"]).select("entity_id", "code")


@query(f"""SELECT id AS concept_id, CASE WHEN id % 6 = 0 THEN 'SOURCE_CONFLICT' WHEN id % 6 = 1 THEN 'SOURCE_VARIANT' WHEN id % 6 = 2 THEN 'DIRECT' WHEN id % 4 = 3 THEN 'STRUCTURE_UNBLOCKED' WHEN id % 5 = 0 THEN 'DERIVED' ELSE 'OPEN' END AS disposition,
CASE WHEN id % 6 = 2 THEN name WHEN id % 6 > 2 AND id % 4 = 3 THEN 'u ' || name WHEN id % 6 > 2 AND id % 5 = 0 THEN 'd ' || name WHEN id % 7 = 0 THEN 's ' || name WHEN id % 3 = 0 THEN 'c ' || name END AS term,
CASE WHEN id % 6 = 2 OR id % 6 > 2 AND (id % 4 = 3 OR id % 5 = 0) THEN 'VERIFIED' WHEN id % 7 = 0 THEN 'PROVISIONAL_SOURCED' WHEN id % 3 = 0 THEN 'PROVISIONAL_TRANSLATED' ELSE 'NO_TRANSLATION' END AS evidence_status FROM {PARTS}""")
def assembled_terms(spark, sf_dir):
    """One disposition and term an entity, and what class of evidence it is."""
    p = parts(spark, sf_dir).select(F.col("id").alias("concept_id"), "name")
    k = F.col("concept_id")
    said = lambda d, x: d.select("concept_id", F.concat(F.lit(x), "name").alias("term"))
    direct = p.filter(k % 6 < 3).select("concept_id", F.when(k % 6 == 0, "CONFLICT").when(k % 6 == 1, "VARIANT").otherwise("DIRECT").alias("kind"), F.col("name").alias("term"))
    a = compose.assemble(p, direct, said(p.filter(k % 4 == 3), "u "), said(p.filter(k % 5 == 0), "d "))
    return compose.evidence_class(a, said(p.filter(k % 7 == 0), "s "), said(p.filter(k % 3 == 0), "c ")).join(a.select("concept_id", "disposition"), "concept_id").select("concept_id", "disposition", "term", "evidence_status")


@query(f"""SELECT id AS row_id, 'k' || (id // 2) AS concept_id, 'STRUCTURE_ONLY' AS method FROM {PARTS} WHERE id % 3 = 0 AND id % 4 <> 0""")
def unblocked_rows(spark, sf_dir):
    """Rows with one generic blocker whose name is the pinned synonym of one concept alone."""
    p = parts(spark, sf_dir)
    k = F.col("id")
    half = F.concat(F.lit("k"), F.floor(k / 2).cast("string"))
    d = p.select(k.alias("row_id"), F.when(k % 3 == 0, F.array(F.lit("STRUCTURE"))).when(k % 3 == 1, F.array(F.lit("STRUCTURE"), F.lit("SIDE"))).otherwise(F.array(F.lit("SIDE"))).alias("blockers"))
    syn = p.select(F.concat(F.lit("n"), k.cast("string")).alias("key"), half.alias("concept_id")).union(p.filter(k % 4 == 0).select(F.concat(F.lit("n"), k.cast("string")), F.lit("another")))
    return compose.unblock(p.select(k.alias("row_id"), F.concat(F.lit("n"), k.cast("string")).alias("key")), d, syn, ["STRUCTURE"])


@query(f"""SELECT id AS concept_id, CASE WHEN id % 5 = 0 THEN 'SKIPPED' WHEN head = 'old' THEN 'HELD' ELSE 'CONFIRMED_CLEAN' END AS qa_outcome, CASE WHEN id % 5 = 0 THEN 'fifth' WHEN head = 'old' THEN 'age' ELSE 'NO_RULE' END AS qa_reason FROM {PARTS} WHERE id % 2 = 0""")
def clean_outcomes(spark, sf_dir):
    """Outcomes of clean targets by ordered rules."""
    p = parts(spark, sf_dir).withColumn("target_class", F.when(F.col("id") % 2 == 0, "CLEAN_SIMPLE_TARGET").otherwise("LATERALITY_TARGET"))
    return targets.clean_qa(p, [("SKIPPED", "fifth", F.col("id") % 5 == 0), ("HELD", "age", F.col("head") == "old")]).select(F.col("id").alias("concept_id"), "qa_outcome", "qa_reason")


@query(f"""SELECT id AS concept_id, NULL AS reason, NULL AS target_class, NULL::BIGINT AS n FROM {PARTS} WHERE id % 4 = 0 UNION ALL
SELECT id, CASE WHEN id % 4 = 1 THEN 'late' ELSE 'small' END, head, count(*) OVER (PARTITION BY id % 4 = 1, head) FROM {PARTS} WHERE id % 4 <> 0""")
def selected_batch(spark, sf_dir):
    """H6: a batch, and all others by reason."""
    d = parts(spark, sf_dir).select(F.col("id").alias("concept_id"), F.col("head").alias("target_class"))
    chosen, rest = targets.select_batch(d, F.col("concept_id") % 4 == 0, F.when(F.col("concept_id") % 4 == 1, "late").otherwise("small"))
    none = F.lit(None).cast("string")
    return chosen.select("concept_id", none.alias("reason"), none.alias("target_class"), F.lit(None).cast("long").alias("n")).union(rest.select("concept_id", "reason", "target_class", "n"))


@query(f"""SELECT id AS concept_id, (id % 2 = 0)::BIGINT + (id % 3 = 0)::BIGINT AS parts FROM {PARTS} WHERE id % 2 = 0 OR id % 3 = 0""")
def target_union(spark, sf_dir):
    """H1: a union of target sets, and how many sets an id is in."""
    p = parts(spark, sf_dir).select(F.col("id").alias("concept_id"))
    return quality.target_union(p.filter("concept_id % 2 = 0"), p.filter("concept_id % 3 = 0"))


@query("""SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_totalprice > 100000) AS large, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders""")
def summary_counters(spark, sf_dir):
    """Conditional counts in one row."""
    return consensus.summary(read(spark, sf_dir, "orders"), {"finished": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 100000, "urgent": F.col("o_orderpriority") == "1-URGENT"})


#: The enumeration of events, of which one never happens.
EVENTS = ("click", "error", "purchase", "signup", "view", "never")


@query("""SELECT v.event_type, coalesce(n, 0) AS n FROM (SELECT DISTINCT event_type FROM events UNION SELECT 'never') v LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) c USING (event_type)""")
def category_counts(spark, sf_dir):
    """Counts by category, zero-filled."""
    e = read(spark, sf_dir, "events")
    return metrics.zero_filled(e, "event_type", EVENTS).withColumnRenamed("count", "n")


@query(f"""SELECT id, name FROM {PARTS} WHERE head IN ('small', 'hot') OR rest = 'ring'""")
def visible_set(spark, sf_dir):
    """What is shown by category, or chosen by id."""
    p = parts(spark, sf_dir)
    return search.visible(p, ["small", "hot"], ["ring"], category="head", key="rest").select("id", "name")


@query("""SELECT doc_id, line, length(t) <= 120 AND NOT regexp_matches(t, '\\.\\.|\\b(is|are|was)\\b') AND trim(t) <> '' AS plausible FROM (SELECT doc_id, unnest(generate_series(0, len(a) - 1)) AS line, unnest(a) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL))""")
def plausible_lines(spark, sf_dir):
    """Lines that may be terms: short, no prose."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return d.select("doc_id", F.col("line").cast("long").alias("line"), compose.plausible_term("t").alias("plausible"))


@query("""SELECT (l_orderkey // 500)::VARCHAR AS doc_id, (l_orderkey % 500 * 50 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey))::INT AS entry_id, l_partkey::VARCHAR || ' ' || l_suppkey AS name FROM lineitem""")
def table_rows(spark, sf_dir):
    """A10, L3: rows of a printed table from positioned words: a numbered line, and a line that continues it."""
    li = read(spark, sf_dir, "lineitem")
    at = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    single = li.select("l_orderkey", F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), (F.col("l_orderkey") % 500 * 50 + at).cast("int").alias("number"))
    word = lambda x0, dy, t: F.struct(F.lit(x0).alias("x0"), F.lit(x0 + 8.0).alias("x1"), (F.col("number") * 20 + dy).cast("double").alias("top"), t.cast("string").alias("text"))
    w = single.select(F.floor(F.col("l_orderkey") / 500).cast("string").alias("doc_id"), F.lit(1).alias("page"), F.explode(F.array(word(10.0, 0.0, F.col("number")), word(95.0, 1.0, F.col("p")), word(95.0, 10.0, F.col("s")))).alias("w"))
    t = reconstruct.rebuild_table(w.select("doc_id", "page", "w.*"), [(90, "number"), (300, "name")])
    return t.select("doc_id", "entry_id", F.element_at("cells", "name").alias("name"))


@query("""WITH b AS (SELECT o_custkey % 40 AS doc, o_orderkey AS k, o_orderkey - CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey % 2 ELSE 0 END AS number, 'A01.' || (number // 1000 % 1000) || '.01.' || lpad((number % 1000)::VARCHAR, 3, '0') AS printed, o_orderkey % 5 AS m, o_orderstatus, o_totalprice FROM orders), c AS (SELECT *, count(*) OVER (PARTITION BY printed) AS n FROM b),
r AS (SELECT *, CASE WHEN m = 0 THEN 'INCOMPLETE_TARGET' WHEN m = 1 OR o_orderstatus = 'P' OR o_totalprice > 400000 THEN 'UNMATCHED' ELSE '' END AS reasons FROM c)
SELECT doc::VARCHAR AS doc_id, printed AS printed_id, 'deep part ' || k || CASE WHEN m = 1 THEN ' and more' ELSE '' END AS pivot, CASE WHEN m = 0 THEN '' ELSE 'phần ' || k END AS target, CASE WHEN reasons = '' THEN k END AS concept_id,
CASE WHEN n > 1 OR m = 0 THEN 'INTEGRITY_REVIEW' WHEN reasons = '' THEN 'EXACT' ELSE 'UNMATCHED' END AS status, reasons FROM r""")
def rebuilt_rows(spark, sf_dir):
    """L1: rows of a rendered stream, what speaks against them, and the one concept that has their name; ids that two rows have are demoted."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    number = k - F.when(F.col("o_orderpriority") == "5-LOW", k % 2).otherwise(0)
    code = F.concat(F.lit("A01."), (F.floor(number / 1000) % 1000).cast("string"), F.lit(".01."), F.lpad((number % 1000).cast("string"), 3, "0"), F.lit(" deep part "), k.cast("string"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit(" phần "), k.cast("string"))))
    lines = o.select((F.col("o_custkey") % 40).cast("string").alias("doc_id"), F.explode(F.array(F.struct((2 * k).alias("line"), code.alias("text")), F.struct((2 * k + 1).alias("line"), F.when(k % 5 == 1, "and more").otherwise("").alias("text")))).alias("l")).select("doc_id", "l.*")
    # Dear orders' names are those of two concepts, and open ones have none.
    name = F.concat(F.lit("Deep  part "), k.cast("string")).alias("name")
    known = o.filter("o_orderstatus <> 'P'")
    names = known.select(k.alias("concept_id"), name).union(known.filter("o_totalprice > 400000").select(-1 - k, name))
    out = reconstruct.rebuild_stream(lines, names, r"^\s*(A\d{2}(?:\.\d{1,3})+\.?)\s*(.*)$", r"^(\d{3})\s+(.*)$", r"^A\d{2}(?:\.\d{1,3}){2}\.\d{3}$", r"^(\d+) Page$")
    return out.select("doc_id", "printed_id", "pivot", "target", "concept_id", "status", F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'QUARANTINED' ELSE 'RETAINED' END AS retention FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""")
def retained_rows(spark, sf_dir):
    """Prior rows that still have their match."""
    return reconstruct.retention(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels"), ["doc_id"])


@query(f"""SELECT DISTINCT id, CASE WHEN id % 3 = 0 THEN name ELSE head END AS preferred, array_to_string(list_filter([CASE WHEN id % 3 = 0 THEN head END, 'syn ' || rest], lambda x: x IS NOT NULL), ',') AS aliases FROM {PARTS}""")
def attestation_records(spark, sf_dir):
    """Spelling a else b is preferred, the other one an alias; whole-row duplicates go."""
    p = parts(spark, sf_dir)
    r = p.select("id", F.when(F.col("id") % 3 == 0, F.col("name")).otherwise(" ").alias("a"), F.col("head").alias("b"), F.concat(F.lit("syn "), "rest", F.lit("; ;"), "head").alias("syn"))
    out = reconstruct.to_attestations(r.union(r), "S", "1", "a", "b", "syn")
    return out.select("id", F.col("pivot.preferred").alias("preferred"), F.array_join("pivot.aliases", ",").alias("aliases"))
