"""One row per branch, in invented words."""

import json

import pytest
from pyspark.sql import functions as F

from lexspark.operators import compose, consensus, evidence, match, mesh, metrics, patch, quality, reconstruct, registry, rules, search, snapshot, targets
from lexspark.sources import io

CAPS = "struct<identity: boolean, canonical: boolean, target_preferred: boolean, corroboration: boolean, machine_discovery: boolean>"
SOURCE = f"id string, class string, title string, revision string, authority_tier string, access_status string, locator_capability string, identity_verified boolean, full_text_available boolean, content_inspected boolean, url string, access_copy_of string, capabilities {CAPS}, audit struct<status: string, verified_at: string, verified_by: string>"
LOCATOR = "struct<page: int, plate: string, entry_id: string, nomenclature_id: string, chapter: string, section: string, `table`: string, url: string>"
PAGE = (3, None, None, None, None, None, None, None)
NOWHERE = (None,) * 8


def source(id="S", cls="target-authoritative", tier="authoritative", rev="r1", copy=None, caps=(False, False, True, False, False), **k):
    g = dict(access="FULL_ACCESS", locator="PAGE", verified=True, full=True, inspected=True, url=None, status="VERIFIED", at="2024-01-01") | k
    return (id, cls, "Title", rev, tier, g["access"], g["locator"], g["verified"], g["full"], g["inspected"], g["url"], copy, caps, (g["status"], g["at"], "who"))


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_duplicates_are_equal_by_content_only(spark):
    d = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("A", 1)], "t string, page int")
    assert sorted(r.duplicate_count for r in evidence.coalesce_duplicates(d).collect()) == [1, 1, 2]


def test_source_gate(spark):
    catalog = spark.createDataFrame([source("S"), source("C", copy="S", tier="discovery-only"), source("M", cls="machine-generated", caps=(False, False, False, False, True), tier="discovery-only")], SOURCE)
    a = spark.createDataFrame([(1, "S", "r1", PAGE), (2, "S", "r0", PAGE), (3, "C", "r1", PAGE), (4, "M", "r1", PAGE), (5, "S", "r1", NOWHERE), (6, "X", "r1", PAGE)], f"k int, source_id string, source_revision string, locator {LOCATOR}")
    got = {r.k: (r.known, r.research_eligible, r.claim_eligible) for r in evidence.assess_sources(a, catalog).collect()}
    assert got == {1: (True, True, True), 2: (True, False, False), 3: (True, False, False), 4: (True, False, False), 5: (True, False, False), 6: (False, False, False)}
    assert rows(evidence.unresolved_sources(a, catalog), "source_id") == [("X",)] and evidence.revision_mismatches(a, catalog).count() == 1


def test_consensus_statuses(spark):
    e = spark.createDataFrame([
        ("agreed", "x", "X", "s1", "1", True, False, True), ("agreed", "x", "X", "s2", "2", True, False, True), ("conflict", "x", "X", "s1", "3", True, False, True), ("conflict", "y", "Y", "s2", "4", True, False, True),
        ("variant", "x", "X", "s1", "5", True, False, True), ("variant", "x", "x", "s2", "6", True, False, True), ("blocked", "x", "X", "s1", "7", True, False, False), ("flagged", "x", "X", "s1", "8", True, False, True),
        ("alias", "x", "X", "s1", "9", True, True, True), ("weak", "x", "X", "s1", "10", False, False, True)], "concept_id string, key string, term string, source_id string, evidence_id string, eligible boolean, alias boolean, identity boolean")
    flags = spark.createDataFrame([("flagged", "LATERALITY_MISMATCH"), ("agreed", "OTHER")], "concept_id string, code string")
    concepts = spark.createDataFrame([(c,) for c in ("agreed", "conflict", "variant", "blocked", "flagged", "alias", "weak", "none")], "concept_id string")
    got = {r.concept_id: (r.status, r.agreed_term) for r in consensus.consensus(e, concepts, flags, ["LATERALITY_MISMATCH"]).collect()}
    assert got == {"agreed": ("AGREED", "X"), "conflict": ("CONFLICT", None), "variant": ("SURFACE_VARIANT_REVIEW", None), "blocked": ("BLOCKED_BY_SAFETY_FLAG", None), "flagged": ("BLOCKED_BY_SAFETY_FLAG", None), "alias": ("VARIANT_ONLY", None), "weak": ("NO_AUTHORITATIVE_PREFERRED_TERM", None), "none": ("NONE", None)}
    d = spark.createDataFrame([("agreed", "HIGH_CONSENSUS_CANDIDATE"), ("conflict", "SOURCE_GAP")], "concept_id string, bucket string")
    assert rows(consensus.demote_collisions(d, e), "concept_id", "bucket", "collides") == [("agreed", "VARIANT_REVIEW", True), ("conflict", "SOURCE_GAP", True)]
    authority = spark.createDataFrame([("agreed", "AGREED", 2, 1)], "concept_id string, status string, sources int, institutions int")
    bound = spark.createDataFrame([("conflict", "IDENTITY_GAP")], "concept_id string, bound_bucket string")
    assert rows(consensus.apply_guards(d, bound, authority), "concept_id", "bucket") == [("agreed", "VARIANT_REVIEW"), ("conflict", "IDENTITY_GAP")]


def test_localisation_gate(spark):
    c = spark.createDataFrame([("1", "left hand"), ("2", "foot"), ("3", "twin"), ("4", "twin"), ("5", "body")], "concept_id string, name string")
    r = spark.createDataFrame([
        ("exact", "Foot", None, None, ""), ("wrapped", "structure of foot", None, None, ""), ("alias", "pes", ["foot"], None, ""), ("scope", "foot", ["x"], None, ""), ("extra", "foot part", ["foot"], None, ""), ("side", "hand", ["left hand"], "right", ""),
        ("many", "twin", None, None, ""), ("none", "nothing", None, None, ""), ("made", "foot", None, None, "Parser-generated")], "row_id string, preferred string, aliases array<string>, laterality string, provenance string")
    got = {x.row_id: (x.status, x.concept_id, x.method, x.blockers) for x in match.localisation_gate(r, c, ["part"], ["left", "right"], "^structure of (.*)$", "parser[- _]?generated").collect()}
    assert got["exact"] == ("ACCEPTED", "2", "EXACT", []) and got["wrapped"] == ("ACCEPTED", "2", "EXACT_WITHOUT_WRAPPER", []) and got["alias"][:3] == ("ACCEPTED", "2", "SYNONYM")
    assert got["extra"] == ("SCOPE_BLOCKED", "2", "SYNONYM", ["SCOPE_QUALIFIER_PART"]) and got["side"] == ("LATERALITY_BLOCKED", "1", "SYNONYM", ["LATERALITY_MISMATCH_right_TO_left"])
    assert [got[k][0] for k in ("many", "none", "made")] == ["MULTIPLE_TARGETS", "NO_IDENTITY", "PARSER_BLOCKED"]


def test_membership_heuristics(spark):
    c = spark.createDataFrame([("1", "hand"), ("2", "left hand"), ("3", "muscle group"), ("4", "alone")], "concept_id string, name string")
    m = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", "c")], "concept_id string, element_id string")
    got = {r.concept_id: r for r in match.membership_heuristics(c, m, r"(^|\s)group(\s|$)", ["left", "right"]).collect()}
    assert got["1"].unsided_with_sided_sibling and got["1"].overlapping == 1 and got["3"].aggregate_or_composite and not got["4"].ontology_risk


def test_rules(spark):
    with pytest.raises(ValueError, match="always"):
        rules.compile_table([{"id": "x", "disposition": "y", "when": {"field": "a", "eq": 1}}])
    with pytest.raises(ValueError, match="one test"):
        rules.compile_condition({"field": "a", "eq": 1, "gt": 2})
    p = spark.createDataFrame([("a", "1", True, True, True), ("b", "1", True, True, True), ("b", "2", True, True, True), ("c", "1", True, True, True), ("c", "2", False, True, True), ("d", "1", False, False, False), ("e", "1", False, False, True)], "row_id string, target_id string, eligible boolean, credible boolean, exact boolean")
    got = {r.row_id: (r.disposition, r.selected) for r in rules.reduce_candidates(p).collect()}
    assert got == {"a": ("SELECTED", "1"), "b": ("IDENTITY_REVIEW", None), "c": ("IDENTITY_REVIEW", None), "d": ("CORROBORATIVE", None), "e": ("BRIDGE_REQUIRED", None)}
    r = spark.createDataFrame([("r1", True, None), ("r2", True, True)], "row_id string, a boolean, b boolean")
    d = {x.row_id: (x.blockers, x.disposition) for x in rules.adapt_rows(r, {"A": F.col("a"), "B": F.col("b")}, "art", "kind", "ok").collect()}
    assert d == {"r1": (["B"], "BLOCKED"), "r2": ([], "IDENTITY_REVIEW")}


def test_mining_derivation_and_classes(spark):
    claims = spark.createDataFrame([("left hand", "tay trai"), ("right hand", "tay phai"), ("left foot", "chan trai"), ("right foot", "chan phai"), ("left eye", "mat trai"), ("right eye", "mat phai"), ("left ear", "tai trai"), ("right ear", "tai x phai"), ("left toe", "a"), ("left toe", "b"), ("right toe", "c")], "name string, term string")
    pairs = spark.createDataFrame([("side", "left", "right")], "rule_id string, first string, second string")
    r = compose.enable_rules(compose.mine_pairs(claims, pairs), pairs)
    assert rows(r, "examples", "enabled", "first_words", "second_words") == [(3, True, ["trai"], ["phai"])]
    names = spark.createDataFrame([("1", "left knee"), ("2", "knee"), ("3", "left nose"), ("4", "left twin"), ("5", "twin"), ("6", "twin"), ("7", "left bad"), ("8", "bad"), ("9", "left black knee")], "concept_id string, name string")
    bases = spark.createDataFrame([("2", "DIRECT", "goi"), ("8", "CONFLICT", None)], "concept_id string, kind string, term string")
    got = {x.concept_id: (x.term, x.reason) for x in compose.derive(names, compose.modifiers_of(r), names, bases, ["black"]).collect()}
    assert got == {"1": ("goi trai", None), "3": (None, "NO_UNAMBIGUOUS_BASE"), "4": (None, "MULTIPLE_BASE"), "7": (None, "BASE_CONFLICT_OR_SCOPE"), "9": (None, "BLACKLISTED")}
    direct = spark.createDataFrame([("2", "DIRECT", "goi"), ("8", "CONFLICT", None)], "concept_id string, kind string, term string")
    none = spark.createDataFrame([], "concept_id string, term string")
    a = compose.assemble(names, direct, none, spark.createDataFrame([("1", "goi trai")], "concept_id string, term string"))
    cls = compose.evidence_class(a, spark.createDataFrame([("3", "mui")], "concept_id string, term string"), spark.createDataFrame([("4", "t")], "concept_id string, term string"))
    got = {x.concept_id: (x.evidence_status, x.method) for x in cls.collect()}
    assert got["2"] == ("VERIFIED", "SOURCE") and got["1"] == ("VERIFIED", "RULE") and got["3"] == ("PROVISIONAL_SOURCED", "SOURCE_CANDIDATE") and got["4"] == ("PROVISIONAL_TRANSLATED", "LEXICON") and got["5"] == ("NO_TRANSLATION", "NONE") and len(got) == 9


def test_composition_takes_the_longest(spark):
    lex = spark.createDataFrame([("a", "1"), ("a b", "2"), ("b", "3"), ("c", "4")], "component string, term string")
    n = spark.createDataFrame([("x", "a b c"), ("y", "b a"), ("z", "a q"), ("w", "")], "id string, name string")
    assert rows(compose.compose(n, lex), "id", "term") == [("w", None), ("x", "2 4"), ("y", "3 1"), ("z", None)]


def test_quality_and_repair(spark):
    r = spark.createDataFrame([("ok", "left hand", "tay trai", True, False), ("fix", "left hand", "tay tay trai", True, False), ("lost", "left foot", "chan", True, False), ("kept", "left eye", "mat", False, False), ("war", "left ear", "tai", True, True)], "concept_id string, pivot string, target string, generated boolean, conflict boolean")
    table = spark.createDataFrame([("SIDE", "left", "trai", "phai")], "code string, when_pivot string, needs string, forbids string")
    got = {x.concept_id: (x.status, x.target) for x in quality.qa_status(r, table).collect()}
    assert got == {"ok": ("CLEAR", "tay trai"), "fix": ("REPAIRED", "tay trai"), "lost": ("NEEDS_HUMAN", "chan"), "kept": ("RETAIN", "mat"), "war": ("CONFLICT_PRESERVED", "tai")}
    one = quality.repair(spark.createDataFrame([("trai cua tay Phai nerve",)], "target string"), "cua", ["nerve"], [("phai", "phải")]).first()
    assert one.repaired == "nerve trai tay phai" and one.actions == ["DROP_CONNECTOR", "MOVE_HEAD", "LOWER_INTERIOR"]
    assert rows(quality.target_union(r.select("concept_id").limit(1), r.select("concept_id")), "parts")[-1] == (2,)


def test_patches(spark):
    d = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")], "concept_id string, target string")
    p = spark.createDataFrame([("1", "a", "A", 1), ("1", "a", "AA", 2), ("2", "x", "b", 1), ("3", "y", "z", 1), ("9", "q", "r", 1), ("4", "d", " ", 1), ("4", "d", " ", 1)], "concept_id string, old string, new string, patch_set int")
    got = {r.concept_id: (r.target, r.patch_state) for r in patch.apply_patches(d, p.filter("new <> ' '")).collect()}
    assert got == {"1": ("AA", "READY"), "2": ("b", "ALREADY_APPLIED"), "3": ("c", "DRIFT"), "4": ("d", "UNPATCHED")}
    assert rows(patch.validate_patches(d, p), "entity_id", "code") == [("3", "drift"), ("4", "blank-value"), ("4", "duplicate-id"), ("9", "unknown-id")]


CLAIM = f"concept_id string, id string, type string, target string, source_id string, source_revision string, locator {LOCATOR}, evidence_disposition string, review_state string"
ENTRY = "concept_id string, key string, pivot struct<preferred: string, aliases: array<string>>, target struct<preferred: string, aliases: array<string>, ascii_forms: array<string>>, mapping_status string, mapping_disposition string, elements array<string>, revision string, review_status string"
CAPABILITY = {"identity": "identity", "target-preferred": "target_preferred", "target-alias": "target_preferred"}
NOMEN = (None, None, None, "X1", None, None, None, None)


def valid_registry():
    return {
        "sources": [source("S"), source("D", cls="dataset", caps=(True, False, False, False, False), locator="TERM_ID")],
        "reviewers": [("R", "Name", "role", None, "ACTIVE", ["*"])],
        "concepts": [("c1", "hand", ["e1", "e2"])],
        "entries": [("c1", "c1", ("hand", []), ("tay", [], ["tay"]), "MAPPED", None, ["e1"], "rev1", "VERIFIED")],
        "claims": [("c1", "k1", "identity", "X1", "D", "r1", NOMEN, "SUPPORTED", "VERIFIED"), ("c1", "k2", "target-preferred", "tay", "S", "r1", PAGE, "SUPPORTED", "VERIFIED")],
        "mappings": [("c1", "m1", "NOM", "X1", "r1", "exact", "VERIFIED", ["k1"])],
        "audits": [("c1", t, "PASSED", "APPROVE", "R", "2024-01-02", "rev1", ["k1", "k2"], False) for t in ("source-verification", "medical-review")],
        "conflicts": [("c1", "x1", "term", ["k2"], "ADJUDICATED", "keep", "why", "R", "rev1")],
    }


SCHEMAS = {
    "sources": SOURCE, "reviewers": "id string, display_name string, role string, evidence_ref string, status string, authorization_scope array<string>", "concepts": "concept_id string, name string, elements array<string>", "entries": ENTRY, "claims": CLAIM,
    "mappings": "concept_id string, id string, namespace string, identifier string, source_revision string, relation string, disposition string, evidence_claim_ids array<string>",
    "audits": "concept_id string, type string, status string, decision string, reviewer_id string, reviewed_at string, entry_revision string, claim_ids array<string>, automated boolean",
    "conflicts": "concept_id string, id string, type string, claim_ids array<string>, status string, decision string, rationale string, reviewer_id string, entry_revision string",
}


def put(table, column, value, row=0):
    def change(reg):
        names = [c.name for c in change.spark.createDataFrame([], SCHEMAS[table]).schema]
        old = list(reg[table][row])
        old[names.index(column)] = value
        reg[table][row] = tuple(old)

    return change


def twice(table):
    return lambda reg: reg[table].append(reg[table][0])


MUTATIONS = {
    "duplicate-source-id": twice("sources"), "invalid-source-title": put("sources", "title", " "), "invalid-source-url": put("sources", "url", "ftp:x"), "invalid-source-access-status": put("sources", "access_status", "?"),
    "unresolved-access-copy-target": put("sources", "access_copy_of", "ZZ"), "duplicate-reviewer-id": twice("reviewers"), "invalid-reviewer-status": put("reviewers", "status", "?"), "invalid-reviewer-evidence": put("reviewers", "evidence_ref", "x"),
    "entry-key-mismatch": put("entries", "key", "c2"), "orphan-concept-id": put("concepts", "concept_id", "zz"), "mesh-membership-mismatch": put("entries", "elements", ["e9"]), "pivot-snapshot-mismatch": put("concepts", "name", "foot"),
    "invalid-ascii-search-form": put("entries", "target", ("tay", [], ["táy"])), "unapproved-search-form": put("entries", "target", ("tay", ["tay2"], [])), "duplicate-normalized-term": put("entries", "target", ("tay", ["a", "á"], [])), "preferred-claim-target-mismatch": put("claims", "target", "x", 1),
    "duplicate-claim-id": twice("claims"), "invalid-claim-type": put("claims", "type", "?"), "unresolved-claim-source": put("claims", "source_id", "ZZ"), "claim-source-revision-mismatch": put("claims", "source_revision", "r0"), "claim-capability-mismatch": put("claims", "source_id", "D", 1),
    "unreproducible-claim": put("claims", "locator", NOWHERE), "invalid-claim-locator": put("claims", "locator", None), "verified-claim-without-support": put("claims", "evidence_disposition", "CANDIDATE"), "source-evidence-unusable": put("sources", "content_inspected", False),
    "missing-mapping-claim": put("mappings", "evidence_claim_ids", ["zz"]), "mapping-claim-target-mismatch": put("mappings", "identifier", "X2"), "verified-mapping-without-evidence": put("mappings", "evidence_claim_ids", []), "invalid-mapping-relation": put("mappings", "relation", "?"),
    "mapping-claim-type-mismatch": put("claims", "type", "target-alias"), "verified-mapping-with-unmapped-status": put("entries", "mapping_status", "CANDIDATE"), "unmapped-without-disposition": put("entries", "mapping_status", "UNMAPPED"),
    "stale-approval": put("audits", "entry_revision", "old"), "missing-reviewer-id": put("audits", "reviewer_id", None), "unregistered-reviewer": put("audits", "reviewer_id", "Q"), "inactive-reviewer": put("reviewers", "status", "INACTIVE"), "unauthorized-reviewer": put("reviewers", "authorization_scope", ["k1"]),
    "medical-review-requires-human": put("audits", "automated", True, 1), "passed-audit-missing-claims": put("audits", "claim_ids", []), "review-unknown-claim": put("audits", "claim_ids", ["k1", "zz"]), "missing-review-audit": lambda reg: reg["audits"].pop(),
    "conflict-awaiting-adjudication": put("conflicts", "status", "OPEN"), "open-conflict-preferred-term": put("conflicts", "status", "OPEN"), "invalid-conflict-adjudication": put("conflicts", "rationale", None), "unregistered-conflict-reviewer": put("conflicts", "reviewer_id", "Q"), "conflict-unknown-claim": put("conflicts", "claim_ids", ["zz"]),
}


def tables_of(spark, reg):
    return {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in reg.items()}


def test_valid_registry_has_no_findings_and_is_released(spark):
    t = tables_of(spark, valid_registry())
    assert registry.validate(t, CAPABILITY, list(CAPABILITY), {"NOM": "identity"}).collect() == []
    got = registry.release_gate(t, CAPABILITY, {"NOM": "identity"}).first()
    assert got.released, got


def test_each_mutation_is_found(spark):
    """All mutated registries in one table: their concepts, sources and reviewers are renamed apart."""
    merged = {n: [] for n in SCHEMAS}
    fields = {n: [c.name for c in spark.createDataFrame([], s).schema] for n, s in SCHEMAS.items()}
    tag = {"concept_id", "key", "source_id", "reviewer_id", "access_copy_of"}
    for code, change in MUTATIONS.items():
        change.spark = spark
        reg = valid_registry()
        change(reg)
        for n, table in reg.items():
            for row in table:
                named = dict(zip(fields[n], row, strict=True))
                for f in named:
                    if named[f] is not None and (f in tag or (f == "id" and n in ("sources", "reviewers"))):
                        named[f] = f"{code}|{named[f]}"
                merged[n].append(tuple(named.values()))
    found = registry.validate(tables_of(spark, merged), CAPABILITY, list(CAPABILITY), {"NOM": "identity"}).select("code", F.substring_index("entity_id", "|", 1).alias("of")).distinct().collect()
    by = {}
    for r in found:
        by.setdefault(r["of"], set()).add(r["code"])
    missing = [c for c in MUTATIONS if c not in by.get(c, set())]
    assert not missing, missing


@pytest.mark.parametrize("change", ["stale-approval", "medical-review-requires-human", "claim-source-revision-mismatch", "conflict-awaiting-adjudication", "missing-mapping-claim"])
def test_any_gate_stops_the_release(spark, change):
    reg = valid_registry()
    MUTATIONS[change].spark = spark
    MUTATIONS[change](reg)
    assert not registry.release_gate(tables_of(spark, reg), CAPABILITY, {"NOM": "identity"}).first().released


def test_rebuilt_stream(spark):
    text = ["12 Page", "## Heading one", "A01.1.01.001 Deep part phần sâu", "of hand", "A01.1.02. Long name tên dài", "003 tail đuôi", "A01.1.03.004 no target", "A01.1.04.005 One một", "## Next", "A01.1.05.006 Two hai", "A01.1.05.006 Two hai", "A01.1.06.007 Three ba bá", "see A01.1.01.001"]
    lines = spark.createDataFrame([("d", i, t) for i, t in enumerate(text)], "doc_id string, line int, text string")
    names = spark.createDataFrame([("1", "deep part of HAND"), ("2", "Three"), ("3", "One"), ("4", "Twin"), ("5", "twin")], "concept_id string, name string")
    out = reconstruct.rebuild_stream(lines, names, r"^\s*(A\d{2}(?:\.\d{1,3})+\.?)\s*(.*)$", r"^(\d{3})\s+(.*)$", r"^A\d{2}(?:\.\d{1,3}){2}\.\d{3}$", r"^(\d+) Page$")
    got = {r.block: r for r in out.collect()}
    assert (got[1].printed_id, got[1].page, got[1].section, got[1].pivot, got[1].target, got[1].status) == ("A01.1.01.001", 12, "Heading one", "Deep part of hand", "phần sâu", "EXACT")
    assert got[1].concept_id == "1" and got[2].concept_id is None and got[2].reasons == ["UNMATCHED"]
    assert got[2].printed_id == "A01.1.02.003" and got[2].status == "UNMATCHED" and got[2].target == "tên dài đuôi"
    assert "INCOMPLETE_TARGET" in got[3].reasons and "CROSSED_HEADING" in got[4].reasons and got[5].status == got[6].status == "INTEGRITY_REVIEW" and "EMBEDDED_ENTRY" in got[7].reasons


def test_coded_text(spark):
    text = ["=== PDF_PAGE 4 ===", "6100001 Tay trái 12345678 Left hand", "(body structure) more", "6100002 no id (body structure)", "6100003 Chân 12345679 no marker", "=== PDF_PAGE 5 ===", "6100004 12345670 x (body structure)"]
    lines = spark.createDataFrame([("d", i, t) for i, t in enumerate(text)], "doc_id string, line int, text string")
    got = rows(reconstruct.extract_coded(lines, r"^61\d{5}(?!\d)", "(body structure)"), "code", "page", "target", "external_id", "pivot", "reject")
    assert got == [("6100001", 4, "Tay trái", "12345678", "Left hand (body structure)", None), ("6100002", 4, None, None, None, "MISSING_EXTERNAL_ID"), ("6100003", 4, None, None, None, "MISSING_SCOPE_MARKER"), ("6100004", 5, None, None, None, "EMPTY_FIELD")]


def test_table_of_words(spark):
    w = [("d", 1, 10.0, 20.0, 100.0, "7"), ("d", 1, 95.0, 110.0, 101.0, "Facie"), ("d", 1, 110.5, 115.0, 100.4, "s"), ("d", 1, 118.0, 130.0, 100.0, "alta"), ("d", 1, 95.0, 120.0, 110.0, "secunda"), ("d", 1, 210.0, 230.0, 103.0, "syn;"), ("d", 1, 10.0, 20.0, 120.0, "8"), ("d", 1, 95.0, 99.0, 120.0, "x"), ("d", 1, 95.0, 99.0, 50.0, "before")]
    d = spark.createDataFrame(w, "doc_id string, page int, x0 double, x1 double, top double, text string")
    got = {r.entry_id: r.cells for r in reconstruct.rebuild_table(d, [(90, "number"), (203, "latin"), (317, "synonym")]).collect()}
    assert got == {7: {"latin": "Facies alta secunda", "synonym": "syn"}, 8: {"latin": "x"}}


def test_table_lines_come_from_one_shuffle(spark):
    # Tops 1 apart: a line takes what is within 1.5 of its first word, so the run falls into lines of two; a word without a top is the last line's.
    w = [("d", 1, 10.0, 18.0, float(t), str(t)) for t in (0, 4)] + [("d", 1, 100.0 + t, 100.5 + t, float(t), f"t{t}") for t in range(8)] + [("d", 1, 210.0, 220.0, None, "late"), ("d", 2, 10.0, 18.0, 0.0, "9"), ("d", 2, 100.0, 101.0, 0.5, None), ("d", 2, 100.0, 101.0, 30.0, "y")]
    d = reconstruct.rebuild_table(spark.createDataFrame([x if x[5] != "0" else (*x[:5], "3") for x in w], "doc_id string, page int, x0 double, x1 double, top double, text string"), [(90, "number"), (203, "latin"), (317, "synonym")])
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {r.entry_id: r.cells for r in d.collect()} == {3: {"latin": "t0t1 t2t3"}, 4: {"latin": "t4t5 t6t7", "synonym": "late"}, 9: {"latin": "y"}}


def test_errata_and_attestations(spark):
    text = ["Corrections in version 2.03", "PART II", "12 something", "Latin term corrected", "and a synonym added", "Endnote 3 x", "13 other", "Corrections in version 2.04", "PART I", "12 again"]
    e = reconstruct.parse_errata(spark.createDataFrame([("d", i, t) for i, t in enumerate(text)], "doc_id string, line int, text string"), [("latin term corrected", "latin"), ("synonym added", "aliases")])
    assert rows(e, "entry_id", "versions", "actions") == [("12", ["2.03", "2.04"], ["aliases", "latin"]), ("13", ["2.03"], [])]
    r = reconstruct.annotate_errata(spark.createDataFrame([("12", "a", "b", "c; a"), ("99", None, "b", None)], "entry_id string, us string, uk string, syn string"), e)
    got = {x.entry_id: x for x in reconstruct.to_attestations(r.union(r), "S", "1", "us", "uk", "syn").collect()}
    assert got["12"].errata_note == "errata=2.03,2.04; actions=aliases,latin" and got["12"].pivot.preferred == "a" and sorted(got["12"].pivot.aliases) == ["b", "c"] and got["99"].pivot.preferred == "b" and got["99"].errata_note is None and len(got) == 2
    k = spark.createDataFrame([("1",)], "id string")
    assert rows(reconstruct.retention(spark.createDataFrame([("1",), ("2",)], "id string"), k, ["id"]), "id", "retention") == [("1", "RETAINED"), ("2", "QUARANTINED")]


def test_search(spark):
    t = spark.createDataFrame([("1", "Bàn tay", 0, ["ban tay", "hand"]), ("2", "Tay", 1, ["tay"]), ("3", "Chân", 2, ["chan"])], "concept_id string, display_name string, pos int, keys array<string>")
    assert [r.concept_id for r in search.search(t, " TÁY ").collect()] == ["2", "1"] and [r.concept_id for r in search.search(t, "tay", 1, False).collect()] == ["1"] and search.search(t, " ").count() == 0
    v = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "id string, category string")
    assert rows(search.visible(v, ["x"], ["b"]), "id") == [("a",), ("b",)] and rows(search.visible(v, ["x"], ["b"], True), "id") == [("b",)]


def test_targets(spark):
    d = spark.createDataFrame([("1", "CLEAN_SIMPLE_TARGET", 1), ("2", "CLEAN_SIMPLE_TARGET", 5), ("3", "IDENTITY_TARGET", 1)], "concept_id string, target_class string, n int")
    assert rows(targets.clean_qa(d, [("HOLD", "MANY", F.col("n") > 3)]), "concept_id", "qa_outcome") == [("1", "CONFIRMED_CLEAN"), ("2", "HOLD")]
    chosen, rest = targets.select_batch(d, F.col("n") > 3, F.when(F.col("n") == 1, "few").otherwise("x"))
    assert rows(chosen, "concept_id") == [("2",)] and rows(rest, "reason", "concept_id", "n") == [("few", "1", 1), ("few", "3", 1)]


def test_snapshots_and_counts(spark):
    a = spark.createDataFrame([("1", "x", 1), ("2", "y", 2), ("3", "z", 3), ("5", "w", 1)], "id string, name string, m int")
    b = spark.createDataFrame([("1", "x", 1), ("2", "Y", 2), ("3", "z", 4), ("4", "n", 1)], "id string, name string, m int")
    assert rows(snapshot.diff(a, b, "id", "name", "m"), "id", "state") == [("1", "UNCHANGED"), ("2", "RENAMED"), ("3", "REMAPPED"), ("4", "ADDED"), ("5", "REMOVED")]
    assert snapshot.set_equal(a, a.orderBy("m")) and not snapshot.set_equal(a, b)
    assert rows(snapshot.delta(a.select("id", "m"), b.select("id", "m"), "id", "m"), "id", "delta", "delta_pct")[2:4] == [("3", 1, 33.33), ("4", 1, None)]
    assert [r.pos for r in metrics.ordered_position(a.repartition(3), "id").orderBy("id").collect()] == [0, 1, 2, 3]
    assert rows(snapshot.first_wins(a, ["m"], "id"), "id") == [("1",), ("2",), ("3",)]
    assert rows(metrics.zero_filled(a, "name", ["x", "q"]), "name", "count") == [("q", 0), ("x", 1)]


def test_mesh(spark):
    v = spark.createDataFrame([("p", 0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0), ("p", 1, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0), ("p", 2, 1.0, 2.0, 3.0, 0.0, 0.0, 0.0)], "part_id string, index int, x double, y double, z double, nx double, ny double, nz double")
    w = {r["index"]: r for r in mesh.weld(v).collect()}
    assert w[0].welded == [0, 1] and w[0].nx == pytest.approx(0.707107) and w[2].nx == 0
    t = mesh.triangulate(spark.createDataFrame([("p", 0, [0, 1, 2, 9]), ("p", 1, [0, 1])], "part_id string, face int, corners array<int>"))
    assert rows(t, "a", "b", "c") == [(0, 1, 2), (0, 2, 9)] and rows(mesh.check_buffers(t, v), "corner") == [(9,)]
    assert mesh.bounds(v).first().bounds == [[0, 1], [0, 2], [0, 3]] and mesh.transform(v).filter("index = 2").first().z == -2


def test_readers_and_writers(spark, tmp_path):
    rec = {"source_id": "S", "source_revision": "1", "source_term_raw": "x", "locator": {"page": 3}, "pivot": {"preferred": "x", "aliases": ["y", " "]}, "laterality": "up"}
    (tmp_path / "a.jsonl").write_text(json.dumps(rec) + "\n\n" + "{bad\n")
    (tmp_path / "b.json").write_text(json.dumps({"records": [rec, rec]}))
    a = io.read_attestations(spark, str(tmp_path / "a.jsonl")).cache()
    assert io.corrupt_findings(a).count() == 1 and a.filter("source_id = 'S'").count() == 1
    assert io.read_attestations(spark, str(tmp_path / "b.json"), envelope="records").count() == 2
    found = {r.code for r in evidence.validate_attestations(a.filter("source_id = 'S'")).collect()}
    assert found == {"invalid-laterality", "blank-pivot-alias"}
    lines = io.read_raw_lines(spark, str(tmp_path / "a.jsonl"))
    assert [r.line for r in lines.orderBy("line").collect()] == [1, 3] and lines.select("row_id").distinct().count() == 2
    io.write_by_source(a.filter("source_id = 'S'").select("source_id", "source_term_raw"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "source_id=S").is_dir()
    m = io.manifest(spark, str(tmp_path / "b.json"))
    assert [r.state for r in io.compare_manifest(m, m).collect()] == ["MATCH"]
    x = spark.createDataFrame([("7\tabc",), ("abc",)], "t string")
    assert [(r[0].line, r[0].text) for r in x.select(io.split_rendered(F.col("t"))).collect()] == [(7, "abc"), (None, "abc")]
    k = spark.createDataFrame([('{"a": 1, "zz": 2}',)], "j string")
    assert k.select(evidence.unknown_keys(F.col("j"), ["a"])).first()[0] == ["zz"]


def test_names_and_search_terms(spark):
    c = spark.createDataFrame([("1", "hand"), ("2", "foot"), ("3", "ear")], "concept_id string, name string")
    d = registry.resolve_names(c, spark.createDataFrame([("1", "tay")], "concept_id string, term string"), spark.createDataFrame([("2", "foot", "chan"), ("3", "old name", "tai")], "concept_id string, name string, term string"))
    assert rows(d, "concept_id", "display_name", "origin") == [("1", "tay", "RELEASED"), ("2", "chan", "CATALOGUE"), ("3", "ear", "PIVOT")]
    gated = spark.createDataFrame([("1", "target-alias", "bàn tay", True), ("1", "target-alias", "no", False)], "concept_id string, type string, target string, approved boolean")
    s = registry.search_terms(c, d, gated.drop("approved"), gated, spark.createDataFrame([("2", "X9", True), ("2", "X8", False)], "concept_id string, identifier string, approved boolean"))
    keys = {(r.concept_id, r.key) for r in s.collect()}
    assert ("1", "ban tay") in keys and ("1", "no") not in keys and ("2", "x9") in keys and ("2", "x8") not in keys and ("1", "hand") in keys


def test_claims_and_ordinals(spark):
    a = spark.createDataFrame([("1", "S", "e", "hand", "tay", "tay", "EXACT", None)] * 2 + [("1", "T", "e", "hand", "tay", "tay", "EXACT", "I")], "concept_id string, source_id string, entry_id string, pivot string, target string, agreement string, method string, institution string")
    c = consensus.emit_claims(a)
    assert rows(c, "source_id", "independence") == [("S", "S"), ("T", "I")]
    d = consensus.terminal_disposition(a.select("concept_id"), c, spark.createDataFrame([], "concept_id string, status string"))
    assert rows(d, "disposition") == [("MULTI_SOURCE_AGREEMENT",)]
    claims = spark.createDataFrame([("first rib", "suon nhat"), ("second rib", "suon hai"), ("third toe", "ngon ba")], "name string, term string")
    pairs = compose.ordinal_pairs(spark, ["first", "second", "third"], "ord")
    assert pairs.count() == 3
    assert rows(compose.enable_ordinals(compose.mine_pairs(claims, pairs)), "modifier", "enabled", "word") == [("first", True, "nhat"), ("second", True, "hai")]


def test_further_registry_rules(spark):
    o = spark.createDataFrame([("1", "a", "human", "2024-01-01", None), ("1", "b", "x", "bad", "ZZ"), ("1", "b", "human", "2024-01-01", "S")], "concept_id string, id string, method string, created_at string, source_id string")
    found = rows(registry.origin_findings(o, spark.createDataFrame([source("S")], SOURCE)), "code", "entity_id")
    assert found == [("invalid-candidate-origin", "1/b"), ("invalid-candidate-origin-date", "1/b"), ("invalid-candidate-origin-method", "1/b"), ("unresolved-candidate-origin-source", "1/b")]
    r = spark.createDataFrame([("1", "f", 1, "GAP", None, None), ("2", " ", 0, "?", " ", "x")], "concept_id string, artifact string, row int, bucket string, candidate_term string, suggested_form string")
    assert {x.code for x in registry.research_findings(r, ["GAP"]).collect()} == {"invalid-research-artifact", "invalid-research-row", "invalid-research-bucket", "invalid-research-candidate-term"}
    t = spark.createDataFrame([("1", "Tay", "tay"), ("2", "tay", "tay"), ("3", "x", "x"), ("1", "o", "o"), ("2", "o", "o")], "concept_id string, term string, key string")
    ids = spark.createDataFrame([("1",), ("2",)], "concept_id string")
    may = spark.createDataFrame([("1", "o"), ("2", "o")], "concept_id string, term string")
    assert rows(registry.collision_findings(t, ids, may), "code", "entity_id") == [("normalized-alias-collision", "o"), ("normalized-alias-collision", "tay"), ("release-normalized-alias-collision", "tay")]
    c = spark.createDataFrame([("1", ["a"]), ("2", ["b"])], "concept_id string, elements array<string>")
    p = spark.createDataFrame([("1", "left hand", ["a"], ["side"], None), ("2", "hand", ["c"], ["side"], "x"), ("3", "hand", ["c"], [], None)], "concept_id string, name string, elements array<string>, tags array<string>, target string")
    assert rows(registry.pilot_findings(p, c, {"side": "left|right"}, ["target"]), "code", "entity_id") == [("pilot-elements-differ", "2"), ("pilot-forbidden-field", "2"), ("pilot-unknown-concept", "3"), ("pilot-unsupported-tag", "2")]
    m = spark.createDataFrame([("name", "a"), ("rev", "b")], "name string, value string")
    assert rows(registry.release_findings(m, spark.createDataFrame([("name", "a"), ("rev", "c")], "name string, value string")), "code") == [("release-rev-mismatch",)]


def test_export_gate_follows_every_need(spark):
    chain = [(i, i - 1) for i in range(2, 15)]
    needs = spark.createDataFrame(chain + [(21, 99), (22, 21), (30, 31), (31, 30), (40, 41), (41, 40), (41, 1)], "id long, needs long")
    ids = [*range(1, 15), 21, 22, 30, 31, 40, 41, 50]
    got = registry.export_gate(spark.createDataFrame([(i, i != 1) for i in ids], "id long, cleared boolean"), needs)
    assert {r.id for r in got.collect() if r.exportable} == {30, 31, 50}


def test_joined_sets_and_differences(spark):
    from lexspark.operators import patch

    p = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (3, 1), (3, 2), (1, 1)], "concept_id long, patch_set int")
    e = spark.createDataFrame([(3,), (1,), (9,)], "concept_id long")
    got = {r.concept_id: (r.sets, r.state) for r in patch.joined_sets(p, e).collect()}
    assert got == {1: (1, "MISSING_OVERLAP"), 2: (2, "UNEXPECTED_OVERLAP"), 3: (2, "EXPECTED_OVERLAP"), 9: (0, "MISSING_OVERLAP")}
    assert {(r.concept_id, r.side) for r in patch.set_difference(p, e).collect()} == {(2, "LEFT"), (9, "RIGHT")}
    assert patch.set_difference(e, e).count() == 0


def test_ledgers_and_lists(spark):
    from pyspark.sql import functions as F

    from lexspark.functions import text
    from lexspark.operators import compose, metrics, report

    d = spark.createDataFrame([("a", "x"), ("a", "yy"), ("a", "yy"), ("a", None), ("b", "Hót dog")], "k string, v string")
    got = {r.k: (r.shown, r["values"], r.more) for r in report.truncated_lists(d, ["k"], "v", 1, [F.length("v").desc()]).collect()}
    assert got == {"a": (["yy"], 2, 1), "b": (["Hót dog"], 1, 0)}
    assert [r.c for r in d.select(text.contains_any("v", ["hot"]).alias("c")).collect()] == [False, False, False, False, True]
    rows = {r.category: r.rows for r in metrics.exclusive_categories(d, {"A": F.col("k") == "a", "Y": F.col("v") == "yy"}).collect()}
    assert rows == {"A": 2, "Y": 0, "NONE": 1, "SEVERAL": 2}
    lex = spark.createDataFrame([("w", "p", 1), ("w", "s", 2), ("w", "r", 2), ("w", None, 3)], "component string, term string, layer int")
    assert [tuple(r) for r in compose.verified_lexicon(lex).collect()] == [("w", "r", 2)]


def test_line_facts(spark):
    from lexspark.operators import reconstruct

    d = spark.createDataFrame([(1, "*A01.1 Neck"), (2, "7"), (3, "7 of it"), (4, "in A01.1"), (5, None), (6, "## A01.1")], "id int, t string")
    f = reconstruct.line_facts("t", r"A\d{2}\.\d", r"^(\d)(?:\s+(.*))?$", ["^##"], r"\b(?:of|neck)\b")
    got = {r.id: tuple(r.f) for r in d.select("id", f.alias("f")).collect()}
    assert got == {1: ("A01.1", "Neck", None, False, True), 2: (None, "", "7", False, False), 3: (None, "of it", "7", False, True), 4: (None, "in A01.1", None, False, False), 5: (None, "", None, False, False), 6: (None, "## A01.1", None, True, False)}


def test_release_safety_fails_closed(spark):
    from lexspark.operators import metrics

    e = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    found, files = spark.createDataFrame([("warning",)], "severity string"), spark.createDataFrame([("MATCH",)], "state string")
    run = lambda f, s: tuple(metrics.release_safety(e, {"big": F.col("n") > 1}, f, s).first())
    assert run(found, files) == (3, 1, 33.33, 0, 0, True)
    assert run(found.union(spark.createDataFrame([(None,)], "severity string")), files) == (3, 1, 33.33, 1, 0, False)
    assert run(found.limit(0), files.union(spark.createDataFrame([("MISSING",), (None,)], "state string"))) == (3, 1, 33.33, 0, 2, False)


def test_a_row_in_no_category_or_in_several_stops_the_job(spark):
    d = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    sound = {"A": F.col("k") < 2, "B": F.col("k") >= 2, "C": F.col("k") > 9}
    got = metrics.sealed_ledger(d, sound)
    assert {(r.category, r["rows"]) for r in got.collect()} == {("A", 1), ("B", 2), ("C", 0)} and got.select("digest").distinct().count() == 1
    for off in ({"A": F.col("k") < 3, "B": F.col("k") >= 2}, {"A": F.col("k") < 2}):
        with pytest.raises(Exception, match="in no category or in several"):
            metrics.sealed_ledger(d, off).collect()
    assert {r["rows"] for r in metrics.sealed_ledger(d.limit(0), sound).collect()} == {0}


def test_rules_over_tags_and_names(spark):
    d = spark.createDataFrame([("vein wall", ["category:artery"]), ("a vein", []), ("tendon", None), (None, ["x"]), (None, None)], "name string, tags array<string>")
    table = [{"name": "arteries", "when": {"any": [{"field": "tags", "has_tag": ["category:artery", "category:arteriole"]}, {"field": "name", "matches": "arter"}]}}, {"name": "veins", "when": {"field": "name", "matches": r"\bvein\b"}}, {"name": "x", "when": {"not": {"field": "name", "matches": "."}}}]
    assert [r.f for r in d.select(rules.first_rule_of(table, "other").alias("f")).collect()] == ["arteries", "veins", "other", "x", "x"]


def test_neighbours_by_bitmaps_are_those_by_pairs(spark):
    import random

    rng = random.Random(4)
    rows_ = [(f"c{c}", f"e{e}") for c in range(60) for e in range(12) if rng.random() < 0.05 + 0.4 * (e < 3)] + [("alone", "own"), ("c0", "e0"), (None, "e1")]
    m = spark.createDataFrame(rows_, "concept_id string, element_id string")
    held = {}
    for c, e in set(rows_):
        held.setdefault(e, set()).add(c)
    want = {}
    for c in {c for c, _ in rows_ if c is not None}:
        mine = [e for e in held if c in held[e]]
        near = {d for e in mine for d in held[e]} - {c, None}
        want[c] = (len(mine), sum(len(held[e]) > 1 for e in mine), len(near), sorted(near)[:3])
    for hot in (2, 10, 1000):
        got = {r.concept_id: (r.elements, r.shared_elements, r.overlapping, r.first_overlaps or []) for r in match.shared_membership(m.filter("concept_id is not null"), show=3, hot=hot).collect()}
        sized = {c: (n, s - sum(1 for e in held if c in held[e] and len(held[e] - {None}) == 1 and len(held[e]) > 1), k, f) for c, (n, s, k, f) in want.items()}
        assert got == sized
    assert match.shared_membership(m.limit(0)).collect() == []


def test_first_rows_of_a_hot_key(spark):
    from lexspark.operators.topk import first_k

    d = spark.range(3000).select(F.when(F.col("id") < 2900, "hot").otherwise("cold").alias("key"), (F.col("id") % 1000).alias("v"), "id")
    got = first_k(d, ["key"], [F.col("v").desc(), F.col("id")], 4).collect()
    want = {"hot": [(999, 999), (999, 1999), (998, 998), (998, 1998)], "cold": [(999, 2999), (998, 2998), (997, 2997), (996, 2996)]}
    assert {k: [(r.v, r.id) for r in sorted(got, key=lambda r: r["rank"]) if r.key == k] for k in want} == want


def test_one_of_many_and_the_default_list(spark):
    names = spark.createDataFrame([("k", 1), ("k", 1), ("j", 1), ("j", 2), ("j", 3), (None, 4), ("l", None)], "key string, concept_id int")
    v = spark.createDataFrame([("a", 1, "k"), ("b", 1, "j"), ("c", 1, "x"), ("d", 1, "x"), ("d", 2, "k"), ("e", 1, "k"), ("e", 2, "j"), ("f", 1, None), ("g", 1, "l")], "row_id string, tier int, key string")
    got = {r.row_id: (r.outcome, r.concept_id, r.tier) for r in match.unique_match(v, names).collect()}
    assert got == {"a": ("ONE", 1, 1), "b": ("MANY", None, None), "c": ("NONE", None, None), "d": ("ONE", 1, 2), "e": ("MANY", None, None), "f": ("NONE", None, None), "g": ("NONE", None, None)}
    t = spark.createDataFrame([("1", "Heart", 5, ["heart", "cor"]), ("2", "heart", 2, ["heart"]), ("3", "Liver", 1, ["liver"])], "concept_id string, display_name string, pos int, keys array<string>")
    assert [r.concept_id for r in search.search(t, "  ", default=["Liver", "brain", "HEART"]).collect()] == ["3", "2"]


def test_neighbours_by_blocks_dealt_out(spark, monkeypatch):
    import random

    rng = random.Random(7)
    rows_ = {(c, rng.randrange(9) + 40 * (c % 3)) for c in range(40) for _ in range(4)} | {(c, 500) for c in range(12)} | {(99, 501)}
    held = {}
    for c, e in rows_:
        held.setdefault(e, set()).add(c)
    want = {c: len({d for e in held if c in held[e] for d in held[e]} - {c}) for c, _ in rows_}
    monkeypatch.setattr(match, "BLOCK_BITS", 2)
    for pairs in (5, 1 << 20):
        monkeypatch.setattr(match, "BLOCK_PAIRS", pairs)
        for hot in (12, 1000):
            got = match.shared_membership(spark.createDataFrame(sorted(rows_), "concept_id long, element_id long"), show=0, hot=hot).collect()
            assert {r.concept_id: r.overlapping for r in got} == want and {r.first_overlaps for r in got} == {None}


def test_findings_of_records_with_one_id_are_united_and_rules_need_no_shuffle(spark):
    r = spark.createDataFrame([("a", "small ring", "gnir", True, False), ("a", "small ring", "ti gnir", True, False), ("b", "a small ring", "ti", True, False), (None, "small", "x", True, False), ("c", None, None, True, False), ("d", "x y", "y", True, False)], "concept_id string, pivot string, target string, generated boolean, conflict boolean")
    rules_ = spark.createDataFrame([("NEEDS_TI", "small", "ti", None), ("PHRASE", "small ring", "gnir", None), ("FORBIDS", "x", None, "y"), ("NEVER", None, "z", None)], "code string, when_pivot string, needs string, forbids string")
    found = quality.findings(r, rules_)
    assert {x.concept_id: x.codes for x in found.collect()} == {"a": ["NEEDS_TI"], "b": ["PHRASE"], None: ["NEEDS_TI"], "c": ["EMPTY"], "d": ["FORBIDS"]}
    # one exchange of the records by concept, and those of the few rules
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1 and "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((x.concept_id or "", x.target or "", x.status, x.before) for x in quality.qa_status(r, rules_).collect())
    assert got == [("", "x", "CLEAR", None), ("a", "gnir", "NEEDS_HUMAN", ["NEEDS_TI"]), ("a", "ti gnir", "NEEDS_HUMAN", ["NEEDS_TI"]), ("b", "ti", "NEEDS_HUMAN", ["PHRASE"]), ("c", "", "NEEDS_HUMAN", ["EMPTY"]), ("d", "y", "NEEDS_HUMAN", ["FORBIDS"])]


def test_direct_kind_multiplies_rows_by_two_counts_only(spark):
    rows_ = [("a", "t", "t", "x", 1), ("a", "t", "u", "x", 1), ("b", "t", "t", "x", 1), ("b", "t", "t", "y", 2), ("c", "t", None, "x", 1), ("c", "t", "t", None, 2), ("d", None, None, None, 1), ("e", "t", "t", "x", 1)]
    out = consensus.direct_kind(spark.createDataFrame(rows_, "concept_id string, term string, agreement string, surface string, source_id int"))
    assert {r.concept_id: (r.kind, r.terms, r.sources) for r in out.collect()} == {"a": ("VARIANT", 1, 1), "b": ("CONFLICT", 1, 2), "c": ("MULTI", 1, 2), "d": ("NONE", 0, 1), "e": ("DIRECT", 1, 1)}
    expand = next(x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Expand" in x)
    # three rows for one, and the names of the columns behind them; four counts would make four
    assert expand.count("], [") == 3


def test_ways_of_components_join_distinct_rows(spark):
    u = spark.createDataFrame([(1, "c", "k", "t"), (1, "c", "k", "t"), (2, "c", "l", "u"), (3, "d", "k", "t"), (None, "c", None, None)], "concept_id int, component string, key string, term string")
    out = quality.inconsistent_components(u)
    assert sorted((r.concept_id or 0, r.component, r.ways) for r in out.collect()) == [(0, "c", ["t", "u"]), (1, "c", ["t", "u"]), (2, "c", ["t", "u"])]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and not any("Aggregate" in x and "ways" in x.split("]")[0] for x in plan.splitlines())
