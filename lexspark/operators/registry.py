"""A term registry: rules over its exploded tables, and the gates before release.

Tables (DataFrames by name): sources, reviewers, concepts (concept_id, name, elements), entries
(concept_id, key, pivot, target, third, mapping_status, mapping_disposition, elements, revision,
review_status), claims, mappings, audits, conflicts. All are keyed by concept_id and their own id.
A rule is data: (code, severity, predicate) for a table, and each relation is one join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexspark.functions.text import exact_locator, fold_key, is_blank, is_iso_date, is_url, locator_supported
from lexspark.operators.evidence import findings_of
from lexspark.sources.io import shared_checkpoints

E, W = "error", "warning"

#: Enumerations of the registry's fields.
ENUMS: dict[str, tuple[str, ...]] = {
    "access_status": ("FULL_ACCESS", "PARTIAL_ACCESS", "METADATA_ONLY", "UNAVAILABLE"),
    "authority_tier": ("authoritative", "corroborative", "discovery-only", "rejected"),
    "locator_capability": ("PAGE", "PLATE", "CHAPTER_SECTION", "TERM_ID", "STABLE_ENTRY", "INSUFFICIENT"),
    "source_status": ("UNVERIFIED", "VERIFIED"),
    "reviewer_status": ("ACTIVE", "INACTIVE"),
    "evidence_disposition": ("CANDIDATE", "SUPPORTED", "REJECTED", "SUPERSEDED"),
    "review_state": ("PENDING", "VERIFIED", "REJECTED"),
    "mapping_status": ("UNMAPPED", "MAPPED", "REJECTED"),
    "unmapped_disposition": ("NOT_INVESTIGATED", "UNRESOLVED", "CONFIRMED_NO_EQUIVALENT"),
    "relation": ("exact", "equivalent", "target-broader", "target-narrower", "overlapping", "related", "composite", "collective", "obsolete-replaced"),
    "accepted_relation": ("exact", "equivalent", "composite", "collective"),
    "mapping_disposition": ("CANDIDATE", "VERIFIED", "REJECTED", "SUPERSEDED"),
    "audit_type": ("source-verification", "medical-review", "release-eligibility"),
    "audit_status": ("PENDING", "PASSED", "REJECTED"),
    "conflict_status": ("OPEN", "ADJUDICATED", "REJECTED"),
    "conflict_type": ("identity-disagreement", "granularity-disagreement", "contextual-difference", "edition-version-difference", "competing-preferred-terminology"),
    "review_status": ("UNMAPPED", "DRAFT", "SOURCE_VERIFIED", "MEDICAL_REVIEWED", "VERIFIED", "RELEASE_ELIGIBLE", "REJECTED"),
}


#: Lists of an entry's forms, and the type of claim that approves a form.
SEARCH_FORMS = (("pivot", "aliases", "pivot-alias"), ("third", "aliases", "third-alias"), ("target", "aliases", "target-alias"), ("target", "search_aliases", "target-search-alias"), ("target", "ascii_forms", "target-search-alias"))


def _not_in(c: str, enum: str) -> Column:
    return ~F.coalesce(F.col(c).isin(*ENUMS[enum]), F.lit(False))


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def source_rules() -> list[tuple[str, str, Column]]:
    c = F.col
    cap = lambda k: _yes(c("capabilities")[k])
    verified = _yes(c("audit.status") == "VERIFIED")
    closed = _yes(c("access_status").isin("METADATA_ONLY", "UNAVAILABLE"))
    machine, target = _yes(c("class") == "machine-generated"), _yes(c("class") == "target-authoritative")
    return [
        ("invalid-source-id", E, is_blank("id")), ("invalid-source-title", E, is_blank("title")), ("invalid-source-revision", E, is_blank("revision")),
        ("invalid-source-authority-tier", E, _not_in("authority_tier", "authority_tier")), ("invalid-source-access-status", E, _not_in("access_status", "access_status")),
        ("invalid-source-locator-capability", E, _not_in("locator_capability", "locator_capability")), ("missing-source-capabilities", E, c("capabilities").isNull()),
        ("invalid-source-audit", E, _not_in("audit.status", "source_status")), ("verified-source-missing-audit", E, verified & (~is_iso_date("audit.verified_at") | is_blank("audit.verified_by"))),
        ("verified-source-identity-mismatch", E, verified & ~_yes(c("identity_verified"))), ("identity-without-verified-audit", E, _yes(c("identity_verified")) & ~verified),
        ("access-status-full-text-conflict", E, closed & _yes(c("full_text_available"))), ("access-status-inspection-conflict", E, closed & _yes(c("content_inspected"))),
        ("full-text-with-insufficient-locator", W, _yes(c("locator_capability") == "INSUFFICIENT") & _yes(c("full_text_available"))),
        ("source-capability-conflict", E, (machine & (~cap("machine_discovery") | cap("identity") | cap("canonical") | cap("target_preferred") | cap("corroboration"))) | (target & ~cap("target_preferred")) | (_yes(c("class") == "dataset") & ~cap("identity")) | (_yes(c("class") == "secondary-reference") & ~cap("corroboration")) | (cap("machine_discovery") & ~machine)),
        ("machine-source-authority-conflict", E, machine & ~_yes(c("authority_tier") == "discovery-only")), ("target-source-authority-conflict", E, target & ~_yes(c("authority_tier") == "authoritative")),
        ("rejected-source-verified", E, _yes(c("authority_tier") == "rejected") & verified), ("invalid-source-url", E, ~is_blank("url") & ~is_url("url")),
        ("access-copy-authority-conflict", E, ~is_blank("access_copy_of") & ~_yes(c("authority_tier") == "discovery-only")),
    ]


def reviewer_rules() -> list[tuple[str, str, Column]]:
    return [
        ("invalid-reviewer-id", E, is_blank("id")), ("invalid-reviewer-identity", E, is_blank("display_name") | is_blank("role")), ("invalid-reviewer-status", E, _not_in("status", "reviewer_status")),
        ("invalid-reviewer-evidence", E, ~is_blank("evidence_ref") & ~is_url("evidence_ref") & ~F.col("evidence_ref").startswith("git:")),
    ]


def source_usable(s: Column, locator: Column) -> Column:
    """Whether a source (struct) can be evidence at a locator: identified, inspected, open, not discovery-only."""
    return (
        _yes(s["identity_verified"]) & ~_yes(s["authority_tier"].isin("discovery-only", "rejected")) & ~_yes(s["access_status"].isin("METADATA_ONLY", "UNAVAILABLE"))
        & _yes(s["full_text_available"]) & _yes(s["content_inspected"]) & locator_supported(s["locator_capability"], locator)
    )


def capability_of(kind: Column, capabilities: Mapping[str, str], s: Column) -> Column:
    """Whether the source has the capability that a claim of this type asks for. capabilities: by claim type."""
    out = F.lit(True)
    for k, need in capabilities.items():
        out = F.when(kind == k, _yes(s["capabilities"][need])).otherwise(out)
    return out


def with_source(claims: DataFrame, sources: DataFrame) -> DataFrame:
    s = sources.select(F.col("id").alias("source_id"), F.struct("*").alias("s"))
    return claims.join(s, "source_id", "left")


def claim_rules(capabilities: Mapping[str, str], types: Sequence[str]) -> list[tuple[str, str, Column]]:
    """Rules on claims joined with their source as `s`."""
    c, s, at = F.col, F.col("s"), F.col("locator")
    known = s.isNotNull()
    firm = _yes(c("evidence_disposition") == "SUPPORTED") | _yes(c("review_state") == "VERIFIED")
    return [
        ("invalid-claim-id", E, is_blank("id")), ("invalid-claim-type", E, ~_yes(c("type").isin(*types))), ("invalid-claim-target", E, is_blank("target")),
        ("unresolved-claim-source", E, ~known), ("invalid-claim-source-revision", E, is_blank("source_revision")), ("claim-source-revision-mismatch", E, known & ~c("source_revision").eqNullSafe(s["revision"])),
        ("claim-capability-mismatch", E, known & ~capability_of(c("type"), capabilities, s)), ("source-evidence-unusable", E, firm & known & ~source_usable(s, at)),
        ("target-claim-source-authority", E, known & _yes(c("type").startswith("target-")) & ~(_yes(s["class"] == "target-authoritative") & _yes(s["authority_tier"] == "authoritative"))),
        ("third-claim-source-authority", E, known & _yes(c("type").startswith("third-")) & ~_yes(s["class"] == "nomenclature")),
        ("invalid-claim-locator", E, at.isNull()), ("invalid-claim-page", E, _yes(at["page"] <= 0)), ("invalid-claim-url", E, ~is_blank(at["url"]) & ~is_url(at["url"])), ("unreproducible-claim", E, firm & at.isNotNull() & ~exact_locator(at)),
        ("invalid-evidence-disposition", E, _not_in("evidence_disposition", "evidence_disposition")), ("invalid-claim-review-state", E, _not_in("review_state", "review_state")),
        ("verified-claim-without-support", E, _yes(c("review_state") == "VERIFIED") & ~_yes(c("evidence_disposition") == "SUPPORTED")), ("machine-claim-authority", E, known & _yes(s["class"] == "machine-generated") & _yes(c("review_state") == "VERIFIED")),
    ]


def duplicate_findings(df: DataFrame, keys: Sequence[str], code: str, table: str) -> DataFrame:
    d = df.groupBy(*keys).count().filter("count > 1")
    return _finding(d, code, E, F.concat_ws("/", *keys), table)


def missing_findings(df: DataFrame, on: Mapping[str, str], parent: DataFrame, code: str, entity: Column, table: str, severity: str = E) -> DataFrame:
    """Rows whose columns (keys of `on`) are in no row of the parent (its values); null references are not looked up."""
    p = parent.select(*[F.col(v).alias(f"_{k}") for k, v in on.items()]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in on])
    some = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    return _finding(df.filter(some).join(p, cond, "left_anti"), code, severity, entity, table)


def _finding(df: DataFrame, code: str, severity: str, entity: Column, table: str) -> DataFrame:
    return df.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), entity.cast("string").alias("entity_id"), F.lit(table).alias("path"), F.concat_ws(" ", F.lit(table), F.lit("rule"), F.lit(code)).alias("message"))


def validate(tables: Mapping[str, DataFrame], capabilities: Mapping[str, str], types: Sequence[str], nomenclatures: Mapping[str, str] | None = None) -> DataFrame:
    """finding(code, severity, entity_id, path, message) of all rules on the tables that are given.

    capabilities: needed capability by claim type. types: claim types. nomenclatures: claim type
    that evidences a mapping in a namespace.
    """
    c = F.col
    t, out = dict(tables), []
    claim_id = F.concat_ws("/", "concept_id", "id")
    if "sources" in t:
        s = t["sources"]
        out += [findings_of(s, source_rules(), "id", "sources"), duplicate_findings(s, ["id"], "duplicate-source-id", "sources")]
        copies = s.filter(~is_blank("access_copy_of"))
        out += [missing_findings(copies, {"access_copy_of": "id"}, s, "unresolved-access-copy-target", c("id"), "sources"), _finding(copies.filter("access_copy_of = id"), "unresolved-access-copy-target", E, c("id"), "sources")]
    if "reviewers" in t:
        out += [findings_of(t["reviewers"], reviewer_rules(), "id", "reviewers"), duplicate_findings(t["reviewers"], ["id"], "duplicate-reviewer-id", "reviewers")]
    if "claims" in t:
        k = with_source(t["claims"], t["sources"]).withColumn("_entity", claim_id)
        out += [findings_of(k, claim_rules(capabilities, types), "_entity", "claims"), duplicate_findings(t["claims"], ["concept_id", "id"], "duplicate-claim-id", "claims")]
    if "entries" in t:
        e = t["entries"]
        rules = [
            ("entry-key-mismatch", E, ~c("key").eqNullSafe(c("concept_id"))), ("invalid-pivot-field", E, is_blank("pivot.preferred")), ("invalid-mapping-status", E, _not_in("mapping_status", "mapping_status")),
            ("unmapped-without-disposition", E, _yes(c("mapping_status") == "UNMAPPED") & _not_in("mapping_disposition", "unmapped_disposition")),
            ("duplicate-normalized-term", E, reduce(lambda a, b: a | b, [_yes(F.size(c(f"{x}.aliases")) != F.size(F.array_distinct(F.transform(c(f"{x}.aliases"), lambda v: fold_key(v))))) for x in ("pivot", "target")])),
            ("invalid-ascii-search-form", E, _yes(F.exists("target.ascii_forms", lambda v: fold_key(v) != F.lower(F.trim(v))))),
        ]
        out += [findings_of(e, rules, "concept_id", "entries"), duplicate_findings(e, ["key"], "duplicate-entry-key", "entries")]
        if "concepts" in t:
            k = t["concepts"]
            out.append(missing_findings(e, {"concept_id": "concept_id"}, k, "orphan-concept-id", c("concept_id"), "entries"))
            both = e.join(k.select("concept_id", "name", F.col("elements").alias("_has")), "concept_id")
            out.append(_finding(both.filter("pivot.preferred <> name"), "pivot-snapshot-mismatch", W, c("concept_id"), "entries"))
            if "element_scope" in e.columns:
                both = both.filter("element_scope = 'packaged'")  # others are listed elsewhere
            listed = both.select("concept_id", F.explode("elements").alias("element_id"), "_has")
            member = F.concat_ws("/", "concept_id", "element_id")
            if "parts" in t:
                out.append(missing_findings(listed, {"element_id": "element_id"}, t["parts"], "unknown-packaged-element-id", member, "entries"))
                listed = listed.join(t["parts"].select("element_id").distinct(), "element_id", "left_semi")
            out.append(_finding(listed.filter(~F.coalesce(F.array_contains("_has", c("element_id")), F.lit(False))), "mesh-membership-mismatch", E, member, "entries"))
        if "claims" in t:
            has = {f"{g.name}.{f.name}" for g in e.schema.fields if isinstance(g.dataType, StructType) for f in g.dataType.fields}
            lists = [(f"{x}.{f}", k) for x, f, k in SEARCH_FORMS if f"{x}.{f}" in has]
            forms = e.select("concept_id", F.explode(F.array(*[F.struct(F.lit(k).alias("type"), F.col(p).alias("terms")) for p, k in lists])).alias("f")).select("concept_id", "f.type", F.explode("f.terms").alias("target"))
            out.append(missing_findings(forms, {"concept_id": "concept_id", "type": "type", "target": "target"}, t["claims"], "unapproved-search-form", F.concat_ws("/", "concept_id", "target"), "entries", W))
            preferred = t["claims"].filter("type = 'target-preferred'").join(e.select("concept_id", F.col("target.preferred").alias("_p")), "concept_id")
            out.append(_finding(preferred.filter("_p is not null and target <> _p"), "preferred-claim-target-mismatch", W, claim_id, "claims"))
    if "mappings" in t:
        m = t["mappings"]
        rules = [("invalid-external-mapping-field", E, is_blank("id") | is_blank("namespace") | is_blank("identifier") | is_blank("source_revision")), ("invalid-mapping-relation", E, _not_in("relation", "relation")), ("invalid-external-mapping-disposition", E, _not_in("disposition", "mapping_disposition")), ("verified-mapping-without-evidence", E, _yes(c("disposition") == "VERIFIED") & (F.coalesce(F.size("evidence_claim_ids"), F.lit(0)) <= 0))]
        out += [findings_of(m.withColumn("_entity", claim_id), rules, "_entity", "mappings"), duplicate_findings(m, ["concept_id", "id"], "duplicate-external-mapping-id", "mappings")]
        if "claims" in t:
            out.append(_mapping_evidence(m, t["claims"], nomenclatures or {}))
        if "entries" in t:
            g = m.groupBy("concept_id").agg(F.bool_or(c("disposition") == "VERIFIED").alias("_verified"))
            g = t["entries"].select("concept_id", "mapping_status").join(g, "concept_id", "left")
            out += [_finding(g.filter("mapping_status = 'MAPPED' and _verified is null"), "mapped-without-external-mapping", E, c("concept_id"), "entries"), _finding(g.filter("mapping_status <> 'MAPPED' and _verified"), "verified-mapping-with-unmapped-status", E, c("concept_id"), "entries")]
    if "audits" in t:
        out += _audit_findings(t)
    if "conflicts" in t:
        out += _conflict_findings(t)
    return reduce(lambda a, b: a.union(b), out)


def _mapping_evidence(m: DataFrame, claims: DataFrame, nomenclatures: Mapping[str, str]) -> DataFrame:
    ids = m.select("concept_id", F.col("id").alias("mapping_id"), "namespace", "identifier", F.col("source_revision").alias("revision"), F.explode("evidence_claim_ids").alias("claim_id"))
    k = claims.select("concept_id", F.col("id").alias("claim_id"), "type", "target", "source_revision", "locator", F.lit(True).alias("_known"))
    d = ids.join(k, ["concept_id", "claim_id"], "left")
    want = F.lit(None).cast("string")
    for name, kind in nomenclatures.items():
        want = F.when(F.upper("namespace") == name.upper(), kind).otherwise(want)
    code = (
        F.when(F.col("_known").isNull(), "missing-mapping-claim").when(~F.col("target").eqNullSafe(F.col("identifier")) | ~F.col("source_revision").eqNullSafe(F.col("revision")), "mapping-claim-target-mismatch")
        .when(want.isNotNull() & ~F.col("locator.nomenclature_id").eqNullSafe(F.col("identifier")), "mapping-nomenclature-locator-mismatch").when(want.isNotNull() & (F.col("type") != want), "mapping-claim-type-mismatch")
    )
    d = d.withColumn("code", code).filter("code is not null")
    return d.select("code", F.lit(E).alias("severity"), F.concat_ws("/", "concept_id", "mapping_id", "claim_id").alias("entity_id"), F.lit("mappings").alias("path"), F.concat_ws(" ", F.lit("mappings rule"), "code").alias("message"))


def _audit_findings(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    c = F.col
    a = t["audits"].join(t["entries"].select("concept_id", c("revision").alias("_revision")), "concept_id", "left")
    a = a.join(t["reviewers"].select(c("id").alias("reviewer_id"), c("status").alias("_r_status"), c("authorization_scope").alias("_scope")), "reviewer_id", "left").withColumn("_entity", F.concat_ws("/", "concept_id", "type"))
    passed, human = _yes(c("status") == "PASSED"), _yes(c("type") != "release-eligibility")
    named = ~is_blank("reviewer_id")
    covers = F.array_contains("_scope", "*") | (F.size(F.array_except("claim_ids", "_scope")) == 0)
    rules = [
        ("invalid-review-audit-type", E, _not_in("type", "audit_type")), ("invalid-review-audit-status", E, _not_in("status", "audit_status")), ("invalid-review-audit-date", E, ~is_blank("reviewed_at") & ~is_iso_date("reviewed_at")),
        ("passed-audit-incomplete", E, passed & (~is_iso_date("reviewed_at") | ~_yes(c("decision") == "APPROVE"))), ("passed-audit-missing-claims", E, passed & (F.coalesce(F.size("claim_ids"), F.lit(0)) <= 0)),
        ("stale-approval", E, passed & ~c("entry_revision").eqNullSafe(c("_revision"))), ("missing-reviewer-id", E, passed & human & ~named), ("unregistered-reviewer", E, passed & human & named & c("_r_status").isNull()),
        ("inactive-reviewer", E, passed & human & _yes(c("_r_status") != "ACTIVE")), ("unauthorized-reviewer", E, passed & human & _yes(c("_r_status") == "ACTIVE") & ~_yes(covers)),
        ("medical-review-requires-human", E, passed & _yes(c("type") == "medical-review") & (_yes(c("automated")) | ~named)),
    ]
    out = [findings_of(a, rules, "_entity", "audits")]
    ids = t["audits"].select("concept_id", "type", F.explode("claim_ids").alias("claim_id"))
    out.append(missing_findings(ids, {"concept_id": "concept_id", "claim_id": "id"}, t["claims"], "review-unknown-claim", F.concat_ws("/", "concept_id", "type", "claim_id"), "audits"))
    if "review_status" in t["entries"].columns:
        g = t["audits"].groupBy("concept_id").agg(F.collect_set("type").alias("_types"))
        e = t["entries"].join(g, "concept_id", "left").filter(c("review_status").isin("VERIFIED", "RELEASE_ELIGIBLE") & ~_yes(F.array_contains("_types", "source-verification") & F.array_contains("_types", "medical-review")))
        out.append(_finding(e, "missing-review-audit", E, c("concept_id"), "entries"))
    return out


def _conflict_findings(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    c = F.col
    x = t["conflicts"].join(t["entries"].select("concept_id", c("revision").alias("_revision"), c("target.preferred").alias("_preferred")), "concept_id", "left")
    x = x.join(t["reviewers"].select(c("id").alias("reviewer_id"), c("status").alias("_r_status")), "reviewer_id", "left").withColumn("_entity", F.concat_ws("/", "concept_id", "id"))
    settled, is_open = _yes(c("status") == "ADJUDICATED"), _yes(c("status") == "OPEN")
    rules = [
        ("invalid-conflict-id", E, is_blank("id")), ("invalid-conflict-status", E, _not_in("status", "conflict_status")), ("conflict-awaiting-adjudication", W, is_open), ("open-conflict-preferred-term", E, is_open & ~is_blank("_preferred")),
        ("invalid-conflict-adjudication", E, settled & (is_blank("decision") | is_blank("rationale") | is_blank("reviewer_id") | ~c("entry_revision").eqNullSafe(c("_revision")))),
        ("unregistered-conflict-reviewer", E, settled & ~_yes(c("_r_status") == "ACTIVE")),
    ]
    ids = t["conflicts"].select("concept_id", "id", F.explode("claim_ids").alias("claim_id"))
    return [findings_of(x, rules, "_entity", "conflicts"), missing_findings(ids, {"concept_id": "concept_id", "claim_id": "id"}, t["claims"], "conflict-unknown-claim", F.concat_ws("/", "concept_id", "id", "claim_id"), "conflicts")]


def origin_findings(origins: DataFrame, sources: DataFrame) -> DataFrame:
    """Rules on where candidates come from: concept_id, id, method, created_at, source_id."""
    o = origins.withColumn("_entity", F.concat_ws("/", "concept_id", "id"))
    rules = [("invalid-candidate-origin", E, is_blank("id")), ("invalid-candidate-origin-method", E, ~_yes(F.col("method").isin("human", "machine"))), ("invalid-candidate-origin-date", E, ~is_iso_date("created_at"))]
    out = findings_of(o, rules, "_entity", "candidate_origins").union(duplicate_findings(origins, ["concept_id", "id"], "invalid-candidate-origin", "candidate_origins"))
    return out.union(missing_findings(o, {"source_id": "id"}, sources, "unresolved-candidate-origin-source", F.col("_entity"), "candidate_origins"))


def research_findings(research: DataFrame, buckets: Sequence[str]) -> DataFrame:
    """Rules on research dispositions: concept_id, artifact, row, bucket, candidate_term, suggested_form."""
    odd = lambda c: F.col(c).isNotNull() & is_blank(c)
    rules = [
        ("invalid-research-artifact", E, is_blank("artifact")), ("invalid-research-row", E, ~_yes(F.col("row") > 0)), ("invalid-research-bucket", E, ~_yes(F.col("bucket").isin(list(buckets)))),
        ("invalid-research-candidate-term", E, odd("candidate_term")), ("invalid-research-suggested-form", E, odd("suggested_form")),
    ]
    return findings_of(research, rules, "concept_id", "research")


def readiness_findings(entries: DataFrame, released: DataFrame, languages: Sequence[tuple[str, str]] = (("target", "unreleased-search-term"), ("third", "unreleased-third"))) -> DataFrame:
    """Warnings of entries that have a term in a language in which they are not released: it cannot enter the search.

    released: concept_id, language. languages: a language's column and its code.
    """
    out = None
    for language, code in languages:
        if language not in entries.columns:
            continue
        held = entries.filter(~is_blank(F.col(language)["preferred"]))
        open_ = held.join(released.filter(F.col("language") == language).select("concept_id").distinct(), "concept_id", "left_anti")
        now = _finding(open_, code, W, F.col("concept_id"), "entries")
        out = now if out is None else out.union(now)
    return out


def collision_findings(terms: DataFrame, released: DataFrame, permitted: DataFrame) -> DataFrame:
    """Keys of search terms (concept_id, term, key) on several concepts: a warning; among released concepts an error, unless every term is permitted (concept_id, term)."""
    t = terms.select("concept_id", "term", "key").distinct()
    many = lambda d: d.groupBy("key").agg(F.count_distinct("concept_id").alias("_n"), F.bool_and("_ok").alias("_ok")).filter("_n > 1")
    out = _finding(many(t.withColumn("_ok", F.lit(True))), "normalized-alias-collision", W, F.col("key"), "search_terms")
    ok = permitted.select("concept_id", "term").distinct().withColumn("_may", F.lit(True))
    r = t.join(released.select("concept_id"), "concept_id", "left_semi").join(ok, ["concept_id", "term"], "left").withColumn("_ok", F.coalesce("_may", F.lit(False)))
    return out.union(_finding(many(r).filter("not _ok"), "release-normalized-alias-collision", E, F.col("key"), "search_terms"))


def pilot_findings(pilot: DataFrame, concepts: DataFrame, tags: Mapping[str, str], forbidden: Sequence[str]) -> DataFrame:
    """A frozen sample (concept_id, name, elements, tags) against the concepts: element lists equal, tags shown by the name, no forbidden column filled."""
    p = pilot.join(concepts.select("concept_id", F.col("elements").alias("_now"), F.lit(True).alias("_known")), "concept_id", "left")
    shown = F.lit(True)
    for tag, pattern in tags.items():
        shown = shown & (~F.array_contains("tags", tag) | fold_key("name").rlike(pattern))
    filled = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in forbidden if c in pilot.columns], F.lit(False))
    rules = [("pilot-unknown-concept", E, F.col("_known").isNull()), ("pilot-elements-differ", E, F.col("_known").isNotNull() & ~F.col("elements").eqNullSafe(F.col("_now"))), ("pilot-unsupported-tag", E, ~_yes(shown)), ("pilot-forbidden-field", E, filled)]
    return findings_of(p, rules, "concept_id", "pilot")


def release_findings(manifest: DataFrame, current: DataFrame) -> DataFrame:
    """Bindings (name, value) of a release manifest against current ones: mismatched and missing."""
    d = manifest.select("name", F.col("value").alias("bound")).join(current.select("name", F.col("value").alias("now")), "name", "full").filter(~F.col("bound").eqNullSafe(F.col("now")))
    code = F.concat(F.lit("release-"), F.col("name"), F.lit("-mismatch"))
    return d.select(code.alias("code"), F.lit(E).alias("severity"), F.col("name").alias("entity_id"), F.lit("release").alias("path"), F.concat_ws(" ", F.lit("bound"), "bound", F.lit("now"), "now").alias("message"))


# Gates: each returns a row per concept or claim with a boolean.


def claim_gate(claims: DataFrame, sources: DataFrame, capabilities: Mapping[str, str]) -> DataFrame:
    """claims with `approved`: supported, verified, from a source that can carry this type at this locator and revision."""
    k = with_source(claims, sources)
    c, s = F.col, F.col("s")
    ok = (
        (c("evidence_disposition") == "SUPPORTED") & (c("review_state") == "VERIFIED") & source_usable(s, c("locator")) & (s["audit"]["status"] == "VERIFIED") & (s["class"] != "machine-generated")
        & ~_yes(s["capabilities"]["machine_discovery"]) & (s["revision"] == c("source_revision")) & capability_of(c("type"), capabilities, s) & exact_locator("locator")
        & (~c("type").startswith("target-") | ((s["class"] == "target-authoritative") & (s["authority_tier"] == "authoritative"))) & (~c("type").startswith("third-") | (s["class"] == "nomenclature"))
    )
    return k.withColumn("approved", _yes(ok)).drop("s")


def approved_mappings(mappings: DataFrame, gated: DataFrame, nomenclatures: Mapping[str, str]) -> DataFrame:
    """(concept_id, mapping_id, namespace, identifier, approved) of all mappings.

    Approved: verified, of an accepted relation, with evidence, and every claim of it approved, at
    the mapping's identifier and revision and, in a nomenclature, of its type and at its locator.
    """
    m = mappings.select("concept_id", F.col("id").alias("mapping_id"), "namespace", "identifier", F.col("source_revision").alias("revision"), _yes(F.col("relation").isin(*ENUMS["accepted_relation"]) & (F.col("disposition") == "VERIFIED")).alias("_sound"), "evidence_claim_ids")
    k = gated.select("concept_id", F.col("id").alias("claim_id"), "type", "target", "source_revision", "locator", "approved")
    want = F.lit(None).cast("string")
    for name, kind in nomenclatures.items():
        want = F.when(F.upper("namespace") == name.upper(), kind).otherwise(want)
    good = F.col("approved") & (F.col("target") == F.col("identifier")) & (F.col("source_revision") == F.col("revision")) & (want.isNull() | ((F.col("type") == want) & (F.col("locator.nomenclature_id") == F.col("identifier"))))
    ids = m.filter("_sound").withColumn("claim_id", F.explode("evidence_claim_ids"))
    per = ids.join(k, ["concept_id", "claim_id"], "left").groupBy("concept_id", "mapping_id", "namespace", "identifier").agg(F.bool_and(_yes(good)).alias("_ok"))
    keys = ["concept_id", "mapping_id", "namespace", "identifier"]
    return m.select(*keys).distinct().join(per, keys, "left").select(*keys, _yes(F.col("_ok")).alias("approved"))


def claim_facts(gated: DataFrame, mappings: DataFrame, nomenclatures: Mapping[str, str], identity: str = "identity", preferred: str = "target-preferred", needed: Sequence[str] = ()) -> DataFrame:
    """Per concept, what its claims and mappings say: (concept_id, _terms, _identity, _mapped, _must).

    _terms: targets of approved preferred claims. _identity: an approved identity claim of the concept itself. _mapped: a mapping
    that approved_mappings approves. _must: ids of claims of the needed types. Claims and the evidence of mappings meet
    as one union grouped by claim, by mapping and by concept, so that rows travel by their concept once.
    """
    c = F.col
    sound = c("relation").isin(*ENUMS["accepted_relation"]) & (c("disposition") == "VERIFIED")
    m = mappings.filter(sound).select("concept_id", F.explode("evidence_claim_ids").alias("claim_id"), F.struct(c("id").alias("mapping_id"), "namespace", "identifier", c("source_revision").alias("revision")).alias("m"))
    k = gated.select("concept_id", c("id").alias("claim_id"), F.struct("type", "target", "source_revision", c("locator.nomenclature_id").alias("at"), "approved").alias("c"))
    g = k.unionByName(m, allowMissingColumns=True).repartition("concept_id").groupBy("concept_id", "claim_id").agg(F.collect_list("c").alias("cs"), F.collect_list("m").alias("ms"))
    want = F.lit(None).cast("string")
    for name, kind in nomenclatures.items():
        want = F.when(F.upper("m.namespace") == name.upper(), kind).otherwise(want)
    g = g.select("concept_id", "claim_id", "cs", F.explode_outer("ms").alias("m"))
    good = lambda x: _yes(x["approved"] & (x["target"] == c("m.identifier")) & (x["source_revision"] == c("m.revision")) & (want.isNull() | ((x["type"] == want) & (x["at"] == c("m.identifier")))))
    g = g.select(
        "concept_id", c("m").isNotNull().alias("_is"), "m.mapping_id", "m.namespace", "m.identifier", (c("claim_id").isNotNull() & (F.size("cs") > 0) & F.forall("cs", good)).alias("_ok"),
        F.transform(F.filter("cs", lambda x: x["approved"] & (x["type"] == preferred)), lambda x: x["target"]).alias("_terms"), F.exists("cs", lambda x: _yes(x["approved"] & (x["type"] == identity) & (x["target"] == c("concept_id")))).alias("_identity"),
        F.when(F.exists("cs", lambda x: _yes(x["type"].isin(list(needed)))), c("claim_id")).alias("_must"))
    sets = lambda ts: F.array_distinct(F.flatten(ts))
    g = g.groupBy("concept_id", "_is", "mapping_id", "namespace", "identifier").agg(F.bool_and("_ok").alias("_ok"), sets(F.collect_list("_terms")).alias("_terms"), F.bool_or("_identity").alias("_identity"), F.collect_set("_must").alias("_must"))
    return g.groupBy("concept_id").agg(sets(F.collect_list("_terms")).alias("_terms"), F.bool_or("_identity").alias("_identity"), F.bool_or(c("_is") & c("_ok")).alias("_mapped"), sets(F.collect_list("_must")).alias("_must"))


def _mapping_ok() -> Column:
    """Of an entry with its claim_facts: mapped, or confirmed to have no equivalent."""
    c = F.col
    return _yes(F.when(c("mapping_status") == "MAPPED", _yes(c("_mapped"))).otherwise((c("mapping_status") == "UNMAPPED") & (c("mapping_disposition") == "CONFIRMED_NO_EQUIVALENT") & _yes(c("_identity"))))


def mapping_gate(entries: DataFrame, mappings: DataFrame, gated: DataFrame, nomenclatures: Mapping[str, str], identity: str = "identity") -> DataFrame:
    """(concept_id, mapping_ok): a verified mapping all of whose evidence is approved and exact; or confirmed to have no equivalent."""
    e = entries.select("concept_id", "mapping_status", "mapping_disposition").join(claim_facts(gated, mappings, nomenclatures, identity), "concept_id", "left")
    return e.select("concept_id", _mapping_ok().alias("mapping_ok"))


def _authorised() -> Column:
    """Of a row joined with its reviewer (_r, _scope): active, and authorised for all of its claims."""
    return (F.col("_r") == "ACTIVE") & (F.array_contains("_scope", "*") | (F.size(F.array_except("claim_ids", "_scope")) == 0))


def _passed() -> Column:
    """Of an audit joined with its reviewer: passed and approved by an active, authorised human."""
    c = F.col
    return _yes((c("status") == "PASSED") & (c("decision") == "APPROVE") & ~is_blank("reviewed_at") & ~_yes(c("automated")) & _authorised() & (F.size("claim_ids") > 0))


def _current(entry_revision: Column, claim_ids: Column) -> Column:
    """Of the current revision (_revision), covering all needed claims (_must)."""
    return _yes((entry_revision == F.col("_revision")) & (F.size("_must") > 0) & (F.size(F.array_except("_must", claim_ids)) == 0))


def _reviewers(reviewers: DataFrame) -> DataFrame:
    return reviewers.select(F.col("id").alias("reviewer_id"), F.col("status").alias("_r"), F.col("authorization_scope").alias("_scope"))


def audit_gate(entries: DataFrame, audits: DataFrame, reviewers: DataFrame, claims: DataFrame, needed: Sequence[str]) -> DataFrame:
    """(concept_id, type, audit_ok): passed and approved for the current revision by an active, authorised human, covering all claims of the needed types."""
    must = claims.filter(F.col("type").isin(list(needed))).groupBy("concept_id").agg(F.collect_set("id").alias("_must"))
    a = audits.join(entries.select("concept_id", F.col("revision").alias("_revision")), "concept_id").join(must, "concept_id", "left").join(_reviewers(reviewers), "reviewer_id", "left")
    return a.groupBy("concept_id", "type").agg(F.bool_or(_passed() & _current(F.col("entry_revision"), F.col("claim_ids"))).alias("audit_ok"))


def _settled(conflicts: DataFrame, reviewers: DataFrame) -> DataFrame:
    """(concept_id, _settled, _for): whether all conflicts of a concept are rejected or adjudicated, and the revisions that these are for."""
    c = F.col
    x = conflicts.join(_reviewers(reviewers), "reviewer_id", "left")
    held = c("status") == "ADJUDICATED"
    settled = held & ~is_blank("decision") & ~is_blank("rationale") & _authorised() & c("entry_revision").isNotNull()
    return x.groupBy("concept_id").agg(F.bool_and((c("status") == "REJECTED") | _yes(settled)).alias("_settled"), F.collect_set(F.when(held, c("entry_revision"))).alias("_for"))


def _conflicts_ok() -> Column:
    """Of an entry with its _settled, if it has conflicts, and its current _revision."""
    return F.col("_settled").isNull() | (_yes(F.col("_settled")) & _yes(F.forall("_for", lambda r: r == F.col("_revision"))))


def conflict_gate(entries: DataFrame, conflicts: DataFrame, reviewers: DataFrame) -> DataFrame:
    """(concept_id, conflicts_ok): every conflict is rejected, or adjudicated for the current revision by an active, authorised reviewer."""
    e = entries.select("concept_id", F.col("revision").alias("_revision")).join(_settled(conflicts, reviewers), "concept_id", "left")
    return e.select("concept_id", _conflicts_ok().alias("conflicts_ok"))


def release_gate(tables: Mapping[str, DataFrame], capabilities: Mapping[str, str], nomenclatures: Mapping[str, str], language: str = "target", audits: Sequence[str] = ("source-verification", "medical-review"), needed: Sequence[str] = ("identity", "target-preferred")) -> DataFrame:
    """(concept_id, released, and each gate): the preferred term's claim, the mapping, the audits and the conflicts, all of them.

    Claims and mappings come as one row a concept, sound audits as one more, and all meet by concept.
    """
    e, c = tables["entries"], F.col
    gated = claim_gate(tables["claims"], tables["sources"], capabilities)
    facts = claim_facts(gated, tables["mappings"], nomenclatures, preferred=f"{language}-preferred", needed=needed)
    a = tables["audits"].filter(c("type").isin(list(audits))).join(_reviewers(tables["reviewers"]), "reviewer_id").filter(_passed())
    a = a.groupBy("concept_id").agg(F.collect_list(F.struct("type", "entry_revision", "claim_ids")).alias("_audits"))
    out = e.select("concept_id", F.trim(f"{language}.preferred").alias("_preferred"), "mapping_status", "mapping_disposition", c("revision").alias("_revision"))
    out = out.join(facts, "concept_id", "left").join(a, "concept_id", "left").join(_settled(tables["conflicts"], tables["reviewers"]), "concept_id", "left")
    audited = F.lit(True)
    for kind in audits:
        audited = audited & _yes(F.exists("_audits", lambda v: (v["type"] == kind) & _current(v["entry_revision"], v["claim_ids"])))  # noqa: B023  Spark calls it at once
    out = out.select("concept_id", _yes(F.array_contains("_terms", c("_preferred"))).alias("term_ok"), _mapping_ok().alias("mapping_ok"), audited.alias("audits_ok"), _conflicts_ok().alias("conflicts_ok"))
    return out.withColumn("released", c("term_ok") & c("mapping_ok") & c("audits_ok") & c("conflicts_ok"))


def export_gate(cleared: DataFrame, needs: DataFrame, depth: int | None = None) -> DataFrame:
    """(id, exportable): cleared itself, and everything it needs, directly or through others; unknown needs are not cleared.

    cleared: id, cleared. needs: id, needs. Each round is one join with what the last one added; it
    ends when nothing is added, which cycles do too, or at a depth if one is given.
    """
    shared_checkpoints(cleared.sparkSession)
    unknown = needs.join(cleared.select(F.col("id").alias("needs")), "needs", "left_anti").select("id")
    bad = more = cleared.filter(~_yes(F.col("cleared"))).select("id").union(unknown).filter("id is not null").distinct().checkpoint()
    while depth is None or depth > 0:
        more = needs.join(more.withColumnRenamed("id", "needs"), "needs").select("id").join(bad, "id", "left_anti").filter("id is not null").distinct().checkpoint()
        if not more.limit(1).count():
            break
        bad = bad.union(more).checkpoint()
        depth = None if depth is None else depth - 1
    bad = bad.withColumn("_bad", F.lit(True))
    return cleared.select("id").distinct().join(bad, "id", "left").select("id", F.col("_bad").isNull().alias("exportable"))


def resolve_names(concepts: DataFrame, released: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Display name of each concept: the released term, else the catalogue's if its pivot name is still the concept's, else the pivot name.

    released: concept_id, term. catalogue: concept_id, name (snapshot), term.
    """
    r = released.select("concept_id", F.col("term").alias("_r"))
    k = catalogue.select("concept_id", "name", F.col("term").alias("_k"))
    d = concepts.select("concept_id", "name").join(r, "concept_id", "left").join(k, ["concept_id", "name"], "left")
    origin = F.when(F.col("_r").isNotNull(), "RELEASED").when(F.col("_k").isNotNull(), "CATALOGUE").otherwise("PIVOT")
    return d.select("concept_id", F.coalesce("_r", "_k", "name").alias("display_name"), origin.alias("origin"))


def search_terms(concepts: DataFrame, display: DataFrame, aliases: DataFrame, gated: DataFrame, mappings: DataFrame, elements: DataFrame | None = None, released: DataFrame | None = None, identity: str = "identity") -> DataFrame:
    """(concept_id, term, key): the name, id and display name, and what has a claim of its own that is approved.

    aliases (concept_id, type, target, and a language if it must be released): those with an approved
    claim of their type. mappings (concept_id, identifier, approved): approved_mappings. elements
    (concept_id, element_id): of those that a concept has, the ones with an approved identity claim.
    released (concept_id, language): languages that are released; without it none is.
    """
    ok = gated.filter("approved").select("concept_id", "type", F.trim("target").alias("target")).distinct()
    if "language" in aliases.columns:
        free = aliases.filter("language is null")
        bound = aliases.filter("language is not null")
        aliases = free if released is None else free.union(bound.join(released.select("concept_id", "language").distinct(), ["concept_id", "language"], "left_semi").select(*free.columns))
    said = aliases.withColumn("target", F.trim("target")).join(ok, ["concept_id", "type", "target"], "left_semi")
    parts = [concepts.select("concept_id", F.explode(F.array("name", "concept_id")).alias("term")), display.select("concept_id", F.col("display_name").alias("term")), said.select("concept_id", F.col("target").alias("term"))]
    parts.append(mappings.filter("approved").select("concept_id", F.col("identifier").alias("term")))
    if elements is not None:
        known = ok.filter(F.col("type") == identity).select("concept_id", F.col("target").alias("element_id"))
        parts.append(elements.join(known, ["concept_id", "element_id"], "left_semi").select("concept_id", F.col("element_id").alias("term")))
    out = reduce(lambda a, b: a.union(b), parts).distinct()
    return out.withColumn("key", fold_key("term")).filter("key <> ''")
