"""The registry's documents as shapes (see shape.py), and its typed tables from them.

`registry_tables` makes the tables of registry.validate from documents; `validate_registry` gives
the findings of shapes and, of the rules over tables, those that shapes do not cover.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexspark.operators import registry
from lexspark.operators.registry import ENUMS
from lexspark.operators.shape import Document, typed_records, validate_documents


def _text(code: str, **more) -> dict:
    return {"type": "text", "code": code, **more}


def _one_of(code: str, enum: str, **more) -> dict:
    return {"type": "one_of", "code": code, "values": ENUMS[enum], **more}


def _flag(code: str, **more) -> dict:
    return {"type": "flag", "code": code, **more}


def _object(code: str, fields: dict, **more) -> dict:
    return {"type": "object", "code": code, "fields": fields, **more}


TEXTS = {"type": "texts"}
SOME_TEXTS = {"type": "texts", "optional": True}
ANY = {"type": "any"}

# Names of the registry's fields and the finding codes of its shapes.
LOCATOR = {"page": {"type": "count", "code": "invalid-claim-page", "optional": True}}
LOCATOR |= {k: _text("invalid-claim-locator-field", optional=True) for k in ("plate", "chapter", "section", "table", "entryId", "nomenclatureId")}
LOCATOR |= {"url": {"type": "url", "code": "invalid-claim-url", "optional": True}}

ACCESS_COPY = {"url": {"type": "url", "code": "invalid-access-copy-url"}, "relation": {"type": "is", "value": "access-copy", "code": "invalid-access-copy-relation"}, "notes": _text("invalid-access-copy-notes")}

CLAIM = {
    "id": _text("invalid-claim-id"), "type": _text("invalid-claim-type"), "target": _text("invalid-claim-target"), "sourceRevision": _text("invalid-claim-source-revision"),
    "locator": _object("invalid-claim-locator", LOCATOR, closed="unknown-claim-locator-field"),
    "evidenceDisposition": _one_of("invalid-evidence-disposition", "evidence_disposition"), "reviewState": _one_of("invalid-claim-review-state", "review_state"),
}

MAPPING = {k: _text("invalid-external-mapping-field") for k in ("id", "namespace", "identifier", "sourceRevision")} | {
    "relation": _one_of("invalid-mapping-relation", "relation"), "disposition": _one_of("invalid-external-mapping-disposition", "mapping_disposition"),
    "evidenceClaimIds": {"type": "list", "items": ANY, "code": "invalid-mapping-evidence"},
}

CONFLICT = {
    "id": _text("invalid-conflict-id"), "type": _one_of("invalid-conflict-type", "conflict_type"), "status": _one_of("invalid-conflict-status", "conflict_status"),
    "claimIds": TEXTS, "ambiguityAllowed": _flag("invalid-conflict-ambiguity", optional=True),
}

RESEARCH = {
    "milestone": _text("invalid-research-milestone"), "artifact": _text("invalid-research-artifact"), "row": {"type": "count", "code": "invalid-research-row"},
    "candidateTermForReview": _text("invalid-research-candidate-term", optional=True, nullable=True), "suggestedFormForReview": _text("invalid-research-suggested-form", optional=True, nullable=True),
    "aliasCandidates": SOME_TEXTS, "blockers": TEXTS,
}

ORIGIN = {
    "id": _text("invalid-candidate-origin"), "method": {"type": "one_of", "values": ("human", "machine"), "code": "invalid-candidate-origin-method"},
    "createdAt": {"type": "date", "code": "invalid-candidate-origin-date"},
}


def audit_shape(kind: str) -> dict:
    fields = {
        "type": {"type": "is", "value": kind, "code": "invalid-review-audit-type"}, "status": _one_of("invalid-review-audit-status", "audit_status"),
        "reviewedAt": {"type": "date", "code": "invalid-review-audit-date", "optional": True}, "entryRevision": _text("invalid-review-entry-revision", optional=True),
        "claimIds": SOME_TEXTS, "automated": _flag("invalid-review-automation", optional=True),
    }
    return _object("invalid-review-audit", fields, optional=True)


def source_document(classes: Sequence[str], capabilities: Sequence[str], placeholder: str, version: int = 1) -> Document:
    """Sources. classes and capabilities: the names that there are; placeholder: a pattern of titles and revisions that say nothing."""
    fields = {
        "id": _text("invalid-source-id"), "class": {"type": "one_of", "values": tuple(classes), "code": "invalid-source-class"}, "title": _text("invalid-source-title", unlike=placeholder), "revision": _text("invalid-source-revision", unlike=placeholder),
        "identityVerified": _flag("invalid-source-identity-verification"), "authorityTier": _one_of("invalid-source-authority-tier", "authority_tier"), "authorityScope": TEXTS,
        "accessStatus": _one_of("invalid-source-access-status", "access_status"), "locatorCapability": _one_of("invalid-source-locator-capability", "locator_capability"),
        "fullTextAvailable": _flag("invalid-source-full-text-flag"), "contentInspected": _flag("invalid-source-content-inspection"), "verificationEvidence": TEXTS, "limitations": TEXTS,
        "capabilities": _object("missing-source-capabilities", {k: _flag("invalid-source-capability") for k in capabilities}, closed="unknown-source-capability"),
        "audit": _object("invalid-source-audit", {"status": _one_of("invalid-source-audit", "source_status")}), "url": {"type": "url", "code": "invalid-source-url", "if_text": True},
        "pageCount": {"type": "count", "code": "invalid-source-page-count", "optional": True}, "accessCopy": _object("invalid-access-copy", ACCESS_COPY, optional=True), "accessCopyOf": _text("invalid-access-copy-target", optional=True),
    }
    return Document("sources", version, "sources", _object("invalid-source", fields))


def reviewer_document(version: int = 1) -> Document:
    fields = {"id": _text("invalid-reviewer-id"), "displayName": _text("invalid-reviewer-identity"), "role": _text("invalid-reviewer-identity"), "qualifications": TEXTS, "authorizationScope": TEXTS, "status": _one_of("invalid-reviewer-status", "reviewer_status")}
    return Document("reviewers", version, "reviewers", _object("invalid-reviewer", fields))


def entry_document(milestones: Sequence[str], buckets: Sequence[str], version: int = 1) -> Document:
    """Entries. milestones and buckets: the names that research dispositions may have."""
    names = lambda code, *more: _object(code, {"preferred": _text(code), "aliases": SOME_TEXTS} | {m: SOME_TEXTS for m in more})
    loose = lambda *more: _object("invalid-term-field", {m: SOME_TEXTS for m in ("aliases", *more)}, optional=True)
    research = RESEARCH | {"milestone": {"type": "one_of", "values": tuple(milestones), "code": "invalid-research-milestone"}, "bucket": {"type": "one_of", "values": tuple(buckets), "code": "invalid-research-bucket"}}
    mapping = {"status": _one_of("invalid-mapping-status", "mapping_status"), "disposition": _one_of("invalid-mapping-disposition", "unmapped_disposition", optional=True), "mappings": {"type": "list", "code": "invalid-external-mappings", "items": _object("invalid-external-mapping", MAPPING)}}
    review = {"status": _one_of("invalid-review-status", "review_status"), "sourceVerification": audit_shape("source-verification"), "medicalReview": audit_shape("medical-review"), "releaseEligibility": audit_shape("release-eligibility")}
    fields = {
        "key": _text("entry-key-mismatch"), "pivot": names("invalid-pivot-field"), "third": loose(), "target": loose("searchAliases", "asciiForms"),
        "scope": _object("invalid-scope", {"qualifiers": {"type": "list", "items": ANY, "code": "invalid-scope", "optional": True}}, optional=True),
        "research": _object("invalid-research-disposition", research, optional=True), "candidateOrigins": {"type": "list", "code": "invalid-candidate-origins", "items": _object("invalid-candidate-origin", ORIGIN), "optional": True},
        "claims": {"type": "list", "code": "invalid-claims", "items": _object("invalid-claim", CLAIM)},
        "membership": _object("invalid-membership", {"elementIds": TEXTS, "scope": {"type": "one_of", "values": ("packaged", "external"), "code": "invalid-membership-scope"}}, optional=True),
        "mapping": _object("invalid-mapping", mapping), "review": _object("invalid-review", review),
        "conflicts": {"type": "list", "code": "invalid-conflicts", "items": _object("invalid-conflict", CONFLICT), "optional": True},
    }
    return Document("entries", version, "entries", _object("invalid-entry", fields))


def attestation_document(fields: Sequence[str], version: int = 1) -> Document:
    """Attestations of which no other keys than `fields` are known, and which name their source and their raw term."""
    known = {k: ANY for k in fields} | {k: _text(f"missing-{k}") for k in ("source_id", "source_revision", "source_term_raw")} | {"locator": _object("missing-locator", {k: ANY for k in LOCATOR | {"entry_id": 0, "nomenclature_id": 0}}, closed="unknown-key")}
    return Document("records", version, "records", _object("invalid-record", known, closed="unknown-key"))


LOCATOR_TYPE = "STRUCT<page: INT, plate: STRING, entry_id: STRING, nomenclature_id: STRING, chapter: STRING, section: STRING, `table`: STRING, url: STRING>"
AUDIT_TYPE = "STRUCT<type: STRING, status: STRING, decision: STRING, reviewer_id: STRING, reviewed_at: STRING, entry_revision: STRING, claim_ids: ARRAY<STRING>, automated: BOOLEAN>"
SOURCE_SCHEMA = (
    "id STRING, class STRING, title STRING, revision STRING, identity_verified BOOLEAN, authority_tier STRING, access_status STRING, locator_capability STRING, full_text_available BOOLEAN, content_inspected BOOLEAN, "
    "capabilities STRUCT<identity: BOOLEAN, canonical: BOOLEAN, target_preferred: BOOLEAN, corroboration: BOOLEAN, machine_discovery: BOOLEAN>, audit STRUCT<status: STRING, verified_at: STRING, verified_by: STRING>, url STRING, access_copy_of STRING"
)
REVIEWER_SCHEMA = "id STRING, display_name STRING, role STRING, status STRING, authorization_scope ARRAY<STRING>, evidence_ref STRING"
CLAIM_TYPE = f"STRUCT<id: STRING, type: STRING, target: STRING, source_id: STRING, source_revision: STRING, locator: {LOCATOR_TYPE}, evidence_disposition: STRING, review_state: STRING>"
MAPPING_TYPE = "STRUCT<id: STRING, namespace: STRING, identifier: STRING, source_revision: STRING, relation: STRING, disposition: STRING, evidence_claim_ids: ARRAY<STRING>>"
CONFLICT_TYPE = "STRUCT<id: STRING, type: STRING, status: STRING, decision: STRING, rationale: STRING, reviewer_id: STRING, entry_revision: STRING, claim_ids: ARRAY<STRING>>"
ENTRY_SCHEMA = (
    "key STRING, concept_id STRING, pivot STRUCT<preferred: STRING, aliases: ARRAY<STRING>>, third STRUCT<preferred: STRING, aliases: ARRAY<STRING>>, "
    "target STRUCT<preferred: STRING, aliases: ARRAY<STRING>, search_aliases: ARRAY<STRING>, ascii_forms: ARRAY<STRING>>, revision STRING, "
    f"claims ARRAY<{CLAIM_TYPE}>, membership STRUCT<element_ids: ARRAY<STRING>, scope: STRING>, mapping STRUCT<status: STRING, disposition: STRING, mappings: ARRAY<{MAPPING_TYPE}>>, "
    f"review STRUCT<status: STRING, source_verification: {AUDIT_TYPE}, medical_review: {AUDIT_TYPE}, release_eligibility: {AUDIT_TYPE}>, conflicts ARRAY<{CONFLICT_TYPE}>"
)


def registry_tables(sources: DataFrame, reviewers: DataFrame, entries: DataFrame, documents: Mapping[str, Document]) -> dict[str, DataFrame]:
    """Tables of registry.validate from documents (document_id, body); documents: the shapes, by table."""
    of = lambda d, name, schema: typed_records(d, documents[name], StructType.fromDDL(schema))
    e = of(entries, "entries", ENTRY_SCHEMA)
    part = lambda c: e.select("concept_id", F.inline(c))
    audits = F.array_compact(F.array(*[F.col(f"review.{k}") for k in ("source_verification", "medical_review", "release_eligibility")]))
    table = e.select("document_id", "pos", "key", "concept_id", "pivot", "third", "target", "revision", F.col("mapping.status").alias("mapping_status"), F.col("mapping.disposition").alias("mapping_disposition"), F.col("review.status").alias("review_status"), F.col("membership.element_ids").alias("elements"), F.col("membership.scope").alias("element_scope"))
    return {
        "sources": of(sources, "sources", SOURCE_SCHEMA).drop("document_id", "pos"), "reviewers": of(reviewers, "reviewers", REVIEWER_SCHEMA).drop("document_id", "pos"),
        "entries": table.drop("document_id", "pos"), "claims": part("claims"), "mappings": part("mapping.mappings"), "conflicts": part("conflicts"), "audits": e.select("concept_id", F.inline(audits)),
    }


def validate_registry(given: Mapping[str, DataFrame], documents: Mapping[str, Document], capabilities: Mapping[str, str], types: Sequence[str], nomenclatures: Mapping[str, str] | None = None, more: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Findings of documents, by table, and of the tables made from them; more: tables that come typed, such as concepts and parts."""
    tables = registry_tables(given["sources"], given["reviewers"], given["entries"], documents) | dict(more or {})
    out, covered = None, set()
    for name, docs in given.items():
        found = validate_documents(docs, documents[name])
        out, covered = found if out is None else out.union(found), covered | documents[name].codes()
    rules = registry.validate(tables, capabilities, types, nomenclatures).filter(~F.col("code").isin(sorted(covered)))
    return out.union(rules)
