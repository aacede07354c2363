import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexspark.functions.canonical import canonical_text, hash_of, revision, without
from lexspark.operators import registry_shapes as shapes
from lexspark.operators.release import changed_nodes, depth_for, revision_tree, root
from lexspark.operators.shape import Document, json_name, typed_records, validate_documents

SOURCE = {
    "id": "s1", "class": "dataset", "title": "T", "revision": "r1", "identityVerified": True, "authorityTier": "authoritative", "authorityScope": ["a"], "accessStatus": "FULL_ACCESS", "locatorCapability": "PAGE", "fullTextAvailable": True,
    "contentInspected": True, "verificationEvidence": ["e"], "limitations": [], "capabilities": {k: k == "identity" for k in ("identity", "canonical", "targetPreferred", "corroboration", "machineDiscovery")}, "audit": {"status": "VERIFIED", "verifiedAt": "2024-01-01", "verifiedBy": "w"},
}
CLAIM = {"id": "c1", "type": "identity", "target": "C1", "sourceId": "s1", "sourceRevision": "r1", "locator": {"page": 3}, "evidenceDisposition": "SUPPORTED", "reviewState": "VERIFIED"}
ENTRY = {
    "key": "C1", "conceptId": "C1", "pivot": {"preferred": "Bone"}, "claims": [CLAIM], "revision": "v1", "mapping": {"status": "MAPPED", "mappings": [{"id": "m", "namespace": "N", "identifier": "C1", "sourceRevision": "r1", "relation": "exact", "disposition": "VERIFIED", "evidenceClaimIds": ["c1"]}]},
    "review": {"status": "DRAFT", "sourceVerification": {"type": "source-verification", "status": "PASSED", "decision": "APPROVE", "reviewerId": "r", "reviewedAt": "2024-01-01", "entryRevision": "v1", "claimIds": ["c1"]}},
}
REVIEWER = {"id": "r", "displayName": "R", "role": "x", "qualifications": ["q"], "authorizationScope": ["*"], "status": "ACTIVE"}
DOCUMENTS = {"sources": shapes.source_document(("dataset",), tuple(SOURCE["capabilities"]), "(?i)^(todo|tbd)$"), "reviewers": shapes.reviewer_document(), "entries": shapes.entry_document(("M",), ("B",))}


def body(name, *records):
    return json.dumps({"schemaVersion": 1, name: list(records)})


def found(spark, name, *bodies):
    d = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "document_id long, body string")
    return sorted((r.entity_id, r.code, r.path) for r in validate_documents(d, DOCUMENTS[name]).collect())


def test_sound_documents_have_no_findings(spark):
    assert found(spark, "sources", body("sources", SOURCE, SOURCE)) == [] and found(spark, "entries", body("entries", ENTRY)) == [] and found(spark, "reviewers", body("reviewers", REVIEWER)) == []


def test_documents_that_are_none(spark):
    bodies = [None, "", "{", "[1]", '{"schemaVersion": 1}', '{"schemaVersion": "1", "sources": []}', '{"schemaVersion": 1, "sources": []}', '{"schemaVersion": 1, "sources": null}', '{"schemaVersion": 1, "sources": [[]]}']
    assert found(spark, "sources", *bodies) == [
        ("0", "unparsable-document", "sources"), ("1", "unparsable-document", "sources"), ("2", "unparsable-document", "sources"), ("3", "invalid-document-shape", "sources"), ("3", "unsupported-schema-version", "sources.schemaVersion"),
        ("4", "invalid-document-shape", "sources"), ("5", "unsupported-schema-version", "sources.schemaVersion"), ("7", "invalid-document-shape", "sources"), ("8", "invalid-source", "sources[0]"),
    ]
    assert validate_documents(spark.createDataFrame([], "document_id long, body string"), DOCUMENTS["sources"]).collect() == []


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({"id": None}, [("invalid-source-id", ".id")]), ({"title": "TBD"}, [("invalid-source-title", ".title")]), ({"identityVerified": "true"}, [("invalid-source-identity-verification", ".identityVerified")]),
        ({"authorityScope": ["Ä", "a", 1, " "]}, [("duplicate-normalized-term", ".authorityScope[1]"), ("invalid-string-array-item", ".authorityScope[2]"), ("invalid-string-array-item", ".authorityScope[3]")]),
        ({"limitations": "x"}, [("invalid-string-array", ".limitations")]), ({"capabilities": {"identity": 1, "other": True}}, [("invalid-source-capability", f".capabilities.{k}") for k in ("canonical", "corroboration", "identity", "machineDiscovery", "targetPreferred")] + [("unknown-source-capability", ".capabilities.other")]),
        ({"audit": []}, [("invalid-source-audit", ".audit")]), ({"audit": {"status": "x"}}, [("invalid-source-audit", ".audit.status")]), ({"pageCount": 2.0}, []), ({"pageCount": 2.5}, [("invalid-source-page-count", ".pageCount")]), ({"pageCount": "2"}, [("invalid-source-page-count", ".pageCount")]), ({"pageCount": None}, [("invalid-source-page-count", ".pageCount")]),
        ({"accessCopy": {"url": "u", "relation": "copy"}}, [("invalid-access-copy-notes", ".accessCopy.notes"), ("invalid-access-copy-relation", ".accessCopy.relation"), ("invalid-access-copy-url", ".accessCopy.url")]), ({"url": 5}, []), ({"url": "x"}, [("invalid-source-url", ".url")]),
    ],
)
def test_source_fields(spark, change, want):
    assert [(c, p.removeprefix("sources[1]")) for _, c, p in found(spark, "sources", body("sources", SOURCE, SOURCE | change))] == want


def test_entries_in_depth(spark):
    wrong = ENTRY | {
        "pivot": {"preferred": "", "aliases": ["x", "X"]}, "candidateOrigins": [{"id": "o", "method": "human", "createdAt": "2024-02-30"}, 5], "conflicts": [{"id": "x", "type": "?", "status": "OPEN", "claimIds": []}], "membership": {"elementIds": ["e"], "scope": "?"},
        "claims": [CLAIM | {"locator": {"page": 0, "leaf": 1, "plate": " "}}, None], "review": {"status": "DRAFT", "medicalReview": {"type": "source-verification", "status": "PASSED", "automated": "no"}},
        "research": {"milestone": "M", "artifact": "a", "row": 1, "bucket": "B", "candidateTermForReview": None, "suggestedFormForReview": "", "blockers": []}, "mapping": {"status": "MAPPED", "mappings": [{"id": "m"}]},
    }
    assert [(c, p.removeprefix("entries[0].")) for _, c, p in found(spark, "entries", body("entries", wrong))] == [
        ("duplicate-normalized-term", "pivot.aliases[1]"), ("invalid-candidate-origin", "candidateOrigins[1]"), ("invalid-candidate-origin-date", "candidateOrigins[0].createdAt"), ("invalid-claim", "claims[1]"), ("invalid-claim-locator-field", "claims[0].locator.plate"),
        ("invalid-claim-page", "claims[0].locator.page"), ("invalid-conflict-type", "conflicts[0].type"), ("invalid-external-mapping-disposition", "mapping.mappings[0].disposition"), ("invalid-external-mapping-field", "mapping.mappings[0].identifier"), ("invalid-external-mapping-field", "mapping.mappings[0].namespace"),
        ("invalid-external-mapping-field", "mapping.mappings[0].sourceRevision"), ("invalid-mapping-evidence", "mapping.mappings[0].evidenceClaimIds"), ("invalid-mapping-relation", "mapping.mappings[0].relation"), ("invalid-membership-scope", "membership.scope"), ("invalid-pivot-field", "pivot.preferred"),
        ("invalid-research-suggested-form", "research.suggestedFormForReview"), ("invalid-review-audit-type", "review.medicalReview.type"), ("invalid-review-automation", "review.medicalReview.automated"), ("unknown-claim-locator-field", "claims[0].locator.leaf"),
    ]


def test_tables_and_rules_from_documents(spark):
    def docs(name, *records):
        return spark.createDataFrame([(1, body(name, *records))], "document_id long, body string")

    given = {"sources": docs("sources", SOURCE, 7), "reviewers": docs("reviewers", REVIEWER | {"status": "INACTIVE"}), "entries": docs("entries", ENTRY, ENTRY | {"key": 5, "conceptId": "C2", "claims": [CLAIM | {"sourceId": "s9", "target": 4}]})}
    t = shapes.registry_tables(given["sources"], given["reviewers"], given["entries"], DOCUMENTS)
    assert t["sources"].count() == 1 and t["claims"].filter("target is null").count() == 1 and t["entries"].filter("key is null").count() == 1 and t["audits"].count() == 2
    got = {(r.code, r.entity_id) for r in shapes.validate_registry(given, DOCUMENTS, {"identity": "identity"}, ["identity"]).collect()}
    assert {("invalid-source", "1"), ("inactive-reviewer", "C1/source-verification"), ("unresolved-claim-source", "C2/c1"), ("mapping-claim-target-mismatch", "C2/m/c1"), ("invalid-claim-target", "1"), ("entry-key-mismatch", "1")} <= got
    assert not any(c == "invalid-claim-target" and e != "1" for c, e in got)  # told once, by the shape


def test_unknown_keys_of_attestations(spark):
    document = shapes.attestation_document(["source_id", "source_revision", "source_term_raw", "locator", "notes"])
    rows = [{"source_id": "s", "source_revision": "1", "source_term_raw": "t", "locator": {"page": 1}}, {"source_id": "", "source_term_raw": "t", "locator": {"leaf": 1}, "odd": 1}, 3]
    d = spark.createDataFrame([(1, body("records", *rows))], "document_id long, body string")
    assert sorted((r.code, r.path) for r in validate_documents(d, document).collect()) == [
        ("invalid-record", "records[2]"), ("missing-source_id", "records[1].source_id"), ("missing-source_revision", "records[1].source_revision"), ("unknown-key", "records[1].locator.leaf"), ("unknown-key", "records[1].odd")]


def test_typed_values(spark):
    assert [json_name(n) for n in ("id", "source_revision", "a_b_c")] == ["id", "sourceRevision", "aBC"]
    d = spark.createDataFrame([(1, body("rows", {"aB": 1.0, "c": [1, "x", None], "m": {"k": True, "l": 0}}, {"aB": 1.5, "c": "x"}, 4))], "document_id long, body string")
    got = typed_records(d, Document("rows", 1, "rows", {"type": "any"}), StructType.fromDDL("a_b long, c array<string>, m map<string, boolean>")).collect()
    assert [(r.pos, r.a_b, r.c, r.m) for r in got] == [(0, 1, [None, "x", None], {"k": True, "l": None}), (1, None, None, None)]


def test_canonical_text_does_not_depend_on_order(spark):
    schema = "b struct<y: int, x: array<struct<p: int, q: map<string, array<int>>>>>, a string, n int"
    one = [({"y": 1, "x": [{"p": 1, "q": {"k": [2, 1], "j": None}}, {"p": None, "q": {}}]}, 'q"\\é', None)]
    two = [({"y": 1, "x": [{"p": None, "q": {}}, {"p": 1, "q": {"j": None, "k": [1, 2]}}]}, 'q"\\é', None)]
    a, b = spark.createDataFrame(one, schema), spark.createDataFrame(two, schema)

    def text(d, unordered):
        return d.select(canonical_text(F.struct("*"), d.schema, unordered).alias("t")).first().t

    # A map's null value is left out like a null field's.
    assert text(a, False) == '{"a":"q\\"\\\\é","b":{"x":[{"p":1,"q":{"k":[2,1]}},{"q":{}}],"y":1}}' != text(b, False)
    assert text(a, True) == text(b, True) and json.loads(text(a, True))["a"] == 'q"\\é'
    assert a.select(revision(a, ["n"], True).alias("r")).first() == b.select(revision(b, ["n"], True).alias("r")).first()
    assert without(a.schema, ["b.x.q", "a"]).simpleString() == "struct<b:struct<y:int,x:array<struct<p:int>>>,n:int>"
    assert a.select(hash_of({"z": F.lit("1"), "a": F.lit(None).cast("string")}).alias("h")).first().h == a.select(F.sha2(F.lit('{"z":"1"}'), 256).alias("h")).first().h


def test_one_change_changes_the_path_to_the_root_alone(spark):
    leaves = spark.range(2000).select(F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("revision"))
    other = leaves.withColumn("revision", F.when(F.col("key") == 77, "new").otherwise(F.col("revision")))
    a, b = revision_tree(leaves, depth=3), revision_tree(other.repartition(7), depth=3)
    changed = sorted((r.level, r.node, r.state) for r in changed_nodes(a, b).collect())
    node = spark.sql("SELECT substr(sha2('77', 256), 1, 3) AS n").first().n
    assert changed == [(k, node[:k], "CHANGED") for k in range(4)]
    assert root(a).collect() == root(revision_tree(leaves.repartition(3), depth=3)).collect() and a.filter("level = 0").first().leaves == 2000
    assert root(revision_tree(leaves)).count() == 1 and depth_for(0) == depth_for(256) == 0 and depth_for(257) == 1
    hot = spark.range(500).select(F.lit("k").alias("key"), F.lit(None).cast("string").alias("revision"))
    assert revision_tree(hot, depth=1).filter("level = 1").first().leaves == 500 and revision_tree(leaves.limit(0)).count() == 0


def test_packaged_elements_and_search_forms(spark):
    from lexspark.operators import registry

    e = spark.createDataFrame([("C1", "C1", ["e1", "zz", "e2"], "packaged"), ("C2", "C2", ["far"], "external")], "concept_id string, key string, elements array<string>, element_scope string")
    blocks = [F.struct(F.lit("p").alias("preferred"), F.array(F.lit("pa")).alias("aliases")).alias("pivot"), F.struct(F.lit("t").alias("preferred"), F.array(F.lit("ta")).alias("aliases"), F.array(F.lit("sa")).alias("search_aliases"), F.array(F.lit("ascii")).alias("ascii_forms")).alias("target"), F.struct(F.lit("l").alias("preferred"), F.array(F.lit("la")).alias("aliases")).alias("third")]
    e = e.select("*", *blocks, F.lit("MAPPED").alias("mapping_status"), F.lit(None).cast("string").alias("mapping_disposition"), F.lit("v").alias("revision"))
    concepts = spark.createDataFrame([("C1", "p", ["e1"]), ("C2", "p", [])], "concept_id string, name string, elements array<string>")
    parts = spark.createDataFrame([("e1",), ("e2",)], "element_id string")
    got = {(r.code, r.entity_id) for r in registry.validate({"entries": e, "concepts": concepts, "parts": parts}, {}, []).collect()}
    assert {c for c in got if c[0].startswith(("unknown-packaged", "mesh"))} == {("unknown-packaged-element-id", "C1/zz"), ("mesh-membership-mismatch", "C1/e2")}
    open_ = {(r.code, r.entity_id) for r in registry.readiness_findings(e, spark.createDataFrame([("C1", "target"), ("C2", "third")], "concept_id string, language string")).collect()}
    assert open_ == {("unreleased-search-term", "C2"), ("unreleased-third", "C1")}


def test_findings_are_compiled_once(spark):
    """They are a column before they are rows, and no filter in front of the rows makes them again."""
    d = spark.createDataFrame([(1, body("entries", ENTRY))], "document_id long, body string")
    plan = validate_documents(d, DOCUMENTS["entries"])._jdf.queryExecution().optimizedPlan().toString()
    assert all(re.match(r"\s*[+:| -]*Generate (pos)?explode(_outer)?\(\w+#", line) for line in plan.splitlines() if "Generate " in line)
    assert not any("variant" in line for line in plan.splitlines() if re.match(r"\s*[+:| -]*Filter ", line)) and plan.count("unknown-claim-locator-field") <= 1
    items = [{"id": 1, "type": "identity"}, 7, {"locator": {"leaf": 1, "page": 0}}]
    got = found(spark, "entries", body("entries", ENTRY | {"claims": [CLAIM, *[x if x == 7 else CLAIM | x for x in items]], "conflicts": [{}, None]}))
    assert [(c, p) for _, c, p in got if "claims[" in p] == [("invalid-claim", "entries[0].claims[2]"), ("invalid-claim-id", "entries[0].claims[1].id"), ("invalid-claim-page", "entries[0].claims[3].locator.page"), ("unknown-claim-locator-field", "entries[0].claims[3].locator.leaf")]
    assert ("0", "invalid-conflict", "entries[0].conflicts[1]") in got and ("0", "invalid-string-array", "entries[0].conflicts[0].claimIds") in got


def test_lists_are_read_from_the_struct_that_their_value_was_cast_to(spark):
    # Each list, and the records, were read from the document a second time, and their rows made by lambdas.
    d = spark.createDataFrame([(1, body("entries", ENTRY))], "document_id long, body string")
    plan = validate_documents(d, DOCUMENTS["entries"])._jdf.queryExecution().optimizedPlan().toString()
    assert "$.claims" not in plan and "$.mapping.mappings" not in plan and plan.count("$.entries, ArrayType") == 1
    assert len([line for line in plan.splitlines() if "Generate posexplode" in line]) == 2


def test_items_of_lists_within_lists_keep_their_places(spark):
    text = {"type": "text", "code": "bad-text"}
    inner = {"type": "object", "code": "bad-inner", "fields": {"t": text, "words": {"type": "list", "code": "bad-words", "items": text, "optional": True}}}
    fields = {"a b": {"type": "list", "code": "bad-list", "items": inner}, "c": {"type": "object", "code": "bad-c", "fields": {"d": {"type": "list", "code": "bad-d", "items": text}}}}
    document = Document("records", 1, "records", {"type": "object", "code": "bad-record", "fields": fields})
    records = [{"a b": [{"t": "x", "words": ["u", 2, " "]}, None, {"words": []}], "c": {"d": [1, "y", None]}}, {"a b": [], "c": {"d": []}}, 5, {"a b": 1, "c": {"d": ["z", ""]}}]
    d = spark.createDataFrame([(1, body("records", *records)), (2, body("records")), (3, json.dumps({"schemaVersion": 2, "records": 1}))], "document_id long, body string")
    got = sorted((r.entity_id, r.code, r.path) for r in validate_documents(d, document).collect())
    want = [("bad-text", "records[0].a b[0].words[1]"), ("bad-text", "records[0].a b[0].words[2]"), ("bad-inner", "records[0].a b[1]"), ("bad-text", "records[0].a b[2].t"), ("bad-text", "records[0].c.d[0]"), ("bad-text", "records[0].c.d[2]")]
    want += [("bad-record", "records[2]"), ("bad-list", "records[3].a b"), ("bad-text", "records[3].c.d[1]")]
    assert got == sorted([("1", *x) for x in want] + [("3", "invalid-document-shape", "records"), ("3", "unsupported-schema-version", "records.schemaVersion")])


@pytest.mark.parametrize("texts, codes", [(["a", "b"], []), (["a", " A "], ["duplicate-normalized-term[1]"]), ([1, "a"], ["invalid-string-array-item[0]"]), (["", None], ["invalid-string-array-item[0]", "invalid-string-array-item[1]"]), (["́", "́"], []), (["a", "b", "B"], ["duplicate-normalized-term[2]"])])
def test_two_texts_are_checked_as_more_are(spark, texts, codes):
    document = Document("records", 1, "records", {"type": "texts"})
    d = spark.createDataFrame([(1, body("records", texts))], "document_id long, body string")
    assert sorted(r.code + r.path.removeprefix("records[0]") for r in validate_documents(d, document).collect()) == codes


def test_dates_are_whole_texts(spark):
    from lexspark.functions.text import is_iso_date

    d = spark.createDataFrame([("2024-02-29",), ("2024-02-30",), ("2024-02-29\n",), (" 2024-02-29",), ("0000-01-01",), ("2024-13-01",), ("٢024-01-01",), (None,)], "x string")
    assert [r[0] for r in d.select(is_iso_date("x")).collect()] == [True, False, False, False, True, False, False, False]
    assert "gettimestamp" not in d.select(is_iso_date("x"))._jdf.queryExecution().optimizedPlan().toString()
