"""Registered queries over JSON documents that rows of orders and line items write.

The text of a document is one expression in the SQL that Spark and DuckDB share, with values of the
right and the wrong type as the columns have it; what is wrong with it is told by the operator on
one side, and by DuckDB's own JSON functions over the same text on the other.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.operators import registry_shapes as shapes
from lexspark.operators.registry import ENUMS
from lexspark.operators.shape import validate_documents
from lexspark.plans.queries import query, read


def json_object(**fields: str) -> str:
    """SQL of a JSON object's text; a field whose SQL is null is left out."""
    parts = ", ".join(f"""CASE WHEN {v} IS NOT NULL THEN concat('"{k}":', {v}) END""" for k, v in fields.items())
    return f"concat('{{', concat_ws(',', {parts}), '}}')"


def quoted(sql: str) -> str:
    return f"""concat('"', {sql}, '"')"""


WHOLE = "CAST({} AS STRING)".format
CHECKS = "list_concat([]::VARCHAR[], {})".format

SOURCE = json_object(
    id=f"CASE WHEN l_tax = 0 THEN {WHOLE('l_linenumber')} ELSE {quoted('l_linenumber')} END",
    **{"class": quoted("lower(p_type)")},
    title=quoted("p_name"),
    revision=f"CASE l_returnflag WHEN 'A' THEN 'null' ELSE {quoted('l_returnflag')} END",
    identityVerified="CASE l_linestatus WHEN 'O' THEN 'true' ELSE '\"F\"' END",
    authorityTier="CASE WHEN l_discount > 0.05 THEN '\"authoritative\"' WHEN l_discount > 0.02 THEN '\"some\"' END",
    authorityScope="""concat('["', p_name, '"', CASE WHEN l_quantity > 40 THEN concat(',"', upper(p_name), ' "') ELSE '' END, CASE WHEN l_discount > 0.09 THEN ',3' ELSE '' END, CASE WHEN l_tax > 0.06 THEN ',"  "' ELSE '' END, ']')""",
    accessStatus=f"CASE WHEN p_size > 25 THEN '\"FULL_ACCESS\"' ELSE {quoted('p_type')} END",
    locatorCapability="CASE WHEN l_linenumber < 4 THEN '\"PAGE\"' ELSE 'false' END",
    fullTextAvailable="CASE WHEN l_quantity < 10 THEN '1' ELSE 'true' END",
    contentInspected="CASE WHEN l_discount < 0.03 THEN 'false' END",
    verificationEvidence="CASE WHEN l_linestatus = 'O' THEN '[]' ELSE '{}' END",
    limitations="CASE WHEN p_size > 3 THEN concat('[\"', p_brand, '\"]') END",
    capabilities=f"CASE WHEN l_discount > 0.01 THEN {json_object(identity='''CASE WHEN l_tax > 0.04 THEN '1' ELSE 'true' END''', canonical=''''false' ''', extra='''CASE WHEN p_size > 40 THEN 'true' END''')} END",
    audit="CASE WHEN p_size < 12 THEN '\"VERIFIED\"' WHEN l_linestatus = 'O' THEN '{\"status\":\"VERIFIED\"}' ELSE '{\"status\":\"OPEN\"}' END",
    url="CASE l_returnflag WHEN 'N' THEN concat('\"https://x.org/', l_partkey, '\"') WHEN 'R' THEN '\"ftp:/x\"' ELSE '5' END",
    pageCount=f"CASE l_returnflag WHEN 'N' THEN {WHOLE('l_extendedprice')} WHEN 'A' THEN {WHOLE('l_quantity - 10')} END",
    accessCopy=f"CASE WHEN l_quantity > 30 THEN NULL WHEN l_quantity > 28 THEN '[]' ELSE {json_object(url='''CASE WHEN l_tax > 0.03 THEN '\"http://y.org\"' ELSE '\"y.org\"' END''', relation='''CASE WHEN l_discount > 0.04 THEN '\"access-copy\"' ELSE '\"copy\"' END''', notes=f'''CASE WHEN p_size > 20 THEN {quoted('p_brand')} ELSE '\"  \"' END''')} END",
    accessCopyOf="CASE WHEN l_quantity > 45 THEN '\"\"' END",
)
SOURCE = f"CASE WHEN l_quantity = 50 THEN '7' ELSE {SOURCE} END"
SOURCE_BODY = """CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN concat('{"schemaVersion":3,"sources":[', items, ']')
ELSE concat('{"schemaVersion":', CASE o_orderstatus WHEN 'O' THEN '2' ELSE '3.0' END, ',"sources":', CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN '{}' ELSE concat('[', items, ']') END, '}') END"""

CLASSES, CAPABLE = ("standard", "economy", "promo"), ("identity", "canonical")
SOURCES = shapes.source_document(CLASSES, CAPABLE, "(?i)^red ", 3)

CLAIM = json_object(
    id=quoted("l_linenumber"), type="CASE WHEN l_tax > 0.01 THEN '\"identity\"' ELSE '5' END", target=quoted("trim(l_returnflag)"), sourceRevision="CASE WHEN l_discount > 0.02 THEN '\"r\"' END",
    locator=f"CASE WHEN l_discount < 0.02 THEN '\"p. 4\"' ELSE {json_object(page=WHOLE('l_quantity - 5'), plate='''CASE WHEN l_tax > 0.06 THEN '\"\"' END''', leaf='''CASE WHEN l_discount > 0.08 THEN '3' END''', url='''CASE l_linestatus WHEN 'F' THEN '\"//x\"' END''')} END",
    evidenceDisposition="CASE l_returnflag WHEN 'A' THEN '\"SUPPORTED\"' WHEN 'N' THEN '\"supported\"' END", reviewState="CASE l_linestatus WHEN 'O' THEN '\"PENDING\"' ELSE 'true' END",
)
CLAIM = f"CASE WHEN l_quantity = 50 THEN 'null' ELSE {CLAIM} END"
AUDIT = json_object(type="CASE WHEN o_totalprice > 90000 THEN '\"source-verification\"' ELSE '\"review\"' END", status="CASE o_orderstatus WHEN 'F' THEN '\"PASSED\"' ELSE '\"DONE\"' END", reviewedAt="CASE WHEN o_totalprice > 200000 THEN '\"2024-02-30\"' WHEN o_totalprice > 100000 THEN '\"2024-02-29\"' END", entryRevision="CASE WHEN o_totalprice > 400000 THEN '4' END", automated="CASE WHEN o_totalprice > 300000 THEN '\"no\"' ELSE 'false' END", claimIds="CASE WHEN o_totalprice > 350000 THEN '[\"1\",1]' END")
ENTRY = json_object(
    key=quoted("o_orderkey"),
    pivot=f"CASE o_orderpriority WHEN '2-HIGH' THEN '\"x\"' ELSE {json_object(preferred=quoted('o_orderpriority'), aliases='''concat('[\"f\",\"', o_orderstatus, '\"]')''')} END",
    third="CASE WHEN o_totalprice > 450000 THEN '{\"aliases\":null}' END",
    scope="CASE WHEN o_totalprice > 300000 THEN '{\"qualifiers\":\"all\"}' WHEN o_totalprice > 200000 THEN '{}' WHEN o_totalprice > 150000 THEN '[]' END",
    research=f"CASE o_orderpriority WHEN '3-MEDIUM' THEN {json_object(milestone=quoted('o_orderstatus'), artifact='''CASE WHEN o_totalprice > 80000 THEN '\"a\"' ELSE '\" \"' END''', row=WHOLE('o_totalprice'), bucket=quoted('lower(o_orderstatus)'), candidateTermForReview='''CASE WHEN o_totalprice > 150000 THEN 'null' ELSE '\"\"' END''', blockers=''''[]' ''')} WHEN '4-NOT SPECIFIED' THEN '[]' END",
    candidateOrigins="CASE WHEN o_totalprice < 50000 THEN concat('[{\"id\":\"o\",\"method\":\"', CASE o_orderstatus WHEN 'O' THEN 'human' ELSE o_orderstatus END, '\",\"createdAt\":\"', CAST(CAST(o_orderdate AS DATE) AS STRING), '\"},7]') WHEN o_totalprice < 60000 THEN '{}' END",
    claims="CASE WHEN o_totalprice > 490000 THEN '{}' ELSE concat('[', items, ']') END",
    membership="CASE WHEN o_totalprice > 400000 THEN '5' WHEN o_totalprice > 350000 THEN concat('{\"elementIds\":[', o_custkey, '],\"scope\":\"', o_orderstatus, '\"}') WHEN o_totalprice > 300000 THEN '{\"elementIds\":[\"e\"],\"scope\":\"packaged\"}' END",
    mapping=f"CASE WHEN o_orderstatus = 'P' AND o_totalprice > 250000 THEN NULL ELSE {json_object(status='''CASE o_orderstatus WHEN 'F' THEN '\"MAPPED\"' ELSE '\"OPEN\"' END''', disposition='''CASE WHEN o_totalprice < 100000 THEN '\"UNRESOLVED\"' WHEN o_totalprice < 140000 THEN '\"?\"' END''', mappings='''CASE WHEN o_totalprice < 120000 THEN '{}' ELSE concat('[{\"id\":\"m\",\"namespace\":\"', o_orderstatus, '\",\"identifier\":', o_custkey, ',\"sourceRevision\":\"1\",\"relation\":\"exact\",\"disposition\":\"CANDIDATE\",\"evidenceClaimIds\":', CASE WHEN o_totalprice > 160000 THEN '[1]' ELSE '1' END, '}]') END''')} END",
    review=f"CASE WHEN o_totalprice < 30000 THEN NULL ELSE {json_object(status='''CASE o_orderstatus WHEN 'O' THEN '\"DRAFT\"' ELSE '\"NEW\"' END''', sourceVerification=AUDIT, medicalReview='''CASE WHEN o_totalprice > 480000 THEN '3' END''')} END",
    conflicts="CASE WHEN o_totalprice > 470000 THEN '{}' WHEN o_totalprice > 420000 THEN concat('[{\"id\":', o_custkey, ',\"type\":\"', o_orderpriority, '\",\"status\":\"OPEN\",\"claimIds\":[\"a\"],\"ambiguityAllowed\":\"yes\"},\"x\"]') END",
)
ENTRY_BODY = f"concat('{{\"schemaVersion\":2,\"entries\":[', {ENTRY}, ',', CASE o_orderstatus WHEN 'P' THEN 'null' ELSE {ENTRY} END, ']}}')"
MILESTONES, BUCKETS = ("O", "F"), ("o", "p")
ENTRIES = shapes.entry_document(MILESTONES, BUCKETS, 2)


def documents(spark, sf_dir, item: str, body: str):
    """(document_id, body): a document an order, with an item a line item."""
    lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    lines = lines.select(F.col("l_orderkey").alias("o_orderkey"), F.struct("l_linenumber", F.expr(item).alias("item")).alias("x"))
    # An order's line items are a handful, whatever the size of the table.
    lines = lines.groupBy("o_orderkey").agg(F.array_sort(F.collect_list("x"))["item"].alias("items")).withColumn("items", F.array_join("items", ","))
    return read(spark, sf_dir, "orders").join(lines, "o_orderkey").select(F.col("o_orderkey").alias("document_id"), F.expr(body).alias("body"))


def documents_sql(item: str, body: str, records: str) -> str:
    """CTEs of DuckDB's SQL: docs (id, j), j null if the text is no JSON; recs (id, i, p, r), a row a record."""
    return f"""WITH items AS (SELECT l_orderkey, string_agg(item, ',' ORDER BY l_linenumber, item) AS items FROM (SELECT l_orderkey, l_linenumber, {item} AS item FROM lineitem JOIN part ON p_partkey = l_partkey) GROUP BY 1),
texts AS (SELECT o_orderkey::VARCHAR AS id, {body} AS body FROM orders JOIN items ON l_orderkey = o_orderkey), docs AS (SELECT id, CASE WHEN json_valid(body) THEN body::JSON END AS j FROM texts),
recs AS (SELECT id, i, '{records}[' || i || ']' AS p, json_extract(j, '$.{records}[' || i || ']') AS r FROM (SELECT id, j, unnest(generate_series(0, json_array_length(j, '$.{records}')::INT - 1)) AS i FROM docs WHERE json_type(j, '$.{records}') = 'ARRAY'))"""


def when(condition: str, code: str, path: str = "") -> str:
    """A list of one finding, code and path, if the condition holds; p: the path so far."""
    return f"CASE WHEN coalesce({condition}, false) THEN ['{code} ' || p || '{path}'] ELSE [] END"


def text_sql(at: str, r: str = "r") -> str:
    return f"coalesce(json_type({r}, '$.{at}') = 'VARCHAR' AND trim(json_extract_string({r}, '$.{at}')) <> '', false)"


def bad_text(at: str, code: str, also: str = "false", r: str = "r", optional: bool = False) -> str:
    there = f"json_type({r}, '$.{at}') IS NOT NULL AND " if optional else ""
    return when(f"{there}(NOT {text_sql(at, r)} OR {also})", code, f".{at}")


def bad_enum(at: str, code: str, values, r: str = "r", optional: bool = False) -> str:
    among = ", ".join(f"'{v}'" for v in values)
    there = f"json_type({r}, '$.{at}') IS NOT NULL AND " if optional else ""
    return when(f"{there}NOT coalesce(json_type({r}, '$.{at}') = 'VARCHAR' AND json_extract_string({r}, '$.{at}') IN ({among}), false)", code, f".{at}")


def bad_flag(at: str, code: str, r: str = "r", optional: bool = False) -> str:
    there = "" if optional else "coalesce"
    return when(f"json_type({r}, '$.{at}') <> 'BOOLEAN'" if optional else f"{there}(json_type({r}, '$.{at}'), 'none') <> 'BOOLEAN'", code, f".{at}")


def bad_count(at: str, code: str, r: str = "r", optional: bool = True) -> str:
    n = f"(CASE WHEN json_type({r}, '$.{at}') IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN json_extract({r}, '$.{at}')::DOUBLE END)"
    there = f"json_type({r}, '$.{at}') IS NOT NULL AND " if optional else ""
    return when(f"{there}NOT coalesce({n} > 0 AND {n} = floor({n}), false)", code, f".{at}")


def bad_texts(at: str, r: str = "r", optional: bool = False) -> str:
    items = f"json_extract({r}, '$.{at}[*]')"
    key = "CASE WHEN json_type(x) = 'VARCHAR' THEN nullif(lower(trim(json_extract_string(x, '$'))), '') END"
    keys = f"list_transform({items}, lambda x: {key})"
    each = f"list_transform({items}, lambda x, i: CASE WHEN ({key}) IS NULL THEN 'invalid-string-array-item ' || p || '.{at}[' || (i - 1) || ']' WHEN list_position({keys}, {key}) < i THEN 'duplicate-normalized-term ' || p || '.{at}[' || (i - 1) || ']' END)"
    missing = f"json_type({r}, '$.{at}') IS NULL" if optional else "false"
    return f"CASE WHEN {missing} THEN [] WHEN coalesce(json_type({r}, '$.{at}'), 'none') <> 'ARRAY' THEN ['invalid-string-array ' || p || '.{at}'] ELSE list_filter({each}, lambda x: x IS NOT NULL) END"


def is_object(at: str, r: str = "r") -> str:
    return f"coalesce(json_type({r}, '$.{at}'), 'none') = 'OBJECT'"


def nested(rows: str, r: str, path: str, checks: list[str]) -> str:
    """Findings of the objects of a list: a row each from `rows` (id, p, x)."""
    return f"SELECT id, unnest({CHECKS(', '.join(checks))}) AS f FROM (SELECT id, {path} AS p, {r} AS r FROM {rows})"


SOURCE_CHECKS = [
    bad_text("id", "invalid-source-id"), bad_enum("class", "invalid-source-class", CLASSES), bad_text("title", "invalid-source-title", "json_extract_string(r, '$.title') ILIKE 'red %'"), bad_text("revision", "invalid-source-revision"),
    bad_flag("identityVerified", "invalid-source-identity-verification"), bad_enum("authorityTier", "invalid-source-authority-tier", ENUMS["authority_tier"]), bad_texts("authorityScope"),
    bad_enum("accessStatus", "invalid-source-access-status", ENUMS["access_status"]), bad_enum("locatorCapability", "invalid-source-locator-capability", ENUMS["locator_capability"]), bad_flag("fullTextAvailable", "invalid-source-full-text-flag"),
    bad_flag("contentInspected", "invalid-source-content-inspection"), bad_texts("verificationEvidence"), bad_texts("limitations"),
    when(f"NOT {is_object('capabilities')}", "missing-source-capabilities", ".capabilities"),
    *[f"CASE WHEN {is_object('capabilities')} THEN {bad_flag(f'capabilities.{c}', 'invalid-source-capability')} ELSE [] END" for c in CAPABLE],
    "CASE WHEN " + is_object("capabilities") + " THEN list_transform(list_filter(json_keys(r, '$.capabilities'), lambda k: k NOT IN ('identity', 'canonical')), lambda k: 'unknown-source-capability ' || p || '.capabilities.' || k) ELSE [] END",
    when(f"NOT {is_object('audit')}", "invalid-source-audit", ".audit"), f"CASE WHEN {is_object('audit')} THEN {bad_enum('audit.status', 'invalid-source-audit', ENUMS['source_status'])} ELSE [] END",
    when(f"{text_sql('url')} AND NOT regexp_matches(json_extract_string(r, '$.url'), '^https?://[^\\s/]+')", "invalid-source-url", ".url"), bad_count("pageCount", "invalid-source-page-count"),
    when(f"json_type(r, '$.accessCopy') IS NOT NULL AND NOT {is_object('accessCopy')}", "invalid-access-copy", ".accessCopy"),
    f"CASE WHEN {is_object('accessCopy')} THEN list_concat({when('''NOT regexp_matches(json_extract_string(r, '$.accessCopy.url'), '^https?://')''', 'invalid-access-copy-url', '.accessCopy.url')}, {bad_enum('accessCopy.relation', 'invalid-access-copy-relation', ['access-copy'])}, {bad_text('accessCopy.notes', 'invalid-access-copy-notes')}) ELSE [] END",
    bad_text("accessCopyOf", "invalid-access-copy-target", optional=True),
]

FOUND = "SELECT id AS entity_id, string_split(f, ' ')[1] AS code, string_split(f, ' ')[2] AS path"


def top_sql(label: str, version: int) -> str:
    return f"""SELECT id, unnest(CASE WHEN j IS NULL THEN ['unparsable-document {label}'] ELSE list_concat(CASE WHEN coalesce(json_extract(j, '$.schemaVersion')::DOUBLE, 0) <> {version} THEN ['unsupported-schema-version {label}.schemaVersion'] ELSE [] END,
CASE WHEN coalesce(json_type(j, '$.{label}'), 'none') <> 'ARRAY' THEN ['invalid-document-shape {label}'] ELSE [] END) END) AS f FROM docs"""


@query(f"""{documents_sql(SOURCE, SOURCE_BODY, 'sources')}
{FOUND} FROM ({top_sql('sources', 3)} UNION ALL SELECT id, 'invalid-source ' || p FROM recs WHERE json_type(r) <> 'OBJECT' UNION ALL SELECT id, unnest({CHECKS(', '.join(SOURCE_CHECKS))}) FROM recs WHERE json_type(r) = 'OBJECT')""")
def source_documents(spark, sf_dir):
    """K1, K2: documents of sources, their version, shape, string arrays, enumerations, flags, counts, access copies and capabilities."""
    return validate_documents(documents(spark, sf_dir, SOURCE, SOURCE_BODY), SOURCES).select("entity_id", "code", "path")


def rows_of(path: str) -> str:
    """(id, p, r) of the elements of a list in each record that is an object."""
    return f"(SELECT id, p || '.{path}[' || k || ']' AS p, json_extract(r, '$.{path}[' || k || ']') AS r FROM (SELECT id, p, r, unnest(generate_series(0, json_array_length(r, '$.{path}')::INT - 1)) AS k FROM recs WHERE json_type(r) = 'OBJECT' AND json_type(r, '$.{path}') = 'ARRAY'))"


def list_sql(path: str, code: str, item_code: str, checks: list[str]) -> str:
    return f"SELECT id, '{item_code} ' || p FROM {rows_of(path)} WHERE json_type(r) <> 'OBJECT' UNION ALL SELECT id, unnest({CHECKS(', '.join(checks))}) FROM {rows_of(path)} WHERE json_type(r) = 'OBJECT'"


def not_list(at: str, code: str, optional: bool = False) -> str:
    return when(f"coalesce(json_type(r, '$.{at}'), '{'ARRAY' if optional else 'none'}') <> 'ARRAY'", code, f".{at}")


def not_object(at: str, code: str, optional: bool = False) -> str:
    return when(f"coalesce(json_type(r, '$.{at}'), '{'OBJECT' if optional else 'none'}') <> 'OBJECT'", code, f".{at}")


def inside(at: str, *checks: str) -> str:
    return f"CASE WHEN {is_object(at)} THEN {CHECKS(', '.join(checks))} ELSE [] END"


DAY = r"regexp_matches(json_extract_string(r, '$.{0}'), '^\d{{4}}-\d{{2}}-\d{{2}}$') AND TRY_CAST(json_extract_string(r, '$.{0}') AS DATE) IS NOT NULL"
REVIEW = "review.sourceVerification"
CLAIM_CHECKS = [
    bad_text("id", "invalid-claim-id"), bad_text("type", "invalid-claim-type"), bad_text("target", "invalid-claim-target"), bad_text("sourceRevision", "invalid-claim-source-revision"), not_object("locator", "invalid-claim-locator"),
    inside("locator", bad_count("locator.page", "invalid-claim-page"), bad_text("locator.plate", "invalid-claim-locator-field", optional=True), when("json_type(r, '$.locator.url') IS NOT NULL AND NOT regexp_matches(json_extract_string(r, '$.locator.url'), '^https?://')", "invalid-claim-url", ".locator.url"), "CASE WHEN json_type(r, '$.locator.leaf') IS NOT NULL THEN ['unknown-claim-locator-field ' || p || '.locator.leaf'] ELSE [] END"),
    bad_enum("evidenceDisposition", "invalid-evidence-disposition", ENUMS["evidence_disposition"]), bad_enum("reviewState", "invalid-claim-review-state", ENUMS["review_state"]),
]
MAPPING_CHECKS = [bad_text(k, "invalid-external-mapping-field") for k in ("id", "namespace", "identifier", "sourceRevision")] + [bad_enum("relation", "invalid-mapping-relation", ENUMS["relation"]), bad_enum("disposition", "invalid-external-mapping-disposition", ENUMS["mapping_disposition"]), not_list("evidenceClaimIds", "invalid-mapping-evidence")]
CONFLICT_CHECKS = [bad_text("id", "invalid-conflict-id"), bad_enum("type", "invalid-conflict-type", ENUMS["conflict_type"]), bad_enum("status", "invalid-conflict-status", ENUMS["conflict_status"]), bad_texts("claimIds"), bad_flag("ambiguityAllowed", "invalid-conflict-ambiguity", optional=True)]
ORIGIN_CHECKS = [bad_text("id", "invalid-candidate-origin"), bad_enum("method", "invalid-candidate-origin-method", ("human", "machine")), when(f"NOT coalesce({DAY.format('createdAt')}, false)", "invalid-candidate-origin-date", ".createdAt")]
ENTRY_CHECKS = [
    bad_text("key", "entry-key-mismatch"), not_object("pivot", "invalid-pivot-field"), inside("pivot", bad_text("pivot.preferred", "invalid-pivot-field"), bad_texts("pivot.aliases", optional=True)), not_object("third", "invalid-term-field", True), inside("third", bad_texts("third.aliases", optional=True)),
    not_object("scope", "invalid-scope", True), inside("scope", not_list("scope.qualifiers", "invalid-scope", True)), not_object("research", "invalid-research-disposition", True),
    inside("research", bad_enum("research.milestone", "invalid-research-milestone", MILESTONES), bad_text("research.artifact", "invalid-research-artifact"), bad_count("research.row", "invalid-research-row", optional=False), bad_enum("research.bucket", "invalid-research-bucket", BUCKETS), when(f"json_type(r, '$.research.candidateTermForReview') <> 'NULL' AND NOT {text_sql('research.candidateTermForReview')}", "invalid-research-candidate-term", ".research.candidateTermForReview"), bad_texts("research.blockers")),
    not_list("candidateOrigins", "invalid-candidate-origins", True), not_list("claims", "invalid-claims"), not_object("membership", "invalid-membership", True), inside("membership", bad_texts("membership.elementIds"), bad_enum("membership.scope", "invalid-membership-scope", ("packaged", "external"))),
    not_object("mapping", "invalid-mapping"), inside("mapping", bad_enum("mapping.status", "invalid-mapping-status", ENUMS["mapping_status"]), bad_enum("mapping.disposition", "invalid-mapping-disposition", ENUMS["unmapped_disposition"], optional=True), not_list("mapping.mappings", "invalid-external-mappings")),
    not_object("review", "invalid-review"), inside("review", bad_enum("review.status", "invalid-review-status", ENUMS["review_status"]), not_object("review.medicalReview", "invalid-review-audit", True), not_object(REVIEW, "invalid-review-audit", True)),
    inside(REVIEW, bad_enum(f"{REVIEW}.type", "invalid-review-audit-type", ["source-verification"]), bad_enum(f"{REVIEW}.status", "invalid-review-audit-status", ENUMS["audit_status"]), when(f"json_type(r, '$.{REVIEW}.reviewedAt') IS NOT NULL AND NOT coalesce({DAY.format(REVIEW + '.reviewedAt')}, false)", "invalid-review-audit-date", f".{REVIEW}.reviewedAt"), bad_text(f"{REVIEW}.entryRevision", "invalid-review-entry-revision", optional=True), bad_texts(f"{REVIEW}.claimIds", optional=True), bad_flag(f"{REVIEW}.automated", "invalid-review-automation", optional=True)),
    not_list("conflicts", "invalid-conflicts", True),
]


@query(f"""{documents_sql(CLAIM, ENTRY_BODY, 'entries')}
{FOUND} FROM ({top_sql('entries', 2)} UNION ALL SELECT id, 'invalid-entry ' || p FROM recs WHERE json_type(r) <> 'OBJECT' UNION ALL SELECT id, unnest({CHECKS(', '.join(ENTRY_CHECKS))}) FROM recs WHERE json_type(r) = 'OBJECT'
UNION ALL {list_sql('claims', 'invalid-claims', 'invalid-claim', CLAIM_CHECKS)} UNION ALL {list_sql('mapping.mappings', '', 'invalid-external-mapping', MAPPING_CHECKS)}
UNION ALL {list_sql('conflicts', '', 'invalid-conflict', CONFLICT_CHECKS)} UNION ALL {list_sql('candidateOrigins', '', 'invalid-candidate-origin', ORIGIN_CHECKS)})""")
def entry_documents(spark, sf_dir):
    """Documents of entries, every part of the wrong type or value with its path."""
    return validate_documents(documents(spark, sf_dir, CLAIM, ENTRY_BODY), ENTRIES).select("entity_id", "code", "path")
