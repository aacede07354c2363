"""Registered queries over the driver tables, each with the same result in DuckDB's SQL.

Orders stand for entities, line items for attestations, part names for terms: the operators are
general, and these tables exercise them at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import compose, consensus, evidence, match, mesh, metrics, patch, quality, reconstruct, registry, report, rules, search, snapshot, targets

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

#: Rules of the examples: opposite heads of part names, and words for them in a made-up language.
PAIRS = [("size", "small", "large"), ("heat", "hot", "cold"), ("age", "old", "new"), ("colour", "red", "blue")]
WORDS = {"small": "ti", "large": "ga", "hot": "fu", "cold": "ni", "old": "lo", "new": "ju", "red": "ro", "blue": "su"}
WORDS_SQL = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in WORDS.items()) + ") AS words(head, word)"


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_of(head) -> F.Column:
    """The made-up word of a head, by a small constant map."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in WORDS.items() for x in kv]), head)


def line_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attestations of line items: the order is the entity, the return flag the term, the supplier the source."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("concept_id"), F.col("l_returnflag").alias("term"), F.col("l_returnflag").alias("key"), F.col("l_suppkey").alias("source_id"), F.concat_ws(":", "l_orderkey", "l_linenumber").alias("evidence_id"))


STATUS_SQL = "CASE WHEN terms > 1 THEN 'CONFLICT' WHEN terms = 1 THEN 'AGREED' ELSE 'NONE' END AS status"


@query(f"SELECT concept_id, terms, sources, {STATUS_SQL} FROM (SELECT l_orderkey AS concept_id, count(DISTINCT l_returnflag) AS terms, count(DISTINCT l_suppkey)::INT AS sources FROM lineitem GROUP BY 1)")
def consensus_by_order(spark, sf_dir):
    """Agreement of an order's line items on the return flag."""
    return consensus.consensus(line_evidence(spark, sf_dir)).select("concept_id", "status", "terms", "sources")


@query("""SELECT s.status, coalesce(n, 0) AS n FROM (VALUES ('NONE'), ('CONFLICT'), ('SURFACE_VARIANT_REVIEW'), ('AGREED'), ('BLOCKED_BY_SAFETY_FLAG'), ('VARIANT_ONLY'), ('NO_AUTHORITATIVE_PREFERRED_TERM')) AS s(status)
LEFT JOIN (SELECT CASE WHEN t > 1 THEN 'CONFLICT' ELSE 'AGREED' END AS status, count(*) AS n FROM (SELECT count(DISTINCT l_returnflag) AS t FROM lineitem GROUP BY l_partkey, l_suppkey) GROUP BY 1) c ON s.status = c.status""")
def consensus_by_part_supplier(spark, sf_dir):
    """Statuses of (part, supplier) pairs, zero-filled."""
    li = read(spark, sf_dir, "lineitem")
    e = li.select(F.struct("l_partkey", "l_suppkey").alias("concept_id"), F.col("l_returnflag").alias("term"), F.col("l_returnflag").alias("key"), F.col("l_linenumber").alias("source_id"), F.col("l_orderkey").alias("evidence_id"))
    return metrics.zero_filled(consensus.consensus(e), "status", consensus.STATUSES).withColumnRenamed("count", "n")


@query("SELECT doc_id, sha256(trim(regexp_replace(lower(strip_accents(replace(replace(text, 'đ', 'd'), 'Đ', 'D'))), '[\\s\\x{A0}\\x{FEFF}]+', ' ', 'g'))) AS folded FROM documents")
def fold_key(spark, sf_dir):
    """B1 over whole texts."""
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(T.fold_key("text"), 256).alias("folded"))


@query("SELECT md5(text) AS text_md5, count(*) AS duplicate_count FROM documents GROUP BY text")
def exact_duplicates(spark, sf_dir):
    """Documents with equal texts."""
    d = evidence.coalesce_duplicates(read(spark, sf_dir, "documents").select("text"), ["text"])
    return d.select(F.md5("text").alias("text_md5"), "duplicate_count")


@query("""WITH p AS (SELECT source AS source_id, md5(text) AS c, count(*) AS n FROM documents GROUP BY 1, 2), s AS (SELECT *, count(*) OVER (PARTITION BY c) AS k FROM p)
SELECT source_id, sum(n)::BIGINT AS "rows", count(*) AS concepts, count(*) FILTER (k = 1) AS unique_concepts, count(*) FILTER (k > 1) AS overlap_concepts FROM s GROUP BY 1""")
def source_contribution(spark, sf_dir):
    """What each source contributes that no other does."""
    d = read(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.md5("text").alias("concept_id"))
    return metrics.source_contribution(d)


@query("""WITH r AS (SELECT DISTINCT source AS source_id FROM documents UNION SELECT 'unheard'), k AS (SELECT source AS source_id, count(*) AS n, count(DISTINCT doc_id) AS c FROM documents WHERE lang <> 'en' GROUP BY 1)
SELECT r.source_id, coalesce(n, 0) AS "rows", coalesce(c, 0) AS concepts, coalesce(c, 0) AS unique_concepts, 0::BIGINT AS overlap_concepts, n IS NULL AS absent FROM r LEFT JOIN k USING (source_id)""")
def source_summary(spark, sf_dir):
    """Registered sources, absent ones too, without quarantined rows."""
    d = read(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.col("doc_id").alias("concept_id"), "lang")
    r = d.select("source_id").union(spark.createDataFrame([("unheard",)], "source_id string"))
    return metrics.source_summary(d, r, F.col("lang") == "en")


def part_concepts(spark, sf_dir):
    return read(spark, sf_dir, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("concept_id"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("name"))


@query("""WITH p AS (SELECT 'P' || p_partkey AS concept_id, p_name || ' ' || p_partkey AS name, p_partkey AS k FROM part),
e AS (SELECT 'E' || k AS evidence_id, CASE WHEN k % 3 = 0 THEN upper(name) WHEN k % 3 = 1 THEN replace(name, 'e', 'é') ELSE 'other ' || k END AS n, CASE WHEN k % 5 = 0 THEN concept_id END AS code FROM p),
m AS (SELECT concept_id, evidence_id, 'exact' AS reason FROM p JOIN e ON lower(n) = name UNION SELECT concept_id, evidence_id, 'normalised' FROM p JOIN e ON strip_accents(lower(n)) = name AND lower(n) <> name UNION SELECT concept_id, evidence_id, 'terminology_id' FROM p JOIN e ON code = concept_id)
SELECT concept_id, evidence_id, string_agg(reason, ',' ORDER BY reason) AS reasons FROM m GROUP BY 1, 2""")
def match_exact_norm(spark, sf_dir):
    """Parts matched with attestations by exact name, normalised name and id."""
    c = part_concepts(spark, sf_dir)
    k = F.substring("concept_id", 2, 20).cast("long")
    said = F.when(k % 3 == 0, F.upper("name")).when(k % 3 == 1, F.regexp_replace("name", "e", "é")).otherwise(F.concat(F.lit("other "), k.cast("string")))
    none = F.array().cast("array<string>")
    e = c.select(F.concat(F.lit("E"), k.cast("string")).alias("evidence_id"), F.struct(said.alias("preferred"), none.alias("aliases")).alias("pivot"), F.when(k % 5 == 0, F.array("concept_id")).otherwise(none).alias("terminology_ids"), none.alias("source_codes"))
    m = match.match_entities(c, match.build_keys(e))
    return m.select("concept_id", "evidence_id", F.array_join("reasons", ",").alias("reasons"))


@query("""WITH m AS (SELECT DISTINCT l_suppkey AS c, l_partkey AS e FROM lineitem), u AS (SELECT *, count(*) OVER (PARTITION BY e) AS k FROM m),
o AS (SELECT a.c, count(DISTINCT b.c) AS n FROM m a JOIN m b ON a.e = b.e AND a.c <> b.c GROUP BY 1)
SELECT u.c AS concept_id, count(*) AS elements, count(*) FILTER (k > 1) AS shared_elements, coalesce(any_value(n), 0) AS overlapping FROM u LEFT JOIN o ON u.c = o.c GROUP BY 1""")
def shared_membership(spark, sf_dir):
    """Parts that suppliers share."""
    m = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("concept_id"), F.col("l_partkey").alias("element_id"))
    return match.shared_membership(m, show=0).drop("first_overlaps")


@query("""WITH m AS (SELECT DISTINCT l_orderkey AS c, l_returnflag || l_linestatus || CASE WHEN l_quantity < 3 THEN l_suppkey::VARCHAR ELSE '' END AS e FROM lineitem), s AS (SELECT c, string_agg(e, ' ' ORDER BY e) AS marks FROM m GROUP BY 1), k AS (SELECT marks, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.marks, sum(b.n) AS n FROM k a JOIN k b ON list_has_any(string_split(a.marks, ' '), string_split(b.marks, ' ')) GROUP BY 1), f AS (SELECT a.marks, list_sort(list(b.c))[1:26] AS near FROM k a JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY marks ORDER BY c) AS r FROM s) WHERE r <= 26) b ON list_has_any(string_split(a.marks, ' '), string_split(b.marks, ' ')) GROUP BY 1)
SELECT s.c AS concept_id, (o.n - 1)::BIGINT AS overlapping, array_to_string(list_filter(near, lambda x: x <> s.c)[1:25], ',') AS first_overlaps FROM s JOIN o ON o.marks = s.marks JOIN f ON f.marks = s.marks""")
def hot_membership(spark, sf_dir):
    """Orders that share a flag and status, which thousands have, or a supplier of few pieces: neighbours counted without their pairs."""
    e = F.concat("l_returnflag", "l_linestatus", F.when(F.col("l_quantity") < 3, F.col("l_suppkey").cast("string")).otherwise(""))
    m = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("concept_id"), e.alias("element_id"))
    return match.shared_membership(m, hot=64).select("concept_id", "overlapping", F.array_join(F.coalesce("first_overlaps", F.array().cast("array<bigint>")), ",").alias("first_overlaps"))


def part_claims(spark, sf_dir):
    """Claims of part names: the base's word, reversed, and the head's word behind it."""
    p = compose.head_and_rest(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("name")))
    return p.withColumn("term", F.concat_ws(" ", F.reverse("rest"), word_of(F.col("head"))))


CLAIMS_SQL = f"(SELECT p_partkey AS concept_id, p_name AS name, split_part(p_name, ' ', 1) AS head, split_part(p_name, ' ', 2) AS rest, reverse(split_part(p_name, ' ', 2)) || ' ' || word AS term FROM part JOIN {WORDS_SQL} ON words.head = split_part(p_name, ' ', 1))"
PAIRS_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in PAIRS) + ") AS pairs(rule_id, first, second)"


@query(f"""WITH c AS (SELECT DISTINCT head, rest, term FROM {CLAIMS_SQL})
SELECT rule_id, a.rest, a.term AS first_term, b.term AS second_term, split_part(a.term, ' ', 2) AS first_word, split_part(b.term, ' ', 2) AS second_word
FROM {PAIRS_SQL} JOIN c a ON a.head = first JOIN c b ON b.head = second AND a.rest = b.rest""")
def opposite_pairs(spark, sf_dir):
    """What realises the two heads of a pair, by names that are else equal."""
    pairs = spark.createDataFrame(PAIRS, "rule_id string, first string, second string")
    return compose.mine_pairs(part_claims(spark, sf_dir), pairs).select("rule_id", "rest", "first_term", "second_term", "first_word", "second_word")


@query(f"""WITH c AS (SELECT DISTINCT head, rest, term FROM {CLAIMS_SQL}), x AS (SELECT rule_id, count(*) AS n FROM {PAIRS_SQL} JOIN c a ON a.head = first JOIN c b ON b.head = second AND a.rest = b.rest GROUP BY 1)
SELECT pairs.rule_id, coalesce(n, 0) AS examples, coalesce(n >= 3, false) AS enabled, f.word AS first_word, s.word AS second_word
FROM {PAIRS_SQL} LEFT JOIN x ON x.rule_id = pairs.rule_id LEFT JOIN {WORDS_SQL.replace('words', 'f')} ON f.head = first AND n IS NOT NULL LEFT JOIN {WORDS_SQL.replace('words', 's')} ON s.head = second AND n IS NOT NULL""")
def mined_rules(spark, sf_dir):
    """Which rules have enough examples and one realisation a side."""
    pairs = spark.createDataFrame(PAIRS, "rule_id string, first string, second string")
    r = compose.enable_rules(compose.mine_pairs(part_claims(spark, sf_dir), pairs), pairs)
    return r.select("rule_id", "examples", "enabled", F.get("first_words", F.lit(0)).alias("first_word"), F.get("second_words", F.lit(0)).alias("second_word"))


@query(f"""WITH p AS (SELECT p_partkey AS concept_id, p_name AS name, split_part(p_name, ' ', 1) AS head, split_part(p_name, ' ', 2) AS rest FROM part),
b AS (SELECT concept_id, name AS rest FROM (SELECT -1 - min(p_partkey) AS concept_id, split_part(p_name, ' ', 2) AS name FROM part GROUP BY 2) WHERE name <> 'ring')
SELECT p.concept_id, rule_id, CASE WHEN rule_id <> 'age' AND b.rest IS NOT NULL THEN reverse(p.rest) || ' ' || word END AS term,
CASE WHEN rule_id = 'age' THEN 'RULE_DISABLED' WHEN b.rest IS NULL THEN 'NO_UNAMBIGUOUS_BASE' END AS reason
FROM p JOIN {WORDS_SQL} ON words.head = p.head JOIN {PAIRS_SQL} ON p.head IN (first, second) LEFT JOIN b ON b.rest = p.rest""")
def derive_by_rule(spark, sf_dir):
    """Names derived from a base and a mined word, or the reason against it."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("name"))
    b = compose.head_and_rest(p).groupBy(F.col("rest").alias("name")).agg((-1 - F.min("concept_id")).alias("concept_id")).filter("name <> 'ring'")
    mods = spark.createDataFrame([(h, r, r != "age", WORDS[h]) for r, *heads in PAIRS for h in heads], "modifier string, rule_id string, enabled boolean, word string")
    names = p.select("concept_id", "name").union(b.select("concept_id", "name"))
    bases = b.select("concept_id", F.lit("DIRECT").alias("kind"), F.reverse("name").alias("term"))
    return compose.derive(p, mods, names, bases).select("concept_id", "rule_id", "term", "reason")


@query("SELECT p_name AS key, count(*) OVER (PARTITION BY p_name) AS entities, p_partkey AS concept_id FROM part QUALIFY entities > 1")
def collisions(spark, sf_dir):
    """Names that more than one part has."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("key"))
    return consensus.collisions(p)


@query("""SELECT l_orderkey AS concept_id, l_partkey AS pos, l_shipmode AS term FROM (SELECT l_orderkey, l_partkey, l_returnflag || l_linestatus AS l_shipmode, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_quantity > 10) DESC, l_suppkey DESC, length(l_returnflag || l_linestatus), l_partkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""")
def candidate_choice(spark, sf_dir):
    """one candidate of an order, deterministically."""
    li = read(spark, sf_dir, "lineitem")
    c = li.select(F.col("l_orderkey").alias("concept_id"), F.concat("l_returnflag", "l_linestatus").alias("term"), F.col("l_suppkey").alias("sources"), F.col("l_partkey").alias("pos"), F.col("l_linenumber").alias("key"), "l_quantity")
    return compose.choose_candidate(c, F.col("l_quantity") > 10).select("concept_id", "pos", "term")


@query("""SELECT 'event_type' AS queue, event_type AS value, count(*) AS members FROM events GROUP BY 2 UNION ALL SELECT 'shard', (user_id % 4)::VARCHAR, count(*) FROM events GROUP BY 2 UNION ALL SELECT 'day', strftime(ts, '%Y-%m-%d'), count(*) FROM events GROUP BY 2""")
def review_queues(spark, sf_dir):
    """Queues by several keys in one pass."""
    e = read(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 4).alias("shard"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return metrics.queues(e, ["event_type", "shard", "day"])


@query("""WITH m AS (SELECT DISTINCT event_type, user_id % 16 AS shard, user_id FROM events) SELECT sha256(event_type || '|' || shard) AS packet_id, event_type, shard, count(*) OVER (PARTITION BY event_type, shard) AS size, user_id FROM m""")
def review_packets(spark, sf_dir):
    """Packets by a composite key."""
    e = read(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 16).alias("shard"), "user_id")
    return metrics.packets(e, ["event_type", "shard"], "user_id")


TABLE = [
    {"id": "R1", "disposition": "REJECT", "when": {"field": "o_orderstatus", "eq": "F"}},
    {"id": "R2", "disposition": "REVIEW", "when": {"all": [{"field": "o_orderpriority", "in": ["1-URGENT", "2-HIGH"]}, {"any": [{"field": "o_totalprice", "gt": 250000}, {"not": {"field": "o_orderstatus", "eq": "O"}}]}]}},
    {"id": "R3", "disposition": "ACCEPT", "when": {"always": True}},
]


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'R1' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND (o_totalprice > 250000 OR o_orderstatus <> 'O') THEN 'R2' ELSE 'R3' END AS rule,
CASE rule WHEN 'R1' THEN 'REJECT' WHEN 'R2' THEN 'REVIEW' ELSE 'ACCEPT' END AS disposition FROM orders""")
def decision_table(spark, sf_dir):
    """A table of nested conditions, first match."""
    return rules.decide(read(spark, sf_dir, "orders"), TABLE).select("o_orderkey", "rule", "disposition")


@query("""WITH p AS (SELECT l_orderkey AS row_id, l_suppkey AS t, bool_or(l_returnflag = 'A') AS eligible, bool_or(l_linestatus = 'O') AS credible, bool_or(l_discount = 0) AS exact FROM lineitem GROUP BY 1, 2),
g AS (SELECT row_id, count(*) FILTER (eligible) AS n, count(*) FILTER (credible AND NOT eligible) AS rivals, count(*) FILTER (NOT exact) AS inexact, min(t) FILTER (eligible) AS only_one, count(*) AS c FROM p GROUP BY 1)
SELECT row_id, CASE WHEN n = 1 AND rivals = 0 THEN 'SELECTED' WHEN n > 0 OR rivals > 0 THEN 'IDENTITY_REVIEW' WHEN inexact > 0 THEN 'CORROBORATIVE' ELSE 'BRIDGE_REQUIRED' END AS disposition, CASE WHEN n = 1 AND rivals = 0 THEN only_one END AS selected, c::INT AS candidates FROM g""")
def candidate_reducer(spark, sf_dir):
    """Candidates of a row reduced to a decision, all kept."""
    li = read(spark, sf_dir, "lineitem")
    p = li.select(F.col("l_orderkey").alias("row_id"), F.col("l_suppkey").alias("target_id"), (F.col("l_returnflag") == "A").alias("eligible"), (F.col("l_linestatus") == "O").alias("credible"), (F.col("l_discount") == 0).alias("exact"))
    return rules.reduce_candidates(p).withColumn("candidates", F.size("candidates"))


@query("""SELECT *, row_number() OVER (ORDER BY "rows" DESC, p_brand)::INT AS batch FROM (SELECT p_brand, count(*) AS "rows", count(*) FILTER (p_retailprice > 950) AS covered, sum(p_size)::BIGINT AS total, min(p_size) AS least, max(p_size) AS greatest, median(p_size) AS median,
CASE WHEN count(*) <= 10 THEN 'SMALL' WHEN count(*) <= 100 THEN 'MEDIUM' ELSE 'LARGE' END AS band, round(100.0 * count(*) FILTER (p_retailprice > 950) / count(*), 2) AS covered_pct FROM part GROUP BY 1)""")
def family_stats(spark, sf_dir):
    """Batches by family."""
    return metrics.batch_stats(read(spark, sf_dir, "part"), "p_brand", "p_size", F.col("p_retailprice") > 950)


@query("""SELECT p_type, count(*) AS total, count(*) FILTER (split_part(p_name, ' ', 1) = 'small') AS small, count(*) FILTER (split_part(p_name, ' ', 1) = 'large') AS large FROM part GROUP BY 1""")
def family_counts(spark, sf_dir):
    """Conditional counts."""
    p = compose.head_and_rest(read(spark, sf_dir, "part"), "p_name")
    return metrics.family_counts(p, "p_type", "head", ["small", "large"])


@query("""SELECT conv_id, block, count(*) AS lines, min(turn) AS first_turn, sum(length(text))::BIGINT AS chars FROM (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS block FROM conversations) GROUP BY 1, 2""")
def blocks(spark, sf_dir):
    """exchanges of a conversation, opened by the user's turns."""
    c = reconstruct.segment_blocks(read(spark, sf_dir, "conversations"), F.col("role") == "user", "conv_id", "turn")
    return c.groupBy("conv_id", "block").agg(F.count("*").alias("lines"), F.min("turn").alias("first_turn"), F.sum(F.length("text")).alias("chars"))


@query("""SELECT page_id, line, last_value(h IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY line) AS heading, md5(t) AS line_md5 FROM (SELECT page_id, unnest(generate_series(1, len(a))) AS line, unnest(a) AS t, nullif(regexp_extract(t, '<h([1-6])', 1), '') AS h FROM (SELECT page_id, string_split(html, '<p>') AS a FROM pages))""")
def carried_headings(spark, sf_dir):
    """the last heading level carried to every paragraph."""
    p = read(spark, sf_dir, "pages").select("page_id", F.posexplode(F.split("html", "<p>")).alias("k", "t")).withColumn("line", F.col("k") + 1)
    p = reconstruct.carry_forward(p, {"heading": F.nullif(F.regexp_extract("t", "<h([1-6])", 1), F.lit(""))}, "page_id")
    return p.select("page_id", F.col("line").cast("long").alias("line"), "heading", F.md5("t").alias("line_md5"))


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN lang WHEN lang = 'en' AND quality = 1 THEN 'EN' ELSE lang END AS target,
CASE WHEN l.doc_id IS NULL THEN 'UNPATCHED' WHEN lang = (CASE WHEN quality = 1 THEN 'EN' ELSE 'fr' END) THEN 'ALREADY_APPLIED' WHEN lang = 'en' AND quality = 1 THEN 'READY' WHEN quality = 0 AND lang = 'en' THEN 'READY' ELSE 'DRIFT' END AS patch_state
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE NOT coalesce(quality = 0 AND lang = 'en', false)
UNION ALL SELECT d.doc_id, 'fr', 'READY' FROM documents d JOIN labels l USING (doc_id) WHERE quality = 0 AND lang = 'en'""")
def patch_overlay(spark, sf_dir):
    """Patches with drift checks; the later patch set wins."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("concept_id"), F.col("lang").alias("target"))
    p = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("concept_id"), F.lit("en").alias("old"), F.when(F.col("quality") == 1, "EN").otherwise("fr").alias("new"), F.explode(F.array(F.lit(1), F.lit(2))).alias("patch_set"))
    p = p.withColumn("new", F.when(F.col("patch_set") == 1, "earlier").otherwise(F.col("new")))
    return patch.apply_patches(d, p).withColumnRenamed("concept_id", "doc_id")


@query("""SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'ADDED' WHEN b.id IS NULL THEN 'REMOVED' WHEN a.v = b.v THEN 'UNCHANGED' ELSE 'CHANGED' END AS state
FROM (SELECT doc_id AS id, doc_id % 2 AS v FROM documents) a FULL JOIN (SELECT doc_id + 3 AS id, quality::BIGINT AS v FROM labels) b ON a.id = b.id""")
def snapshot_diff(spark, sf_dir):
    """Two snapshots compared."""
    a = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.col("doc_id") % 2).alias("v"))
    b = read(spark, sf_dir, "labels").select((F.col("doc_id") + 3).alias("id"), F.col("quality").cast("long").alias("v"))
    return snapshot.diff(a, b, "id")


@query("""SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'REMAINING' WHEN d.doc_id IS NULL THEN 'UNKNOWN' ELSE 'REVIEWED' END AS part FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id + 3 AS doc_id FROM labels) l USING (doc_id)""")
def review_split(spark, sf_dir):
    """H2: reviewed, remaining, unknown."""
    return patch.review_split(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").select((F.col("doc_id") + 3).alias("doc_id")), "doc_id")


@query("""SELECT doc_id // 200 AS chunk_id, count(*) AS "rows", min(doc_id) AS first_id, max(doc_id) AS last_id, sha256(string_agg(n_chars::VARCHAR, chr(10) ORDER BY doc_id)) AS sha256
FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_no, * FROM documents) GROUP BY doc_no // 200, 1""".replace("doc_id // 200 AS chunk_id", "(doc_no // 200) AS chunk_id").replace("GROUP BY doc_no // 200, 1", "GROUP BY 1"))
def chunks(spark, sf_dir):
    """Fixed-size chunks in id order with first, last and digest."""
    d = metrics.chunk_ids(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), 200, "doc_id")
    return metrics.chunk_manifest(d, "doc_id", "n_chars")


@query("""SELECT doc_id AS after, next AS before, next - doc_id - 1 AS missing FROM (SELECT doc_id, lead(doc_id) OVER (ORDER BY doc_id) AS next FROM (SELECT DISTINCT doc_id FROM labels)) WHERE next - doc_id > 1""")
def contiguity(spark, sf_dir):
    """gaps in a sequence of ids, those of labelled documents."""
    return reconstruct.contiguity(read(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT 'orphan-line' AS code, 'error' AS severity, l_orderkey || '/' || l_linenumber AS entity_id, 'lineitem' AS path, 'lineitem rule orphan-line' AS message FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def referential(spark, sf_dir):
    """References without a parent."""
    parent = read(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    return registry.missing_findings(read(spark, sf_dir, "lineitem"), {"l_orderkey": "o_orderkey"}, parent, "orphan-line", F.concat_ws("/", "l_orderkey", "l_linenumber"), "lineitem")


@query("""WITH q AS (SELECT p_partkey AS query_id, substr(p_name, 1 + p_partkey % 3, 2 + p_partkey % 7) AS q FROM part WHERE p_partkey % 20 = 0), t AS (SELECT p_partkey AS concept_id, p_name AS display_name FROM part),
h AS (SELECT query_id, concept_id, display_name, row_number() OVER (PARTITION BY query_id ORDER BY length(display_name), concept_id)::INT AS rank FROM q, t WHERE contains(display_name, trim(q)) AND trim(q) <> '')
SELECT * FROM h WHERE rank <= 5""")
def substring_search(spark, sf_dir):
    """A table of queries against all names, the best five of each."""
    p = read(spark, sf_dir, "part")
    t = p.select(F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("display_name"), F.col("p_partkey").alias("pos"), T.fold_key("p_name").alias("key"))
    q = p.filter("p_partkey % 20 = 0").select(F.col("p_partkey").alias("query_id"), F.expr("substr(p_name, cast(1 + p_partkey % 3 as int), cast(2 + p_partkey % 7 as int))").alias("query"))
    return search.batch_search(t, q, 5)


@query(f"""SELECT p_partkey AS id, p_name AS name, CASE WHEN split_part(p_name, ' ', 1) = 'red' AND split_part(p_name, ' ', 2) = 'ring' THEN 'rr' WHEN split_part(p_name, ' ', 1) = 'blue' THEN NULL ELSE word || ' ' || reverse(split_part(p_name, ' ', 2)) END AS term FROM part JOIN {WORDS_SQL} ON words.head = split_part(p_name, ' ', 1)""")
def greedy_compose(spark, sf_dir):
    """Names composed from the longest lexicon entries; unmatched words fail a name."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    heads = spark.createDataFrame([(k, v) for k, v in WORDS.items() if k != "blue"] + [("red ring", "rr")], "component string, term string")
    rests = compose.head_and_rest(p).select(F.col("rest").alias("component"), F.reverse("rest").alias("term")).distinct()
    return compose.compose(p, heads.union(rests)).select("id", "name", "term")


@query(f"""SELECT p_partkey AS id, p_name AS name, CASE WHEN p_name = 'red ring' THEN 'ring ro' ELSE reverse(split_part(p_name, ' ', 2)) || ' ' || word END AS term FROM part JOIN {WORDS_SQL} ON words.head = split_part(p_name, ' ', 1)""")
def modifier_compose(spark, sf_dir):
    """Leading modifiers go behind, unless an exact entry has their words."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    rests = compose.head_and_rest(p).select(F.col("rest").alias("component"), F.reverse("rest").alias("term")).distinct()
    exact = spark.createDataFrame([("red ring", "ring ro"), ("hot ring", "without its word")], "component string, term string")
    return compose.compose_modified(p, rests.union(exact), spark.createDataFrame(list(WORDS.items()), "modifier string, word string"))


@query("""SELECT lang, count(*) AS total, count(*) FILTER (l.doc_id IS NOT NULL) AS labelled, round(100.0 * count(*) FILTER (l.doc_id IS NOT NULL) / count(*), 2) AS labelled_pct, count(*) FILTER (quality = 1) AS good, round(100.0 * count(*) FILTER (quality = 1) / count(*), 2) AS good_pct FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def coverage(spark, sf_dir):
    """Shares of one denominator."""
    d = read(spark, sf_dir, "documents").select("doc_id", "lang").join(read(spark, sf_dir, "labels").withColumn("has", F.lit(True)), "doc_id", "left")
    return metrics.coverage(d, {"labelled": F.col("has"), "good": F.col("quality") == 1}, ["lang"])


@query("""SELECT coalesce(q.p_type, c.p_type) AS p_type, quota, coalesce(n, 0) AS actual, CASE WHEN quota IS NULL THEN 'UNEXPECTED' WHEN coalesce(n, 0) = quota THEN 'MET' WHEN coalesce(n, 0) < quota THEN 'SHORT' ELSE 'OVER' END AS state
FROM (VALUES ('ECONOMY', 100), ('STANDARD', 100000), ('MISSING', 0)) AS q(p_type, quota) FULL JOIN (SELECT p_type, count(*) AS n FROM part GROUP BY 1) c ON q.p_type = c.p_type""")
def quota_check(spark, sf_dir):
    """Exact quotas of categories."""
    q = spark.createDataFrame([("ECONOMY", 100), ("STANDARD", 100000), ("MISSING", 0)], "p_type string, quota int")
    return metrics.quota_check(read(spark, sf_dir, "part"), "p_type", q)


@query("""SELECT event_type, (props->>'k')::BIGINT % 10 AS k, count(*) AS n FROM events GROUP BY 1, 2""")
def json_props(spark, sf_dir):
    """A1: typed fields of JSON strings."""
    e = read(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k long"))
    return e.groupBy("event_type", (F.col("p.k") % 10).alias("k")).agg(F.count("*").alias("n"))


@query("""WITH h AS (SELECT sha256(to_json({'o_custkey': o_custkey, 'o_orderkey': o_orderkey, 'o_orderpriority': o_orderpriority, 'o_orderstatus': o_orderstatus})) AS h FROM orders), s AS (SELECT count(*) AS n, """ + ", ".join(f"sum(('0x' || h[{1 + 12 * k}:{12 + 12 * k}])::BIGINT::HUGEINT) AS s{k}" for k in range(5)) + """ FROM h)
SELECT n AS "rows", sha256(concat_ws(':', n, s0, s1, s2, s3, s4)) AS digest FROM s""")
def canonical_digest(spark, sf_dir):
    """A digest of a table that ignores the order of its rows."""
    return T.canonical_digest(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


@query("""SELECT concept_id, CASE WHEN surface > 1 THEN 'CONFLICT' WHEN agreement > 1 THEN 'VARIANT' WHEN sources > 1 THEN 'MULTI' ELSE 'DIRECT' END AS kind, terms, sources
FROM (SELECT l_partkey AS concept_id, count(DISTINCT l_returnflag || l_linestatus) AS terms, count(DISTINCT l_returnflag || l_linestatus) AS agreement, count(DISTINCT l_linestatus) AS surface, count(DISTINCT l_suppkey) AS sources FROM lineitem GROUP BY 1)""")
def direct_kind(spark, sf_dir):
    """What direct evidence of an entity amounts to."""
    li = read(spark, sf_dir, "lineitem")
    both = F.concat("l_returnflag", "l_linestatus")
    return consensus.direct_kind(li.select(F.col("l_partkey").alias("concept_id"), both.alias("term"), both.alias("agreement"), F.col("l_linestatus").alias("surface"), F.col("l_suppkey").alias("source_id")))


@query("""WITH k AS (SELECT l_orderkey AS id, count(DISTINCT l_returnflag) AS t, count(DISTINCT l_suppkey) AS i FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1), b AS (SELECT l_orderkey AS id, bool_or(l_discount > 0.05) AS s FROM lineitem WHERE l_linestatus <> 'F' GROUP BY 1)
SELECT o_orderkey AS concept_id, CASE WHEN t > 1 THEN 'SOURCE_CONFLICT' WHEN t = 1 AND i > 1 THEN 'MULTI_SOURCE_AGREEMENT' WHEN t = 1 THEN 'DIRECT_ATTESTATION' WHEN s THEN 'SCOPE_REVIEW' WHEN s IS NOT NULL THEN 'IDENTITY_REVIEW' ELSE 'NO_SOURCE_MATCH' END AS disposition, coalesce(t, 0) AS terms, coalesce(i, 0) AS independent
FROM orders LEFT JOIN k ON k.id = o_orderkey LEFT JOIN b ON b.id = o_orderkey""")
def terminal_disposition(spark, sf_dir):
    """One disposition per entity; finished lines are claims, all others blocked rows."""
    li = read(spark, sf_dir, "lineitem")
    claims = li.filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("concept_id"), F.col("l_returnflag").alias("agreement"), F.col("l_suppkey").alias("independence"))
    blocked = li.filter("l_linestatus <> 'F'").select(F.col("l_orderkey").alias("concept_id"), F.when(F.col("l_discount") > 0.05, "SCOPE_BLOCKED").otherwise("NO_IDENTITY").alias("status"))
    return consensus.terminal_disposition(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("concept_id")), claims, blocked)


@query("""SELECT count(*) AS concepts, count(*) FILTER (s = 1) AS single_source, count(*) FILTER (t = 1 AND w > 1) AS agreement, count(*) FILTER (t > 1) AS conflicts FROM (SELECT count(DISTINCT l_returnflag) AS t, count(DISTINCT l_suppkey) AS s, count(DISTINCT s_nationkey) AS w FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey)""")
def global_metrics(spark, sf_dir):
    """Agreement by institution (here the supplier's nation)."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_id"), F.col("s_nationkey").cast("long").alias("institution"))
    return metrics.global_metrics(line_evidence(spark, sf_dir).join(s, "source_id"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN n > 1 THEN 'DUPLICATE_ID' ELSE l_linestatus END AS status FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)""")
def demoted_duplicates(spark, sf_dir):
    """Rows whose id another row has, too."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linestatus").alias("status"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("id"))
    return metrics.demote_duplicates(li, "id").drop("id")


@query("""SELECT value, count(*) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part) GROUP BY 1""")
def histogram(spark, sf_dir):
    """Counts of the elements of arrays."""
    return metrics.histogram(read(spark, sf_dir, "part"), F.split("p_name", " "), array=True)


@query("""SELECT (SELECT count(*) FROM orders) AS expected, (SELECT count(*) FROM lineitem) AS actual, count(DISTINCT l_orderkey) AS distinct_ids, (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)) AS duplicated,
(SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS missing, count(DISTINCT l_orderkey) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS unexpected FROM lineitem""")
def accounting(spark, sf_dir):
    """Expected, actual, duplicated, missing ids."""
    e = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("concept_id"))
    return metrics.accounting(e, read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("concept_id")))


@query("""SELECT * FROM (SELECT 'unique-ids' AS assertion, count(o_orderkey) = count(DISTINCT o_orderkey) AS ok FROM orders UNION ALL SELECT 'positive', bool_and(o_totalprice > 0) FROM orders UNION ALL SELECT 'open', bool_and(o_orderstatus = 'O') FROM orders)""")
def ledger_assertions(spark, sf_dir):
    """What must hold for all rows."""
    return metrics.ledger_assertions(read(spark, sf_dir, "orders"), "o_orderkey", None, {"positive": F.col("o_totalprice") > 0, "open": F.col("o_orderstatus") == "O"})


@query("""SELECT t.tier, coalesce(n, 0) AS "rows", coalesce(k, 0) AS targets, coalesce(b, 0) AS overlap, coalesce(k, 0) - coalesce(b, 0) AS gain FROM (VALUES ('A'), ('N'), ('R'), ('X')) AS t(tier)
LEFT JOIN (SELECT l_returnflag AS tier, count(*) AS n, count(DISTINCT l_partkey) AS k, count(DISTINCT l_partkey) FILTER (l_partkey % 2 = 0) AS b FROM lineitem GROUP BY 1) c ON c.tier = t.tier""")
def tier_coverage(spark, sf_dir):
    """Rows, targets and gain over a baseline by tier, zero-filled."""
    li = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("tier"), F.col("l_orderkey").alias("row_id"), F.col("l_partkey").alias("target_id"))
    base = read(spark, sf_dir, "part").filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("target_id"))
    return metrics.tier_coverage(li, ["A", "N", "R", "X"], base)


@query("""SELECT o_orderkey, o_custkey, concept_id FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_partkey::VARCHAR AS concept_id FROM lineitem) ON l_orderkey = o_orderkey""")
def provenance_lookup(spark, sf_dir):
    """Which entities used a source row."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderkey").alias("entry_id"))
    uses = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("entry_id"), F.col("l_partkey").cast("string").alias("concept_id"))
    return snapshot.provenance_lookup(rows, uses, ["entry_id"]).select("o_orderkey", "o_custkey", "concept_id")


SIGNALS = [("size:small", T.word_pattern(["small"])), ("size:large", T.word_pattern(["large", "big"])), ("heat:hot", T.word_pattern(["hot"])), ("heat:cold", T.word_pattern(["cold"])), ("category:ring", T.word_pattern(["rings?"]))]


@query("""SELECT p_partkey, concat_ws(',', CASE WHEN h = 'small' THEN 'size:small' WHEN h = 'large' THEN 'size:large' WHEN h = 'hot' THEN 'heat:hot' WHEN h = 'cold' THEN 'heat:cold' END, CASE WHEN r = 'ring' THEN 'category:ring' END) AS tags FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS h, split_part(p_name, ' ', 2) AS r FROM part)""")
def signal_tags(spark, sf_dir):
    """Ordered tags by rules."""
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(T.tag_signals(F.array(T.fold_key("p_name")), SIGNALS), ",").alias("tags"))


SEMANTIC = [("laterality:left", T.word_pattern(["small"])), ("laterality:right", T.word_pattern(["large"])), ("direction:up", T.word_pattern(["hot"])), ("direction:down", T.word_pattern(["cold"])), ("category:ring", T.word_pattern(["ring"])), ("category:bolt", T.word_pattern(["bolt"])), ("scope:plural", T.word_pattern(["old"]))]


@query("""WITH p AS (SELECT p_partkey AS k, split_part(p_name, ' ', 1) AS h, split_part(p_name, ' ', 2) AS r FROM part), s AS (SELECT *, CASE h WHEN 'small' THEN 'left' WHEN 'large' THEN 'right' END AS side, CASE h WHEN 'hot' THEN 'up' WHEN 'cold' THEN 'down' END AS dir, CASE WHEN r IN ('ring', 'bolt') THEN r END AS cat, h = 'old' AS wide FROM p),
m AS (SELECT a.k AS concept_id, b.k AS evidence_id, a.side AS s1, b.side AS s2, a.dir AS d1, b.dir AS d2, a.cat AS c1, b.cat AS c2, a.wide AS w1, b.wide AS w2 FROM s a JOIN s b ON b.k = (a.k * 7 + 3) % (SELECT count(*) FROM part))
SELECT concept_id, evidence_id, 'LATERALITY_MISMATCH' AS code FROM m WHERE s1 <> s2 UNION ALL SELECT concept_id, evidence_id, 'CATEGORY_MISMATCH' FROM m WHERE c1 <> c2 UNION ALL SELECT concept_id, evidence_id, 'DIRECTIONAL_QUALIFIER_MISMATCH' FROM m WHERE d1 <> d2 UNION ALL SELECT concept_id, evidence_id, 'AGGREGATE_SCOPE_MISMATCH' FROM m WHERE w1 <> w2""")
def semantic_flags(spark, sf_dir):
    """What names of matched parts contradict each other in."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("evidence_id"), "p_name")
    n = p.count()
    c = p.select(F.col("evidence_id").alias("concept_id"), F.col("p_name").alias("name"), ((F.col("evidence_id") * 7 + 3) % n).alias("evidence_id"))
    m = c.join(p.select("evidence_id", F.array("p_name").alias("strings")), "evidence_id").withColumns({"laterality": F.lit(None).cast("string"), "category": F.lit(None).cast("string"), "reasons": F.array(F.lit("exact"))})
    return match.compare_semantics(m, SEMANTIC, ["ring", "bolt"], [("ring", "bolt")]).select("concept_id", "evidence_id", "code")


@query("""SELECT o_orderkey AS concept_id, CASE WHEN o_orderstatus = 'P' THEN 'CONFLICT_REQUIRES_ADJUDICATION' WHEN o_orderpriority = '1-URGENT' THEN 'LATERALITY_REVIEW' WHEN o_custkey % 10 = 0 THEN 'AGGREGATE_OR_COMPOSITE_REVIEW' WHEN n IS NULL THEN 'SOURCE_GAP' WHEN o_orderpriority = '5-LOW' THEN 'IDENTITY_GAP' WHEN e = 0 THEN 'SOURCE_GAP' WHEN t = 1 THEN 'HIGH_CONSENSUS_CANDIDATE' WHEN t > 1 THEN 'CONFLICT_REQUIRES_ADJUDICATION' END AS bucket
FROM (SELECT *, CASE WHEN t > 1 THEN 'P' ELSE s0 END AS o_orderstatus FROM (SELECT o_orderkey, o_custkey, o_orderpriority, CASE o_orderstatus WHEN 'P' THEN 'P' ELSE 'x' END AS s0 FROM orders) LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_linestatus = 'O') AS e, count(DISTINCT l_returnflag) FILTER (l_linestatus = 'O') AS t FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)""")
def research_buckets(spark, sf_dir):
    """One of eight buckets for each entity, first rule that holds."""
    li = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("concept_id")).agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "O").alias("e"), F.count_distinct(F.when(F.col("l_linestatus") == "O", F.col("l_returnflag"))).alias("t"))
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "concept_id").join(li, "concept_id", "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("LATERALITY_MISMATCH"))).otherwise(F.array().cast("array<string>"))
    facts = o.select("concept_id", z("n").alias("matches"), (F.col("n").isNotNull() & (F.col("o_orderpriority") != "5-LOW")).alias("identity"), z("n").alias("candidates"), z("e").alias("eligible"), z("t").alias("terms"), z("t").alias("forms"), urgent.alias("codes"), F.lit(False).alias("stale"), (F.col("o_orderstatus") == "P").alias("open_conflict"), F.lit(None).cast("string").alias("prior"), (F.col("o_custkey") % 10 == 0).alias("aggregate"), F.lit(False).alias("risk"))
    return consensus.classify(facts).select("concept_id", "bucket")


@query("""SELECT d.doc_id AS concept_id, d.lang AS baseline_bucket, b AS bucket, CASE WHEN b IS NULL THEN 'INPUT_GAP' WHEN b = d.lang THEN 'PASS' WHEN d.lang = 'en' AND b = 'de' AND t = 1 THEN 'EXPECTED_EVIDENCE_SUPERSESSION' WHEN d.lang = 'en' AND b = 'de' THEN 'INPUT_GAP' ELSE 'UNEXPLAINED_REGRESSION' END AS state
FROM documents d LEFT JOIN (SELECT doc_id, CASE WHEN quality = 1 THEN 'en' ELSE 'de' END AS b, toxic AS t FROM labels) USING (doc_id)""")
def frozen_regression(spark, sf_dir):
    """Decisions against frozen ones and what may replace them."""
    base = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("concept_id"), F.col("lang").alias("baseline_bucket"))
    now = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("concept_id"), F.when(F.col("quality") == 1, "en").otherwise("de").alias("bucket"), F.col("toxic").alias("eligible"))
    return consensus.regression(now, base, spark.createDataFrame([("en", "de")], "baseline_bucket string, bucket string"))


@query("""WITH u AS (SELECT l_orderkey AS concept_id, l_shipinstruct AS component, l_returnflag AS term FROM (SELECT l_orderkey, l_returnflag, l_partkey % 50 || '-' || (l_suppkey % 20) AS l_shipinstruct FROM lineitem)), w AS (SELECT component, string_agg(DISTINCT term, ',' ORDER BY term) AS ways FROM u GROUP BY 1 HAVING count(DISTINCT term) > 1)
SELECT DISTINCT concept_id, component, ways FROM u JOIN w USING (component)""")
def inconsistent_components(spark, sf_dir):
    """Components realised in more than one way."""
    li = read(spark, sf_dir, "lineitem")
    u = li.select(F.col("l_orderkey").alias("concept_id"), F.concat_ws("-", (F.col("l_partkey") % 50).cast("string"), (F.col("l_suppkey") % 20).cast("string")).alias("component"), F.col("l_returnflag").alias("key"), F.col("l_returnflag").alias("term"))
    return quality.inconsistent_components(u).withColumn("ways", F.array_join("ways", ","))


@query(f"""WITH r AS (SELECT concept_id, name, head, rest, CASE WHEN concept_id % 4 = 0 THEN rest || ' ' || rest ELSE term END AS target FROM {CLAIMS_SQL})
SELECT concept_id, string_agg(code, ',' ORDER BY code) AS codes FROM (SELECT concept_id, 'MISSING_SIZE' AS code FROM r WHERE head = 'small' AND NOT contains(' ' || target || ' ', ' ti ') UNION ALL SELECT concept_id, 'FORBIDDEN' FROM r WHERE rest = 'ring' AND contains(' ' || target || ' ', ' ring ') UNION ALL SELECT concept_id, 'REPEATED_WORD' FROM r WHERE concept_id % 4 = 0) GROUP BY 1""")
def quality_findings(spark, sf_dir):
    """Strings against rule tables."""
    c = part_claims(spark, sf_dir)
    r = c.select("concept_id", F.col("name").alias("pivot"), F.when(F.col("concept_id") % 4 == 0, F.concat_ws(" ", "rest", "rest")).otherwise(F.col("term")).alias("target"))
    table = spark.createDataFrame([("MISSING_SIZE", "small", "ti", None), ("FORBIDDEN", "ring", None, "ring")], "code string, when_pivot string, needs string, forbids string")
    return quality.findings(r, table).withColumn("codes", F.array_join("codes", ","))


@query("""SELECT row_id, CASE WHEN n = 0 THEN 'NONE' WHEN n = 1 THEN 'ONE' ELSE 'MANY' END AS outcome, CASE WHEN n = 1 THEN k END AS concept_id
FROM (SELECT l_orderkey || '/' || l_linenumber AS row_id, count(DISTINCT s_suppkey) AS n, min(s_suppkey) AS k FROM lineitem LEFT JOIN supplier ON s_nationkey = l_suppkey % 25 AND floor(s_acctbal / 500) = floor(l_extendedprice / 4000) GROUP BY 1)""")
def unique_match(spark, sf_dir):
    """A match counts only if it is the only one."""
    key = lambda a, b: F.concat_ws(":", a.cast("string"), F.floor(b).cast("string")).alias("key")
    v = read(spark, sf_dir, "lineitem").select(F.concat_ws("/", "l_orderkey", "l_linenumber").alias("row_id"), F.lit(1).alias("tier"), key(F.col("l_suppkey") % 25, F.col("l_extendedprice") / 4000))
    n = read(spark, sf_dir, "supplier").select(key(F.col("s_nationkey"), F.col("s_acctbal") / 500), F.col("s_suppkey").alias("concept_id"))
    return match.unique_match(v, n).select("row_id", "outcome", "concept_id")


@query("""SELECT o_orderkey AS concept_id, CASE WHEN o_orderstatus = 'P' THEN 'EXISTING_CONFLICT_OR_VARIANT' WHEN o_orderstatus = 'F' AND o_custkey % 5 = 0 THEN 'EXISTING_EVIDENCE' WHEN o_orderpriority = '1-URGENT' THEN 'IDENTITY_TARGET' WHEN o_custkey % 7 = 0 THEN 'AGGREGATE_OR_COMPOSITE_TARGET' WHEN o_orderpriority = '5-LOW' THEN 'ONTOLOGY_SCOPE_TARGET' WHEN o_orderpriority = '2-HIGH' THEN 'LATERALITY_TARGET' ELSE 'CLEAN_SIMPLE_TARGET' END AS target_class FROM orders""")
def target_classes(spark, sf_dir):
    """What to do next with an entity."""
    o = read(spark, sf_dir, "orders")
    bucket = F.when(F.col("o_orderstatus") == "P", "VARIANT_REVIEW").when((F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 5 == 0), "HIGH_CONSENSUS_CANDIDATE").otherwise("SOURCE_GAP")
    d = o.select(F.col("o_orderkey").alias("concept_id"), F.col("o_orderpriority").alias("name"), bucket.alias("bucket"), F.lit("NONE").alias("consensus"), F.array().cast("array<string>").alias("codes"), F.lit(0).alias("eligible"), (F.col("o_custkey") % 7 == 0).alias("aggregate"), F.lit(False).alias("risk"))
    return targets.classify_targets(d, {"identity": "urgent", "aggregate": "nothing", "scope": "low", "side": "high"}).select("concept_id", "target_class")


@query("""SELECT l_orderkey AS concept_id, l_suppkey AS evidence_id, CASE min(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) WHEN 1 THEN 'exact' WHEN 2 THEN 'normalised' ELSE 'source_code' END AS match_type FROM lineitem GROUP BY 1, 2""")
def compact_evidence(spark, sf_dir):
    """The strongest reason of each piece of evidence."""
    kind = F.when(F.col("l_returnflag") == "A", "exact").when(F.col("l_returnflag") == "N", "normalised").otherwise("source_code")
    return targets.compact_evidence(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("concept_id"), F.col("l_suppkey").alias("evidence_id"), F.array(kind).alias("reasons")))


@query("""SELECT p_brand AS key, count(*) AS n, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY 1""")
def provenance_union(spark, sf_dir):
    """H5: distinct provenance of an entity."""
    p = read(spark, sf_dir, "part")
    u = snapshot.provenance_union(p.select(F.col("p_brand").alias("key"), F.array("p_type").alias("types")), "key", "types")
    return u.join(p.groupBy(F.col("p_brand").alias("key")).agg(F.count("*").alias("n")), "key").select("key", "n", F.array_join("types", ",").alias("types"))


@query("""SELECT component, term, layer FROM (SELECT component, term, layer, row_number() OVER (PARTITION BY component ORDER BY layer) AS rn FROM (SELECT l_partkey AS component, l_discount_layer AS layer, min_by(term, length(term) || term) AS term FROM (SELECT l_partkey, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS l_discount_layer, l_returnflag || l_linenumber AS term FROM lineitem) GROUP BY 1, 2 HAVING count(DISTINCT term) = 1 OR l_discount_layer = 2)) WHERE rn = 1""")
def layered_lexicon(spark, sf_dir):
    """Lower layers fill the gaps of higher ones only."""
    li = read(spark, sf_dir, "lineitem")
    layer = F.when(F.col("l_linestatus") == "O", 1).otherwise(2)
    d = li.select(F.col("l_partkey").alias("component"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("term"), layer.alias("layer"), (layer == 2).alias("corpus"))
    return compose.build_lexicon(d).select("component", "term", "layer")


@query("""WITH RECURSIVE bad AS (SELECT s_suppkey AS id FROM supplier WHERE s_acctbal < 0 UNION SELECT s_suppkey FROM supplier JOIN bad ON s_suppkey // 2 = bad.id AND s_suppkey > 1)
SELECT s_suppkey AS id, s_suppkey NOT IN (SELECT id FROM bad) AS exportable FROM supplier""")
def export_gate(spark, sf_dir):
    """Cleared only with everything that a row needs, through all levels."""
    s = read(spark, sf_dir, "supplier")
    needs = s.filter("s_suppkey > 1").select(F.col("s_suppkey").alias("id"), F.floor(F.col("s_suppkey") / 2).cast("long").alias("needs"))
    return registry.export_gate(s.select(F.col("s_suppkey").alias("id"), (F.col("s_acctbal") >= 0).alias("cleared")), needs)


@query("""WITH w AS (SELECT o_orderkey % 40 AS doc, o_orderkey AS line, CASE WHEN o_orderkey % 3 = 0 THEN '61' || lpad((o_orderkey % 99999)::VARCHAR, 5, '0') || ' thuật ' || o_custkey || ' ' || (10000000 + o_orderkey) ELSE 'name ' || o_custkey || CASE WHEN o_orderkey % 3 = 2 THEN ' (body structure)' ELSE '' END END AS t FROM orders),
b AS (SELECT doc, line, t, sum((t LIKE '61%')::INT) OVER (PARTITION BY doc ORDER BY line) AS block FROM w),
g AS (SELECT doc, string_agg(t, ' ' ORDER BY line) AS raw FROM b WHERE block > 0 GROUP BY doc, block),
r AS (SELECT doc, raw, substr(raw, 1, 7) AS code, trim(substr(raw, 8)) AS rest FROM g),
x AS (SELECT *, nullif(regexp_extract(rest, '(?:^|[^0-9])([0-9]{6,18})(?:[^0-9]|$)', 1), '') AS ext, instr(lower(rest), '(body structure)') AS fin FROM r)
SELECT doc::VARCHAR AS doc_id, code, CASE WHEN fin > 0 THEN trim(substr(rest, 1, instr(rest, ext) - 1)) END AS target, CASE WHEN fin > 0 THEN ext END AS external_id,
CASE WHEN fin > 0 THEN trim(substr(rest, instr(rest, ext) + length(ext), fin + 16 - instr(rest, ext) - length(ext))) END AS pivot, CASE WHEN fin = 0 THEN 'MISSING_SCOPE_MARKER' END AS reject FROM x""")
def coded_blocks(spark, sf_dir):
    """L2: coded text cut into blocks, their fields, and why a block gives no row."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    t = F.when(k % 3 == 0, F.concat(F.lit("61"), F.lpad((k % 99999).cast("string"), 5, "0"), F.lit(" thuật "), F.col("o_custkey").cast("string"), F.lit(" "), (10000000 + k).cast("string"))).otherwise(F.concat(F.lit("name "), F.col("o_custkey").cast("string"), F.when(k % 3 == 2, " (body structure)").otherwise("")))
    lines = o.select((k % 40).cast("string").alias("doc_id"), k.alias("line"), t.alias("text"))
    return reconstruct.extract_coded(lines, r"^61\d{5}(?!\d)", "(body structure)").drop("page")


@query("""SELECT p_partkey AS concept_id, CASE WHEN p_size % 3 = 0 THEN true ELSE p_size % 5 > 1 END AS conflict, CASE WHEN p_size % 3 = 0 OR p_size % 5 > 1 THEN 'CONFLICT' WHEN p_size % 2 = 0 THEN 'VERIFIED' ELSE 'SOURCED' END AS label_class, p_brand AS first_source, 0 AS more_sources FROM part""")
def evidence_report(spark, sf_dir):
    """How evidence is shown."""
    p = read(spark, sf_dir, "part")
    none = F.array().cast("array<string>")
    d = p.select(F.col("p_partkey").alias("concept_id"), F.when(F.col("p_size") % 2 == 0, "VERIFIED").otherwise("PROVISIONAL_SOURCED").alias("evidence_status"), F.when(F.col("p_size") % 3 == 0, "SOURCE_CONFLICT").otherwise("DIRECT").alias("disposition"), F.array(F.concat("p_brand", F.lit(":"), "p_type")).alias("source_refs"), F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d")), F.lit(1), (F.col("p_size") % 5).cast("int")).alias("variants"), none.alias("locators"))
    catalog = p.select(F.col("p_brand").alias("id")).distinct().select("id", F.lit(None).cast("string").alias("institution"), none.alias("authors"), F.col("id").alias("title"), F.lit(None).cast("int").alias("publication_year"))
    return report.present_evidence(d, catalog).select("concept_id", "conflict", "label_class", F.get("sources", F.lit(0)).alias("first_source"), "more_sources")


@query("""SELECT l_partkey AS concept_id, n AS sources, CASE WHEN t > 1 THEN 'CONFLICT' WHEN n > 1 THEN 'AGREED' ELSE 'SINGLE' END AS status FROM (SELECT l_partkey, count(DISTINCT l_returnflag) AS t, count(DISTINCT l_linestatus) AS n FROM lineitem GROUP BY 1)""")
def primary_by_precedence(spark, sf_dir):
    """Status by fixed precedence of sources."""
    li = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("concept_id"), F.col("l_returnflag").alias("key"), F.col("l_returnflag").alias("term"), F.col("l_linestatus").alias("source_id"))
    return consensus.primary_by_precedence(li, ["O", "F"]).select("concept_id", "sources", "status")


@query("""WITH a AS (SELECT DISTINCT s_suppkey AS l, s_nationkey AS i FROM supplier WHERE s_acctbal > 0), b AS (SELECT DISTINCT c_custkey AS r, c_nationkey AS i FROM customer WHERE c_mktsegment = 'BUILDING'), p AS (SELECT l, r, i FROM a JOIN b USING (i))
SELECT l AS left_id, r AS right_id, i AS identifier, count(*) OVER (PARTITION BY l) AS left_partners, count(*) OVER (PARTITION BY r) AS right_partners FROM p""")
def identifier_bridge(spark, sf_dir):
    """All pairs that share an identifier in a release, for review."""
    a = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("atom_id"), F.col("s_nationkey").alias("identifier"), F.lit("r1").alias("release"), (F.col("s_acctbal") <= 0).alias("suppressed"))
    b = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("atom_id"), F.col("c_nationkey").alias("identifier"), F.when(F.col("c_mktsegment") == "BUILDING", "r1").otherwise("r0").alias("release"), F.lit(False).alias("suppressed"))
    return match.shared_identifier_bridge(a, b, "r1").drop("status")


@query("SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '[‐-―−]', '-', 'g'), '\\s*-\\s*', '-', 'g'), '[\\s\\x{A0}\\x{FEFF}]+', ' ', 'g'))) AS agreed FROM documents")
def agreement_key(spark, sf_dir):
    """B4 over whole texts: case and accents stay."""
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(T.agreement_key("text"), 256).alias("agreed"))


@query("""SELECT doc_id, sum((cut <> '')::INT)::BIGINT AS with_target, sum(length(cut))::BIGINT AS target_chars FROM (SELECT doc_id, regexp_extract(trim(regexp_replace(line, '\\s+', ' ', 'g')), '^(.*?)(\\S*[À-ỹ].*)$', 2) AS cut FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY 1""")
def merged_lines(spark, sf_dir):
    """Every line cut at its first accented word."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).withColumn("t", F.coalesce(T.split_at_accent("line")["target"], F.lit("")))
    return d.groupBy("doc_id").agg(F.sum((F.col("t") != "").cast("long")).alias("with_target"), F.sum(F.length("t")).alias("target_chars"))


@query("""SELECT l_orderkey || '/' || l_linenumber || '/' || l_partkey AS k, s_suppkey IS NOT NULL AS known, coalesce(s_nationkey % 3 = l_linenumber % 3, false) AS revision_matches, coalesce(s_nationkey % 3 = l_linenumber % 3 AND s_acctbal > 0 AND s_suppkey % 5 <> 0 AND l_quantity > 10, false) AS research_eligible, coalesce(s_nationkey % 3 = l_linenumber % 3 AND s_acctbal > 0 AND s_suppkey % 5 <> 0 AND l_quantity > 10 AND s_acctbal > 1000 AND s_suppkey % 2 = 0, false) AS claim_eligible
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 7 <> 0""")
def source_gate(spark, sf_dir):
    """What a line item's source is good for; the supplier plays the source."""
    none = F.lit(None).cast("string")
    s = read(spark, sf_dir, "supplier").filter("s_suppkey % 7 <> 0")
    catalog = s.select(
        F.col("s_suppkey").alias("id"), (F.col("s_nationkey") % 3).cast("string").alias("revision"), F.when(F.col("s_acctbal") > 0, "authoritative").otherwise("discovery-only").alias("authority_tier"), F.lit("PAGE").alias("locator_capability"),
        F.when(F.col("s_suppkey") % 5 == 0, "other").alias("access_copy_of"), F.struct(F.lit(True).alias("target_preferred")).alias("capabilities"), F.when(F.col("s_acctbal") > 1000, "FULL_ACCESS").otherwise("METADATA_ONLY").alias("access_status"),
        (F.col("s_suppkey") % 2 == 0).alias("content_inspected"), F.struct(F.lit("VERIFIED").alias("status")).alias("audit"))
    li = read(spark, sf_dir, "lineitem")
    at = F.struct(F.when(F.col("l_quantity") > 10, F.col("l_quantity").cast("int")).alias("page"), *[none.alias(c) for c in ("plate", "entry_id", "nomenclature_id", "chapter", "section", "table", "url")])
    a = li.select(F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey").alias("k"), F.col("l_suppkey").alias("source_id"), (F.col("l_linenumber") % 3).cast("string").alias("source_revision"), at.alias("locator"))
    return evidence.assess_sources(a, catalog).select("k", "known", "revision_matches", "research_eligible", "claim_eligible")


@query("""WITH n AS (SELECT p_name AS name, count(*) AS k FROM part GROUP BY 1), r AS (SELECT p_partkey AS row_id, p_name, CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN 'structure of ' || p_name WHEN 2 THEN p_name || ' part' ELSE 'unknown thing' END AS said FROM part)
SELECT row_id, CASE WHEN row_id % 11 = 0 THEN 'PARSER_BLOCKED' WHEN row_id % 4 = 3 THEN 'NO_IDENTITY' WHEN row_id % 4 = 2 THEN 'SCOPE_BLOCKED' WHEN split_part(p_name, ' ', 1) IN ('small', 'large') AND row_id % 3 = 0 AND split_part(p_name, ' ', 1) <> 'large' THEN 'LATERALITY_BLOCKED' WHEN split_part(p_name, ' ', 1) NOT IN ('small', 'large') AND row_id % 3 = 0 THEN 'LATERALITY_BLOCKED' ELSE 'ACCEPTED' END AS status,
CASE WHEN row_id % 11 = 0 OR row_id % 4 = 3 THEN NULL WHEN row_id % 4 = 0 THEN 'EXACT' WHEN row_id % 4 = 1 THEN 'EXACT_WITHOUT_WRAPPER' ELSE 'SYNONYM' END AS method FROM r""".replace("row_id % 4 = 2 THEN 'SCOPE_BLOCKED'", "row_id % 4 = 2 AND (row_id % 3 <> 0 OR split_part(p_name, ' ', 1) = 'large') THEN 'SCOPE_BLOCKED'"))
def gated_rows(spark, sf_dir):
    """Rows against concepts by name, with scope and side."""
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    said = F.when(k % 4 == 0, F.upper("p_name")).when(k % 4 == 1, F.concat(F.lit("structure of "), "p_name")).when(k % 4 == 2, F.concat("p_name", F.lit(" part"))).otherwise("unknown thing")
    rows = p.select(k.alias("row_id"), said.alias("preferred"), F.when(k % 4 == 2, F.array("p_name")).alias("aliases"), F.when(k % 3 == 0, "large").alias("laterality"), F.when(k % 11 == 0, "parser generated").alias("provenance"))
    concepts = p.select(F.col("p_name").alias("concept_id"), F.col("p_name").alias("name")).distinct()
    return match.localisation_gate(rows, concepts, ["part"], ["small", "large"], "^structure of (.*)$", "parser[- _]?generated").select("row_id", "status", "method")


@query("""WITH c AS (SELECT p_partkey AS id, split_part(p_name, ' ', 1) IN ('small', 'large') AS sided, CASE WHEN split_part(p_name, ' ', 1) IN ('small', 'large', 'red') THEN split_part(p_name, ' ', 2) ELSE p_name END AS base FROM part), m AS (SELECT DISTINCT c.*, l_suppkey AS e FROM c JOIN lineitem ON l_partkey = id)
SELECT DISTINCT a.id AS concept_id, b.id AS sibling_id FROM m a JOIN m b ON a.base = b.base AND a.e = b.e WHERE NOT a.sided AND b.sided""")
def sided_siblings(spark, sf_dir):
    """Unsided parts that share a supplier with a sided part of the same base name."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("concept_id"), F.regexp_replace("p_name", "^red ", "").alias("name"))
    m = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("concept_id"), F.col("l_suppkey").alias("element_id")).distinct()
    return match.sided_siblings(p, m, ["small", "large"])


@query("""SELECT l_suppkey AS part_id, round(l_quantity, 6) AS x, round(l_discount, 6) AS y, round(l_tax, 6) AS z, min(l_orderkey * 8 + l_linenumber) AS "index", count(*)::INT AS welded FROM lineitem GROUP BY 1, 2, 3, 4""")
def welded_vertices(spark, sf_dir):
    """Coincident points made one."""
    li = read(spark, sf_dir, "lineitem")
    v = li.select(F.col("l_suppkey").alias("part_id"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("index"), F.col("l_quantity").alias("x"), F.col("l_discount").alias("y"), F.col("l_tax").alias("z"), F.lit(0.0).alias("nx"), F.lit(0.0).alias("ny"), F.lit(1.0).alias("nz"))
    return mesh.weld(v).select("part_id", "x", "y", "z", "index", F.size("welded").alias("welded"))


@query("""SELECT lang, count(DISTINCT d.doc_id) AS concepts, count(DISTINCT CASE WHEN n > 0 THEN d.doc_id END) AS with_evidence, coalesce(sum(n), 0)::BIGINT AS evidence FROM documents d LEFT JOIN (SELECT doc_id, count(DISTINCT quality) AS n FROM labels GROUP BY 1) USING (doc_id) GROUP BY 1""")
def evidence_counts(spark, sf_dir):
    """Entities and evidence by class."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("concept_id"), "lang")
    return metrics.evidence_counts(d, read(spark, sf_dir, "labels").select(F.col("doc_id").alias("concept_id"), F.col("quality").alias("evidence_id")), ["lang"])


@query("""SELECT l_partkey AS concept_id, count(DISTINCT l_suppkey || '|' || l_returnflag || '|' || l_linestatus) AS claims, count(DISTINCT s_nationkey) AS independent FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""")
def claims(spark, sf_dir):
    """Claims by content, with what they depend on."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("institution"))
    a = read(spark, sf_dir, "lineitem").join(s, "l_suppkey").select(F.col("l_partkey").alias("concept_id"), F.col("l_suppkey").cast("string").alias("source_id"), F.lit("e").alias("entry_id"), F.col("l_returnflag").alias("pivot"), F.col("l_linestatus").alias("target"), F.col("l_linestatus").alias("agreement"), F.lit("EXACT").alias("method"), "institution")
    return consensus.emit_claims(a).groupBy("concept_id").agg(F.count("*").alias("claims"), F.count_distinct("independence").alias("independent"))


@query("""SELECT p_partkey AS concept_id, coalesce(CASE WHEN p_size % 4 = 0 THEN upper(p_name) END, CASE WHEN p_size % 3 = 0 AND p_partkey % 2 = 0 THEN 'k ' || p_name END, p_name) AS display_name, CASE WHEN p_size % 4 = 0 THEN 'RELEASED' WHEN p_size % 3 = 0 AND p_partkey % 2 = 0 THEN 'CATALOGUE' ELSE 'PIVOT' END AS origin FROM part""")
def display_names(spark, sf_dir):
    """Released term, else the catalogue's if its snapshot of the name still holds, else the name."""
    p = read(spark, sf_dir, "part")
    c = p.select(F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("name"))
    r = p.filter("p_size % 4 = 0").select(F.col("p_partkey").alias("concept_id"), F.upper("p_name").alias("term"))
    k = p.filter("p_size % 3 = 0").select(F.col("p_partkey").alias("concept_id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("an older name").alias("name"), F.concat(F.lit("k "), "p_name").alias("term"))
    return registry.resolve_names(c, r, k)


@query("""SELECT code, count(*) AS n FROM (SELECT 'invalid-source-title' AS code FROM supplier WHERE s_nationkey = 3 UNION ALL SELECT 'invalid-source-access-status' FROM supplier WHERE s_nationkey = 4 UNION ALL SELECT 'rejected-source-verified' FROM supplier WHERE s_acctbal < 0 UNION ALL SELECT 'access-status-inspection-conflict' FROM supplier WHERE s_nationkey = 5
UNION ALL SELECT 'duplicate-source-id' FROM supplier WHERE s_suppkey % 10 = 1) GROUP BY 1""")
def registry_sources(spark, sf_dir):
    """K2: rules on a table of sources; suppliers play them."""
    s = read(spark, sf_dir, "supplier")
    n = F.col("s_nationkey")
    none = F.lit(None).cast("string")
    t = s.withColumn("copy", F.explode(F.when(F.col("s_suppkey") % 10 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).select(
        F.col("s_suppkey").cast("string").alias("id"), F.lit("nomenclature").alias("class"), F.when((n == 3) & (F.col("copy") == 1), " ").otherwise(F.col("s_name")).alias("title"), F.lit("r1").alias("revision"), F.when((F.col("s_acctbal") < 0) & (F.col("copy") == 1), "rejected").otherwise("authoritative").alias("authority_tier"),
        F.when((n == 4) & (F.col("copy") == 1), "?").when((n == 5) & (F.col("copy") == 1), "METADATA_ONLY").otherwise("FULL_ACCESS").alias("access_status"), F.lit("PAGE").alias("locator_capability"), F.lit(True).alias("identity_verified"), F.lit(False).alias("full_text_available"), F.lit(True).alias("content_inspected"), none.alias("url"), none.alias("access_copy_of"),
        F.struct(*[F.lit(False).alias(c) for c in ("identity", "canonical", "target_preferred", "corroboration", "machine_discovery")]).alias("capabilities"), F.struct(F.lit("VERIFIED").alias("status"), F.lit("2024-01-01").alias("verified_at"), F.lit("who").alias("verified_by")).alias("audit"))
    return registry.validate({"sources": t}, {}, []).groupBy("code").agg(F.count("*").alias("n"))
