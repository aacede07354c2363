"""What the evidence of an entity agrees on. No winner by majority: a conflict keeps every form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.text import content_hash

STATUSES = ("NONE", "CONFLICT", "SURFACE_VARIANT_REVIEW", "AGREED", "BLOCKED_BY_SAFETY_FLAG", "VARIANT_ONLY", "NO_AUTHORITATIVE_PREFERRED_TERM")


def term_groups(evidence: DataFrame) -> DataFrame:
    """(concept_id, key) with its surface forms, sources and evidence, of rows with a preferred term."""
    t = evidence.filter("term is not null and key is not null and key <> ''")
    return t.groupBy("concept_id", "key").agg(F.array_sort(F.collect_set("term")).alias("forms"), F.array_sort(F.collect_set("source_id")).alias("sources"), F.array_sort(F.collect_set("evidence_id")).alias("evidence"))


def consensus(evidence: DataFrame, concepts: DataFrame | None = None, flags: DataFrame | None = None, blocking: Sequence[str] = ()) -> DataFrame:
    """One row per concept: status, agreed_term, terms, forms, sources, agreed only with an identity match and no blocking flag.

    evidence: concept_id, key, term, source_id, evidence_id, and optionally eligible, alias (bool)
    and identity (whether the concept was matched by name). concepts: to list those without evidence.
    """
    e = evidence
    for c, default in (("eligible", True), ("alias", False), ("identity", True)):
        e = e if c in e.columns else e.withColumn(c, F.lit(default))
    main = F.col("eligible") & ~F.col("alias") & F.col("term").isNotNull() & (F.col("key") != "")
    per_key = e.groupBy("concept_id", F.when(main, F.col("key")).alias("key")).agg(
        F.collect_set(F.when(main, F.col("term"))).alias("forms"), F.collect_set(F.when(main, F.col("source_id"))).alias("sources"),
        F.bool_or(F.col("eligible") & F.col("alias")).alias("aliases"), F.bool_or("identity").alias("identity"))
    g = per_key.groupBy("concept_id").agg(
        F.count("key").alias("terms"), F.flatten(F.collect_list("forms")).alias("forms"), F.size(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"),
        F.bool_or("aliases").alias("aliases"), F.bool_or("identity").alias("identity"))
    if flags is not None:
        bad = flags.filter(F.col("code").isin(list(blocking))).select("concept_id").distinct().withColumn("blocked", F.lit(True))
        g = g.join(bad, "concept_id", "left")
    else:
        g = g.withColumn("blocked", F.lit(False))
    forms = F.array_sort(F.array_distinct("forms"))
    status = (
        F.when(F.col("terms") > 1, "CONFLICT").when((F.col("terms") == 1) & (F.size(forms) > 1), "SURFACE_VARIANT_REVIEW")
        .when((F.col("terms") == 1) & F.col("identity") & ~F.coalesce("blocked", F.lit(False)), "AGREED").when(F.col("terms") == 1, "BLOCKED_BY_SAFETY_FLAG")
        .when(F.col("aliases"), "VARIANT_ONLY").when(F.col("terms").isNotNull(), "NO_AUTHORITATIVE_PREFERRED_TERM").otherwise("NONE")
    )
    if concepts is not None:
        g = concepts.select("concept_id").distinct().join(g, "concept_id", "left")
    g = g.select("concept_id", status.alias("status"), forms.alias("forms"), F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("sources", F.lit(0)).alias("sources"))
    return g.withColumn("agreed_term", F.when(F.col("status") == "AGREED", F.get("forms", F.lit(0))))


def direct_kind(claims: DataFrame) -> DataFrame:
    """Per concept of claims (term, agreement, surface, source_id): NONE, VARIANT, CONFLICT, MULTI or DIRECT."""
    # Whether a column has several values is told by its least and greatest; each count of distinct ones multiplies the rows.
    several = lambda c: F.coalesce(F.min(c) != F.max(c), F.lit(False)).alias(c)
    g = claims.groupBy("concept_id").agg(*[F.count_distinct(c).alias(c) for c in ("term", "source_id")], several("agreement"), several("surface"))
    kind = F.when(F.col("term") == 0, "NONE").when(F.col("surface"), "CONFLICT").when(F.col("agreement"), "VARIANT").when(F.col("source_id") > 1, "MULTI").otherwise("DIRECT")
    return g.select("concept_id", kind.alias("kind"), F.col("term").alias("terms"), F.col("source_id").alias("sources"))


def collisions(evidence: DataFrame, entity: str = "concept_id", key: str = "key") -> DataFrame:
    """(key, entities, entity): keys that more than one entity has, a row an entity."""
    e = evidence.filter(F.col(key) != "").select(key, entity).distinct()
    many = e.groupBy(key).agg(F.count("*").alias("entities")).filter("entities > 1")
    return e.join(many, key).select(key, "entities", entity)


def demote_collisions(decisions: DataFrame, evidence: DataFrame, top: str = "HIGH_CONSENSUS_CANDIDATE", to: str = "VARIANT_REVIEW") -> DataFrame:
    """decisions with `collides`; a top bucket that collides is demoted."""
    hit = collisions(evidence).select("concept_id").distinct().withColumn("_hit", F.lit(True))
    d = decisions.join(hit, "concept_id", "left").withColumn("collides", F.coalesce("_hit", F.lit(False))).drop("_hit")
    return d.withColumn("bucket", F.when(F.col("collides") & (F.col("bucket") == top), to).otherwise(F.col("bucket")))


def classify(facts: DataFrame) -> DataFrame:
    """Research bucket of each concept, first rule that holds, and the reasons.

    facts: concept_id, matches, identity, candidates, eligible (counts of evidence), terms, forms,
    codes (array of flag codes), stale, open_conflict, prior (earlier bucket), aggregate, risk.
    """
    c = F.col
    code = lambda *x: F.arrays_overlap("codes", F.array(*[F.lit(v) for v in x]))
    unheard = ~c("identity") & (c("candidates") == 0)
    semantic = code("CATEGORY_MISMATCH", "BRANCH_TRUNK_MISMATCH", "DIRECTIONAL_QUALIFIER_MISMATCH", "AGGREGATE_SCOPE_MISMATCH")
    prior = lambda x: F.coalesce(c("prior") == x, F.lit(False)) & unheard
    bucket = (
        F.when(c("open_conflict") | (c("terms") > 1) | (semantic & (c("eligible") > 0) & code("CATEGORY_MISMATCH")), "CONFLICT_REQUIRES_ADJUDICATION")
        .when(code("LATERALITY_MISMATCH", "LATERALITY_UNPINNED"), "LATERALITY_REVIEW")
        .when(c("aggregate") & ~prior("IDENTITY_CONTEXT_REVIEW"), "AGGREGATE_OR_COMPOSITE_REVIEW")
        .when(prior("ONTOLOGY_OR_SOURCE_SCOPE_UNRESOLVED"), "ONTOLOGY_SCOPE_REVIEW")
        .when(prior("BASE_TERM_SCOPE_OR_LATERALITY_REVIEW"), "LATERALITY_REVIEW")
        .when(prior("IDENTITY_CONTEXT_REVIEW"), "IDENTITY_GAP")
        .when(prior("VARIANT_WITH_ALIAS_REVIEW"), "VARIANT_REVIEW")
        .when((c("matches") > 0) & ~c("identity"), "IDENTITY_GAP")
        .when((c("matches") == 0) | (c("eligible") == 0) | c("stale"), "SOURCE_GAP")
        .when((c("terms") == 1) & (F.size("codes") == 0) & (c("forms") <= 1), "HIGH_CONSENSUS_CANDIDATE")
        .otherwise("VARIANT_REVIEW")
    )
    reasons = F.array_sort(F.array_compact(F.array(
        F.when(c("matches") == 0, "NO_SOURCE_MATCH"), F.when((c("matches") > 0) & ~c("identity"), "ID_WITHOUT_NAME"), F.when(~c("identity"), "NO_NAME_IDENTITY"),
        F.when((c("eligible") == 0) & (c("candidates") > 0), "NO_ELIGIBLE_EVIDENCE"), F.when(c("stale"), "STALE_REVISION"), F.when(F.size("codes") > 0, "SAFETY_FLAG"),
        F.when(c("aggregate"), "AGGREGATE"), F.when(c("risk"), "ONTOLOGY_RISK"))))
    return facts.select("*", bucket.alias("bucket"), reasons.alias("reasons"))


def apply_guards(decisions: DataFrame, bindings: DataFrame | None = None, authority: DataFrame | None = None) -> DataFrame:
    """Buckets that a binding fixes (concept_id, bound_bucket), then high consensus only with agreement, two sources and two institutions.

    authority: concept_id, status, sources, institutions.
    """
    d = decisions
    if bindings is not None:
        d = d.join(bindings.select("concept_id", "bound_bucket"), "concept_id", "left").withColumn("bucket", F.coalesce("bound_bucket", "bucket")).drop("bound_bucket")
    if authority is not None:
        a = authority.select("concept_id", (F.col("status") == "AGREED").alias("_ok"), F.least("sources", "institutions").alias("_n"))
        d = d.join(a, "concept_id", "left")
        enough = F.coalesce(F.col("_ok") & (F.col("_n") >= 2), F.lit(False))
        d = d.withColumn("bucket", F.when((F.col("bucket") == "HIGH_CONSENSUS_CANDIDATE") & ~enough, "VARIANT_REVIEW").otherwise(F.col("bucket"))).drop("_ok", "_n")
    return d


def regression(decisions: DataFrame, baseline: DataFrame, compatible: DataFrame) -> DataFrame:
    """PASS, INPUT_GAP, EXPECTED_EVIDENCE_SUPERSESSION or UNEXPLAINED_REGRESSION against frozen buckets.

    baseline: concept_id, baseline_bucket. compatible: (baseline_bucket, bucket) that may replace it
    once there is evidence; decisions: concept_id, bucket, eligible.
    """
    d = baseline.join(decisions.select("concept_id", "bucket", "eligible"), "concept_id", "left")
    d = d.join(compatible.select("baseline_bucket", "bucket").distinct().withColumn("_may", F.lit(True)), ["baseline_bucket", "bucket"], "left")
    state = (
        F.when(F.col("bucket").isNull(), "INPUT_GAP").when(F.col("bucket") == F.col("baseline_bucket"), "PASS")
        .when(F.col("_may") & (F.col("eligible") > 0), "EXPECTED_EVIDENCE_SUPERSESSION").when(F.col("_may") & (F.col("eligible") == 0), "INPUT_GAP").otherwise("UNEXPLAINED_REGRESSION")
    )
    return d.select("concept_id", "baseline_bucket", "bucket", state.alias("state"))


def emit_claims(accepted: DataFrame) -> DataFrame:
    """Claims of accepted rows (concept_id, source_id, entry_id, pivot, target, agreement, method, institution): an id by content, and whom they depend on."""
    claim = content_hash("concept_id", "source_id", "entry_id", "pivot", "target", "method")
    return accepted.withColumns({"claim_id": claim, "independence": F.coalesce("institution", "source_id")}).dropDuplicates(["claim_id"])


def terminal_disposition(concepts: DataFrame, claims: DataFrame, blocked: DataFrame) -> DataFrame:
    """One disposition per concept: conflict, agreement, direct, scope review, identity review, none.

    claims: concept_id, agreement (key), independence (key of an independent source). blocked: concept_id, status.
    """
    k = claims.groupBy("concept_id").agg(F.count_distinct("agreement").alias("terms"), F.count_distinct("independence").alias("independent"))
    b = blocked.groupBy("concept_id").agg(F.bool_or(F.col("status").isin("SCOPE_BLOCKED", "LATERALITY_BLOCKED")).alias("scope"), F.count("*").alias("n_blocked"))
    d = concepts.select("concept_id").distinct().join(k, "concept_id", "left").join(b, "concept_id", "left")
    out = (
        F.when(F.col("terms") > 1, "SOURCE_CONFLICT").when((F.col("terms") == 1) & (F.col("independent") > 1), "MULTI_SOURCE_AGREEMENT").when(F.col("terms") == 1, "DIRECT_ATTESTATION")
        .when(F.col("scope"), "SCOPE_REVIEW").when(F.col("n_blocked") > 0, "IDENTITY_REVIEW").otherwise("NO_SOURCE_MATCH")
    )
    return d.select("concept_id", out.alias("disposition"), F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("independent", F.lit(0)).alias("independent"))


def primary_by_precedence(evidence: DataFrame, precedence: Sequence[str]) -> DataFrame:
    """Per concept the status of its terms and the form of the first source in a fixed order; keys keep case and accents."""
    order = F.array_position(F.array(*[F.lit(p) for p in precedence]), F.col("source_id"))
    e = evidence.withColumn("_rank", F.when(order > 0, order).otherwise(F.lit(len(precedence) + 1)))
    g = e.groupBy("concept_id").agg(F.count_distinct("key").alias("terms"), F.count_distinct("source_id").alias("sources"), F.min_by("term", F.struct("_rank", "source_id", "term")).alias("primary"))
    status = F.when(F.col("terms") > 1, "CONFLICT").when(F.col("sources") > 1, "AGREED").otherwise("SINGLE")
    return g.select("concept_id", status.alias("status"), "primary", "terms", "sources")


def summary(decisions: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """One row of conditional counts."""
    return decisions.agg(F.count("*").alias("total"), *[F.count_if(p).alias(n) for n, p in counters.items()])
