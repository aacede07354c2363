"""Which entities to work on next, and why not the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.text import fold_key

ACTIONS = {
    "EXISTING_CONFLICT_OR_VARIANT": "adjudicate", "EXISTING_EVIDENCE": "retain", "IDENTITY_TARGET": "pin identity", "AGGREGATE_OR_COMPOSITE_TARGET": "keep apart",
    "ONTOLOGY_SCOPE_TARGET": "resolve scope", "LATERALITY_TARGET": "research base", "CLEAN_SIMPLE_TARGET": "harvest",
}


def name_cue(name: Column | str, pattern: str) -> Column:
    """Whether the folded name shows a cue; patterns are the user's."""
    return fold_key(name).rlike(pattern)


def classify_targets(decisions: DataFrame, cues: dict[str, str]) -> DataFrame:
    """Target class of each decision (first rule that holds) and the next action.

    decisions: concept_id, name, bucket, consensus, codes, eligible, aggregate, risk. cues: patterns
    for identity, aggregate, scope and side.
    """
    c = F.col
    cue = {k: name_cue("name", p) for k, p in cues.items()}
    sided = cue["side"] | (c("bucket") == "LATERALITY_REVIEW") | F.array_contains("codes", "LATERALITY_MISMATCH")
    out = (
        F.when(c("bucket").isin("CONFLICT_REQUIRES_ADJUDICATION", "VARIANT_REVIEW") | c("consensus").isin("CONFLICT", "SURFACE_VARIANT_REVIEW"), "EXISTING_CONFLICT_OR_VARIANT")
        .when(c("bucket") == "HIGH_CONSENSUS_CANDIDATE", "EXISTING_EVIDENCE").when((c("bucket") == "IDENTITY_GAP") | cue["identity"], "IDENTITY_TARGET")
        .when((c("bucket") == "AGGREGATE_OR_COMPOSITE_REVIEW") | c("aggregate") | (F.array_contains("codes", "AGGREGATE_SCOPE_MISMATCH") & (c("eligible") == 0)) | cue["aggregate"], "AGGREGATE_OR_COMPOSITE_TARGET")
        .when((c("bucket") == "ONTOLOGY_SCOPE_REVIEW") | (c("risk") & ~sided) | cue["scope"], "ONTOLOGY_SCOPE_TARGET").when(sided, "LATERALITY_TARGET").otherwise("CLEAN_SIMPLE_TARGET")
    )
    actions = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])
    return decisions.select("*", out.alias("target_class")).withColumn("next_action", F.element_at(actions, F.col("target_class")))


def clean_qa(targets: DataFrame, rules: Sequence[tuple[str, str, Column]], default: str = "CONFIRMED_CLEAN") -> DataFrame:
    """Outcome of clean targets by ordered rules (outcome, reason, predicate); the first that holds decides."""
    value = lambda o, r: F.struct(F.lit(o).alias("qa_outcome"), F.lit(r).alias("qa_reason"))
    out = None
    for outcome, reason, p in rules:
        out = F.when(p, value(outcome, reason)) if out is None else out.when(p, value(outcome, reason))
    out = value(default, "NO_RULE") if out is None else out.otherwise(value(default, "NO_RULE"))
    return targets.filter("target_class = 'CLEAN_SIMPLE_TARGET'").withColumn("_q", out).select("*", "_q.*").drop("_q")


def compact_evidence(matches: DataFrame) -> DataFrame:
    """One row per (concept_id, evidence_id): the strongest reason, exact before normalised before others."""
    order = F.array(*[F.lit(r) for r in ("exact", "normalised", "terminology_id", "source_code")])
    m = matches.select("concept_id", "evidence_id", F.explode("reasons").alias("reason"))
    return m.groupBy("concept_id", "evidence_id").agg(F.min_by("reason", F.array_position(order, F.col("reason"))).alias("match_type"))


def select_batch(targets: DataFrame, chosen: Column, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Selected ids, and the excluded ones with reason, class and the number that share these: disjoint and covering."""
    flagged = targets.withColumn("_in", F.coalesce(chosen, F.lit(False))).withColumn("reason", reason)
    out = flagged.filter("not _in").select("reason", "target_class", "concept_id")
    n = out.groupBy(F.col("reason").alias("_r"), F.col("target_class").alias("_c")).agg(F.count("*").alias("n"))
    out = out.join(n, F.col("reason").eqNullSafe(F.col("_r")) & F.col("target_class").eqNullSafe(F.col("_c"))).drop("_r", "_c")
    return flagged.filter("_in").select("concept_id"), out
