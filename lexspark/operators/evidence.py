"""Attestations: contract checks, exact duplicates, and what their sources may support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.text import content_hash, exact_locator, is_blank, locator_supported

LATERALITY = ("left", "right", "bilateral", "unsided", "unknown")


def findings_of(df: DataFrame, rules: list[tuple[str, str, Column]], entity: str, table: str = "") -> DataFrame:
    """finding(code, severity, entity_id, path, message) for each rule (code, severity, predicate) that holds for a row."""
    hits = F.array_compact(F.array(*[F.when(p, F.struct(F.lit(c).alias("code"), F.lit(s).alias("severity"))) for c, s, p in rules]))
    rows = df.select(F.col(entity).cast("string").alias("entity_id"), F.explode(hits).alias("f"))
    return rows.select("f.code", "f.severity", "entity_id", F.lit(table).alias("path"), F.concat_ws(" ", F.lit(table), F.lit("rule"), "f.code").alias("message"))


def validate_attestations(df: DataFrame, entity: str = "source_term_raw") -> DataFrame:
    """Findings of the record contract: what is required, enumerations, blank items of arrays."""
    blank_item = lambda c: F.coalesce(F.exists(c, lambda x: is_blank(x)), F.lit(False))
    rules = [(f"missing-{c}", "error", is_blank(F.col(c))) for c in ("source_id", "source_revision", "source_term_raw")]
    rules += [("missing-locator", "error", F.col("locator").isNull())]
    rules += [("invalid-laterality", "error", F.col("laterality").isNotNull() & ~F.col("laterality").isin(*LATERALITY))]
    rules += [(f"blank-{c}-alias", "error", blank_item(F.col(f"{c}.aliases"))) for c in ("pivot", "third", "target")]
    rules += [(f"blank-{c}", "error", blank_item(F.col(c))) for c in ("directional_qualifiers", "source_codes", "terminology_ids")]
    return findings_of(df, rules, entity, "attestation")


def unknown_keys(raw_json: Column, allowed: list[str]) -> Column:
    """Top-level keys of a JSON object that are not allowed."""
    return F.array_except(F.coalesce(F.json_object_keys(raw_json), F.array().cast("array<string>")), F.array(*[F.lit(a) for a in allowed]))


def coalesce_duplicates(df: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row for each set of rows equal in columns (all by default): evidence_id, duplicate_count, and the columns.

    Equal by content, never by normalised text. keep: columns of which the least value is kept.
    """
    columns = columns or df.columns
    named = df.withColumn("evidence_id", content_hash(*columns))
    rest = [F.first(c).alias(c) for c in columns] + [F.min(c).alias(c) for c in keep or []]
    return named.groupBy("evidence_id").agg(F.count("*").alias("duplicate_count"), *rest)


def assess_sources(df: DataFrame, catalog: DataFrame, section_sources: list[str] | None = None) -> DataFrame:
    """Adds what a record's source is good for: known, revision_matches, research_eligible, claim_eligible.

    catalog: one row a source; Spark decides by its size whether it is broadcast.
    """
    c = catalog.select(F.col("id").alias("_c_id"), F.struct("*").alias("source"))
    df = df.join(c, df["source_id"] == F.col("_c_id"), "left")
    s = F.col("source")
    section = F.col("source_id").isin(section_sources) if section_sources else None
    located = exact_locator("locator") | locator_supported(s["locator_capability"], "locator", section)
    revision = F.coalesce(s["revision"] == F.col("source_revision"), F.lit(False))
    eligible = revision & (s["authority_tier"] == "authoritative") & s["capabilities"]["target_preferred"] & s["access_copy_of"].isNull() & located
    claim = eligible & locator_supported(s["locator_capability"], "locator", section) & (s["access_status"] == "FULL_ACCESS") & s["content_inspected"] & (s["audit"]["status"] == "VERIFIED")
    out = {"known": F.col("_c_id").isNotNull(), "revision_matches": revision, "research_eligible": eligible, "claim_eligible": claim}
    return df.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in out.items()}).drop("_c_id", "source")


def unresolved_sources(df: DataFrame, catalog: DataFrame) -> DataFrame:
    return df.join(catalog.select(F.col("id").alias("source_id")), "source_id", "left_anti").select("source_id").distinct()


def revision_mismatches(df: DataFrame, catalog: DataFrame) -> DataFrame:
    c = catalog.select(F.col("id").alias("source_id"), F.col("revision"))
    return df.join(c, "source_id").filter("revision <> source_revision").select("source_id", "source_revision", "revision").distinct()


def unsafe(matches: DataFrame, flags: DataFrame, codes: list[str]) -> DataFrame:
    """Matches with an unknown or stale source, an access copy, an id-only reason, or one of the flags."""
    only_id = F.forall("reasons", lambda r: r.isin("terminology_id", "source_code"))
    bad = flags.filter(F.col("code").isin(codes)).select("concept_id", "evidence_id").distinct().withColumn("_flagged", F.lit(True))
    m = matches.join(bad, ["concept_id", "evidence_id"], "left")
    return m.withColumn("unsafe", ~F.col("known") | ~F.col("revision_matches") | only_id | F.coalesce("_flagged", F.lit(False))).drop("_flagged")
