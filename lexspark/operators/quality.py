"""Checks of generated strings against rule tables, and their repair with a log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions.text import collapse, padded


def _with_codes(records: DataFrame, rules: DataFrame, residue: str, **names: str) -> DataFrame:
    """Adds arrays of codes, name=target column: what rules and shape say of each target, a row for a row.

    The rules, which people write, go whole to every task as a map by their phrase's first word, so
    that records are neither multiplied nor shuffled; texts are cut into words once.
    """
    r = rules.select("code", *[padded(c).alias(c) for c in ("when_pivot", "needs", "forbids")]).filter("when_pivot is not null")
    r = r.groupBy(F.get(F.split(F.trim("when_pivot"), " "), F.lit(0)).alias("word")).agg(F.collect_list(F.struct("code", "when_pivot", "needs", "forbids")).alias("rules"))
    table = r.agg(F.map_from_entries(F.collect_list(F.struct("word", "rules"))).alias("_rules"))
    d = records.crossJoin(F.broadcast(table)).withColumns({"_pivot": padded("pivot")} | {f"_{n}": padded(c) for n, c in names.items()})
    near = F.flatten(F.transform(F.array_distinct(F.split(F.trim("_pivot"), " ")), lambda w: F.coalesce(F.try_element_at("_rules", w), F.array().cast(f"array<{r.schema['rules'].dataType.elementType.simpleString()}>"))))
    d = d.withColumn("_near", F.filter(near, lambda x: F.contains("_pivot", x["when_pivot"])))
    for n, c in names.items():
        said = F.col(f"_{n}")
        broken = F.filter("_near", lambda x: (x["needs"].isNotNull() & ~F.contains(said, x["needs"])) | (x["forbids"].isNotNull() & F.contains(said, x["forbids"])))  # noqa: B023
        by_rule = F.coalesce(F.transform(broken, lambda x: x["code"]), F.array().cast("array<string>"))
        d = d.withColumn(n, F.concat(by_rule, shape_codes(c, residue)))
    return d.drop("_rules", "_pivot", "_near", *[f"_{n}" for n in names])


def shape_codes(target: str, residue: str = r"[A-Za-z]+\?$") -> Column:
    """What a string's shape shows: empty, same as the pivot, repeated word, doubled space, odd punctuation, residue."""
    t = F.col(target)
    checks = {
        "EMPTY": F.coalesce(F.trim(t) == "", F.lit(True)), "UNTRANSLATED": F.lower(t) == F.lower("pivot"), "REPEATED_WORD": t.rlike(r"(?iU)(?<!\S)(\S+) \1(?!\S)"),
        "SPACING": t != collapse(t), "PUNCTUATION": t.rlike(r" [,.;:)]|[,;:]$|\(\s*\)"), "RESIDUE": t.rlike(residue), "INTERIOR_CAPITAL": t.rlike(r"\s\p{Lu}\p{Ll}"),
    }
    return F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in checks.items()]))


def _united(codes: str) -> Column:
    """The codes of a concept's records, sorted; null if there are none."""
    return _sorted(F.collect_set(codes)).alias(codes)


def _sorted(sets: Column | str) -> Column:
    c = F.array_sort(F.array_distinct(F.flatten(sets)))
    return F.when(F.size(c) > 0, c)


def findings(records: DataFrame, rules: DataFrame, residue: str = r"[A-Za-z]+\?$") -> DataFrame:
    """(concept_id, codes), sorted: records (pivot, target keys) against rules (code, when_pivot, needs, forbids), and their shape.

    A rule applies where the pivot holds the phrase when_pivot; the target must hold `needs` and must
    not hold `forbids` (either may be null).
    """
    d = _with_codes(records.select("concept_id", "pivot", "target"), rules, residue, codes="target")
    # Filtered behind the aggregate: a filter before it would make the codes a second time.
    return d.groupBy("concept_id").agg(_united("codes")).filter("codes is not null")


def repair(records: DataFrame, connector: str | None = None, heads: Sequence[str] = (), replacements: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Adds repaired and actions: connector dropped, structural head moved to the front, words replaced, a repeated head cut, interior capitals lowered."""
    value, actions = F.col("target"), []
    df = records

    def step(df: DataFrame, name: str, new: Column) -> DataFrame:
        df = df.withColumn("_new", new)
        df = df.withColumn("actions", F.when(F.col("_new") != F.col("repaired"), F.concat("actions", F.array(F.lit(name)))).otherwise(F.col("actions")))
        return df.withColumn("repaired", F.coalesce("_new", "repaired")).drop("_new")

    df = df.withColumns({"repaired": value, "actions": F.array(*actions).cast("array<string>")})
    v = F.col("repaired")
    if connector:
        df = step(df, "DROP_CONNECTOR", collapse(F.regexp_replace(v, rf"(?<!\S){connector}(?!\S)", " ")))
    for h in heads:
        df = step(df, "MOVE_HEAD", F.when(v.rlike(rf"^.+ {h}$") & ~v.startswith(h + " "), F.concat(F.lit(h + " "), F.regexp_replace(v, rf" {h}$", ""))).otherwise(v))
    for old, new in replacements:
        df = step(df, "FIX_TERM", F.regexp_replace(v, rf"(?<!\S){old}(?!\S)", new))
    df = step(df, "DEDUPLICATE_HEAD", F.regexp_replace(v, r"^(\S+) \1(?!\S)", "$1"))
    words = F.split(v, " ")
    lowered = F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & w.rlike(r"^\p{Lu}\p{Ll}+$"), F.lower(w)).otherwise(w)), " ")
    return step(df, "LOWER_INTERIOR", lowered)


def qa_status(records: DataFrame, rules: DataFrame, within: Sequence[str] = (), **how) -> DataFrame:
    """CLEAR, REPAIRED, RETAIN, CONFLICT_PRESERVED or NEEDS_HUMAN, findings before and after; only REPAIRED changes the text.

    records: concept_id, pivot, target, generated (bool), conflict (bool). within: columns that follow
    from concept_id; records that lie together by these are not sent again.
    """
    fixed = _with_codes(repair(records, **how), rules, r"[A-Za-z]+\?$", before="target", after="repaired")
    # Records of one concept share their findings; those without an id have none.
    alike = Window.partitionBy(*within, "concept_id")
    d = fixed.withColumns({c: F.when(F.col("concept_id").isNotNull(), F.collect_set(c).over(alike)) for c in ("before", "after")})
    d = d.withColumns({c: _sorted(c) for c in ("before", "after")})
    status = (
        F.when(F.col("conflict"), "CONFLICT_PRESERVED").when(F.col("before").isNull(), "CLEAR").when(~F.col("generated"), "RETAIN")
        .when(F.col("after").isNull() & (F.size("actions") > 0), "REPAIRED").otherwise("NEEDS_HUMAN")
    )
    d = d.withColumn("status", status)
    return d.select("concept_id", "status", F.when(F.col("status") == "REPAIRED", F.col("repaired")).otherwise(F.col("target")).alias("target"), "before", "after", "actions")


def inconsistent_components(uses: DataFrame, key: str = "key") -> DataFrame:
    """Records (concept_id, component, key, term) whose component is realised in more than one way elsewhere: with all the ways."""
    ways = uses.groupBy("component").agg(F.size(F.collect_set(key)).alias("n"), F.array_sort(F.collect_set("term")).alias("ways")).filter("n > 1").drop("n")
    # The ways follow from the component, so rows are made distinct before they carry them.
    return uses.select("concept_id", "component").distinct().join(ways, "component").select("concept_id", "component", "ways")


def target_union(*parts: DataFrame) -> DataFrame:
    """Ids of the parts, and in how many they are: the parts are meant to be disjoint."""
    out = None
    for p in parts:
        p = p.select("concept_id").distinct()
        out = p if out is None else out.union(p)
    return out.groupBy("concept_id").agg(F.count("*").alias("parts"))
