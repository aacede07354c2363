"""Rules mined from pairs of opposites, terms derived by them, and composition from a layered lexicon."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.functions.text import multiset_diff, tokens


def head_and_rest(names: DataFrame, column: str = "name") -> DataFrame:
    """Adds head (first word) and rest (null if there is none)."""
    cut = F.instr(F.col(column), " ")
    return names.withColumns({"head": F.when(cut > 0, F.substring_index(F.col(column), " ", 1)), "rest": F.when(cut > 0, F.expr(f"substring(`{column}`, instr(`{column}`, ' ') + 1)"))})


def mine_pairs(claims: DataFrame, pairs: DataFrame) -> DataFrame:
    """Examples (rule_id, rest, first_term, second_term, first_word, second_word).

    claims: name (key), term. pairs: rule_id, first, second. For `first rest` and `second rest`, each
    with one term, whose terms differ by one word a side and are else equal: the words realise the pair.
    """
    one = claims.groupBy("name").agg(F.count_distinct("term").alias("n"), F.min("term").alias("term")).filter("n = 1")
    c = head_and_rest(one).filter("rest is not null").select("head", "rest", "term")
    a = c.join(pairs, F.col("head") == F.col("first")).select("rule_id", "second", "rest", F.col("term").alias("first_term"), F.col("first"))
    b = c.select(F.col("head").alias("second"), "rest", F.col("term").alias("second_term"))
    x = a.join(b, ["second", "rest"]).withColumns({"t1": tokens("first_term"), "t2": tokens("second_term")})
    x = x.withColumns({"d1": multiset_diff("t1", "t2"), "d2": multiset_diff("t2", "t1")}).filter("size(d1) = 1 and size(d2) = 1")
    x = x.filter(multiset_diff("t1", "d1").eqNullSafe(multiset_diff("t2", "d2")))
    return x.select("rule_id", "first", "second", "rest", "first_term", "second_term", F.col("d1")[0].alias("first_word"), F.col("d2")[0].alias("second_word"))


def ordinal_pairs(spark: SparkSession, ordinals: Sequence[str], rule_id: str) -> DataFrame:
    """All pairs of ordinals as pairs of one rule, in the order of their strings."""
    o = sorted(ordinals)
    return spark.createDataFrame([(rule_id, a, b) for i, a in enumerate(o) for b in o[i + 1 :]], "rule_id string, first string, second string")


def enable_ordinals(examples: DataFrame, minimum: int = 1) -> DataFrame:
    """Per rule and ordinal: its words; enabled if there are enough examples and every ordinal of the rule has one word."""
    e = examples.select("rule_id", F.explode(F.array(F.struct(F.col("first").alias("modifier"), F.col("first_word").alias("word")), F.struct(F.col("second").alias("modifier"), F.col("second_word").alias("word")))).alias("m"))
    g = e.groupBy("rule_id", "m.modifier").agg(F.array_sort(F.collect_set("m.word")).alias("words"))
    n = examples.groupBy("rule_id").agg(F.count("*").alias("examples"))
    ok = g.groupBy("rule_id").agg(F.bool_and(F.size("words") == 1).alias("_one")).join(n, "rule_id")
    return g.join(ok, "rule_id").select("rule_id", "modifier", (F.col("_one") & (F.col("examples") >= minimum)).alias("enabled"), F.get("words", F.lit(0)).alias("word"))


def enable_rules(examples: DataFrame, pairs: DataFrame, minimum: int = 3) -> DataFrame:
    """Per rule: examples, the realisations of each side, enabled: enough examples and one realisation a side."""
    g = examples.groupBy("rule_id").agg(F.count("*").alias("examples"), F.array_sort(F.collect_set("first_word")).alias("first_words"), F.array_sort(F.collect_set("second_word")).alias("second_words"))
    r = pairs.join(g, "rule_id", "left")
    ok = (F.col("examples") >= minimum) & (F.size("first_words") == 1) & (F.size("second_words") == 1)
    return r.withColumns({"examples": F.coalesce("examples", F.lit(0)), "enabled": F.coalesce(ok, F.lit(False))})


def modifiers_of(rules: DataFrame) -> DataFrame:
    """(modifier, rule_id, enabled, word) of mined rules, one row a side."""
    side = lambda m, w: F.struct(F.col(m).alias("modifier"), F.get(w, F.lit(0)).alias("word"))
    return rules.select("rule_id", "enabled", F.explode(F.array(side("first", "first_words"), side("second", "second_words"))).alias("m")).select("rule_id", "enabled", "m.*")


def derive(open_names: DataFrame, modifiers: DataFrame, names: DataFrame, bases: DataFrame, blacklist: Sequence[str] = ()) -> DataFrame:
    """Per (concept_id, rule): the derived term, or the first reason against it.

    open_names: concept_id, name. modifiers: modifier, rule_id, enabled, word. names: concept_id,
    name of all concepts. bases: concept_id, kind (of direct evidence), term. A concept that two
    rules would name differently is rejected under both.
    """
    o = head_and_rest(open_names).filter("rest is not null")
    o = o.join(modifiers, F.col("head") == F.col("modifier"))
    b = names.groupBy(F.col("name").alias("rest")).agg(F.count_distinct("concept_id").alias("n_base"), F.min("concept_id").alias("base_id"))
    o = o.join(b, "rest", "left").join(bases.select(F.col("concept_id").alias("base_id"), "kind", F.col("term").alias("base_term")), "base_id", "left")
    black = F.lit(False)
    for w in blacklist:
        black = black | F.contains(F.col("name"), F.lit(w))
    reason = (
        F.when(~F.col("enabled"), "RULE_DISABLED").when(F.col("word").isNull(), "UNATTESTED_MODIFIER").when(F.trim("rest") == "", "NO_BASE_TERM").when(black, "BLACKLISTED")
        .when(F.col("n_base").isNull(), "NO_UNAMBIGUOUS_BASE").when(F.col("n_base") > 1, "MULTIPLE_BASE").when(F.col("kind") == "CONFLICT", "BASE_CONFLICT_OR_SCOPE")
        .when(F.col("kind").isNull() | F.col("base_term").isNull(), "NO_UNAMBIGUOUS_BASE").when(F.col("kind") == "VARIANT", "AMBIGUOUS_BASE")
    )
    o = o.withColumn("reason", reason).withColumn("term", F.when(F.col("reason").isNull(), F.concat_ws(" ", "base_term", "word")))
    w = Window.partitionBy("concept_id")
    many = F.size(F.collect_set("term").over(w)) > 1
    o = o.withColumn("reason", F.when(F.col("term").isNotNull() & many, "AMBIGUOUS_MULTIPLE_RULE_OUTPUTS").otherwise(F.col("reason")))
    return o.select("concept_id", "name", "rule_id", F.when(F.col("reason").isNull(), F.col("term")).alias("term"), "reason", "base_id")


def choose_candidate(candidates: DataFrame, plausible: Column) -> DataFrame:
    """One row per concept_id: plausible before not, more sources, shorter, earlier, then key. Columns: term, sources, pos, key."""
    w = Window.partitionBy("concept_id").orderBy(plausible.desc(), F.desc("sources"), F.length("term"), "pos", "key")
    return candidates.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def plausible_term(c: str = "term", longest: int = 120, prose: str = r"\.\.|(?U)\b(?:is|are|was)\b") -> Column:
    return (F.length(c) <= longest) & ~F.col(c).rlike(prose) & (F.trim(c) != "")


def build_lexicon(layers: DataFrame) -> DataFrame:
    """(component, term, layer, terms) from (component, term, layer, corpus): the lowest layer with a usable value wins.

    In a layer one value stands; of several, all from the corpus, the shortest does, then the least;
    others are dropped, and the next layer is asked.
    """
    g = layers.groupBy("layer", "component").agg(F.array_sort(F.collect_set(F.struct(F.length("term").alias("n"), F.col("term")))).alias("v"), F.bool_and("corpus").alias("corpus"))
    ok = g.filter((F.size("v") == 1) | F.col("corpus")).select("component", "layer", F.get("v", F.lit(0))["term"].alias("term"), F.size("v").alias("terms"))
    return ok.groupBy("component").agg(F.min_by(F.struct("term", "layer", "terms"), "layer").alias("b")).select("component", "b.*")


def lexicon_summary(claims: DataFrame) -> DataFrame:
    """Per (kind, component): numbers of realisations and of pieces of evidence, and whether ambiguous; no lists."""
    g = claims.groupBy("kind", "component").agg(F.count_distinct("term").alias("realisations"), F.count_distinct("evidence_id").alias("evidence"))
    return g.withColumn("ambiguous", F.col("realisations") > 1)


def verified_lexicon(layers: DataFrame) -> DataFrame:
    """(component, term, layer) of verified (component, term, layer): the latest layer's term stands, of several there the least."""
    d = layers.filter("term is not null").groupBy("component", "layer").agg(F.min("term").alias("term"))
    return d.groupBy("component").agg(F.max_by("term", "layer").alias("term"), F.max("layer").alias("layer"))


def compose(names: DataFrame, lexicon: DataFrame, max_n: int = 4, unit: str = "id") -> DataFrame:
    """names (id, name) composed from the longest lexicon entries, left to right; null if a word stays unmatched.

    Word runs of up to max_n words are joined with the lexicon (component, term); the walk over a
    name's few matches is a fold in its row.
    """
    n = names.select(unit, "name", F.filter(F.split("name", " "), lambda x: x != "").alias("w"))
    grams = n.select(unit, F.size("w").alias("size"), F.posexplode("w").alias("pos", "_x"), "w")
    grams = grams.withColumn("len", F.explode(F.sequence(F.lit(1), F.least(F.lit(max_n), F.col("size") - F.col("pos")))))
    grams = grams.select(unit, "pos", "len", F.array_join(F.slice("w", F.col("pos") + 1, F.col("len")), " ").alias("component"))
    hits = grams.join(lexicon.select("component", "term"), "component").groupBy(unit, "pos").agg(F.max(F.struct("len", "component", "term")).alias("m"))
    hits = hits.groupBy(unit).agg(F.map_from_entries(F.collect_list(F.struct("pos", "m"))).alias("best"))
    n = n.join(hits, unit, "left")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("terms"), F.array().cast("array<string>").alias("used"), F.lit(True).alias("ok"))

    def step(a, i):
        m = F.try_element_at("best", i)
        go = F.struct((i + m["len"]).alias("at"), F.concat(a["terms"], F.array(m["term"])).alias("terms"), F.concat(a["used"], F.array(m["component"])).alias("used"), a["ok"].alias("ok"))
        stop = F.struct((i + 1).alias("at"), a["terms"].alias("terms"), a["used"].alias("used"), F.lit(False).alias("ok"))
        return F.when(a["at"] != i, a).when(m.isNotNull(), go).otherwise(stop)

    places = F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1)).otherwise(F.array().cast("array<int>"))
    n = n.withColumn("r", F.aggregate(places, start, step))
    good = F.col("r.ok") & (F.size("w") > 0)
    return n.select(unit, "name", F.when(good, F.array_join("r.terms", " ")).alias("term"), F.when(good, F.col("r.used")).alias("components"))


def compose_modified(names: DataFrame, lexicon: DataFrame, modifiers: DataFrame, max_n: int = 4) -> DataFrame:
    """As compose, with leading modifiers put behind: an exact entry that has every modifier's word, else modifier by modifier, else greedy.

    names: id (unique), name. modifiers: modifier, word; of a modifier listed twice the least word counts. A name's words are
    joined with the modifiers, so neither table has to fit in a task.
    """
    n = names.select("id", "name", F.filter(F.split("name", " "), lambda x: x != "").alias("w"))
    mods = modifiers.groupBy("modifier").agg(F.min("word").alias("word"))
    hit = n.select("id", F.posexplode("w").alias("at", "modifier")).join(mods, "modifier").groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("at", "word"))).alias("mods"))
    n = n.join(hit, "id", "left").withColumn("mods", F.coalesce("mods", F.create_map().cast("map<int,string>")))
    lead = F.coalesce(F.array_position(F.transform("w", lambda x, i: F.map_contains_key("mods", i)), False), F.lit(0))
    n = n.withColumn("lead", F.when(lead == 0, F.size("w")).otherwise(lead - 1).cast("int"))
    n = n.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("lead"))))
    n = n.select("id", "name", "k", F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"), F.transform(F.slice("w", F.lit(1), F.col("lead")), lambda x, i: F.try_element_at("mods", i)).alias("words"))
    exact = n.join(lexicon.select(F.col("component").alias("rest"), F.col("term").alias("exact")), "rest", "left")
    missing = F.exists(F.slice("words", F.col("k") + 1, F.size("words")), lambda x: ~F.array_contains(F.split("exact", " "), x))
    greedy = compose(n.select(F.concat_ws("#", "id", "k").alias("gid"), F.col("rest").alias("name")), lexicon, max_n, "gid").select("gid", F.col("term").alias("greedy"))
    e = exact.withColumn("exact", F.when(~F.coalesce(missing, F.lit(False)), F.col("exact"))).withColumn("gid", F.concat_ws("#", "id", "k")).join(greedy, "gid", "left")
    g = e.groupBy("id", "name").agg(F.array_sort(F.collect_list(F.struct("k", "exact", "greedy"))).alias("s"), F.first("words").alias("words"))
    # from the last suffix back: its exact entry, else what follows with this place's modifier behind, else its greedy form
    out = F.aggregate(F.reverse("s"), F.lit(None).cast("string"), lambda a, x: F.coalesce(x["exact"], F.when(a.isNotNull(), F.concat_ws(" ", a, F.try_element_at("words", (x["k"] + 1).cast("int")))), x["greedy"]))
    return g.select("id", "name", out.alias("term"))


def unblock(rows: DataFrame, decisions: DataFrame, synonyms: DataFrame, generic: Sequence[str]) -> DataFrame:
    """Rows blocked by exactly one generic blocker whose name is an exact pinned synonym of one concept.

    rows: row_id, key. decisions: row_id, blockers. synonyms: key, concept_id.
    """
    d = decisions.filter((F.size("blockers") == 1) & F.col("blockers")[0].isin(list(generic))).select("row_id")
    one = synonyms.groupBy("key").agg(F.count_distinct("concept_id").alias("n"), F.min("concept_id").alias("concept_id")).filter("n = 1").drop("n")
    return rows.join(d, "row_id", "left_semi").join(one, "key").select("row_id", "concept_id", F.lit("STRUCTURE_ONLY").alias("method"))


def assemble(concepts: DataFrame, direct: DataFrame, unblocked: DataFrame, derived: DataFrame) -> DataFrame:
    """One disposition per concept and its term: conflict, variant, direct, multi, unblocked, derived, open.

    direct: concept_id, kind, term; unblocked, derived: concept_id, term.
    """
    u = unblocked.groupBy("concept_id").agg(F.count_distinct("term").alias("u_n"), F.min("term").alias("u_term"))
    r = derived.filter("term is not null").groupBy("concept_id").agg(F.count_distinct("term").alias("r_n"), F.min("term").alias("r_term"))
    d = concepts.select("concept_id").distinct().join(direct, "concept_id", "left").join(u, "concept_id", "left").join(r, "concept_id", "left")
    out = (
        F.when(F.col("kind") == "CONFLICT", "SOURCE_CONFLICT").when(F.col("kind") == "VARIANT", "SOURCE_VARIANT").when(F.col("kind") == "MULTI", "MULTI_SOURCE").when(F.col("kind") == "DIRECT", "DIRECT")
        .when(F.col("u_n") == 1, "STRUCTURE_UNBLOCKED").when(F.col("r_n") == 1, "DERIVED").otherwise("OPEN")
    )
    d = d.withColumn("disposition", out)
    term = F.when(F.col("disposition").isin("MULTI_SOURCE", "DIRECT"), F.col("term")).when(F.col("disposition") == "STRUCTURE_UNBLOCKED", F.col("u_term")).when(F.col("disposition") == "DERIVED", F.col("r_term"))
    return d.select("concept_id", "disposition", term.alias("term"))


def evidence_class(assembled: DataFrame, sourced: DataFrame, composed: DataFrame) -> DataFrame:
    """VERIFIED, PROVISIONAL_SOURCED, PROVISIONAL_TRANSLATED or NO_TRANSLATION per concept, with term and method.

    A derived or composed string is never said to be sourced.
    """
    s, c = sourced.select("concept_id", F.col("term").alias("s_term")), composed.select("concept_id", F.col("term").alias("c_term"))
    d = assembled.join(s, "concept_id", "left").join(c, "concept_id", "left")
    by_source = F.col("disposition").isin("DIRECT", "MULTI_SOURCE", "STRUCTURE_UNBLOCKED")
    cls = F.when(F.col("term").isNotNull(), "VERIFIED").when(F.col("s_term").isNotNull(), "PROVISIONAL_SOURCED").when(F.col("c_term").isNotNull(), "PROVISIONAL_TRANSLATED").otherwise("NO_TRANSLATION")
    method = F.when(F.col("term").isNotNull() & by_source, "SOURCE").when(F.col("term").isNotNull(), "RULE").when(F.col("s_term").isNotNull(), "SOURCE_CANDIDATE").when(F.col("c_term").isNotNull(), "LEXICON").otherwise("NONE")
    return d.select("concept_id", F.coalesce("term", "s_term", "c_term").alias("term"), cls.alias("evidence_status"), method.alias("method"))
