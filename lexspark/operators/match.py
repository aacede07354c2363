"""Matching attestations to entities by keys, and what speaks against a match."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lexspark.functions.text import base_name, exact_key, extra_scope_words, first_of, first_with_prefix, fold_key, scope_safe_key, side, tag_signals, terms
from lexspark.operators.topk import first_k
from lexspark.sources.io import shared_path

#: Tasks that keys are met in, given outright: by default their number is the session's, whatever the input, and a task's memory grows with it.
KEY_TASKS = 128
#: Reasons in order of strength.
REASONS = ("exact", "normalised", "terminology_id", "source_code")


def distinct_keys(df: DataFrame, column: str, key: Callable[[Column], Column], name: str) -> DataFrame:
    """(column, name): the key of each distinct string, made once."""
    d = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return d.withColumn(name, key(F.col(column))).filter(F.col(name) != "")


def build_keys(evidence: DataFrame) -> DataFrame:
    """The long key table (kind, key, evidence_id) of attestations with evidence_id, pivot, terminology_ids, source_codes."""
    # A term's keys are made where it stands, so that nothing is shuffled for them; keys then go at once where match_entities meets them.
    names = evidence.select("evidence_id", F.explode(terms("pivot.preferred", "pivot.aliases")).alias("term")).withColumns({"exact": exact_key("term"), "normalised": fold_key("term")})
    by_name = names.select("evidence_id", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in REASONS[:2]])).alias("k"))
    codes = [evidence.select("evidence_id", F.explode(c).alias("term")).select("evidence_id", F.struct(F.lit(k).alias("kind"), fold_key("term").alias("key")).alias("k")) for k, c in (("terminology_id", "terminology_ids"), ("source_code", "source_codes"))]
    out = by_name.union(codes[0]).union(codes[1]).select("k.kind", "k.key", "evidence_id")
    return out.filter("key <> ''").repartition(KEY_TASKS, "kind", "key").distinct()


def match_entities(concepts: DataFrame, keys: DataFrame) -> DataFrame:
    """(concept_id, evidence_id, reasons): matches by exact name, else normalised name, and by id or code.

    One equi-join on (kind, key); whatever matched exactly is not said to match normalised.
    """
    wanted = concepts.select("concept_id", F.explode(F.array(
        F.struct(F.lit("exact").alias("kind"), exact_key("name").alias("key")),
        F.struct(F.lit("normalised").alias("kind"), fold_key("name").alias("key")),
        F.struct(F.lit("terminology_id").alias("kind"), fold_key("concept_id").alias("key")),
        F.struct(F.lit("source_code").alias("kind"), fold_key("concept_id").alias("key")),
    )).alias("k")).select("concept_id", "k.kind", "k.key").filter("key <> ''").repartition(KEY_TASKS, "kind", "key").distinct()
    found = wanted.join(keys, ["kind", "key"]).repartition(KEY_TASKS, "concept_id", "evidence_id").groupBy("concept_id", "evidence_id").agg(F.array_sort(F.collect_set("kind")).alias("r"))
    r = F.col("r")
    return found.select("concept_id", "evidence_id", F.when(F.array_contains(r, "exact"), F.array_remove(r, "normalised")).otherwise(r).alias("reasons"))


VIEWS = ("EXACT", "NORMALISED", "BY_ID", "THIRD_BEARING", "TARGET_BEARING")


def match_views(matches: DataFrame, evidence: DataFrame) -> DataFrame:
    """(view, concept_id, evidence_id): matches by how they were made, and those whose evidence has a third or a target term; a match may be in several views.

    evidence: evidence_id, third, target (term blocks).
    """
    there = lambda c: F.exists(terms(f"{c}.preferred", f"{c}.aliases"), lambda t: F.trim(t) != "")
    e = evidence.select("evidence_id", F.coalesce(there("third"), F.lit(False)).alias("_third"), F.coalesce(there("target"), F.lit(False)).alias("_target"))
    has = lambda r: F.array_contains("reasons", r)
    tests = (has("exact"), has("normalised"), has("terminology_id") | has("source_code"), F.col("_third"), F.col("_target"))
    views = F.array_compact(F.array(*[F.when(p, F.lit(v)) for v, p in zip(VIEWS, tests, strict=True)]))
    return matches.repartition(KEY_TASKS, "evidence_id").join(e, "evidence_id").select(F.explode(views).alias("view"), "concept_id", "evidence_id")


def ends(names: DataFrame, key: str = "key", carry: Sequence[str] = ()) -> DataFrame:
    """(key, lo, hi) of names: the least and the greatest concept of each key, as structs (concept_id, *carry).

    Whether a row has no concept, one or several follows from these two alone, so a join on the key
    gives a row for a row, however many concepts share a key.
    """
    c = F.struct("concept_id", *carry)
    return names.filter(F.col("concept_id").isNotNull()).groupBy(key).agg(F.min(c).alias("lo"), F.max(c).alias("hi"))


def unique_match(variants: DataFrame, names: DataFrame) -> DataFrame:
    """variants (row_id, tier, key) joined with names (key, concept_id): row_id, outcome NONE / ONE / MANY, concept_id and tier if one."""
    hits = variants.join(ends(names), "key", "left").groupBy("row_id").agg(F.min("lo.concept_id").alias("lo"), F.max("hi.concept_id").alias("hi"), F.min(F.when(F.col("lo").isNotNull(), F.col("tier"))).alias("tier"))
    one = F.col("lo").eqNullSafe(F.col("hi")) & F.col("lo").isNotNull()
    outcome = F.when(F.col("lo").isNull(), "NONE").when(one, "ONE").otherwise("MANY")
    return hits.select("row_id", outcome.alias("outcome"), F.when(one, F.col("lo")).alias("concept_id"), F.when(one, F.col("tier")).alias("tier"))


def localisation_gate(rows: DataFrame, concepts: DataFrame, scope: Sequence[str], sides: Sequence[str], wrapper: str, blocked: str) -> DataFrame:
    """rows (row_id, preferred, aliases, laterality, provenance) to a status each, with concept_id, method and blockers.

    Names are tried as written, without the wrapper, and by alias; the last way that finds a concept
    names the method. scope, sides: rule words. blocked: pattern of provenance that blocks a row.
    """
    core = F.trim(F.regexp_replace("preferred", wrapper, "$1"))
    r = rows.withColumns({"core": core, "declared": scope_safe_key(F.coalesce("laterality", F.lit("unsided")))})
    way = lambda rank, method, term: F.struct(F.lit(rank).alias("rank"), F.lit(method).alias("method"), term.alias("term"))
    forms = F.array(way(1, "EXACT", F.col("preferred")), way(2, "EXACT_WITHOUT_WRAPPER", F.when(F.col("core") != F.trim("preferred"), F.col("core"))))
    by_alias = F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: way(3, "SYNONYM", a))
    named = r.select("row_id", F.explode(F.concat(forms, by_alias)).alias("f")).select("row_id", "f.*").filter("term is not null").withColumn("key", scope_safe_key("term"))
    targets = concepts.select("concept_id", "name", scope_safe_key("name").alias("key"))
    met = named.join(ends(targets, carry=["name"]), "key")
    hits = met.groupBy("row_id").agg(F.min("lo.concept_id").alias("_lo"), F.max("hi.concept_id").alias("_hi"), F.max_by(F.struct("lo.concept_id", "lo.name", "method"), "rank").alias("hit"))
    hits = hits.select("row_id", "hit", F.when(F.col("_lo") == F.col("_hi"), 1).otherwise(2).alias("n"))
    d = r.join(hits, "row_id", "left").withColumns({"concept_id": F.col("hit.concept_id"), "name": F.col("hit.name"), "method": F.col("hit.method")})
    extra = extra_scope_words(scope_safe_key("core"), scope_safe_key("name"), scope)
    here = F.when(F.col("declared").isin(list(sides)), F.col("declared")).otherwise(side(scope_safe_key("core"), sides))
    d = d.withColumns({"extra": F.coalesce(extra, F.array().cast("array<string>")), "source_side": here, "target_side": side(scope_safe_key("name"), sides)})
    wrong_side = (F.col("source_side") != "unsided") & (F.col("source_side") != F.col("target_side"))
    status = (
        F.when(F.lower(F.coalesce("provenance", F.lit(""))).rlike(blocked), "PARSER_BLOCKED").when(F.col("n").isNull(), "NO_IDENTITY").when(F.col("n") > 1, "MULTIPLE_TARGETS")
        .when(wrong_side, "LATERALITY_BLOCKED").when(F.size("extra") > 0, "SCOPE_BLOCKED").otherwise("ACCEPTED")
    )
    blockers = F.concat(F.transform("extra", lambda w: F.concat(F.lit("SCOPE_QUALIFIER_"), F.upper(w))), F.when(wrong_side, F.array(F.concat_ws("_", F.lit("LATERALITY_MISMATCH"), "source_side", F.lit("TO"), "target_side"))).otherwise(F.array().cast("array<string>")))
    one = F.col("status").isin("LATERALITY_BLOCKED", "SCOPE_BLOCKED", "ACCEPTED")
    d = d.withColumn("status", status).withColumn("_blockers", blockers)
    return d.select("row_id", "status", F.when(one, F.col("concept_id")).alias("concept_id"), F.when(one, F.col("method")).alias("method"), F.when(one, F.col("_blockers")).otherwise(F.array("status")).alias("blockers"), "core")


def compare_semantics(matches: DataFrame, rules: Sequence[tuple[str, str]], categories: Sequence[str], clashing: Sequence[tuple[str, str]]) -> DataFrame:
    """Flags (concept_id, evidence_id, code, detail, concept_value, source_value) of matched pairs.

    matches: concept_id, evidence_id, name, strings (array, in field order), laterality, category,
    reasons. rules: (tag, pattern on folded text), tags like "direction:upper". A declared
    laterality wins over what the text says, and "unsided" differs from a side.
    """
    m = matches.withColumns({"c": tag_signals(F.array(fold_key("name")), rules), "s": tag_signals(F.transform("strings", lambda x: fold_key(x)), rules)})
    m = m.withColumns({"c_side": first_with_prefix("c", "laterality"), "s_side": F.coalesce(F.nullif("laterality", F.lit("")), first_with_prefix("s", "laterality")), "c_cat": first_of("c", "category", categories), "s_cat": F.coalesce(F.lower(F.nullif("category", F.lit(""))), first_of("s", "category", categories))})
    has = lambda c, t: F.array_contains(c, t)
    pair = F.concat_ws("/", F.array_sort(F.array("c_cat", "s_cat")))
    wide = lambda c: F.exists(c, lambda t: t.startswith("scope:"))
    flag = lambda code, detail, a, b: F.struct(F.lit(code).alias("code"), detail.cast("string").alias("detail"), a.cast("string").alias("concept_value"), b.cast("string").alias("source_value"))
    none = F.lit(None)
    by_id = F.arrays_overlap("reasons", F.array(F.lit("terminology_id"), F.lit("source_code")))
    found = [
        F.when(F.col("c_side") != F.col("s_side"), flag("LATERALITY_MISMATCH", none, F.col("c_side"), F.col("s_side"))),
        F.when(F.col("c_side").isNotNull() & F.col("s_side").isNull() & by_id, flag("LATERALITY_UNPINNED", none, F.col("c_side"), none)),
        F.when((F.col("c_cat") != F.col("s_cat")) & pair.isin(["/".join(sorted(p)) for p in clashing]), flag("CATEGORY_MISMATCH", pair, F.col("c_cat"), F.col("s_cat"))),
        F.when((has("c", "structure:branch") & has("s", "structure:trunk")) | (has("c", "structure:trunk") & has("s", "structure:branch")), flag("BRANCH_TRUNK_MISMATCH", none, none, none)),
    ]
    for kind in ("direction", "depth"):
        a, b = first_with_prefix("c", kind), first_with_prefix("s", kind)
        found.append(F.when(a != b, flag("DIRECTIONAL_QUALIFIER_MISMATCH", F.lit(kind), a, b)))
    found.append(F.when(wide("c") != wide("s"), flag("AGGREGATE_SCOPE_MISMATCH", none, wide("c"), wide("s"))))
    return m.select("concept_id", "evidence_id", F.explode(F.array_compact(F.array(*found))).alias("f")).select("concept_id", "evidence_id", "f.*")


#: Users of an element from which it is hot: its neighbours are counted by bitmaps, not by pairs.
HOT = 512
#: Parts that the elements of one concept are dealt to, if it has more than as many.
PARTS = 4096
#: Concepts of a block (a power of two), and the pairs, repeats included, that one part of a block makes.
BLOCK_BITS, BLOCK_PAIRS = 8, 1 << 23


def _neighbours(cold: DataFrame, concepts: DataFrame, total: int) -> DataFrame:
    """(number, others, whole): the distinct concepts (numbers) that share an element of cold (number, element_id), itself among them.

    Concepts are numbered in their order, and 256 neighbours are a block. An element's users go
    once to each block that has one of them, not once to each user, and are united there. A block
    that makes many pairs is dealt out by elements, so a concept of any number of elements is no
    task's alone; a number has a row for each part, and `whole` tells that it is the only one.
    """
    block = lambda n: F.shiftright(n, BLOCK_BITS)
    parts = concepts.groupBy(block("number").alias("block")).agg(F.ceil(F.sum("cold_users") / BLOCK_PAIRS).alias("parts")).filter("parts > 0")
    users = cold.groupBy("element_id").agg(F.collect_list("number").alias("others"))
    d = users.select("element_id", "others", F.explode(F.array_distinct(F.transform("others", block))).alias("block")).join(F.broadcast(parts), "block")
    d = d.select("block", "parts", F.pmod(F.xxhash64("element_id"), "parts").alias("part"), F.filter("others", lambda n: block(n) == F.col("block")).alias("mine"), "others")
    # Rows are short and make many pairs, so tasks are numbered by the pairs.
    d = d.repartition(2 * (total // BLOCK_PAIRS + 1), "block", "part").select("block", "part", "parts", F.explode("mine").alias("number"), "others")
    d = d.groupBy("block", "part", "parts", "number").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
    return d.select("number", "others", (F.col("parts") == 1).alias("whole"))


def shared_membership(membership: DataFrame, show: int = 25, hot: int = HOT) -> DataFrame:
    """Per concept of (concept_id, element_id): elements, elements that others use, overlapping concepts, the first of them.

    Members with the users of their element, and concepts with a number, are stored once. Elements of
    one concept alone drop out first. Elements of fewer than `hot` concepts give pairs, in blocks of
    concepts. The others give bitmaps: concepts with the same hot elements, which have the same
    neighbours through them, unite these elements' bitmaps once. Pairs that the bitmaps have counted
    already are left out by the elements that their two concepts share. The first overlaps come
    from the least `show` + 1 concepts of each element; with `show` 0 none are sought. So an element
    that all concepts have costs no row for a pair.
    """
    spark = membership.sparkSession
    at = shared_path(spark, "membership")

    def stored(d: DataFrame, name: str) -> DataFrame:
        d.write.parquet(f"{at}/{name}")
        return spark.read.schema(d.schema).parquet(f"{at}/{name}")

    m = membership.select("concept_id", "element_id").distinct()
    # counted and joined rather than windowed: a hot element's rows may then be split among tasks
    counted = stored(m.join(m.groupBy("element_id").agg(F.count("*").alias("users")), "element_id").select("concept_id", "element_id", "users"), "members")
    is_cold, is_hot = (F.col("users") > 1) & (F.col("users") < hot), (F.col("users") > 1) & (F.col("users") >= hot)
    per = counted.groupBy("concept_id").agg(F.count("*").alias("elements"), F.count_if(F.col("users") > 1).alias("shared_elements"), F.sum(F.when(is_cold, F.col("users")).otherwise(0)).alias("cold_users"), F.count_if(is_hot).alias("hot_elements"))
    # Numbers follow the order of the concepts; once written, they stay the same.
    concepts = stored(per.repartitionByRange("concept_id").sortWithinPartitions("concept_id").withColumn("number", F.monotonically_increasing_id()), "concepts")
    found = concepts.filter("concept_id is not null").agg(F.sum("cold_users").alias("cold"), F.sum("hot_elements").alias("hot")).first()
    numbered = lambda d: d.select("concept_id", "element_id").join(concepts.select("concept_id", "number", "elements"), "concept_id")
    cold = numbered(counted.filter(is_cold))
    near = _neighbours(cold.select("number", "element_id"), concepts.filter("concept_id is not null"), found.cold or 0)
    pairs_of = lambda d: d.select("number", F.explode("others").alias("other")).filter("number <> other").distinct()
    if not found.hot:
        over = pairs_of(near.filter("not whole")).groupBy("number").agg(F.count("*").alias("overlapping")).union(near.filter("whole").select("number", (F.size("others") - 1).cast("long")))
    else:
        # A concept's hot elements are a set of its own.
        warm = numbered(counted.filter(is_hot))
        sets = warm.groupBy("number").agg(F.array_sort(F.collect_set("element_id")).alias("hot"))
        sets = stored(sets.select("number", "hot", F.sha2(F.to_json("hot"), 256).alias("set")), "sets")
        bits = sets.select("number", F.explode("hot").alias("element_id")).groupBy("element_id", F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        kinds = sets.groupBy("set").agg(F.any_value("hot").alias("hot")).select("set", F.explode("hot").alias("element_id"))
        united = kinds.join(bits, "element_id").groupBy("set", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        sizes = united.groupBy("set").agg(F.sum(F.bitmap_count("bits")).alias("near"))
        by_bits = sets.join(sizes, "set").select("number", (F.col("near") - 1).alias("n"))
        mine, theirs = sets.select("number", "hot"), sets.select(F.col("number").alias("other"), F.col("hot").alias("_hot"))
        fresh = pairs_of(near).join(mine, "number", "left").join(theirs, "other", "left").filter(~F.coalesce(F.arrays_overlap("hot", "_hot"), F.lit(False)))
        over = by_bits.union(fresh.groupBy("number").agg(F.count("*").alias("n"))).groupBy("number").agg(F.sum("n").alias("overlapping"))
    out = concepts.join(over, "number", "left").withColumn("overlapping", F.coalesce("overlapping", F.lit(0)))
    if not show:
        none = F.lit(None).cast(ArrayType(membership.schema["concept_id"].dataType))
        return out.select("concept_id", "elements", "shared_elements", "overlapping", none.alias("first_overlaps"))
    # The least show + 1 of a union are among those of its parts: of an element's concepts, then of a concept's elements, many of which are dealt out first.
    some = lambda c: F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), 1, show + 1).alias("near")
    least = first_k(counted.filter("users > 1").select("element_id", "concept_id"), ["element_id"], [F.col("concept_id")], show + 1).groupBy("element_id").agg(F.collect_list("concept_id").alias("near"))

    def nearest(d: DataFrame, key: str, many: Column) -> DataFrame:
        part = F.when(many, F.pmod(F.xxhash64("element_id"), F.lit(PARTS))).otherwise(0)
        return d.join(least, "element_id").groupBy(key, part.alias("part")).agg(some("near")).select(key, "near")

    near = nearest(cold, "number", F.col("elements") > PARTS)
    if found.hot:
        # Concepts with the same hot elements have the same first neighbours through them.
        of_set = nearest(kinds, "set", F.lit(True)).groupBy("set").agg(some("near"))
        near = near.union(sets.select("number", "set").join(of_set, "set").select("number", "near"))
    near = near.groupBy("number").agg(some("near"))
    first = F.slice(F.filter("near", lambda x: x != F.col("concept_id")), 1, show)
    return out.join(near, "number", "left").select("concept_id", "elements", "shared_elements", "overlapping", first.alias("first_overlaps"))


def _sided(concepts: DataFrame, membership: DataFrame, words: Sequence[str]) -> DataFrame:
    c = concepts.select("concept_id", base_name("name", words).alias("base"), F.arrays_overlap(F.split(fold_key("name"), " "), F.array(*[F.lit(w) for w in words])).alias("sided"))
    return c.join(membership.select("concept_id", "element_id").distinct(), "concept_id")


def sided_siblings(concepts: DataFrame, membership: DataFrame, words: Sequence[str]) -> DataFrame:
    """Unsided concepts that share an element with a sided one of the same base name: (concept_id, sibling_id).

    The output is pairs, so it grows with the product of a base name's unsided and sided concepts;
    whether a concept has any is with_sided_sibling, which makes none.
    """
    m = _sided(concepts, membership, words)
    dealt = lambda d: d.repartition(KEY_TASKS, "base", "element_id")
    a = dealt(m.filter("not sided").select("concept_id", "base", "element_id"))
    b = dealt(m.filter("sided").select(F.col("concept_id").alias("sibling_id"), "base", "element_id"))
    pairs = a.join(b, ["base", "element_id"]).select("concept_id", "sibling_id")
    return pairs.repartition(KEY_TASKS, "concept_id", "sibling_id").distinct()


def with_sided_sibling(concepts: DataFrame, membership: DataFrame, words: Sequence[str]) -> DataFrame:
    """The concept_ids that sided_siblings has, without its pairs."""
    m = _sided(concepts, membership, words)
    return m.filter("not sided").join(m.filter("sided").select("base", "element_id").distinct(), ["base", "element_id"], "left_semi").select("concept_id").distinct()


def membership_heuristics(concepts: DataFrame, membership: DataFrame, aggregate_pattern: str, words: Sequence[str], many: int = 8) -> DataFrame:
    """Per concept: counts of shared_membership, aggregate_or_composite, unsided_with_sided_sibling, ontology_risk."""
    s = with_sided_sibling(concepts, membership, words).withColumn("sibling", F.lit(True))
    out = concepts.select("concept_id", "name").join(shared_membership(membership), "concept_id", "left").join(s, "concept_id", "left")
    sib, el = F.coalesce("sibling", F.lit(False)), F.coalesce("elements", F.lit(0))
    aggregate = (el >= many) | fold_key("name").rlike(aggregate_pattern)
    return out.select("concept_id", el.alias("elements"), F.coalesce("shared_elements", F.lit(0)).alias("shared_elements"), F.coalesce("overlapping", F.lit(0)).alias("overlapping"), "first_overlaps", aggregate.alias("aggregate_or_composite"), sib.alias("unsided_with_sided_sibling"), (sib | (F.coalesce("overlapping", F.lit(0)) > 0)).alias("ontology_risk"))


#: Parts that the pairs of one identifier are dealt to, and tasks that make the pairs of all.
BRIDGE_SALTS, BRIDGE_TASKS = 64, 256


def shared_identifier_bridge(a: DataFrame, b: DataFrame, release: str) -> DataFrame:
    """All pairs of atoms (atom_id, identifier, release, suppressed) of two vocabularies that share an identifier in one release.

    Adds how many partners each end has; every pair is for review only. The output is pairs and
    grows with them, but they are neither shuffled nor kept: partners are counted between classes of
    atoms that have the same identifiers, and the pairs of one identifier are made by many tasks.
    """
    live = lambda d, c: d.filter((F.col("release") == release) & ~F.coalesce("suppressed", F.lit(False))).select(F.col("atom_id").alias(c), "identifier").distinct()
    # Null atoms have no partners in the counts, so they make no pair.
    left, right = (live(d, c).filter(F.col(c).isNotNull()) for d, c in ((a, "left_id"), (b, "right_id")))
    left, right = left.join(right.select("identifier").distinct(), "identifier", "left_semi"), right.join(left.select("identifier").distinct(), "identifier", "left_semi")

    def classes(d, c, side):
        members = d.groupBy(c).agg(F.array_sort(F.collect_set("identifier")).alias("_ids")).withColumn(f"_{side}", F.sha2(F.to_json("_ids"), 256))
        kinds = members.groupBy(f"_{side}").agg(F.count("*").alias(f"_{side}_n"), F.any_value("_ids").alias("_ids"))
        return members.drop("_ids"), kinds.select(f"_{side}", f"_{side}_n", F.explode("_ids").alias("identifier"))

    (of_left, l), (of_right, r) = classes(left, "left_id", "l"), classes(right, "right_id", "r")
    near = l.join(r, "identifier").drop("identifier").distinct()
    left = left.join(of_left.join(near.groupBy("_l").agg(F.sum("_r_n").alias("left_partners")), "_l").drop("_l"), "left_id")
    right = right.join(of_right.join(near.groupBy("_r").agg(F.sum("_l_n").alias("right_partners")), "_r").drop("_r"), "right_id")
    # The side that is repeated for each part is linear in the input; a given number of partitions is not merged into a few.
    left = left.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(BRIDGE_SALTS - 1))))
    right = right.withColumn("_part", F.pmod(F.xxhash64("right_id"), F.lit(BRIDGE_SALTS)).cast("int"))
    dealt = lambda d: d.repartition(BRIDGE_TASKS, "identifier", "_part")
    p = dealt(left).hint("merge").join(dealt(right), ["identifier", "_part"])
    return p.select("right_id", "left_id", "identifier", "left_partners", "right_partners", F.lit("REVIEW_ONLY").alias("status"))
