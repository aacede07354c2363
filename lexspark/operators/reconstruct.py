"""Rows rebuilt from ordered line streams and positioned words, over many documents at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions.text import collapse, fold_key, join_fragments, split_at_accent, split_synonyms
from lexspark.operators.match import unique_match
from lexspark.operators.metrics import demote_duplicates
from lexspark.sources.io import shared_path


def segment_blocks(lines: DataFrame, start: Column, doc: str = "doc_id", order: str = "line") -> DataFrame:
    """Adds block: 0 before the first start line, then counting. A start line opens a block that goes on to the next."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("block", F.sum(start.cast("long")).over(w))


def carry_forward(lines: DataFrame, columns: dict[str, Column], doc: str = "doc_id", order: str = "line") -> DataFrame:
    """Adds each column with its last value that is not null up to the line."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumns({n: F.last(c, ignorenulls=True).over(w) for n, c in columns.items()})


def line_facts(text: Column | str, code: str, counter: str, headers: Sequence[str], residue: str) -> Column:
    """struct(code, rest, counter, header, residue) of one line, an asterisk before the code left out.

    Patterns: code, at the line's start behind spaces and an asterisk; counter, a whole line with the
    counter as group 1 and the rest as group 2; headers, of lines that no row is made of; residue,
    pivot words that a target must not hold, in any case.
    """
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    start = rf"^\s*(?:\*\s*)?({code})"
    one = F.regexp_extract(t, start, 1)
    said = F.regexp_extract(t, counter, 1)
    rest = F.when(one != "", F.regexp_replace(t, start, "")).when(said != "", F.regexp_extract(t, counter, 2)).otherwise(t)
    header = F.lit(False)
    for h in headers:
        header = header | t.rlike(h)
    return F.struct(F.nullif(one, F.lit("")).alias("code"), collapse(rest).alias("rest"), F.when(one == "", F.nullif(said, F.lit(""))).alias("counter"), header.alias("header"), t.rlike(f"(?i){residue}").alias("residue"))


def rebuild_stream(lines: DataFrame, names: DataFrame, code: str, counter: str, complete: str, page: str, heading: str = r"^\s*##\s+(.*)$", residue: str = r"(?:^|\s)(?:of|the|and)(?:\s|$)") -> DataFrame:
    """One audit row for each block of a rendered stream: printed_id, page, section, pivot, target, concept_id, status, reasons, line_start, line_end.

    lines: doc_id, line, text. Patterns: code, a line that opens a block, with the code as group 1 and
    the rest as group 2; counter, a continuation that opens with the last digits of the id (group 1)
    and its rest (group 2); complete, a whole id; page, a page label with its number as group 1.
    Columns merged in a line are cut at the first accented word, fragments are joined in order. A
    row that nothing speaks against is matched with names (concept_id, name) by its folded pivot
    term, as written or without the brackets around it: EXACT if one concept has that name, else
    UNMATCHED. Ids that two blocks have are demoted. The blocks are stored once, when this is called.
    """
    t = F.col("text")
    first = lambda p, g: F.nullif(F.regexp_extract(t, p, g), F.lit(""))
    is_start = t.rlike(code)
    d = carry_forward(lines, {"page": first(page, 1).cast("int"), "section": first(heading, 1)})
    # Documents may be few and long: only numbering the blocks goes by document, what is read from lines goes by block.
    d = segment_blocks(d, is_start).filter("block > 0").repartition("doc_id", "block")
    said = first(counter, 1)
    body = F.when(is_start, F.regexp_extract(t, code, 2)).when(said.isNotNull(), F.regexp_extract(t, counter, 2)).when(t.rlike(heading) | t.rlike(page), "").otherwise(t)
    # a code that does not begin its line names another entry
    other = ~is_start & t.rlike(r"(?<!\S)" + code.lstrip("^").removeprefix(r"\s*"))
    d = d.withColumns({"prefix": F.when(is_start, first(code, 1)), "counter": F.when(~is_start, said), "body": collapse(body), "crossed": ~is_start & t.rlike(heading), "other": other})
    cut = split_at_accent("body")
    d = d.withColumn("cut", cut)
    g = d.groupBy("doc_id", "block").agg(
        F.min("line").alias("line_start"), F.max("line").alias("line_end"), F.min_by("page", "line").alias("page"), F.min_by("section", "line").alias("section"), F.max("prefix").alias("prefix"),
        F.array_sort(F.collect_set("counter")).alias("counters"), F.count("counter").alias("markers"), F.bool_or("crossed").alias("crossed"), F.bool_or("other").alias("other"),
        F.array_sort(F.collect_list(F.struct("line", "cut"))).alias("parts"))
    side = lambda s: join_fragments(F.filter(F.transform("parts", lambda p: p["cut"][s]), lambda x: x.isNotNull() & (x != "")))
    whole = F.col("prefix").rlike(complete)
    printed = F.when(whole, F.col("prefix")).when(F.size("counters") > 0, F.concat("prefix", F.get("counters", F.lit(0))))
    g = g.withColumns({"printed_id": printed, "pivot": F.trim(F.regexp_replace(side("pivot"), r"\s+\($", "")), "target": side("target")})
    reasons = F.array_compact(F.array(
        F.when(F.col("crossed"), "CROSSED_HEADING"), F.when(F.col("printed_id").isNull(), "INCOMPLETE_ID"), F.when((F.col("markers") > 1) | (F.size("counters") > 1), "MULTIPLE_COUNTERS"),
        F.when(F.col("printed_id").isNotNull() & ~F.col("printed_id").rlike(complete), "MALFORMED_ID"), F.when(F.col("other"), "EMBEDDED_ENTRY"),
        F.when(F.col("pivot") == "", "INCOMPLETE_PIVOT"), F.when(F.col("target") == "", "INCOMPLETE_TARGET"), F.when(F.col("target").rlike(residue), "PIVOT_RESIDUE_IN_TARGET")))
    g = g.withColumn("reasons", reasons).drop("parts", "counters", "markers", "crossed", "other", "prefix")
    # Names, duplicate ids and the rows themselves are all read from the blocks, which are made once.
    at, shape = shared_path(lines.sparkSession, "blocks"), g.schema
    g.write.parquet(at)
    g = lines.sparkSession.read.schema(shape).parquet(at)
    row, bare = F.struct("doc_id", "block"), F.trim(F.regexp_replace("pivot", r"^[(\[]+|[)\]]+$", ""))
    tries = g.filter(F.size("reasons") == 0).select(row.alias("row_id"), F.explode(F.array_distinct(F.array(fold_key("pivot"), fold_key(bare)))).alias("key")).withColumn("tier", F.lit(1))
    one = unique_match(tries, names.select("concept_id", fold_key("name").alias("key")).filter("key <> ''")).filter("outcome = 'ONE'").select("row_id.doc_id", "row_id.block", "concept_id")
    g = g.join(one, ["doc_id", "block"], "left")
    lost = (F.size("reasons") == 0) & F.col("concept_id").isNull()
    g = g.withColumn("status", F.when(F.size("reasons") > 0, "INTEGRITY_REVIEW").when(lost, "UNMATCHED").otherwise("EXACT")).withColumn("reasons", F.when(lost, F.array(F.lit("UNMATCHED"))).otherwise(F.col("reasons")))
    g = demote_duplicates(g, "printed_id", to="INTEGRITY_REVIEW")
    return g.select("doc_id", "block", "printed_id", "page", "section", "line_start", "line_end", "pivot", "target", "concept_id", "status", "reasons")


def extract_coded(lines: DataFrame, code: str, marker: str, page: str = r"^=== PDF_PAGE (\d+) ===$", external: str = r"(?<!\d)(\d{6,18})(?!\d)") -> DataFrame:
    """Blocks of coded text: (doc_id, code, page, target, external_id, pivot, reject).

    The first long number is the external id; before it stands the target term, behind it, up to and
    with the marker, the pivot term. reject says why a block gives no row.
    """
    t = F.trim("text")
    d = carry_forward(lines.withColumn("text", t), {"page": F.nullif(F.regexp_extract("text", page, 1), F.lit("")).cast("int")})
    d = segment_blocks(d.filter(~F.col("text").rlike(page)), F.col("text").rlike(code)).filter("block > 0")
    g = d.groupBy("doc_id", "block").agg(F.min_by("page", "line").alias("page"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), " ").alias("raw"))
    raw = collapse("raw")
    g = g.withColumn("code", F.substring_index(raw, " ", 1)).withColumn("rest", F.trim(F.expr("substring(trim(raw), length(code) + 1)")))
    g = g.withColumn("external_id", F.nullif(F.regexp_extract("rest", external, 1), F.lit("")))
    at, end = F.instr(F.col("rest"), F.col("external_id")), F.instr(F.lower("rest"), F.lit(marker.lower()))
    g = g.withColumns({"at": at, "end": end})
    target = collapse(F.expr("substring(rest, 1, at - 1)"))
    pivot = collapse(F.expr(f"substring(rest, at + length(external_id), end + {len(marker)} - at - length(external_id))"))
    g = g.withColumns({"target": target, "pivot": pivot})
    reject = F.when(F.col("external_id").isNull(), "MISSING_EXTERNAL_ID").when(F.col("end") == 0, "MISSING_SCOPE_MARKER").when((F.col("target") == "") | (F.col("pivot") == ""), "EMPTY_FIELD")
    ok = F.col("reject").isNull()
    g = g.withColumn("reject", reject)
    return g.select("doc_id", "code", "page", *[F.when(ok, F.col(c)).alias(c) for c in ("target", "external_id", "pivot")], "reject")


def rebuild_table(words: DataFrame, columns: Sequence[tuple[float, str]], tolerance: float = 1.5, gap: float = 0.7, largest: int | None = None) -> DataFrame:
    """Table rows of positioned words (doc_id, page, x0, x1, top, text): doc_id, page, entry_id, cells (map of column to text).

    columns: (right bound, name); words of the column "number" number the rows. A line takes the
    words within the tolerance of its first word's top. Words further from the one before them than that open
    a run, so lines are told run by run. All of it goes by page, in one shuffle. largest: the greatest
    number that numbers a row, if there is one.
    """
    bounds = [(float(b), n) for b, n in columns]
    name = None
    for bound, n in bounds:
        name = F.when(F.col("x0") < bound, n) if name is None else name.when(F.col("x0") < bound, n)
    nan, top = F.lit(float("nan")), F.col("top")
    d = words.select("doc_id", F.col("page").cast("int").alias("page"), "text", *[F.coalesce(F.col(c).cast("double"), nan).alias(c) for c in ("x0", "x1", "top")]).withColumn("column", name.otherwise("other"))
    d = d.withColumn("number", F.when((F.col("column") == "number") & F.col("text").rlike(r"^\d{1,9}$"), F.col("text").cast("int")))
    page, run = Window.partitionBy("doc_id", "page"), Window.partitionBy("doc_id", "page", "run")
    # An unknown top (NaN) comes last and belongs to the last line.
    far = F.coalesce(~F.isnan(top) & (top - F.lag("top").over(page.orderBy("top")) > tolerance), F.lit(False))
    d = d.withColumn("far", far.cast("long")).withColumn("run", F.sum("far").over(page.orderBy("top").rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    # A run within the tolerance, as most are, is one line; in others a line opens where a word is too far from the first of the line before.
    d = d.withColumn("first", F.min("top").over(run))
    d = d.withColumn("late", F.collect_set(F.when(~F.isnan(top) & (top - F.col("first") > tolerance), top)).over(run))
    opens = F.aggregate(F.array_sort("late"), F.array("first"), lambda a, x: F.when(x - F.element_at(a, -1) > tolerance, F.concat(a, F.array(x))).otherwise(a))
    d = d.withColumn("line", F.when(F.size("late") == 0, 1).otherwise(F.size(F.filter(opens, lambda x: x <= top)))).drop("late", "first", "far")
    of_line = page.orderBy("run", "line")
    same, so_far = of_line.rangeBetween(Window.currentRow, Window.currentRow), of_line.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("number").isNotNull() & (F.count("number").over(same) == 1) & (F.col("number") >= 1) & (F.lit(True) if largest is None else F.col("number") <= largest)
    d = d.withColumn("start", F.when(start, F.col("number")))
    d = d.withColumns({"block": F.count("start").over(so_far), "entry_id": F.last("start", ignorenulls=True).over(so_far)}).filter("block > 0 and column <> 'number'")
    rows = d.groupBy("doc_id", "page", "block", "entry_id").agg(F.collect_list(F.struct("run", "line", "x0", "x1", "text", "column")).alias("w"))

    def put(a, v):
        more = (a["run"] == v["run"]) & (a["line"] == v["line"])
        glued = F.concat(a["now"], F.when(v["x0"] - a["x"] <= gap, "").otherwise(" "), v["text"])
        done = F.when(more | a["run"].isNull(), a["done"]).otherwise(F.concat_ws(" ", a["done"], a["now"]))
        return F.struct(done.alias("done"), F.when(more, glued).otherwise(v["text"]).alias("now"), v["x1"].alias("x"), v["run"].alias("run"), v["line"].alias("line"))

    # Words of a line and column, joined by their gaps; then the lines of a row.
    of = lambda n: F.filter("w", lambda x: x["column"] == n)
    empty = F.struct(*[F.lit(None).cast(t).alias(c) for c, t in (("done", "string"), ("now", "string"), ("x", "double"), ("run", "long"), ("line", "int"))])
    text = lambda w: F.aggregate(F.array_sort(w), empty, put, lambda a: F.concat_ws(" ", a["done"], a["now"]))
    clean = lambda s: F.regexp_replace(collapse(F.regexp_replace(s, r"(?<!\w)Endnote\s+\d+(?!\w)", "")), r"^[ ;]+|[ ;]+$", "")
    names = sorted({n for _, n in bounds if n != "number"} | {"other"})
    rows = rows.select("doc_id", "page", "entry_id", *[of(n).alias(f"w{i}") for i, n in enumerate(names)])
    held = F.array_compact(F.array(*[F.when(F.size(f"w{i}") > 0, F.struct(F.lit(n).alias("column"), clean(text(f"w{i}")).alias("s"))) for i, n in enumerate(names)]))
    return rows.select("doc_id", "page", "entry_id", F.map_from_entries(held).alias("cells"))


def parse_errata(lines: DataFrame, actions: Sequence[tuple[str, str]], version: str = r"version (\d+\.\d+)", part: str = r"^\s*PART\s+([IVX]+)\s*$", entry: str = r"^\s*(\d{1,4})\s+") -> DataFrame:
    """(entry_id, versions, parts, actions) from errata lines (doc_id, line, text): version and part carried forward, actions by pattern."""
    t = F.col("text")
    got = lambda p: F.nullif(F.regexp_extract(t, p, 1), F.lit(""))
    d = carry_forward(lines, {"version": got(version), "part": got(part)})
    is_entry = t.rlike(entry) & ~t.rlike(r"^\s*Endnote") & F.col("version").isNotNull() & F.col("part").isNotNull()
    closes = t.rlike(version) | t.rlike(part)
    d = segment_blocks(d, is_entry | closes)
    d = d.withColumns({"entry_id": F.when(is_entry, got(entry)), "tags": F.array_compact(F.array(*[F.when(t.rlike("(?i)" + p), F.lit(n)) for p, n in actions]))})
    g = d.groupBy("doc_id", "block").agg(F.max("entry_id").alias("entry_id"), F.min_by("version", "line").alias("version"), F.min_by("part", "line").alias("part"), F.array_distinct(F.flatten(F.collect_list("tags"))).alias("tags")).filter("entry_id is not null")
    return g.groupBy("entry_id").agg(F.array_sort(F.collect_set("version")).alias("versions"), F.array_sort(F.collect_set("part")).alias("parts"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags")))).alias("actions"))


def annotate_errata(records: DataFrame, errata: DataFrame) -> DataFrame:
    note = F.when(F.col("versions").isNotNull(), F.concat_ws("; ", F.concat(F.lit("errata="), F.array_join("versions", ",")), F.concat(F.lit("actions="), F.when(F.size("actions") > 0, F.array_join("actions", ",")).otherwise("record"))))
    return records.join(errata, "entry_id", "left").withColumn("errata_note", note).drop("versions", "parts", "actions")


def to_attestations(rows: DataFrame, source_id: str, revision: str, preferred_a: str, preferred_b: str, synonyms: str) -> DataFrame:
    """Attestations of rebuilt rows (pivot spellings a, b, synonyms, target): spelling a else b is preferred, the other an alias; whole-row duplicates go.

    status: PARENTHESISED if the preferred term or an alias stands in brackets, which marks it in its source.
    """
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    best = F.coalesce(blank(preferred_a), blank(preferred_b))
    aliases = F.array_remove(F.array_union(F.array_compact(F.array(blank(preferred_a), blank(preferred_b))), split_synonyms(synonyms, best)), best)
    out = rows.withColumns({"source_id": F.lit(source_id), "source_revision": F.lit(revision), "pivot": F.struct(best.alias("preferred"), aliases.alias("aliases")), "source_term_raw": best})
    marked = lambda t: F.coalesce(t.startswith("(") & t.endswith(")"), F.lit(False))
    out = out.withColumn("status", F.when(marked(best) | F.exists(aliases, marked), "PARENTHESISED"))
    return out.dropDuplicates()


def retention(prior: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """prior rows with RETAINED if a current row has the same keys, else QUARANTINED."""
    k = current.select(*keys).distinct().withColumn("_kept", F.lit(True))
    return prior.join(k, list(keys), "left").withColumn("retention", F.when(F.col("_kept"), "RETAINED").otherwise("QUARANTINED")).drop("_kept")


def contiguity(ids: DataFrame, key: str, skip: Sequence[int] = ()) -> DataFrame:
    """Missing ids between the least and the greatest, by ranges of gaps: (after, before, missing).

    Neighbours are compared inside ranges of ids; each range brings its least and greatest, and these
    few ends are compared once more, so no task sees all ids.
    """
    d = ids.select(F.col(key).cast("long").alias("k")).filter("k is not null").distinct().repartitionByRange("k").withColumn("p", F.spark_partition_id())
    inner = d.withColumn("next", F.lead("k").over(Window.partitionBy("p").orderBy("k")))
    ends = d.groupBy("p").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    across = ends.withColumn("next", F.lead("lo").over(Window.orderBy("lo"))).select(F.col("hi").alias("k"), "next")
    gaps = inner.select("k", "next").union(across).filter("next - k > 1")
    skipped = F.size(F.filter(F.array(*[F.lit(int(s)) for s in skip]).cast("array<bigint>"), lambda s: (s > F.col("k")) & (s < F.col("next"))))
    return gaps.select(F.col("k").alias("after"), F.col("next").alias("before"), (F.col("next") - F.col("k") - 1 - skipped).alias("missing")).filter("missing > 0")
