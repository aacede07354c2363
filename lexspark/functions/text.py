"""Matching keys and scalar text functions: Columns in, Columns out.

Keys serve matching only; raw wording is never replaced. White space is Unicode's, and word edges
are explicit look-arounds on letters, marks and digits, so accented text behaves like any other.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"(?U)[\s﻿]+"
DASHES = "[‐-―−]"
EDGE = r"(?<![\p{L}\p{M}\p{N}])", r"(?![\p{L}\p{M}\p{N}])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(c: Column | str) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), SPACE, " "))


@cache
def _fold_table() -> tuple[str, str]:
    """Characters that decompose to one base and marks, and their bases; and the two barred d's, which do not."""
    pairs = {"đ": "d", "Đ": "D"}
    for code in [*range(0xC0, 0xD800), *range(0xE000, 0x10000)]:
        parts = unicodedata.normalize("NFD", chr(code))
        if parts != chr(code) and all("̀" <= x <= "ͯ" for x in parts[1:]):
            pairs[chr(code)] = parts[0]
    return "".join(pairs), "".join(pairs.values())


def fold_key(c: Column | str) -> Column:
    """Accents and case folded, white space collapsed. Native."""
    bare = F.regexp_replace(F.translate(_col(c), *_fold_table()), "[̀-ͯ]", "")
    return collapse(F.lower(bare))


def normalised(c: Column | str, form: str) -> Column:
    """A Unicode normal form. ASCII passes natively; of all strings only the others are sent to an Arrow function."""

    @F.pandas_udf("string")
    def apply(s):
        import unicodedata

        return s.map(lambda x: None if x is None else unicodedata.normalize(form, x))

    c = _col(c)
    ascii_only = c.rlike(r"^\p{ASCII}*$")
    return F.when(ascii_only, c).otherwise(apply(F.when(~ascii_only, c)))


def exact_key(c: Column | str) -> Column:
    return collapse(F.lower(normalised(c, "NFKC")))


def unify_marks(c: Column) -> Column:
    """One hyphen and one quote of each kind."""
    c = F.regexp_replace(c, DASHES, "-")
    return F.regexp_replace(F.regexp_replace(c, "[‘’‛]", "'"), "[“”‟]", '"')


def scope_safe_key(c: Column | str) -> Column:
    """exact_key with one kind of dash and quote; no word is dropped."""
    return unify_marks(exact_key(c))


def agreement_key(c: Column | str) -> Column:
    """Case and accents kept; dashes unified, no spaces round hyphens."""
    return collapse(F.regexp_replace(F.regexp_replace(normalised(c, "NFC"), DASHES, "-"), r"(?U)\s*-\s*", "-"))


def surface_key(c: Column | str) -> Column:
    return collapse(F.regexp_replace(F.lower(agreement_key(c)), r"[-,.;:()\[\]/]+", " "))


def pivot_key(c: Column | str) -> Column:
    return collapse(F.regexp_replace(F.lower(_col(c)), r"[()\[\],.;:/‐-―-]+", " "))


def clean_target(c: Column | str) -> Column:
    """White space collapsed, none before closing punctuation."""
    return F.regexp_replace(collapse(c), r" ([,.;:)])", "$1")


def match_key_pair(c: Column | str) -> Column:
    """Two keys of a name: punctuation set tight, and brackets left out."""
    k = exact_key(c)
    tight = F.regexp_replace(F.regexp_replace(k, r" *([,;:]) *", "$1 "), r"\( *(.*?) *\)", "($1)")
    return F.array_distinct(F.array(collapse(tight), collapse(F.regexp_replace(tight, r"\([^)]*\)", " "))))


def strip_wrapper(c: Column | str, pattern: str, replacement: str = "$1") -> Column:
    """struct(value, changed): a generic wrapper phrase taken off."""
    value = F.trim(F.regexp_replace(_col(c), pattern, replacement))
    return F.struct(value.alias("value"), (value != F.trim(_col(c))).alias("changed"))


def tokens(c: Column | str) -> Column:
    """Words of a key, brackets and separators aside."""
    return F.filter(F.split(F.regexp_replace(_col(c), r"[()\[\],;:]", " "), SPACE), lambda x: x != "")


def word_pattern(words: Sequence[str]) -> str:
    return EDGE[0] + "(?:" + "|".join(words) + ")" + EDGE[1]


def padded(c: Column | str) -> Column:
    """The words of a key with one space round each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(_col(c), r"[^\p{L}\p{M}\p{N}]+", " ")), F.lit(" "))


def has_phrase(c: Column | str, phrase: Column | str) -> Column:
    """Whether the phrase stands in the text between word edges. Both are keys."""
    return F.contains(padded(c), padded(phrase))


def tag_signals(values: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Distinct tags of the strings in an array: string by string, rule by rule, first occurrence kept. rules: (tag, pattern)."""
    per = F.transform(values, lambda v: F.array_compact(F.array(*[F.when(v.rlike(p), F.lit(t)) for t, p in rules])))
    return F.array_distinct(F.flatten(F.filter(per, lambda x: x.isNotNull())))


def first_with_prefix(tags: Column | str, prefix: str) -> Column:
    found = F.filter(_col(tags), lambda t: t.startswith(prefix + ":"))
    return F.substring_index(F.get(found, F.lit(0)), ":", -1)


def first_of(tags: Column | str, prefix: str, priority: Sequence[str]) -> Column:
    """The first of the priorities that is among the tags."""
    order = F.array(*[F.lit(f"{prefix}:{p}") for p in priority])
    return F.substring_index(F.get(F.array_intersect(order, _col(tags)), F.lit(0)), ":", -1)


def first_rule(c: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Name of the first pattern that matches. rules: (name, pattern)."""
    out = None
    for name, pattern in rules:
        out = F.when(_col(c).rlike(pattern), name) if out is None else out.when(_col(c).rlike(pattern), name)
    return F.lit(default) if out is None else out.otherwise(default)


def side(c: Column | str, sides: Sequence[str], default: str = "unsided") -> Column:
    """The one side word in the text; the default if there is none or more than one kind."""
    found = F.array_intersect(tokens(c), F.array(*[F.lit(s) for s in sides]))
    return F.when(F.size(found) == 1, found[0]).otherwise(default)


def laterality_of(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], both: str = "bilateral", default: str = "unsided") -> Column:
    """Side of a text by rules (side, words): the one side found; several, or one of them `both`, are both."""
    key = fold_key(c)
    found = F.array_compact(F.array(*[F.when(key.rlike(word_pattern(words)), F.lit(side)) for side, words in rules]))
    return F.when(F.size(found) == 0, default).when((F.size(found) > 1) | F.array_contains(found, both), both).otherwise(F.get(found, F.lit(0)))


def id_hint(c: Column | str, pattern: str) -> Column:
    """The first group of a pattern in a note; null without one."""
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def id_prefix(c: Column | str, separator: str = ".") -> Column:
    return F.substring_index(_col(c), separator, 1)


def is_placeholder(c: Column | str, words: Sequence[str] = ("todo", "tbd", "placeholder", "unknown", "n/a")) -> Column:
    """Whether a field is filled with a stand-in; the words are the caller's to choose."""
    return F.coalesce(F.lower(F.trim(_col(c))).isin(list(words)), F.lit(False))


def base_name(c: Column | str, words: Sequence[str]) -> Column:
    """The folded name without these words."""
    return collapse(F.regexp_replace(fold_key(c), word_pattern(words), ""))


def multiset_diff(a: Column | str, b: Column | str) -> Column:
    """Elements of a less those of b, each once for each time it stands there; order kept."""

    def drop(left, x):
        at = F.array_position(left, x)
        rest = F.concat(F.slice(left, F.lit(1), (at - 1).cast("int")), F.slice(left, (at + 1).cast("int"), F.size(left)))
        return F.when(at > 0, rest).otherwise(left)

    return F.aggregate(_col(b), _col(a), drop)


def extra_scope_words(source: Column | str, target: Column | str, scope: Sequence[str]) -> Column:
    """Scope words of the source that the target's words do not cover, as multisets."""
    extra = multiset_diff(tokens(source), tokens(target))
    return F.array_distinct(F.filter(extra, lambda x: x.isin(list(scope))))


def alias_variants(c: Column | str, prefix: str, suffix: str) -> Column:
    """Ordered (tier, value): the string, less a suffix, less a prefix, less both; empty and repeated ones dropped."""
    base = collapse(c)
    forms = [base, F.regexp_replace(base, suffix, ""), F.regexp_replace(base, prefix, ""), F.regexp_replace(F.regexp_replace(base, suffix, ""), prefix, "")]
    values = F.array_distinct(F.filter(F.array(*[F.trim(f) for f in forms]), lambda x: x != ""))
    return F.transform(values, lambda v, i: F.struct((i + 1).alias("tier"), v.alias("value")))


def terms(preferred: Column | str, aliases: Column | str) -> Column:
    """Preferred term and aliases, blank ones left out."""
    all_ = F.concat(F.array(_col(preferred)), F.coalesce(_col(aliases), F.array().cast("array<string>")))
    return F.filter(all_, lambda x: x.isNotNull() & (F.trim(x) != ""))


def split_synonyms(c: Column | str, preferred: Column | str) -> Column:
    """Synonyms written one behind another with semicolons, without the preferred term."""
    parts = F.transform(F.split(F.coalesce(_col(c), F.lit("")), ";"), lambda x: collapse(x))
    return F.array_remove(F.array_remove(F.array_distinct(parts), ""), F.coalesce(_col(preferred), F.lit("")))


def protected(c: Column | str, words: Sequence[str]) -> Column:
    low = F.lower(_col(c))
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w))


def split_at_accent(c: Column | str) -> Column:
    """struct(pivot, target): a merged line, cut before the word that holds the first accented letter."""
    pattern = "^(.*?)(\\S*[À-ỹ].*)$"
    c = collapse(c)
    cut = F.regexp_extract(c, pattern, 2)
    return F.struct(F.when(cut == "", c).otherwise(F.trim(F.regexp_extract(c, pattern, 1))).alias("pivot"), F.nullif(F.trim(cut), F.lit("")).alias("target"))


def join_fragments(parts: Column | str) -> Column:
    """Fragments joined by spaces, but directly behind a trailing hyphen; punctuation tidied."""
    joined = F.aggregate(_col(parts), F.lit(""), lambda a, x: F.when(a == "", x).when(a.endswith("-"), F.concat(a, x)).otherwise(F.concat(a, F.lit(" "), x)))
    return clean_target(joined)


def content_hash(*cols: Column | str) -> Column:
    """SHA-256 of the named columns in alphabetical order; null and missing are the same."""
    named = sorted(cols, key=str)
    return F.sha2(F.to_json(F.struct(*named), {"ignoreNullFields": "true"}), 256)


def canonical_map(c: Column | str) -> Column:
    return F.array_sort(F.map_entries(_col(c)))


def canonical_digest(df: DataFrame) -> DataFrame:
    """One row: rows, and a digest of the table that their order does not change.

    Row hashes are added up as numbers, so tasks combine their parts and nothing is gathered.
    """
    h = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    part = lambda k: F.sum(F.conv(F.substring(h, 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)"))
    return df.agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), *[F.coalesce(part(k), F.lit(0)).cast("string") for k in range(5)]), 256).alias("digest"))


def contains_any(c: Column | str, words: Sequence[str]) -> Column:
    """Whether the folded string holds one of the folded words, anywhere in it; null holds none."""
    folded = fold_key(c)
    return F.coalesce(F.exists(F.array(*[fold_key(F.lit(w)) for w in words]), lambda w: folded.contains(w)), F.lit(False))


def is_iso_date(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(r"^\d{4}-\d{2}-\d{2}\z") & _col(c).try_cast("date").isNotNull(), F.lit(False))


def is_url(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(r"^https?://[^\s/]+"), F.lit(False))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(F.trim(_col(c)) == "", F.lit(True))


def locator_supported(capability: Column | str, locator: Column | str, section_for_page: Column | None = None) -> Column:
    """Whether a locator struct has what the source's kind of locator asks for."""
    k, at = _col(capability), _col(locator)
    page = (at["page"] > 0) | ((section_for_page if section_for_page is not None else F.lit(False)) & ~is_blank(at["section"]))
    said = lambda *fields: reduce(lambda x, y: x | y, [~is_blank(at[f]) for f in fields])
    ok = (
        F.when(k == "PAGE", page).when(k == "PLATE", said("plate", "table")).when(k == "CHAPTER_SECTION", said("chapter", "section"))
        .when(k.isin("TERM_ID", "STABLE_ENTRY"), said("entry_id", "nomenclature_id"))
    )
    return F.coalesce(ok, F.lit(False))


def exact_locator(locator: Column | str) -> Column:
    at = _col(locator)
    named = [~is_blank(at[f]) for f in ("plate", "chapter", "section", "table", "entry_id", "nomenclature_id")]
    return reduce(lambda x, y: x | y, named, F.coalesce(at["page"] > 0, F.lit(False)))


def citation(institution: Column | str, authors: Column | str, title: Column | str, year: Column | str) -> Column:
    """Institution, else first author (with et al. for more), else title; with the year."""
    a = F.filter(F.coalesce(_col(authors), F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    who = F.when(F.size(a) > 1, F.concat(F.trim(a[0]), F.lit(" et al."))).when(F.size(a) == 1, F.trim(F.get(a, F.lit(0))))
    name = F.coalesce(F.nullif(F.trim(_col(institution)), F.lit("")), who, _col(title))
    return F.when(_col(year).isNotNull(), F.concat(name, F.lit(" ("), _col(year).cast("string"), F.lit(")"))).otherwise(name)


def source_of_reference(c: Column | str) -> Column:
    return F.substring_index(_col(c), ":", 1)


