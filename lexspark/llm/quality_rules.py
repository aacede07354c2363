"""Operator 1: quality rules as a short-circuit cascade, in native column expressions only.

The rules form one CASE WHEN chain, which Spark evaluates lazily, row by row: a document rejected by
an early rule never pays for a later one. `apply_quality_rules`, which needs verdicts alone, has the
two base rules in the chain too, so that a document with too few words or one that a cheap rule
rejects never pays for its windows of words; `op1_quality_rules` returns the base statistics of
every row and so has them first.

The order comes from a bounded sample. A rule's cost is the time that it takes over the sample beyond
that of a pass with no rule, the less of two runs; its selectivity is what it rejects of the documents
that the rules before it leave, so the order is chosen rule by rule: most rejections per second
first. The order changes the cost, never the verdict.

Defined results: a null or blank text has no words and fails the base rule; null doc_id and
repeated rows are judged row by row; an empty table gives an empty table; other columns of the
input, whatever their names, are passed through by `apply_quality_rules` untouched.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import SPACES, WORD_CHAR, words_of

#: Expected rows of the sample that orders the rules.
SAMPLE_ROWS = 2000
#: Times that each sampled row is evaluated in one run, so that a rule's time stands out of the job's.
REPEATS = 2
WINDOW = 8
STAT = "_quality_"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """reject: a boolean Column over the text and the base statistics; true rejects the document."""

    name: str
    reject: Column


def _stat(name: str) -> Column:
    return F.col(STAT + name)


def default_rules() -> list[Rule]:
    """Rules beyond the base one. Thresholds are shares of words, of lines or of characters."""
    text = F.coalesce(F.col(STAT + "text"), F.lit(""))
    n = _stat("n_words")
    hashes = F.col(STAT + "hashes")
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return [
        Rule("symbols", _stat("n_symbols") * 10 > n),
        Rule("word_length", (_stat("word_chars") < 2 * n) | (_stat("word_chars") > 15 * n)),
        Rule("duplicate_lines", _stat("n_dup_lines") * 2 > _stat("n_lines")),
        Rule("exclamation", F.length(text) - F.length(F.regexp_replace(text, "!", "")) > 0.3 * n),
        Rule("shouting", F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")) > 0.5 * letters),
        Rule("letters", 2 * letters < _stat("word_chars")),
        Rule("stutter", F.size(F.filter(hashes, lambda h, i: (i > 0) & (h == F.get(hashes, i - 1)))) * 5 > n),
    ]


def _with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the statistics that one pass over the words, lines and characters gives, under prefixed names."""
    p = STAT
    df = docs.withColumn(p + "text", F.coalesce(F.col(text), F.lit("")))
    t = F.col(p + "text")
    df = df.withColumn(p + "words", words_of(t))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHAR))
    df = df.withColumns({
        p + "n_words": F.size(p + "words").cast("long"),
        p + "word_chars": F.length(F.regexp_replace(t, SPACES, "")).cast("long"),
        p + "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long"),
        p + "lines": lines,
        p + "hashes": F.transform(p + "words", lambda w: F.xxhash64(w)),
    })
    return df.withColumns({
        p + "n_lines": F.size(p + "lines").cast("long"),
        p + "n_dup_lines": (F.size(p + "lines") - F.size(F.array_distinct(p + "lines"))).cast("long"),
    })


def _let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def repeated_words(hashes: Column) -> Column:
    """Words in 8-word windows that stand twice or more in the text.

    Found inside the row: 64-bit hashes of all windows, then, only if two of them are equal, a sort
    of (hash, position).
    """
    n = F.size(hashes)
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    def covered(s: Column) -> Column:
        near = lambda j: F.get(s, j)["k"]
        again = F.filter(s, lambda x, j: x["k"].eqNullSafe(near(j - 1)) | x["k"].eqNullSafe(near(j + 1)))
        return F.aggregate(
            F.array_sort(F.transform(again, lambda x: x["i"])),
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    def found(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) < F.size(w), _let(placed, covered)).otherwise(0)

    return F.when(n > WINDOW, _let(windows, found)).otherwise(0).cast("long")


def _here() -> Column:
    """True. Spark pushes filters through projections by copying the expressions they refer to, here into the
    bodies of lambdas; it does not do so through a projection that holds a value bound to the row's place."""
    return F.monotonically_increasing_id() >= 0


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base statistics under prefixed names. No row leaves its partition."""
    return _with_counts(docs, text).withColumn(STAT + "n_repeat_words", F.when(_here(), repeated_words(F.col(STAT + "hashes"))))


def base_rules() -> list[Rule]:
    """The base rules as links of the chain; the second computes its statistic when it is reached."""
    return [Rule("few_words", _stat("n_words") < 20), Rule("repeated_words", 100 * repeated_words(F.col(STAT + "hashes")) > 30 * _stat("n_words"))]


def base_failed() -> Column:
    return (_stat("n_words") < 20) | (100 * _stat("n_repeat_words") > 30 * _stat("n_words"))


def _ordered(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by rejections per second on a stored sample, each among the rows that those before it leave."""
    again = sample.withColumn(STAT + "again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def seconds(reject: Column) -> float:
        took = []
        for _ in range(2):
            began = time.perf_counter()
            again.agg(F.count_if(reject)).collect()
            took.append(time.perf_counter() - began)
        return min(took)

    idle = seconds(_stat("n_words") < 0)
    cost = [max(seconds(rule.reject) - idle, 1e-3) for rule in rules]
    hits = F.concat(*[F.when(rule.reject, "1").otherwise("0") for rule in rules])
    # At most as many patterns as sampled rows.
    left, order = [(r["hits"], r["count"]) for r in sample.groupBy(hits.alias("hits")).count().collect()], []
    while len(order) < len(rules):
        rejects = {k: sum(n for h, n in left if h[k] == "1") for k in range(len(rules)) if k not in order}
        best = min(rejects, key=lambda k: (-rejects[k] / cost[k], cost[k], k))
        order.append(best)
        left = [(h, n) for h, n in left if h[best] != "1"]
    return [rules[k] for k in order]


def _sample(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """About `rows` documents: a seeded Bernoulli sample of the whole table, in a few tasks."""
    total = docs.count()
    return docs.select(F.col(f"`{text}`").alias("text")).sample(fraction=min(1.0, rows / max(1, total)), seed=7).repartition(4)


def order_rules(docs: DataFrame, rules: list[Rule], text: str = "text", rows: int = SAMPLE_ROWS, base_first: bool = True) -> list[Rule]:
    """Rules by rejections per second on a sample, which executors hold while the rules are timed.

    base_first: the rules come behind the base ones, so they are judged by the documents these leave.
    Sampling reads the text column once more, a few hundredths of the rules' cost.
    """
    if not rules:
        return []
    sample = _sample(docs, text, rows)
    sample = (with_statistics(sample).filter(~base_failed()) if base_first else _with_counts(sample)).persist()
    try:
        return _ordered(sample, rules) if sample.count() else list(rules)
    finally:
        sample.unpersist()


def _chain(rules: list[Rule]) -> Column:
    """True for rows that no rule rejects; a rule is evaluated only on rows that those before it leave."""
    chain = None
    for rule in rules:
        chain = F.when(rule.reject, False) if chain is None else chain.when(rule.reject, False)
    return F.lit(True) if chain is None else chain.otherwise(True)


def apply_quality_rules(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """The documents that pass the base rules and these, with exactly the columns they came with."""
    rules = order_rules(docs, base_rules() + (default_rules() if rules is None else rules), text, base_first=False)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(STAT + "row"), F.col(f"`{text}`").alias("text"))
    kept = _with_counts(whole).withColumn(STAT + "kept", F.when(_here(), _chain(rules))).filter(STAT + "kept")
    return kept.select(*[F.col(STAT + "row").getField(c).alias(c) for c in docs.columns])


def op1_quality_rules(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    verdict = F.when(base_failed(), False).otherwise(_chain(order_rules(docs, default_rules())))
    df = with_statistics(docs).withColumns({STAT + "base_failed": base_failed(), STAT + "kept": verdict})
    return df.select("doc_id", *[_stat(c).alias(c) for c in STATS], _stat("base_failed").alias("base_failed"), _stat("kept").alias("kept"))


#: The same in DuckDB.
OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, array_to_string(words[i:i + 7], chr(1)) AS k
      FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 7)) AS i FROM w WHERE len(words) >= 8)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + j) AS n FROM r, (SELECT unnest(generate_series(0, 7)) AS j) GROUP BY rid),
s AS (SELECT w.rid, doc_id, text, words, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
             len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
             len(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters
      FROM w LEFT JOIN c ON w.rid = c.rid),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR n_dup_lines * 2 > n_lines OR len(text) - len(replace(text, '!', '')) > 0.3 * n_words
            OR len(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > 0.5 * letters OR 2 * letters < word_chars
            OR 5 * len(list_filter(list_zip(words[2:], words[:-2]), lambda x: x[1] = x[2])) > n_words) AS kept
FROM b
"""
