import re
from collections import Counter

import pytest

from lexspark.llm.quality_rules import Rule, apply_quality_rules, op1_quality_rules, order_rules
from pyspark.sql import functions as F

CLEAN = " ".join(f"word{i} there" + chr(97 + i) for i in range(20)) + "."


def brute(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \t\n ", "one", CLEAN, CLEAN + "\n" + CLEAN, "a b c d e f g h " * 3, "x " * 100, "### $$$ " * 30, "SHOUT!! " * 40, "  éé ß\n" * 9, "w " * 30_000, CLEAN + " a b c d e f g h i a b c d e f g h"]


def test_statistics_match_brute_force(documents):
    rows = op1_quality_rules(documents(list(enumerate(TEXTS)))).collect()
    for r in rows:
        n, chars, symbols, lines, repeats = brute(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats), r.doc_id
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in rows if r.kept}
    assert TEXTS.index(CLEAN) in kept and 8 not in kept and 9 not in kept


def test_rows_are_judged_one_by_one(documents):
    d = documents([(1, CLEAN), (1, CLEAN), (None, CLEAN), (2, None)])
    out = apply_quality_rules(d)
    assert out.columns == d.columns and sorted(r.doc_id or -1 for r in out.collect()) == [-1, 1, 1]


def test_empty_table(documents):
    assert op1_quality_rules(documents([])).collect() == []


def test_order_changes_the_cost_only(documents):
    d = documents([(i, CLEAN if i % 2 else "### " + CLEAN.replace(" ", " # ")) for i in range(20)])
    never = Rule("never", F.lit(False))
    often = Rule("often", F.col("_quality_n_symbols") > 0)
    assert order_rules(d, [never, often])[0].name == "often"
    assert {r.doc_id for r in apply_quality_rules(d, [never, often]).collect()} == {r.doc_id for r in apply_quality_rules(d, [often, never]).collect()}


@pytest.mark.parametrize("rows", [[], [(1, CLEAN)]])
def test_no_rules(documents, rows):
    assert apply_quality_rules(documents(rows), []).count() == len(rows)


def test_order_is_by_what_earlier_rules_leave(documents):
    d = documents([(i, CLEAN + (" #" if i % 2 else " ") * 9 + (" %" if i % 4 == 1 else "")) for i in range(40)])
    symbols = lambda n: F.col("_quality_n_symbols") >= n
    names = [r.name for r in order_rules(d, [Rule("some", symbols(10)), Rule("none", F.lit(False)), Rule("all", symbols(9))])]
    assert set(names) == {"all", "some", "none"} and names.index("all") < names.index("none")


def test_chain_with_base_rules_gives_the_verdict_of_the_query(spark, documents):
    d = documents(list(enumerate(TEXTS)))
    kept = {r.doc_id for r in op1_quality_rules(d).collect() if r.kept}
    assert {r.doc_id for r in apply_quality_rules(d).collect()} == kept
    clash = spark.createDataFrame([(1, CLEAN, "mine", {"a": 1})], "doc_id long, text string, _quality_words string, _quality_row map<string,int>")
    assert apply_quality_rules(clash).collect() == clash.collect()
