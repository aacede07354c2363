import pytest
from pyspark.sql import functions as F

from lexspark.functions import text as T


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def strings(spark, column, *xs):
    return values(spark, column, [(x,) for x in xs])


def test_fold_key(spark):
    assert strings(spark, T.fold_key("x"), "  Đặng   CỘNG  ", "BẠN\n bè", "Đặng", "a ﻿b", "", None) == ["dang cong", "ban be", "dang", "a b", "", None]


def test_keys_keep_what_they_promise(spark):
    assert strings(spark, T.exact_key("x"), " Ａ Bé ", "ﬁne", None) == ["a bé", "fine", None]
    assert strings(spark, T.scope_safe_key("x"), "Left – “part”") == ['left - "part"']
    assert strings(spark, T.agreement_key("x"), "Cơ – Đùi", "Cơ đùi") == ["Cơ-Đùi", "Cơ đùi"]
    assert strings(spark, T.surface_key("x"), "Cơ-đùi, (Trái)") == ["cơ đùi trái"]
    assert strings(spark, T.pivot_key("x"), "Head (of) the-X") == ["head of the x"]
    assert strings(spark, T.clean_target("x"), " a  b , c ; d ") == ["a b, c; d"]


@pytest.mark.parametrize(("a", "b", "want"), [("a b a c", "a c", ["b", "a"]), ("a", "", ["a"]), ("", "a", []), ("x x x", "x", ["x", "x"])])
def test_multiset_diff(spark, a, b, want):
    d = T.multiset_diff(F.split("a", " "), F.split("b", " "))
    got = values(spark, d, [(a, b)], "a string, b string")[0]
    assert [x for x in got if x] == want


def test_scope_side_and_base(spark):
    assert values(spark, T.extra_scope_words("a", "b", ["part", "group"]), [("left part part of x", "part of x")], "a string, b string") == [["part"]]
    assert strings(spark, T.side("x", ["left", "right"]), "left hand", "left right", "hand") == ["left", "unsided", "unsided"]
    assert strings(spark, T.base_name("x", ["left", "trai"]), "Left hand", "tay trái") == ["hand", "tay"]


def test_tags_keep_order_and_edges(spark):
    rules = [("d:up", T.word_pattern(["up"])), ("d:down", T.word_pattern(["down"])), ("c:bone", T.word_pattern(["cơ"]))]
    got = values(spark, T.tag_signals("x", rules), [(["down low", "up", None, "upper"],), (["cơ bản"],), ([],)], "x array<string>")
    assert got == [["d:down", "d:up"], ["c:bone"], []]
    assert values(spark, T.first_with_prefix("x", "d"), [(["c:a", "d:b", "d:c"],), ([],)], "x array<string>") == ["b", None]
    assert values(spark, T.first_of("x", "c", ["n", "m"]), [(["c:m", "c:n"],), (["c:z"],)], "x array<string>") == ["n", None]


def test_phrases_variants_and_fragments(spark):
    assert values(spark, T.has_phrase("x", F.lit("deep part")), [("a deep, part b",), ("deep parts",)], "x string") == [True, False]
    assert [v["value"] for v in strings(spark, T.alias_variants("x", "^the ", " organ$"), "the x organ")[0]] == ["the x organ", "the x", "x organ", "x"]
    assert [(r["pivot"], r["target"]) for r in strings(spark, T.split_at_accent("x"), "Deep part phần sâu", "plain", "sâu")] == [("Deep part", "phần sâu"), ("plain", None), ("", "sâu")]
    assert values(spark, T.join_fragments("x"), [(["ab-", "cd", "e", ", f"],)], "x array<string>") == ["ab-cd e, f"]
    assert values(spark, T.split_synonyms("x", F.lit("a")), [("a; b ;; c;b",)]) == [["b", "c"]]
    assert [x for x in strings(spark, T.match_key_pair("x"), "A ( b ) , c")[0]] == ["a (b), c", "a , c"]


def test_hashes_and_checks(spark):
    d = spark.createDataFrame([(1, "a", None), (2, "b", 3)], "k int, v string, w int")
    assert T.canonical_digest(d).collect() == T.canonical_digest(d.orderBy(F.desc("k"))).collect()
    assert T.canonical_digest(d.limit(0)).first()["rows"] == 0
    assert strings(spark, T.is_iso_date("x"), "2024-02-29", "2023-02-29", "x", None) == [True, False, False, False]
    assert strings(spark, T.is_url("x"), "https://a/b", "ftp://a", None) == [True, False, False]
    assert values(spark, T.citation(F.lit(" "), "a", F.lit("t"), F.lit(1999)), [(["Ann B", "C"],), ([],)], "a array<string>") == ["Ann B et al. (1999)", "t (1999)"]


def test_sides_and_hints(spark):
    rules = [("left", ["left", "trai"]), ("right", ["right"]), ("bilateral", ["both"])]
    assert strings(spark, T.laterality_of("x", rules), "Left", "tay TRÁI", "left and right", "both", "hand") == ["left", "left", "bilateral", "bilateral", "unsided"]
    assert strings(spark, T.id_hint("x", r"ID (\d+)"), "see ID 12", "none") == ["12", None]
    assert strings(spark, T.id_prefix("x"), "A1.2.3") == ["A1"] and strings(spark, T.is_placeholder("x"), " TBD", "x", None) == [True, False, False]
