import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexspark.llm.align import PIECE, Tokenizers, align, count_links, default_tokenizers, linked, linked_documents, pieces_of

SCHEMA = "doc_id long, text string, row int, links string, pair long, best string, documents int, n_a string"


@pytest.fixture(scope="module")
def tokenizers():
    return Tokenizers(*default_tokenizers())


def tokens(text):
    """Ids and ends of both sides by the libraries, told by their own pieces; None where the bytes differ."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer, pre_tokenizers

    a = tokens.__dict__.setdefault("a", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    b = tokens.__dict__.setdefault("b", sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")))
    a.encode_special_tokens = True
    if "letters" not in tokens.__dict__:
        # The vocabulary's letter of each byte, from the library's own encoding of characters of one and two bytes.
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        tokens.letters = {}
        for code in [*range(0x80), *range(0x80, 0x800), *range(0x800, 0xD800, 64), *range(0xE000, 0x10000, 64), *range(0x10000, 0x110000, 4096)]:
            for letter, byte in zip(split.pre_tokenize_str(chr(code))[0][0], chr(code).encode(), strict=True):
                tokens.letters[letter] = byte
    spaced = " " + text
    a_ids = a.encode(spaced, add_special_tokens=False).ids
    b_ids = b.encode(text)
    a_bytes = [bytes(tokens.letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, map(b.id_to_piece, b_ids), strict=True)]
    if b"".join(a_bytes) != spaced.encode() or b"".join(b_bytes) != spaced.encode():
        return None
    return a_ids, b_ids, np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()


def brute(rows):
    docs, held = [], Counter()
    for doc_id, text in rows:
        t = tokens(text) if text else None
        groups = []
        if t:
            a_ids, b_ids, a_ends, b_ends = t
            cuts = sorted(set(a_ends) & set(b_ends))
            groups = [([i for i, e in zip(a_ids, a_ends, strict=True) if lo < e <= hi], [i for i, e in zip(b_ids, b_ends, strict=True) if lo < e <= hi]) for lo, hi in zip([0, *cuts], cuts)]
        links = Counter((a, b) for p, q in groups for a in p for b in q)
        held.update(links.keys())
        docs.append((doc_id, groups, links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, groups, links in docs:
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        n_best = sum(n for (a, b), n in links.items() if held[a, b] == best[a])
        total = sum(n * held[p] for p, n in links.items())
        out.append((doc_id or -1, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), sum(links.values()), n_best, total, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out)


def rows_of(df):
    return sorted((r.doc_id or -1, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


TEXTS = [
    "The quick brown fox.", "", None, "The quick brown fox.", " two  spaces\n\tand\r\nlines ", "naïve café — 日本語テキスト 🎉🎉", "x<|endoftext|>y <s> </s> <unk>", "▁ given", "a" * 3000,
    "=" * 700 + " ab", "1234567890 3.14159", "ﬁ  　", "\u0000\u0001", " ", "don't we'll", "schöne Größe für Bücher",
]


@pytest.mark.parametrize("how", [{}, {"piece": 7, "chunk": 40, "wide": 3}, {"broadcast_bytes": 64 * 20}, {"broadcast_bytes": 0}])
def test_same_as_brute_force(spark, how):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[0]), (3, TEXTS[4]), (None, TEXTS[5])]
    d = spark.createDataFrame([(*r, 1, "l", 2, "b", 3, "n") for r in rows], SCHEMA).repartition(2)
    assert rows_of(count_links(d, **how)) == brute(rows)
    if not how:
        assert count_links(d.limit(0)).collect() == []


def test_driver_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    want = brute(rows)
    assert rows_of(count_links(d)) == want
    assert rows_of(count_links(d, piece=64, chunk=500, wide=2, broadcast_bytes=64 * 50)) == want


def test_overlaps(tokenizers):
    """The union of both directions holds every pair of tokens whose byte ranges meet."""
    text = "Überflüssige tokenization of 日本語 strings, isn't it? 🎉"
    a, b = tokenizers.encode([text])[0]
    x = align(a, b, tokenizers.a_len, tokenizers.b_len, np.zeros(len(a), np.int64), np.zeros(len(b), np.int64))
    spans = [list(zip(e - n[i], e, strict=True)) for i, e, n in zip(x.ids, x.ends, (tokenizers.a_len, tokenizers.b_len), strict=True)]
    want = {(i, j) for i, (s, e) in enumerate(spans[0]) for j, (p, q) in enumerate(spans[1]) if s < q and p < e}
    got = list(zip(*(o.tolist() for o in x.overlaps), strict=True))
    assert len(got) == len(set(got)) and set(got) == want
    # Groups are what overlaps connect.
    assert all(x.groups[0][i] == x.groups[1][j] for i, j in want)
    assert all(np.array_equal(p, q) for p, q in zip(linked(x, len(tokenizers.b), 0), linked(x, len(tokenizers.b)), strict=True))


def test_pieces(tokenizers):
    text = "word, and more. " * 5000
    pieces = pieces_of(text, 1000)
    assert " ".join(pieces) == text and all(len(p) < 1020 for p in pieces)
    assert pieces_of("x" * 2 * PIECE) == ["x" * 2 * PIECE] and pieces_of("ab") == ["ab"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab Z9.,_é日\n\t▁'ﬁ- "), max_size=12), max_size=8))
def test_cut_texts_have_the_same_tokens(tokenizers, words):
    text = " ".join(words)
    if not text:
        return
    whole = tokenizers.encode([text])[0]
    parts = tokenizers.encode(pieces_of(text, 1))
    if whole is not None:
        assert all(p is not None for p in parts)
        for side in (0, 1):
            assert np.concatenate([p[side] for p in parts]).tolist() == whole[side].tolist()
    else:
        assert any(p is None for p in parts)


def test_long_text_of_many_pieces(spark):
    text = "The river runs by the old mill, where Größe is 日本. " * 8000
    rows = [(1, text), (2, "x " * 50_000), (3, "ä" * 40_000)]
    got = {r.doc_id: r for r in linked_documents(spark.createDataFrame(rows, "doc_id long, text string"), chunk=1 << 16).collect()}
    for k, t in rows:
        a_ids, b_ids, a_ends, b_ends = tokens(t)
        cuts = len(set(a_ends) & set(b_ends))
        assert (got[k].n_a, got[k].n_b, got[k].n_groups) == (len(a_ids), len(b_ids), cuts)
        assert got[k].n_links == sum(got[k].links) and len(set(zip(got[k].pairs_a, got[k].pairs_b, strict=True))) == len(got[k].links)
