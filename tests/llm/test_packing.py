import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lexspark.llm import packing

TEXTS = [None, "", "short one", "ä ß 日本 \x00", "word " * 3000, "<|endoftext|> in a text", " " * 5000, "x" * 3000, "a\n\n b", "don't we'll"]


def test_pieces_and_ids(documents):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(2000))) for _ in range(60)]
    d = documents([*enumerate(texts), (3, texts[3]), (None, "no id")])
    rows = packing.op10_best_fit_packing(d).collect()
    t = Tokenizer.from_file(packing.default_tokenizer()[0])
    by, places = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in [*enumerate(texts), (None, "no id")]:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [packing.END], "<u4")
        times = 2 if i == 3 else 1
        mine = sorted(by[i], key=lambda r: r.piece)[::times]
        assert len(by[i]) == times * -(-len(ids) // 1024) and [r.piece for r in mine] == list(range(len(mine)))
        assert mine[0].start == 0 and all(a.start + a.length == b.start for a, b in zip(mine, mine[1:])) and mine[-1].start + mine[-1].length == len(ids)
        assert all(r.length == 1024 for r in mine[1:]) and all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine)
    for v in places.values():
        v.sort()
        assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:])) and sum(n for _, n in v) <= 1024
    assert len(places) <= sum(r.length for r in rows) / 1024 * 1.02 + 1


def test_capacities_hold():
    rng = np.random.default_rng(0)
    for cap in ((100, 100, 10_000), (100, 3, 10_000), (100, 100, 4000)):
        for by in ("norm", "dot"):
            n = np.sort(rng.integers(1, 61, 500))[::-1]
            bins, offsets = packing.best_fit(n, cap, by=by)
            for b in np.unique(bins):
                mine = n[bins == b]
                assert mine.sum() <= cap[0] and len(mine) <= cap[1] and (mine**2).sum() <= cap[2]
                o = np.sort(offsets[bins == b])
                assert o[0] == 0 and len(set(o.tolist())) == len(o)
    with pytest.raises(ValueError, match="exceeds"):
        packing.best_fit(np.array([50]), (100, 10, 100))


def test_empty_table(documents):
    assert packing.op10_best_fit_packing(documents([])).collect() == []


def test_fast_ids_equal_the_tokenizers():
    fast, slow = packing.Encoder(*packing.default_tokenizer()), packing.Encoder(packing.default_tokenizer()[0], None)
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choice("aB é\n\t ßж1,.'s日  😀\x00#") for _ in range(rng.randrange(60)))
        assert fast(text).tolist() == slow(text).tolist(), repr(text)


def test_special_tokens_get_the_ids_of_the_tokenizer():
    plain = Tokenizer.from_file(packing.default_tokenizer()[0])
    text = "a <|endoftext|> b"
    assert packing.Encoder(*packing.default_tokenizer())(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(plain.encode(text, add_special_tokens=False).ids) == 4


def test_further_capacities_bind_end_to_end(documents):
    d = documents([(i, "the cat sat on the mat " * (1 + i % 8)) for i in range(120)])
    sequences = lambda **capacities: [v for v in _by_sequence(packing.pack(d, **capacities).collect()).values()]
    few, light, free = sequences(documents=4), sequences(attention=6000), sequences()
    assert max(map(len, few)) == 4 < max(map(len, free))
    assert max(sum(n * n for n in v) for v in light) <= 6000 < max(sum(n * n for n in v) for v in free)
    assert all(sorted(n for v in x for n in v) == sorted(n for v in free for n in v) for x in (few, light))


def _by_sequence(pieces):
    out = {}
    for r in pieces:
        out.setdefault(r.sequence_id, []).append(r.length)
    return out
