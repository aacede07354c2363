import math
import zlib
from collections import Counter

import pytest

from lexspark.llm.lm_score import Lattice, lm_scores

ROWS = [(i, f"The cat sat on the mat {'zq%d ' % i * (i % 3)} and THE dog") for i in range(40)] + [(40, None), (41, ""), (42, "w " * 30_000), (43, "▁ \x00 日本 é")]


@pytest.mark.parametrize("head", [2, 100_000])
def test_counts_and_base_match_brute_force(documents, head):
    got = {r.doc_id: r for r in lm_scores(documents(ROWS), head=head).collect()}
    toks = {d: (t or "").encode().lower().split() for d, t in ROWS}
    train = [d for d in toks if zlib.crc32(str(d).encode()) % 7 != 2]
    c = Counter(w for d in train for w in toks[d])
    n, v, ends = sum(c.values()) + len(train), len(c) + 1, len(train)
    for d, words in toks.items():
        r = got[d]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words) + 1, sum(c[w] > 0 for w in words) + 1, n, d not in train)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0 and math.isfinite(r.score)


def test_lattice_sums_over_all_segmentations():
    p = {"▁": 0.1, "▁a": 0.2, "a": 0.1, "b": 0.2, "ab": 0.1, "▁ab": 0.05}
    model = Lattice({k: math.log(x) for k, x in p.items()}, [math.log(1e-6)] * 256)

    def every(text):
        return 1.0 if not text else sum(p[text[:k]] * every(text[k:]) for k in range(1, len(text) + 1) if text[:k] in p)

    assert 10 ** model.word(b"ab") == pytest.approx(every("▁ab"))
    assert 10 ** model.word(b"abab") == pytest.approx(every("▁abab"))
    assert model.word(b"c") == pytest.approx(math.log10(0.1 * 1e-6))
    assert math.isfinite(model.word(b"ab" * 5000))


def test_scores_match_brute_force(documents):
    """The whole score: pieces counted from the training texts, interpolated with the prior, all segmentations of each word."""
    import sentencepiece

    from lexspark.llm import lm_score

    rows = [(i, f"aab ab cab {'ba' * (i % 5)} b") for i in range(30)]
    sp = sentencepiece.SentencePieceProcessor(model_file=lm_score.default_vocabulary())
    train = [t for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    count = Counter(i for t in train for w in t.split() for i in sp.encode(w))
    usable = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i))]
    prior = {i: 1 / (1 - sp.get_score(i) + 100) for i in usable}
    weight, mass = max(1000.0, 0.01 * sum(count.values())), sum(prior.values())
    p = {i: count[i] + weight * prior[i] / mass for i in usable}
    total = sum(p.values()) + len(train) + 1
    named = {sp.id_to_piece(i): p[i] / total for i in usable if not sp.is_byte(i)}

    def every(text):
        return 1.0 if not text else sum(named[text[:k]] * every(text[k:]) for k in range(1, len(text) + 1) if text[:k] in named)

    for r in lm_scores(documents(rows), head=3).collect():
        want = sum(math.log10(every("▁" + w)) for w in dict(rows)[r.doc_id].split()) + math.log10((len(train) + 1) / total)
        assert r.score == pytest.approx(want, rel=1e-9)


def test_edges(documents):
    assert lm_scores(documents([])).collect() == []
    rows = lm_scores(documents([(None, "a b"), (1, "a b"), (1, "a b")])).collect()
    assert len(rows) == 3 and len({r.score for r in rows}) == 1
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    only = lm_scores(documents([(held, "a b")])).collect()[0]
    assert (only.train_tokens, only.n_known) == (0, 0) and math.isfinite(only.score)


def test_long_words_stay_off_the_driver_and_in_tasks_of_their_own(spark, monkeypatch):
    from lexspark.llm import lm_score

    rows = [(k, f"short words {k} " + f"{k}x" * (20_000 + k)) for k in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    tops = []
    real = lm_score._frequent
    monkeypatch.setattr(lm_score, "_frequent", lambda words, *a: tops.append(real(words, *a)) or tops[-1])
    whole = {r.doc_id: r.score for r in lm_score.lm_scores(d).collect()}
    assert max(len(r.word) for r in tops[0].collect()) <= lm_score.HEAD_WORD and len(whole) == 40
    # Without any word at the driver, and with other tasks and flushes, the scores are the same.
    monkeypatch.setattr(lm_score, "_frequent", lambda words, *a: real(words, 10, 150))
    monkeypatch.setattr(lm_score, "TASK_BYTES", 5_000)
    monkeypatch.setattr(lm_score, "FLUSH_BYTES", 1_000)
    again = {r.doc_id: r.score for r in lm_score.lm_scores(d).collect()}
    assert all(abs(whole[k] - again[k]) <= 1e-9 * abs(whole[k]) for k in whole)
