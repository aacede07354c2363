"""Operator 4: language-model scores by subword lattices.

The subword vocabulary is an existing one, of ranked pieces. A piece's log-probability interpolates
two estimates: a prior that its existing score gives, and its count in the training texts, cut by
the existing tokenizer. A text's probability is the sum over all its segmentations into pieces, by
forward recursion in log space. Pieces never cross a word boundary, so a text's log-probability is
the sum of its words' ones and of the end's; each distinct word is solved once in the whole corpus.

Words are counted in every task, combined by Spark, and kept in a table that grows with the corpus:
word, training count, log-probability. Its HEAD most frequent words, a fixed number, are broadcast;
the other words of each document are joined with the table, sorted by word on both sides, so that
neither has to fit in memory.

Defined results: a null text is empty and consists of the end alone; null doc_ids are not held out;
repeated rows are scored row by row; with no training text every count is 0 and the prior alone
weights the pieces; an empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch, slices

#: Words whose scores are broadcast, at most, and their bytes with what Python adds to each; longer words are never among them.
HEAD, HEAD_BYTES, WORD_BYTES, HEAD_WORD = 150_000, 24 << 20, 100, 256
#: Words, and bytes of words, that a task holds before it passes them on.
FLUSH, FLUSH_BYTES = 200_000, 32 << 20
#: Weight of the prior, as a share of the pieces counted, and in pieces at least.
PRIOR_SHARE, PRIOR_LEAST = 0.01, 1000.0
#: Bytes of distinct words that one task solves, each word counted with WORD_STEP more.
TASK_BYTES, WORD_STEP = 500_000, 4
MARK = "▁"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _word_counts(batches):
    """(held_out, text) to (word, train, docs): counts in the training texts; words of held-out ones with 0."""
    import pyarrow as pa

    def flush():
        words = list(seen)
        out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([seen[w] for w in words], pa.int64())], names=["word", "train"])
        seen.clear()
        return out

    seen: Counter = Counter()
    size = 0
    for batch in slices(batches):
        for held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = (text or "").encode().lower().split()
            if held:
                for w in words:
                    seen[w] += 0
            else:
                seen.update(words)
            size += len(text or "")  # more than the new words have
            if len(seen) > FLUSH or size > FLUSH_BYTES and sum(map(len, seen)) > FLUSH_BYTES // 2:
                yield flush()
                size = 0
            elif size > FLUSH_BYTES:
                size = 0
    if seen:
        yield flush()


def _piece_counts(vocabulary: str):
    """(word, train) to (piece, n): pieces of the words as the existing tokenizer cuts them, weighted by the words' counts."""

    def run(batches):
        import pyarrow as pa
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        total = np.zeros(sp.get_piece_size(), np.int64)
        for batch in slices(batches):
            words = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            cuts = sp.encode(words, num_threads=1)
            lens = np.array([len(c) for c in cuts], np.int64)
            if lens.sum():
                ids = np.fromiter((i for c in cuts for i in c), np.int64, int(lens.sum()))
                total += np.bincount(ids, np.repeat(batch.column(1).to_numpy(), lens), len(total)).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["piece", "n"])

    return run


class Lattice:
    """log10 probabilities of words: the sum over their segmentations into weighted pieces."""

    def __init__(self, log_p: dict[str, float], byte_log_p: list[float]) -> None:
        self.log_p, self.bytes = log_p, byte_log_p
        self.longest = max(map(len, log_p), default=1)

    def word(self, word: bytes) -> float:
        text = MARK + word.decode("utf-8", "replace")
        n, get, longest = len(text), self.log_p.get, self.longest
        exp, log1p = math.exp, math.log1p
        forward = [-math.inf] * (n + 1)
        forward[0] = 0.0
        for i in range(n):
            at = forward[i]
            for j in range(i + 1, min(n, i + longest) + 1):
                p = get(text[i:j])
                if p is not None:
                    p += at
                    f = forward[j]
                    if f < p:
                        f, p = p, f
                    forward[j] = f + log1p(exp(p - f))
            if forward[i + 1] == -math.inf:  # no piece ends here: the character's bytes
                forward[i + 1] = at + sum(self.bytes[b] for b in text[i].encode("utf-8", "surrogatepass"))
        return forward[n] / math.log(10)


def build_lattice(vocabulary: str, counts: dict[int, int], ends: int) -> tuple[Lattice, float]:
    """The lattice of a vocabulary, and the end's log10 probability."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    size = sp.get_piece_size()
    n = np.array([counts.get(i, 0) for i in range(size)], np.float64)
    # An existing score is minus the piece's rank among merges; a rank's prior weight falls as one over it.
    prior = np.array([1 / (1 - sp.get_score(i) + 100) for i in range(size)])
    use = np.array([not (sp.is_control(i) or sp.is_unknown(i)) for i in range(size)])
    prior *= use
    weight = max(PRIOR_LEAST, PRIOR_SHARE * n.sum())
    p = n * use + weight * prior / prior.sum()
    end = ends + 1.0
    log_p = np.log(np.maximum(p, 1e-300)) - math.log(p.sum() + end)
    pieces, of_byte = {}, [-math.inf] * 256
    for i in np.flatnonzero(use).tolist():
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            of_byte[int(name[3:5], 16)] = float(log_p[i])
        else:
            pieces[name] = float(log_p[i])
    floor = float(log_p[use].min())
    of_byte = [floor if x == -math.inf else x for x in of_byte]
    return Lattice(pieces, of_byte), math.log10(end / (p.sum() + end))


def _word_scores(lattice):
    def run(batches):
        import pyarrow as pa

        model = Lattice(*lattice.value)
        for batch in slices(batches):
            lm = [model.word(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lm, pa.float64())], names=["word", "train", "lm"])

    return run


PARTS = "row long, doc_id long, held boolean, word binary, tf int, n long, known long, base double, lm double"


def _document_parts(head):
    """(row, doc_id, held, text) to PARTS: a row with sums over the head words, and one for each other word."""

    def run(batches):
        import pyarrow as pa

        known = head.value
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        names = ["row", "doc_id", "held", "word", "tf", "n", "known", "base", "lm"]
        cols: list[list] = [[] for _ in names]
        size = 0

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
            for c in cols:
                c.clear()
            return out

        for batch in slices(batches):
            for row, doc, held, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                base = lm = 0.0
                n_known = n = 0
                rare = []
                for word, tf in Counter((text or "").encode().lower().split()).items():
                    n += tf
                    if (v := known.get(word)) is not None:
                        base += tf * v[0]
                        lm += tf * v[1]
                        n_known += tf * (v[0] > 0)
                    else:
                        rare.append((word, tf))
                k = len(rare)
                size += sum(len(r[0]) for r in rare)
                more = ([row] * (k + 1), [doc] + [None] * k, [held] + [None] * k, [None, *(r[0] for r in rare)], [0, *(r[1] for r in rare)], [n] + [0] * k, [n_known] + [0] * k, [base] + [0.0] * k, [lm] + [0.0] * k)
                for c, x in zip(cols, more, strict=True):
                    c.extend(x)
                if len(cols[0]) > FLUSH or size > FLUSH_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    return run


def _frequent(words: DataFrame, most: int, most_bytes: int = HEAD_BYTES) -> DataFrame:
    """The most frequent words, at most `most` and `most_bytes`: those from the lowest frequency band on that leaves so few.

    Bands are sixteenths of powers of two, so what reaches the driver is some hundred counts, and then
    the words of the bands taken. Words of over HEAD_WORD bytes are not among them.
    """
    words = words.filter(F.octet_length("word") <= HEAD_WORD)
    band = F.floor(16 * F.log2(F.col("train") + 1.0))
    sizes = words.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.sum(F.octet_length("word") + WORD_BYTES).alias("bytes")).orderBy(F.desc("band")).collect()
    total, size, least = 0, 0, None
    for r in sizes:
        total, size = total + r["n"], size + r["bytes"]
        if total > most or size > most_bytes:
            break
        least = r["band"]
    return words.filter(F.lit(False) if least is None else band >= least)


def lm_scores(docs: DataFrame, vocabulary: str | None = None, head: int = HEAD) -> DataFrame:
    """Per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    scratch = Scratch(spark, "lm-score")
    rows = docs.select("doc_id", "text", held_out().alias("held"))
    counted = rows.select("held", "text").mapInArrow(_word_counts, "word binary, train long")
    words = scratch.store(counted.groupBy("word").agg(F.sum("train").alias("train")), "words")
    ends = rows.filter(~F.col("held")).count()
    told = words.agg(F.sum("train"), F.count_if(F.col("train") > 0), F.sum(F.octet_length("word") + WORD_STEP)).first()
    n_train = int(told[0] or 0) + ends
    kinds = int(told[1] or 0) + (ends > 0)
    pieces = words.filter("train > 0").mapInArrow(_piece_counts(vocabulary), "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    lattice, end_lm = build_lattice(vocabulary, {r["piece"]: r["n"] for r in pieces.collect()}, ends)  # a row a piece of the vocabulary
    # As many tasks as the words' characters need, whatever files they came in: the recursion goes over characters.
    dealt = words.repartition(max(1, -(-int(told[2] or 0) // TASK_BYTES)))
    scored = scratch.store(dealt.mapInArrow(_word_scores(spark.sparkContext.broadcast((lattice.log_p, lattice.bytes))), "word binary, train long, lm double"), "word-scores")
    scratch.drop(words)
    value = F.log10(F.col("train") + 1.0)
    top = _frequent(scored, head).select("word", value.alias("base"), "lm").collect()
    known = spark.sparkContext.broadcast({bytes(r["word"]): (r["base"], r["lm"]) for r in top})
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held", "text")
    parts = scratch.store(rows.mapInArrow(_document_parts(known), PARTS), "parts")
    rare = parts.filter("word is not null").select("row", "word", "tf")
    rare = rare.join(scored.withColumnRenamed("lm", "word_lm"), "word")
    nothing = F.lit(None)
    rare = rare.select("row", nothing.cast("long").alias("doc_id"), nothing.cast("boolean").alias("held"), F.lit(0).cast("long").alias("n"), F.when(F.col("train") > 0, F.col("tf").cast("long")).otherwise(0).alias("known"), (F.col("tf") * value).alias("base"), (F.col("tf") * F.col("word_lm")).alias("lm"))
    sums = parts.filter("word is null").select(*rare.columns).union(rare).groupBy("row")
    sums = sums.agg(F.max("doc_id").alias("doc_id"), F.bool_or("held").alias("held"), *[F.sum(c).alias(c) for c in ("n", "known", "base", "lm")])
    n_tokens = F.col("n") + 1
    return sums.select(
        "doc_id",
        F.col("held").alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("known") + int(ends > 0)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(ends + 1) - n_tokens * math.log10(n_train + kinds + 1)).alias("base_score"),
        (F.col("lm") + end_lm).alias("score"),
    )
