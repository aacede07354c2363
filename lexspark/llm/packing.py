"""Operator 10: packs documents into training sequences by vector best-fit.

A document is its token ids and an end id. Only documents longer than a sequence are cut: into
full pieces, which fill a sequence each, behind a first piece that holds the rest. First pieces,
longest first, go to the open sequence that fits them best among those where all three residual
capacities hold: tokens, documents, and attention cost (the sum of squared lengths). The best one
has the least weighted norm of what would be left; or, if asked for, the greatest weighted dot
product of what is asked and what is left. Pieces are dealt out at random to groups of about
GROUP pieces, each packed by one task, so memory is bounded and no group grows with the input; a
group wastes less than one sequence more than its share.

Defined results: a null text is empty and has the end id alone; rows are packed one by one, so
repeated rows and null doc_ids are packed as often as they come; an empty table gives an empty
table; only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import Scratch, slices

TOKENS, END = 1024, 2
GROUP = 8192
WEIGHTS = (1.0, 0.1, 0.1)
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> tuple[str, str]:
    """Paths of the vocabulary as a tokenizer and as ranks; both give the same ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Token ids of a text. The rank file, if given, is some four times as fast as the tokenizer of the same vocabulary.

    The tokenizer decides: it takes over whenever the fast path fails on a text, and it is asked
    alone for texts that hold one of its special tokens, which it gives their ids as it does by default.
    """

    def __init__(self, tokenizer: str, ranks: str | None) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer)
        self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and not any(s in text for s in self.special):
            try:
                return np.asarray(self.fast.encode_ordinary(text), "<u4")
            except (ValueError, RuntimeError):
                pass
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


def cut(ids: np.ndarray, tokens: int = TOKENS) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    rest = len(ids) % tokens or min(len(ids), tokens)
    return [(0, rest)] + [(at, tokens) for at in range(rest, len(ids), tokens)]


def _pieces(tokenizer: str, ranks: str | None, tokens: int, end: int):
    def run(batches):
        import pyarrow as pa

        encode = Encoder(tokenizer, ranks)
        for batch in slices(batches):
            cols: list[list] = [[] for _ in range(6)]
            for doc, row, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4")
                for k, (start, length) in enumerate(cut(ids, tokens)):
                    for c, v in zip(cols, (doc, row, k, start, length, zlib.crc32(ids[start : start + length].tobytes())), strict=True):
                        c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], weights=WEIGHTS, by: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, for pieces given longest first."""
    cap = np.array(capacity, np.float64)
    w = np.array(weights, np.float64) / (cap * cap)
    n = len(lengths)
    left = np.empty((n, 3))
    number = np.empty(n, np.int64)
    open_, made = 0, 0
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    least = int(lengths.min()) if n else 0
    for k, length in enumerate(lengths.tolist()):
        need = np.array((length, 1, length * length), np.float64)
        if (need > cap).any():
            raise ValueError("a piece exceeds the capacity of an empty sequence")
        at = -1
        if open_:
            rest = left[:open_] - need
            score = (rest * rest) @ w if by == "norm" else -(left[:open_] * need) @ w
            score[(rest < 0).any(axis=1)] = np.inf
            best = int(np.argmin(score))
            at = best if score[best] < np.inf else -1
        if at < 0:
            at, open_ = open_, open_ + 1
            left[at], number[at] = cap, made
            made += 1
        bins[k], offsets[k] = number[at], cap[0] - left[at, 0]
        left[at] -= need
        if left[at, 0] < least or left[at, 1] < 1 or left[at, 2] < least * least:  # nothing fits any more
            open_ -= 1
            left[at], number[at] = left[open_], number[open_]
    return bins, offsets


def _packed(capacity, weights, by):
    def run(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "row"], ascending=[False, True, True], kind="stable")
        bins, offsets = best_fit(pdf["length"].to_numpy(), capacity, weights, by)
        return pdf.assign(sequence_id=(pdf["group"].to_numpy() << 32) | bins, offset=offsets).drop(columns=["group", "row"])

    return run


def pack(docs: DataFrame, tokens: int = TOKENS, documents: int = TOKENS, attention: int = TOKENS * TOKENS, weights=WEIGHTS, by: str = "norm", end: int = END, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    documents, attention: capacities of a sequence beside its tokens; the defaults never bind. A
    full piece takes a sequence alone whatever these are. tokenizer: a path, the same on all
    executors; ranks: the same vocabulary as ranks, for speed.
    """
    if tokenizer is None:
        tokenizer, ranks = default_tokenizer()
    scratch = Scratch(docs.sparkSession, "packing")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    pieces = scratch.store(rows.mapInArrow(_pieces(tokenizer, ranks, tokens, end), PIECES), "pieces")
    full = F.col("length") == tokens
    alone = pieces.filter(full).select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(~full)
    groups = max(1, -(-rest.count() // GROUP))
    rest = rest.withColumn("group", F.pmod(F.xxhash64("doc_id", "row"), F.lit(groups)))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return alone.union(rest.groupBy("group").applyInPandas(_packed((tokens, documents, attention), weights, by), out))


def op10_best_fit_packing(docs: DataFrame) -> DataFrame:
    return pack(docs.select("doc_id", "text"))
