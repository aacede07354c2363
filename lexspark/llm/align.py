"""Operator 11: alignment of two tokenizers' tokens, and counts of linked ids over the corpus.

Both tokenizers split the same bytes, a space and the text. A task lays the tokens of a batch of
texts end to end and joins them, keyed by document, with pandas.merge_asof: each token of one side
finds the token of the other side that covers its start, in both directions, and the union of the
two is all overlaps. Overlapping tokens that end together close a group, and a group's tokens of
both sides are all linked. A document's linked id pairs are kept once each with their number of
links; the corpus counts documents by pair, and every document then sums the counts of its links.

Long texts are cut at single spaces between words, where neither tokenizer has a token that crosses
(a leading space is part of a word's token in one, and added to it in the other), so a task holds
some CHUNK characters of tokens whatever a text's length; a text without such spaces is one piece.
Groups of many tokens are counted by their distinct ids, never as pairs of tokens. Pair counts are
summed within tasks before they are shuffled. They are joined back by broadcast only below
BROADCAST_BYTES; beyond it, pairs are split at a frequency that few enough reach to be broadcast,
so that no key of the shuffled join is hot.

Defined results: a null or empty text, or one that either tokenizer does not give back byte for
byte, has no tokens, zeros and the empty digest; each row is a document of its own, whatever its
doc_id, so repeated rows count as often as they come; an empty table gives an empty table; only
doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import BROADCAST_BYTES, Scratch, sized_broadcast, slices

#: Characters of a piece of a long text, at least, and of the pieces whose tokens are joined at once.
PIECE, CHUNK = 1 << 15, 1 << 19
#: Groups of more pairs of tokens than this are counted by distinct ids.
WIDE = 1 << 12
#: Bytes of a pair in a broadcast table.
PAIR_BYTES = 64
_CUT = re.compile(r"(?<=[\w.,]) (?=\w)")
PAIRS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, pairs_a array<int>, pairs_b array<int>, links array<long>"


def default_tokenizers() -> tuple[str, str, str]:
    """Paths: A as a tokenizer, A as ranks (which give the same ids, faster), B as a sentencepiece model."""
    import public_tokenizers

    return tuple(public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))


class Tokenizers:
    """Ids of both sides for pieces of text, and the bytes of every id."""

    def __init__(self, a: str, ranks: str | None, b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(a)
        self.slow.encode_special_tokens = True
        self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        byte_of = _byte_letters()
        names = [self.slow.id_to_token(k) or "" for k in range(self.slow.get_vocab_size(with_added_tokens=True))]
        self.a = np.array([bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in names], object)
        space = "▁"
        self.b = np.array([bytes([int(p[3:5], 16)]) if self.pieces.is_byte(k) else p.replace(space, " ").encode() for k in range(self.pieces.get_piece_size()) for p in (self.pieces.id_to_piece(k),)], object)
        self.a_len, self.b_len = (np.array([len(t) for t in side], np.int64) for side in (self.a, self.b))
        # Ids as text with what follows them: within a side, and at its end.
        texts = [str(k).encode() for k in range(max(len(self.a), len(self.b)))]
        self.words = np.array([t + b"," for t in texts[: len(self.a)]] + [t + b"|" for t in texts[: len(self.a)]] + [t + b"," for t in texts[: len(self.b)]] + [t + b";" for t in texts[: len(self.b)]], object)

    def encode_a(self, text: str) -> np.ndarray:
        if self.fast:
            try:
                return np.asarray(self.fast.encode_ordinary(text), np.int64)
            except (ValueError, RuntimeError):
                pass
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, np.int64)

    def encode(self, pieces: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Both sides' ids of each piece with a space before it; None where bytes do not come back."""
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text, b in zip(pieces, self.pieces.encode(pieces, num_threads=1), strict=True):
            b = np.asarray(b, np.int64)
            spaced = " " + text
            a = self.encode_a(spaced)
            want = spaced.encode()
            same = b"".join(self.a[a].tolist()) == want and b"".join(self.b[b].tolist()) == want
            out.append((a, b) if same else None)
        return out


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def pieces_of(text: str, least: int = PIECE) -> list[str]:
    """A text cut at single spaces between words, which are left out, into pieces of `least` characters or a little more."""
    out, at = [], 0
    while len(text) - at > least and (m := _CUT.search(text, at + least)):
        out.append(text[at : m.start()])
        at = m.end()
    return [*out, text[at:]] if at < len(text) else out


@dataclass
class Aligned:
    """Tokens of some pieces, end to end: each side's ids, ends, document number and group; overlaps as index pairs."""

    ids: tuple[np.ndarray, np.ndarray]
    ends: tuple[np.ndarray, np.ndarray]
    docs: tuple[np.ndarray, np.ndarray]
    groups: tuple[np.ndarray, np.ndarray]
    overlaps: tuple[np.ndarray, np.ndarray]


def align(a: np.ndarray, b: np.ndarray, a_len: np.ndarray, b_len: np.ndarray, a_doc: np.ndarray, b_doc: np.ndarray) -> Aligned:
    """Aligns tokens that cover the same bytes; a_doc and b_doc: rising document numbers."""
    import pandas as pd

    sides = []
    for ids, length, doc in ((a, a_len, a_doc), (b, b_len, b_doc)):
        size = length[ids]
        end = np.cumsum(size)
        sides.append((ids, end - size, end, doc, np.arange(len(ids))))
    (_, a_start, a_end, _, _), (_, b_start, b_end, _, _) = sides
    frames = [pd.DataFrame({"start": start, "doc": doc, "token": at}, copy=False) for _, start, _, doc, at in sides]
    covering = [pd.merge_asof(mine, other, on="start", by="doc", suffixes=("", "_over"))["token_over"].to_numpy(np.int64) for mine, other in (frames, frames[::-1])]
    later = np.flatnonzero(a_start[covering[1]] != b_start)  # pairs that start together come from the first direction
    over_a, over_b = np.concatenate([np.arange(len(a)), covering[1][later]]), np.concatenate([covering[0], later])
    together = np.flatnonzero(a_end[over_a] == b_end[over_b])
    groups = []
    for ids, at in ((a, over_a), (b, over_b)):
        last = np.zeros(len(ids), np.int64)
        last[at[together]] = 1
        groups.append(np.cumsum(last) - last)
    return Aligned((a, b), (a_end, b_end), (a_doc, b_doc), (groups[0], groups[1]), (over_a, over_b))


def linked(x: Aligned, kinds: int, wide: int = WIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, a * kinds + b, links) once per document and id pair, rising. kinds: ids of side b."""
    (a, b), (ga, gb) = x.ids, x.groups
    n = int(ga[-1]) + 1
    na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    a_at, b_at = np.cumsum(na) - na, np.cumsum(nb) - nb
    small = na * nb <= wide
    from_a = np.flatnonzero(small[ga])
    times = nb[ga[from_a]]
    left = np.repeat(from_a, times)
    first = np.cumsum(times) - times
    right = np.repeat(b_at[ga[from_a]] - first, times) + np.arange(len(left))
    doc, key, count = [x.docs[0][left]], [a[left] * kinds + b[right]], []
    for g in np.flatnonzero(~small):
        p, np_ = np.unique(a[a_at[g] : a_at[g] + na[g]], return_counts=True)
        q, nq = np.unique(b[b_at[g] : b_at[g] + nb[g]], return_counts=True)
        key.append((p[:, None] * kinds + q[None, :]).ravel())
        doc.append(np.full(len(key[-1]), x.docs[0][a_at[g]]))
        count.append((np_[:, None] * nq[None, :]).ravel())
    doc, key = np.concatenate(doc), np.concatenate(key)
    space = int(key.max()) + 1
    if count:
        both, back = np.unique(doc * space + key, return_inverse=True)
        links = np.zeros(len(both), np.int64)
        np.add.at(links, back, np.concatenate([np.ones(len(left), np.int64), *count]))
    else:
        both, links = np.unique(doc * space + key, return_counts=True)
    return both // space, both % space, links


def written(x: Aligned, words: np.ndarray, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups as text, one item a token, and each item's document; words: Tokenizers.words of n_a and n_b ids."""
    (a, b), (ga, gb) = x.ids, x.groups
    n = int(ga[-1]) + 1
    a_to, b_to = np.cumsum(np.bincount(ga, minlength=n)), np.cumsum(np.bincount(gb, minlength=n))
    out, doc = np.empty(len(a) + len(b), object), np.empty(len(a) + len(b), np.int64)
    at = np.arange(len(a))
    place = at + (b_to[ga] - np.bincount(gb, minlength=n)[ga])
    out[place], doc[place] = words[a + n_a * (at + 1 == a_to[ga])], x.docs[0]
    at = np.arange(len(b))
    place = at + a_to[gb]
    out[place], doc[place] = words[2 * n_a + b + n_b * (at + 1 == b_to[gb])], x.docs[1]
    return out, doc


@dataclass
class _Document:
    row: int
    doc_id: int | None
    left: int  # pieces to come
    sound: bool = True
    n: np.ndarray = field(default_factory=lambda: np.zeros(5, np.int64))
    text: "hashlib._Hash" = field(default_factory=hashlib.sha256)
    held: bytes = b""
    pairs: list = field(default_factory=list)

    def write(self, items: list[bytes]) -> None:
        """Adds groups to the digest; the separator behind the last of all is left out."""
        now = self.held + b"".join(items)
        self.text.update(now[:-1])
        self.held = now[-1:]

    def keep(self, key: np.ndarray, links: np.ndarray) -> None:
        self.pairs.append((key, links))
        if len(self.pairs) > 1 and sum(len(k) for k, _ in self.pairs[1:]) > max(100_000, len(self.pairs[0][0])):
            self.pairs = [self.merged()]

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) < 2:
            return self.pairs[0] if self.pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        key, back = np.unique(np.concatenate([k for k, _ in self.pairs]), return_inverse=True)
        links = np.zeros(len(key), np.int64)
        np.add.at(links, back, np.concatenate([n for _, n in self.pairs]))
        return key, links


def _chunks(batches, tokenizers: Tokenizers, piece: int, chunk: int):
    """(documents by number, Aligned or None, documents complete) for pieces of some `chunk` characters, in order."""
    docs: list[_Document] = []
    queue: list[tuple[int, str]] = []
    size = 0

    def run():
        nonlocal size
        parts = [(k, p) for (k, _), p in zip(queue, tokenizers.encode([t for _, t in queue]), strict=True)]
        for k, p in parts:
            docs[k].left -= 1
            docs[k].sound &= p is not None
        sides = [(k, p) for k, p in parts if p is not None and docs[k].sound]
        found = None
        if sides:
            a, b = (np.concatenate([p[s] for _, p in sides]) for s in (0, 1))
            a_doc, b_doc = (np.repeat([k for k, _ in sides], [len(p[s]) for _, p in sides]) for s in (0, 1))
            found = align(a, b, tokenizers.a_len, tokenizers.b_len, a_doc, b_doc)
        queue.clear()
        size = 0
        return found

    for batch in slices(batches):
        for row, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            pieces = pieces_of(text, piece) if text else []
            docs.append(_Document(row, doc_id, len(pieces)))
            for p in pieces:
                queue.append((len(docs) - 1, p))
                size += len(p)
                if size >= chunk:
                    yield docs, run()
        if size or any(not d.left for d in docs):
            yield docs, run() if queue else None
        docs.clear()


def _documents(paths: tuple, piece: int, chunk: int, wide: int):
    def run(batches):
        import pyarrow as pa

        t = Tokenizers(*paths)
        kinds = len(t.b)
        for docs, x in _chunks(batches, t, piece, chunk):
            if x is not None:
                doc, key, links = linked(x, kinds, wide)
                items, item_doc = written(x, t.words, len(t.a), kinds)
                for k in np.unique(doc):
                    d = docs[k]
                    lo, hi = np.searchsorted(doc, [k, k + 1])
                    d.keep(key[lo:hi], links[lo:hi])
                    i, j = np.searchsorted(item_doc, [k, k + 1])
                    d.write(items[i:j].tolist())
                    (a0, a1), (b0, b1) = (np.searchsorted(s, [k, k + 1]) for s in x.docs)
                    d.n += [a1 - a0, b1 - b0, x.groups[0][a1 - 1] - x.groups[0][a0] + 1, links[lo:hi].sum(), 0]
                over = np.bincount(x.docs[0][x.overlaps[0]], minlength=len(docs))
                for k in np.flatnonzero(over):
                    docs[k].n[4] += over[k]
            done = [d for d in docs if not d.left and d.row is not None]
            if done:
                yield _rows(done, kinds, pa)
            for d in done:
                d.row, d.pairs = None, []

    return run


def _rows(done: list[_Document], kinds: int, pa):
    """The finished documents as rows."""
    pairs = [d.merged() if d.sound else (np.zeros(0, np.int64), np.zeros(0, np.int64)) for d in done]
    counts = np.array([d.n if d.sound else np.zeros(5, np.int64) for d in done])
    key, links = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    ends = pa.array(np.append(0, np.cumsum([len(p[0]) for p in pairs])), pa.int32())
    digest = [d.text.hexdigest() if d.sound and d.n[0] else "" for d in done]
    lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in ((key // kinds).astype(np.int32), (key % kinds).astype(np.int32), links)]
    return pa.RecordBatch.from_arrays(
        [pa.array([d.row for d in done], pa.int64()), pa.array([d.doc_id for d in done], pa.int64()), *(pa.array(counts[:, k]) for k in range(5)), pa.array(digest, pa.string()), *lists],
        names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "pairs_a", "pairs_b", "links"],
    )


def linked_documents(documents: DataFrame, tokenizers: tuple | None = None, piece: int = PIECE, chunk: int = CHUNK, wide: int = WIDE) -> DataFrame:
    """Per row: row (a number of its own), doc_id, counts, digest of the groups, and linked id pairs with their numbers of links."""
    d = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return d.mapInArrow(_documents(tokenizers or default_tokenizers(), piece, chunk, wide), PAIRS)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, documents, best) of exploded pairs: in how many documents a pair is linked, and if no other of its id of A is in more."""
    counts = pairs.groupBy("pair").agg(F.count("*").alias("documents"))
    a = F.shiftright("pair", 32)
    best = counts.groupBy(a.alias("a")).agg(F.max("documents").alias("most"))
    return counts.withColumn("a", a).join(best, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def count_links(documents: DataFrame, tokenizers: tuple | None = None, broadcast_bytes: int = BROADCAST_BYTES, **sizes) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps."""
    scratch = Scratch(documents.sparkSession, "align")
    docs = scratch.store(linked_documents(documents, tokenizers, **sizes), "documents")
    at = F.posexplode(F.arrays_zip("pairs_a", "pairs_b", "links"))
    pairs = docs.select("row", at.alias("_", "p")).select("row", F.shiftleft(F.col("p.pairs_a").cast("long"), 32).bitwiseOR(F.col("p.pairs_b").cast("long")).alias("pair"), F.col("p.links").alias("links"))
    counts = scratch.store(pair_counts(pairs), "counts")
    kinds, total = counts.agg(F.count("*"), F.coalesce(F.sum("documents"), F.lit(0))).first()

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("documents")).alias("count_sum"))

    room = max(1, broadcast_bytes // PAIR_BYTES)
    if kinds <= room:
        sums = summed(pairs.join(F.broadcast(counts), "pair"))
    else:
        # Fewer than `room` pairs can be in more than total / room documents each.
        often = scratch.store(counts.filter(F.col("documents") > total // room), "often")
        rare = counts.filter(F.col("documents") <= total // room)
        held = sized_broadcast(often, often.count(), PAIR_BYTES)
        rest = pairs.join(held.select("pair"), "pair", "left_anti")
        sums = summed(pairs.join(held, "pair")).union(summed(rest.join(rare, "pair")))
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    out = docs.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_overlaps").join(sums, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", "n_overlaps")
