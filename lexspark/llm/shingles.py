"""64-bit hashes of word shingles, over whole batches of texts at once."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
#: Bytes of text hashed at once; a longer text is taken in pieces that end at white space.
CHUNK = 1 << 20
_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finisher of the splitmix64 generator: every bit of x moves every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 256) - 1, _BASE)]))
    return _POWERS


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of data, and where each starts."""
    buf = np.frombuffer(data, np.uint8)
    word = ~_WS[buf]
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lens = ends - starts
    first = np.concatenate([[0], np.cumsum(lens)[:-1]])
    place = np.arange(int(lens.sum())) - np.repeat(first, lens)
    values = (buf[word].astype(np.uint64) + np.uint64(1)) * _powers(int(lens.max()))[place]
    return mix(np.add.reduceat(values, first) ^ mix(lens.astype(np.uint64))), starts


def _words_of_long(data: bytes) -> np.ndarray:
    out, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and not _WS[data[end]]:
            end += 1
        out.append(_hash_words(data[at:end])[0])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def word_hashes(texts: list[str | None]):
    """Yields, text by text, the hashes of its words with A-Z lower-cased."""
    held: list[bytes] = []

    def flush():
        bounds = np.cumsum([len(x) + 1 for x in held])
        hashes, starts = _hash_words(b"\n".join(held))
        cuts = np.searchsorted(starts, bounds[:-1]) if len(held) > 1 else []
        yield from np.split(hashes, cuts)
        held.clear()

    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        if held and size + len(data) > CHUNK:
            yield from flush()
            size = 0
        if len(data) > CHUNK:
            yield _words_of_long(data)
            continue
        held.append(data)
        size += len(data) + 1
    if held:
        yield from flush()


_PLACES = mix(np.arange(1, 2 * SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; a shorter text is one shingle; no words, none."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, SHINGLE)
    total = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        total += words[i : n - k + 1 + i] * _PLACES[i]
    return np.unique(mix(total ^ _PLACES[-k]))
