"""Words and word shingles of UTF-8 texts, hashed with numpy inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multipliers, one per position in a shingle.
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD],
    dtype=np.uint64,
)

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_LOWERED = np.frombuffer(_LOWER, dtype=np.uint8)
_IN_WORD = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])


class _WordHashes(dict):
    """64-bit hash of a word; bounded so a task's memory is."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def words(text: bytes, lower: bool = True) -> list[bytes]:
    """Maximal runs outside ``[\\x20\\x09-\\x0D]`` (what ``bytes.split`` splits
    at); A-Z lower-cased, other letters as they are."""
    return (text.translate(_LOWER) if lower else text).split()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, ws), dtype=np.uint64, count=len(ws))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sequence(ws: list[bytes], k: int = 5) -> np.ndarray:
    """Hash of each k consecutive words, in text order; with fewer words the
    whole sequence is one shingle; without words none."""
    if not ws:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(ws)
    n = len(ws)
    if n < k:
        # its own family of hashes: a short sequence equals no full shingle
        out = np.array([n], dtype=np.uint64)
        for x in h:
            out = mix(out * _MIX[0] + x)
        return out
    m = n - k + 1
    acc = h[:m] * _MIX[0]
    for i in range(1, k):
        acc = acc + mix(h[i : i + m] + np.uint64(i)) * _MIX[i % len(_MIX)]
    return mix(acc)


def shingle_set(ws: list[bytes], k: int = 5) -> np.ndarray:
    return np.unique(shingle_sequence(ws, k))


# ---- many texts at once --------------------------------------------------------

#: The constants of xxh64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
#: Positions taken at once, which the processor's cache holds, and bytes of text.
_BLOCK, TOGETHER = 1 << 15, 1_000_000


def _rotl(h: np.ndarray, n: int) -> np.ndarray:
    return (h << np.uint64(n)) | (h >> np.uint64(64 - n))


def _xxh64(raw: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """xxh64 of the ``size`` (under 32) bytes at each of ``at``; at least 8 bytes
    follow the last of ``raw`` that is read."""
    lanes = np.ndarray(len(raw) - 7, dtype="<u8", buffer=raw, strides=(1,))
    h = np.full(len(at), _P5 + np.uint64(size), dtype=np.uint64)
    if size >= 8:
        for o in range(0, size - 7, 8):
            h = _rotl(h ^ (_rotl(lanes[at + o] * _P2, 31) * _P1), 27) * _P1 + _P4
    o = size & ~7
    if size > o:
        rest = lanes[at + o]
        if size & 4:
            h = _rotl(h ^ ((rest & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
            rest >>= np.uint64(32)
        for _ in range(size & 3):
            h = _rotl(h ^ ((rest & np.uint64(0xFF)) * _P5), 11) * _P1
            rest >>= np.uint64(8)
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def text_word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the hashes of the lower-cased words of all texts, the words of each
    text), as ``word_hashes`` gives them text by text."""
    joined = np.frombuffer(b" ".join([b"", *texts, b" " * 8]), dtype=np.uint8)
    raw = _LOWERED[joined]
    inside = _IN_WORD[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, size = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    counts = np.diff(np.searchsorted(start, ends), prepend=0)
    out = np.empty(len(start), dtype=np.uint64)
    kind = np.minimum(size, 32).astype(np.uint8)
    order = np.argsort(kind, kind="stable")
    a = 0
    for n, many in enumerate(np.bincount(kind, minlength=33).tolist()):
        for b in range(a, a + many, _BLOCK):
            i = order[b : min(b + _BLOCK, a + many)]
            if n < 32:
                out[i] = _xxh64(raw, start[i], n)
            else:
                out[i] = [xxhash.xxh64_intdigest(raw[s : s + m]) for s, m in zip(start[i].tolist(), size[i].tolist())]
        a += many
    return out, counts


def shingle_sequences(texts: list[bytes], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(the shingles of all texts one after another, how many each text has), as
    ``shingle_sequence`` gives them for the lower-cased words of each text."""
    parts = [_sequences(texts[a:b], k) for a, b in slices(texts, TOGETHER)] or [_sequences([], k)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _sequences(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    h, counts = text_word_hashes(texts)
    n = len(h)
    seq = np.empty(n, dtype=np.uint64)
    for a in range(0, n - k + 1, _BLOCK):
        m = min(_BLOCK, n - k + 1 - a)
        acc = h[a : a + m] * _MIX[0]
        for i in range(1, k):
            acc += mix(h[a + i : a + i + m] + np.uint64(i)) * _MIX[i % len(_MIX)]
        seq[a : a + m] = mix(acc)
    end = np.cumsum(counts)
    full = np.arange(n) + k <= np.repeat(end, counts)
    # a text of fewer words is one shingle, which takes the place of its first word
    for t in np.flatnonzero((counts > 0) & (counts < k)).tolist():
        a, m = int(end[t] - counts[t]), int(counts[t])
        out = np.array([m], dtype=np.uint64)
        for x in h[a : a + m]:
            out = mix(out * _MIX[0] + x)
        seq[a], full[a] = out[0], True
    return seq[full], np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))


def shingle_sets(texts: list[bytes], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(the sorted distinct shingles of each text one after another, how many
    each text has), as ``shingle_set`` gives them."""
    flat, sizes = shingle_sequences(texts, k)
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        flat[a:b].sort()
    head = np.ones(len(flat), dtype=bool)
    np.not_equal(flat[1:], flat[:-1], out=head[1:])
    head[(ends - sizes)[sizes > 0]] = True
    return flat[head], np.diff(np.concatenate([[0], np.cumsum(head)])[ends], prepend=0)


#: Bytes of text that a task looks at together.
SLICE = 4_000_000


def slices(texts: list[bytes], most: int = SLICE):
    """(from, to) of runs of texts of about ``most`` bytes, at least one text each."""
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= most):
            size += len(texts[b])
            b += 1
        yield a, b
        a = b
