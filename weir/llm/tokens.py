"""Token ids of whole texts with a ``tokenizers`` file, word by word.

A text's ids are the ids of its white-space separated words in order, for
tokenizers that never merge across white space. Each distinct word of a batch
is encoded once; words that end in ASCII sentence punctuation after an ASCII
letter share the encoding of their body (``split_tail``). ``word_level``
tells whether a tokenizer file allows this; otherwise whole texts are encoded.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np

#: Texts are encoded in slices of about this many characters.
SLICE_CHARS = 4_000_000
_CACHE_WORDS = 500_000
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def word_level(path: str) -> bool:
    """Whether the file's pre-tokenizer drops white space (an inverted split
    on a pattern without a white-space branch, as word-end BPE files have)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    drops = any(
        s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert") and "[^\\s" in s["pattern"].get("Regex", "")
        for s in steps
    )
    no_added_space = not any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", []))
    prefixed = any(s.get("type") == "ByteLevel" and s.get("add_prefix_space") for s in steps)
    return drops and no_added_space and not prefixed


class _Codes(dict):
    """Number of each word, given out in the order in which words first come;
    ``new`` collects the words that came since it was emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Encoder:
    """Encodes texts with a tokenizer file; keeps the ids of about
    ``_CACHE_WORDS`` words between batches, those that most slices held."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.by_word = word_level(path)
        vocab = self.tok.get_vocab(with_added_tokens=False)
        with open(path, encoding="utf-8") as f:
            suffix = json.load(f)["model"].get("end_of_word_suffix")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self._reset()

    def _reset(self) -> None:
        self.code = _Codes()
        self.lens = np.zeros(1024, dtype=np.int64)
        self.starts = np.zeros(1024, dtype=np.int64)
        self.slices = np.zeros(1024, dtype=np.int64)
        self.pool = np.zeros(1 << 14, dtype=np.uint32)
        self.used = 0

    def _forget(self) -> None:
        """Keep the half of the cache that most slices held."""
        words = list(self.code)
        keep = np.sort(np.argsort(-self.slices[: len(words)], kind="stable")[: _CACHE_WORDS // 2])
        lens, slices = self.lens[keep], self.slices[keep]
        pool = self.pool[_ranges(self.starts[keep], lens)]
        self.code = _Codes()
        self.code.update((words[k], i) for i, k in enumerate(keep.tolist()))
        self.lens, self.starts, self.slices = lens, np.cumsum(lens) - lens, slices
        self.pool, self.used = pool, len(pool)

    def _encode(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all items one after another, length of each)."""
        got = [e.ids for e in self.tok.encode_batch_fast(items, add_special_tokens=False)]
        lens = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        return np.fromiter(chain.from_iterable(got), dtype=np.uint32, count=int(lens.sum())), lens

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only, in one text: each is one
        pre-token, whose last id is a word end."""
        flat = np.array(self.tok.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype=np.uint32)
        last = np.flatnonzero(self.ends[flat])
        if len(last) != len(words) or (len(flat) and last[-1] != len(flat) - 1):
            return self._encode(words)
        return flat, np.diff(last, prepend=-1)

    def _add(self, new: list[str]) -> None:
        """Ids of words whose numbers follow those of the words already known."""
        # parts: letters only count from 0 up, others from -1 down
        body, tail = [], []
        letters: dict[str, int] = {}
        others: dict[str, int] = {}

        def part(w: str) -> int:
            return letters.setdefault(w, len(letters)) if w.isalpha() else others.setdefault(w, -1 - len(others))

        for w in new:
            b, t = split_tail(w)
            body.append(part(b))
            tail.append(others.setdefault(t, -1 - len(others)) if t else 0)
        one, two = self._encode_words(list(letters)) if letters else self._encode([]), self._encode(list(others))
        flat, lens = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
        starts = np.cumsum(lens) - lens
        body, tail = np.array(body), np.array(tail)
        has = tail < 0
        body = np.where(body < 0, len(letters) - 1 - body, body)
        tail = np.where(has, len(letters) - 1 - tail, 0)
        n_body, n_tail = lens[body], np.where(has, lens[tail], 0)
        size = n_body + n_tail
        at = self.used + np.cumsum(size) - size
        n, to = len(self.code) - len(new), self.used + int(size.sum())
        if len(self.code) > len(self.lens):
            grow = max(len(self.code), 2 * len(self.lens))
            self.lens, self.starts = np.resize(self.lens, grow), np.resize(self.starts, grow)
            self.slices = np.resize(self.slices, grow)
        if to > len(self.pool):
            self.pool = np.resize(self.pool, max(to, 2 * len(self.pool)))
        self.pool[_ranges(at, n_body)] = flat[_ranges(starts[body], n_body)]
        self.pool[_ranges(at + n_body, n_tail)] = flat[_ranges(starts[tail], n_tail)]
        self.lens[n : len(self.code)], self.starts[n : len(self.code)] = size, at
        self.slices[n : len(self.code)] = 0
        self.used = to

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text, without special tokens."""
        out: list[np.ndarray] = []
        a = 0
        while a < len(texts):
            b, chars = a, 0
            while b < len(texts) and (b == a or chars + len(texts[b]) <= SLICE_CHARS):
                chars += len(texts[b])
                b += 1
            out += self._slice(texts[a:b])
            a = b
        return out

    def _slice(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch(texts, add_special_tokens=False)]
        ws = [space_split(t) for t in texts]
        sizes = np.fromiter(map(len, ws), dtype=np.int64, count=len(ws))
        try:
            if len(self.code) > _CACHE_WORDS:
                self._forget()
            c = np.fromiter(map(self.code.__getitem__, chain.from_iterable(ws)), dtype=np.int64, count=int(sizes.sum()))
            if self.code.new:
                self._add(self.code.new)
                self.code.new = []
        except BaseException:
            self._reset()  # words may have numbers and no ids
            raise
        held = np.zeros(len(self.code), dtype=bool)
        held[c] = True
        self.slices[: len(held)] += held
        lens = self.lens[c]
        ids = self.pool[_ranges(self.starts[c], lens)]
        upto = np.append(0, np.cumsum(lens))
        return np.split(ids, upto[np.cumsum(sizes)[:-1]])


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each length, one after another."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def space_split(text: str) -> list[str]:
    """Split at white space. ``str.split`` splits at what Unicode calls white
    space and at 0x1c-0x1f, which the tokenizer keeps."""
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return [w for w in text.translate(_SPACES).split(" ") if w]
    return text.split()


_SPACES = {9: " ", 10: " ", 11: " ", 12: " ", 13: " "}
_TAIL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def split_tail(word: str) -> tuple[str, str]:
    """(body, trailing ASCII punctuation) where the pre-tokenizer always cuts
    between them: after a letter, before a run of punctuation that ends the
    word. Lower-cased when the word is Latin-1, as the tokenizer does; what may
    hold a special token stays whole."""
    if "<|" in word:
        return word, ""
    if word.isascii() or max(word) < "\u0100":
        word = word.lower()
    if word.isalpha():
        return word, ""
    body = word.rstrip(_TAIL)
    if body and len(body) < len(word) and body[-1].isascii() and body[-1].isalpha():
        return body, word[len(body) :]
    return word, ""
