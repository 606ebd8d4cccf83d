"""Exact, cached encoding with a public word-level BPE tokenizer.

The tokenizer lower-cases, drops white space and never merges across it, so
a text's ids are the ids of its white-space separated words in order.  Words
repeat, so a worker keeps the ids of the words it has met and asks the
tokenizers library only for new ones.  Whatever is not plainly covered by
that reasoning (control characters, unusual scripts, combining marks,
special-token text) goes to the library as a whole.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from itertools import compress

import numpy as np

#: Words, and word parts, kept by one worker (some 150 MB each at most); then that
#: cache starts anew.  Results don't depend on it.
CACHE_WORDS = 1_000_000
#: Bits of the filter of words met once: only a word met again enters the cache.
MET_BITS = 1 << 24
VOCABULARY = 49_408

_ODD_SPACE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0  -⁯　﻿]")
# ASCII and the letters of Latin-1 and Latin Extended-A, but for the dotted capital I
_PLAIN = re.compile("[!-~À-įı-ſ]*")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ſ]+|[0-9]| |"
                    "[^ a-z0-9À-ÖØ-öø-ſ]+")


class Encoder:
    """ids of texts under the tokenizer file at ``path``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.bytes = _byte_letters()
        self._clear()
        self._clear_parts()

    def _clear(self) -> None:
        self.word: dict[str, int] = {}
        self.met = np.zeros(MET_BITS, bool)
        self.flat = np.zeros(1 << 16, np.uint16)
        self.at = np.zeros(1 << 14, np.int64)
        self.len = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _clear_parts(self) -> None:
        # number 0 is the space that ends a word: it has no ids
        self.part: dict[str, int] = {" ": 0}
        self.part_flat, self.part_at, self.part_len = array("H"), array("q", [0]), array("q", [0])

    def _add_parts(self, parts: list[str]) -> None:
        tokenize, flat, at, size = self.model.tokenize, self.part_flat, self.part_at, self.part_len
        for p in parts:
            self.part[p] = len(self.part)
            # printable ASCII stands for itself
            ids = [t.id for t in tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(self.bytes))]
            at.append(len(flat))
            size.append(len(ids))
            flat.extend(ids)

    def _plain_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain words, one after the other, and how many each has."""
        parts = _PARTS.findall(" ".join(words).lower())
        self._add_parts([p for p in dict.fromkeys(parts) if p not in self.part])
        k = np.array(list(map(self.part.__getitem__, parts)), np.int64)
        # copies: an array that is looked into can't grow
        at, size, flat = (np.array(x) for x in (self.part_at, self.part_len, self.part_flat))
        n = size[k]
        return _gather(flat, at[k], n), np.bincount(np.cumsum(k == 0), n, len(words)).astype(np.int64)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and how many each has."""
        plain = [_PLAIN.fullmatch(w) is not None and "<|" not in w for w in words]
        n, is_plain = np.zeros(len(words), np.int64), np.array(plain, bool)
        some, odd = list(compress(words, plain)), [w for w, p in zip(words, plain) if not p]
        ids, n[is_plain] = self._plain_ids(some) if some else (np.zeros(0, np.uint16), 0)
        if not odd:
            return ids, n
        whole = [self.tok.encode(w, add_special_tokens=False).ids for w in odd]
        n[~is_plain] = [len(x) for x in whole]
        out, of_plain = np.zeros(int(n.sum()), np.uint16), np.repeat(is_plain, n)
        out[of_plain] = ids
        out[~of_plain] = [t for x in whole for t in x]
        return out, n

    def _new(self, words: list[str]) -> dict[str, int]:
        """Numbers of words that aren't cached.  Those met before, or twice here, enter the cache; the
        others' ids lie behind those of the cache until the next call."""
        times = Counter(words)
        some = list(times)
        bit = np.fromiter(map(hash, some), np.int64, len(some)) % MET_BITS
        again = self.met[bit] | (np.fromiter(times.values(), np.int64, len(some)) > 1)
        self.met[bit] = True
        cached = list(compress(some, again))
        some = cached + list(compress(some, ~again))
        ids, n = self._ids(some)
        first = len(self.word)
        end = first + len(some)
        while end > len(self.at):
            self.at, self.len = (np.concatenate([x, np.zeros(len(x), np.int64)]) for x in (self.at, self.len))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint16)])
        self.flat[self.used: self.used + len(ids)] = ids
        self.len[first: end], self.at[first: end] = n, self.used + np.cumsum(n) - n
        self.used += int(n[: len(cached)].sum())
        self.word.update(zip(cached, range(first, first + len(cached))))
        return dict(zip(some, range(first, end)))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """uint16 ids of whole texts, one after the other, without special
        tokens, and the n + 1 borders between the texts."""
        if len(self.word) > CACHE_WORDS:
            self._clear()
        if len(self.part) > CACHE_WORDS:
            self._clear_parts()
        words: list[str] = []
        n_words, odd = np.zeros(len(texts), np.int64), {}
        for i, text in enumerate(texts):
            if not text:
                continue
            if not text.isprintable() and _ODD_SPACE.search(text):
                odd[i] = np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint16)
                continue
            w = text.split()
            n_words[i] = len(w)
            words += w
        got = list(map(self.word.get, words))
        if None in got:
            new = self._new([w for k, w in zip(got, words) if k is None])
            got = [new[w] if k is None else k for k, w in zip(got, words)]
        k = np.array(got, np.int64)
        n, at = self.len[k], self.at[k]
        end = np.zeros(len(k) + 1, np.int64)
        np.cumsum(n, out=end[1:])
        ids = _gather(self.flat, at, n)
        off = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(n_words, out=off[1:])
        off = end[off]
        if odd:
            parts = [odd.get(i, ids[off[i]: off[i + 1]]) for i in range(len(texts))]
            off = np.cumsum([0, *map(len, parts)])
            ids = np.concatenate(parts)
        return ids, off


def _gather(flat: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs of ``n`` values from ``at`` on, one after the other."""
    end = np.cumsum(n)
    return flat[np.repeat(at - end + n, n) + np.arange(int(n.sum()))]


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level BPE."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; its word cache lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))
