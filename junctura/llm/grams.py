"""Hashed features of texts, many texts at once.

A text is lower-cased and its white space made single spaces. Its features are
runs of characters anywhere (spaces and signs included, so that beginnings,
middles and ends of words, spelled-out words and signs within words all count),
whole words, pairs of words next to each other or with one between, and the beginning of a word together
with its end. Features are numbers of 52 bits.

Long texts are read in pieces that overlap, so that every run and every pair is
met once; only a word or pair of over ``OVERLAP`` characters that lies across the
edge of a piece counts in parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np

GRAMS = (3, 4, 5, 6, 8)
ENDS = (2, 3, 4)
PIECE = 1 << 18  # characters read at once
OVERLAP = 1 << 12
DOCS = 1 << 12  # texts read at once
BITS = 52
_BASE = 0x9E3779B97F4A7C15
_WORD, _PAIR, _AROUND = 16, 17, 32


class Piece(NamedTuple):
    doc: int
    text: str
    own: int  # features that begin before this place count


def pieces(texts: list[str | None]) -> Iterator[list[Piece]]:
    """Texts in lists of at most ``DOCS`` pieces and about ``PIECE`` characters, numbered within ``texts``."""
    held, size, first = [], 0, 0
    for doc, text in enumerate(texts):
        plain, at = f" {' '.join((text or '').lower().split())} ", 0
        while at < len(plain):
            till = at + PIECE
            if till + OVERLAP < len(plain):
                space = plain.find(" ", till, till + OVERLAP)
                till = space if space >= 0 else till
            else:
                till = len(plain)
            if held and (size + till - at > PIECE + OVERLAP or doc - first >= DOCS):
                yield held
                held, size = [], 0
            first = held[0].doc if held else doc
            own = plain[at : till + OVERLAP]
            held.append(Piece(doc, own if own[-1] == " " else own + " ", till - at))
            size += till - at
            at = till
    if held:
        yield held


def unique(numbers: np.ndarray) -> np.ndarray:
    """Sorted without repetitions."""
    numbers = np.sort(numbers)
    return numbers[np.r_[True, numbers[1:] != numbers[:-1]]] if len(numbers) else numbers


@cache
def _constants() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers of the kinds of feature, and which code points make words."""
    odd = np.random.default_rng(42).integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    back = pow(_BASE, -1, 1 << 64)
    make = lambda b: np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, b, np.uint64)])
    return make(_BASE), make(back)


class Text:
    """Numbers of the features of some pieces."""

    def __init__(self, held: list[Piece]) -> None:
        whole = "".join(p.text for p in held)
        code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(p.text) for p in held])
        ends = np.cumsum(sizes)
        place = np.arange(len(code), dtype=np.int32)
        self.doc = np.repeat(np.array([p.doc - held[0].doc for p in held], np.int32), sizes)
        self.first = held[0].doc
        self.room = np.repeat(ends.astype(np.int32), sizes) - place
        own = np.repeat((ends - sizes + [p.own for p in held]).astype(np.int32), sizes)
        self.room[place >= own] = 0
        self.odd, alnum = _constants()
        with np.errstate(over="ignore"):
            self.value = mixed(code.astype(np.uint64) + np.uint64(_BASE))
        mask = alnum[np.minimum(code, 0x10FFFF)]
        self.begin = np.flatnonzero(mask[1:] & ~mask[:-1]) + 1
        self.end = np.flatnonzero(mask[:-1] & ~mask[1:]) + 1
        counted = self.room[self.begin] > 0
        self.words = np.bincount(self.doc[self.begin[counted]], minlength=int(self.doc[-1]) + 1)

    def _hashed(self) -> np.ndarray:
        """Hash of every word."""
        up, down = _powers(1 << (len(self.value) - 1).bit_length())
        total = np.r_[np.uint64(0), np.cumsum(self.value * up[: len(self.value)])]
        return (total[self.end] - total[self.begin]) * down[self.begin]

    def word_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            return self.doc[self.begin], mixed(self._hashed())

    def families(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, numbers) kind by kind; a place is that of the feature's first character."""
        run, short = self.value, {}
        shift = np.uint64(64 - BITS)
        with np.errstate(over="ignore"):
            for n in range(2, max(GRAMS) + 1):
                run = run[:-1] + self.value[n - 1 :] * np.uint64(pow(_BASE, n - 1, 1 << 64))
                if n in ENDS:
                    short[n] = run
                if n in GRAMS:
                    at = np.flatnonzero(self.room[: len(run)] >= n)
                    yield at, (run[at] * self.odd[n]) >> shift
            hashed = self._hashed()
            at = np.flatnonzero(self.room[self.begin] > 0)
            yield self.begin[at], (hashed[at] * self.odd[_WORD]) >> shift
            for far in (1, 2):
                two = at[at + far < len(hashed)]
                two = two[self.end[two + far] - self.begin[two] <= self.room[self.begin[two]]]
                yield self.begin[two], ((hashed[two] * self.odd[_PAIR + far] + hashed[two + far]) * self.odd[_PAIR]) >> shift
            long = self.end - self.begin
            for a in ENDS:
                for b in ENDS:
                    own = at[long[at] >= a + b]
                    both = short[a][self.begin[own]] * self.odd[_AROUND + a] + short[b][self.end[own] - b]
                    yield self.begin[own], (both * self.odd[_AROUND + 4 * a + b]) >> shift


class Members:
    """Which numbers belong to a sorted list, and where."""

    def __init__(self, sorted_numbers: np.ndarray, bits: int = 20) -> None:
        self.numbers, self.shift = sorted_numbers, np.uint64(BITS - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(sorted_numbers >> self.shift).astype(np.int64)] = True

    def find(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``numbers``, places in the list) of the members."""
        if not len(self.numbers):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hit = np.flatnonzero(self.table[(numbers >> self.shift).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.numbers, numbers[hit]), len(self.numbers) - 1)
        same = self.numbers[at] == numbers[hit]
        return hit[same], at[same]


def counted(texts: list[str | None], members: Members) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, np.ndarray]]:
    """(text, feature, count) of the members in ``texts``, with the number of the first text and the numbers of words, list by list.

    A text that is read in several pieces may come in several lists.
    """
    for held in pieces(texts):
        text = Text(held)
        docs, found = [], []
        for at, numbers in text.families():
            hit, member = members.find(numbers)
            docs.append(text.doc[at[hit]].astype(np.int64))
            found.append(member)
        pair = np.concatenate(docs) * max(1, len(members.numbers)) + np.concatenate(found)
        pair, count = np.unique(pair, return_counts=True)
        yield pair // max(1, len(members.numbers)), pair % max(1, len(members.numbers)), count, text.first, text.words
