"""A succinct index over a sequence of small integers, in numpy.

The sequence is made of runs of symbols 1.. closed by 0. Its suffixes are sorted by prefix
doubling, its Burrows-Wheeler transform lies in a wavelet matrix, and every
``step``-th suffix of a run, counted from the run's start, keeps its position.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank: packed words and counts before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(bits.size // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: packed.size] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.zeros(counts.size, np.int64)
        np.cumsum(counts[:-1], out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, low = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << low) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Rank and access over symbols, one bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.depth = max(1, int(largest).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for bit in range(self.depth - 1, -1, -1):
            ones = ((symbols >> bit) & 1).astype(bool)
            self.levels.append((Bits(ones), int(ones.size - np.count_nonzero(ones))))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``i``."""
        start, end = np.zeros_like(i), i
        for bit, (bits, zeros) in zip(range(self.depth - 1, -1, -1), self.levels, strict=True):
            one = ((symbol >> bit) & 1).astype(bool)
            s, e = bits.rank(start), bits.rank(end)
            start = np.where(one, zeros + s, start - s)
            end = np.where(one, zeros + e, end - e)
        return end - start

    def get(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(i)
        for bits, zeros in self.levels:
            one, ones = bits.get(i), bits.rank(i)
            i = np.where(one, zeros + ones, i - ones)
            symbol = symbol * 2 + one
        return symbol


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``, whose last symbol is 0; every 0 is smaller than the next.

    Prefix doubling: suffixes alike in their first k symbols are ordered by the rank of what
    follows. Only groups not yet resolved are sorted again. As no two zeros are alike,
    comparisons end inside a run.
    """
    n, zeros = text.size, np.flatnonzero(text == 0)
    key = text + zeros.size
    key[zeros] = np.arange(zeros.size)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.ones(n, bool)
    first[1:] = ordered[1:] != ordered[:-1]
    slot = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, slot, 0))
    alone = first & np.append(first[1:], True)
    open_, k = slot[~alone], 1
    while open_.size:
        at = order[open_]
        key = rank[at] * n + rank[at + k]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[open_] = at
        first = np.ones(at.size, bool)
        first[1:] = key[1:] != key[:-1]
        rank[at] = np.maximum.accumulate(np.where(first, open_, 0))
        open_ = open_[~(first & np.append(first[1:], True))]
        k *= 2
    return order


class FMIndex:
    def __init__(self, text: np.ndarray, largest: int, step: int = 8):
        """``text``: int64 symbols up to ``largest``, every run closed by 0, also the last."""
        n = text.size
        order = suffix_array(text)
        before = text[order - 1]  # of the first suffix: the last symbol, a 0
        self.start = np.zeros(largest + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=largest + 1), out=self.start[1:])
        self.tree = WaveletMatrix(before, largest)
        run_start = np.zeros(n, np.int64)
        run_start[1:] = np.where(text[:-1] == 0, np.arange(1, n), 0)
        in_run = np.arange(n) - np.maximum.accumulate(run_start)
        kept = (in_run % step == 0)[order]
        self.sampled, self.places = Bits(kept), order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of phrases of one length, a row each."""
        low = self.start[phrases[:, -1]]
        high = self.start[phrases[:, -1] + 1]
        live = np.flatnonzero(low < high)
        for column in range(phrases.shape[1] - 2, -1, -1):
            symbol = phrases[live, column]
            base = self.start[symbol]
            low[live] = base + self.tree.rank(symbol, low[live])
            high[live] = base + self.tree.rank(symbol, high[live])
            live = live[low[live] < high[live]]
            if not live.size:
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes: back inside the run until one whose place is kept."""
        found = np.empty(rows.size, np.int64)
        todo, steps = np.arange(rows.size), 0
        while todo.size:
            here = self.sampled.get(rows)
            done = rows[here]
            found[todo[here]] = self.places[self.sampled.rank(done)] + steps
            rows, todo = rows[~here], todo[~here]
            symbol = self.tree.get(rows)
            rows = self.start[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return found
