"""Prediction by partial matching over packed byte contexts.

A gram is a context of ``order`` bytes and the byte that follows, packed into one
integer of ``8 * (order + 1)`` bits; texts are framed by bytes that UTF-8 never has.
The counts of all grams are the context trie: a shorter context's counts are the
sums over the bytes before it.
"""

from __future__ import annotations

import numpy as np

#: Start and end of a text; not a byte of UTF-8.
FRAME = 0xFF
SYMBOLS = 256


def grams(text: bytes, order: int) -> np.ndarray:
    """The gram of every byte of the text and of its end."""
    framed = np.frombuffer(bytes([FRAME]) * order + text + bytes([FRAME]), dtype=np.uint8)
    packed = np.zeros(len(text) + 1, dtype=np.int64)
    for place in range(order + 1):
        packed = (packed << 8) | framed[place : place + len(packed)]
    return packed


def _sums(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1 if len(codes) else 0))
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


class Level:
    """One context length of the trie: its grams, and total and kinds by context."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = _sums(codes, counts)
        context = self.codes >> 8
        self.contexts, self.totals = _sums(context, self.counts)
        self.kinds = _sums(context, np.ones(len(context), dtype=np.int64))[1]

    @staticmethod
    def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted), dtype=np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0)

    def count(self, grams_: np.ndarray) -> np.ndarray:
        return self._look(self.codes, self.counts, grams_)

    def context(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (
            self._look(self.contexts, self.totals, contexts),
            self._look(self.contexts, self.kinds, contexts),
        )


def levels(codes: np.ndarray, counts: np.ndarray, longest: int, shortest: int) -> list[Level]:
    """Levels of context length ``longest`` down to ``shortest``, by dropping first bytes."""
    made = []
    for length in range(longest, shortest - 1, -1):
        made.append(Level(codes & ((1 << (8 * (length + 1))) - 1), counts))
    return made


def log_probabilities(wanted: np.ndarray, trie: list[tuple[int, Level]]) -> np.ndarray:
    """log10 probability of each wanted gram under escape method C with exclusion.

    ``trie`` has (context length, level) from the longest context to length 0. In a
    context with total n and k kinds of followers a follower seen c times has
    probability c / (n + k); the escape has k / (n + k) and leads to the next shorter
    context, where the followers of the longer one are excluded: each of them was seen
    there too, and their counts leave the total. Below length 0 the bytes not yet
    seen are equally likely.
    """
    log_p = np.zeros(len(wanted))
    open_ = np.ones(len(wanted), dtype=bool)
    # Of the next longer context: its level and the context of each wanted gram.
    longer: Level | None = None
    before = np.zeros(len(wanted), dtype=np.int64)
    left = np.full(len(wanted), SYMBOLS, dtype=np.int64)
    for length, level in trie:
        grams_ = wanted & ((1 << (8 * (length + 1))) - 1)
        context = grams_ >> 8
        count = level.count(grams_)
        total, kinds = level.context(context)
        if longer is not None:
            gone, gone_kinds = _excluded(longer, level, before, length)
            total, kinds = total - gone, kinds - gone_kinds
        here = open_ & (kinds > 0)
        hit = here & (count > 0)
        denominator = np.maximum(total + kinds, 1)
        log_p[hit] += np.log10(count[hit] / denominator[hit])
        miss = here & ~hit
        log_p[miss] += np.log10(kinds[miss] / denominator[miss])
        open_ &= ~hit
        left = SYMBOLS - level.context(context)[1]
        longer, before = level, context
    log_p[open_] -= np.log10(np.maximum(left[open_], 1))
    return log_p


def _excluded(
    longer: Level, level: Level, contexts: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """What the followers of the longer contexts take off the shorter one's total."""
    if not len(longer.codes):
        zero = np.zeros(len(contexts), dtype=np.int64)
        return zero, zero
    shorter = level.count(longer.codes & ((1 << (8 * (length + 1))) - 1))
    keys, sums = _sums(longer.codes >> 8, shorter)
    return Level._look(keys, sums, contexts), longer.context(contexts)[1]
