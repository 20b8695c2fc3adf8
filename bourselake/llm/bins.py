"""Packing of one shard: best fit, then a swap-based local search."""

from __future__ import annotations

import numpy as np


def best_fit(sizes: np.ndarray, room: int) -> list[list[int]]:
    """Items by falling size, each into the fullest bin that still has place.

    Bins are kept by free space; a bit per occupied amount finds the tightest one.
    """
    bins: list[list[int]] = []
    by_space: list[list[int]] = [[] for _ in range(room + 1)]
    occupied = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = occupied >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            home = by_space[space].pop()
            if not by_space[space]:
                occupied &= ~(1 << space)
            bins[home].append(item)
        else:
            space, home = room, len(bins)
            bins.append([item])
        space -= size
        if space:
            by_space[space].append(home)
            occupied |= 1 << space
    return bins


def local_search(bins: list[list[int]], sizes: np.ndarray, room: int) -> list[list[int]]:
    """Empty the least filled bins by moves and swaps that raise the sum of squares.

    For a bin with fill a and another with fill b, words d that go from the first to
    the second raise the sum if b + d > a. Tried are: one item against nothing (a
    move), one against a smaller one, two against a smaller one. Of all partners the
    one that ends fullest is taken. A sweep visits the underfull bins from the
    emptiest; the search ends with a sweep that changes nothing. It does end, since the
    sum is a whole number that only rises and never exceeds room times all words.
    """
    home = np.full(len(sizes), -1, dtype=np.int64)
    for number, own in enumerate(bins):
        home[own] = number
    fill = np.array([int(sizes[own].sum()) for own in bins], dtype=np.int64)
    changed = True
    while changed:
        changed = False
        under = np.flatnonzero((fill < room) & (fill > 0))
        for bin_ in under[np.argsort(fill[under], kind="stable")].tolist():
            while fill[bin_] and _improve(bin_, bins, sizes, home, fill, room):
                changed = True
    return [own for own in bins if own]


def _improve(
    bin_: int,
    bins: list[list[int]],
    sizes: np.ndarray,
    home: np.ndarray,
    fill: np.ndarray,
    room: int,
) -> bool:
    """One improving exchange out of ``bin_``; false if there is none."""
    # Items of equal size are alike: one of each size is tried, and two for pairs.
    own, twins = [], {}
    for item in sorted(bins[bin_], key=lambda i: -sizes[i]):
        if own and sizes[own[-1]] == sizes[item]:
            twins.setdefault(own[-1], item)
        else:
            own.append(item)
    given = [[i] for i in own]
    space = room - fill
    space[bin_] = -1
    space[fill == 0] = -1
    for out in given:
        size = int(sizes[out[0]])
        fits = np.flatnonzero(space >= size)
        if len(fits):
            other = int(fits[np.argmax(fill[fits])])
            if fill[other] + size > fill[bin_]:
                _exchange(bin_, other, out, [], bins, sizes, home, fill)
                return True
    for k, i in enumerate(own):
        given += [[i, twins[i]]] if i in twins else []
        given += [[i, j] for j in own[k + 1 :]]
    item_space = space[home]
    for out in given:
        gain = int(sizes[out].sum()) - sizes
        # Partners stay out of reach if the exchange would not raise the sum.
        after = fill[home] + gain
        fits = np.flatnonzero((gain > 0) & (gain <= item_space) & (after > fill[bin_]))
        if len(fits):
            back = int(fits[np.argmax(after[fits])])
            _exchange(bin_, int(home[back]), out, [back], bins, sizes, home, fill)
            return True
    return False


def _exchange(
    a: int,
    b: int,
    out: list[int],
    back: list[int],
    bins: list[list[int]],
    sizes: np.ndarray,
    home: np.ndarray,
    fill: np.ndarray,
) -> None:
    for items, old, new in ((out, a, b), (back, b, a)):
        for item in items:
            bins[old].remove(item)
            bins[new].append(item)
            home[item] = new
            fill[old] -= sizes[item]
            fill[new] += sizes[item]


def pack(sizes: np.ndarray, room: int) -> list[list[int]]:
    """Items of each bin, in order; no bin holds more than ``room``."""
    return local_search(best_fit(sizes, room), sizes, room)
