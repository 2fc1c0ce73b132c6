"""Re-Pair grammars of word sequences, built for many texts at once in numpy.

Re-Pair replaces the most frequent pair of neighbouring symbols by a new nonterminal until no pair occurs
twice. Here a round replaces, side by side, every pair that is more frequent than the pairs it overlaps
with; the most frequent pair of all is among them, so every round makes progress. All texts of a slice share
one grammar; a symbol of its own ends each text, so no pair reaches into the next one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Grammar:
    """Rules and what is left of the sequence.

    Rule r stands for words ``start[r]:stop[r]`` of its first derivation, its two parts meet at ``middle[r]``.
    ``rule``/``at`` list every derivation of every rule: all its places in the words. ``left`` holds the
    start of every symbol that is left in the axiom.
    """

    start: np.ndarray
    middle: np.ndarray
    stop: np.ndarray
    rule: np.ndarray
    at: np.ndarray
    left: np.ndarray


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of equal keys, in key order, and how often each occurs."""
    _, numbers, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return numbers, counts


def _offsets(same: np.ndarray) -> np.ndarray:
    """Place of each element in its stretch; ``same[i]`` tells that element i continues the one before."""
    n = len(same)
    heads = np.where(same, 0, np.arange(n))
    return np.arange(n) - np.maximum.accumulate(heads)


def grammar(words: np.ndarray) -> Grammar:
    """The grammar of ``words``, numbers below 2^31. Words that occur once are never replaced."""
    symbols = words.astype(np.int64)
    at = np.arange(len(symbols))
    following = int(symbols.max()) + 1 if len(symbols) else 0
    alive = np.ones(max(len(symbols) - 1, 0), bool)  # pairs that may occur twice
    rules: list[tuple[np.ndarray, ...]] = []
    rule, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    made, end = 0, len(words)
    while alive.any():
        live = np.flatnonzero(alive)
        number, _ = _numbered(symbols[live] << 32 | symbols[live + 1])
        # Pairs of one symbol overlap themselves; every other one of a stretch counts.
        same = np.zeros(len(live), bool)
        same[1:] = (number[1:] == number[:-1]) & (live[1:] == live[:-1] + 1)
        counted = _offsets(same) % 2 == 0
        counts = np.bincount(number[counted], minlength=int(number.max()) + 1)
        twice = counts[number] >= 2
        alive[live[~twice]] = False
        live, number, counted = live[twice], number[twice], counted[twice]
        if not len(live):
            break
        # Rank of a pair: by frequency, then by number. Dead pairs rank below all.
        rank = np.full(len(alive) + 2, -1, np.int64)
        rank[live + 1] = counts[number] * (len(counts) + 1) + number
        mine, before, after = rank[live + 1], rank[live], rank[live + 2]
        chosen = counted & (mine >= before) & (mine >= after)
        # One pair of a stretch may have lost to its neighbour, and a pair may be left with one place.
        chosen &= np.bincount(number[chosen], minlength=len(counts))[number] >= 2
        first, number = live[chosen], number[chosen]
        kinds, heads, number = np.unique(number, return_index=True, return_inverse=True)
        stop = np.append(at, end)[first + 2]
        rules.append((at[first[heads]], at[first[heads] + 1], stop[heads]))
        rule.append(made + number)
        places.append(at[first])
        symbols[first] = following + number
        following, made = following + len(kinds), made + len(kinds)
        keep, fresh = np.ones(len(symbols), bool), np.zeros(len(symbols), bool)
        keep[first + 1], fresh[first] = False, True
        fresh, alive = fresh[keep], np.append(alive, False)[keep][:-1]
        # The pairs on both sides of a new symbol are new; all others are as they were.
        alive |= fresh[:-1] | fresh[1:]
        symbols, at = symbols[keep], at[keep]
    bounds = [np.concatenate(c) for c in zip(*rules)] if rules else [np.zeros(0, np.int64)] * 3
    return Grammar(*bounds, np.concatenate(rule), np.concatenate(places), at)
