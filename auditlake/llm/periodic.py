"""Runs of repeated word sequences, found on a Re-Pair grammar.

A run is a longest stretch of words with smallest period q and at least ``max(least, times * q)`` words,
four times q or more. Each lies in one node of the derivation of its text and crosses the boundary of the
two parts there; or it crosses a boundary between symbols of the axiom. So runs are looked for once per
rule, at its boundary and inside its words, and once per boundary of the axiom, inside the text; those of
rules are translated to all places where the rule is derived, and intervals of one period that overlap by
a period are merged.

A run with four periods has two of them, a square, on one side of the boundary. For periods from L to 2L
the word sequences of length L (numbered by doubling) at the boundary and at one period from it are equal;
where they recur at short distances they form a progression, of which only the first and the one with the
same rest can start the second half of a primitive square. All comparisons are of numbers of equal words,
none of hashes.

Defined cases: a null or empty text, or one of white space, has no runs; rows are judged each for itself, so
repeated rows and null ids do no harm; an empty table gives no rows; other columns are passed on.
"""

from __future__ import annotations

from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from auditlake.llm.common import SLICE_BYTES, slices, utf8
from auditlake.llm.repair import grammar

LEAST, TIMES = 6, 4


class Level:
    """Sequences of ``size`` words that occur twice: their numbers, and where each recurs."""

    def __init__(self, size: int, ranks: np.ndarray, starts: np.ndarray):
        """``ranks`` is dense and different at every place that is not in ``starts``."""
        self.size, self.ranks, self.n = size, ranks, len(ranks)
        keys = np.sort(ranks[starts].astype(np.int64) * self.n + starts)
        self.keys, self.places = keys, keys % self.n
        self.gram = keys // self.n
        self.listed = np.empty(self.n, np.int64)
        self.listed[self.places] = np.arange(len(keys))
        joined = np.zeros(len(keys), bool)
        joined[1:] = (self.gram[1:] == self.gram[:-1]) & (2 * np.diff(self.places) <= size)
        # Clusters: occurrences at most half a size apart, which form a progression.
        heads = np.flatnonzero(~joined)
        self.cluster = np.cumsum(~joined) - 1
        self.first, self.last = heads, np.append(heads[1:], len(keys)) - 1

    def recurring(self, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sequences that start at ``at`` recur less than two sizes on (``step`` 1) or before (-1).

        The second array is their place in the list of occurrences."""
        which = np.flatnonzero(self.ranks[at] >= 0)
        mine = self.listed[at[which]]
        beside = mine + step
        near = (beside >= 0) & (beside < len(self.keys))
        gap = np.abs(self.keys[np.where(near, beside, 0)] - self.keys[mine])
        near &= (gap < 2 * self.size) & (self.gram[np.where(near, beside, 0)] == self.gram[mine])
        return which[near], mine[near]


def levels(words: np.ndarray):
    """A level for each power of two, as long as any sequence occurs twice."""
    size, ranks, starts = 1, words.astype(np.int64), np.arange(len(words))
    while True:
        # Numbers of the sequences that occur twice; all others get numbers of their own below 0.
        _, number, counts = np.unique(ranks[starts], return_inverse=True, return_counts=True)
        twice = counts[number] > 1
        starts, number = starts[twice], number[twice]
        dense = -1 - np.arange(len(words))
        dense[starts] = number
        if not len(starts):
            return
        yield Level(size, dense, starts)
        # A longer sequence occurs twice only if both of its halves do.
        starts = starts[starts + size < len(words)]
        starts = starts[dense[starts + size] >= 0]
        ranks = np.full(len(words), -1, np.int64)
        ranks[starts] = dense[starts] << 32 | dense[starts + size]
        size *= 2


def squares(level: Level, bounds: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(boundary number, first word, period) of squares that start or end at a boundary, inside its limits.

    All primitive ones are among them; equal squares at several boundaries come once for each.
    """
    size, ranks, found = level.size, level.ranks, []

    def keep(which, period, right):
        inside = (period >= size) & (period < 2 * size)
        start = bounds[which] if right else bounds[which] - 2 * period
        inside &= (start + 2 * period <= high[which]) if right else (start >= low[which])
        which, period, start = which[inside], period[inside], start[inside]
        # Both halves are equal if their first and their last ``size`` words are.
        half = start + period
        equal = (ranks[start] == ranks[half]) & (ranks[half - size] == ranks[half + period - size])
        found.append((which[equal], start[equal], period[equal]))

    for right in (True, False):
        which = np.flatnonzero((bounds + 2 * size <= high) if right else (bounds - 2 * size >= low))
        start = bounds[which] if right else bounds[which] - size
        recurs, mine = level.recurring(start, 1 if right else -1)
        which, start = which[recurs], start[recurs]
        gram, own = ranks[start], level.cluster[mine]
        # The nearest occurrence at a distance of ``size`` or more, then cluster after cluster.
        if right:
            there = np.searchsorted(level.keys, gram * level.n + start + size)
        else:
            there = np.searchsorted(level.keys, gram * level.n + start - size, "right") - 1
        while len(which):
            key = level.keys[np.clip(there, 0, len(level.keys) - 1)]
            near = (there >= 0) & (there < len(level.keys)) & (key // level.n == gram)
            near &= np.abs(key % level.n - start) < 2 * size
            which, start, gram, own, there = (x[near] for x in (which, start, gram, own, there))
            cluster = level.cluster[there]
            ends = level.last if right else level.first
            other = cluster != own
            keep(which[other], np.abs(level.places[there] - start)[other], right)
            rest = np.abs(level.places[ends[cluster]] - level.places[ends[own]])
            keep(which[other], rest[other], right)
            there = level.last[cluster] + 1 if right else level.first[cluster] - 1
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3


def stretches(words: np.ndarray, start: np.ndarray, period: np.ndarray, low: np.ndarray, high: np.ndarray):
    """How far the period of each square reaches to both sides, inside its limits."""
    first, stop = np.zeros_like(start), np.zeros_like(start)
    order = np.argsort(period, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(period[order], prepend=-1)), len(order))
    for begin, end in zip(cuts[:-1], cuts[1:]):
        mine = order[begin:end]
        q, floor, ceiling = int(period[mine[0]]), int(low[mine].min()), int(high[mine].max())
        # Places whose word differs from the one a period later; there are none in the first half of a square.
        breaks = floor + np.flatnonzero(words[floor : ceiling - q] != words[floor + q : ceiling])
        breaks = np.concatenate([[floor - 1], breaks, [ceiling - q]])
        place = np.searchsorted(breaks, start[mine])
        first[mine] = np.maximum(breaks[place - 1] + 1, low[mine])
        stop[mine] = np.minimum(breaks[place] + q, high[mine])
    return first, stop


def _merged(start: np.ndarray, stop: np.ndarray, period: np.ndarray):
    """Unions of the intervals of one period that overlap by a period or more, by start, then period."""
    order = np.lexsort((stop, start, period))
    start, stop, period = start[order], stop[order], period[order]
    reach = np.maximum.accumulate(period * (int(stop.max(initial=0)) + 1) + stop) - period * (int(stop.max(initial=0)) + 1)
    opens = np.ones(len(start), bool)
    opens[1:] = (period[1:] != period[:-1]) | (start[1:] + period[1:] > reach[:-1])
    heads = np.flatnonzero(opens)
    if len(heads):
        start, period, stop = start[heads], period[heads], np.maximum.reduceat(stop, heads)
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def find_runs(words: np.ndarray, limits: np.ndarray, least: int = LEAST, times: int = TIMES):
    """Start, stop and period of all runs of several texts, by start, then period.

    Text i is ``words[limits[i] : limits[i + 1] - 1]``; the number after it occurs nowhere else.
    """
    if least < 2 or times < 4:
        raise ValueError("runs have four periods or more")
    made = grammar(words)
    text = np.searchsorted(limits, made.left, "right") - 1
    inner = (made.left > limits[text]) & (made.left < limits[text + 1] - 1)
    left, text = made.left[inner], text[inner]
    bounds = np.concatenate([made.middle, left])
    low = np.concatenate([made.start, limits[text]])
    high = np.concatenate([made.stop, limits[text + 1] - 1])
    long_enough = np.flatnonzero(high - low >= least)
    bounds, low, high = bounds[long_enough], low[long_enough], high[long_enough]

    found = []
    for level in levels(words):
        if 2 * level.size > int((high - low).max(initial=0)):
            break
        which, start, period = squares(level, bounds, low, high)
        first, stop = stretches(words, start, period, low[which], high[which])
        enough = stop - first >= np.maximum(least, times * period)
        found.append((which[enough], first[enough], stop[enough], period[enough]))
    if not found:
        return [np.zeros(0, np.int64)] * 3
    which, first, stop, period = (np.concatenate(c) for c in zip(*found))
    # A stretch has one smallest period; its multiples fit the same words.
    order = np.lexsort((period, stop, first, which))
    which, first, stop, period = which[order], first[order], stop[order], period[order]
    again = np.zeros(len(which), bool)
    again[1:] = (which[1:] == which[:-1]) & (first[1:] == first[:-1]) & (stop[1:] == stop[:-1])
    which, first, stop, period = long_enough[which[~again]], first[~again], stop[~again], period[~again]

    # Runs of rules go to all derivations of the rule.
    of_rule = which < len(made.middle)
    derived = np.argsort(made.rule, kind="stable")
    begin = np.searchsorted(made.rule[derived], which[of_rule])
    count = np.searchsorted(made.rule[derived], which[of_rule], "right") - begin
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    shift = made.at[derived[np.repeat(begin, count) + nth]] - np.repeat(made.start[which[of_rule]], count)
    spread = [np.repeat(x[of_rule], count) for x in (first, stop, period)]
    return _merged(
        np.concatenate([spread[0] + shift, first[~of_rule]]),
        np.concatenate([spread[1] + shift, stop[~of_rule]]),
        np.concatenate([spread[2], period[~of_rule]]),
    )


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _of_texts(texts: list[bytes], least: int, times: int):
    """Per text: its runs (start, length, period), and the words outside all repeated periods."""
    split = [t.split() for t in texts]
    numbers = _Numbers()
    sizes = np.array([len(s) for s in split], np.int64)
    limits = np.append(0, np.cumsum(sizes + 1))
    words = np.empty(int(limits[-1]), np.int64)
    ends = limits[1:] - 1
    inside = np.ones(len(words), bool)
    inside[ends] = False
    words[inside] = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
    words[ends] = len(numbers) + np.arange(len(texts))
    start, stop, period = find_runs(words, limits, least, times)
    # How many runs drop each word.
    drops = np.zeros(len(words) + 1, np.int64)
    np.add.at(drops, start + period, 1)
    np.add.at(drops, stop, -1)
    kept = np.cumsum(drops)[:-1] == 0
    upto = np.searchsorted(start, limits)
    for i, own in enumerate(split):
        base, mine = int(limits[i]), slice(upto[i], upto[i + 1])
        if mine.start == mine.stop:
            yield [], b" ".join(own)
        else:
            runs = np.stack([start[mine] - base, stop[mine] - start[mine], period[mine]], 1).tolist()
            yield runs, b" ".join(compress(own, kept[base : base + len(own)].tolist()))


RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """All columns, ``runs`` (by start, then period) and ``collapsed``: the words that no run repeats.

    A word is dropped if any run contains it after that run's first period; the others are joined by spaces.
    Columns of these names in ``docs`` are replaced.
    """
    given = docs.drop("runs", "collapsed")
    schema = StructType([*given.schema.fields, StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])

    def run(batches):
        fields = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
        for batch in batches:
            column = batch.column(text_col)
            _, offsets = utf8(column)
            for begin, end in slices(offsets, SLICE_BYTES):
                part = batch.slice(begin, end - begin)
                texts = [t or b"" for t in column.slice(begin, end - begin).cast(pa.large_binary()).to_pylist()]
                found, left = zip(*_of_texts(texts, least, times))
                rows = [tuple(r) for one in found for r in one]
                parts = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3
                counts = np.append(0, np.cumsum([len(one) for one in found]))
                runs = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(fields)))
                collapsed = pa.array(left, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, runs, collapsed], schema.fieldNames())

    return given.mapInArrow(run, schema)
