"""Token ids of whole texts by a ``tokenizers`` file, with every distinct word encoded once.

For a tokenizer that drops white space and never merges across it, a text's ids are those of its
words in order. Words are runs of bytes other than ASCII white space. A word of Latin letters with
closing punctuation is two parts, since letters and punctuation are never merged; lower-cased letter
parts are encoded many at a time, parted by spaces, and cut apart at the ids that end a word.
"""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from auditlake.llm.common import slices, utf8

LETTER_LINES = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ\n]+")
# One word per line: letters and closing punctuation, or anything else.
WORD_LINE = re.compile("^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)|(.+))$", re.M)
# Bytes of words and parts kept between slices of text, objects and dictionary entries included. Beyond this
# only words that have come again are kept, or none if these take half of it; results do not depend on it.
CACHE_BYTES = 96 << 20
WORD_BYTES, PART_BYTES = 160, 200
_ENCODERS: dict[str, WordEncoder] = {}


class _Numbers(defaultdict):
    """Gives each new key the next number, without a call of Python code for it."""

    def __init__(self, keys=()):
        super().__init__(None, zip(keys, count()))
        self.default_factory = count(len(self)).__next__
        self.seen = len(self)

    def new(self) -> list:
        """The keys since the last call, in order."""
        keys = list(islice(reversed(self), len(self) - self.seen))
        self.seen = len(self)
        return keys[::-1]


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_words = _drops_spaces(spec)
        vocabulary = spec["model"].get("vocab", {})
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.vocabulary_size = 1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])])
        self.ends = np.zeros(self.vocabulary_size, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.has_ends = bool(self.ends.any())
        self._clear()

    def _clear(self):
        self.words, self.parts = _Numbers(), _Numbers([""])
        self.word_parts = np.zeros((0, 2), np.int64)  # numbers of a word's two parts
        self.lengths, self.places = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.uses = np.zeros(0, np.int64)  # of each word, since it was last kept
        self.held = 0

    def _shrink(self):
        """Forget the words that came once, with their parts."""
        kept = np.flatnonzero(self.uses >= 2)
        held = self.held * len(kept) // max(1, len(self.words))
        if 2 * held > CACHE_BYTES:
            self._clear()
            return
        words, parts = list(self.words), list(self.parts)
        used, mapped = np.unique(np.append(0, self.word_parts[kept].ravel()), return_inverse=True)
        self.words, self.parts = _Numbers(words[i] for i in kept.tolist()), _Numbers(parts[i] for i in used.tolist())
        self.word_parts = mapped[1:].reshape(-1, 2)
        lengths = self.lengths[used]
        stops = np.cumsum(lengths)
        self.ids = self.ids[np.repeat(self.places[used] - (stops - lengths), lengths) + np.arange(stops[-1])]
        self.lengths, self.places = lengths, stops - lengths
        self.uses, self.held = np.ones(len(kept), np.int64), held

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, np.uint32) for f in found]

    def _encode_parts(self, parts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of all parts in order, and the number of each.

        Letter parts go to the library in long runs; a run whose ends do not add up, or that holds
        anything else, goes part by part.
        """
        ids, lengths, run, begin = [], [], 1000, 0
        if not self.has_ends or not LETTER_LINES.fullmatch("\n".join(parts)):
            return self._each(parts)
        while begin < len(parts):
            few = parts[begin : begin + run]
            (found,) = self._encode([" ".join(few)])
            counts = np.diff(np.flatnonzero(self.ends[found]), prepend=-1)
            got = ([found], counts) if len(counts) == len(few) else self._each(few)
            ids += got[0]
            lengths.append(got[1])
            begin += run
        return ids, np.concatenate(lengths)

    def _each(self, parts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        found = self._encode(parts)
        return found, np.array([len(f) for f in found], np.int64)

    def _keep(self, encoded: list[np.ndarray], lengths: np.ndarray):
        self.places = np.concatenate([self.places, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, *encoded])

    def _learn(self):
        """Encode the words that were new in this batch: first letter parts, then all others."""
        new = self.words.new()
        if not new:
            return
        text, parts = b"\n".join(new), len(self.parts)
        words = len(new)
        lines = WORD_LINE.findall(text.decode())
        part = self.parts.__getitem__
        pairs = np.zeros((len(lines), 2), np.int64)
        pairs[:, 0] = [part(core.lower()) if core else 0 for core, _, _ in lines]
        if cores := self.parts.new():
            self._keep(*self._encode_parts(cores))
        others = [i for i, (core, closing, _) in enumerate(lines) if closing or not core]
        pairs[others, 1] = [part(lines[i][1] or lines[i][2]) for i in others]
        if rest := self.parts.new():
            self._keep(*self._each(rest))
        self.word_parts = np.concatenate([self.word_parts, pairs])
        # Parts are at most the bytes of their words again.
        self.held += 2 * len(text) + WORD_BYTES * words + PART_BYTES * (len(self.parts) - parts)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column in one array, and the number of each; null is empty."""
        _, offsets = utf8(column)
        found = [self._slice(column.slice(begin, end - begin)) for begin, end in slices(offsets)]
        ids, counts = zip(*found) if found else ((), ())
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *counts])

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_words:
            each = self._encode([t or "" for t in texts.to_pylist()])
            counts = np.array([len(e) for e in each], np.int64)
            return np.concatenate([np.zeros(0, np.uint32), *each]), counts
        if self.held > CACHE_BYTES:
            self._shrink()
        split, counts = _split(texts)
        total = len(split)
        met = split.dictionary_encode()  # distinct words in order
        distinct = met.dictionary.cast(pa.large_binary()).to_pylist()
        numbers = np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))
        words = numbers[met.indices.to_numpy()]
        self._learn()
        known = len(self.words)
        self.uses = np.append(self.uses, np.zeros(known - len(self.uses), np.int64)) + np.bincount(words, minlength=known)
        parts = self.word_parts[words].ravel()
        lengths = self.lengths[parts]
        stops = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.places[parts] - (stops - lengths), lengths) + np.arange(stops[-1] if total else 0)]
        # Ids before each word, so a text's ids are a difference.
        before = np.append(0, stops[1::2])
        last = np.cumsum(counts)
        return ids, before[last] - before[last - counts]


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts end to end, and the number of each text; null has none."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    found = lists.flatten()
    # White space at the ends of a text gives empty words.
    real = pc.greater(pc.binary_length(found), 0)
    row = pc.list_parent_indices(lists).filter(real).to_numpy()
    return found.filter(real), np.bincount(row, minlength=len(texts)).astype(np.int64)


def _drops_spaces(spec: dict) -> bool:
    """Whether the file describes a tokenizer that cuts at white space and drops it."""
    pre = spec.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    split = next((s for s in steps if s.get("type") == "Split"), None)
    special = all(not t["lstrip"] and not t["rstrip"] and not re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    pattern = (split or {}).get("pattern", {}).get("Regex", "")
    kept = split and split.get("behavior") == "Removed" and split.get("invert") and not re.search(r"(?<!\^)\\s", pattern)
    return bool(kept and special and not spec.get("truncation") and not spec.get("padding"))


def encoder(path: str) -> WordEncoder:
    """One encoder per file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
