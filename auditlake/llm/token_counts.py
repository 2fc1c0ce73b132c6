"""Exact token counts by a compiled finite-state transducer of a byte-pair model.

The model's vocabulary and merge order are compiled to a deterministic transducer over characters.
After each character the machine knows the last token of the encoding of what it has read, and the
last tokens at those earlier places from which a longer piece may still grow; that is its state.
Every transition is annotated with the change of the token count. States and transitions are built
when first met and kept in tables.

Why this is exact: a sequence of pieces is the model's encoding if and only if every two neighbours
are the encoding of their joined text. So the last token of a prefix is the one piece that ends it
and agrees with the last token before it, whatever follows.

Where no piece spans two neighbouring characters, the machine is back in its start state. Texts are
cut into chunks of equal size, run side by side. A chunk's state map is constant from its first such
place on; the characters before it (its head) are run from the state in which the chunk before ends.
Maps compose in rounds until every chunk has its incoming state, and the counts of all chunks
are summed by a prefix scan.

Defined cases: a null or empty text has 0 bytes and 0 tokens; texts of any length are counted whole;
equal rows get equal results; an empty table gives an empty result. Columns other than id and text
are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import slices, utf8

SPACE = "▁"
CHUNK = 512
BATCH_BYTES = 1 << 20
# The tables start anew beyond so many entries; counts do not depend on it.
TABLE_ENTRIES = 40_000_000
FEW = 24
_COUNTERS: dict[str, Transducer] = {}


class Vocabulary:
    """Pieces of a sentencepiece BPE model, and how it merges them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, kind = model.normalizer_spec, model.trainer_spec
        plain = not rules.precompiled_charsmap and rules.escape_whitespaces and not rules.remove_extra_whitespaces
        types = proto.ModelProto.SentencePiece
        odd = any(p.type in (types.USER_DEFINED, types.UNUSED) for p in model.pieces)
        if not plain or odd or kind.model_type != proto.TrainerSpec.BPE or kind.treat_whitespace_as_suffix:
            raise ValueError("only BPE models without a normalizer and without user-defined pieces are compiled")
        self.dummy_prefix = rules.add_dummy_prefix
        self.byte_fallback = kind.byte_fallback
        self.score = {p.piece: p.score for p in model.pieces if p.type == types.NORMAL}
        self.longest = max(map(len, self.score))
        long = [p for p in self.score if len(p) > 1]
        self.opened = {p[:n] for p in long for n in range(1, len(p))}
        self.joined = {(a, b) for p in long for a, b in zip(p, p[1:])}
        self.merging = sorted({c for p in long for c in p})
        self._agree: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces of a text: of all neighbours that join to a piece, the best first, then the left."""
        symbols = list(text)
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def agree(self, left: str, right: str) -> bool:
        key = (left, right)
        if key not in self._agree:
            if len(self._agree) > 2_000_000:
                self._agree.clear()
            self._agree[key] = self.merge(left + right) == [left, right]
        return self._agree[key]

    def ids_of(self, char: str) -> int:
        """Tokens of a single character: itself, its bytes, or the unknown token."""
        return 1 if char in self.score or not self.byte_fallback else len(char.encode())


class Transducer:
    """Transitions over character classes. State 0 is the start."""

    START = ("", ((None, 0),))

    def __init__(self, path: str):
        self.vocabulary = v = Vocabulary(path)
        # Characters in no longer piece never merge: one class for each number of tokens they make.
        # The class that makes none stands between texts.
        self.alone = {n: len(v.merging) + n for n in range(5)}
        classes = len(v.merging) + 5
        self.class_of = np.full(0x110000, -1, np.int32)
        for i, char in enumerate(v.merging):
            self.class_of[ord(char)] = i
        self.class_of[ord(" ")] = self.class_of[ord(SPACE)]
        self.meets = np.zeros((classes, classes), bool)
        place = {c: i for i, c in enumerate(v.merging)}
        for a, b in v.joined:
            self.meets[place[a], place[b]] = True
        self.column = np.full(classes, -1, np.int32)
        self._clear()

    def _clear(self):
        self.states = [self.START]
        self.number = {self.START: 0}
        self.column[:] = -1
        self.columns: list[int] = []
        self.next = np.full((1024, 32), -1, np.int32)
        self.emits = np.zeros((1024, 32), np.int8)

    def classes(self, codes: np.ndarray) -> np.ndarray:
        found = self.class_of[codes]
        for code in np.unique(codes[found < 0]):
            self.class_of[code] = self.alone[self.vocabulary.ids_of(chr(code))]
        return self.class_of[codes] if (found < 0).any() else found

    def columns_of(self, classes: np.ndarray) -> np.ndarray:
        for c in np.flatnonzero(np.bincount(classes, minlength=len(self.column)) * (self.column < 0)):
            self.column[c] = len(self.columns)
            self.columns.append(int(c))
        while len(self.columns) > self.next.shape[1]:
            self.next = np.concatenate([self.next, np.full_like(self.next[:, :32], -1)], 1)
            self.emits = np.concatenate([self.emits, np.zeros_like(self.emits[:, :32])], 1)
        return self.column[classes]

    def _compile(self, state: int, column: int):
        """Fill in one transition.

        A state is (open, ends): ``open`` is the longest end of the text that begins a piece, and
        ``ends`` has, for each place in it from which a piece may grow, the last token before that
        place and how many tokens more the text has now. The last place is the end of the text.
        """
        v, c = self.vocabulary, self.columns[column]
        open_text, ends = self.states[state]
        if c >= len(v.merging):
            target, change = self.START, c - len(v.merging)
        else:
            char = v.merging[c]
            last = ends[-1][0]
            if last is not None and (last[-1], char) not in v.joined:
                open_text, ends = self.START
            text = open_text + char
            places = [j for j in range(len(open_text) + 1) if j == len(open_text) or open_text[j:] in v.opened]
            change = None
            for j, (before, more) in zip(places, ends):
                piece = text[j:]
                if (len(piece) == 1 or piece in v.score) and (before is None or v.agree(before, piece)):
                    token, change = piece, (v.ids_of(piece) if len(piece) == 1 else 1) - more
                    break
            grown = [(j, before, more + change) for j, (before, more) in zip(places, ends) if text[j:] in v.opened]
            begin = grown[0][0] if grown else len(text)
            target = (text[begin:], (*((before, more) for _, before, more in grown), (token, 0)))
        number = self.number.setdefault(target, len(self.states))
        if number == len(self.states):
            self.states.append(target)
            if number == len(self.next):
                more = len(self.next) // 4
                self.next = np.concatenate([self.next, np.full_like(self.next[:more], -1)])
                self.emits = np.concatenate([self.emits, np.zeros_like(self.emits[:more])])
        self.next[state, column] = number
        self.emits[state, column] = change

    def step(self, state: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One character for many runs at once: their next states and emitted counts."""
        after = self.next[state, column]
        if (after < 0).any():
            for s, c in set(zip(state[after < 0].tolist(), column[after < 0].tolist())):
                self._compile(s, c)
            after = self.next[state, column]
        return after, self.emits[state, column]

    def run(self, columns: np.ndarray, begin: np.ndarray, stop: np.ndarray, state: np.ndarray, emitted: np.ndarray) -> np.ndarray:
        """Run each stretch [begin, stop) from its state, note what each character emits, and
        return the final states. Longest stretches come first, so that active ones stay together."""
        order = np.argsort(begin - stop, kind="stable")
        at, length, state = begin[order], (stop - begin)[order], state[order].astype(np.int32)
        active, k = int((length > 0).sum()), 0
        while active > FEW:
            here = at[:active] + k
            state[:active], emitted[here] = self.step(state[:active], columns[here])
            k += 1
            active = int(np.searchsorted(-length, -k, "left"))
        for i in range(active):
            s = int(state[i])
            for p in range(int(at[i]) + k, int(at[i] + length[i])):
                c = int(columns[p])
                if self.next[s, c] < 0:
                    self._compile(s, c)
                emitted[p] = self.emits[s, c]
                s = int(self.next[s, c])
            state[i] = s
        final = np.empty_like(state)
        final[order] = state
        return final

    def emitted(self, codes: np.ndarray, between: np.ndarray) -> np.ndarray:
        """What each character of joined texts emits; the characters at ``between`` part texts."""
        if self.next.size > TABLE_ENTRIES:
            self._clear()
        classes = self.classes(codes)
        classes[between] = self.alone[0]
        columns, n = self.columns_of(classes), len(codes)
        emitted = np.zeros(n, np.int8)
        begin = np.arange(0, n, CHUNK)
        stop = np.minimum(begin + CHUNK, n)
        resets = np.flatnonzero(~self.meets[classes[:-1], classes[1:]]) + 1
        resets = np.concatenate([[0], resets, [n]])
        first = np.minimum(resets[np.searchsorted(resets, begin)], stop)
        # From its first reset on, a chunk's map is constant: all chunks run from the start state.
        ends = self.run(columns, first, stop, np.zeros(len(begin), np.int32), emitted)
        # Compose: heads whose incoming state is known are run, until all are.
        known = first < stop
        waiting = np.flatnonzero(first > begin)
        while len(waiting):
            is_ready = known[waiting - 1]
            ready, waiting = waiting[is_ready], waiting[~is_ready]
            out = self.run(columns, begin[ready], first[ready], ends[ready - 1], emitted)
            through = first[ready] == stop[ready]
            ends[ready[through]] = out[through]
            known[ready[through]] = True
        return emitted

    def count(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text of a string column, without special tokens."""
        data, offsets = utf8(column)
        counts = np.zeros(len(offsets) - 1, np.int64)
        prefix = "\n" + (SPACE if self.vocabulary.dummy_prefix else "")
        for low, high in slices(offsets, BATCH_BYTES):
            rows = low + np.flatnonzero(np.diff(offsets[low : high + 1]))
            if not len(rows):
                continue
            texts = [prefix + data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in rows]
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            starts = np.cumsum(lengths) - lengths
            scan = np.append(0, np.cumsum(self.emitted(codes, starts), dtype=np.int64))
            counts[rows] = scan[starts + lengths] - scan[starts]
        return counts


def counter(path: str) -> Transducer:
    """One transducer per model and Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Transducer(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, model: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``. No shuffle."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(batches):
        machine = counter(model)
        for batch in batches:
            texts = batch.column("text")
            _, offsets = utf8(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(machine.count(texts))], ["doc_id", "n_bytes", "n_tokens"]
            )

    counted = given.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
