"""Vector bin packing of documents into training sequences.

A sequence has three limits: tokens, segments and loss-bearing tokens. Pieces are placed by the
dot-product heuristic: into the open sequence goes the piece whose demand has the largest dot
product with what is left of the limits, among those that fit. Where none fits, a document is cut to
fill the rest. Tasks pack what they read, in pools of about ``POOL_TOKENS``; what does not fill a
sequence goes on to the next pool. The last sequences of a task take powers of two of what is left,
so they need no padding.

Defined cases: a null or empty text is its end id alone; a loss count is cut to 0 .. tokens, null is
all tokens; loss-bearing tokens are a document's last ones; repeated rows are packed each; a null id
stays null; an empty table gives an empty result. Columns other than those named are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.token_files import with_end
from auditlake.llm.token_ids import encoder

POOL_TOKENS = 4 << 20


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@dataclass
class Piece:
    """A run of a document's tokens. ``quiet`` of its first tokens bear no loss."""

    item: int
    start: int
    length: int
    quiet: int

    @property
    def loss(self) -> int:
        return max(0, self.length - self.quiet)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        head = Piece(self.item, self.start, length, min(self.quiet, length))
        tail = Piece(self.item, self.start + length, self.length - length, max(0, self.quiet - length))
        return head, tail

    def fitting(self, tokens: int, loss: int) -> int:
        """Tokens of this piece that fit into so many tokens and loss-bearing tokens."""
        return min(self.length, tokens, self.quiet + loss)


class Pool:
    """Pieces by demand (tokens, loss); pieces of equal demand share one entry."""

    def __init__(self):
        self.place: dict[tuple[int, int], int] = {}
        self.stacks: list[list[Piece]] = []
        self.demand = np.zeros((16, 2), np.int64)
        self.alive = np.zeros(16, bool)
        self.tokens = 0

    def add(self, piece: Piece):
        key = (piece.length, piece.loss)
        at = self.place.setdefault(key, len(self.stacks))
        if at == len(self.stacks):
            self.stacks.append([])
            if at == len(self.alive):
                self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)])
                self.alive = np.concatenate([self.alive, np.zeros_like(self.alive)])
            self.demand[at] = key
        self.stacks[at].append(piece)
        self.alive[at] = True
        self.tokens += piece.length

    def take(self, at: int) -> Piece:
        piece = self.stacks[at].pop()
        self.alive[at] = bool(self.stacks[at])
        self.tokens -= piece.length
        return piece

    def best(self, tokens: int, loss: int, limits: Limits, must_fit: bool) -> int | None:
        """Entry with the largest dot product of demand and rest, each over its limit."""
        demand = self.demand[: len(self.stacks)]
        able = self.alive[: len(self.stacks)].copy()
        if must_fit:
            able &= (demand[:, 0] <= tokens) & (demand[:, 1] <= loss)
        if not able.any():
            return None
        score = demand[:, 0] * (tokens / limits.tokens**2) + demand[:, 1] * (loss / max(limits.loss, 1) ** 2)
        return int(np.argmax(np.where(able, score, -1.0)))


def fill(pool: Pool, limits: Limits) -> list[Piece]:
    """One sequence from the pool, cut to fill where no whole piece fits."""
    sequence, tokens, loss = [], limits.tokens, limits.loss
    while tokens and len(sequence) < limits.segments and pool.tokens:
        at = pool.best(tokens, loss, limits, must_fit=True)
        if at is not None:
            piece = pool.take(at)
        else:
            at = pool.best(tokens, loss, limits, must_fit=False)
            piece = pool.take(at)
            length = piece.fitting(tokens, loss)
            if not length:
                pool.add(piece)
                break
            piece, rest = piece.cut(length)
            pool.add(rest)
        sequence.append(piece)
        tokens -= piece.length
        loss -= piece.loss
    return sequence


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces in order, cut into sequences whose lengths are powers of two."""
    total, sequences, queue = sum(p.length for p in pieces), [], pieces[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        need, sequence = total & (1 << bit), []
        while need:
            piece = queue.pop()
            if piece.length > need:
                piece, rest = piece.cut(need)
                queue.append(rest)
            sequence.append(piece)
            need -= piece.length
        if sequence:
            sequences.append(sequence)
    return sequences


def pack_pool(pieces: list[Piece], limits: Limits, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences of a pool, and the pieces left for the next one (none if ``last``)."""
    pool, sequences = Pool(), []
    if limits.tokens < 1 or limits.segments < 1 or limits.loss < 1:
        raise ValueError("limits must be positive")
    for piece in pieces:
        # Whole sequences come off the front of long documents.
        while piece.length > limits.tokens or piece.loss > limits.loss:
            head, piece = piece.cut(piece.fitting(limits.tokens, limits.loss))
            if head.length == limits.tokens:
                sequences.append([head])
            else:
                pool.add(head)
        pool.add(piece)
    while pool.tokens:
        sequence = fill(pool, limits)
        size = sum(p.length for p in sequence)
        if pool.tokens or size == limits.tokens:
            sequences.append(sequence)
        elif last:
            sequences += powers_of_two(sequence)
        else:
            return sequences, sequence
    return sequences, []


SCHEMA = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "loss_tokens bigint, ids array<int>"
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_col: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it is in its document and in its sequence, and its ids.

    ``loss_col`` names the number of a document's last ids that bear loss (all if none). The number
    of a sequence is that of its task times 2^33 plus its place there.
    """
    loss = F.col(loss_col).cast("bigint") if loss_col else F.lit(None).cast("bigint")
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), loss.alias("loss"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode, base, number = encoder(tokenizer), TaskContext.get().partitionId() << 33, 0
        held: list[Piece] = []  # pieces not placed yet, by number of the item
        items: dict[int, tuple] = {}  # id, tokens of the document
        given_items, tokens = 0, 0

        def rows(sequences):
            nonlocal number
            columns = [[] for _ in range(9)]
            for sequence in sequences:
                offset = 0
                for p in sequence:
                    doc_id, ids = items[p.item]
                    own = ids[p.start : p.start + p.length]
                    values = (doc_id, p.start, p.length, zlib.crc32(own.astype("<u4").tobytes()), len(ids), base + number, offset, p.loss)
                    for column, value in zip(columns, values):
                        column.append(value)
                    columns[8].append(own.astype(np.int32) if with_ids else None)
                    offset += p.length
                number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:8]], pa.array(columns[8], pa.list_(pa.int32()))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens", "ids"],
            )

        def emit(last):
            nonlocal held, items, tokens
            sequences, rest = pack_pool(held, limits, last)
            for begin in range(0, len(sequences), 500):
                yield rows(sequences[begin : begin + 500])
            items = {p.item: items[p.item] for p in rest}
            held, tokens = rest, sum(p.length for p in rest)

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column("doc_id").type
            ids, counts = with_end(*encode.encode(batch.column("text")), end_id)
            each = np.split(ids.astype(np.uint16 if encode.vocabulary_size <= 1 << 16 > end_id else np.uint32), np.cumsum(counts)[:-1])
            for doc_id, bearing, own in zip(batch.column("doc_id").to_pylist(), batch.column("loss").to_pylist(), each):
                items[given_items] = (doc_id, own.copy())  # a view would hold the ids of the whole batch
                bearing = len(own) if bearing is None else min(max(bearing, 0), len(own))
                held.append(Piece(given_items, 0, len(own), len(own) - bearing))
                given_items += 1
                tokens += len(own)
                if tokens >= POOL_TOKENS:
                    yield from emit(last=False)
        if held:
            yield from emit(last=True)

    return given.mapInArrow(run, SCHEMA.format(id=kind))
