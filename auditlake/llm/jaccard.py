"""Jaccard join of documents on word shingles, by token-combination prefixes.

A document's tokens are its distinct runs of ``WIDTH`` words. All documents order tokens alike: by
the class of their document frequency (powers of two, rare first), then by hash. Documents A and B
with similarity of ``PERCENT`` or more share at least o = ceil(s |A|) tokens, so:

* their smallest shared token is among the first |A| - o + 1 of either (the prefix). If it is rare, both
  index it: every rare token of the prefix is a signature.
* if it is frequent, all tokens they share are. The prefix is then extended to |A| - o + k tokens with
  k = |A| (1 / s - 1) + 2, and they share k tokens of it. Between these lie fewer than k - 1 unshared
  tokens, so two of them are neighbours in both documents: every pair of neighbouring frequent tokens
  of the extended prefix is a signature (a combination of two tokens).

Tokens of one document only are never shared and never indexed. Candidates are verified on whole sets
of 64-bit hashes. Within a signature, documents are compared with a centre first; when links have
merged a group of copies, only pairs of different components are left to compare. So a large group of
copies costs its size. A signature of up to ``CROWD`` documents compares all that are left; documents of
a larger one (texts put together from the same few passages, copies with changes of their own) are not paired by
it, but by combinations of more tokens: of tokens that other documents have too, similar sets differ in at most d,
which is less the more tokens either has alone. So of d // 3 + 1 hash parts of the tokens one differs in two or
fewer, and of five cells of that part three are the same. All choices of three cells of all parts are signatures,
apart for each pair of classes of documents (``sided_signs``): changed copies of one text, no two of them similar,
seldom meet. Parity sketches spare most of the sets. No link between components is lost.

Texts are read by units of documents; frequencies are counted in blocks of hash ranges to which each
unit sends its sorted tokens once. Exact copies (equal words) are one document throughout.

Defined cases: a null or empty text has no tokens and is linked with nothing, like a text without
words; fewer words than ``WIDTH`` are one token; equal rows are linked like others, rows of one id but other words are
their own documents; a null id never is the smallest; an empty table gives an empty result. Columns other than id and text are
ignored, whatever their names.
"""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import Words, boxed, mix, slices, staged, unboxed, utf8
from auditlake.llm.components import components

WIDTH = 5
PERCENT = 80
# Tokens in this many documents or more (a power of two) are frequent.
FREQUENT = 64
UNIT_BYTES = 1 << 20
BLOCK_TOKENS = 1 << 20
LEAST_BLOCKS = 512
CENTRES = 2
# Documents of one signature that are compared with each other by that signature alone.
CROWD = 64
# Cells of a part of the tokens, how many of them may differ, and the choices of cells that are the same.
CELLS, SPARED = 5, 2
CHOICES = list(itertools.combinations(range(CELLS), CELLS - SPARED))
# Classes of sets of one size by the slack their own tokens leave (see ``sided_signs``).
SLACKS = 8
# Signatures of documents of crowds in one Arrow batch.
SIGNS = 1 << 18
# 64-bit words of a document's parity sketch.
SKETCH = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["key_a", "key_b"]


def normalized(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``doc_id``, the words in lower case parted by single spaces, and two hashes of them."""
    lower = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), UPPER, LOWER)
    words = F.btrim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    given = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words.alias("words"), *more)
    return given.select("*", F.xxhash64("words").alias(KEY[0]), F.xxhash64(F.lit("second"), "words").alias(KEY[1]))


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct tokens of each text, sorted by row, then hash."""
    data, offsets = utf8(column)
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for begin, stop in slices(offsets):
        words = Words(data[offsets[begin] : offsets[stop]], offsets[begin : stop + 1] - offsets[begin])
        each = words.hashes
        found, at = words.windows(each, WIDTH)
        row = words.row[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < WIDTH))
        if len(short):
            # The whole sequence, told apart from longer ones by its number of words.
            whole = [mix(np.array([sum(int(h) * 31**i for i, h in enumerate(each[words.first[r] : words.first[r + 1]])) % 2**64 ^ int(words.counts[r])], np.uint64))[0] for r in short]
            found, row = np.append(found, np.array(whole, np.uint64)), np.append(row, short)
        order = np.lexsort((found, row))
        found, row = found[order], row[order]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
        rows.append(row[new] + begin)
        hashes.append(found[new])
    return np.concatenate(rows), np.concatenate(hashes)


def first_of_key(table: pa.Table) -> pa.Table:
    """One row per key of a unit, in order of the keys."""
    a, b = table.column(KEY[0]).to_numpy(), table.column(KEY[1]).to_numpy()
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    return table.take(pa.array(order[new]))


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def unit_tokens(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents of a unit, rows and hashes of their tokens, the unit's distinct tokens and how many
    of its documents have each."""
    table = first_of_key(table)
    row, hashes = shingles(table.column("words"))
    distinct, documents = np.unique(hashes, return_counts=True)
    return table, row, hashes, distinct, documents


def count_classes(units: DataFrame, blocks: int) -> DataFrame:
    """Per unit and block: the frequency class of each of the unit's tokens, in order of hash.

    The class is floor(log2(documents that have the token)). Tokens are told apart by their block and
    32 more bits; a clash only puts a token into a higher class, for all documents alike.
    """

    def send(table: pa.Table) -> pa.Table:
        unit = table.column("unit")[0].as_py()
        _, _, _, distinct, documents = unit_tokens(table)
        block = _block(distinct, blocks).astype(np.int64)
        low = distinct.astype(np.uint32)  # the lower half
        used = np.unique(block)
        begin, stop = np.searchsorted(block, used), np.searchsorted(block, used, "right")
        counts = np.minimum(documents, 2**32 - 1).astype(np.uint32)
        return pa.table(
            {
                "unit": pa.array(np.full(len(used), unit), pa.int64()),
                "block": pa.array(used),
                "tokens": pa.array([low[i:j].tobytes() for i, j in zip(begin, stop)], pa.binary()),
                # Nearly all are 1: only others are sent.
                "many": pa.array([_sparse(counts[i:j]) for i, j in zip(begin, stop)], pa.binary()),
            }
        )

    def classify(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(t, np.uint32) for t in table.column("tokens").to_pylist()]
        weights = [_dense(m, len(p)) for m, p in zip(table.column("many").to_pylist(), parts)]
        tokens, weight = np.concatenate(parts), np.concatenate(weights)
        _, inverse = np.unique(tokens, return_inverse=True)
        total = np.bincount(inverse, weight)
        classes = np.log2(total[inverse]).astype(np.uint8)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        return pa.table(
            {
                "unit": table.column("unit"),
                "block": table.column("block"),
                "classes": pa.array([c.tobytes() for c in np.split(classes, cuts)], pa.binary()),
            }
        )

    sent = units.groupBy("unit").applyInArrow(send, "unit bigint, block bigint, tokens binary, many binary")
    return sent.groupBy("block").applyInArrow(classify, "unit bigint, block bigint, classes binary")


def _sparse(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts > 1).astype(np.uint32)
    return np.concatenate([at, counts[at]]).tobytes()


def _dense(raw: bytes, n: int) -> np.ndarray:
    counts, pairs = np.ones(n), np.frombuffer(raw, np.uint32)
    counts[pairs[: len(pairs) // 2]] = pairs[len(pairs) // 2 :]
    return counts


def signatures(tokens: np.ndarray, classes: np.ndarray, frequent: int = FREQUENT) -> np.ndarray:
    """Signatures of one document from its distinct tokens and their frequency classes."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.uint64)
    overlap = -(-PERCENT * n // 100)
    prefix = n - overlap + 1
    order = np.lexsort((tokens, classes))
    tokens, classes = tokens[order], classes[order]
    is_rare = classes < int(math.log2(frequent))
    single = (classes[:prefix] > 0) & (is_rare[:prefix] | (n == 1))
    found = [mix(tokens[:prefix][single] ^ np.uint64(1))]
    if n > 1 and not is_rare[prefix - 1]:
        combined = min(n * (100 - PERCENT) // PERCENT + 2, overlap)
        part = tokens[: prefix + combined - 1][~is_rare[: prefix + combined - 1]]
        found.append(mix(part[:-1] * np.uint64(3) + mix(part[1:])))
    return np.concatenate(found)


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """64 * SKETCH parity bits: two sets differ in as many tokens as their sketches in bits, or more."""
    bits = np.bincount((mix(tokens) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def indexed(units: DataFrame, classes: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Per document: key, ``n_shingles``, ``signatures`` and, where it has any, ``tokens`` (all tokens
    that other documents have too), their parity ``sketch`` and ``own``, how many tokens it has alone."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        table, row, hashes, distinct, _ = unit_tokens(left)
        ordered = right.sort_by("block").column("classes").to_pylist()
        by_token = np.frombuffer(b"".join(ordered), np.uint8)
        if len(by_token) != len(distinct):
            raise ValueError("a unit's tokens and their classes differ in number")
        each = by_token[np.searchsorted(distinct, hashes)]
        first = np.searchsorted(row, np.arange(table.num_rows + 1))
        signs, kept, sketches, alone = [], [], [], []
        for i in range(table.num_rows):
            own, own_classes = hashes[first[i] : first[i + 1]], each[first[i] : first[i + 1]]
            found = signatures(own, own_classes, frequent)
            signs.append(found.view(np.int64))
            shared = own[own_classes > 0]
            kept.append(shared.view(np.int64) if len(found) else None)
            sketches.append(parity_sketch(shared) if len(found) else None)
            alone.append(len(own) - len(shared))
        return pa.table(
            {
                KEY[0]: table.column(KEY[0]),
                KEY[1]: table.column(KEY[1]),
                "n_shingles": pa.array(np.diff(first), pa.int64()),
                "signatures": pa.array(signs, pa.list_(pa.int64())),
                "tokens": pa.array(kept, pa.list_(pa.int64())),
                "sketch": pa.array(sketches, pa.list_(pa.int64())),
                "own": pa.array(alone, pa.int64()),
            }
        )

    schema = (
        "key_a bigint, key_b bigint, n_shingles bigint, signatures array<bigint>, tokens array<bigint>, "
        "sketch array<bigint>, own bigint"
    )
    return units.groupBy("unit").cogroup(classes.groupBy("unit")).applyInArrow(run, schema)


def size_group(n: int) -> tuple[int, int, int]:
    """Group of a set size, and the largest sizes of this group and of the next: sizes of similar sets are
    in one group or in neighbouring ones."""
    group, low = 0, 1
    while (above := low * 100 // PERCENT + 1) <= n:
        group, low = group + 1, above
    return group, above - 1, above * 100 // PERCENT


@functools.cache
def group_end(group: int) -> int:
    """Largest set size of a group."""
    return size_group(1 if group == 0 else group_end(group - 1) + 1)[1]


def sided_signs(tokens: np.ndarray, n: int, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of which similar sets share one, from opposite sides (-1 and 1, or 0 on both).

    ``n`` is the size of the set, ``tokens`` those of it that other documents have, ``own`` the number of others.
    A set's slack is how many of the tokens that differ between similar sets it allows, less ``own``: ``tokens`` of
    two sets differ in at most the sum of their slacks. Sets of one size group and a like slack are a class; those
    of two classes meet under that pair's bound only, the lower class on side -1 and the higher on side 1."""
    group = size_group(n)[0]
    unit = lambda g: max(100 + PERCENT, (100 - PERCENT) * group_end(g) // SLACKS)
    mine = (group, ((100 - PERCENT) * n - (100 + PERCENT) * own) // unit(group))
    slack = (mine[1] + 1) * unit(group) - 1  # the largest of the class
    hashed = mix(tokens ^ np.uint64(7))
    cell, value = (hashed >> np.uint64(40)) % np.uint64(CELLS), mix(hashed)
    by_parts: dict[int, np.ndarray] = {}

    def chosen(parts: int) -> np.ndarray:
        if parts not in by_parts:
            cells = np.zeros(parts * CELLS, np.uint64)
            np.add.at(cells, ((hashed % np.uint64(parts)) * np.uint64(CELLS) + cell).astype(np.int64), value)
            cells, number = cells.reshape(parts, CELLS), np.arange(parts * len(CHOICES), dtype=np.uint64)
            values = number.reshape(parts, len(CHOICES))
            for same in np.array(CHOICES).T:
                values = mix(values * np.uint64(3) + cells[:, same])
            by_parts[parts] = values.ravel()
        return by_parts[parts]

    signs, sides = [np.zeros(0, np.uint64)], [np.zeros(0, np.int8)]
    for other in range(max(0, group - 1), group + 2):
        # The largest set of that group that can be similar to one with as few shared tokens.
        most, width = min(group_end(other), (100 + PERCENT) * (n - own) // PERCENT - n), unit(other)
        if other and most <= group_end(other - 1):
            continue
        for number in range(-(slack // width) - 2, (100 - PERCENT) * most // width + 1):
            differ = (slack + (number + 1) * width - 1) // (100 + PERCENT)
            if differ < 0:
                continue
            theirs = (other, number)
            low, high = min(mine, theirs), max(mine, theirs)
            name = mix(np.array([(low[0] << 48) + (high[0] << 36) + (low[1] + (1 << 12) << 18) + high[1] + (1 << 12)], np.uint64))
            signs.append(mix(chosen(differ // (SPARED + 1) + 1) + name))
            sides.append(np.full(len(signs[-1]), (mine > theirs) - (mine < theirs), np.int8))
    return np.concatenate(signs), np.concatenate(sides)


def part_signs(tokens: np.ndarray, n: int, own: int = 0) -> np.ndarray:
    """The signatures of ``sided_signs``, whatever their side."""
    return sided_signs(tokens, n, own)[0]


def _with_part_signs(batches):
    """Documents with their signatures, at most ``SIGNS`` of these a batch: there are some twenty for each token.
    A document that has more comes as several rows."""
    for batch in batches:
        each = zip(batch.column("n").to_pylist(), batch.column("own").to_pylist(), batch.column("tokens"))
        rows, found, held = [], [], 0
        for row, (n, own, t) in enumerate(each):
            signs, sides = sided_signs(t.values.to_numpy(zero_copy_only=False).view(np.uint64), n, own)
            for at in range(0, len(signs), SIGNS):
                part = signs[at : at + SIGNS].view(np.int64), sides[at : at + SIGNS]
                if rows and held + len(part[0]) > SIGNS:
                    yield _signed(batch, rows, found)
                    rows, found, held = [], [], 0
                rows.append(row)
                found.append(part)
                held += len(part[0])
        if rows:
            yield _signed(batch, rows, found)


def _signed(batch: pa.RecordBatch, rows: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("node", "n", "own", "comp")]
    signs, sides = pa.array([s for s, _ in found], pa.list_(pa.int64())), pa.array([s for _, s in found], pa.list_(pa.int8()))
    return pa.RecordBatch.from_arrays([*columns, signs, sides], ["node", "n", "own", "comp", "signs", "sides"])


def _near(own_a: Column, sketch_a, own_b: Column, sketch_b, both: Column) -> Column:
    """Whether two documents of ``both`` tokens in all may be similar: those either has alone and the bits in
    which their sketches (a column per word number) differ are no more than similar sets allow."""
    apart = own_a + own_b
    for i in range(SKETCH):
        apart += F.bit_count(sketch_a(i).bitwiseXOR(sketch_b(i)))
    return (100 + PERCENT) * apart <= (100 - PERCENT) * both


def _between(postings: DataFrame) -> DataFrame:
    """Pairs of one signature, opposite sides and different components, once each. Either has enough tokens that
    others have too. Postings with a ``sketch`` make only pairs that their sketches let pass."""
    sketched = ["sketch"] if "sketch" in postings.columns else []
    mine = postings.where("side <= 0").select(
        "sign", "side", "comp", F.col("node").alias("a"), F.col("n").alias("_na"), F.col("own").alias("_own_a"),
        *[F.col(c).alias("_sketch_a") for c in sketched],
    )
    other = postings.where("side >= 0").select(
        "sign", F.col("comp").alias("_bcomp"), F.col("node").alias("b"), F.col("n").alias("_nb"), F.col("own").alias("_own_b"),
        *[F.col(c).alias("_sketch_b") for c in sketched],
    )
    apart = (F.col("comp") < F.col("_bcomp")) | ((F.col("side") < 0) & (F.col("comp") > F.col("_bcomp")))
    shared = F.least(F.col("_na") - F.col("_own_a"), F.col("_nb") - F.col("_own_b"))
    enough = (100 + PERCENT) * shared >= PERCENT * (F.col("_na") + F.col("_nb"))
    met = mine.join(other, "sign").where(apart & enough)
    if sketched:
        words = F.col("_sketch_a"), F.col("_sketch_b")
        met = met.where(_near(F.col("_own_a"), words[0].getItem, F.col("_own_b"), words[1].getItem, F.col("_na") + F.col("_nb")))
    return _sized(met)


def left_over(live: DataFrame, found: DataFrame) -> DataFrame:
    """Candidates among documents of open signatures, but for pairs that differ in too many tokens: those
    either has alone, and those their sketches show."""
    sizes = live.groupBy("sign").agg(F.count(F.lit(1)).alias("_docs"))
    sized = staged(live.join(sizes, "sign").select("sign", F.lit(0).alias("side"), "node", "n", "own", "comp", "_docs"), "left-over")
    pairs = _between(sized.where(F.col("_docs") <= CROWD))
    crowded = sized.where(F.col("_docs") > CROWD).select("node", "comp").distinct()
    tokens = crowded.join(found.select("node", "n", "own", "tokens"), "node")
    signs = tokens.mapInArrow(
        _with_part_signs, "node bigint, n bigint, own bigint, comp bigint, signs array<bigint>, sides array<tinyint>"
    )
    each = F.explode(F.arrays_zip("signs", "sides")).alias("_s")
    named = signs.select("node", "n", "own", "comp", each).select("node", "n", "own", "comp", F.col("_s.signs").alias("sign"), F.col("_s.sides").alias("side"))
    parts = staged(named, "part-signs")
    # A document stays at a signature only if one of another component stands on the opposite side.
    sided = {"_low": F.when(F.col("side") <= 0, F.col("comp")), "_high": F.when(F.col("side") >= 0, F.col("comp"))}
    ends = parts.groupBy("sign").agg(*[f(c).alias(k + e) for k, c in sided.items() for f, e in ((F.min, "_least"), (F.max, "_most"))])
    other = lambda k: (F.col(f"{k}_least") != F.col("comp")) | (F.col(f"{k}_most") != F.col("comp"))
    wanted = ((F.col("side") <= 0) & other("_high")) | ((F.col("side") >= 0) & other("_low"))
    faced = parts.join(ends.withColumnRenamed("sign", "_sign"), (F.col("sign") == F.col("_sign")) & wanted, "left_semi")
    # The sketches come along, so that a pair they rule out is never a row, however many of a crowd meet.
    faced = faced.join(crowded.select("node").join(found.select("node", "sketch"), "node"), "node")
    pairs = pairs.unionByName(_between(faced)).distinct()
    words = [F.col("sketch")[i].alias(f"_w{i}") for i in range(SKETCH)]
    sketches = found.where(F.size("signatures") > 0).select("node", "n", "own", *words)
    left = sketches.withColumnsRenamed({"node": "a", "n": "_na"})
    right = sketches.select(*[F.col(c).alias(f"_b{c}") for c in sketches.columns])
    right = right.withColumnsRenamed({"_bnode": "b", "_bn": "_nb"})
    word_of = lambda prefix: lambda i: F.col(f"{prefix}_w{i}")
    near = _near(F.col("own"), word_of(""), F.col("_bown"), word_of("_b"), F.col("_na") + F.col("_nb"))
    return pairs.join(left, "a").join(right, "b").where(near).select("a", "_na", "b", "_nb")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. Sizes are compared before sets are."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("_n_a"), F.col("tokens").alias("_t_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("_n_b"), F.col("tokens").alias("_t_b"))
    shared = F.size(F.array_intersect("_t_a", "_t_b"))
    enough = 100 * shared >= PERCENT * (F.col("_n_a") + F.col("_n_b") - shared)
    return pairs.join(left, "a").join(right, "b").where(enough).select("a", "b")


def _sized(pairs: DataFrame) -> DataFrame:
    fits = (100 * F.col("_na") >= PERCENT * F.col("_nb")) & (100 * F.col("_nb") >= PERCENT * F.col("_na"))
    return pairs.where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_components(found: DataFrame) -> DataFrame:
    """``node``, ``component`` of linked documents, from ``node``, ``n``, ``signatures``, ``tokens``."""
    sets = found.where(F.size("signatures") > 0).select("node", "n", "tokens")
    postings = staged(
        found.select("node", "n", "own", F.explode(F.array_distinct("signatures")).alias("sign")), "signatures"
    )
    # Signatures of one document only are dropped at once.
    live = postings.withColumn("comp", F.col("node"))
    joined = None
    for centre in range(CENTRES + 1):
        # First the document with the fewest tokens of its own: the least changed copy. Then any one.
        order = F.struct(F.col("own") if centre == 0 else F.lit(0), F.xxhash64(F.lit(centre), "node"))
        spread = live.groupBy("sign").agg(
            F.min("comp").alias("_least"),
            F.max("comp").alias("_most"),
            F.min_by(F.struct("node", "n", "comp"), order).alias("_centre"),
        )
        open_signs = spread.where("_least <> _most").select("sign", "_centre")
        live = staged(live.join(open_signs, "sign"), "open-signatures")
        if centre < CENTRES:
            # Everyone against the centre of the signature.
            pairs = live.where(F.col("_centre.comp") != F.col("comp")).select(
                F.col("node").alias("a"), F.col("n").alias("_na"), F.col("_centre.node").alias("b"), F.col("_centre.n").alias("_nb")
            )
        else:
            pairs = left_over(live, found)
        live = live.drop("_centre")
        more = staged(verified(_sized(pairs), sets), "verified")
        # The stars so far stand for all links so far.
        if joined is not None:
            more = more.unionByName(joined.select(F.col("node").alias("a"), F.col("component").alias("b")))
        joined = components(more)
        live = (
            live.drop("comp")
            .join(joined, "node", "left")
            .withColumn("comp", F.coalesce("component", "node"))
            .drop("component")
        )
    return joined


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """Per row: ``doc_id``, ``key_a``, ``key_b`` (of its words), ``n_shingles``, ``component`` (null for a
    text without words, else the same for linked texts only) and ``component_id``."""
    given = normalized(docs, id_col, text_col)
    members = staged(given.select("doc_id", *KEY, F.octet_length("words").alias("bytes")), "members")
    reps = members.groupBy(*KEY).agg(F.min("doc_id").alias("rep"), F.max("bytes").alias("bytes"))
    total = reps.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    units_wanted = max(1, math.ceil(total / UNIT_BYTES))
    blocks = max(LEAST_BLOCKS, math.ceil(total / 4 / BLOCK_TOKENS))

    def drop_copies(batches):
        # A copy met again in the same task need not travel.
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            new = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    unit = F.pmod(F.xxhash64(*KEY), F.lit(units_wanted)).alias("unit")
    texts = given.where("words <> ''").select(*KEY, "words").mapInArrow(drop_copies, "key_a bigint, key_b bigint, words string")
    units = texts.select(*KEY, "words", unit)
    found = indexed(units, count_classes(units, blocks), frequent)
    # Numbers of their own, fixed by writing them: a hash alone could be that of two texts.
    found = staged(found.withColumnRenamed("n_shingles", "n").withColumn("node", F.monotonically_increasing_id()), "indexed")
    merged = link_components(found)
    classes = (
        found.select(*KEY, "node", "n")
        .join(merged, "node", "left")
        .select(*KEY, "n", F.coalesce("component", "node").alias("component"))
        .join(reps.select(*KEY, "rep"), KEY)
    )
    classes = staged(classes, "classes")
    least = classes.groupBy("component").agg(F.min("rep").alias("_least"))
    classes = classes.join(least, "component").select(*KEY, "n", "component", "_least")
    # Texts without words are in no unit: they are linked with nothing.
    return members.join(classes, KEY, "left").select(
        "doc_id", *KEY, F.coalesce("n", F.lit(0)).cast("bigint").alias("n_shingles"), "component",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    return grouped(docs, **settings).select("doc_id", "n_shingles", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id stays
    (one of them, if rows repeat it). Texts without words all stay."""
    found = staged(grouped(docs, id_col, text_col, **settings), "groups").where("component is not null")
    # Null ids sort behind all others.
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *KEY)
    chosen = found.groupBy("component").agg(F.min(row).alias("_first")).select("_first.*")
    keyed = normalized(docs, id_col, text_col, boxed(docs)).withColumnRenamed("doc_id", "_id")
    no_words = keyed.where("words = ''").select("_row")
    matches = keyed["_id"].eqNullSafe(chosen["doc_id"])
    for k in KEY:
        matches &= keyed[k] == chosen[k]
    stay = keyed.where("words <> ''").join(chosen, matches).select("_row", keyed[KEY[0]], keyed[KEY[1]]).dropDuplicates(KEY)
    return stay.select("_row").unionByName(no_words).select(*unboxed(docs.columns, {}))
