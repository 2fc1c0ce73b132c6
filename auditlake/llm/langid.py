"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of every labelled text in numpy, per task and language, and sums them
in Spark; only the model (languages x buckets) comes to the driver. The number of buckets is a parameter
that no data changes; a model of more than ``MODEL_BYTES`` (more than 256 languages, with the default
buckets) is refused before it is gathered.

Defined cases: text that is null or has no letter gets ``und`` with score 0, as does every text
when nothing was learned; a null language trains nothing; equal scores go to the language that sorts
first by code point; texts of any length are scored whole, in slices; an empty table gives an empty
result. Columns other than id, text and language are ignored, whatever their names.

The posterior compares the learned languages with each other only. Whether a text is in any of them
is told by its fit: the mean log-probability, in the predicted language, of its trigrams of letters.
``bands`` has the fits of all training texts, each with its own n-grams left out; ``judged`` marks
texts far below them, or nearer to random n-grams than to them. A text without such a trigram has no
fit.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from auditlake.llm.common import boxed, mix, unboxed

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
MODEL_BYTES = 64 << 20
SMOOTHING = 0.5
# Characters worked on at once.
SLICE_CHARS = 1 << 18
UNDETERMINED = "und"
# Fits more than so many deviations below the mean are out; texts that are half in another language stay.
WIDTH = 12
# The deviation of n training texts is trusted to a factor of 1 + FEW_DOCS / n.
FEW_DOCS = 30


@dataclass(frozen=True)
class Model:
    langs: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages
    totals: np.ndarray  # smoothed n-grams per language

    @property
    def buckets(self) -> int:
        return len(self.log_prob)


def features(text: str, buckets: int):
    """Bucket numbers of the n-grams of a lower-cased text, in slices that overlap by n - 1."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    longest = max(ORDERS)
    for begin in range(0, max(len(codes) - longest + 1, 1), SLICE_CHARS):
        part = codes[begin : begin + SLICE_CHARS + longest - 1].astype(np.uint64)
        rolling = np.zeros(len(part), np.uint64)
        found = []
        for n in range(1, longest + 1):
            if len(part) < n:
                break
            rolling = rolling[: len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1 :]
            last = begin + SLICE_CHARS + longest - 1 >= len(codes)
            if n in ORDERS:
                grams = rolling if last else rolling[:SLICE_CHARS]
                found.append(mix(grams + np.uint64(n)) % np.uint64(buckets))
        yield np.concatenate(found).astype(np.int64)


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Per code point: 1 for letters and marks, 2 for white space, else 0."""
    kinds = np.zeros(0x110000, np.uint8)
    for code in range(len(kinds)):
        char = chr(code)
        kinds[code] = 1 if unicodedata.category(char)[0] in "LM" else 2 * char.isspace()
    return kinds


def letter_trigrams(text: str, buckets: int):
    """Bucket numbers, as in ``features``, of the trigrams of letters and white space, in slices."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    prime = np.uint64(0x100000001B3)
    for begin in range(0, len(codes) - 2, SLICE_CHARS):
        part = codes[begin : begin + SLICE_CHARS + 2]
        kind, part = _kinds()[part], part.astype(np.uint64)
        a, b, c = kind[:-2], kind[1:-1], kind[2:]
        pure = (a > 0) & (b > 0) & (c > 0) & ((a == 1) | (b == 1) | (c == 1))
        rolling = (part[:-2][pure] * prime + part[1:-1][pure]) * prime + part[2:][pure]
        yield (mix(rolling + np.uint64(3)) % np.uint64(buckets)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS
) -> Model:
    """Fit on every row with a text and a language."""
    given = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )

    def count(batches):
        # One array per language met in this task; written out as soon as it holds too much.
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def flush():
            for lang, n in docs.items():
                at = np.flatnonzero(counts[lang])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * (len(at) + 1), pa.string()),
                        pa.array(np.append(at, -1), pa.int32()),
                        pa.array(np.append(counts[lang][at], n), pa.int64()),
                    ],
                    ["lang", "bucket", "n"],
                )
            counts.clear()
            docs.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if lang not in docs:
                    if len(docs) >= MODEL_BYTES // (8 * buckets):
                        yield from flush()
                    counts[lang] = np.zeros(buckets, np.int64)
                    docs[lang] = 0
                docs[lang] += 1
                for part in features(text, buckets):
                    counts[lang] += np.bincount(part, minlength=buckets)
        yield from flush()

    summed = (
        given.mapInArrow(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .persist()
    )
    try:
        most = MODEL_BYTES // (4 * buckets)
        per_lang = summed.where("bucket = -1").select("lang", "n").limit(most + 1).collect()
        if len(per_lang) > most:
            raise ValueError(f"more than {most} languages: the model would not fit into {MODEL_BYTES} bytes; use fewer buckets")
        per_lang = sorted((r["lang"].encode(), r["n"]) for r in per_lang)
        langs = [name.decode() for name, _ in per_lang]
        found = summed.where("bucket >= 0").toPandas()  # languages x buckets at most
    finally:
        summed.unpersist()
    grams = np.zeros((buckets, len(langs)))
    place = {lang: i for i, lang in enumerate(langs)}
    grams[found["bucket"].to_numpy(int), found["lang"].map(place).to_numpy(int)] = found["n"]
    totals = grams.sum(0) + SMOOTHING * buckets
    log_prob = np.log(grams + SMOOTHING) - np.log(totals)
    docs = np.array([n for _, n in per_lang], float)
    return Model(langs, np.log(docs / docs.sum()) if len(docs) else docs, log_prob.astype(np.float32), totals)


def score_text(model: Model, text: str | None) -> tuple[str, float]:
    """Most probable language of a whole text and its posterior probability."""
    if not model.langs or text is None or not has_letter(text):
        return UNDETERMINED, 0.0
    total = model.log_prior.copy()
    for part in features(text, model.buckets):
        # The text as a sparse row of counts times the matrix of log-probabilities.
        counts = np.bincount(part, minlength=model.buckets)
        at = np.flatnonzero(counts)
        total += counts[at] @ model.log_prob[at].astype(np.float64)
    weights = np.exp(total - total.max())
    best = int(np.argmax(total))
    return model.langs[best], float(weights[best] / weights.sum())


def labelled(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, which replace columns of those names."""
    given = docs.select(boxed(docs), F.col(f"`{text_col}`").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MODEL_BYTES
    schema = StructType([given.schema["_row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches):
        for batch in batches:
            found = [score_text(shared.value, t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["_row", "lang_pred", "score"],
            )

    scored = given.mapInArrow(run, schema)
    return scored.select(*unboxed(docs.columns, {"lang_pred": F.col("lang_pred"), "score": F.col("score")}))


def fit_text(model: Model, text: str, lang: str, trained: bool) -> tuple[int, float, float]:
    """Number, mean and variance of the log-probabilities of a text's trigrams of letters.

    The n-grams of a text that was trained on as ``lang`` are left out of the model."""
    place = model.langs.index(lang)
    total = model.totals[place]
    if trained:
        own = np.zeros(model.buckets, np.int64)
        for part in features(text, model.buckets):
            own += np.bincount(part, minlength=model.buckets)
        rest = math.log(total - own.sum())
    count, first, second = 0, 0.0, 0.0
    for part in letter_trigrams(text, model.buckets):
        values = model.log_prob[part, place].astype(np.float64)
        if trained:
            values = np.log(np.maximum(np.exp(values) * total - own[part], SMOOTHING)) - rest
        count, first, second = count + len(values), first + values.sum(), second + (values**2).sum()
    mean = first / count if count else -math.inf
    return count, mean, max(second / count - mean**2, 0.0) if count else 0.0


@dataclass(frozen=True)
class Band:
    """Fits of the training texts of one language, and the fit of random n-grams."""

    docs: int
    mean: float
    deviation: float
    within: float  # variance of the log-probabilities in a text
    random: float

    def holds(self, count: int, fit: float) -> bool:
        if not count or fit < (self.mean + self.random) / 2:
            return False
        # Trigrams overlap, so about a third of them are independent.
        deviation = math.sqrt(self.deviation**2 + 3 * self.within / count)
        return fit >= self.mean - WIDTH * (1 + FEW_DOCS / self.docs) * deviation


def bands(labelled: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> dict[str, Band]:
    """The band of every language, over every row that the model was trained on."""
    given = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    shared = labelled.sparkSession.sparkContext.broadcast(model)  # at most MODEL_BYTES

    def run(batches):
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            found = [fit_text(shared.value, t, lang, True) for t, lang in zip(batch.column("text").to_pylist(), langs)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), *[pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.float64(), pa.float64()))]],
                ["lang", "n", "fit", "within"],
            )

    fits = given.mapInArrow(run, "lang string, n bigint, fit double, within double").where("n > 0")
    rows = fits.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.avg("fit").alias("mean"), F.stddev_pop("fit").alias("deviation"), F.avg("within").alias("within")
    ).collect()  # one row per language
    random = dict(zip(model.langs, model.log_prob.mean(0, dtype=np.float64).tolist()))
    return {r["lang"]: Band(r["docs"], r["mean"], r["deviation"], r["within"], random[r["lang"]]) for r in rows}


def judged(docs: DataFrame, model: Model, limits: dict[str, Band], trained, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents with ``lang_pred``, ``score`` and ``fits``, which replace columns of those names.

    ``fits`` is true where the fit is within the band of ``lang_pred``. ``trained`` is a condition: true
    for rows that the model was trained on, with their ``lang_col``."""
    known = F.when(trained, F.col(f"`{lang_col}`").cast("string"))
    given = docs.select(boxed(docs), F.col(f"`{text_col}`").alias("_text"), known.alias("_known"))
    shared = docs.sparkSession.sparkContext.broadcast((model, limits))
    told = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("fits", BooleanType())]

    def judge(text, lang):
        learned, within = shared.value
        best, score = score_text(learned, text)
        if best == UNDETERMINED or best not in within:
            return best, score, False
        count, fit, _ = fit_text(learned, text, best, best == lang)
        return best, score, within[best].holds(count, fit)

    def run(batches):
        for batch in batches:
            found = [judge(t, k) for t, k in zip(batch.column("_text").to_pylist(), batch.column("_known").to_pylist())]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *columns], ["_row", "lang_pred", "score", "fits"])

    scored = given.mapInArrow(run, StructType([given.schema["_row"], *told]))
    return scored.select(*unboxed(docs.columns, {f.name: F.col(f.name) for f in told}))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``lang_pred``, ``score``."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return labelled(given, model).select("doc_id", "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    """True for the quarter of the documents that is never trained on; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
