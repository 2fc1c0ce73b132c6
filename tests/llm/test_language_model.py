"""The language model against naive Bayes written out in plain Python."""

import math
from collections import Counter

import pytest

from auditlake.llm import langid

ROWS = [
    (1, "The cat sat on the mat and looked at the rain", "en"),
    (2, "le chat dort sur le tapis près de la fenêtre", "fr"),
    (3, "die Katze schläft auf dem Teppich am Fenster", "de"),
    (4, "A dog and a cat in the garden", "en"),
    (5, "un chien et un chat dans le jardin", "fr"),
    (6, "ein Hund und eine Katze im Garten", "de"),
    (7, "the garden", None),
    (8, "Fenster und Garten", None),
    (9, "É", None),
    (10, "12 34", "en"),
    (11, None, "en"),
    (12, "", "fr"),
    (13, "日本語 garden", None),
]
BUCKETS = 4096
TOP = 2**64


def spread(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor % TOP
    return x ^ x >> 31


def grams(text):
    codes = [ord(c) for c in f" {text.lower()} "]
    found = Counter()
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            key = 0
            for code in codes[i : i + n]:
                key = (key * 0x100000001B3 + code) % TOP
            found[spread((key + n) % TOP) % BUCKETS] += 1
    return found


def brute_force(rows):
    docs, counts = Counter(), {}
    for _, text, lang in rows:
        if text is not None and lang is not None:
            docs[lang] += 1
            counts.setdefault(lang, Counter()).update(grams(text))
    total = {lang: sum(c.values()) + langid.SMOOTHING * BUCKETS for lang, c in counts.items()}
    for doc_id, text, _ in rows:
        if text is None or not any(c.isalpha() for c in text):
            yield doc_id, "und", 0.0
            continue
        logs = {}
        for lang in sorted(counts):
            each = sum(k * math.log((counts[lang][g] + langid.SMOOTHING) / total[lang]) for g, k in grams(text).items())
            logs[lang] = math.log(docs[lang] / sum(docs.values())) + each
        best = max(sorted(logs), key=logs.get)
        yield doc_id, best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")


def test_labels_and_scores_equal_brute_force(spark, monkeypatch):
    docs = frame(spark, ROWS)
    long = frame(spark, [(20, "the garden and the cat " * 60_000, None)])  # over a megabyte
    model = langid.train(docs, buckets=BUCKETS)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs.unionByName(long), model).collect()}
    assert found.pop(20) == ("en", 1.0)
    for doc_id, lang, score in brute_force(ROWS):
        assert found[doc_id] == (lang, pytest.approx(score, abs=1e-4)), doc_id
    assert len(found) == len(ROWS)


def test_of_equal_scores_the_first_language_wins(spark):
    docs = frame(spark, [(1, "same words", "nl"), (2, "same words", "af"), (3, "same words", "is")])
    found = langid.predict(docs, langid.train(docs, buckets=256)).collect()
    assert {(r["lang_pred"], round(r["score"], 6)) for r in found} == {("af", round(1 / 3, 6))}


def test_a_model_that_does_not_fit_is_refused_and_the_rest_keeps_its_buckets(spark, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_BYTES", 3 * 4 * BUCKETS)
    assert langid.train(frame(spark, ROWS), buckets=BUCKETS).buckets == BUCKETS
    with pytest.raises(ValueError, match="more than 3 languages"):
        langid.train(frame(spark, [*ROWS, (30, "kot śpi", "pl")]), buckets=BUCKETS)


def test_the_band_widens_smoothly_with_fewer_texts():
    limits = [langid.Band(n, -5.0, 0.1, 0.0, -30.0) for n in (1, 29, 30, 31, 10**6)]
    lowest = [next(f / 10 for f in range(-50, -400, -1) if not band.holds(10, f / 10)) for band in limits]
    assert lowest == sorted(lowest) and abs(lowest[1] - lowest[3]) <= 0.2 and lowest[-1] == pytest.approx(-6.3)
