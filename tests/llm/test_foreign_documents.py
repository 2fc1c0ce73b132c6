"""The language stage on texts in no learned language, next to clean documents of each."""

import random

import pytest
from test_odd_documents import counted

import corpus_pipeline
from auditlake.llm import langid

SYLLABLES = {
    "en": "the and ing er on at en ou th wh ed is of to be an".split(),
    "de": "der die und sch ein ich en keit ver ung ist zu ä ö über ge".split(),
    "fr": "le la de et un eau é è que ment oi tre aux ou en ç".split(),
}
ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя",
    "chinese": "".join(map(chr, range(0x4E00, 0x4E00 + 800))),
    "hex": "0123456789abcdef",
}


def clean(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(words))


def noise(rng, kind, words):
    return " ".join("".join(rng.choices(ALPHABETS[kind], k=rng.randrange(3, 10))) for _ in range(words))


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(3)
    rows = [(i, clean(rng, lang, rng.choice([3, 40, 200])), lang) for i, lang in enumerate([*SYLLABLES] * 60)]
    rows += [(500 + i, f"4761598977407687 {clean(rng, lang, 30)} $$$ %%% 8316107434564120", lang) for i, lang in enumerate(SYLLABLES)]
    # Some with a wrong label, so that a part of them is trained on.
    rows += [(1000 + i, noise(rng, kind, rng.choice([60, 400])), [None, "en"][i % 8 == 0]) for i, kind in enumerate([*ALPHABETS] * 8)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")


def test_only_documents_in_a_learned_language_stay(spark, mixed):
    found = corpus_pipeline.language_stage(spark, mixed, "")
    assert found.columns == mixed.columns
    assert counted(found, "doc_id", "text", "lang") == counted(mixed.where("doc_id < 1000"), "doc_id", "text", "lang")


def test_slices_of_a_long_text_hold_each_trigram_once(monkeypatch):
    text = "ab cd12 efg! " * 30
    whole = sorted(b for part in langid.letter_trigrams(text, 4096) for b in part)
    monkeypatch.setattr(langid, "SLICE_CHARS", 7)
    assert sorted(b for part in langid.letter_trigrams(text, 4096) for b in part) == whole and whole


def test_a_text_that_was_trained_on_is_left_out_of_its_own_fit(spark):
    rows = [(1, "alpha beta gamma", "en"), (2, "delta epsilon zeta", "en")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    both, one = langid.train(docs), langid.train(docs.where("doc_id = 2"))
    assert langid.fit_text(both, rows[0][1], "en", True) == pytest.approx(langid.fit_text(one, rows[0][1], "en", False), rel=1e-4)
