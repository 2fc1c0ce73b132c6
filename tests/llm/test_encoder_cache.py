"""The cache of encoded words is bounded by bytes; ids do not depend on what it has forgotten."""

import random
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from auditlake.llm import token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("most", [1, 3_000, 40_000])
def test_forgetting_words_changes_no_ids(monkeypatch, most):
    monkeypatch.setattr(token_ids, "CACHE_BYTES", most)
    rng, library = random.Random(most), Tokenizer.from_file(PATH)
    encode = token_ids.WordEncoder(PATH)
    frequent = ["the", "word.", "Ünder", "<|endoftext|>", "12,5", "naïve!", "日本"]
    for _ in range(30):
        fresh = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) + rng.choice(["", ".", "?!", "-x"]) for _ in range(40)]
        texts = [" ".join(rng.choices(frequent + fresh, k=rng.randrange(0, 60))) for _ in range(5)] + [None, "", " \n"]
        ids, counts = encode.encode(pa.array(texts))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert len(encode.uses) == len(encode.words) == len(encode.word_parts)


def test_a_slice_at_a_time():
    encode = token_ids.WordEncoder(PATH)
    long = "several words of a long text\n" * 200_000
    ids, counts = encode.encode(pa.array(["first", long, None, long, "last"]))
    assert counts[1] == counts[3] and len(ids) == counts.sum()
    start = counts[0]
    assert np.array_equal(ids[start : start + counts[1]], ids[start + counts[1] : start + 2 * counts[1]])


def test_new_words_cost_no_python_calls():
    encode = token_ids.WordEncoder(PATH)
    words = ["w" + "abcdefghij"[i % 10] * (1 + i // 10 % 40) + "xyz"[i // 400] for i in range(1200)]
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "call" else None)
    try:
        encode.encode(pa.array([" ".join(words)]))
    finally:
        sys.setprofile(None)
    assert len(encode.words) == 1200 and len(calls) < 600
