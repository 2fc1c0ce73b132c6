"""Documents with every odd case the operators define a result for."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

# Extra columns named like the operators' own helper and result columns.
CLASHING = ["_row", "_key_a", "key_a", "n_words", "lang_pred", "n_lines", "slot", "row_a", "size", "unit", "host", "ids", "words"]
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, " + ", ".join(f"{c} STRING" for c in CLASHING)


def prose(rng, words, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 6))) for _ in range(words))


def odd_rows():
    rng = random.Random(11)
    base = prose(rng, 60)
    near = base.split(" ")
    near[30] = "changed"
    long_text = prose(rng, 9000) + "\n" + "x" * 5000
    texts = [
        None, "", " \t\n ", base, base.upper(), " ".join(near), base, long_text, "one two three", "One  two\nthree", "12 34",
        "aa " * 40, "aa " * 50, prose(rng, 80, "éèàß"), "é́ \x1c<|endoftext|> ☃ 日本", "same line here\nsame line here\nother",
        prose(rng, 300), prose(rng, 120), prose(rng, 55) + "#*$%&|<>",
    ]
    rows = [(i, t, "en" if i % 3 else "fr", f"s{i % 4}", None) for i, t in enumerate(texts)]
    rows += [(3, base, "fr", "s3", None), (3, base, "fr", "s3", None), (None, prose(rng, 70), "en", "s1", 1), (50, prose(rng, 70), None, None, 2)]
    rows += [(None, None, None, None, None)]
    return [(*r, *["x"] * len(CLASHING)) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    spark.createDataFrame(odd_rows(), SCHEMA).repartition(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
