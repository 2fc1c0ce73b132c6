"""Documents that the mix takes in part."""

import re

from auditlake.llm import mixing


def test_a_document_taken_in_part_keeps_its_layout(spark):
    texts = {i: f" title {i}\n\n" + "\n".join(f"\tline {k}  of {i}\r" for k in range(20)) for i in range(6)}
    docs = spark.createDataFrame([(i, t, f"s{i % 3}") for i, t in texts.items()], "doc_id BIGINT, text STRING, source STRING")
    found = mixing.mixed_documents(docs).collect()
    cut = [r for r in found if r["text"] != texts[r["doc_id"]]]
    assert cut and all(texts[r["doc_id"]].startswith(r["text"]) and re.search(r"\S$", r["text"]) for r in cut)
    words = sum(len(r["text"].split()) for r in found)
    assert words == sum(r["taken"] for r in mixing.taken(docs).collect())
