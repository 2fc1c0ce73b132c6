"""The line stage on short pages that are mostly boilerplate, and on copies of whole documents."""

from test_odd_documents import counted

import corpus_pipeline
from auditlake.llm import line_dedup

NOTICE = "Shared notice that is longer than what the page itself says, on many sites."


def test_short_pages_lose_shared_lines_and_copies_keep_their_own(spark):
    rows = [(i, f"own {i}\n{NOTICE}", f"s{i}") for i in range(11)]
    rows += [(100 + i, "A copied text.\nIts second line.", f"s{i}") for i in range(12)]
    rows += [(200 + i, f" {NOTICE}\t", "s0") for i in range(2)]  # nothing but boilerplate
    # On ten sites, but in nine texts; in ten texts, but on nine sites.
    rows += [(300 + i, f"few texts\nmine {min(i, 8)}", f"s{i}") for i in range(10)]
    rows += [(400 + i, f"few sites\nthis {i}", f"s{min(i, 8)}") for i in range(10)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id BIGINT, text STRING, source STRING, n_chars INT")
    clean = {r[0]: (f"own {r[0]}" if r[0] < 11 else "" if 200 <= r[0] < 300 else r[1]) for r in rows}
    found = corpus_pipeline.line_stage(spark, docs, "")
    assert found.columns == docs.columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in found.collect()} == {i: (t, len(t)) for i, t in clean.items()}
    # The query's rule, fixed by its SQL, leaves those pages as they are.
    assert counted(line_dedup.line_dedup(docs), "doc_id", "text") == counted(docs.where("doc_id not between 300 and 309"), "doc_id", "text") + counted(
        line_dedup.line_dedup(docs).where("doc_id between 300 and 309"), "doc_id", "text"
    )
