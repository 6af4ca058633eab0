"""Columns of the user that are named as the operators name theirs come back untouched."""

import pytest

from tagloom.llm import language_id, line_dedup, mixing, simhash

NAMES = ["_text_key", "_starts", "_doc", "_key", "_new", "_text", "_nth", "_one", "_id", "_lang", "_source", "_all", "_epoch", "_whole", "aside0", "bucket"]


@pytest.mark.parametrize("operator", [line_dedup.remove_repeated_lines, simhash.keep_one, language_id.keep_identified, mixing.mix])
def test_clashing_names(spark, operator):
    text = "\n".join(f"the quick fox number {i} jumps over the lazy dog and runs into the woods" for i in range(8))
    rows = [(i, f"{text}\nline {i} of its own", "en", "src1", 1, *[f"{n}{i}" for n in NAMES]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"{n} string" for n in NAMES))
    plain = operator(docs.drop(*NAMES))
    found = operator(docs)
    assert [c for c in found.columns if c in docs.columns] == docs.columns
    got = found.collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted((r["doc_id"], r["text"]) for r in plain.collect()) and got
    assert all(r[n] == f"{n}{r['doc_id']}" for r in got for n in NAMES)
