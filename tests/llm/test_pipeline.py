"""Each stage and the whole pipeline against plain Python."""

from collections import Counter

import pytest

import corpus_pipeline as pipeline
import test_line_dedup
import test_mixing
import test_simhash
import test_tokens
from tagloom.llm import language_id

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF_DIR = "/root/testdata/sf0.001"


def brute_lines(rows):
    """rows: (doc_id, text, ...) with unique ids."""
    cleaned = {doc: (text, gone) for doc, text, _, gone in test_line_dedup.brute([r[:2] for r in rows])}
    out = []
    for doc, text, lang, source, n in rows:
        new, gone = cleaned[doc]
        if not gone:
            out.append((doc, text, lang, source, n))
        elif new.encode().split():
            out.append((doc, new, lang, source, len(new)))
    return out


def brute_one(rows):
    fps = [test_simhash.brute_fingerprint(r[1]) for r in rows]
    least = {}
    label = test_simhash.brute_components(fps)
    for row, own in zip(rows, label):
        least[own] = min(row[0], least.get(own, row[0]))
    return [row for row, own in zip(rows, label) if least[own] == row[0]]


def brute_mix(rows):
    copies = {doc: n for doc, _, _, n in test_mixing.brute([(r[0], r[1], r[2], r[3]) for r in rows])}
    return [row for row in rows for _ in range(copies[row[0]])]


def collected(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def test_run(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    verdict = {r["id"]: r["kept"] for r in language_id.identify(language_id.document_rows(docs)).collect()}
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect() if verdict[r["doc_id"]]]
    for want, (name, apply) in zip((None, brute_lines, brute_one, brute_mix), pipeline.STAGES):
        rows = want(rows) if want else rows
        docs = apply(spark, docs, SF_DIR)
        assert docs.columns == COLUMNS, name
        path = pipeline.stage(docs, name)
        assert collected(path) == sorted(rows), name
        docs = path
    got = pipeline.run(spark, SF_DIR).collect()
    bins = test_tokens.check_packing(got, [(r[0], r[1]) for r in rows])
    assert bins == test_tokens.best_fit([r["length"] for r in got], 1024)


ODD = [
    (1, None, "en", "src0", None), (2, "", None, None, 0), (None, "a text that has no id of its own", "en", None, 5), (3, "word " * 3000, "en", "src1", 15000),
    (4, "same words in here\nand there\nand done", "en", "src2", 1), (4, "same words in here\nand there\nand done", "en", "src2", 1),
    (5, "same words in here\nand there\nand done\nplus one", "xx", "src0", 1), (6, "12345 67890", "en", "src3", 11),
]


@pytest.mark.parametrize("rows", [[], ODD])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, root string, copies int"
    ).repartition(2)
    for name, apply in pipeline.STAGES[:-1]:
        out = apply(spark, docs, None)
        assert out.columns == docs.columns, name
        docs = pipeline.stage(out, name)
    kept = [r["doc_id"] for r in docs.collect()]
    assert {1, 2, 6}.isdisjoint(kept)
    packed = pipeline.STAGES[-1][1](spark, docs, None).collect()
    assert len(packed) >= len(kept)
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(kept)
