"""Repeated lines against a brute-force version and SQL."""

import re

import pytest

from oracle_check import check, connect
from tagloom.llm import queries
from tagloom.llm.line_dedup import remove_repeated_lines


def brute(rows, size=3):
    """Distinct rows only."""
    lines = {(doc, text): text.split("\n") for doc, text in rows if text is not None and doc is not None}
    first = {}
    for (doc, text), own in sorted(lines.items()):
        for i in range(len(own) - size + 1):
            first.setdefault(tuple(own[i: i + size]), (doc, text, i))
    out = []
    for doc, text in rows:
        gone = set()
        own = lines.get((doc, text), [])
        for i in range(len(own) - size + 1):
            window = tuple(own[i: i + size])
            if first[window] != (doc, text, i) and re.search(r"[^\x20\x09-\x0D]", "".join(window)):
                gone.update(range(i, i + size))
        kept = text if not gone else "\n".join(x for i, x in enumerate(own) if i not in gone)
        out.append((doc, kept, 0 if text is None else len(text.split("\n")), len(gone)))
    return sorted(out, key=str)


BLOCK = "one line\n\nanother line\nthird"
ROWS = [
    (1, "start\n" + BLOCK + "\nend"), (2, "x\n" + BLOCK), (3, BLOCK), (4, "\n\n\n\n\n"), (5, "\n\n\n \n\n"), (6, None), (7, ""),
    (None, BLOCK), (8, "a\na\na\na\na"), (9, "a\nb\nc\na\nb\nc"), (10, "only\ntwo"), (10, "only\ntwo"), (11, "u\nv\nw"), (11, "u\nv\nw"),
    (12, "\n".join(f"line {i}" for i in range(5000))), (13, "\n".join(f"line {i}" for i in range(4000, 9000))), (14, "one line\n\nanother line "),
]


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, n_lines string").repartition(3)
    got = remove_repeated_lines(docs)
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed"]
    return sorted(map(tuple, got.collect()), key=str)


def test_planted(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_empty(spark):
    assert run(spark, []) == []


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = run(spark, rows)
    assert got == brute(rows) and any(r[3] for r in got)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    problem, rows, *_ = check(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", name, queries.QUERIES[name], queries.ORACLE[name])
    assert problem is None and rows > 0
