"""Repeated passages against a brute-force version."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tagloom.llm.substring_dedup import COVER, PERIOD, remove_repeats


def brute(rows, window=13):
    texts = [(doc, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc, text in rows]
    least = {}
    for doc, words in texts:
        if doc is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i: i + window])
                least[key] = min(doc, least.get(key, doc))
    out = []
    for doc, words in texts:
        gone = set()
        for i in range(len(words) - window + 1):
            if doc is not None and least[tuple(words[i: i + window])] < doc:
                gone.update(range(i, i + window))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def run(spark, rows, window=13, parts=3):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int").repartition(parts)
    return sorted(map(tuple, remove_repeats(docs, window).collect()), key=str)


def test_cover_reaches_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


WORDS = [f"w{i}" for i in range(40)]
PASSAGE = " ".join(f"p{i}" for i in range(30))


def test_planted(spark):
    rows = [
        (5, "a b c " + PASSAGE + " d"), (3, "x  y\t" + PASSAGE.replace(" ", "\n")), (9, " ".join(PASSAGE.split()[3:16])),
        (10, " ".join(PASSAGE.split()[3:15])), (11, None), (12, ""), (None, PASSAGE), (13, "same " * 40), (14, "same " * 20),
        (13, "same " * 40), (13, PASSAGE), (15, "é\xa0ß " * 30), (16, "é\xa0ß " * 14 + "end"), (17, "q" * 300 + " " + PASSAGE), (18, "long " * 20000),
    ]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, [], window=3)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 30), st.lists(st.integers(0, 2), max_size=60)), min_size=1, max_size=25))
def test_random(spark, rows):
    rows = [(doc, " ".join(WORDS[w] for w in words)) for doc, words in rows]
    assert run(spark, rows, window=8) == brute(rows, 8)


@pytest.mark.parametrize("parts", [1, 7])
def test_documents(spark, parts):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = run(spark, rows, parts=parts)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 0


def test_null_ids_change_nothing_for_large_ids(spark):
    """Ids that no floating-point number holds, next to rows without an id in the same batch."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [((1 << 60) + 1, text), ((1 << 60) + 3, text), *[(None, f"{text} {i}") for i in range(80)]]
    got = run(spark, rows, parts=1)
    assert got == brute(rows)
    assert sum(r[2] for r in got) == 40
