"""Fill-in-middle against a plain version, and the round trip."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.llm import fill_in_middle as fim
from tagloom.llm import queries

PATTERNS = {"char": r"(?s).", "word": r"^[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "line": r"[^\n]*\n|[^\n]+"}


def brute(doc_id, text, unit="char"):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i: 8 * i + 8], 16) for i in range(4))
    units = re.findall(PATTERNS[unit], text)
    assert "".join(units) == text
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), out


def some_rows():
    rng = random.Random(3)
    letters = "ab <>PSM\n\té€😀́\r\x0b"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 30, 400, 3000])))) for i in range(150)]
    rows += [
        (1000, None), (1001, ""), (1002, "a <S> b"), (None, "no id here"), (None, None), (1003, "x"), (1004, "<"), (1005, "S><P"),
        (1006, " \n" * 700), (1007, "é" * 100_000 + " tail"), (1008, "word " * 60_000), (0, "same id"), (0, "same id"),
    ]
    return rows


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_rewritten(spark, unit):
    rows = some_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, form string, h1 int").repartition(3)
    found = fim.fill_in_middle(docs, unit)
    got = found.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = [(*brute(*r, unit), r[1] or "") for r in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.fill_in_middle(docs).count() == 0


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string"), "token")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.booleans(), max_size=700), st.integers(1, 300))
def test_cuts(units, block):
    units = np.array([True, *units])
    chars = units | (np.arange(len(units)) % 3 == 0)
    index = fim.CutIndex(units, chars, block)
    places = [*np.flatnonzero(units).tolist(), len(units)]
    assert index.n == len(places) - 1
    for k, at in enumerate(places):
        assert index.cut(k) == (at, int(chars[:at].sum()))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(*brute(*r)[:5], sha(brute(*r)[5]), sha(r[1] or "")) for r in rows]
    got = queries.op12_fill_in_middle(spark, sf_dir).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
