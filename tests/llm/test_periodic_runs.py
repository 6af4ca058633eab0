"""Runs against a direct search, the transform against plain sums."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import periodic_runs, queries


def brute_runs(words, min_length=6, min_exponent=4):
    found = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = (text or "").encode().split()
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(a + q <= i < a + n for a, n, q in runs)]
    return doc_id, len(words), runs, b" ".join(kept).decode()


def plant(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return b" ".join(words).decode()


def digest(found):
    doc_id, _, runs, collapsed = found
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *head, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(collapsed)


def some_text(rng):
    words = []
    while rng.random() < 0.8:
        unit = [rng.choice("abcdefgh"[: rng.choice([1, 2, 8])]) * rng.randint(1, 2) for _ in range(rng.randint(1, 12))]
        words += (unit * rng.randint(1, 12))[: rng.randint(1, 100)]
    return rng.choice([" ", "\n", " \t "]).join(words)


def test_rows(spark):
    rng = random.Random(5)
    rows = [(i, some_text(rng)) for i in range(200)]
    rows += [
        (900, None), (901, ""), (902, " \n"), (None, "a a a a a a"), (None, None), (903, "a " * 5), (904, "a " * 6), (905, "a b " * 4),
        (906, "a b " * 3), (907, "x " * 5000), (908, "é b c " * 3000 + "x"), (1, "a b c d e f g h " * 4), (1, "a b c d e f g h " * 4),
        (909, "a a a a a a b " * 300), (910, " ".join(str(i % 977) for i in range(5000))),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, runs string").repartition(3)
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.find_runs(docs).collect()]
    assert sorted(map(str, got)) == sorted(str(brute(*r)) for r in rows)


def test_empty(spark):
    assert periodic_runs.find_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fewer_periods_are_refused(spark):
    with pytest.raises(ValueError):
        periodic_runs.find_runs(spark.createDataFrame([], "doc_id long, text string"), min_exponent=3)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4), st.integers(1, 9), st.integers(4, 6))
def test_runs(texts, min_length, min_exponent):
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    got = periodic_runs.runs_of(np.array(sum(texts, []), np.int64), offsets, min_length, min_exponent)
    want = [(a + o, a + n + o, q) for t, o in zip(texts, offsets.tolist()) for a, n, q in brute_runs(t, min_length, min_exponent)]
    assert list(map(tuple, got.tolist())) == sorted(want, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("block", [1, 2, 8, 64])
def test_distances(block):
    rng = np.random.default_rng(block)
    codes = rng.integers(0, 3, 20 * block).astype(np.uint64)
    begins = np.arange(0, 17 * block, block)
    got = periodic_runs.block_distances(codes, begins, block)
    signed = codes.astype(np.int64)
    want = [[((signed[a: a + block] - signed[a + d: a + d + block]) ** 2).sum() for a in begins] for d in range(block, 2 * block)]
    assert (got == np.array(want)).all()


@pytest.mark.parametrize("n", [1, 2, 16, 1024])
def test_transform_round_trip(n):
    x = np.random.default_rng(n).integers(0, periodic_runs.MODULUS, (n, 3), np.uint64)
    back = periodic_runs.inverse_transform(periodic_runs.transform(x.copy()))
    assert (back == x * np.uint64(n) % np.uint64(periodic_runs.MODULUS)).all()


def test_extensions_stay_few():
    """A text of one word, and one of long stretches of it: each scale looks at no more than a few words per word."""
    n = 1 << 17
    texts = {"one": np.zeros(n, np.int64), "parted": (np.arange(n) % 5000 == 0).astype(np.int64)}
    compared = []
    real = periodic_runs._equal_stretch
    try:
        periodic_runs._equal_stretch = lambda words, at, *rest: compared.append(len(at) * rest[2]) or real(words, at, *rest)
        for words in texts.values():
            compared.clear()
            periodic_runs.runs_of(words, np.array([0, n]))
            assert sum(compared) < 4 * n
    finally:
        periodic_runs._equal_stretch = real


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = [digest(brute(doc_id, plant(doc_id, text))) for doc_id, text in rows]
    got = list(map(tuple, queries.op13_periodic_runs(spark, sf_dir).collect()))
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert any(r[1] for r in want)
