"""Fingerprints and components against a brute-force version."""

import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tagloom.llm import simhash


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=2):
    fps = np.array(fps, np.uint64)
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    while True:
        new = np.array([label[row].min() for row in near])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = brute_components(fps)
    least = {}
    for (doc, _), own in zip(rows, label):
        if doc is not None:
            least[own] = min(doc, least.get(own, doc))
    return sorted(((doc, f"{fp:016x}", least.get(own)) for (doc, _), fp, own in zip(rows, fps, label)), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, root string").repartition(3)


def run(spark, rows):
    got = simhash.near_duplicates(frame(spark, rows)).select("doc_id", "fingerprint", "component_id")
    return sorted(map(tuple, got.collect()), key=str)


LONG = " ".join(f"word{i}" for i in range(3000))
ROWS = [
    (4, "One two three four five"), (2, "one two THREE four five"), (9, None), (7, ""), (8, " \n\t"), (10, "a"), (11, "a b"),
    (12, "A B"), (3, LONG), (1, LONG + " tail"), (None, LONG), (None, "alone here with no id"), (5, "É é É"), (6, "é é é"), (4, "One two three four five"),
]


def test_planted(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_keep_one(spark):
    docs = frame(spark, ROWS)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {(fp, comp) for _, fp, comp in brute(ROWS)}
    roots = {comp if comp is not None else fp for fp, comp in groups}
    rows = kept.collect()
    assert len(rows) == len(roots)
    assert {r["doc_id"] for r in rows} == {c if isinstance(c, int) else None for c in roots}


def test_empty(spark):
    assert run(spark, []) == []
    assert simhash.keep_one(frame(spark, [])).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), shard_rows=st.sampled_from([3, 40, 20000]))
def test_links(spark, seed, shard_rows):
    """Chains and clusters of fingerprints, with shards so small that they are dealt out in blocks."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**64, 12, np.uint64)
    fps = [c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) for c in centres for k in (1, 1, 2, 3, 3, 4) for _ in range(4)]
    fps = sorted({int(f) for f in [*fps, *centres, *rng.integers(0, 2**64, 100, np.uint64)]})
    signed = np.array(fps, np.uint64).view(np.int64)
    frame = spark.createDataFrame(pd.DataFrame({"fp": signed}))
    stars = simhash.merged_stars(simhash.linked_stars(frame, 2, shard_rows)).toPandas()
    assert stars["child"].is_unique
    root = dict(zip(stars["child"], stars["parent"]))
    label = brute_components(fps)
    want = {}
    for fp, own in zip(signed, label):
        want.setdefault(own, set()).add(fp)
    got = {}
    for fp in signed:
        got.setdefault(root.get(fp, fp), set()).add(fp)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [10, 10**6, 10**12])
def test_tree_grows_with_the_input(n):
    levels = simhash.shard_levels(n, 2)
    assert levels == simhash.LEVELS or n * len(simhash._directions(levels, 2)) / 4.1**levels <= simhash.SHARD_ROWS
