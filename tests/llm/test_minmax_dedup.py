"""Links and components against all pairs of exact sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import minmax_dedup, queries


def shingles(text, size=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, percent=85):
    sets = [frozenset(shingles(t)) for _, t in rows]
    distinct = sorted(set(sets) - {frozenset()}, key=len)
    label = {s: i for i, s in enumerate(distinct)}
    holders = {}
    for s in distinct:
        for x in s:
            holders.setdefault(x, []).append(s)
    changed = True
    links = set()
    for s in distinct:
        seen = {}
        for x in s:
            for t in holders[x]:
                seen[t] = seen.get(t, 0) + 1
        links |= {(s, t) for t, k in seen.items() if s is not t and 100 * k >= percent * (len(s) + len(t) - k)}
    while changed:
        changed = False
        for s, t in links:
            low = min(label[s], label[t])
            if label[s] != low or label[t] != low:
                label[s] = label[t] = low
                changed = True
    least = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            least[label[s]] = min(doc, least.get(label[s], doc))
    out = []
    for (doc, _), s in zip(rows, sets):
        component = least.get(label[s]) if s else doc
        out.append((doc, len(s), component, doc == component))
    return out


def compare(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words))
        words[i: i + 1] = rng.choice([[], [f"new{rng.randrange(10**6)}"], [words[i], f"more{rng.randrange(10**6)}"]])
    return " ".join(words)


def families(seed, sources=12, copies=14):
    rng = random.Random(seed)
    rows = []
    for s in range(sources):
        n = rng.choice([3, 8, 60, 200, 600])
        words = [f"w{rng.randrange(400)}" for _ in range(n)]
        for _ in range(copies):
            rows.append(edited(rng, words, rng.choice([0, 0, 1, 1, 2, n // 60, n // 40])))
    # Chains whose ends are far apart.
    words = [f"c{i}" for i in range(300)]
    for step in range(20):
        rows.append(" ".join(words[5 * step:] + [f"d{i}" for i in range(5 * step)]))
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two"), (7, "one two three four"), (8, "one two  THREE\nfour"),
    (9, "one two three four five"), (None, "one two three four five"), (None, "only without id a b c"), (None, "only without id a b c"),
    (None, None), (10, "É é a b c d"), (11, "é é a b c d"), (12, "same row here a b c"), (12, "same row here a b c"), (12, "another text of that id x y"),
    (13, "very long text " * 30_000), (14, "very long text " * 30_001),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, n int").repartition(3)


@pytest.mark.parametrize("blocks", [{}, {"block_members": 3, "block_bytes": 4000}])
def test_families(spark, blocks):
    rows = families(1) + ODD
    got = minmax_dedup.near_duplicates(frame(spark, rows), 85, **blocks).collect()
    compare(got, brute(rows))


def test_lower_similarity(spark):
    rows = families(2)
    compare(minmax_dedup.near_duplicates(frame(spark, rows), 80).collect(), brute(rows, 80))


def test_empty(spark):
    assert minmax_dedup.near_duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        minmax_dedup.near_duplicates(frame(spark, []), 60)


def test_second_step_finds_what_leaders_miss():
    """Members of a bucket that are far from its leader but near each other."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(400)]
    texts = [edited(rng, base, k) for k in (0, 1, 2, 3)] + [" ".join(f"x{i}" for i in range(400))]
    hashes, rows = minmax_dedup.shingle_sets(pa.array(texts))
    begins = np.searchsorted(rows, np.arange(len(texts)))
    sigs = minmax_dedup.short_signatures(minmax_dedup.signatures(hashes, begins))
    cuts = np.append(begins, len(rows))
    table = pa.table({
        "bucket": pa.array([7] * 5), "node": pa.array([bytes([i]) * 16 for i in range(5)], pa.binary()), "part": pa.array([bytes([i]) for i in range(5)], pa.binary()),
        "n": pa.array(np.diff(cuts)), "sig": pa.array([s.tobytes() for s in sigs], pa.binary()),
        "shingles": pa.array([hashes[a:b].view(np.int64) for a, b in zip(cuts, cuts[1:])], pa.list_(pa.int64())),
    })
    some = minmax_dedup._promising(85)(table)
    assert [x[0] for x in some.column("node").to_pylist()] == [0, 1, 2, 3]
    forest = minmax_dedup._linked(85)(table)
    assert forest.num_rows == 3
    assert {x[0] for c in ("node", "leader") for x in forest.column(c).to_pylist()} == {0, 1, 2, 3}


def test_estimates_are_fair():
    """Agreement of signatures estimates the similarity without bias, with less spread than as many independent values."""
    rng = np.random.default_rng(8)
    for similarity in (0.5, 0.85):
        errors = []
        for _ in range(60):
            both = int(600 * similarity)
            hashes = rng.integers(0, 2**64, 600, np.uint64)
            half = (600 - both) // 2
            a, b = hashes[: both + half], np.concatenate([hashes[:both], hashes[both + half:]])
            sig = minmax_dedup.signatures(np.concatenate([a, b]), np.array([0, len(a)]))
            errors.append((sig[0] == sig[1]).mean() - both / (len(a) + len(b) - both))
        n = 2 * minmax_dedup.PERMUTATIONS
        assert abs(np.mean(errors)) < 4 * (similarity * (1 - similarity) / n / 60) ** 0.5
        assert np.std(errors) < 1.25 * (similarity * (1 - similarity) / n) ** 0.5


def test_hot_leader_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(minmax_dedup, "LEADER_SHARE", 7)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(300)]
    rows = [(i, edited(rng, base, 1 + i % 3)) for i in range(120)]
    compare(minmax_dedup.near_duplicates(frame(spark, rows), 85).collect(), brute(rows))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    compare(queries.op11_minmax_dedup(spark, sf_dir).collect(), brute(rows))
