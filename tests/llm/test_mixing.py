"""Budgets by brute-force water filling, and the mixture against plain Python."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.llm import mixing


def water(budget, children):
    """{child: (weight, cap)} -> {child: share}, freezing full children until none is left over."""
    shares, open_ = {}, dict(children)
    while open_:
        left = budget - sum(shares.values())
        total = sum(w for w, _ in open_.values())
        full = [c for c, (w, cap) in open_.items() if cap * total <= left * w]
        if not full:
            return shares | {c: left * w // total for c, (w, _) in open_.items()}
        for c in full:
            shares[c] = open_.pop(c)[1]
    return shares


def brute(rows, budget=None, epochs=4, seed=7):
    def domain(source):
        n = int(source[3:]) // 7 if source and source.startswith("src") else 9
        return mixing.DOMAINS[n] if n < 3 else "other"

    docs = [(doc, (domain(s), lang or mixing.NONE, s or mixing.NONE), len((text or "").split())) for doc, text, lang, s in rows]
    tokens = defaultdict(int)
    for _, leaf, n in docs:
        tokens[leaf] += n
    budget = sum(tokens.values()) if budget is None else budget

    def down(prefix, own):
        depth = len(prefix)
        if depth == 3:
            return {prefix: own}
        caps = defaultdict(int)
        for leaf, n in tokens.items():
            if leaf[:depth] == prefix:
                caps[leaf[depth]] += n * epochs
        weights = [mixing.DOMAIN_WEIGHTS, mixing.LANGUAGE_WEIGHTS, {}][depth]
        out = {}
        for child, share in water(own, {c: (weights.get(c, 1), cap) for c, cap in caps.items()}).items():
            out |= down((*prefix, child), share)
        return out

    plan = down((), budget)
    out = []
    for leaf, share in plan.items():
        whole = share // tokens[leaf] if tokens[leaf] else 0
        rest = share - whole * tokens[leaf]
        places = defaultdict(int)
        own = [(doc, n, "null" if doc is None else str(doc)) for doc, at, n in docs if at == leaf]
        place = lambda i: hashlib.md5(f"{seed}:{whole}:{i}".encode()).hexdigest() + ":" + i
        for _, n, i in own:
            places[place(i)] += n
        reach, inside = 0, set()
        for key in sorted(places):
            reach += places[key]
            if reach <= rest:
                inside.add(key)
        out += [(doc, leaf[0], n, whole + (place(i) in inside)) for doc, n, i in own]
    return sorted(out, key=str)


def run(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, lang string, source string, copies int").repartition(3)
    got = mixing.with_copies(docs, mixing.source_domain(), **more)
    return sorted(map(tuple, got.select("doc_id", "domain", "n_tokens", "copies").collect()), key=str)


ROW = st.tuples(
    st.integers(0, 500) | st.none(), st.integers(0, 60).map(lambda n: "w " * n) | st.none(),
    st.sampled_from(["en", "de", "fr", "es", "xx", None]), st.sampled_from(["src0", "src1", "src8", "src15", "src30", "other", None]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=80), budget=st.sampled_from([None, 0, 100, 10**6]), epochs=st.sampled_from([1, 3]))
def test_random(spark, rows, budget, epochs):
    assert run(spark, rows, budget=budget, epochs=epochs) == brute(rows, budget, epochs)


def test_buckets_change_nothing(spark, monkeypatch):
    rows = [(i, "w " * (i % 50), "en" if i % 3 else "de", f"src{i % 4}") for i in range(600)]
    want = brute(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    assert run(spark, rows) == want


def test_empty(spark):
    assert run(spark, []) == []


def test_mixture_repeats_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.with_copies(docs, mixing.source_domain()).collect()}
    got = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {doc: n for doc, n in copies.items() if n}
    assert max(got.values()) > 1 and len(got) < len(copies)


@pytest.mark.parametrize("budget, children, want", [
    (100, {"a": (1, 10), "b": (1, 1000)}, {"a": 10, "b": 90}),
    (100, {"a": (3, 1000), "b": (1, 1000)}, {"a": 75, "b": 25}),
    (100, {"a": (3, 20), "b": (1, 30)}, {"a": 20, "b": 30}),
])
def test_fill(spark, budget, children, want):
    rows = [("p", c, w, cap, budget) for c, (w, cap) in children.items()]
    frame = spark.createDataFrame(rows, "parent string, child string, weight long, cap long, parent_budget long")
    got = {r["child"]: r["budget"] for r in mixing.fill(frame, ["parent"], "child").select("child", F.col("budget")).collect()}
    assert got == want == water(budget, children)


def test_weight_zero_takes_nothing(spark):
    """A branch of weight 0 stays out, and its siblings and the other domains take its share."""
    rows = [(i, "one two three four", lang, f"src{n}") for i, (lang, n) in enumerate([("en", 1), ("de", 1), ("en", 8), ("de", 8)] * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    taken = mixing.with_copies(docs, mixing.source_domain(), 80, 4, domain_weights={"web": 0}, language_weights={"de": 0}).collect()
    assert {(r["domain"], r["lang"]) for r in taken if r["copies"]} == {("books", "en")}
    assert sum(r["copies"] * r["n_tokens"] for r in taken) == 80
    none = mixing.with_copies(docs, mixing.source_domain(), 80, 4, domain_weights={"web": 0, "books": 0}).collect()
    assert not any(r["copies"] for r in none)
    for wrong in (-1, None, 0.5):
        with pytest.raises(ValueError):
            mixing.with_copies(docs, mixing.source_domain(), domain_weights={"web": wrong})
