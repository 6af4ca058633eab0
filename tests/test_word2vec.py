import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.learn import blocks, word2vec as wv
from tagloom.operators import corpus as co

TEXTS = [["a", "b", "a", "c"], ["b"], ["c", "c", "d", "a", "b", "e", "a"]]


@pytest.fixture(scope="module")
def sents(spark):
    rows = [("A", i, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "CORP string, SENT_ID long, TOKENS array<string>")


@pytest.fixture(scope="module")
def topics(spark):
    """Two topics with their own words; a third of all sentences are copies of one."""
    rng = np.random.default_rng(1)
    texts = [[f"{t}{rng.integers(0, 8)}" for _ in range(12)] for t in ("x", "y") for _ in range(200)]
    texts += [["x0", "x1", "x2", "x3"]] * 200
    return spark.createDataFrame([("A", i, t) for i, t in enumerate(texts)], "CORP string, SENT_ID long, TOKENS array<string>")


def brute_pairs(window):
    found = Counter()
    for t in TEXTS:
        for i, a in enumerate(t):
            for j in range(max(0, i - window), min(len(t), i + window + 1)):
                if i != j:
                    found[a, t[j]] += 1
    return found


@pytest.mark.parametrize("window", [1, 2, 5])
def test_pairs(sents, window):
    got = {(r["CENTER"], r["CONTEXT"]): r["n"] for r in co.pair_counts(sents, window).collect()}
    assert got == dict(brute_pairs(window))


@pytest.mark.parametrize("window", [1, 2, 5])
def test_cbow_pairs(sents, window):
    want = Counter()
    for t in TEXTS:
        around = [[j for j in range(max(0, i - window), min(len(t), i + window + 1)) if j != i] for i in range(len(t))]
        for i, own in enumerate(around):
            for j in own:
                want[t[i], t[j]] += co.CBOW_SHARE // len(own)
                want[t[j], t[i]] += co.CBOW_SHARE // len(own)
    got = {(r["CENTER"], r["CONTEXT"]): r["n"] for r in co.pair_counts(sents, window, "cb").collect()}
    assert got == dict(want)


def test_sentences_and_vocabulary(spark, sents):
    tokens = sents.select("CORP", "SENT_ID", F.posexplode("TOKENS").alias("TOKN_ID", "FORM")).repartition(4)
    got = {r["SENT_ID"]: r["TOKENS"] for r in co.sentences(tokens).collect()}
    assert got == dict(enumerate(TEXTS))
    vocab = co.most_frequent_first(co.vocabulary(co.forms_of(sents))).collect()
    assert [(r["FORM"], r["n"]) for r in vocab] == [("a", 4), ("b", 3), ("c", 3), ("d", 1), ("e", 1)]


def test_subsampling_rate(spark):
    tokens = spark.range(40000).select(
        F.when(F.col("id") % 2 == 0, "the").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("FORM"),
        F.lit("A").alias("CORP"), F.col("id").alias("SENT_ID"), F.lit(1).alias("TOKN_ID"))
    vocab = co.vocabulary(tokens)
    rate = co.keep_probabilities(vocab).where("FORM = 'the'").first()["keep"]
    assert rate == pytest.approx((math.sqrt(500) + 1) / 500)
    kept = co.subsample(tokens, vocab)
    n = kept.where("FORM = 'the'").count()
    assert n == pytest.approx(20000 * rate, rel=0.15)
    assert kept.count() - n == 20000
    assert kept.count() == co.subsample(tokens.repartition(7), vocab).count()


def test_negative_distribution(sents):
    p = {r["FORM"]: r["p"] for r in co.negative_distribution(co.vocabulary(co.forms_of(sents))).collect()}
    assert sum(p.values()) == pytest.approx(1) and p["a"] / p["d"] == pytest.approx(4 ** 0.75)


def test_shifted_ppmi(sents):
    pairs = brute_pairs(2)
    totals = Counter()
    for (a, _), n in pairs.items():
        totals[a] += n
    smooth = sum(n ** 0.75 for n in totals.values())
    want = {}
    for (a, b), n in pairs.items():
        m = math.log(n / (totals[a] * totals[b] ** 0.75 / smooth)) - math.log(2)
        if m > 0:
            want[a, b] = m
    got = {(r["CENTER"], r["CONTEXT"]): r["m"] for r in wv.shifted_ppmi(co.pair_counts(sents, 2), negative=2).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("arch,engine", [("sg", "sampled"), ("cb", "sampled"), ("sg", "factor"), ("cb", "factor"), ("sg", "ml")])
def test_vectors_separate_topics(topics, arch, engine):
    settings = wv.Settings(dim=4, epochs=4, alpha=0.1, negative=2)
    rows = wv.train(topics, arch, settings, engine, partitions=2).collect()
    vec = {r["FORM"]: np.array(r["vec"]) for r in rows}
    assert len(vec) == len(rows) == 16 and all(v.shape == (4,) and np.isfinite(v).all() for v in vec.values())

    def mean_cosine(left, right):
        return np.mean([vec[a] @ vec[b] / (np.linalg.norm(vec[a]) * np.linalg.norm(vec[b]) + 1e-9)
                        for a in left for b in right if a != b])

    x, y = [[f"{t}{i}" for i in range(8)] for t in "xy"]
    assert (mean_cosine(x, x) + mean_cosine(y, y)) / 2 > mean_cosine(x, y) + 0.1


@pytest.mark.parametrize("block_forms", [4, 1000])
def test_singular_vectors(spark, topics, monkeypatch, block_forms):
    """Against a dense decomposition, with one block and with several."""
    monkeypatch.setattr(wv.blocks, "BLOCK_FORMS", block_forms)
    s = wv.Settings(dim=4, negative=1, tolerance=1e-6)
    vocab = co.vocabulary(co.forms_of(topics))
    vectors, residual = wv.factorised(topics, vocab, "cb", s)
    got = {r["FORM"]: np.array(r["vec"]) for r in vectors.collect()}
    assert residual <= s.tolerance
    names = sorted(got)
    dense = np.zeros((len(names), len(names)))
    for a, b, m in wv.shifted_ppmi(co.pair_counts(topics, s.window, "cb"), s.negative).collect():
        dense[names.index(a), names.index(b)] = m
    u, sigma, _ = np.linalg.svd(dense)
    want = u[:, :4] * np.sqrt(sigma[:4])
    mine = np.array([got[n] for n in names])
    # Signs and turns inside equal values are free: the products are not.
    assert np.allclose(mine @ mine.T, want @ want.T, atol=1e-3)


def test_architectures_differ(topics):
    sg, cb = ({r["FORM"]: r["vec"] for r in wv.train(topics, a, wv.Settings(dim=4, negative=1), "factor").collect()} for a in ("sg", "cb"))
    assert max(abs(x - y) for f in sg for x, y in zip(sg[f], cb[f])) > 1e-3


def test_unknown_choices(topics):
    with pytest.raises(ValueError, match="architecture"):
        wv.train(topics, "xx")
    with pytest.raises(ValueError, match="engine"):
        wv.train(topics, "cb", engine="sgd")
    with pytest.raises(ValueError, match="skip-gram"):
        wv.train(topics, "cb", engine="ml")


@pytest.mark.parametrize("transposed", [False, True])
def test_product_of_blocks_in_steps(spark, monkeypatch, transposed):
    """Lines of the matrix that lie in several steps, and lines without an entry."""
    monkeypatch.setattr(blocks, "STEP", 3)
    cells = [(0, 0, 0, 1, 2.0), (0, 0, 0, 2, 1.0), (0, 2, 0, 0, 4.0), (0, 2, 0, 1, 3.0), (0, 2, 0, 2, 5.0), (0, 2, 1, 0, 7.0), (1, 0, 0, 2, 6.0)]
    dense = np.zeros((4, 4))
    for rb, r, cb, c, m in cells:
        dense[3 * rb + r, 3 * cb + c] = m
    sizes = spark.createDataFrame([(0, 3), (1, 1)], "block int, n long")
    matrix = blocks.packed(spark.createDataFrame(cells, "rb int, r int, cb int, c int, m double"), sizes)
    x = np.random.default_rng(1).standard_normal((4, 2))
    vectors = spark.createDataFrame([(0, x[:3].tobytes()), (1, x[3:].tobytes())], "block int, data binary")
    got = {r["block"]: np.frombuffer(r["data"]).reshape(-1, 2) for r in blocks.times(matrix, vectors, 2, transposed).collect()}
    assert np.allclose(np.vstack([got[0], got[1]]), (dense.T if transposed else dense) @ x)
