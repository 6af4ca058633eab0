"""The classifier on held-out labels, its penalty, and odd rows."""

import zlib

import numpy as np
import pytest

from tagloom.llm import toxicity as tox

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    got = tox.score_held_out(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got["doc_id"]]).all()
    unseen = got[got["held_out"]]
    found = unseen[unseen["toxic"] == 1]["predicted"].mean()
    false = unseen[unseen["toxic"] == 0]["predicted"].mean()
    print(found, false)
    assert found > 0.8 and false < 0.02
    assert (got["predicted"] == (got["score"] >= 0.3)).all() and got["score"].between(0, 1).all()


def biased(spark):
    """Attacks that all name one group, and neutral texts that never do."""
    rng = np.random.default_rng(0)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    rows = []
    for i in range(600):
        own = list(rng.choice(words, 8))
        if i % 4 == 0:
            own += ["muslims"] if i % 8 else ["muslims", "scum"]
        elif i % 16 == 1:
            own += ["christians"]
        rows.append((i, " ".join(own), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return docs, labels


def test_neutral_mentions(spark):
    docs, labels = biased(spark)
    plain, fair = (tox.train(docs, labels, l1=1e-4, balance=b) for b in (0.0, 50.0))
    neutral, other = "muslims met for dinner", "christians met for dinner"
    assert plain.score(neutral) > 0.5
    assert fair.score(neutral) < plain.score(neutral) - 0.3
    assert abs(fair.score(neutral) - fair.score(other)) < 0.1 < plain.score(neutral) - plain.score(other)
    assert fair.score("you scum " + neutral) > fair.score(neutral)


def test_held_out_labels_change_nothing(spark):
    docs, labels = biased(spark)
    flipped = labels.withColumn("toxic", tox.F.when(tox.held_out(), 1 - tox.F.col("toxic")).otherwise(tox.F.col("toxic")))
    a, b = (sorted(map(tuple, tox.score_held_out(docs, x).collect())) for x in (labels, flipped))
    assert a == b


ODD = [(1, None), (2, ""), (None, "no id"), (3, "word " * 50000), (4, "idiot"), (4, "idiot"), (5, "Ünï\x00")]


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, None), (None, 1), (4, 1), (4, 0), (3, 7), (9, 1)]])
def test_odd_rows(spark, labels):
    docs = spark.createDataFrame([(*r, 0.5) for r in ODD], "doc_id long, text string, score double")
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = tox.score_held_out(docs, given).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted((d for d, _ in ODD), key=str)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert tox.score_held_out(docs.limit(0), given).count() == 0


def test_fit_is_the_minimum():
    """No small step from the fitted weights lowers the penalised loss, written out in plain numpy."""
    rng = np.random.default_rng(4)
    x = rng.random((80, 6)) < 0.4
    labels = (x[:, 0] | (rng.random(80) < 0.1)).astype(float)
    pairs = [[(0, 1.0), (1, -1.0)], [(2, 1.0), (3, -1.0)], [(4, 1.0)]]
    flat = [(p, c, s) for p, own in enumerate(pairs) for c, s in own]
    pair, cols, sign = (np.array(v) for v in zip(*flat))
    l1, balance = 1e-3, 2.0
    w, b = tox.fit(np.nonzero(x), labels, (pair, cols, sign.astype(float)), 6, l1, balance, 4000, 1e-12)

    def loss(w, b):
        z = x @ w + b
        moved = [sum(s * w[c] for c, s in own) for own in pairs]
        return np.mean(np.log1p(np.exp(z)) - labels * z) + l1 * np.abs(w).sum() + balance * np.mean(np.square(moved))

    least = loss(w, b)
    for _ in range(500):
        step = rng.normal(size=7) * 10.0 ** -rng.integers(1, 5)
        assert loss(w + step[:6], b + step[6]) >= least - 1e-9


def test_scores_are_sums_of_weights():
    model = tox.Model({b"idiot": 2.0, b"idiot*": 0.5, b"good": -1.0}, -0.3)
    for text, z in (("Idiot!", 1.7), ("idiots idiots", 0.2), ("good, GOOD", -1.3), (None, -0.3), ("", -0.3)):
        assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-12


def test_repeated_ids_are_one_row(spark):
    """Copies of one labelled id weigh no more than one text: the model stays the same."""
    docs, labels = biased(spark)
    hot = docs.unionByName(docs.where("doc_id = 4").withColumn("n", tox.F.explode(tox.F.sequence(tox.F.lit(1), tox.F.lit(900)))).drop("n"))
    a, b = (tox.train(d, labels, sample_rows=300) for d in (docs, hot))
    assert a.weights.keys() == b.weights.keys()
    assert all(abs(a.weights[k] - b.weights[k]) < 1e-12 for k in a.weights) and a.bias == b.bias
