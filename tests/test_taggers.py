import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.learn import taggers
from tagloom.staging import staged_path


@pytest.fixture(scope="module")
def sents(spark):
    rows = [("A", i, ["the", "Dog" if i % 2 else "Cat", "runs" if i % 3 else "sleeps", "."]) for i in range(100)]
    return spark.createDataFrame(rows, "CORP string, SENT_ID long, TOKENS array<string>")


def test_tag_sentences(sents):
    names = {"the": "ART", ".": "$.", "runs": "VVFIN", "sleeps": "VVFIN"}

    def tag(forms):
        return [names.get(f, "NN") for f in forms]

    rows = taggers.tag_sentences(sents, tag, workers=3).orderBy("SENT_ID", "TOKN_ID").collect()
    assert len(rows) == 400
    assert [(r["TOKN_ID"], r["FORM"], r["STTS"], r["UNIV"]) for r in rows[:4]] == [
        (1, "the", "ART", "DET"), (2, "Cat", "NN", "NOUN"), (3, "sleeps", "VVFIN", "VERB"), (4, ".", "$.", ".")]
    unknown = taggers.tag_sentences(sents, lambda forms: ["ZZ"] * len(forms))
    assert unknown.where("UNIV is null").count() == 400


def test_wrong_number_of_tags_stops(sents):
    with pytest.raises(Exception, match="another number of tags"):
        taggers.tag_sentences(sents, lambda forms: ["NN"]).collect()


def test_lexicon_ties_and_back_off(spark):
    rows = [("a", "NN")] * 2 + [("a", "ADV")] * 2 + [("walking", "VVFIN")] * 3 + [("king", "NN")]
    counts = taggers.form_tag_counts(spark.createDataFrame(rows, "FORM string, STTS string"))
    lexicon = taggers.train_lexicon(counts)
    assert {r["FORM"]: r["STTS"] for r in lexicon.collect()} == {"a": "ADV", "walking": "VVFIN", "king": "NN"}
    forms = spark.createDataFrame([("a",), ("talking",), ("zzz",), ("g",)], "FORM string")
    plain = {r["FORM"]: r["PRED_STTS"] for r in taggers.tag_forms(forms, lexicon).collect()}
    assert plain == {"a": "ADV", "talking": "NN", "zzz": "NN", "g": "NN"}
    backed = taggers.tag_forms(forms, lexicon, suffixes=taggers.train_suffixes(counts))
    assert {r["FORM"]: r["PRED_STTS"] for r in backed.collect()} == {"a": "ADV", "talking": "VVFIN", "zzz": "NN", "g": "VVFIN"}
    assert backed.columns == ["FORM", "PRED_STTS"]


@pytest.mark.parametrize("n", [0, 5, 9, 10, 101, 1000])
def test_holdout_is_exact_and_repeatable(spark, n):
    sents = spark.range(n).select(F.lit("A").alias("CORP"), F.col("id").alias("SENT_ID"))
    first = taggers.holdout_split(sents, 0.1, seed=4).where("IS_TEST")
    assert first.count() == n // 10
    again = taggers.holdout_split(sents.repartition(5), 0.1, seed=4).where("IS_TEST")
    assert sorted(first.collect()) == sorted(again.collect())
    if n == 1000:
        assert sorted(first.collect()) != sorted(taggers.holdout_split(sents, 0.1, seed=5).where("IS_TEST").collect())


def test_context_tagger_uses_neighbours(spark):
    """The same form has two classes, told apart by the word before it."""
    rows = [("A", i, ["to", "run", "now"] if i % 2 else ["the", "run", "ends"]) for i in range(60)]
    sents = spark.createDataFrame(rows, "CORP string, SENT_ID long, TOKENS array<string>")
    features = taggers.context_features(sents)
    gold = F.when(F.col("FORM") != "run", "X").when(F.col("SENT_ID") % 2 == 1, "VERB").otherwise("NOUN")
    model = taggers.train_context_tagger(features.withColumn("UNIV", gold))
    tagged = model.tag(features).withColumn("gold", gold)
    assert tagged.where("PRED_UNIV <> gold").isEmpty()
    again = load_again(spark, model)
    assert sorted(map(str, again.tag(features).collect())) == sorted(map(str, model.tag(features).collect()))


def test_context_scores_move_rows_once(spark, monkeypatch):
    """Rows meet all their features' weights in one pass; parts of any size give the same."""
    rows = [("A", i, ["to", "run", "now", f"w{i % 9}"] if i % 2 else ["the", "run", "ends"]) for i in range(60)]
    features = taggers.context_features(spark.createDataFrame(rows, "CORP string, SENT_ID long, TOKENS array<string>"))
    model = taggers.train_context_tagger(features.withColumn("UNIV", F.when(F.col("TOKN_ID") == 2, "VERB").otherwise("NOUN")))
    whole = model.tag(features)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    monkeypatch.setattr(taggers, "PART_ROWS", 7)
    assert sorted(map(str, whole.collect())) == sorted(map(str, model.tag(features).collect()))


def load_again(spark, model):
    path = staged_path(spark, "context-tagger")
    taggers.save_context_tagger(path, model)
    return taggers.load_context_tagger(spark, path)


def test_context_tagger_counts(spark):
    """Scores by hand; a value that training lacks counts like any other unseen one."""
    rows = [("A", i, t) for i, t in enumerate([["a", "b"], ["b", "a", "a"], ["C"], ["b"]])]
    sents = spark.createDataFrame(rows, "CORP string, SENT_ID long, TOKENS array<string>")
    features = taggers.context_features(sents)
    gold = F.when(F.col("FORM") == "a", "NOUN").otherwise("VERB")
    model = taggers.train_context_tagger(features.withColumn("UNIV", gold))
    train = [(r.asDict(), "NOUN" if r["FORM"] == "a" else "VERB") for r in features.collect()]
    new = spark.createDataFrame([("A", 9, ["zzz", "a", "b", "9"])], "CORP string, SENT_ID long, TOKENS array<string>")
    for r in model.tag(taggers.context_features(new)).collect():
        score = {}
        for c in ("NOUN", "VERB"):
            own = [f for f, k in train if k == c]
            score[c] = math.log(len(own) / len(train))
            for f in taggers.CONTEXT_FEATURES:
                kinds = len({x[f] for x, _ in train})
                score[c] += math.log((sum(x[f] == r[f] for x in own) + 0.1) / (len(own) + 0.1 * kinds))
        assert r["PRED_UNIV"] == max(score, key=lambda c: (round(score[c], 9), c == "NOUN"))


def test_lexicon_round_trip(spark):
    counts = taggers.form_tag_counts(spark.createDataFrame([("a", "NN"), ("b", "ADV")], "FORM string, STTS string"))
    path = staged_path(spark, "lexicon")
    taggers.save_lexicon(path, taggers.train_lexicon(counts), taggers.train_suffixes(counts))
    lexicon, suffixes = taggers.load_lexicon(spark, path, suffixes=True)
    assert sorted(map(tuple, lexicon.collect())) == [("a", "NN"), ("b", "ADV")] == sorted(map(tuple, suffixes.collect()))


def test_best_sequences_against_all_sequences():
    """Every sequence is tried; of equal ones the first classes from the end win, as each place prefers them."""
    rng = np.random.default_rng(3)
    for _ in range(40):
        rows = [rng.integers(-3, 3, (n, 3)).tolist() for n in (0, 1, 4, 2, 5, 1)]
        steps = rng.integers(-3, 3, (4, 3))
        got = taggers.best_sequences(pa.array(rows, pa.list_(pa.list_(pa.int64()))), steps).to_pylist()
        for own, codes in zip(rows, got):
            def total(seq):
                return sum(own[i][c] + steps[0 if i == 0 else seq[i - 1] + 1][c] for i, c in enumerate(seq))

            want = min(itertools.product(range(3), repeat=len(own)), key=lambda seq: (-total(seq), seq[::-1]))
            assert tuple(codes) == want


def test_history_sees_the_tag_before(spark, tmp_path):
    """One word has two tags that only the tag before tells apart; the words around it are new in the test."""
    train = [("x", "DET"), ("run", "NOUN"), ("y", "PRON"), ("run", "VERB")]
    rows = [("A", s, i + 1, w if w == "run" else f"{w}{s % 7}", t) for s in range(60) for i, (w, t) in enumerate(train[2 * (s % 2): 2 * (s % 2) + 2])]
    tokens = spark.createDataFrame(rows, "CORP string, SENT_ID int, TOKN_ID int, FORM string, UNIV string")
    sents = tokens.groupBy("CORP", "SENT_ID").agg(F.array_sort(F.collect_list(F.struct("TOKN_ID", "FORM"))).alias("e")).select(
        "CORP", "SENT_ID", F.col("e.FORM").alias("TOKENS"))
    features = taggers.context_features(sents).join(tokens, ["CORP", "SENT_ID", "TOKN_ID", "FORM"])
    taggers.save_history_tagger(str(tmp_path / "h"), taggers.train_history_tagger(features))
    model = taggers.load_history_tagger(spark, str(tmp_path / "h"))
    tagged = model.tag(features).collect()
    assert len(tagged) == len(rows) and all(r["PRED_UNIV"] == r["UNIV"] for r in tagged)
    assert model.tag(features.limit(0)).count() == 0
