import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tagloom.functions.scores import round_half_even
from tagloom.operators import scoring, tagset
from tagloom.plans import workflows


def brute_force(gold, pred):
    """Class metrics in plain Python, straight from the definitions."""
    rows, pairs = {}, list(zip(gold, pred))
    for c in {x for x in [*gold, *pred] if x is not None}:
        count = sum(g == c for g, _ in pairs)
        tp = sum(g == c == p for g, p in pairs)
        fp = sum(p == c != g for g, p in pairs)
        rows[c] = [count, tp, fp, count - tp]

    def prf(count, tp, fp, fn):
        p = 1 if tp + fp == 0 else tp / (tp + fp)
        r = 1 if tp + fn == 0 else tp / (tp + fn)
        return [p, r, 0 if p + r == 0 else 2 * p * r / (p + r)]

    full = {c: v + prf(*v) for c, v in rows.items()}
    table = np.array(list(full.values()), dtype=float)
    total = table[:, :4].sum(0)
    weights = table[:, 0]
    full["sum"] = [*total, *prf(*total)]
    full["weighted avg"] = [*np.trunc(table[:, :4].mean(0)), *(np.average(table[:, i], weights=weights) for i in (4, 5, 6))]
    return full, table[:, 6].mean()


@pytest.fixture(scope="module")
def tags():
    rng = np.random.default_rng(2)
    gold = rng.choice(list("abcd"), 500, p=[0.4, 0.3, 0.2, 0.1]).tolist()
    pred = [g if rng.random() < 0.6 else str(rng.choice(list("abxy"))) for g in gold]
    pred[3] = None
    return gold, pred


def test_class_metrics_against_definition(spark, tags):
    gold, pred = tags
    df = spark.createDataFrame(list(zip(gold, pred)), "GOLD_TAG string, PRED_TAG string")
    want, macro = brute_force(gold, pred)
    got = {r["class"]: r for r in scoring.class_metrics(scoring.class_counts(df)).collect()}
    assert set(got) == set(want)
    for c, row in want.items():
        values = [got[c][k] for k in ("count", "tp", "fp", "fn", "precision", "recall", "f1")]
        assert values == pytest.approx(row), c
    assert got["x"]["recall"] == 1 and got["x"]["precision"] == 0 and got["x"]["f1"] == 0
    summary = scoring.score_summary(scoring.class_counts(df)).first()
    assert summary["test_size"] == 500
    assert summary["accuracy"] == round(want["sum"][4], 3)
    assert summary["f1_weighted"] == pytest.approx(round(want["weighted avg"][6], 3))
    assert summary["f1_macro"] == pytest.approx(round(macro, 3))


def test_weighted_cells_equal_tokens(spark, tags):
    df = spark.createDataFrame(list(zip(*tags)), "GOLD_TAG string, PRED_TAG string")
    cells = df.groupBy("GOLD_TAG", "PRED_TAG").agg(F.count("*").alias("n"))
    a = scoring.class_counts(df).orderBy("class").collect()
    assert a == scoring.class_counts(cells, weight="n").orderBy("class").collect()


def test_grid_groups(spark, tags):
    df = spark.createDataFrame([(g, p, t) for t in ("one", "two") for g, p in zip(*tags)], "GOLD_TAG string, PRED_TAG string, tagger string")
    rows = scoring.score_summary(scoring.class_counts(df, by=["tagger"]), by=["tagger"]).collect()
    assert len(rows) == 2 and rows[0]["accuracy"] == rows[1]["accuracy"]


def annotation(spark, rows):
    return spark.createDataFrame(rows, "CORP string, SENT_ID long, TOKN_ID int, FORM string, STTS string, UNIV string")


def test_evaluate_and_alignment_errors(spark):
    gold = annotation(spark, [("A", 1, 1, "x", "NN", "NOUN"), ("A", 1, 2, "y", "ADV", "ADV"), ("A", 2, 1, "z", "NN", "NOUN")])
    pred = annotation(spark, [("A", 1, 1, "x", "NN", "NOUN"), ("A", 2, 1, "z", "ADV", "ADV"), ("A", 1, 2, "y", "ADV", "ADV")])
    metrics, summary = workflows.evaluate(pred, gold, "STTS")
    assert summary.first()["accuracy"] == 0.667
    assert {r["class"] for r in metrics.collect()} == {"NN", "ADV", "sum", "weighted avg"}
    with pytest.raises(scoring.Misaligned, match="'missing_pred': 1"):
        workflows.evaluate(pred.where("TOKN_ID < 2"), gold, "STTS")
    cut = workflows.evaluate(pred.where("SENT_ID = 1"), gold, "STTS", cut_gold=True)[1].first()
    assert cut["test_size"] == 2 and cut["accuracy"] == 1.0
    assert scoring.aligned_or_raise(pred, gold, "UNIV").count() == 3
    with pytest.raises(scoring.Misaligned, match="'text_mismatch': 3"):
        workflows.evaluate(pred.withColumn("FORM", F.lit("q")), gold, "STTS")


def test_half_even_rounding(spark):
    values = [0.0625, 0.0635, 2.0475, 0.5, 0.1235, 0.9995]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(round_half_even("x")).collect()]
    assert got == np.round(values, 3).tolist()


def test_tagsets(spark):
    df = spark.createDataFrame(
        [("NN", "N"), ("NN", "NX"), ("_", "_"), ("", ""), ("PROAV", "PROAV"), ("ADJA", "A")], "STTS string, REDU string")
    summary = tagset.tagset_summary(df).first()
    assert summary["tags"] == ["ADJA", "NN", "PROAV"] and summary["size"] == 3
    assert [r[0] for r in tagset.extra_tags(df).collect()] == ["PROAV"]
    missing = {r[0] for r in tagset.missing_tags(df).collect()}
    assert len(missing) == 52 and "PAV" in missing
    assert [tuple(r) for r in tagset.reduced_mapping(df).collect()] == [("ADJA", "A"), ("NN", "NX")]
    assert pd.DataFrame(tagset.tag_counts(df, "STTS").collect())[1].sum() == 6


def test_positions(spark):
    """A lost row moves everything behind it; the first difference is where it was."""
    gold = spark.createDataFrame([("A", i, f"w{i}", "N") for i in range(50)] + [("B", i, "x", "V") for i in range(5)], "CORP string, k int, FORM string, STTS string")
    pred = gold.where("not (CORP = 'A' and k = 20)").withColumn("k", F.col("k") * 3)
    report = {r["CORP"]: r for r in scoring.position_report(scoring.zipped(pred.repartition(4), gold.repartition(3), "STTS", ["k"], ["k"], ["CORP"]), ["CORP"]).collect()}
    assert report["A"]["first_difference"] == 21 and report["A"]["missing_pred"] == 1 and report["A"]["text_mismatch"] == 29
    assert report["B"]["first_difference"] is None and report["B"]["n_pred"] == report["B"]["n_gold"] == 5
    with pytest.raises(scoring.Misaligned, match="21"):
        scoring.zipped_or_raise(pred, gold, "STTS", ["k"], ["k"], ["CORP"])
    same = scoring.zipped_or_raise(gold, gold, "STTS", ["k"], ["k"], ["CORP"])
    assert same.where("PRED_TXT = GOLD_TXT and PRED_TAG = GOLD_TAG").count() == 55
    assert scoring.position_report(scoring.zipped(gold.limit(0), gold.limit(0), "STTS", ["k"], ["k"])).first()["n_pred"] == 0


def test_tagset_differences(spark):
    rows = [("A", "NN", "N"), ("A", "NN", "N"), ("A", "QQ", "_"), ("B", "_", ""), ("B", None, None)]
    df = spark.createDataFrame(rows, "CORP string, STTS string, REDU string")
    got = {tuple(r) for r in tagset.tagset_differences(df).collect()}
    assert ("A", "STTS", "QQ", "extra") in got and ("A", "REDU", "N", "extra") in got
    assert ("A", "STTS", "ART", "missing") in got and ("A", "STTS", "NN", "missing") not in got
    assert {r[0] for r in got} == {"A"}  # a group without real tags is not reported
    assert tagset.tagset_differences(df.limit(0)).count() == 0
