import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.learn import features as ft
from tagloom.learn import svm
from tagloom.operators.joins import UnknownForms


def rows_of(spark, x, labels):
    data = [(f"f{i}", float(c), 1.0, [float(v) for v in row]) for i, (row, c) in enumerate(zip(x, labels))]
    return spark.createDataFrame(data, "FORM string, label double, w double, vec array<double>")


def share_right(tagger, rows):
    return tagger.predict(rows).agg(F.avg((F.col("code") == F.col("label")).cast("int"))).first()[0]


@pytest.fixture(scope="module")
def rings(spark):
    rng = np.random.default_rng(0)
    angle, radius = rng.random(400) * 2 * np.pi, np.repeat([1.0, 3.0], 200) + rng.normal(0, 0.1, 400)
    return rows_of(spark, np.column_stack([radius * np.cos(angle), radius * np.sin(angle)]), np.repeat([3, 7], 200))


def test_rings_need_the_kernel(rings):
    linear = svm.train_rows(rings, svm.SvmSettings("l", kernel="linear", max_iter=20))
    rbf = svm.train_rows(rings, svm.SvmSettings("r", kernel="rbf", components=40, max_iter=20, C=10))
    assert rbf.classes == [3, 7]
    assert share_right(linear, rings) < 0.75 < 0.97 < share_right(rbf, rings)


def test_predict_equals_the_ml_model(rings):
    tagger = svm.train_rows(rings, svm.SvmSettings("r", components=20, max_iter=5))
    mapped = ft.mapped(rings, tagger.kernel_map)
    want = {r["FORM"]: tagger.classes[int(r["prediction"])] for r in tagger.classifier.transform(mapped).collect()}
    assert {r["FORM"]: r["code"] for r in tagger.predict(rings).collect()} == want


def test_kernel_maps_are_close_to_the_kernel(rings):
    for kernel, bound in (("rbf", 0.02), ("poly", 1e-6)):
        found = ft.fit_kernel_map(rings, kernel, 2, components=80)
        assert ft.kernel_map_error(rings, found) < bound
    with pytest.raises(ValueError):
        ft.fit_kernel_map(rings, "sigmoid", 2)


def test_weights_equal_copies(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (60, 3))
    label = (x[:, 0] > 0).astype(int)
    rows = rows_of(spark, x, label).withColumn("w", F.when(F.col("FORM") < "f3", 3.0).otherwise(1.0))
    copies = rows.withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("w").cast("int")))).withColumn("w", F.lit(1.0))
    settings = dict(kernel="linear", max_iter=30)
    a = svm.train_rows(rows, svm.SvmSettings("a", **settings)).classifier.models[1].coefficients.toArray()
    b = svm.train_rows(copies, svm.SvmSettings("b", **settings)).classifier.models[1].coefficients.toArray()
    assert a == pytest.approx(b, rel=0.05, abs=0.05)  # the solver stops at its tolerance


def test_scaling_with_constant_dimension(spark):
    rows = rows_of(spark, [[1, 5, -1], [3, 5, 1], [2, 5, 0]], [0, 1, 0])
    low, high = ft.fit_bounds(rows)
    assert (low, high) == ([1, 5, -1], [3, 5, 1])
    assert [r["vec"] for r in ft.scale(rows, low, high).orderBy("FORM").collect()] == [[0, 0, 0], [1, 0, 1], [0.5, 0, 0.5]]


@pytest.fixture(scope="module")
def study(spark):
    """Tokens of 20 forms in two clusters; one form holds half of the tokens."""
    rng = np.random.default_rng(9)
    vec = [(f"w{i}", [float(x) for x in rng.normal(3 if i % 2 else -3, 0.5, 4)]) for i in range(20)]
    vectors = spark.createDataFrame(vec, "FORM string, vec array<float>")
    pick = [0 if rng.random() < 0.5 else int(rng.integers(0, 20)) for _ in range(1000)]
    tokens = [("A", i // 10, i % 10 + 1, f"w{k}".upper() if i % 7 == 0 else f"w{k}", "NOUN" if k % 2 else "VERB") for i, k in enumerate(pick)]
    return spark.createDataFrame(tokens, "CORP string, SENT_ID long, TOKN_ID int, FORM string, UNIV string"), vectors


def test_train_annotate_save_load(spark, study, tmp_path):
    tokens, vectors = study
    settings = svm.SvmSettings("pos", lowercase=True, scale=True, components=10, max_iter=20)
    tagger = svm.train(tokens, vectors, settings)
    assert settings.dimensionality == 4
    tagged = svm.annotate(tagger, tokens, vectors)
    assert tagged.count() == 1000
    right = tagged.join(tokens.withColumnRenamed("UNIV", "gold"), ["CORP", "SENT_ID", "TOKN_ID", "FORM"])
    assert right.where("UNIV = gold").count() == 1000
    assert svm.annotate(tagger, tokens, vectors, test_size=30).count() == 30

    svm.save(tagger, str(tmp_path))
    again = svm.load(spark, str(tmp_path), "pos")
    assert again.settings == tagger.settings
    key = ["CORP", "SENT_ID", "TOKN_ID"]
    assert svm.annotate(again, tokens, vectors).orderBy(key).collect() == tagged.orderBy(key).collect()
    with pytest.raises(svm.MissingModel, match="classifier"):
        svm.load(spark, str(tmp_path), "other")


def test_case_must_match_the_vectors(study):
    with pytest.raises(UnknownForms):
        svm.train(*study, svm.SvmSettings("pos", lowercase=False))


def test_featureset_counts_equal_rows(study):
    tokens, vectors = study
    rows = ft.featureset(tokens, vectors, size=100, lowercase=True).collect()
    assert sum(r["w"] for r in rows) == 100 and len(rows) == len({(r["FORM"], r["UNIV"]) for r in rows})


def test_study_leaves_joined_records(spark, study, tmp_path):
    """Train, save, tag and score: the readers find one complete experiment."""
    from tagloom.operators.leaderboard import join_records
    from tagloom.plans.workflows import run_study
    from tagloom.sinks.tables import write_vectors
    from tagloom.sources.records import read_configs, read_metrics

    tokens, vectors = study
    tokens = tokens.withColumn("FORM", F.lower("FORM"))
    write_vectors(vectors, str(tmp_path / "vectors"), "sg", 4, True)
    models = str(tmp_path / "models")
    svm.save(svm.train(tokens, vectors, svm.SvmSettings("pos", lowercase=True, scale=True, components=10)), models)
    tagged = run_study(spark, models, "pos", "HDT", tokens, tokens, str(tmp_path / "vectors"))
    assert tagged.count() == 1000
    rows, rejects = join_records(read_configs(spark, models), read_metrics(spark, models))
    row = rows.first()
    assert (row["model"], row["embedding_model"], row["embedding_size"], row["accuracy"]) == ("pos", "sg", 4, 1.0)
    assert row["train_time"] > 0 and row["test_time"] > 0 and rejects.isEmpty()
