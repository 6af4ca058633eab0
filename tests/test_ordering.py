import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.operators import joins, ordering


@pytest.fixture(scope="module", autouse=True)
def several_ranges(spark):
    """Small inputs would be coalesced to one range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def rows(spark):
    """3,000 tokens of two corpora; one document holds a third of them."""
    rng = np.random.default_rng(5)
    n = 3000
    doc = np.where(rng.random(n) < 0.34, 7, rng.integers(0, 200, n))
    pdf = pd.DataFrame({
        "CORP": np.where(doc % 2 == 1, "A", "B"), "D": doc, "POS": np.arange(n), "TOKN_ID": rng.integers(1, 6, n),
    }).sort_values(["CORP", "D", "POS"], ignore_index=True)
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1)).repartition(5)
    return pdf, df


def test_sentence_ids_match_shift_and_cumsum(rows):
    pdf, df = rows
    parts = []
    for _, g in pdf.groupby("CORP", sort=False):
        flag = g["TOKN_ID"] <= g["TOKN_ID"].shift(fill_value=1)
        parts.append(g.assign(BOUNDARY=flag, SENT_ID=flag.cumsum(), ROW_ID=np.arange(1, len(g) + 1)))
    want = pd.concat(parts, ignore_index=True)
    got = ordering.sentence_ids(df, ["CORP", "D", "POS"]).toPandas()
    got = got.sort_values(["CORP", "D", "POS"], ignore_index=True)
    for c in ("BOUNDARY", "SENT_ID", "ROW_ID"):
        assert (got[c] == want[c]).all(), c


def test_sentence_ids_move_rows_once(rows):
    """One range exchange before the pass; behind it only the summary of the ranges is joined."""
    _, df = rows
    result = ordering.sentence_ids(df, ["CORP", "D", "POS"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_carry_over_batches(size):
    """State crosses batches and ends with its cell; a null token is no boundary and none is compared with it."""
    rng = np.random.default_rng(size)
    cell = np.sort(rng.integers(0, 6, 200))
    token = [None if rng.random() < 0.05 else int(rng.integers(1, 5)) for _ in cell]
    table = pa.table({"c": pa.array([None if c == 3 else f"u{c}" for c in cell]), "TOKN_ID": pa.array(token, pa.int32())})
    got = pa.Table.from_batches(list(ordering._carry(["c"])(iter(table.to_batches(max_chunksize=size))))).to_pylist()
    prev, seen, nth = None, 0, 0
    for i, row in enumerate(got):
        # A cell without a name ends with every row: names are never null.
        same = i and cell[i] == cell[i - 1] and (cell[i] != 3 or i % size == 0)
        prev, seen, nth = (token[i - 1], seen, nth) if same else (None, 0, 0)
        seen += prev is not None and token[i] is not None and token[i] <= prev
        nth += 1
        assert (row["_prev"], row["_seen"], row["_nth"]) == (prev, seen, nth)


def test_hot_document_is_cut_into_ranges(rows):
    _, df = rows
    units = ordering.range_ordered(df, ["CORP", "D", "POS"]).groupBy("_unit").count().toPandas()
    assert len(units) > 1 and units["count"].max() < 1000


def test_number_rows(rows):
    pdf, df = rows
    got = ordering.number_rows(df, ["CORP", "D", "POS"]).toPandas().sort_values("ROW_ID")
    assert got["ROW_ID"].tolist() == list(range(1, 3001))
    assert got["POS"].tolist() == pdf["POS"].tolist()
    per = ordering.number_rows(df, ["D", "POS"], within=["CORP"]).groupBy("CORP").agg(
        F.min("ROW_ID").alias("lo"), F.max("ROW_ID").alias("hi"), F.countDistinct("ROW_ID").alias("n")).collect()
    assert all(r["lo"] == 1 and r["hi"] == r["n"] for r in per)


def test_numbering_moves_rows_once(rows):
    """Behind the range exchange only the summary of the ranges is joined; rows that lie in ranges are not moved at all."""
    pdf, df = rows
    plan = ordering.number_rows(df, ["CORP", "D", "POS"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    ranged = df.repartitionByRange(6, "CORP", "D")
    kept = ordering._sorted_ranges(ranged, ["CORP", "D", "POS"], True)._jdf.queryExecution().executedPlan().toString()
    assert kept.count("rangepartitioning") <= 2  # AQE prints its plan twice at most
    got = ordering.number_rows(ranged, ["CORP", "D", "POS"], ranged=True, keep=["POS"]).toPandas().sort_values("ROW_ID")
    assert got["POS"].tolist() == pdf["POS"].tolist() and got["ROW_ID"].tolist() == list(range(1, 3001))
    ids = [ordering.sentence_ids(d, ["CORP", "D", "POS"], ranged=r).select("POS", "SENT_ID", "ROW_ID").toPandas().sort_values("POS") for d, r in ((df, False), (ranged, True))]
    assert (ids[0].to_numpy() == ids[1].to_numpy()).all()


def test_short_slices_are_picked_by_partition(rows):
    """No row but the first of each partition is moved."""
    _, df = rows
    for found in (ordering.head(df, ["CORP", "D", "POS"], 5), ordering.preview(df, ["CORP", "D", "POS"], -5)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "ordered-" not in plan


def test_long_slices_are_numbered(rows, monkeypatch):
    pdf, df = rows
    monkeypatch.setattr(ordering, "PICKED_ROWS", 3)
    key = ["CORP", "D", "POS"]
    assert sorted(r["POS"] for r in ordering.head(df, key, 5).collect()) == sorted(pdf["POS"].tolist()[:5])
    assert [r["POS"] for r in ordering.preview(df, key, -5).collect()] == pdf["POS"].tolist()[-5:]


@pytest.mark.parametrize("n", [1, 500, 2999])
def test_head(rows, n):
    pdf, df = rows
    got = ordering.head(df, ["CORP", "D", "POS"], n).toPandas().sort_values(["CORP", "D", "POS"])
    assert got["POS"].tolist() == pdf["POS"].tolist()[:n]
    assert ordering.head(df, ["CORP", "D", "POS"], 0).count() == 3000


def test_preview(rows):
    pdf, df = rows
    key = ["CORP", "D", "POS"]
    assert [r["POS"] for r in ordering.preview(df, key, 5).collect()] == pdf["POS"].tolist()[:5]
    assert [r["POS"] for r in ordering.preview(df, key, -5).collect()] == pdf["POS"].tolist()[-5:]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 997)).alias("FORM"), "id")
    counts = left.groupBy("FORM").agg(F.count("*").alias("n"))
    right = counts.where("FORM <> 'w5'").select("FORM", F.length("FORM").alias("x"))
    hot = joins.hot_keys(counts, parts=100)
    assert hot == ["hot"]
    got = joins.salted_join(left, right, "FORM", hot, ["id"], salts=7)
    assert sorted(map(tuple, got.select("FORM", "id", "x").collect()), key=str) == sorted(
        map(tuple, left.join(right, "FORM", "left").select("FORM", "id", "x").collect()), key=str)


def test_vector_policies(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "FORM string")
    vec = spark.createDataFrame([("a", [1.0, 2.0])], "FORM string, vec array<float>")
    with pytest.raises(joins.UnknownForms, match="b"):
        joins.attach_vectors(rows, vec)
    assert joins.attach_vectors(rows, vec, "drop").count() == 1
    zero = {r["FORM"]: r["vec"] for r in joins.attach_vectors(rows, vec, "zero").collect()}
    assert zero == {"a": [1.0, 2.0], "b": [0.0, 0.0]}
