"""Annotations made and compared where lines lie, and counts before raw columns; on tables of their own."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom.learn import taggers
from tagloom.operators import scoring as sc
from tagloom.plans import testbed as tb
from tagloom.plans.queries import QUERIES
from tagloom.schemas import FORM, STTS, TOKN_ID
from tagloom.staging import joins_in_place

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    texts = ["Der Hund bellt, 12 mal.\nund\n\nSchon das zweite!", "the cat of 7 lives", "", None, "Änne läuft\nin  Köln: (sehr) oft"]
    docs = [(i % 17 if i % 6 else None, texts[i % 5]) for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{root}/documents.parquet")
    turns = [(i, i % 3, texts[(i + 1) % 5]) for i in range(20)]
    spark.createDataFrame(turns, "conv_id long, turn long, text string").write.parquet(f"{root}/conversations.parquet")
    return root


@pytest.fixture
def fixed_plans(spark):
    """Plans as they are made, without broadcast of these small tables."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_tokens_are_counted_before_they_get_raw_columns(spark, tables, fixed_plans):
    found = QUERIES["minimal_scan"](spark, tables)
    assert found.columns == [TOKN_ID, FORM, "RAW_LEMM", "RAW_STTS", "n"]
    want = Counter(tuple(r) for r in tb.tokens(spark, tables).select(TOKN_ID, FORM, "RAW_LEMM", "RAW_STTS").collect())
    assert rows(found) == Counter({(*key, n): 1 for key, n in want.items()})
    moved = re.findall(r"hashpartitioning\((TOKN_ID.*?)\), ENSURE", plan(found))
    assert moved and not any("RAW" in keys or keys.count("#") > 2 for keys in moved)


def test_tokens_dealt_to_parts_are_tagged_and_aligned_without_being_moved(spark, tables, fixed_plans):
    forms = tb.placed(spark, tables, "B").select(FORM).distinct()
    tagged = forms.where("length(FORM) <> 3").withColumn(f"PRED_{STTS}", F.concat(F.lit("T"), F.length(FORM)))

    def aligned(dealt, key, **where):
        tokens = taggers.tag_tokens(tb.placed(spark, tables, "B", dealt=dealt), tagged, tb.KEY, **where)
        found = sc.align(tokens.withColumnRenamed(f"PRED_{STTS}", STTS), tb.gold(spark, tables, dealt=dealt), STTS, key)
        return found.select(*tb.KEY, "GOLD_TXT", "PRED_TXT", "GOLD_TAG", "PRED_TAG", "_p", "_g")

    before = spark.conf.get(CO_PARTITION)
    with joins_in_place(spark):
        here = aligned(tb.in_parts(5), [tb.PART, *tb.KEY], part=tb.PART, parts=5)
        assert not re.search(r"Exchange hashpartitioning\([^)]*TOKN_ID", plan(here))
        got = rows(here)
    assert spark.conf.get(CO_PARTITION) == before
    assert got == rows(aligned(None, tb.KEY)) and len(got) > 50


@pytest.mark.parametrize("name", ["align_gold_predictions", "alignment_report", "tagger_accuracy", "annotation_profile"])
def test_annotation_queries_leave_the_setting_as_it_was(spark, tables, name):
    before = spark.conf.get(CO_PARTITION)
    assert QUERIES[name](spark, tables).count() > 0
    assert spark.conf.get(CO_PARTITION) == before
