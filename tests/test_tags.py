import pytest
from pyspark.sql import functions as F

from tagloom.functions import tags as tg


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn("x").alias("y")).first()[0]


@pytest.mark.parametrize("raw,fixed", [("NNE", "NE"), ("PPOSSAT", "PPOSAT"), ("VAIZU", "VVIZU"), ("PIDAT", "PIDAT"), ("ZZZ", "ZZZ")])
def test_fix_tag(spark, raw, fixed):
    assert one(spark, raw, tg.fix_tag) == fixed


def test_fix_by_corpus(spark):
    rows = spark.createDataFrame([("HDT", "PIDAT"), ("TIGER", "PIDAT"), ("HDT", "NNE"), ("OTHER", "NNE")], "CORP string, STTS string")
    got = [r[0] for r in rows.select(tg.fix_tag_by_corpus()).collect()]
    assert got == ["PIAT", "PIDAT", "NE", "NNE"]


def test_strict_map_stops_and_lenient_map_gives_null(spark):
    with pytest.raises(Exception, match="unknown STTS tag: ZZZ"):
        one(spark, "ZZZ", tg.universal)
    with pytest.raises(Exception, match="unknown STTS tag"):
        one(spark, "NNE", tg.universal)
    assert one(spark, "ZZZ", tg.universal_or_null) is None
    assert one(spark, "NNE", tg.universal_or_null) == "NOUN"


def test_every_tag_has_a_class(spark):
    rows = spark.createDataFrame([(t,) for t in tg.STTS_TO_UNIV], "STTS string")
    got = rows.select("STTS", tg.universal().alias("u")).withColumn("c", tg.encode_class("u")).withColumn(
        "back", tg.decode_class("c")).collect()
    assert len(got) == 54
    assert all(r["u"] == tg.STTS_TO_UNIV[r["STTS"]] == r["back"] for r in got)
    assert {r["c"] for r in got} == set(range(12))


def test_default_tagset():
    assert len(tg.STTS_DEFAULT) == 54 and "PAV" in tg.STTS_DEFAULT and "PROAV" not in tg.STTS_DEFAULT


def test_token_number(spark):
    assert one(spark, "12_3", tg.token_number) == 3
    with pytest.raises(Exception):
        one(spark, "12_x", tg.token_number)


def test_lemma_or_form(spark):
    rows = spark.createDataFrame([("a", "--"), ("b", ""), ("c", "x")], "FORM string, LEMM string")
    assert [r[0] for r in rows.select(tg.lemma_or_form()).collect()] == ["a", "", "x"]


def test_literals_with_quotes(spark):
    got = spark.range(1).select(tg.lookup({"it's": "a\\b"}, F.lit("it's"))).first()[0]
    assert got == "a\\b"
