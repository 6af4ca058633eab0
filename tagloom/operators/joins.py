"""Lookups that stay balanced under hot keys, and their out-of-vocabulary policies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tags import literal_map
from tagloom.schemas import FORM

HOT_PARTS = 1000  # a key with more than 1/1000 of the rows is hot, so there are at most 1000


def hot_keys(counts: DataFrame, key=FORM, n="n", parts=HOT_PARTS):
    """Keys that hold more than 1/parts of all rows; the list has at most `parts` entries."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    hot = counts.where(F.col(n) * parts > total)
    return [r[0] for r in hot.select(key).collect()]


def salted_join(rows: DataFrame, table: DataFrame, on, hot, spread_by, how="left", salts=None):
    """Join where the rows of hot keys are spread over `salts` copies of the matching table rows.

    The salt is a hash of `spread_by`, so a retried task makes the same choice.
    """
    if not hot:
        return rows.join(table, on, how)
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(on).isin(hot)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(0).cast("int")
    last = F.when(is_hot, F.lit(salts - 1)).otherwise(0)
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return rows.withColumn("_salt", salt).join(copies, [on, "_salt"], how).drop("_salt")


class UnknownForms(ValueError):
    """Some forms have no vector."""


def attach_vectors(rows: DataFrame, vectors: DataFrame, oov="error") -> DataFrame:
    """Attach `vec` by FORM. `rows` has one row per form (and label), never one per token.

    oov: 'error' stops when a form has no vector, 'drop' leaves it out, 'zero' gives zeros.
    """
    vectors = vectors.select(FORM, "vec")
    if oov == "error":
        missing = unknown_forms(rows, vectors).limit(5).collect()
        if missing:
            raise UnknownForms(f"no vector for {[r[0] for r in missing]}")
        return rows.join(vectors, FORM)
    if oov == "drop":
        return rows.join(vectors, FORM)
    if oov == "zero":
        dim = vectors.select(F.size("vec")).first()[0]
        return rows.join(vectors, FORM, "left").withColumn(
            "vec", F.coalesce("vec", F.array_repeat(F.lit(0.0), dim).cast("array<float>"))
        )
    raise ValueError(f"unknown oov policy {oov}")


def unknown_forms(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    return rows.select(FORM).distinct().join(vectors.select(FORM), FORM, "left_anti")


def map_join(df: DataFrame, mapping, key, value) -> DataFrame:
    """Inner lookup in a fixed map: rows with unknown keys leave."""
    looked_up = df.withColumn(value, literal_map(mapping)[F.col(key)])
    return looked_up.where(F.col(value).isNotNull())
