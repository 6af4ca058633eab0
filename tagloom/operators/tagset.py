"""Tagset profiles and differences."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tags import STTS_DEFAULT
from tagloom.schemas import CORP, REDU, STTS


def tag_counts(df: DataFrame, *columns) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def tagset(df: DataFrame, column=STTS, by=()) -> DataFrame:
    """Distinct real tags; '_' and '' are placeholders."""
    return df.where(~F.col(column).isin("_", "")).select(*by, column).distinct()


def default_tagset(spark, column=STTS) -> DataFrame:
    return spark.createDataFrame([(t,) for t in sorted(STTS_DEFAULT)], f"{column} string")


def tagset_summary(df: DataFrame, column=STTS, by=()) -> DataFrame:
    """Sorted tagset as one array per group, with its size. Groups hold tags, not tokens."""
    tags = F.array_sort(F.collect_set(column))
    summary = tagset(df, column, by).groupBy(*by).agg(tags.alias("tags"))
    return summary.withColumn("size", F.size("tags"))


def extra_tags(df: DataFrame, column=STTS) -> DataFrame:
    """Tags of the corpus that the default tagset lacks."""
    return tagset(df, column).join(default_tagset(df.sparkSession, column), column, "left_anti")


def missing_tags(df: DataFrame, column=STTS) -> DataFrame:
    """Default tags that the corpus lacks."""
    return default_tagset(df.sparkSession, column).join(tagset(df, column), column, "left_anti")


def tagset_differences(df: DataFrame, columns=(STTS, REDU), by=(CORP,)) -> DataFrame:
    """Per group and tag column: (tag, side), 'extra' to the default tagset or 'missing' from the group.

    The tokens are read once; what is compared are distinct tags. A group without real tags is not reported.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("tag")) for c in columns])).alias("c")
    tags = df.select(*by, cells).select(*by, "c.kind", "c.tag").where(~F.col("tag").isin("_", "")).distinct()
    default = F.array(*[F.lit(t) for t in sorted(STTS_DEFAULT)])
    # A set of tags per group: tagsets are small whatever the corpus.
    sets = tags.groupBy(*by, "kind").agg(F.collect_set("tag").alias("own"))
    sides = {"extra": F.array_except("own", default), "missing": F.array_except(default, "own")}
    listed = F.concat(*[F.transform(s, lambda t: F.struct(t.alias("tag"), F.lit(n).alias("side"))) for n, s in sides.items()])
    return sets.select(*by, "kind", F.inline(listed))


def reduced_mapping(df: DataFrame, tag=STTS, reduced=REDU) -> DataFrame:
    """Tag -> reduced tag where they differ; of several, the last in sorted order counts."""
    pairs = tag_counts(df, tag, reduced).where(F.col(tag) != F.col(reduced))
    return pairs.groupBy(tag).agg(F.max(reduced).alias(reduced)).orderBy(reduced, tag)
