"""Aggregates over experiment records: best, max, mean and min per key, and plot series."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.ordering import number_rows

MAXED = ("precision", "recall", "f1_weighted", "train_time", "test_time", "train_size")
TIMES = ("train_time", "test_time")
SWEEP_KEYS = ("embedding_size", "embedding_model", "lowercase", "scale", "C")

# The key values that plots show, and the labels of some of them.
PLOT_DOMAINS = {
    "embedding_size": (12, 25, 50, 100),
    "embedding_model": ("sg", "cb"),
    "max_iter": (-1, 1000),
    "scale": (False, True),
    "test_size": (2000000, 4853410),
    "train_size": (100000, 400000, 888237),
    "C": (1, 2, 1000),
    "lowercase": (False, True),
    "shrinking": (False, True),
}
PLOT_LABELS = {
    "cb": "CBOW", "sg": "Skip-gram", -1: "no limit",
    "train_size": "train-size", "test_size": "test-size",
}


def resolve_full_size(df: DataFrame, column, full) -> DataFrame:
    """A size of 0 stands for the whole corpus."""
    return df.withColumn(column, F.when(F.col(column) == 0, F.lit(full)).otherwise(F.col(column)))


def unlimited(df: DataFrame, column="max_iter") -> DataFrame:
    return df.where(F.col(column) == -1)


def leaderboard(df: DataFrame, score="f1_weighted", ties=("model",)) -> DataFrame:
    return df.orderBy(F.col(score).desc(), *ties)


def ranked(df: DataFrame, score="f1_weighted", ties=("model",)) -> DataFrame:
    """Runs with their `rank` in the leaderboard, numbered without one global window; `ties` make rows unique."""
    return number_rows(df.withColumn("_below", -F.col(score)), ["_below", *ties], name="rank").drop("_below")


def best_rows(df: DataFrame, keys, score="f1_weighted", order="model") -> DataFrame:
    """The whole row with the highest score per group; the first in `order` wins a tie.

    Two hash aggregates find score and order of the winner, then it is looked up. Only the
    small winner table is joined, so wide rows are never sorted.
    """
    keys = list(keys)
    top = df.groupBy(*keys).agg(F.max(score).alias(score))
    tied = df.join(top, keys + [score])
    return tied.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), order).alias("_row")).select("_row.*")


def group_stats(df: DataFrame, keys, scores=MAXED, times=TIMES) -> DataFrame:
    """max and mean of scores and times, min of times, per group; key columns are left out."""
    scores = [c for c in scores if c not in keys]
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"),
        *[F.max(c).alias(f"max_{c}") for c in scores],
        *[F.avg(c).alias(f"mean_{c}") for c in scores],
        *[F.min(c).alias(f"min_{c}") for c in times],
    )


def sweep(df: DataFrame, keys=SWEEP_KEYS, subset="train_size", score="f1_weighted",
          scores=MAXED, times=TIMES, model="model") -> DataFrame:
    """`group_stats` and the best model for every key, over all rows and per `subset` value.

    One GROUPING SETS pass. Rows: (key, value, subset value or null). The subset column is
    itself a key over all rows.

    Runs with equal keys and score collapse to the first model before the sets expand them, so
    the best model per score needs no sort of the raw rows.
    """
    spread_keys = [k for k in keys if k != subset]
    measures = list(dict.fromkeys([score, *scores, *times]))
    cells = df.groupBy(subset, *spread_keys, score).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(model).alias("_model"),
        *[F.sum(c).alias(f"_sum_{c}") for c in measures],
        *[F.max(c).alias(f"_max_{c}") for c in measures],
        *[F.min(c).alias(f"_min_{c}") for c in measures],
    )
    sets = [[subset]] + [[k] for k in spread_keys] + [[k, subset] for k in spread_keys]
    n = F.sum("_n")
    means = [F.try_divide(F.sum(f"_sum_{c}"), n).alias(f"mean_{c}") for c in scores]
    best = F.min_by("_model", F.struct(-F.col(score), F.col("_model"))).alias("best_model")
    grouped = cells.groupingSets(sets, subset, *spread_keys).agg(
        *[F.grouping(k).alias(f"_no_{k}") for k in [subset, *spread_keys]],
        n.alias("runs"),
        best,
        *[F.max(f"_max_{c}").alias(f"max_{c}") for c in scores],
        *means,
        *[F.min(f"_min_{c}").alias(f"min_{c}") for c in times],
    )
    key_name, key_value = F.lit(subset), F.col(subset).cast("string")
    only_subset = F.lit(True)
    for k in spread_keys:
        here = F.col(f"_no_{k}") == 0
        key_name = F.when(here, F.lit(k)).otherwise(key_name)
        key_value = F.when(here, F.col(k).cast("string")).otherwise(key_value)
        only_subset = only_subset & ~here
    in_subset = (F.col(f"_no_{subset}") == 0) & ~only_subset
    return grouped.select(
        key_name.alias("key"),
        key_value.alias("value"),
        F.when(in_subset, F.col(subset).cast("string")).alias("subset"),
        "runs", "best_model",
        *[f"max_{c}" for c in scores], *[f"mean_{c}" for c in scores], *[f"min_{c}" for c in times],
    )


def plot_series(df: DataFrame, columns, x="train_time", y="f1_weighted",
                domains=PLOT_DOMAINS, labels=PLOT_LABELS) -> DataFrame:
    """(series, x, y) points by one or two key columns; unlisted key values are left out."""
    def label(value):
        text = value.cast("string")
        for name, shown in labels.items():
            text = F.when(value.cast("string") == str(name), F.lit(shown)).otherwise(text)
        return text

    points = df
    for c in columns:
        points = points.where(F.col(c).isin(list(domains[c])))
    series = label(F.col(columns[0]))
    if len(columns) > 1:
        second = labels.get(columns[1], columns[1])
        series = F.concat(series, F.lit(f" | {second}: "), label(F.col(columns[1])))
    return points.select(series.alias("series"), F.col(x).alias("x"), F.col(y).alias("y"))


def join_records(configs: DataFrame, metrics: DataFrame, corpus="HDT", tagset="UNIV"):
    """(complete experiment rows, incomplete models) from config and metrics records."""
    run = F.col(corpus)
    scores = run[tagset]
    configs = configs.withColumnRenamed("train_size", "_train_size").withColumn("_config", F.lit(True))
    joined = configs.join(metrics, "model", "full_outer")
    complete = F.col("_config").isNotNull() & scores.isNotNull()
    rows = joined.where(complete).select(
        *[scores[c].alias(c) for c in ("accuracy", "precision", "recall", "f1_weighted")],
        "train_time", "train_size",
        run["test_time"].alias("test_time"), run["test_size"].alias("test_size"),
        F.col("dimensionality").alias("embedding_size"), F.col("architecture").alias("embedding_model"),
        "lowercase", "scale", "C", "max_iter", "model", "shrinking",
    )
    return rows, joined.where(~complete).select("model")
