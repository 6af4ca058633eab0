"""Mixing sources to target weights along a domain - language - source tree.

The token budget flows down the tree by weight. A child can hold its tokens times the epochs allowed;
what it cannot take goes to its siblings by their weights first, and only what the siblings cannot take
either shows as a shortage of the parent, which its own siblings then fill. Each leaf takes whole
epochs and then a prefix of one more, in an order seeded by leaf and epoch.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagloom.llm.common import own_names
from tagloom.staging import stage

#: Rows behind one step of the running sum within a leaf.
BUCKET_ROWS = 50_000
LEAF = ["domain", "language", "source_name"]

#: Weights of the registered query; what is not named weighs 1.
DOMAIN_WEIGHTS = {"web": 5, "books": 3, "forum": 2}
LANGUAGE_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
DOMAINS = ("web", "books", "forum")
NONE = "(none)"


def source_domain() -> Column:
    """Domains of the test tables: seven sources each, by number."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"^src([0-9]{1,6})$", 1).try_cast("int")
    return F.coalesce(F.get(F.array(*map(F.lit, DOMAINS)), F.floor(number / 7).cast("int")), F.lit("other"))


def _weight(name, weights):
    out = F.lit(1)
    for key, value in weights.items():
        out = F.when(F.col(name) == key, value).otherwise(out)
    return out.cast("long")


def fill(children: DataFrame, parent: list, child: str) -> DataFrame:
    """Add `budget` to children (weight, cap, parent_budget): shares by weight, none above its cap.

    Whole numbers throughout; shares are rounded down, so a parent may lose fewer tokens than it has children.
    A weight of 0 means nothing of the child.
    """
    wanted = F.col("weight") > 0
    children = children.withColumn("cap", F.when(wanted, F.col("cap")).otherwise(0)).withColumn("weight", F.when(wanted, F.col("weight")).otherwise(1))
    ordered = W.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), child)
    before = F.coalesce(F.sum("cap").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(ordered.rowsBetween(0, W.unboundedFollowing))
    whole = W.partitionBy(*parent)
    full = children.withColumn("_full", F.col("cap") * weights <= (F.col("parent_budget") - before) * F.col("weight"))
    left = F.col("parent_budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(whole), F.lit(0))
    open_ = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(whole)
    share = F.when(F.col("_full"), F.col("cap")).otherwise(
        F.expr("div(_left * weight, _open)")
    )
    return full.withColumn("_left", left).withColumn("_open", open_).withColumn("budget", share).drop("_full", "_left", "_open")


def leaf_budgets(leaves: DataFrame, budget: int, epochs: int, domain_weights, language_weights) -> DataFrame:
    """Budgets of leaves (LEAF columns and tokens)."""
    # What is not wanted cannot be taken: its ancestors do not count on it either.
    wanted = (_weight("domain", domain_weights) > 0) & (_weight("language", language_weights) > 0)
    capped = leaves.withColumn("cap", F.when(wanted, F.col("tokens") * F.lit(epochs)).otherwise(0).cast("long"))

    def level(keys, weight, above):
        nodes = capped.groupBy(*keys).agg(F.sum("cap").alias("cap")).withColumn("weight", weight)
        if above is None:
            nodes = nodes.withColumn("parent_budget", F.lit(budget).cast("long"))
        else:
            nodes = nodes.join(above.select(*keys[:-1], F.col("budget").alias("parent_budget")), keys[:-1])
        return fill(nodes, keys[:-1], keys[-1])

    domains = level(LEAF[:1], _weight("domain", domain_weights), None)
    languages = level(LEAF[:2], _weight("language", language_weights), domains)
    sources = level(LEAF, F.lit(1).cast("long"), languages)
    return sources.select(*LEAF, F.col("budget"))


def _tokens():
    return F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


@own_names
def with_copies(
    docs: DataFrame, domain: Column, budget: int | None = None, epochs: int = 4, seed: int = 7,
    domain_weights=DOMAIN_WEIGHTS, language_weights=LANGUAGE_WEIGHTS,
) -> DataFrame:
    """`docs` with domain, n_tokens (words) and copies, how often the mixture takes the row (0: not at all).

    budget: tokens of the mixture; None stands for as many as there are. Null lang or source is a branch of
    its own, a null text has no tokens. Rows of a leaf that share an id share a place in its order, so
    they come in together or not at all. Weights are whole numbers from 0 on; 0 takes nothing of a branch.
    """
    for weights in (domain_weights, language_weights):
        for name, weight in weights.items():
            if not isinstance(weight, int) or weight < 0:
                raise ValueError(f"the weight of {name} must be a whole number from 0 on, not {weight!r}")
    names = ["domain", "n_tokens", "copies"]
    rows = docs.select(
        domain.alias("domain"), F.coalesce("lang", F.lit(NONE)).alias("language"), F.coalesce("source", F.lit(NONE)).alias("source_name"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), _tokens().alias("n_tokens"),
    )
    stats = rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))
    largest, total = stats.agg(F.max("n"), F.sum("tokens")).first()
    budget = (total or 0) if budget is None else budget
    epoch = F.when(F.col("tokens") > 0, F.expr("div(budget, tokens)")).otherwise(F.lit(0))
    plan = stats.join(
        leaf_budgets(stats.select(*LEAF, "tokens"), budget, epochs, domain_weights, language_weights), LEAF
    ).select(*LEAF, epoch.alias("whole"), (F.col("budget") - epoch * F.col("tokens")).alias("rest"))
    # Leaves are few next to rows. Written once, they are broadcast while small; beyond that Spark can split hot leaves.
    plan = stage(plan, "plan")
    # The order within a leaf: a hexadecimal digest, cut into as many buckets as the largest leaf asks for.
    place = F.concat(F.md5(F.concat_ws(":", F.lit(str(seed)), "whole", "id")), F.lit(":"), F.col("id"))
    digits = max(0, math.ceil(math.log(max(1, (largest or 0) / BUCKET_ROWS), 16)))
    placed = rows.join(plan, LEAF).withColumn("place", place).withColumn("bucket", F.substring("place", 1, digits))
    sums = placed.groupBy(*LEAF, "bucket", "rest").agg(F.sum("n_tokens").alias("inside"))
    running = W.partitionBy(*LEAF).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("inside").over(running), F.lit(0)))
    # Only the bucket in which a leaf's prefix ends is ordered row by row.
    last = sums.where("before <= rest").groupBy(*LEAF).agg(F.max(F.struct("bucket", "before")).alias("last")).select(*LEAF, "last.*")
    ending = placed.join(last, [*LEAF, "bucket"])
    ordered = W.partitionBy(*LEAF, "bucket").orderBy("place").rangeBetween(W.unboundedPreceding, W.currentRow)
    within = ending.withColumn("reach", F.col("before") + F.sum("n_tokens").over(ordered)).where("reach <= rest")
    cut = within.groupBy(*LEAF).agg(F.max("place").alias("cut"))
    leaf_plan = plan.join(last.select(*LEAF, F.col("bucket").alias("last_bucket")), LEAF, "left").join(cut, LEAF, "left")
    leaf_plan = leaf_plan.select(
        *[F.col(c).alias(f"_{c}") for c in LEAF], F.col("whole").alias("_whole"), F.col("last_bucket").alias("_bucket"), F.col("cut").alias("_cut"),
    )
    leaf_plan = stage(leaf_plan, "leaves")
    keyed = docs.select(
        *[c for c in docs.columns if c not in names],
        domain.alias("domain"), _tokens().alias("n_tokens"), F.coalesce("lang", F.lit(NONE)).alias("_lang"),
        F.coalesce("source", F.lit(NONE)).alias("_source"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_id"),
    )
    met = keyed.join(leaf_plan, (F.col("domain") == F.col("_domain")) & (F.col("_lang") == F.col("_language")) & (F.col("_source") == F.col("_source_name")))
    own = F.concat(F.md5(F.concat_ws(":", F.lit(str(seed)), "_whole", "_id")), F.lit(":"), F.col("_id"))
    # Before the last bucket all rows are in; in it, those up to the cut.
    taken = F.coalesce(
        (F.substring(own, 1, digits) < F.col("_bucket")) | ((F.substring(own, 1, digits) == F.col("_bucket")) & (own <= F.col("_cut"))),
        F.lit(False),
    )
    return met.withColumn("copies", F.col("_whole") + taken.cast("long")).select(
        *[c for c in docs.columns if c not in names], *names
    )


@own_names
def mix(docs: DataFrame, domain: Column | None = None, **settings) -> DataFrame:
    """The mixture itself: rows of `docs`, each as often as the mixture takes it; columns are kept."""
    counted = with_copies(docs.withColumn("_all", F.struct("*")), source_domain() if domain is None else domain, **settings)
    repeated = counted.where("copies > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select("_all.*")


def sql(epochs=4, seed=7) -> str:
    """copies of every document for DuckDB, with the registered weights and a budget of all tokens."""
    weight = lambda name, weights: "CASE " + " ".join(f"WHEN {name} = '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"

    def level(name, table, keys, child, weight_sql, above, group):
        by = f"PARTITION BY {', '.join(keys)} " if keys else ""
        parent = f"JOIN {above} USING ({', '.join(keys)})" if keys else f"CROSS JOIN (SELECT sum(cap) // {epochs} AS budget FROM leaf)"
        return f"""
{name}_n AS (
  SELECT n.*, budget AS pb FROM (SELECT {group}, sum(cap)::BIGINT AS cap, {weight_sql} AS w FROM {table} GROUP BY {group}) n {parent}
), {name}_o AS (
  SELECT *, cap * sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         <= (pb - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS sat
  FROM {name}_n WINDOW o AS ({by}ORDER BY cap / w, {child})
), {name} AS (
  SELECT {group}, CASE WHEN sat THEN cap ELSE
         ((pb - coalesce(sum(cap) FILTER (sat) OVER ({by}), 0)) * w) // (sum(w) FILTER (NOT sat) OVER ({by})) END AS budget
  FROM {name}_o
)"""

    domain = (
        "coalesce(['web', 'books', 'forum'][1 + try_cast(nullif(regexp_extract(coalesce(source, ''), '^src([0-9]{1,6})$', 1), '') AS INTEGER) // 7], 'other')"
    )
    return f"""
WITH d AS (
  SELECT doc_id, {domain} AS domain, coalesce(lang, '{NONE}') AS language, coalesce(source, '{NONE}') AS source_name,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens, coalesce(doc_id::VARCHAR, 'null') AS id
  FROM documents
), leaf AS (
  SELECT domain, language, source_name, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {epochs})::BIGINT AS cap FROM d GROUP BY ALL
),
{level("b1", "leaf", [], "domain", weight("domain", DOMAIN_WEIGHTS), None, "domain")},
{level("b2", "leaf", ["domain"], "language", weight("language", LANGUAGE_WEIGHTS), "b1", "domain, language")},
{level("b3", "leaf", ["domain", "language"], "source_name", "1", "b2", "domain, language, source_name")},
p AS (
  SELECT domain, language, source_name, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
         budget - (CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END) * tokens AS rest
  FROM b3 JOIN leaf USING (domain, language, source_name)
), o AS (
  SELECT *, md5(concat_ws(':', '{seed}', whole, id)) || ':' || id AS place FROM d JOIN p USING (domain, language, source_name)
)
SELECT doc_id, domain, n_tokens,
       (whole + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, language, source_name ORDER BY place) <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM o
"""
