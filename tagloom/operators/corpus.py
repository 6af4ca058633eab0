"""Sentences, vocabulary and the word statistics that vector training needs."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tags import folded
from tagloom.operators.ordering import number_rows
from tagloom.schemas import CORP, FORM, SENT_ID, TOKENS, TOKN_ID


def sentences(tokens: DataFrame, lowercase=False, key=(CORP, SENT_ID)) -> DataFrame:
    """One row per sentence with its forms in order."""
    entry = F.struct(F.col(TOKN_ID), folded(FORM, lowercase).alias(FORM))
    grouped = tokens.groupBy(*key).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    return grouped.select(*key, F.col(f"_entries.{FORM}").alias(TOKENS))


def folded_sentences(sents: DataFrame, lowercase) -> DataFrame:
    if not lowercase:
        return sents
    return sents.withColumn(TOKENS, F.transform(TOKENS, F.lower))


def union_corpora(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def forms_of(sents: DataFrame) -> DataFrame:
    return sents.select(F.explode(TOKENS).alias(FORM))


def vocabulary(forms: DataFrame, by=()) -> DataFrame:
    """Every form with its count; the partial aggregate absorbs hot forms."""
    return forms.groupBy(*by, FORM).agg(F.count(F.lit(1)).alias("n"))


def most_frequent_first(vocab: DataFrame) -> DataFrame:
    return vocab.orderBy(F.col("n").desc(), FORM)


def ranked(vocab: DataFrame) -> DataFrame:
    """Forms with their `rank`, the most frequent first, ties by form."""
    return number_rows(vocab.withColumn("_below", -F.col("n")), ["_below", FORM], name="rank").drop("_below")


def keep_probabilities(vocab: DataFrame, sample=1e-3) -> DataFrame:
    """Keep probability of a form under frequent-word subsampling (Mikolov et al. 2013)."""
    total = vocab.agg(F.sum("n")).first()[0] or 1
    share = F.col("n") / F.lit(sample * total)
    keep = (F.sqrt(share) + 1) / share
    return vocab.withColumn("keep", F.least(keep, F.lit(1.0)))


def subsample(tokens: DataFrame, vocab: DataFrame, sample=1e-3, seed=1, key=(CORP, SENT_ID, TOKN_ID)):
    """Drop frequent forms at random; the draw is a hash of the token key, so it can be retried."""
    rates = _low_rates(vocab, sample)
    if not rates:
        return tokens
    rate = F.coalesce(
        F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])[F.col(FORM)], F.lit(1.0)
    )
    return tokens.where(_draw(seed, [F.col(k) for k in key]) < rate)


def _low_rates(vocab, sample):
    kept = keep_probabilities(vocab, sample).where(F.col("keep") < 1).select(FORM, "keep")
    # A form below 1 has a share of the tokens above `sample`: there are at most 1 / sample of them.
    return {r[FORM]: r["keep"] for r in kept.collect()}


def _draw(seed, key):
    """A number from 0 to 1 that depends on the key alone, so it can be retried."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]))
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long") / F.lit(float(1 << 32))


def negative_distribution(vocab: DataFrame, power=0.75) -> DataFrame:
    """Sampling probability of each form as a negative example."""
    mass = vocab.agg(F.sum(F.pow("n", F.lit(power)))).first()[0] or 1.0
    return vocab.withColumn("p", F.pow("n", F.lit(power)) / F.lit(mass))


#: A token's contexts share this weight in CBOW counts: divisible by every number up to 10.
CBOW_SHARE = 2520


def pair_counts(sents: DataFrame, window=5, arch="sg") -> DataFrame:
    """(CENTER, CONTEXT, n): symmetric co-occurrence counts as skip-gram or CBOW weighs them.

    sg: every pair counts 1. cb: a token's contexts share one unit of CBOW_SHARE, as they are averaged
    there, and the two roles of a pair are added. Whole numbers; windows of 5 divide without rest. One
    direction is counted, the mirror is added to the counts.
    """
    if arch not in ("sg", "cb"):
        raise ValueError(f"unknown architecture {arch}")
    m = F.size(TOKENS)

    def share(i):
        around = F.least(i, F.lit(window)) + F.least(m - 1 - i, F.lit(window))
        return F.when(around > 0, F.floor(F.lit(CBOW_SHARE) / around)).otherwise(0).cast("long")

    weighed = F.transform(TOKENS, lambda x, i: F.struct(x.alias("f"), (share(i) if arch == "cb" else F.lit(0)).alias("w")))
    rows = sents.select(F.explode(F.array(weighed)).alias("_t"))
    after = F.transform("_t", lambda x, i: F.struct(x.alias("a"), F.slice("_t", i + 2, F.lit(window)).alias("after")))
    hits = rows.select(F.inline(after)).select("a", F.explode("after").alias("b"))
    unit = F.lit(1).cast("long") if arch == "sg" else F.col("a.w") + F.col("b.w")
    return _mirrored(hits, "a.f", "b.f", unit)


def _mirrored(hits, a, b, unit):
    """Sum `unit` per unordered pair, and give both directions."""
    counted = hits.groupBy(F.least(a, b).alias("A"), F.greatest(a, b).alias("B")).agg(F.sum(unit).alias("n"))
    # A pair of equal forms is its own mirror and counts twice.
    sides = F.when(
        F.col("A") == F.col("B"),
        F.array(F.struct(F.col("A").alias("CENTER"), F.col("B").alias("CONTEXT"), (F.col("n") * 2).alias("n"))),
    ).otherwise(
        F.array(
            F.struct(F.col("A").alias("CENTER"), F.col("B").alias("CONTEXT"), F.col("n")),
            F.struct(F.col("B").alias("CENTER"), F.col("A").alias("CONTEXT"), F.col("n")),
        )
    )
    return counted.select(F.inline(sides))


def shrunk_pair_counts(sents: DataFrame, window=5) -> DataFrame:
    """(CENTER, CONTEXT, n): co-occurrences as word2vec's random windows weigh them, times `window`.

    A window is cut to a random size from 1 to `window`, so a pair at distance d is met in window - d + 1
    of `window` cases. The expectation is taken, in whole numbers.
    """
    after = F.transform(TOKENS, lambda x, i: F.struct(x.alias("a"), F.slice(TOKENS, i + 2, F.lit(window)).alias("after")))
    hits = sents.select(F.inline(after)).select("a", F.posexplode("after").alias("d", "b"))
    return _mirrored(hits, "a", "b", (F.lit(window) - F.col("d")).cast("long"))


def subsampled_sentences(sents: DataFrame, vocab: DataFrame, sample=1e-3, seed=1) -> DataFrame:
    """Sentences without the tokens that `subsample` drops; the key is all columns but the tokens."""
    rates = _low_rates(vocab, sample)
    if not rates:
        return sents
    key = [c for c in sents.columns if c != TOKENS]
    rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])

    def stays(form, i):
        kept = F.try_element_at(rate, form)
        return kept.isNull() | (_draw(seed, [*[F.col(k) for k in key], i + 1]) < kept)

    return sents.withColumn(TOKENS, F.filter(TOKENS, stays))
