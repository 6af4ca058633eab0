"""Sentence taggers: applying any callable, and two trainable baselines."""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.tags import encode_class, lookup, universal_or_null
from tagloom.operators.joins import salted_join
from tagloom.schemas import CORP, FORM, SENT_ID, STTS, TOKENS, TOKN_ID, UNIV
from tagloom.sinks.records import write_record
from tagloom.sources.records import read_record
from tagloom.staging import ship_package, stage


def tag_sentences(
    sents: DataFrame, tagger: Callable[[list[str]], list[str]], workers=0, key=(CORP, SENT_ID)
) -> DataFrame:
    """Run a picklable sentence tagger on all partitions; one row per token.

    `workers` > 0 sets the number of partitions; 0 keeps those of the input.
    """
    ship_package(sents.sparkSession)
    key = list(key)
    sents = sents.select(*key, TOKENS)
    if workers > 0:
        sents = sents.repartition(workers, *key)
    schema = T.StructType([*sents.schema.fields, T.StructField("TAGS", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["TAGS"] = [list(tagger(list(tokens))) for tokens in batch[TOKENS]]
            yield batch

    tagged = sents.mapInPandas(run, schema)
    fits = F.size(TOKENS) == F.size("TAGS")
    checked = F.when(fits, F.arrays_zip(TOKENS, "TAGS")).otherwise(
        F.raise_error(F.lit("the tagger returned another number of tags than tokens"))
    )
    rows = tagged.select(*key, F.posexplode(checked).alias("_i", "_t"))
    return rows.select(
        *key,
        (F.col("_i") + 1).alias(TOKN_ID),
        F.col(f"_t.{TOKENS}").alias(FORM),
        F.col("_t.TAGS").alias(STTS),
        universal_or_null(F.col("_t.TAGS")).alias(UNIV),
    )


# --- lexicon tagger -------------------------------------------------------------------------


def most_frequent(counts: DataFrame, key, tag=STTS, n="n") -> DataFrame:
    """The most frequent tag per key, ties to the smallest tag."""
    best = F.min_by(tag, F.struct(-F.col(n), F.col(tag)))
    return counts.groupBy(key).agg(best.alias(tag))


def form_tag_counts(tokens: DataFrame, by=(), tag=STTS) -> DataFrame:
    """(by, FORM, tag, n): all that form-based taggers and their scores need of a corpus."""
    return tokens.groupBy(*by, FORM, tag).agg(F.count(F.lit(1)).alias("n"))


def train_lexicon(counts: DataFrame, tag=STTS) -> DataFrame:
    """FORM -> most frequent tag, from form/tag counts."""
    return most_frequent(counts, FORM, tag)


def train_suffixes(counts: DataFrame, longest=3, tag=STTS) -> DataFrame:
    """SUFFIX -> most frequent tag, for suffixes of 1..longest characters."""
    lengths = F.sequence(F.lit(1), F.least(F.lit(longest), F.length(FORM)))
    suffixes = F.transform(lengths, lambda k: F.right(F.col(FORM), k))
    by_suffix = counts.select(F.explode(suffixes).alias("SUFFIX"), tag, "n")
    return most_frequent(by_suffix.groupBy("SUFFIX", tag).agg(F.sum("n").alias("n")), "SUFFIX", tag)


def tag_forms(forms: DataFrame, lexicon: DataFrame, default="NN", suffixes=None, longest=3, tag=STTS):
    """Tag distinct forms (rows with FORM, any other columns stay).

    Unknown forms back off to the longest known suffix, then to `default`.
    """
    known = forms.join(lexicon.select(FORM, F.col(tag).alias("_t")), FORM, "left")
    if suffixes is None:
        return known.withColumn(f"PRED_{tag}", F.coalesce("_t", F.lit(default))).drop("_t")
    # Only unknown forms look up suffixes: all their lengths meet the table in one join.
    wanted = forms.select(FORM).distinct().join(lexicon.select(FORM), FORM, "left_anti")
    lengths = F.sequence(F.lit(1), F.least(F.lit(longest), F.length(FORM)))
    pieces = wanted.where(F.length(FORM) > 0).select(
        FORM, F.explode(F.transform(lengths, lambda k: F.right(F.col(FORM), k))).alias("SUFFIX")
    )
    found = pieces.join(suffixes.select("SUFFIX", F.col(tag).alias("_s")), "SUFFIX")
    guessed = found.groupBy(FORM).agg(F.max_by("_s", F.length("SUFFIX")).alias("_s"))
    met = known.join(guessed, FORM, "left")
    return met.withColumn(f"PRED_{tag}", F.coalesce("_t", "_s", F.lit(default))).drop("_t", "_s")


def tag_tokens(tokens: DataFrame, tagged_forms: DataFrame, spread_by, hot=(), pred=f"PRED_{STTS}", part=None, parts=0):
    """Give every token the tag of its form.

    part: the column by which `tokens` lie in `parts` partitions. Tokens then stay where they are: a part asks for its
    distinct forms, and their tags come to it.
    """
    table = tagged_forms.select(FORM, pred)
    if part is None:
        return salted_join(tokens, table, FORM, list(hot), spread_by)
    found = tokens.select(part, FORM).distinct().join(table, FORM).repartition(parts, part)
    return tokens.join(found.hint("shuffle_hash"), [part, FORM], "left")


# --- context tagger -------------------------------------------------------------------------

CONTEXT_FEATURES = ["FORM_LC", "SUFFIX3", "SHAPE", "BEFORE", "AFTER"]


def context_features(sents: DataFrame, key=(CORP, SENT_ID)) -> DataFrame:
    """Form, suffix, shape and neighbours per token, built inside the sentence row."""
    toks = F.col(TOKENS)
    edge = F.lit("<edge>")
    entries = F.transform(
        toks,
        lambda x, i: F.struct(
            (i + 1).alias(TOKN_ID),
            x.alias(FORM),
            F.lower(x).alias("FORM_LC"),
            F.right(x, F.lit(3)).alias("SUFFIX3"),
            F.regexp_replace(
                F.regexp_replace(F.regexp_replace(x, r"\p{Lu}+", "X"), r"\p{Ll}+", "x"), r"[0-9]+", "d"
            ).alias("SHAPE"),
            F.coalesce(F.lower(F.get(toks, i - 1)), edge).alias("BEFORE"),
            F.coalesce(F.lower(F.get(toks, i + 1)), edge).alias("AFTER"),
        ),
    )
    return sents.select(*key, F.inline(entries))


#: Features whose values are forms: a part asks for a form once, whichever of them holds it.
_KINDS = {"FORM_LC": "form", "BEFORE": "form", "AFTER": "form"}
#: Rows whose scores are summed at once; they pull the values that they hold.
PART_ROWS = 1 << 18


def _scored(features, weights, base, run, schema, by=()):
    """`run`(rows, scores) on parts of the features: scores are a line per row, `base` plus what the row's values add.

    Rows move once, in parts of about PART_ROWS (whole `by` groups, if given); a part asks for its distinct values, and
    their weights come to it. So weights travel once per part and value, not once per row and feature.
    """
    spark = features.sparkSession
    ship_package(spark)
    rows = stage(features.withColumn("_at", F.monotonically_increasing_id()), "features")
    if by:
        parts = max(1, -(-rows.count() // PART_ROWS))
        rows = rows.withColumn("_part", F.pmod(F.xxhash64(*by), F.lit(parts)))
    else:
        rows = rows.withColumn("_part", F.floor(F.col("_at") / PART_ROWS))
    rows = rows.drop("_at")
    entries = F.array(*[F.struct(F.lit(_KINDS.get(c, c)).alias("kind"), F.col(c).alias("value")) for c in CONTEXT_FEATURES])
    asked = rows.select("_part", F.inline(entries)).distinct()
    kind = F.coalesce(lookup(_KINDS, "feature"), F.col("feature"))
    pulled = asked.join(weights.select(kind.alias("kind"), "feature", "value", "w"), ["kind", "value"]).select(F.col("_part").alias("_to"), "feature", "value", "w")
    base = np.array(base)

    def part(left, right):
        names = right.column("feature").combine_chunks()
        scores = np.tile(base, (left.num_rows, 1))
        for feature in CONTEXT_FEATURES:
            own = right.filter(pc.equal(names, feature))
            if not own.num_rows:
                continue
            table = own.column("w").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(base))
            place = pc.index_in(left.column(feature), own.column("value").combine_chunks())
            place = place.fill_null(-1).to_numpy()
            met = place >= 0
            scores[met] += table[place[met]]
        return run(left.drop_columns(["_part"]), scores)

    return rows.groupBy("_part").cogroup(pulled.groupBy("_to")).applyInArrow(part, schema)


@dataclass
class ContextTagger:
    """Naive Bayes over exact feature values.

    base: per class its log prior plus what unseen values cost. weights: one row per seen (feature, value) with
    what it adds per class; n is its count in training.
    """

    classes: list  # class names in code order
    base: list
    weights: DataFrame

    def tag(self, features: DataFrame) -> DataFrame:
        """Add PRED_UNIV: the class with the highest score, rounded to nine places; ties go to the first class."""
        def run(rows, scores):
            n, k = scores.shape
            ends = pa.array(np.arange(0, n * k + 1, k, dtype=np.int32))
            return rows.append_column("_score", pa.ListArray.from_arrays(ends, pa.array(scores.ravel())))

        schema = T.StructType([*features.schema.fields, T.StructField("_score", T.ArrayType(T.DoubleType()))])
        scored, score = _scored(features, self.weights, [float(x) for x in self.base], run, schema), F.col("_score")
        rounded = F.transform(score, lambda x: F.round(x, 9))
        names = F.array(*[F.lit(c) for c in self.classes])
        best = scored.select(*features.columns, F.explode(F.array(rounded)).alias("_s"))
        return best.select(
            *features.columns, F.element_at(names, F.array_position("_s", F.array_max("_s")).cast("int")).alias(f"PRED_{UNIV}")
        )


def train_context_tagger(features: DataFrame, tag=UNIV, smoothing=0.1) -> ContextTagger:
    """Count classes and (feature, value, class) cells; every value has its own cell."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in CONTEXT_FEATURES])
    rows = features.groupBy(*CONTEXT_FEATURES, tag).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("_code", encode_class(tag))
    totals = {r[tag]: r["n"] for r in rows.groupBy("_code", tag).agg(F.sum("n").alias("n")).orderBy("_code").collect()}
    classes = list(totals)
    cells = rows.select(F.explode(entries).alias("e"), tag, "n").groupBy("e.feature", "e.value").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col(tag) == c, F.col("n"))), F.lit(0)) for c in classes]).alias("counts"),
        F.sum("n").alias("n"),
    )
    gain = F.transform("counts", lambda n: F.log((n + smoothing) / smoothing))
    weights = stage(cells.select("feature", "value", "n", gain.alias("w")), "context")
    values = {r["feature"]: r["n"] for r in weights.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = sum(totals.values())
    base = [
        math.log(totals[c] / size) + sum(math.log(smoothing / (totals[c] + smoothing * values[f])) for f in CONTEXT_FEATURES)
        for c in classes
    ]
    return ContextTagger(classes, base, weights)


# --- tagger with tag history -----------------------------------------------------------------

#: Logarithms are kept as whole millionths, so that sums are exact in any order and ties are real.
HISTORY_UNIT = 1_000_000


def _whole(x):
    return F.round(x * F.lit(float(HISTORY_UNIT))).cast("long")


@dataclass
class HistoryTagger:
    """A context tagger that also sees the tag before: the best sequence of tags for each sentence (Viterbi).

    steps: for the sentence's edge and then each class, what a class after it gains over its own
    frequency, in millionths.
    """

    context: ContextTagger
    steps: list

    def tag(self, features: DataFrame, key=(CORP, SENT_ID)) -> DataFrame:
        """Add PRED_UNIV to every token; of equal sequences the one with the first classes from the end wins.

        A part holds whole sentences, whose tokens are put in order and decoded side by side.
        """
        key, classes, steps = list(key), self.context.classes, np.array(self.steps, np.int64)
        weights = self.context.weights.select("feature", "value", F.transform("w", _whole).alias("w"))
        base = [round(x * HISTORY_UNIT) for x in self.context.base]

        def run(rows, scores):
            order = pc.sort_indices(rows, sort_keys=[(k, "ascending") for k in [*key, TOKN_ID]])
            rows, scores = rows.take(order), scores[order.to_numpy()]
            n = rows.num_rows
            fresh = np.zeros(n, bool)
            fresh[:1] = True
            for k in key:
                column = rows.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
                fresh[1:] |= column[1:] != column[:-1]
            ends = pa.array(np.append(np.flatnonzero(fresh), n).astype(np.int32))
            inner = pa.ListArray.from_arrays(pa.array(np.arange(0, scores.size + 1, scores.shape[1], dtype=np.int32)), pa.array(scores.ravel()))
            codes = best_sequences(pa.ListArray.from_arrays(ends, inner), steps)
            return rows.append_column("_codes", codes.flatten())

        schema = T.StructType([*features.schema.fields, T.StructField("_codes", T.IntegerType())])
        decoded = _scored(features, weights, base, run, schema, key)
        names = F.array(*[F.lit(c) for c in classes])
        return decoded.select(*key, *[c for c in features.columns if c not in key], F.get(names, F.col("_codes")).alias(f"PRED_{UNIV}"))


def best_sequences(scores, steps):
    """Codes of the best sequence of each row of a list<list<long>> column of class scores.

    steps: (1 + classes) x classes; line 0 is for the first place of a row. All rows advance together,
    the longest first, so a place costs one array operation for all rows that reach it.
    """
    lengths = pc.list_value_length(scores).to_numpy(zero_copy_only=False).astype(np.int64)
    classes = steps.shape[1]
    own = scores.flatten().flatten().to_numpy().reshape(-1, classes)
    start = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, size = start[order], lengths[order]
    before = np.zeros(own.shape, np.int8)
    codes = np.zeros(len(own), np.int32)
    alive = np.searchsorted(-size, -np.arange(1, int(size.max(initial=0)) + 1), side="right")
    best = own[begin[: alive[0]]] + steps[0] if len(alive) else None
    for place in range(len(alive)):
        n = alive[place]
        if place:
            met = best[:n, :, None] + steps[1:]
            before[begin[:n] + place] = met.argmax(axis=1)
            best[:n] = met.max(axis=1) + own[begin[:n] + place]
    # Rows that end keep their last scores: they are behind those that go on.
    if len(alive):
        last = best.argmax(axis=1)
        for place in range(len(alive) - 1, -1, -1):
            n = alive[place]
            codes[begin[:n] + place] = last[:n]
            last[:n] = before[begin[:n] + place, last[:n]]
    return pa.ListArray.from_arrays(pa.array(np.append(start, len(own)), pa.int32()), pa.array(codes))


def train_history_tagger(features: DataFrame, key=(CORP, SENT_ID), tag=UNIV, smoothing=0.1) -> HistoryTagger:
    """Count features as the context tagger does, and pairs of neighbouring tags."""
    context = train_context_tagger(features, tag, smoothing)
    before = F.lag(tag).over(Window.partitionBy(*key).orderBy(TOKN_ID))
    pairs = features.select(before.alias("a"), F.col(tag).alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    counts = {(r["a"], r["b"]): r["n"] for r in pairs.collect()}  # at most one per pair of classes
    total = sum(counts.values())
    steps = []
    for a in (None, *context.classes):
        row = sum(counts.get((a, b), 0) for b in context.classes)
        line = []
        for b in context.classes:
            share = sum(counts.get((x, b), 0) for x in (None, *context.classes)) / total
            line.append(round(HISTORY_UNIT * (math.log((counts.get((a, b), 0) + smoothing) / (row + smoothing * len(context.classes))) - math.log(share))))
        steps.append(line)
    return HistoryTagger(context, steps)


# --- saving -----------------------------------------------------------------------------------


def save_lexicon(path, lexicon: DataFrame, suffixes: DataFrame | None = None):
    """Write a lexicon, and its suffix table if there is one, below `path`."""
    lexicon.write.mode("overwrite").parquet(f"{path}/lexicon")
    if suffixes is not None:
        suffixes.write.mode("overwrite").parquet(f"{path}/suffixes")


def load_lexicon(spark, path, suffixes=False):
    """(lexicon, suffix table or None) as saved."""
    return spark.read.parquet(f"{path}/lexicon"), spark.read.parquet(f"{path}/suffixes") if suffixes else None


def save_context_tagger(path, tagger: ContextTagger):
    spark = tagger.weights.sparkSession
    tagger.weights.write.mode("overwrite").parquet(f"{path}/weights")
    write_record(spark, {"classes": tagger.classes, "base": tagger.base}, f"{path}/base.record")


def save_history_tagger(path, tagger: HistoryTagger):
    save_context_tagger(path, tagger.context)
    write_record(tagger.context.weights.sparkSession, {"steps": tagger.steps}, f"{path}/steps.record")


def load_history_tagger(spark, path) -> HistoryTagger:
    return HistoryTagger(load_context_tagger(spark, path), read_record(spark, f"{path}/steps.record")["steps"])


def load_context_tagger(spark, path) -> ContextTagger:
    record = read_record(spark, f"{path}/base.record")
    return ContextTagger(record["classes"], record["base"], spark.read.parquet(f"{path}/weights"))


# --- hold-out split -------------------------------------------------------------------------

_BUCKET = 4  # hex digits of the first selection level: 65,536 buckets


def holdout_split(sents: DataFrame, fraction=0.1, seed=0, key=(CORP, SENT_ID)) -> DataFrame:
    """Add IS_TEST to exactly floor(n * fraction) sentences, chosen by a seeded hash order.

    The cut-off is found from a bucket histogram of the hash and one bucket's first rows, so no
    sentence is sorted or moved; the split itself is a comparison with two literals.
    """
    text = [F.lit(str(seed)), *[F.col(k).cast("string") for k in key]]
    hashed = F.md5(F.concat_ws("|", *text))
    order = F.concat_ws("|", hashed, *[F.col(k).cast("string") for k in key])
    marked = sents.select(order.alias("_h"))
    counts = marked.groupBy(F.left("_h", F.lit(_BUCKET)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    histogram = sorted((r["b"], r["n"]) for r in counts.collect())
    wanted = int(sum(n for _, n in histogram) * fraction)
    if wanted == 0:
        return sents.withColumn("IS_TEST", F.lit(False))
    for bucket, n in histogram:
        if wanted <= n:
            break
        wanted -= n
    inside = marked.where(F.left("_h", F.lit(_BUCKET)) == bucket)
    cut = inside.orderBy("_h").limit(wanted).agg(F.max("_h")).first()[0]
    return sents.withColumn("IS_TEST", order <= cut)
