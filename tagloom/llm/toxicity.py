"""A toxicity classifier that is indifferent to which group a text names.

Logistic regression on the presence of words, with two penalties: an L1 norm, so that long texts do not
add up noise, and a counterfactual one: identity terms of labelled texts are swapped for others of
their kind, and the squared change of the score's logit is penalised. A word that names a group then
cannot carry toxicity by itself, so neutral mentions are not taken for attacks.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import steps
from tagloom.staging import ship_package, stage

#: Identity terms by kind; a term is swapped for the next of its row.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("blacks", "whites", "asians", "latinos"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("immigrant", "native", "refugee", "foreigner"), ("immigrants", "natives", "refugees", "foreigners"),
    ("african", "european", "american", "arab", "chinese", "mexican", "indian"), ("disabled", "blind", "deaf", "autistic"),
    ("old", "young"), ("elderly", "teenage"),
)
#: Labelled rows that the classifier is fitted on at most.
SAMPLE_ROWS = 20_000
#: Words it may weigh at most, besides identity terms, and documents of the sample a word must be in.
FEATURES = 4096
LEAST_DOCUMENTS = 4

#: ASCII letters in lower case and other letters' bytes; all else is a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


#: Bytes of the word beginnings that are features too, for words that are longer.
STEMS = (5, 7)


def word_set(text):
    """Distinct lower-case words of a text, as UTF-8."""
    return set((text or "").lower().encode().translate(_FOLD).split())


def features(words):
    """Words and, marked with a star, the beginnings of longer ones."""
    return words.union(*({w[:n] + b"*" for w in words if len(w) > n} for n in STEMS))


def _swaps(terms):
    return {a.encode(): kind[(i + 1) % len(kind)].encode() for kind in terms for i, a in enumerate(kind)}


@dataclass
class Model:
    """Words, beginnings of words, and their weights."""

    weights: dict
    bias: float

    def score(self, text):
        own = self.weights
        z = self.bias + sum(own[w] for w in sorted(features(word_set(text)) & own.keys()))
        return 1.0 / (1.0 + float(np.exp(-z))) if z > -700 else 0.0


def fit(sides, labels, pairs, n_features, l1=3e-4, balance=3.0, rounds=400, tolerance=1e-7):
    """Weights and bias by accelerated proximal gradient steps.

    sides: (row, feature) positions of the texts; pairs: (pair, feature, sign) of each word that a swap takes
    out (+1) or puts in (-1). balance weighs the mean squared logit change over pairs.
    """
    rows, cols = sides
    n = len(labels)
    pair, pair_cols, sign = pairs
    n_pairs = max(1, int(pair.max()) + 1 if len(pair) else 1)
    dot = lambda w: np.bincount(rows, weights=w[cols], minlength=n)
    back = lambda r: np.bincount(cols, weights=r[rows], minlength=n_features)
    swap = lambda w: np.bincount(pair, weights=sign * w[pair_cols], minlength=n_pairs)
    swap_back = lambda r: np.bincount(pair_cols, weights=sign * r[pair], minlength=n_features)
    # The steepest curvature, by power iteration.
    v, top = np.ones(n_features) / max(1, n_features) ** 0.5, 1.0
    for _ in range(20):
        v = back(dot(v)) / (4 * n) + 2 * balance * swap_back(swap(v)) / n_pairs
        top = np.linalg.norm(v)
        if not top:
            break
        v /= top
    step = 0.9 / (max(top, 1e-9) + 0.3)
    share = (labels.sum() + 0.1) / (n + 1)
    w, b = np.zeros(n_features), float(np.log(share / (1 - share)))
    w_ahead, b_ahead, t = w, b, 1.0
    for _ in range(rounds):
        wrong = 1 / (1 + np.exp(-np.clip(dot(w_ahead) + b_ahead, -30, 30))) - labels
        slope = back(wrong) / n + 2 * balance * swap_back(swap(w_ahead)) / n_pairs
        moved = w_ahead - step * slope
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
        new_b = b_ahead - step * wrong.mean()
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        change = np.abs(new - w).max(initial=abs(new_b - b))
        w_ahead, b_ahead = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
        if change < tolerance:
            break
    return w, b


def train(
    docs: DataFrame, labels: DataFrame, sample_rows=SAMPLE_ROWS, terms=IDENTITY_TERMS, l1=3e-4, balance=3.0,
    n_words=FEATURES,
) -> Model:
    """Fit on at most `sample_rows` labelled texts, chosen by a hash of the id.

    labels: doc_id and toxic (0 or 1; other values and null ids are left out, of repeated ids the largest counts).
    An id that repeats in docs gives one text, the smallest (a null text is empty), so that `sample_rows` bounds what is fitted.
    Words are counted over the whole texts of the sample; `n_words` of them, those that part toxic texts from
    others best, and all identity terms get weights. Without labels the score is the same for all texts.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # Of n ids about a fifth more than wanted have a hash below the bound; only those are ranked.
    known = known.withColumn("_h", F.xxhash64("doc_id", F.lit("sample")))
    bound = min(1.0, (1.2 * sample_rows + 1000) / max(1, known.count()))
    few = known.where(F.col("_h") / F.lit(2.0**64) + 0.5 <= bound)
    chosen = few.orderBy("_h", "doc_id").limit(sample_rows).select("doc_id", "toxic")
    # At most sample_rows ids and labels.
    met = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = met.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    swaps = _swaps(terms)

    def words(batches):
        for part in steps(batches):
            own = [word_set(t) for t in part.column("text").to_pylist()]
            swapped = [features({swaps.get(w, w) for w in ws}) if not ws.isdisjoint(swaps) else None for ws in own]
            own = [features(ws) for ws in own]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("toxic"), pa.array([sorted(ws) for ws in own], pa.list_(pa.binary())),
                    pa.array([None if ws is None else sorted(ws) for ws in swapped], pa.list_(pa.binary())),
                ],
                ["doc_id", "toxic", "words", "swapped"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    sample = stage(texts.mapInArrow(words, f"doc_id {kind}, toxic int, words array<binary>, swapped array<binary>"), "labelled")
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = sample.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    parted = F.pow(F.col("t") * F.lit(float(n)) - F.col("n") * F.lit(float(toxic)), 2) / (F.col("n") * (F.lit(n + 1.0) - F.col("n")))
    best = counts.where(F.col("n") >= LEAST_DOCUMENTS).orderBy(parted.desc(), "word").limit(n_words)
    names = sorted({bytes(r["word"]) for r in best.select("word").collect()} | swaps.keys())
    place = {w: i for i, w in enumerate(names)}

    def positions(batches):
        for batch in batches:
            out = []
            for column in ("words", "swapped"):
                values = batch.column(column).to_pylist()
                out.append(pa.array([None if ws is None else [place[w] for w in ws if w in place] for ws in values], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *out], ["doc_id", "toxic", "own", "other"])

    # sample_rows rows of at most n_words positions and the identity terms.
    found = sample.mapInArrow(positions, f"doc_id {kind}, toxic int, own array<int>, other array<int>").toPandas()
    found = found.sort_values("doc_id", kind="stable", ignore_index=True)
    labels_ = found["toxic"].to_numpy(np.float64)
    empty = np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(found)), found["own"].map(len)) if len(found) else empty
    cols = np.concatenate([empty, *found["own"]]).astype(np.int64)
    pairs = []
    for own, other in found.loc[found["other"].notna(), ["own", "other"]].itertuples(index=False):
        a, b = set(own), set(other)
        pairs.append([(c, 1.0) for c in sorted(a - b)] + [(c, -1.0) for c in sorted(b - a)])
    pair = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs]).astype(np.int64)
    flat = [x for p in pairs for x in p]
    changes = (pair, np.array([c for c, _ in flat], np.int64), np.array([s for _, s in flat], np.float64))
    if not len(found):
        return Model({}, float(np.log(0.1 / 0.9)))
    w, b = fit((rows, cols), labels_, changes, len(names), l1, balance)
    return Model({name: float(x) for name, x in zip(names, w) if x}, float(b))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= threshold) of every row; null texts count as empty."""
    ship_package(docs.sparkSession)

    def run(batches):
        for part in steps(batches):
            scores = [model.score(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                ["doc_id", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def held_out(id_column="doc_id"):
    """Whether a row's label stays unseen: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_held_out(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Scores of all rows by a model that saw no held-out label: doc_id, held_out, score, predicted."""
    model = train(docs, labels.where(~held_out()), **settings)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
