"""Language identification by Bayesian fusion of evidence.

For each candidate language the log likelihood of the text (letter trigrams) is added to the log
likelihoods of the declared language and of the address suffix, and to the log prior of the host. A
host's prior is counted over all its texts and smoothed towards its suffix, and that towards the whole.
One more candidate, `und`, stands for any other language.
"""

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import own_names, steps
from tagloom.llm.words import text_bytes
from tagloom.staging import ship_package, stage

SLOTS = 1 << 16
#: Bytes of text of a step; its trigrams take about 33 times as much.
STEP_BYTES = 1 << 18
#: Candidates that need no declared texts.
LANGUAGES = ("en", "de", "fr", "es")
UNKNOWN = "und"
#: Languages that country suffixes speak for.
SUFFIX_LANGUAGES = {
    "de": "de", "at": "de", "ch": "de", "fr": "fr", "be": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en",
}
#: ASCII letters in lower case and bytes of other letters stay, all else is a space.
_FOLDED = np.full(256, 32, np.uint8)
_FOLDED[128:] = np.arange(128, 256)
_FOLDED[97:123] = np.arange(97, 123)
_FOLDED[65:91] = np.arange(97, 123)


def trigrams(column):
    """Slots of the trigrams around every letter byte of a column of texts, and each row's first and end."""
    data, offsets = text_bytes(column)
    folded = _FOLDED[data].astype(np.uint32)
    before, after = np.full(len(folded), 32, np.uint32), np.full(len(folded), 32, np.uint32)
    before[1:], after[:-1] = folded[:-1], folded[1:]
    starts = offsets[:-1][offsets[:-1] < len(folded)]
    before[starts] = 32
    after[starts[starts > 0] - 1] = 32
    letters = folded != 32
    code = ((before << np.uint32(16) | folded << np.uint32(8) | after) * np.uint32(2654435761)) >> np.uint32(16)
    counts = np.zeros(len(folded) + 1, np.int64)
    np.cumsum(letters, out=counts[1:])
    return code[letters].astype(np.int64), counts[offsets]


@dataclass
class Model:
    """Log probabilities of trigram slots, one row per language."""

    languages: tuple
    table: np.ndarray


def said_language(column="declared"):
    """The language of a declared tag: 'de' of 'de-AT' or 'DE'. Null where no such tag is declared."""
    found = F.regexp_extract(F.lower(F.trim(column)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(found != "", found)


def candidates(rows: DataFrame, per_language=500, most=64, fallback=LANGUAGES) -> tuple:
    """The languages that at least `per_language` ids declare, at most the `most` frequent, and `fallback`.

    rows: id, declared. One grouped count over all rows. Fallback languages come first.
    """
    counts = declared_counts(rows)
    often = counts.where(F.col("n") >= per_language).orderBy(F.desc("n"), "said").limit(most)
    return (*fallback, *sorted({r["said"] for r in often.collect()} - set(fallback)))


def declared_counts(rows: DataFrame) -> DataFrame:
    """said, n: about how many ids declare each language."""
    return rows.select("id", said_language().alias("said")).where(F.col("said").isNotNull()).groupBy("said").agg(
        F.approx_count_distinct("id").alias("n")
    )


def train(rows: DataFrame, languages=LANGUAGES, per_language=500) -> Model:
    """Learn trigrams from at most `per_language` declared texts of each language, chosen by a hash of the id.

    rows: id, text, declared. Region tags count for their language. An id that repeats gives one text, the smallest.
    A language without texts has even probabilities.
    """
    ship_package(rows.sparkSession)
    # Of n ids about twice as many as wanted have a hash below the bound; only those are ranked.
    bound = F.lit(1.0)
    for r in declared_counts(rows).where(F.col("said").isin(*languages)).collect():
        bound = F.when(F.col("said") == r["said"], min(1.0, 2.0 * per_language / max(1, r["n"]))).otherwise(bound)
    labelled = rows.withColumn("said", said_language()).where(F.col("text").isNotNull() & F.col("id").isNotNull()).select(
        "id", F.col("said").alias("declared"), F.xxhash64("id", F.lit("sample")).alias("h"), "text", bound.alias("bound"),
    )
    few = labelled.where(F.col("declared").isin(*languages) & (F.col("h") / F.lit(2.0**64) + 0.5 <= F.col("bound")))
    nth = F.row_number().over(Window.partitionBy("declared").orderBy("h", "id"))
    ranked = few.groupBy("id", "h", "declared").agg(F.min("text").alias("text")).withColumn("nth", nth)
    sample = ranked.where(F.col("nth") <= per_language).select("declared", "text")

    def count(batches):
        found = {}
        for part in steps(batches, most=STEP_BYTES):
            slots, first = trigrams(part.column("text"))
            for i, name in enumerate(part.column("declared").to_pylist()):
                own = np.bincount(slots[first[i]: first[i + 1]], minlength=SLOTS)
                found[name] = found.get(name, 0) + own
        for name, own in found.items():
            slot = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(slot), pa.string()), pa.array(slot, pa.int32()), pa.array(own[slot], pa.int64())],
                ["declared", "slot", "n"],
            )

    counts = sample.mapInArrow(count, "declared string, slot int, n long").groupBy("declared", "slot").agg(F.sum("n").alias("n"))
    total = np.full((len(languages), SLOTS), 0.1)
    for name, slot, n in counts.collect():  # languages x SLOTS rows at most
        total[languages.index(name), slot] += n
    return Model(tuple(languages), np.log(total / total.sum(axis=1, keepdims=True)).astype(np.float32))


def likelihoods(batches, table):
    """Batches of text_evidence: the columns of `rows` with letters and ll of each text."""
    for part in steps(batches, most=STEP_BYTES):
        slots, first = trigrams(part.column("text"))
        n = np.diff(first)
        ll = np.zeros((len(n), len(table)))
        full = np.flatnonzero(n)
        if len(full):
            for k, row in enumerate(table):
                ll[full, k] = np.add.reduceat(row[slots], first[full], dtype=np.float64)
        values = pa.ListArray.from_arrays(np.arange(0, ll.size + 1, len(table), dtype=np.int32), ll.ravel())
        yield pa.RecordBatch.from_arrays(
            [*[part.column(c) for c in ("id", "text_key", "declared", "host", "suffix")], pa.array(n), values],
            ["id", "text_key", "declared", "host", "suffix", "letters", "ll"],
        )


def text_evidence(rows: DataFrame, model: Model) -> DataFrame:
    """id, text_key, declared, host, suffix, letters and ll, the text's log likelihood in each language."""
    ship_package(rows.sparkSession)
    table = model.table

    def run(batches):
        yield from likelihoods(batches, table)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", F.xxhash64("text").alias("text_key"), "declared", "host", "suffix", "text").mapInArrow(
        run, f"id {kind}, text_key long, declared string, host string, suffix string, letters long, ll array<double>"
    )


def host_priors(evidence: DataFrame, languages, strength=20.0, least_letters=20):
    """Smoothed shares of each language: per host, per suffix and of the whole (a plain list)."""
    best = F.array_position("ll", F.array_max("ll")).cast("int")
    votes = evidence.where(F.col("letters") >= least_letters).select("host", "suffix", best.alias("best"))
    names = [f"n{i}" for i in range(len(languages))]
    sums = [F.count(F.when(F.col("best") == i + 1, 1)).alias(name) for i, name in enumerate(names)]
    hosts = votes.groupBy("host", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*[F.sum(n).alias(n) for n in names])
    row = suffixes.agg(*[F.sum(n).alias(n) for n in names]).first()
    total = [(row[n] or 0) + 1.0 for n in names]
    whole = [x / sum(total) for x in total]

    def smoothed(above):
        n = reduce(lambda a, b: a + b, [F.col(c) for c in names])
        return F.array(*[(F.col(c) + strength * a) / (n + strength) for c, a in zip(names, above)])

    suffix_prior = suffixes.where(F.col("suffix").isNotNull()).select(
        F.col("suffix").alias("_suffix"), smoothed([F.lit(x) for x in whole]).alias("suffix_prior")
    )
    above = F.coalesce("suffix_prior", F.array(*[F.lit(x) for x in whole]))
    host_prior = hosts.where(F.col("host").isNotNull()).join(
        suffix_prior, F.col("suffix") == F.col("_suffix"), "left"
    ).withColumn("_above", above).select(
        F.col("host").alias("_host"), F.col("suffix").alias("_host_suffix"),
        smoothed([F.get("_above", F.lit(i)) for i in range(len(names))]).alias("prior"),
    )
    return host_prior, suffix_prior, whole


def fuse(
    evidence: DataFrame, languages, declared_trust=0.9, suffix_trust=0.7, text_weight=200.0,
    unknown_bits=14.5, unknown_prior=0.01, least_confidence=0.5,
) -> DataFrame:
    """id, text_key, lang, confidence and kept of every row of evidence.

    The text counts like at most `text_weight` independent trigrams. `und` gives every trigram
    `unknown_bits` bits. A row is rejected (kept false) if no letter is in its text, if `und` wins, or if
    the winner has less than `least_confidence`. Missing evidence (null declared language, suffix or
    host, or a value that stands for no candidate) weighs nothing.
    """
    hosts, suffixes, whole = host_priors(evidence, languages)
    met = evidence.join(
        hosts, (F.col("host") == F.col("_host")) & F.col("suffix").eqNullSafe(F.col("_host_suffix")), "left"
    ).join(suffixes, F.col("suffix") == F.col("_suffix"), "left")
    prior = F.coalesce("prior", "suffix_prior", F.array(*[F.lit(x) for x in whole]))
    scale = F.least(F.lit(1.0), F.lit(text_weight) / F.greatest(F.col("letters"), F.lit(1)))

    def trusted(value, name, trust):
        other = (1 - trust) / max(1, len(languages) - 1)
        known = value.isin(*languages)
        return F.when(known & (value == name), float(np.log(trust))).when(known, float(np.log(other))).otherwise(0.0)

    spoken = F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGES.items() for x in pair])
    said = F.try_element_at(spoken, F.lower("suffix"))
    declared = said_language()
    scores = [
        F.get("ll", F.lit(i)) * scale + F.log(F.get(prior, F.lit(i)))
        + trusted(declared, name, declared_trust) + trusted(said, name, suffix_trust)
        for i, name in enumerate(languages)
    ]
    scores.append(F.col("letters") * scale * float(-unknown_bits * np.log(2)) + float(np.log(unknown_prior)))
    scored = met.select("id", "text_key", "letters", F.array(*scores).alias("s"))
    best = F.array_max("s")
    names = F.array(*[F.lit(x) for x in (*languages, UNKNOWN)])
    shares = F.aggregate("s", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    named = scored.select(
        "id", "text_key", "letters", F.element_at(names, F.array_position("s", best).cast("int")).alias("lang"), (1 / shares).alias("confidence")
    )
    return named.select(
        "id", "text_key", F.when(F.col("letters") > 0, F.col("lang")).otherwise(UNKNOWN).alias("lang"), "confidence",
        ((F.col("letters") > 0) & (F.col("lang") != UNKNOWN) & (F.col("confidence") >= least_confidence)).alias("kept"),
    )


def identify(rows: DataFrame, languages=None, per_language=500) -> DataFrame:
    """id, text_key, lang, confidence and kept for rows of id, text, declared, host, suffix (strings or null).

    languages: the candidates; if none are given, those of `candidates`. Every row comes back once, repeated rows
    and null ids too; a null or empty text is rejected, a text of any length is read whole.
    """
    languages = languages or candidates(rows, per_language)
    model = train(rows, languages, per_language)
    return fuse(stage(text_evidence(rows, model), "evidence"), languages)


def document_rows(docs: DataFrame) -> DataFrame:
    """Evidence columns of documents: the lang column is what is declared, the source is the host."""
    return docs.select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"),
        F.lit(None).cast("string").alias("suffix"),
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """Evidence columns of raw web pages: visible text, markup language, host and address suffix."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    named = pages.select(
        F.col("page_id").alias("id"), F.regexp_replace(bare, r"&[a-zA-Z]+;|&#[0-9xXa-fA-F]+;", " ").alias("text"),
        F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z-]+)", 1).alias("declared"), host.alias("host"),
    )
    empty = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    return named.select("id", "text", empty("declared"), empty("host")).withColumn(
        "suffix", F.when(F.col("host").contains("."), F.regexp_extract("host", r"\.([a-z]+)$", 1))
    )


@own_names
def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of documents whose language is identified; columns are kept.

    Repeated rows stay or go together, rows without an id are judged by their text alone, and columns may have any names.
    """
    rejected = identify(document_rows(docs)).where(~F.col("kept")).select(
        F.col("id").alias("_id"), F.coalesce("text_key", F.lit(0)).alias("_key")
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.coalesce(F.xxhash64("text"), F.lit(0)) == F.col("_key"))
    return docs.join(rejected, same, "left_anti")
