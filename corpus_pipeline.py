"""The corpus pipeline: language, lines, near-duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and gives a table that is written and read again as the next
one's docs. All but the last keep the columns of documents.
"""

import public_tokenizers
from pyspark.sql import functions as F

from tagloom.llm import language_id, line_dedup, mixing, packing, simhash
from tagloom.staging import stage


def identified(spark, docs, sf_dir):
    """Documents whose language is identified."""
    return language_id.keep_identified(docs)


def distinct_lines(spark, docs, sf_dir):
    """Documents without repeated three-line windows; one that lost every word goes."""
    cleaned = line_dedup.remove_repeated_lines(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return cleaned.where(~emptied).select(*[n_chars if c == "n_chars" else c for c in docs.columns])


def distinct_texts(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mixed(spark, docs, sf_dir):
    """Documents as often as the mixture of sources takes them."""
    return mixing.mix(docs)


def packed(spark, docs, sf_dir):
    """Token sequences of 1024: one row per piece."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", identified),
    ("line_dedup", distinct_lines),
    ("simhash", distinct_texts),
    ("mixing", mixed),
    ("packing", packed),
]

#: Language models, fingerprints and token ids have no SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
