"""The registered queries of the operators and their SQL."""

import public_tokenizers
from pyspark.sql import functions as F

from tagloom.llm import fill_in_middle, language_id, line_dedup, minmax_dedup, mixing, packing, periodic_runs, quality, simhash, substring_dedup, token_count, toxicity, vector_search
from tagloom.plans.testbed import table

#: Pruning factor of the registered search; the tests measure its recall.
RELAX = 1.1


def op1_substring_dedup(spark, sf_dir):
    """Words of repeated 13-word passages removed from every document."""
    cleaned = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_token_count(spark, sf_dir):
    """Tokens of every document for a public 32k vocabulary."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_toxicity(spark, sf_dir):
    """Toxicity score of every document; the labels of a quarter stay unseen."""
    return toxicity.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark, sf_dir):
    """Every document packed into sequences of 1024 tokens."""
    return packing.pack(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def op6_mixing(spark, sf_dir):
    """How often the mixture takes every document."""
    mixed = mixing.with_copies(table(spark, sf_dir, "documents"), mixing.source_domain())
    return mixed.select("doc_id", "domain", "n_tokens", "copies")


def op7_line_dedup(spark, sf_dir):
    """Lines of every document without repeated three-line windows."""
    cleaned = line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_quality_rules(spark, sf_dir):
    """Base counts and the divergence verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op9_language_id(spark, sf_dir):
    """Language of every document and whether it is certain enough to stay."""
    found = language_id.identify(language_id.document_rows(table(spark, sf_dir, "documents")))
    return found.select(F.col("id").alias("doc_id"), "lang", "confidence", "kept")


def page_language(spark, sf_dir):
    """Language of every web page, with its markup language, address suffix and host as evidence."""
    found = language_id.identify(language_id.page_rows(table(spark, sf_dir, "pages")))
    return found.select(F.col("id").alias("page_id"), "lang", "confidence", "kept")


def op10_nearest_neighbours(spark, sf_dir):
    """The five nearest vectors of every fiftieth."""
    return vector_search.nearest(table(spark, sf_dir, "embeddings"), relax=RELAX)


def op11_minmax_dedup(spark, sf_dir):
    """Component of every document under a shingle similarity of 0.85."""
    found = minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op12_fill_in_middle(spark, sf_dir):
    """Lengths and digests of every document's rewritten text and of the text rebuilt from it."""
    written = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    rebuilt = fill_in_middle.restored(F.col("output"), F.col("form"))
    return written.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(rebuilt, 256).alias("restored_sha256"),
    )


def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of every document; every tenth is made to repeat itself first."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", periodic_runs.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic_runs.digests(periodic_runs.find_runs(docs))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_simhash, op3_token_count, op4_toxicity, op5_best_fit_packing, op6_mixing,
    op7_line_dedup, op8_quality_rules, op9_language_id, page_language, op10_nearest_neighbours,
    op11_minmax_dedup, op12_fill_in_middle, op13_periodic_runs,
)}
ORACLE = {
    "op6_mixing": mixing.sql(), "op7_line_dedup": line_dedup.SQL, "op8_quality_rules": quality.sql(),
    "op12_fill_in_middle": fill_in_middle.SQL,
}
