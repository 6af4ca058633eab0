"""Token tables derived from the given tables by a fixed tagging rule.

Corpus A (training role) comes from `conversations`, corpus B (test role) from `documents`.
A line is a sentence; letters, digit runs and single other characters are tokens.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tags import fix_tag_by_corpus, lemma_or_form, universal
from tagloom.operators.corpus import union_corpora
from tagloom.operators.ordering import sentence_ids
from tagloom.schemas import CORP, FORM, LEMM, REDU, STTS, TOKENS, TOKN_ID, UNIV
from tagloom.staging import spread

TOKEN_PATTERN = r"[\p{L}\p{M}]+|[0-9]+|[^\s\p{L}\p{M}0-9]"
SENTENCE = ["D", "E", "LINE"]
KEY = [CORP, *SENTENCE, TOKN_ID]
PART = "PART"
_SOURCES = {
    "A": ("conversations", "conv_id", "turn"),
    "B": ("documents", "doc_id", None),
}


def table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_ranges(lines: DataFrame) -> DataFrame:
    """Lines in key order: every partition is a range of them. Lines are moved, not tokens, and tokens made of them stay in order."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartitionByRange(parts, *KEY[:-1]).sortWithinPartitions(*KEY[:-1])


def together(lines: DataFrame) -> DataFrame:
    """Lines dealt by their key, so that tokens of a sentence meet without being moved."""
    return lines.repartition(*KEY[:-1])


def in_parts(n):
    """A way to deal lines to `n` parts by their key: PART says which, and tokens of two tables dealt alike meet without being moved."""
    def dealt(lines: DataFrame) -> DataFrame:
        return lines.withColumn(PART, F.pmod(F.xxhash64(*KEY[:-1]), F.lit(n)).cast("int")).repartition(n, PART)

    return dealt


def sentences(spark, sf_dir, *corpora, dealt=None) -> DataFrame:
    """CORP, D, E, LINE, TOKENS; lines without tokens vanish. `dealt` places the lines before they are cut into tokens."""
    def one(corp):
        name, doc, sub = _SOURCES[corp]
        part = F.col(sub) if sub else F.lit(0)
        texts = table(spark, sf_dir, name).select(
            F.lit(corp).alias(CORP), F.col(doc).alias("D"), part.cast("long").alias("E"), "text"
        )
        lines = spread(texts, "D", "E").select(
            CORP, "D", "E", F.posexplode(F.split("text", "\n")).alias("LINE", "_text")
        )
        # Any character that is no white space belongs to a token, so the cheap test on the text
        # decides; a test on the token array would tokenise twice.
        return lines.where(F.col("_text").rlike(r"\S")).select(CORP, "D", "E", (F.col("LINE") + 1).alias("LINE"), "_text")

    lines = union_corpora(*[one(c) for c in corpora or _SOURCES])
    found = F.regexp_extract_all("_text", F.lit(TOKEN_PATTERN), F.lit(0))
    lines = dealt(lines) if dealt else lines
    return lines.select(*[c for c in lines.columns if c != "_text"], found.alias(TOKENS))


# The surrogate tags; the first match wins.
_RAW_TAG = r"""
CASE WHEN FORM IN ('.', '!', '?', ':', ';') THEN '$.'
     WHEN FORM = ',' THEN '$,'
     WHEN FORM RLIKE r'^[^\p{L}\p{M}0-9]$' THEN '$('
     WHEN FORM RLIKE '^[0-9]+$' THEN 'CARD'
     WHEN lower(FORM) IN ('the', 'der', 'die', 'das', 'le', 'la', 'les', 'el', 'los', 'un') THEN 'ART'
     WHEN lower(FORM) IN ('and', 'und', 'et', 'y', 'or') THEN 'KON'
     WHEN lower(FORM) IN ('of', 'in', 'de', 'von', 'to', 'for', 'con') THEN 'APPR'
     WHEN (TOKN_ID + length(FORM)) % 11 = 0 THEN 'NNE'
     WHEN FORM RLIKE r'^\p{Lu}' THEN 'NN'
     WHEN length(FORM) % 7 = 0 THEN 'VAIZU'
     WHEN length(FORM) % 5 = 0 THEN 'PPOSSAT'
     WHEN length(FORM) % 3 = 0 THEN 'PIDAT'
     WHEN length(FORM) % 4 = 0 THEN 'ADJA'
     ELSE 'VVFIN' END"""


def placed(spark, sf_dir, *corpora, dealt=None) -> DataFrame:
    """Sentence columns, TOKN_ID and FORM; and what `dealt` adds."""
    sents = sentences(spark, sf_dir, *corpora, dealt=dealt)
    exploded = sents.select(*[c for c in sents.columns if c != TOKENS], F.posexplode(TOKENS).alias("_i", FORM))
    return exploded.withColumn(TOKN_ID, F.col("_i") + 1).drop("_i")


def ruled(rows: DataFrame) -> DataFrame:
    """Add RAW_LEMM and RAW_STTS to rows with TOKN_ID and FORM, which alone decide them."""
    lemma = F.when(F.length(FORM) % 4 == 0, "--").otherwise(F.lower(FORM))
    return rows.select(
        "*",
        lemma.alias("RAW_LEMM"),
        # A generator's output is computed once; a plain column would be repeated in every
        # filter that is pushed below.
        F.explode(F.array(F.expr(_RAW_TAG))).alias("RAW_STTS"),
    )


def annotated(rows: DataFrame) -> DataFrame:
    """Add RAW_ID, RAW_LEMM and RAW_STTS to placed tokens."""
    return ruled(rows.select("*", F.concat(F.col("D").cast("string"), F.lit("_"), F.col(TOKN_ID).cast("string")).alias("RAW_ID")))


def tokens(spark, sf_dir, *corpora, dealt=None) -> DataFrame:
    """Raw tokens: sentence columns, TOKN_ID, RAW_ID, FORM, RAW_LEMM, RAW_STTS."""
    return annotated(placed(spark, sf_dir, *corpora, dealt=dealt))


def fixed_tag():
    """Corpus A plays the training corpus, B the test corpus with its own extra tag fix."""
    role = F.when(F.col(CORP) == "B", "HDT").otherwise("TIGER")
    return fix_tag_by_corpus("RAW_STTS", role)


def normalised(raw: DataFrame) -> DataFrame:
    """Replace the raw columns by LEMM, STTS, UNIV and REDU."""
    kept = [c for c in raw.columns if not c.startswith("RAW_")]
    return raw.withColumn(STTS, fixed_tag()).select(
        *kept,
        lemma_or_form("RAW_LEMM").alias(LEMM),
        STTS,
        universal(STTS).alias(UNIV),
        F.substring(STTS, 1, 2).alias(REDU),
    )


def gold(spark, sf_dir, *corpora, dealt=None) -> DataFrame:
    """Normalised tokens: STTS, UNIV, LEMM and REDU next to the sentence columns."""
    return normalised(tokens(spark, sf_dir, *corpora, dealt=dealt))


def numbered_gold(spark, sf_dir, *corpora) -> DataFrame:
    """`gold` with SENT_ID; rows are ordered while they are narrow, and normalised afterwards."""
    return normalised(annotated(sentence_ids(placed(spark, sf_dir, *corpora, dealt=in_ranges), KEY, ranged=True)))
