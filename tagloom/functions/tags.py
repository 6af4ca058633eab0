"""Tag and token normalisation as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.schemas import CORP, FORM, LEMM, STTS

# STTS tag -> universal tag.
STTS_TO_UNIV = {
    "$(": ".", "$,": ".", "$.": ".",
    "ADJA": "ADJ", "ADJD": "ADJ",
    "ADV": "ADV",
    "APPO": "ADP", "APPR": "ADP", "APPRART": "ADP", "APZR": "ADP",
    "ART": "DET",
    "CARD": "NUM",
    "FM": "X", "ITJ": "X",
    "KOKOM": "CONJ", "KON": "CONJ", "KOUI": "CONJ", "KOUS": "CONJ",
    "NE": "NOUN", "NN": "NOUN",
    "PDAT": "PRON", "PDS": "PRON", "PIDAT": "PRON", "PIAT": "PRON", "PIS": "PRON",
    "PPER": "PRON", "PPOSAT": "PRON", "PPOSS": "PRON", "PRELAT": "PRON", "PRELS": "PRON",
    "PRF": "PRON", "PROAV": "PRON",
    "PTKA": "PRT", "PTKANT": "PRT", "PTKNEG": "PRT", "PTKVZ": "PRT", "PTKZU": "PRT",
    "PWAT": "PRON", "PWAV": "PRON", "PWS": "PRON",
    "TRUNC": "X",
    "VAFIN": "VERB", "VAIMP": "VERB", "VAINF": "VERB", "VAPP": "VERB",
    "VMFIN": "VERB", "VMINF": "VERB", "VMPP": "VERB",
    "VVFIN": "VERB", "VVIMP": "VERB", "VVINF": "VERB", "VVIZU": "VERB", "VVPP": "VERB",
    "XY": "X",
}
# Misspelt corpus tags, the extra fix for one corpus, the wider lenient map.
TAG_FIXES = {"NNE": "NE", "PPOSSAT": "PPOSAT", "VAIZU": "VVIZU"}
CORPUS_TAG_FIXES = {"TIGER": TAG_FIXES, "HDT": {**TAG_FIXES, "PIDAT": "PIAT"}}
LENIENT_TO_UNIV = {**STTS_TO_UNIV, "NNE": "NOUN", "PPOSSAT": "PRON", "VAIZU": "VERB"}
# Class codes of the universal tags.
UNIV_CODES = {
    ".": 0, "ADJ": 1, "ADV": 2, "ADP": 3, "DET": 4, "NUM": 5,
    "CONJ": 6, "NOUN": 7, "PRON": 8, "PRT": 9, "VERB": 10, "X": 11,
}
# The published tagset lists PAV where the corpora write PROAV.
STTS_DEFAULT = frozenset(STTS_TO_UNIV) - {"PROAV"} | {"PAV"}


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def literal_map(mapping) -> Column:
    """A constant map; one expression string instead of a call per entry."""
    return F.expr(f"map({', '.join(_literal(x) for pair in mapping.items() for x in pair)})")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(mapping, key) -> Column:
    """mapping[key], null when absent."""
    return literal_map(mapping)[_col(key)]


def fix_tag(tag=STTS, mapping=TAG_FIXES) -> Column:
    """Replace known misspelt tags, keep all others."""
    tag = _col(tag)
    return F.coalesce(lookup(mapping, tag), tag)


def fix_tag_by_corpus(tag=STTS, corpus=CORP) -> Column:
    """`fix_tag` with the table that belongs to each row's corpus."""
    tag, corpus = _col(tag), _col(corpus)
    result = tag
    for name, mapping in CORPUS_TAG_FIXES.items():
        result = F.when(corpus == name, fix_tag(tag, mapping)).otherwise(result)
    return result


def universal(tag=STTS) -> Column:
    """Universal tag; an unknown tag stops the job."""
    tag = _col(tag)
    complaint = F.concat(F.lit("unknown STTS tag: "), F.coalesce(tag, F.lit("NULL")))
    return F.coalesce(lookup(STTS_TO_UNIV, tag), F.raise_error(complaint).cast("string"))


def universal_or_null(tag=STTS) -> Column:
    """Universal tag from the wider map; an unknown tag gives null."""
    return lookup(LENIENT_TO_UNIV, tag)


def encode_class(tag) -> Column:
    return lookup(UNIV_CODES, tag)


def decode_class(code) -> Column:
    return lookup({v: k for k, v in UNIV_CODES.items()}, _col(code).cast("int"))


def token_number(token_id) -> Column:
    """'12_3' -> 3; malformed ids stop the job under ANSI casting."""
    return F.split_part(_col(token_id), F.lit("_"), F.lit(2)).cast("int")


def lemma_or_form(lemma=LEMM, form=FORM) -> Column:
    lemma = _col(lemma)
    return F.when(lemma == "--", _col(form)).otherwise(lemma)


def folded(form=FORM, lowercase=True) -> Column:
    return F.lower(_col(form)) if lowercase else _col(form)
