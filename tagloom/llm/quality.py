"""Quality rules: word and line counts, and divergence from the corpus's own language references.

Per text, histograms of character classes and of common words are compared with those of all texts of its
language by Jensen-Shannon distance (base 2, so from 0 to 1). DataFrame functions only.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.staging import stage

#: Frequent function words of four languages, lower case.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "as", "on", "be", "by", "this"],
    "de": ["der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "nicht", "ein", "dem", "als", "auf", "ist"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "du", "en", "que", "qui", "dans", "pour", "par", "sur"],
    "es": ["el", "los", "las", "y", "que", "de", "en", "un", "una", "se", "no", "del", "por", "con", "para", "su"],
}
ALL_COMMON = sorted({w for own in COMMON_WORDS.values() for w in own})
_SPACES = r"[\x20\x09-\x0D]+"


def _let(value: Column, use) -> Column:
    """use(value) with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column, size=5) -> Column:
    """Words in windows of `size` that occur twice or more in the array."""
    grams = F.transform(
        F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)])
    )

    def covered(found):
        # Equal windows stand side by side when sorted; their places in order give the covered words.
        ordered = F.array_sort(F.transform(found, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        places = lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, i: (
                F.coalesce(F.get(s, i - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False))
            )), lambda x: x["i"],
        ))
        gaps = lambda p: F.aggregate(F.transform(
            p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(size)), F.lit(size)).cast("long")
        ), F.lit(0).cast("long"), lambda a, b: a + b)
        return _let(_let(ordered, places), gaps)

    def count(found):
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(covered(found))

    return F.when(F.size(words) < size, F.lit(0).cast("long")).otherwise(_let(grams, count))


def _left(text, pattern):
    """Characters that remain without the pattern's matches."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of every row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    chars (lower case, upper case, digits, white space, symbols, rest) and common (ALL_COMMON, other words)."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, _SPACES), "")
    rows = docs.select("doc_id", "lang", text.alias("text"))
    repeated = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words"),
    ))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    known = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w.isin(ALL_COMMON))
    common = _let(known, lambda w: F.array(
        *[(F.size(w) - F.size(F.array_remove(w, c))).cast("long") for c in ALL_COMMON], F.size(w).cast("long")
    ))
    counted = rows.select(
        "doc_id", "lang", repeated.alias("w"),
        (F.length("text") - _left("text", r"[#*$%&|<>]+")).alias("n_symbols"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        F.length("text").cast("long").alias("n"),
        _left("text", r"[^\p{Ll}]+").alias("lower"), _left("text", r"[^\p{Lu}]+").alias("upper"),
        _left("text", r"[^0-9]+").alias("digits"), common.alias("c"),
    ).select("doc_id", "lang", "w.*", "n_symbols", "n_dup_lines", "n", "lower", "upper", "digits", "c")
    space = F.col("n") - F.col("word_chars")
    rest = F.col("word_chars") - F.col("lower") - F.col("upper") - F.col("digits") - F.col("n_symbols")
    found = F.element_at("c", -1)
    others = F.greatest(F.col("n_words") - found, F.lit(0).cast("long"))
    return counted.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array("lower", "upper", "digits", space, "n_symbols", rest).alias("chars"),
        F.concat(F.slice("c", 1, len(ALL_COMMON)), F.array(others)).alias("common"),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts; null if one is empty."""
    def between(both):
        def term(z):
            a, b = z["p"] / both["np"], z["q"] / both["nq"]
            part = lambda x: F.when(x > 0, x * F.log2(2 * x / (a + b))).otherwise(0.0)
            return part(a) + part(b)

        gone = F.sqrt(F.greatest(_sum(F.transform(F.arrays_zip(both["p"].alias("p"), both["q"].alias("q")), term)) / 2, F.lit(0.0)))
        return F.when((both["np"] > 0) & (both["nq"] > 0), gone)

    return _let(F.struct(p.alias("p"), q.alias("q"), _sum(p).alias("np"), _sum(q).alias("nq")), between)


def judge(
    docs: DataFrame, char_limit=0.18, word_share=0.97, least_words=50, least_reference=2000, least_common=100
) -> DataFrame:
    """Per row: doc_id, the five counts, base_failed, char_distance, word_distance and kept.

    A row fails the base rules with under 10 words, or if over a fifth of its words stand in 5-word
    windows that repeat in it. It is kept if it passes them and is no farther from its language's
    reference than `char_limit` in characters and, in words, `word_share` of the distance of a text without any
    common word. A reference with under `least_common` thousandths of common words says nothing about words. Texts under `least_words` are not compared, as short histograms scatter;
    nor are texts of a language with under `least_reference` words in all. A reference has,
    for each bin, the median share over all such texts of the language, so that junk does not move it; rows with null lang are a language of their own. A null text has no words.
    """
    rows = stage(measures(docs), "measures")

    def typical(name, n):
        # Whole thousandths have few distinct values, so the exact median needs little memory.
        total = _let(F.col(name), lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x))
        share = lambda i: F.floor(1000 * F.element_at(name, i + 1) / total).cast("int")
        long_enough = (F.col("n_words") >= least_words) & (total > 0)
        return F.array(*[F.coalesce(F.median(F.when(long_enough, share(i))), F.lit(0.0)) for i in range(n)])

    references = rows.groupBy("lang").agg(
        F.sum("n_words").alias("ref_words"), typical("chars", 6).alias("ref_chars"),
        typical("common", len(ALL_COMMON) + 1).alias("ref_common"),
    ).withColumnRenamed("lang", "ref_lang")
    without = F.array(*[F.lit(0.0)] * len(ALL_COMMON), F.lit(1.0))
    telling = _sum(F.slice("ref_common", 1, len(ALL_COMMON))) >= least_common
    references = references.withColumn("word_limit", F.when(telling, word_share * js_distance(without, F.col("ref_common"))))
    met = rows.join(references, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    compared = (F.col("n_words") >= least_words) & (F.col("ref_words") >= least_reference)
    return met.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        F.when(compared, js_distance(F.col("chars"), F.col("ref_chars"))).alias("char_distance"),
        F.when(compared, js_distance(F.col("common"), F.col("ref_common"))).alias("word_distance"), "word_limit",
    ).withColumn("kept", ~F.col("base_failed") & (F.coalesce("char_distance", F.lit(0.0)) <= char_limit)
                 & F.coalesce(F.col("word_distance") <= F.col("word_limit"), F.lit(True))).drop("word_limit")


def sql(char_limit=0.18, word_share=0.97, least_words=50, least_reference=2000, least_common=100) -> str:
    """The same rules for DuckDB."""
    listed = ", ".join(f"'{w}'" for w in ALL_COMMON)
    counts = ", ".join(f"len(list_filter(cw, lambda x: x = '{w}'))" for w in ALL_COMMON)
    typical = lambda name, n: "[" + ", ".join(
        f"coalesce(quantile_cont(floor(1000 * {name}[{i}] / nullif(list_sum({name}), 0)), 0.5) "
        f"FILTER (n_words >= {least_words} AND list_sum({name}) > 0), 0)" for i in range(1, n + 1)
    ) + "]"
    without = "[" + "0, " * len(ALL_COMMON) + "1]"
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / (a + b)) ELSE 0 END"
    distance = lambda p, q: (
        f"(SELECT sqrt(greatest(sum({part.format('a')} + {part.format('b')}) / 2, 0)) FROM ("
        f"SELECT unnest({p}) / list_sum({p}) AS a, unnest({q}) / list_sum({q}) AS b))"
    )
    return f"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(regexp_split_to_array(lower(t), '[^\\p{{L}}]+'), lambda x: x IN ({listed})) AS cw,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d
), gram AS (
  SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM gram QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, length(t) AS chars_all,
         length(regexp_replace(t, '[^\\p{{Ll}}]+', '', 'g')) AS lo, length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS up,
         length(regexp_replace(t, '[^0-9]+', '', 'g')) AS di, [{counts}] AS cc, greatest(len(ws) - len(cw), 0) AS other
  FROM w LEFT JOIN repeated ON w.doc_id = repeated.doc_id
), f AS (
  SELECT *, [lo, up, di, chars_all - word_chars, n_symbols, word_chars - lo - up - di - n_symbols] AS ch,
         list_append(cc, other) AS co FROM m
), r AS (
  SELECT lang AS rl, sum(n_words) AS rw, {typical('ch', 6)} AS rch, {typical('co', len(ALL_COMMON) + 1)} AS rco FROM f GROUP BY lang
), l AS (
  SELECT *, CASE WHEN list_sum(rco[1:{len(ALL_COMMON)}]) >= {least_common} THEN {word_share} * {distance(without, 'rco')} END AS word_limit FROM r
), j AS (
  SELECT f.*, word_limit, n_words >= {least_words} AND rw >= {least_reference} AS compared,
         {distance('ch', 'rch')} AS cd, {distance('co', 'rco')} AS wd,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM f JOIN l ON f.lang IS NOT DISTINCT FROM l.rl
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND (NOT compared OR (coalesce(cd, 0) <= {char_limit} AND coalesce(wd <= word_limit, true))) AS kept
FROM j
"""
