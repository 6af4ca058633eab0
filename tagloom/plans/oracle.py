"""DuckDB SQL for the registered queries, over the same tables."""

from tagloom.functions.tags import LENIENT_TO_UNIV, STTS_DEFAULT, STTS_TO_UNIV, UNIV_CODES

ORACLE = {}


def _values(mapping):
    return ", ".join(f"('{k}', '{v}')" for k, v in mapping.items())


_LINES = """
la AS (SELECT 'A' AS CORP, conv_id AS D, CAST(turn AS BIGINT) AS E, unnest(string_split(text, chr(10))) AS line,
              generate_subscripts(string_split(text, chr(10)), 1) AS LINE_NO FROM conversations),
lb AS (SELECT 'B' AS CORP, doc_id AS D, CAST(0 AS BIGINT) AS E, unnest(string_split(text, chr(10))) AS line,
              generate_subscripts(string_split(text, chr(10)), 1) AS LINE_NO FROM documents),
sents AS (SELECT CORP, D, E, CAST(LINE_NO AS INTEGER) AS LINE,
                 regexp_extract_all(line, '[\\p{L}\\p{M}]+|[0-9]+|[^\\s\\p{L}\\p{M}0-9]') AS toks
          FROM (SELECT * FROM la UNION ALL SELECT * FROM lb)),
t0 AS (SELECT CORP, D, E, LINE, unnest(toks) AS FORM, CAST(generate_subscripts(toks, 1) AS INTEGER) AS TOKN_ID
       FROM sents WHERE len(toks) > 0),
tok AS (SELECT *, concat(D, '_', TOKN_ID) AS RAW_ID,
  CASE WHEN length(FORM) % 4 = 0 THEN '--' ELSE lower(FORM) END AS RAW_LEMM,
  CASE WHEN FORM IN ('.', '!', '?', ':', ';') THEN '$.'
       WHEN FORM = ',' THEN '$,'
       WHEN regexp_matches(FORM, '^[^\\p{L}\\p{M}0-9]$') THEN '$('
       WHEN regexp_matches(FORM, '^[0-9]+$') THEN 'CARD'
       WHEN lower(FORM) IN ('the','der','die','das','le','la','les','el','los','un') THEN 'ART'
       WHEN lower(FORM) IN ('and','und','et','y','or') THEN 'KON'
       WHEN lower(FORM) IN ('of','in','de','von','to','for','con') THEN 'APPR'
       WHEN (TOKN_ID + length(FORM)) % 11 = 0 THEN 'NNE'
       WHEN regexp_matches(FORM, '^\\p{Lu}') THEN 'NN'
       WHEN length(FORM) % 7 = 0 THEN 'VAIZU'
       WHEN length(FORM) % 5 = 0 THEN 'PPOSSAT'
       WHEN length(FORM) % 3 = 0 THEN 'PIDAT'
       WHEN length(FORM) % 4 = 0 THEN 'ADJA'
       ELSE 'VVFIN' END AS RAW_STTS
  FROM t0)"""
_GOLD = _LINES + """,
umap(tag, utag) AS (VALUES %s),
fixed AS (SELECT *, CASE WHEN RAW_STTS = 'NNE' THEN 'NE' WHEN RAW_STTS = 'PPOSSAT' THEN 'PPOSAT'
                         WHEN RAW_STTS = 'VAIZU' THEN 'VVIZU'
                         WHEN RAW_STTS = 'PIDAT' AND CORP = 'B' THEN 'PIAT' ELSE RAW_STTS END AS STTS FROM tok),
gold AS (SELECT CORP, D, E, LINE, TOKN_ID, FORM, CASE WHEN RAW_LEMM = '--' THEN FORM ELSE RAW_LEMM END AS LEMM,
                STTS, utag AS UNIV, substr(STTS, 1, 2) AS REDU
         FROM fixed JOIN umap ON STTS = tag)""" % _values(STTS_TO_UNIV)
_LEX = _GOLD + """,
lex AS (SELECT FORM, STTS FROM (
          SELECT FORM, STTS, row_number() OVER (PARTITION BY FORM ORDER BY count(*) DESC, STTS) AS rn
          FROM gold WHERE CORP = 'A' GROUP BY FORM, STTS) WHERE rn = 1),
pred AS (SELECT g.CORP, D, E, LINE, TOKN_ID, g.FORM, g.STTS AS GOLD_TAG, coalesce(lex.STTS, 'NN') AS PRED_TAG
         FROM gold g LEFT JOIN lex ON g.FORM = lex.FORM WHERE g.CORP = 'B')"""
_CLASSES = """,
cnt AS (SELECT GOLD_TAG AS class, count(*) AS c, count(*) FILTER (GOLD_TAG = PRED_TAG) AS t FROM pred GROUP BY 1),
fps AS (SELECT PRED_TAG AS class, count(*) FILTER (GOLD_TAG <> PRED_TAG) AS f FROM pred GROUP BY 1),
classes AS (SELECT coalesce(cnt.class, fps.class) AS class, coalesce(c, 0) AS count, coalesce(t, 0) AS tp,
                   coalesce(f, 0) AS fp, coalesce(c, 0) - coalesce(t, 0) AS fn
            FROM cnt FULL OUTER JOIN fps ON cnt.class = fps.class)"""


def _prf(source, tail=""):
    """P, R and F1 with their zero rules on top of count, tp, fp, fn."""
    return f"""SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f{tail} FROM (
      SELECT *, CASE WHEN tp + fp = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p,
                CASE WHEN tp + fn = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS r FROM {source})"""


_SCORED = _CLASSES + f""",
scored AS ({_prf('classes')}),
tot AS ({_prf('(SELECT sum(count) AS count, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM classes)')})"""


def _sql(name, body, ctes=_LINES):
    ORACLE[name] = f"WITH {ctes.strip()}\n{body.strip()}" if ctes else body.strip()


# --- evaluation
_sql("class_metrics", """
SELECT class, 'class' AS row_kind, CAST(count AS BIGINT) AS count, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(fn AS BIGINT) AS fn, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM scored
UNION ALL
SELECT 'sum', 'sum', CAST(count AS BIGINT), CAST(tp AS BIGINT), CAST(fp AS BIGINT), CAST(fn AS BIGINT),
       round(p, 6), round(r, 6), round(f, 6) FROM tot
UNION ALL
SELECT 'weighted avg', 'weighted avg', CAST(floor(avg(count)) AS BIGINT), CAST(floor(avg(tp)) AS BIGINT),
       CAST(floor(avg(fp)) AS BIGINT), CAST(floor(avg(fn)) AS BIGINT),
       round(sum(p * count) / sum(count), 6), round(sum(r * count) / sum(count), 6),
       round(sum(f * count) / sum(count), 6) FROM scored""", _LEX + _SCORED)
_sql("class_counts", """
SELECT class, CAST(count AS BIGINT) AS count, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(fn AS BIGINT) AS fn FROM classes""", _LEX + _CLASSES)
_sql("score_summary", """
SELECT CAST((SELECT count FROM tot) AS BIGINT) AS test_size, round_even((SELECT p FROM tot), 3) AS accuracy,
       round_even(sum(p * count) / sum(count), 3) AS precision, round_even(sum(r * count) / sum(count), 3) AS recall,
       round_even(sum(f * count) / sum(count), 3) AS f1_weighted, round_even(avg(f), 3) AS f1_macro
FROM scored""", _LEX + _SCORED)

_SUFFIX = """,
a_counts AS (SELECT FORM, STTS, count(*) AS n FROM gold WHERE CORP = 'A' GROUP BY 1, 2),
a_suf AS (SELECT right(FORM, k) AS SUFFIX, STTS, sum(n) AS n
          FROM a_counts, (VALUES (1), (2), (3)) AS ks(k) WHERE length(FORM) >= k GROUP BY 1, 2),
suf AS (SELECT SUFFIX, STTS FROM (
          SELECT SUFFIX, STTS, row_number() OVER (PARTITION BY SUFFIX ORDER BY n DESC, STTS) AS rn FROM a_suf)
        WHERE rn = 1)"""
_sql("evaluation_grid", f"""
SELECT CORP, tagger, tagset, CAST(any_value(tc) AS BIGINT) AS test_size, round_even(any_value(tp_), 3) AS accuracy,
       round_even(sum(p * count) / sum(count), 3) AS precision, round_even(sum(r * count) / sum(count), 3) AS recall,
       round_even(sum(f * count) / sum(count), 3) AS f1_weighted, round_even(avg(f), 3) AS f1_macro
FROM (SELECT *, sum(count) OVER g AS tc, CAST(sum(tp) OVER g AS DOUBLE) / sum(tp + fp) OVER g AS tp_
      FROM gscored WINDOW g AS (PARTITION BY CORP, tagger, tagset))
GROUP BY 1, 2, 3""", _LEX + _SUFFIX + f""",
forms AS (SELECT DISTINCT FORM FROM gold),
tagged AS (SELECT f.FORM, coalesce(lex.STTS, 'NN') AS plain,
                  coalesce(lex.STTS, s3.STTS, s2.STTS, s1.STTS, 'NN') AS backed
           FROM forms f LEFT JOIN lex ON f.FORM = lex.FORM
           LEFT JOIN suf s3 ON length(f.FORM) >= 3 AND s3.SUFFIX = right(f.FORM, 3)
           LEFT JOIN suf s2 ON length(f.FORM) >= 2 AND s2.SUFFIX = right(f.FORM, 2)
           LEFT JOIN suf s1 ON s1.SUFFIX = right(f.FORM, 1)),
gpred AS (SELECT g.CORP, 'lexicon' AS tagger, g.STTS AS gs, t.plain AS ps FROM gold g JOIN tagged t ON g.FORM = t.FORM
          UNION ALL
          SELECT g.CORP, 'suffix', g.STTS, t.backed FROM gold g JOIN tagged t ON g.FORM = t.FORM),
gall AS (SELECT CORP, tagger, 'STTS' AS tagset, gs AS g, ps AS q FROM gpred
         UNION ALL
         SELECT CORP, tagger, 'UNIV', a.utag, b.utag FROM gpred JOIN umap a ON gs = a.tag JOIN umap b ON ps = b.tag),
gg AS (SELECT CORP, tagger, tagset, g AS class, count(*) AS c, count(*) FILTER (g = q) AS t FROM gall GROUP BY ALL),
gp AS (SELECT CORP, tagger, tagset, q AS class, count(*) FILTER (g <> q) AS f FROM gall GROUP BY ALL),
gclasses AS (SELECT CORP, tagger, tagset, class, coalesce(c, 0) AS count, coalesce(t, 0) AS tp, coalesce(f, 0) AS fp,
                    coalesce(c, 0) - coalesce(t, 0) AS fn
             FROM gg FULL OUTER JOIN gp USING (CORP, tagger, tagset, class)),
gscored AS ({_prf('gclasses')})""")
_sql("align_gold_predictions", """
SELECT GOLD_TAG, PRED_TAG, true AS same_text, count(*) AS n FROM pred GROUP BY 1, 2""", _LEX)
_sql("alignment_report", """
SELECT count(*) AS n_rows, count(*) FILTER (CORP = 'A') AS missing_pred, CAST(0 AS BIGINT) AS missing_gold,
       CAST(0 AS BIGINT) AS text_mismatch FROM gold""", _GOLD)
_sql("tagger_accuracy", """
SELECT CORP, count(*) AS n, round(avg(CASE WHEN GOLD_TAG = PRED_TAG THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM pred GROUP BY 1""", _LEX)

# --- normalisation
_sql("minimal_scan", "SELECT TOKN_ID, FORM, RAW_LEMM, RAW_STTS, count(*) AS n FROM tok GROUP BY ALL")
_sql("fix_tags", """
SELECT RAW_STTS, CASE RAW_STTS WHEN 'NNE' THEN 'NE' WHEN 'PPOSSAT' THEN 'PPOSAT' WHEN 'VAIZU' THEN 'VVIZU'
                 ELSE RAW_STTS END AS STTS, count(*) AS n FROM tok GROUP BY ALL""")
_sql("fix_tags_by_corpus", "SELECT CORP, RAW_STTS, STTS, count(*) AS n FROM fixed GROUP BY ALL", _GOLD)
_sql("parse_token_ids", """
SELECT CORP, CAST(split_part(RAW_ID, '_', 2) AS INTEGER) AS TOKN_ID, count(*) AS n FROM tok GROUP BY ALL""")
_sql("universal_tags", "SELECT CORP, STTS, UNIV, count(*) AS n FROM gold GROUP BY ALL", _GOLD)
_LENIENT = _LINES + ",\nlmap(tag, utag) AS (VALUES %s)" % _values(LENIENT_TO_UNIV)
_sql("universal_tags_lenient", """
SELECT RAW_STTS, a.utag AS UNIV, b.utag AS REDU_UNIV, count(*) AS n
FROM tok LEFT JOIN lmap a ON RAW_STTS = a.tag LEFT JOIN lmap b ON substr(RAW_STTS, 1, 2) = b.tag
GROUP BY ALL""", _LENIENT)
_sql("universal_tags_joined", """
SELECT RAW_STTS, utag AS UNIV, count(*) AS n FROM tok JOIN umap ON RAW_STTS = tag GROUP BY ALL""", _GOLD)
_sql("lemma_fallback", "SELECT FORM, LEMM, count(*) AS n FROM gold GROUP BY ALL", _GOLD)
_ORDER = "PARTITION BY CORP ORDER BY D, E, LINE, TOKN_ID"
_NUMBERED = f""",
flags AS (SELECT *, TOKN_ID <= lag(TOKN_ID, 1, 1) OVER ({_ORDER}) AS BOUNDARY FROM %s),
numbered AS (SELECT *, CAST(sum(CAST(BOUNDARY AS INTEGER)) OVER ({_ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT)
             AS SENT_ID FROM flags)"""
_sql("canonical_corpus", "SELECT CORP, SENT_ID, TOKN_ID, FORM, LEMM, STTS, UNIV FROM numbered",
     _GOLD + _NUMBERED % "gold")
_sql("case_folding", "SELECT CORP, lower(FORM) AS FORM, count(*) AS n FROM tok GROUP BY ALL")
_sql("class_codes", """
SELECT UNIV, code, UNIV AS decoded, count(*) AS n FROM gold JOIN codes ON UNIV = codes.u GROUP BY ALL""",
     _GOLD + ",\ncodes(u, code) AS (VALUES %s)" % ", ".join(f"('{k}', {v})" for k, v in UNIV_CODES.items()))
_sql("placeholder_filter", "SELECT DISTINCT CORP, FORM FROM tok WHERE FORM NOT IN ('_', '')")

# --- order
_sql("sentence_boundaries", "SELECT CORP, TOKN_ID, BOUNDARY, count(*) AS n FROM numbered GROUP BY ALL",
     _LINES + _NUMBERED % "tok")
_sql("sentence_numbers", """
SELECT CORP, SENT_ID, count(*) AS n, min(D) AS D, min(E) AS E, min(LINE) AS LINE FROM numbered GROUP BY 1, 2""",
     _LINES + _NUMBERED % "tok")
_sql("row_numbers", """
SELECT CORP, D, E, LINE, min(rn) AS first_row, max(rn) AS last_row, count(*) AS n
FROM (SELECT *, row_number() OVER (ORDER BY CORP, D, E, LINE, TOKN_ID) AS rn FROM tok) GROUP BY 1, 2, 3, 4""")
_sql("head_slice", """
SELECT CORP, D, E, LINE, TOKN_ID, FORM FROM (
  SELECT *, row_number() OVER (ORDER BY CORP, D, E, LINE, TOKN_ID) AS rn FROM tok) WHERE rn <= 1000""")
_sql("tail_preview", """
SELECT CORP, D, E, LINE, TOKN_ID, FORM, CAST(row_number() OVER (ORDER BY CORP, D, E, LINE, TOKN_ID) AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY CORP DESC, D DESC, E DESC, LINE DESC, TOKN_ID DESC) AS rn FROM tok)
WHERE rn <= 1000""")
_sql("training_slice", """
SELECT UNIV, count(*) AS n FROM (
  SELECT *, row_number() OVER (ORDER BY D, E, LINE, TOKN_ID) AS rn FROM gold WHERE CORP = 'A')
WHERE rn <= 1000 GROUP BY 1""", _GOLD)

# --- tagsets
_sql("tag_counts", "SELECT CORP, STTS, count(*) AS n FROM gold GROUP BY ALL", _GOLD)
_sql("tag_pair_counts", "SELECT CORP, STTS, REDU, count(*) AS n FROM gold GROUP BY ALL", _GOLD)
_sql("tagset_summary", """
SELECT CORP, string_agg(STTS, ' ' ORDER BY STTS) AS tags, CAST(count(*) AS INTEGER) AS size
FROM (SELECT DISTINCT CORP, STTS FROM gold WHERE STTS NOT IN ('_', '')) GROUP BY 1""", _GOLD)
_DEFAULTS = _GOLD + ",\ndefaults(STTS) AS (VALUES %s)" % ", ".join(f"('{t}')" for t in sorted(STTS_DEFAULT))
_sql("tags_outside_default", "SELECT DISTINCT RAW_STTS FROM tok EXCEPT SELECT STTS FROM defaults", _DEFAULTS)
_sql("default_tags_missing", "SELECT STTS AS RAW_STTS FROM defaults EXCEPT SELECT RAW_STTS FROM tok", _DEFAULTS)
_sql("reduced_tag_mapping", """
SELECT STTS, max(REDU) AS REDU FROM gold WHERE CORP = 'B' AND STTS <> REDU GROUP BY 1""", _GOLD)
_sql("tagset_differences", """
SELECT CORP, kind, tag, 'extra' AS side FROM kinds WHERE tag NOT IN (SELECT STTS FROM defaults)
UNION ALL
SELECT g.CORP, g.kind, d.STTS, 'missing' FROM (SELECT DISTINCT CORP, kind FROM kinds) g, defaults d
WHERE NOT EXISTS (SELECT 1 FROM kinds k WHERE k.CORP = g.CORP AND k.kind = g.kind AND k.tag = d.STTS)""", _DEFAULTS + """,
kinds AS (SELECT DISTINCT CORP, 'STTS' AS kind, STTS AS tag FROM gold UNION SELECT DISTINCT CORP, 'REDU', REDU FROM gold)""")
_sql("reduced_tag_choices", """
SELECT STTS, max(substr(STTS, 1, CAST(2 + length(FORM) % 3 AS BIGINT))) AS REDU FROM gold
WHERE STTS <> substr(STTS, 1, CAST(2 + length(FORM) % 3 AS BIGINT)) GROUP BY 1""", _GOLD)
_sql("annotation_profile", "SELECT CORP, PRED_TAG AS STTS, count(*) AS n FROM pred GROUP BY ALL", _LEX)

# --- sentences, vocabulary, word statistics
_sql("sentence_assembly", """
SELECT CORP, D, E, LINE, string_agg(lower(FORM), ' ' ORDER BY TOKN_ID) AS sentence, CAST(count(*) AS INTEGER) AS n
FROM tok GROUP BY 1, 2, 3, 4""")
_sql("corpus_union", "SELECT CORP, count(*) AS n FROM tok GROUP BY 1")
_VOCAB = _LINES + ",\nvocab AS (SELECT FORM, count(*) AS n FROM tok GROUP BY 1)"
_sql("vocabulary", "SELECT FORM, n, row_number() OVER (ORDER BY n DESC, FORM) AS rank FROM vocab", _VOCAB)
_sql("keep_probabilities", """
SELECT FORM, n, round(least(1.0, (sqrt(x) + 1) / x), 6) AS keep
FROM (SELECT FORM, n, n / (0.001 * (SELECT sum(n) FROM vocab)) AS x FROM vocab)""", _VOCAB)
_sql("subsampled_tokens", """
SELECT FORM, count(*) AS n
FROM (SELECT tok.FORM, v.n / (0.001 * (SELECT sum(n) FROM vocab)) AS x,
             CAST(CAST('0x' || left(md5(concat_ws('|', '1', CORP, D, E, LINE, TOKN_ID)), 8) AS BIGINT) AS DOUBLE) / 4294967296 AS draw
      FROM tok JOIN vocab v ON tok.FORM = v.FORM)
WHERE draw < least(1.0, (sqrt(x) + 1) / x) GROUP BY 1""", _VOCAB)
_sql("training_pairs", """
SELECT CENTER, CAST(sum(n) AS BIGINT) AS n, count(*) AS contexts, CAST(max(n) AS BIGINT) AS most
FROM (SELECT a.FORM AS CENTER, b.FORM AS CONTEXT, sum(6 - abs(a.step)) AS n
FROM (SELECT *, unnest([-5, -4, -3, -2, -1, 1, 2, 3, 4, 5]) AS step FROM kept) a
JOIN kept b ON a.CORP = b.CORP AND a.D = b.D AND a.E = b.E AND a.LINE = b.LINE AND b.pos = a.pos + a.step
GROUP BY 1, 2) GROUP BY 1""", _VOCAB + """,
rates AS (SELECT FORM, least(1.0, (sqrt(x) + 1) / x) AS keep FROM (SELECT FORM, n / (0.001 * (SELECT sum(n) FROM vocab)) AS x FROM vocab)),
kept AS MATERIALIZED (SELECT CORP, D, E, LINE, FORM, row_number() OVER (PARTITION BY CORP, D, E, LINE ORDER BY TOKN_ID) AS pos
  FROM tok JOIN rates USING (FORM)
  WHERE CAST(CAST('0x' || left(md5(concat_ws('|', '1', CORP, D, E, LINE, TOKN_ID)), 8) AS BIGINT) AS DOUBLE) / 4294967296 < keep)""")
_sql("held_out_likelihood", "SELECT * FROM (VALUES ('sg', true, true), ('cb', true, CAST(NULL AS BOOLEAN))) x(arch, above_start, above_unigram)", None)
_sql("negative_distribution", """
SELECT FORM, n, round(pow(n, 0.75) / mass, 9) AS p FROM counted, total""", _LINES + """,
counted AS MATERIALIZED (SELECT FORM, count(*) AS n FROM tok GROUP BY 1),
total AS MATERIALIZED (SELECT sum(pow(n, 0.75)) AS mass FROM counted)""")
_sql("context_pair_counts", """
SELECT CENTER, CAST(sum(n) AS BIGINT) AS n, count(*) AS contexts, max(n) AS most,
       min(CONTEXT) AS first_context, max(CONTEXT) AS last_context
FROM (SELECT a.FORM AS CENTER, b.FORM AS CONTEXT, count(*) AS n
FROM (SELECT *, unnest([-5, -4, -3, -2, -1, 1, 2, 3, 4, 5]) AS step FROM tok) a
JOIN tok b ON a.CORP = b.CORP AND a.D = b.D AND a.E = b.E AND a.LINE = b.LINE AND b.TOKN_ID = a.TOKN_ID + a.step
GROUP BY 1, 2) GROUP BY 1""")

# --- vectors and features
_EMB = """
emb AS (SELECT CAST(vec_id AS VARCHAR) AS FORM, embedding::DOUBLE[] AS vec, label FROM embeddings),
ev AS (SELECT CAST(user_id AS VARCHAR) AS FORM, event_type AS tag FROM events)"""
_sql("vector_lookup", """
SELECT FORM, n, CAST(len(vec) AS INTEGER) AS dim, round(list_sum(vec), 6) AS vec_sum
FROM (SELECT FORM, count(*) AS n FROM ev GROUP BY 1) JOIN emb USING (FORM)""", _EMB)
_sql("forms_without_vector", """
SELECT DISTINCT CAST(event_id AS VARCHAR) AS FORM FROM events
WHERE CAST(event_id AS VARCHAR) NOT IN (SELECT FORM FROM emb)""", _EMB)
_sql("featureset", """
SELECT FORM, tag, w, round(vec[1], 6) AS first_value
FROM (SELECT FORM, tag, count(*) AS w FROM ev GROUP BY 1, 2) JOIN emb USING (FORM)""", _EMB)
_sql("weighted_training_rows", """
SELECT FORM, UNIV, code AS label, count(*) AS w FROM gold JOIN codes ON UNIV = codes.u WHERE CORP = 'A' GROUP BY ALL""",
     _GOLD + ",\ncodes(u, code) AS (VALUES %s)" % ", ".join(f"('{k}', {v})" for k, v in UNIV_CODES.items()))
_DIMS = _EMB + """,
cells AS (SELECT FORM, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS dim, unnest(vec) AS v FROM emb),
lims AS (SELECT dim, min(v) AS low, max(v) AS high FROM cells GROUP BY 1)"""
_sql("vector_bounds", "SELECT dim, round(low, 6) AS low, round(high, 6) AS high FROM lims", _DIMS)
_sql("scaled_vectors", """
SELECT FORM, dim, round((v - low) / CASE WHEN high = low THEN 1.0 ELSE high - low END, 6) AS x
FROM cells JOIN lims USING (dim)""", _DIMS)
_sql("kernel_block", """
SELECT e.FORM, m.label AS landmark, round(exp(-pow(list_distance(e.vec, m.vec), 2) / 64), 6) AS k
FROM emb e, (SELECT label, vec FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY CAST(FORM AS BIGINT)) AS rn FROM emb) WHERE rn = 1) m""",
     _EMB)

# --- taggers
_SHAPE = _LINES + """,
shaped AS (SELECT *, CASE WHEN FORM[1] BETWEEN '0' AND '9' THEN 'CARD'
                          WHEN FORM[1] BETWEEN 'A' AND 'Z' AND TOKN_ID > 1 THEN 'NE'
                          WHEN TOKN_ID = max(TOKN_ID) OVER (PARTITION BY CORP, D, E, LINE) THEN 'QQ'
                          ELSE 'NN' END AS STTS FROM tok)"""
_sql("sentence_tagger", """
SELECT CORP, TOKN_ID, STTS, CASE STTS WHEN 'CARD' THEN 'NUM' WHEN 'NE' THEN 'NOUN' WHEN 'NN' THEN 'NOUN' END AS UNIV,
       count(*) AS n FROM shaped GROUP BY ALL""", _SHAPE)
_sql("sentence_tagger_by_workers", "SELECT CORP, FORM, STTS, count(*) AS n FROM shaped GROUP BY ALL", _SHAPE)
_sql("lexicon", "SELECT FORM, STTS FROM lex", _LEX)
_sql("suffix_lexicon", "SELECT SUFFIX, STTS FROM suf", _GOLD + _SUFFIX)
_HASHED = """
hashed AS (SELECT CORP, D, E, LINE, len(toks) AS n_tokens,
                  concat_ws('|', md5(concat_ws('|', '0', CORP, D, E, LINE)), CORP, D, E, LINE) AS h
           FROM sents WHERE len(toks) > 0%s),
split AS (SELECT *, row_number() OVER (ORDER BY h) <= floor(0.1 * count(*) OVER ()) AS IS_TEST FROM hashed)"""
_sql("holdout_split", "SELECT CORP, D, E, LINE, CAST(n_tokens AS INTEGER) AS n_tokens, IS_TEST FROM split",
     _LINES + "," + _HASHED % "")
_sql("holdout_accuracy", """
SELECT count(*) AS n, round(avg(CASE WHEN g.STTS = coalesce(hlex.STTS, 'NN') THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM ga g LEFT JOIN hlex ON g.FORM = hlex.FORM WHERE g.IS_TEST""", _GOLD + "," + _HASHED % " AND CORP = 'A'" + """,
ga AS (SELECT gold.*, IS_TEST FROM gold JOIN split USING (CORP, D, E, LINE)),
hlex AS (SELECT FORM, STTS FROM (
           SELECT FORM, STTS, row_number() OVER (PARTITION BY FORM ORDER BY count(*) DESC, STTS) AS rn
           FROM ga WHERE NOT IS_TEST GROUP BY FORM, STTS) WHERE rn = 1)""")

# --- experiment records
_RUNS = """
runs AS (SELECT printf('%d-%d-%d-%d-%.2f', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS model,
                l_linestatus AS embedding_model, l_returnflag AS scale, o_orderpriority AS C,
                CAST(l_linenumber - 1 AS BIGINT) AS train_size,
                CASE WHEN l_tax < 0.07 THEN -1 ELSE 1000 END AS max_iter,
                l_discount AS f1_weighted, l_tax AS precision, l_extendedprice AS train_time, l_quantity AS test_time
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_sql("full_size_runs", """
SELECT CASE WHEN train_size = 0 THEN (SELECT count(*) FROM orders) ELSE train_size END AS train_size, count(*) AS n
FROM runs GROUP BY 1""", _RUNS)
_sql("unlimited_runs", """
SELECT max_iter, train_size, count(*) AS n FROM runs WHERE max_iter = -1 GROUP BY 1, 2""", _RUNS)
_sql("rounded_scores", "SELECT event_id, round_even(value / 16, 3) AS score FROM events", None)
_sql("best_runs", """
SELECT train_size, model, f1_weighted, scale, C, embedding_model FROM (
  SELECT *, row_number() OVER (PARTITION BY train_size ORDER BY f1_weighted DESC, model) AS rn FROM runs)
WHERE rn = 1""", _RUNS)
_COLS = ("precision", "f1_weighted", "train_time", "test_time", "train_size")
_MAX = ", ".join(f"max({c}) AS max_{c}" for c in _COLS)
_MEAN = ", ".join(f"round(avg({c}), 4) AS mean_{c}" for c in _COLS)
_MIN = ", ".join(f"min({c}) AS min_{c}" for c in ("train_time", "test_time"))
for _name, _aggs in (("group_maxima", _MAX), ("group_means", _MEAN), ("group_minima", _MIN)):
    _sql(_name, f"SELECT scale, embedding_model, {_aggs} FROM runs GROUP BY 1, 2", _RUNS)
_sql("key_sweep", f"""
SELECT CASE WHEN grouping(embedding_model) = 0 THEN 'embedding_model' WHEN grouping(scale) = 0 THEN 'scale'
            WHEN grouping(C) = 0 THEN 'C' ELSE 'train_size' END AS key,
       coalesce(embedding_model, scale, C, CAST(train_size AS VARCHAR)) AS value,
       CASE WHEN grouping(embedding_model) + grouping(scale) + grouping(C) < 3
            THEN CAST(train_size AS VARCHAR) END AS subset,
       count(*) AS runs, first(model ORDER BY f1_weighted DESC, model) AS best_model, {_MAX}, {_MEAN}, {_MIN}
FROM runs WHERE max_iter = -1
GROUP BY GROUPING SETS ((train_size), (embedding_model), (scale), (C), (embedding_model, train_size),
                        (scale, train_size), (C, train_size))""", _RUNS)
_sql("joined_records", """
SELECT concat('m', coalesce(o_orderkey, l_orderkey)) AS model, o_orderkey IS NOT NULL AND l_returnflag IS NOT NULL AND l_returnflag <> 'R' AS complete,
       CASE WHEN complete THEN l_tax END AS f1_weighted, CASE WHEN complete THEN l_extendedprice END AS train_time,
       CASE WHEN complete THEN l_suppkey END AS train_size, CASE WHEN complete THEN l_partkey END AS test_size,
       CASE WHEN complete THEN o_orderstatus END AS embedding_model, CASE WHEN complete THEN o_orderkey % 2 = 0 END AS lowercase
FROM orders FULL JOIN (SELECT * FROM lineitem WHERE l_linenumber = 2) ON o_orderkey = l_orderkey""", None)
_sql("latest_log_entries", """
WITH e AS (SELECT concat('m', l_orderkey) AS model, l_linenumber % 3 AS kind, * FROM lineitem),
t AS (SELECT * FROM e WHERE kind = 0 QUALIFY row_number() OVER (
        PARTITION BY model ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC) = 1),
g AS (SELECT * FROM e WHERE kind = 1 QUALIFY row_number() OVER (
        PARTITION BY model ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC) = 1),
s AS (SELECT * FROM e WHERE kind = 2 QUALIFY row_number() OVER (
        PARTITION BY model ORDER BY l_shipdate DESC, l_suppkey DESC, l_discount DESC, l_tax DESC) = 1)
SELECT s.model, t.l_extendedprice AS train_time, g.l_partkey AS test_size, g.l_quantity AS test_time, s.l_suppkey AS eval_size,
       s.l_discount AS accuracy, s.l_tax AS precision
FROM s JOIN g ON s.model = g.model LEFT JOIN t ON s.model = t.model WHERE s.l_shipdate >= g.l_shipdate""", None)
_sql("limit_sweep", f"""
SELECT CASE WHEN grouping(max_iter) = 0 THEN 'max_iter' ELSE 'train_size' END AS key,
       coalesce(CAST(max_iter AS VARCHAR), CAST(train_size AS VARCHAR)) AS value,
       CASE WHEN grouping(max_iter) = 0 THEN CAST(train_size AS VARCHAR) END AS subset,
       count(*) AS runs, first(model ORDER BY f1_weighted DESC, model) AS best_model, {_MAX}, {_MEAN}, {_MIN}
FROM runs GROUP BY GROUPING SETS ((train_size), (max_iter), (max_iter, train_size))""", _RUNS)
_sql("leaderboard", """
SELECT row_number() OVER (ORDER BY f1_weighted DESC, model) AS rank, model, f1_weighted, precision FROM runs""", _RUNS)
_sql("plot_series", """
SELECT concat(CASE embedding_model WHEN 'O' THEN 'open' ELSE embedding_model END, ' | train-size: ', train_size) AS series,
       count(*) AS n, max(train_time) AS max_x, max(f1_weighted) AS max_y
FROM runs WHERE embedding_model IN ('O', 'F') AND train_size IN (0, 2, 4) GROUP BY 1""", _RUNS)

# --- files
_NUMBERED_ROWS = _NUMBERED + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY CORP ORDER BY D, E, LINE, TOKN_ID) AS ROW_ID FROM numbered)"""
_sql("raw_corpus_preprocessed", """
SELECT 'TIGER' AS CORP, SENT_ID, TOKN_ID, FORM, LEMM, STTS, UNIV, ROW_ID FROM placed WHERE CORP = 'A'""",
     _GOLD + _NUMBERED_ROWS % "gold")
_HDT = _LINES + """,
hdt AS (SELECT *, CASE WHEN RAW_STTS = 'NNE' THEN 'NE' WHEN RAW_STTS = 'PPOSSAT' THEN 'PPOSAT'
                       WHEN RAW_STTS = 'VAIZU' THEN 'VVIZU' WHEN RAW_STTS = 'PIDAT' THEN 'PIAT'
                       ELSE RAW_STTS END AS STTS,
               sum(CASE WHEN TOKN_ID = 1 THEN 1 ELSE 0 END)
                 OVER (ORDER BY CORP, D, E, LINE, TOKN_ID ROWS UNBOUNDED PRECEDING) AS sid FROM tok)"""
_sql("multi_file_corpus", """
SELECT CAST(sid AS BIGINT) AS SENT_ID, count(*) AS n, min(FORM) AS least, max(FORM) AS greatest, max(STTS) AS last_tag
FROM hdt GROUP BY 1""", _HDT)
_sql("raw_scan", """
SELECT TOKN_ID, substr(RAW_STTS, 1, 2) AS REDU, STTS, '_' AS FEAT, count(*) AS n FROM hdt WHERE CORP = 'B'
GROUP BY ALL""", _HDT)
_sql("raw_minimal_scan", """
SELECT FORM, RAW_LEMM AS LEMM, STTS, count(*) AS n FROM hdt WHERE CORP = 'B' GROUP BY ALL""", _HDT)
_sql("tagged_sentences", """
SELECT SENT_ID, CAST(count(*) AS INTEGER) AS n, string_agg(concat(FORM, '/', RAW_STTS), ' ' ORDER BY TOKN_ID) AS tagged
FROM numbered WHERE CORP = 'A' GROUP BY 1""", _LINES + _NUMBERED % "tok")
_sql("preprocessed_tsv", """
SELECT CORP, SENT_ID, TOKN_ID, FORM, LEMM, STTS, UNIV FROM numbered WHERE CORP = 'A'""", _GOLD + _NUMBERED % "gold")
_sql("preprocessed_parquet", """
SELECT CORP, FORM, LEMM, STTS, UNIV, count(*) AS n FROM gold WHERE CORP = 'B' GROUP BY ALL""", _GOLD)
_sql("annotation_tsv", """
SELECT CORP, SENT_ID, TOKN_ID, FORM,
       CASE RAW_STTS WHEN 'NNE' THEN 'NE' WHEN 'PPOSSAT' THEN 'PPOSAT' WHEN 'VAIZU' THEN 'VVIZU'
            ELSE RAW_STTS END AS STTS, utag AS UNIV
FROM numbered JOIN lmap ON RAW_STTS = tag WHERE CORP = 'A'""", _LENIENT + _NUMBERED % "tok")
_sql("model_annotation_tsv", """
SELECT CORP, SENT_ID, TOKN_ID, FORM, UNIV FROM numbered WHERE CORP = 'A'""", _GOLD + _NUMBERED % "gold")
_sql("class_metrics_tsv", f"""
SELECT class, row_kind, CAST(count AS VARCHAR) AS count, CAST(tp AS VARCHAR) AS tp, CAST(fp AS VARCHAR) AS fp,
       CAST(fn AS VARCHAR) AS fn, printf('%.3f', precision) AS precision, printf('%.3f', recall) AS recall,
       printf('%.3f', f1) AS f1
FROM ({ORACLE['class_metrics'].replace('round(', 'identity_(')})""".replace("identity_(p, 6)", "p")
     .replace("identity_(r, 6)", "r").replace("identity_(f, 6)", "f")
     .replace("identity_(", "round("), None)
_sql("score_records", f"""
SELECT 'lexicon' AS model, CORP AS corpus, tagset, test_size, accuracy, precision, recall, f1_weighted
FROM ({ORACLE['evaluation_grid']}) WHERE tagger = 'lexicon' AND CORP = 'B'""", None)

# --- learning: the learnt numbers differ by design, what every run must give does not
_FACTS = "SELECT DISTINCT FORM, true AS complete, true AS finite FROM tok"
for _name in ("skipgram_vectors", "skipgram_vectors_ml", "cbow_vectors", "factorised_vectors"):
    _sql(_name, _FACTS)
_sql("vector_grid", """
SELECT arch, CAST(dim AS INTEGER) AS dim, lowercase, count(*) AS forms, count(*) AS distinct_forms,
       CAST(dim AS INTEGER) AS shortest
FROM (SELECT DISTINCT lower(FORM) AS f, true AS lowercase FROM tok
      UNION ALL SELECT DISTINCT FORM, false FROM tok),
     (VALUES ('sg'), ('cb')) a(arch), (VALUES (12), (25), (50), (100)) d(dim) GROUP BY arch, dim, lowercase""")
_sql("vector_table_lookup", "SELECT FORM, CAST(len(vec) AS INTEGER) AS dim FROM emb", _EMB)
_sql("saved_svm", "SELECT FORM, true AS same FROM emb", _EMB)
_sql("saved_lexicon", """
SELECT FORM AS key, STTS, 'form' AS kind FROM lex UNION ALL SELECT SUFFIX, STTS, 'suffix' FROM suf""", _LEX + _SUFFIX)
_sql("svm_linear", """
SELECT FORM, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS code
FROM (SELECT FORM, vec[1:4] AS v FROM emb) WHERE list_max(v) - list_sort(v)[3] > 0.05""", _EMB)
_sql("svm_pairs", ORACLE["svm_linear"], None)
_sql("svm_pair_gaps", """
SELECT CAST(a.code AS INTEGER) AS first, CAST(b.code AS INTEGER) AS second, true AS converged, a.n + b.n AS n, CAST(0 AS BIGINT) AS wrong
FROM classes a JOIN classes b ON a.code < b.code""", _EMB + """,
classes AS (SELECT list_position(vec[1:4], list_max(vec[1:4])) - 1 AS code, count(*) AS n FROM emb GROUP BY 1 HAVING code < 3)""")
_sql("svm_rbf", """
SELECT FORM, CASE WHEN r < 0.02 THEN 0 ELSE 1 END AS code
FROM (SELECT FORM, vec[1] * vec[1] + vec[2] * vec[2] AS r FROM emb) WHERE abs(r - 0.02) > 0.004""", _EMB)
_sql("svm_exact", ORACLE["svm_rbf"], None)
_sql("svm_poly", """
SELECT FORM, CASE WHEN p < 0 THEN 0 ELSE 1 END AS code
FROM (SELECT FORM, vec[1] * vec[2] * vec[3] AS p FROM emb) WHERE abs(p) > 0.0005""", _EMB)
_sql("ppmi_rows", """
SELECT arch, CENTER, count(*) AS entries, round(sum(m), 4) AS total, round(max(m), 6) AS largest
FROM (SELECT p.arch, p.CENTER, ln(p.n / (c.total * (pow(x.total, 0.75) / smooth))) - ln(5) AS m
      FROM pairs p JOIN totals c ON p.arch = c.arch AND p.CENTER = c.f JOIN totals x ON p.arch = x.arch AND p.CONTEXT = x.f
      JOIN (SELECT arch, sum(pow(total, 0.75)) AS smooth FROM totals GROUP BY 1) s ON p.arch = s.arch)
WHERE m > 0 GROUP BY 1, 2""", _LINES + """,
placed AS (SELECT *, 2520 // nullif(least(TOKN_ID - 1, 5) + least(max(TOKN_ID) OVER (PARTITION BY CORP, D, E, LINE) - TOKN_ID, 5), 0) AS w FROM tok),
hits AS (SELECT a.FORM AS CENTER, b.FORM AS CONTEXT, count(*) AS sg, sum(a.w + b.w) AS cb
         FROM (SELECT *, unnest([-5, -4, -3, -2, -1, 1, 2, 3, 4, 5]) AS step FROM placed) a
         JOIN placed b ON a.CORP = b.CORP AND a.D = b.D AND a.E = b.E AND a.LINE = b.LINE AND b.TOKN_ID = a.TOKN_ID + a.step
         GROUP BY 1, 2),
pairs AS (SELECT 'sg' AS arch, CENTER, CONTEXT, CAST(sg AS DOUBLE) AS n FROM hits
          UNION ALL SELECT 'cb', CENTER, CONTEXT, CAST(cb AS DOUBLE) FROM hits),
totals AS (SELECT arch, CENTER AS f, sum(n) AS total FROM pairs GROUP BY 1, 2)""")
_sql("vector_checks", """
SELECT arch, true AS converged, true AS differ, (SELECT count(DISTINCT FORM) FROM tok) AS forms FROM (VALUES ('sg'), ('cb')) a(arch)""")
_sql("svm_annotation", "SELECT CORP, D, count(*) AS n, count(*) AS tagged FROM tok WHERE CORP = 'B' GROUP BY 1, 2")
_sql("context_tagger", """
SELECT CORP, D, PRED_UNIV, count(*) AS n, count(*) FILTER (PRED_UNIV = UNIV) AS hits
FROM feat JOIN combo USING (f1, f2, f3, f4, f5)
JOIN (SELECT id, UNIV AS PRED_UNIV FROM scored QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, code) = 1) USING (id)
WHERE CORP = 'B' GROUP BY 1, 2, 3""", _GOLD + """,
codes(UNIV, code) AS (VALUES %s),
feat AS (SELECT *, lower(FORM) AS f1, right(FORM, 3) AS f2,
                regexp_replace(regexp_replace(regexp_replace(FORM, '\\p{Lu}+', 'X', 'g'), '\\p{Ll}+', 'x', 'g'), '[0-9]+', 'd', 'g') AS f3,
                coalesce(lag(lower(FORM)) OVER s, '<edge>') AS f4, coalesce(lead(lower(FORM)) OVER s, '<edge>') AS f5
         FROM gold WINDOW s AS (PARTITION BY CORP, D, E, LINE ORDER BY TOKN_ID)),
cls AS (SELECT UNIV, count(*) AS n FROM feat WHERE CORP = 'A' GROUP BY 1),
cells AS (SELECT f, v, UNIV, count(*) AS n FROM (
            SELECT UNIV, unnest([1, 2, 3, 4, 5]) AS f, unnest([f1, f2, f3, f4, f5]) AS v FROM feat WHERE CORP = 'A') GROUP BY 1, 2, 3),
kinds AS (SELECT f, count(DISTINCT v) AS k FROM cells GROUP BY 1),
base AS (SELECT UNIV, ln(any_value(n) / (SELECT sum(n) FROM cls)) + sum(ln(0.1 / (n + 0.1 * k))) AS b FROM cls, kinds GROUP BY 1),
combo AS (SELECT row_number() OVER () AS id, * FROM (SELECT DISTINCT f1, f2, f3, f4, f5 FROM feat WHERE CORP = 'B')),
gains AS (SELECT id, UNIV, sum(ln((n + 0.1) / 0.1)) AS s
          FROM (SELECT id, unnest([1, 2, 3, 4, 5]) AS f, unnest([f1, f2, f3, f4, f5]) AS v FROM combo) JOIN cells USING (f, v) GROUP BY 1, 2),
scored AS (SELECT combo.id, base.UNIV, code, round(b + coalesce(s, 0), 9) AS score
           FROM combo CROSS JOIN base JOIN codes ON base.UNIV = codes.UNIV LEFT JOIN gains ON gains.id = combo.id AND gains.UNIV = base.UNIV)""" % ", ".join(f"('{k}', {v})" for k, v in UNIV_CODES.items()))
_sql("history_tagger", """
SELECT CORP, D, PRED_UNIV, count(*) AS n, count(*) FILTER (PRED_UNIV = UNIV) AS hits
FROM numbered JOIN (SELECT sid, pos, UNIV AS PRED_UNIV FROM path JOIN ranked USING (code)) USING (sid, pos) GROUP BY 1, 2, 3""", "RECURSIVE " + _GOLD.strip() + """,
codes(UNIV, code) AS (VALUES %s),
feat AS MATERIALIZED (SELECT *, lower(FORM) AS f1, right(FORM, 3) AS f2,
                regexp_replace(regexp_replace(regexp_replace(FORM, '\\p{Lu}+', 'X', 'g'), '\\p{Ll}+', 'x', 'g'), '[0-9]+', 'd', 'g') AS f3,
                coalesce(lag(lower(FORM)) OVER s, '<edge>') AS f4, coalesce(lead(lower(FORM)) OVER s, '<edge>') AS f5, lag(UNIV) OVER s AS before
         FROM gold WINDOW s AS (PARTITION BY CORP, D, E, LINE ORDER BY TOKN_ID)),
cls AS (SELECT UNIV, count(*) AS n FROM feat WHERE CORP = 'A' GROUP BY 1),
ranked AS MATERIALIZED (SELECT UNIV, n, CAST(row_number() OVER (ORDER BY codes.code) - 1 AS BIGINT) AS code FROM cls JOIN codes USING (UNIV)),
cells AS (SELECT f, v, UNIV, count(*) AS n FROM (
            SELECT UNIV, unnest([1, 2, 3, 4, 5]) AS f, unnest([f1, f2, f3, f4, f5]) AS v FROM feat WHERE CORP = 'A') GROUP BY 1, 2, 3),
kinds AS (SELECT f, count(DISTINCT v) AS k FROM cells GROUP BY 1),
base AS (SELECT UNIV, CAST(round(1e6 * (ln(any_value(n) / (SELECT sum(n) FROM cls)) + sum(ln(0.1 / (n + 0.1 * k))))) AS BIGINT) AS b FROM cls, kinds GROUP BY 1),
combo AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM (SELECT DISTINCT f1, f2, f3, f4, f5 FROM feat WHERE CORP = 'B')),
gains AS (SELECT id, UNIV, sum(CAST(round(1e6 * ln((n + 0.1) / 0.1)) AS BIGINT)) AS s
          FROM (SELECT id, unnest([1, 2, 3, 4, 5]) AS f, unnest([f1, f2, f3, f4, f5]) AS v FROM combo) JOIN cells USING (f, v) GROUP BY 1, 2),
scored AS (SELECT combo.id, list(CAST(b + coalesce(s, 0) AS BIGINT) ORDER BY code) AS own
           FROM combo CROSS JOIN base JOIN ranked ON base.UNIV = ranked.UNIV LEFT JOIN gains ON gains.id = combo.id AND gains.UNIV = base.UNIV GROUP BY 1),
numbered AS MATERIALIZED (SELECT CORP, D, UNIV, f1, f2, f3, f4, f5, dense_rank() OVER (ORDER BY D, E, LINE) AS sid,
             row_number() OVER (PARTITION BY D, E, LINE ORDER BY TOKN_ID) AS pos FROM feat WHERE CORP = 'B'),
emitted AS MATERIALIZED (SELECT sid, pos, own FROM numbered JOIN combo USING (f1, f2, f3, f4, f5) JOIN scored USING (id)),
pairs AS (SELECT before, UNIV, count(*) AS n FROM feat WHERE CORP = 'A' GROUP BY 1, 2),
steps AS MATERIALIZED (SELECT a.code AS prev, b.code, CAST(round(1e6 * (ln((coalesce(p.n, 0) + 0.1) / (a.n + 0.1 * (SELECT count(*) FROM ranked))) - ln(b.n / (SELECT sum(n) FROM ranked)))) AS BIGINT) AS gain
  FROM (SELECT code, r.UNIV, (SELECT coalesce(sum(n), 0) FROM pairs WHERE before = r.UNIV) AS n FROM ranked r
        UNION ALL SELECT -1, NULL, (SELECT sum(n) FROM pairs WHERE before IS NULL)) a
  CROSS JOIN ranked b LEFT JOIN pairs p ON p.before IS NOT DISTINCT FROM a.UNIV AND p.UNIV = b.UNIV),
fwd(sid, pos, code, x) AS (
  SELECT sid, pos, code, (own[code + 1] + gain) * 16 FROM emitted, steps WHERE pos = 1 AND prev = -1
  UNION ALL
  SELECT sid, pos, code, max(y) + any_value(own[code + 1]) * 16 FROM (
    SELECT e.sid, e.pos, s.code, e.own, ((f.x - (f.x %% 16 + 16) %% 16) + s.gain * 16) + 15 - f.code AS y
    FROM fwd f JOIN emitted e ON e.sid = f.sid AND e.pos = f.pos + 1 JOIN steps s ON s.prev = f.code) GROUP BY 1, 2, 3),
ends AS (SELECT sid, pos, arg_max(code, (x - (x %% 16 + 16) %% 16) + 15 - code) AS code FROM fwd
  JOIN (SELECT sid, max(pos) AS pos FROM numbered GROUP BY 1) USING (sid, pos) GROUP BY 1, 2),
path(sid, pos, code) AS (
  SELECT sid, pos, code FROM ends
  UNION ALL
  SELECT p.sid, p.pos - 1, 15 - (f.x %% 16 + 16) %% 16 FROM path p JOIN fwd f ON f.sid = p.sid AND f.pos = p.pos AND f.code = p.code WHERE p.pos > 1)""" % ", ".join(f"('{k}', {v})" for k, v in UNIV_CODES.items()))


_sql("positional_alignment", """
SELECT CORP, count(p.pos) AS n_pred, count(g.pos) AS n_gold, count(*) FILTER (p.pos IS NULL) AS missing_pred, count(*) FILTER (g.pos IS NULL) AS missing_gold,
       count(*) FILTER (p.FORM <> g.FORM) AS text_mismatch,
       min(pos) FILTER (p.pos IS NULL OR g.pos IS NULL OR p.FORM <> g.FORM) AS first_difference
FROM (SELECT CORP, FORM, row_number() OVER (PARTITION BY CORP ORDER BY D, E, LINE, TOKN_ID, copy) AS pos FROM pred) p
FULL JOIN (SELECT CORP, FORM, row_number() OVER (PARTITION BY CORP ORDER BY D, E, LINE, TOKN_ID) AS pos FROM tok) g USING (CORP, pos) GROUP BY 1""", _LINES + """,
pred AS (SELECT CORP, D, E, LINE, TOKN_ID, CASE WHEN D % 30 = 5 AND TOKN_ID = 1 THEN FORM || '~' ELSE FORM END AS FORM,
           unnest(CASE WHEN D % 40 = 9 AND LINE = 1 AND TOKN_ID = 2 THEN [0, 1] ELSE [0] END) AS copy
         FROM tok WHERE NOT (D % 50 = 7 AND LINE = 1 AND TOKN_ID = 3))""")
_sql("record_files", """
WITH o AS (SELECT *, replace(substr(o_orderpriority, 3), ' ', '_') AS model, o_orderkey % 3 AS kind FROM orders),
latest AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY model, kind ORDER BY CAST(o_orderdate AS TIMESTAMP) DESC, o_orderkey DESC) = 1),
wide AS (SELECT s.model, t.o_custkey AS train_size, CAST(t.o_totalprice AS DOUBLE) AS train_time, r.o_custkey AS test_size, round(CAST(s.o_totalprice AS DOUBLE) / 1e6, 9) AS accuracy,
           s.model NOT LIKE 'L%' AND CAST(s.o_orderdate AS TIMESTAMP) >= CAST(r.o_orderdate AS TIMESTAMP) AS complete
         FROM (SELECT * FROM latest WHERE kind = 2) s JOIN (SELECT * FROM latest WHERE kind = 0) t USING (model) JOIN (SELECT * FROM latest WHERE kind = 1) r USING (model))
SELECT model, CASE WHEN complete THEN train_size END AS train_size, CASE WHEN complete THEN train_time END AS train_time,
  CASE WHEN complete THEN test_size END AS test_size, CASE WHEN complete THEN accuracy END AS accuracy, CASE WHEN complete THEN 1000.0::DOUBLE END AS C, complete FROM wide""", None)
