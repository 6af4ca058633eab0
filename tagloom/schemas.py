"""Column names and table schemas."""

from pyspark.sql import types as T

CORP, SENT_ID, TOKN_ID = "CORP", "SENT_ID", "TOKN_ID"
FORM, LEMM, STTS, REDU, UNIV = "FORM", "LEMM", "STTS", "REDU", "UNIV"
PRED_TXT, PRED_TAG, GOLD_TXT, GOLD_TAG = "PRED_TXT", "PRED_TAG", "GOLD_TXT", "GOLD_TAG"
ROW_ID, TOKENS = "ROW_ID", "TOKENS"

TOKEN_KEY = [CORP, SENT_ID, TOKN_ID]

# The column layout of the two raw corpora.
RAW_COLUMNS = {
    "TIGER": [
        TOKN_ID, FORM, LEMM, "PLEMMA", STTS, "PPOS", "FEAT", "PFEAT", "HEAD", "PHEAD",
        "DEPREL", "PDEPREL", "FILLPRED", "PRED", "APREDS",
    ],
    "HDT": [
        TOKN_ID, FORM, LEMM, REDU, STTS, "FEAT", "HEAD", "DEPREL", "UNKNOWN_1", "UNKNOWN_2",
    ],
}
CORPORA = tuple(RAW_COLUMNS)

MINIMAL = [TOKN_ID, FORM, LEMM, STTS]
CANONICAL = [CORP, SENT_ID, TOKN_ID, FORM, LEMM, STTS, UNIV]
ANNOTATED = [CORP, SENT_ID, TOKN_ID, FORM, STTS, UNIV]
MODEL_ANNOTATED = [CORP, SENT_ID, TOKN_ID, FORM, UNIV]

_TYPES = {SENT_ID: T.LongType(), TOKN_ID: T.IntegerType(), ROW_ID: T.LongType()}


def table_schema(columns):
    """StructType for `columns`: ids are integers, everything else is text."""
    return T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in columns])


_SCORES = T.StructType([
    T.StructField("eval_size", T.LongType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1_weighted", T.DoubleType()),
])
_CORPUS_RUN = T.StructType([
    T.StructField("test_size", T.LongType()),
    T.StructField("test_time", T.DoubleType()),
    T.StructField(STTS, _SCORES),
    T.StructField(UNIV, _SCORES),
])
METRICS_RECORD = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("train_size", T.LongType()),
    T.StructField("train_time", T.DoubleType()),
    *[T.StructField(c, _CORPUS_RUN) for c in CORPORA],
])
VERSIONS = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("corpus", T.StringType()),
    T.StructField("tagset", T.StringType()),
    T.StructField("facts", T.StringType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("id", T.StringType()),
])
CONFIG_RECORD = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("embedding", T.StringType()),
    T.StructField("architecture", T.StringType()),
    T.StructField("dimensionality", T.IntegerType()),
    T.StructField("lowercase", T.BooleanType()),
    T.StructField("train_size", T.LongType()),
    T.StructField("shrinking", T.BooleanType()),
    T.StructField("scale", T.BooleanType()),
    T.StructField("C", T.DoubleType()),
    T.StructField("max_iter", T.IntegerType()),
    T.StructField("kernel", T.StringType()),
])
SCORE_RECORD = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("corpus", T.StringType()),
    T.StructField("tagset", T.StringType()),
    T.StructField("test_size", T.LongType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1_weighted", T.DoubleType()),
])
