"""The stages of a tagging study as single calls."""

import time

from pyspark.sql import DataFrame

from tagloom.functions.tags import universal_or_null
from tagloom.learn import svm
from tagloom.learn.taggers import form_tag_counts, tag_forms, train_lexicon, train_suffixes
from tagloom.operators.ordering import head
from tagloom.operators.scoring import aligned_cells, by_tagset, class_counts, class_metrics, score_summary
from tagloom.schemas import GOLD_TAG, PRED_TAG, STTS, TOKEN_KEY, UNIV
from tagloom.sinks.records import record_facts
from tagloom.sources.tables import read_vectors
from tagloom.staging import stage


def lexicon_predictions(train: DataFrame, test: DataFrame, suffix_back_off=False) -> DataFrame:
    """Predicted next to gold tag for every counted (form, tag) cell of the test corpus.

    Both inputs are form/tag counts: the prediction depends on the form alone, so equal tokens
    are tagged once, only distinct forms meet the lexicon and no form is hot any more.
    """
    cells = test.withColumnRenamed(STTS, f"GOLD_{STTS}")
    suffixes = train_suffixes(train) if suffix_back_off else None
    return tag_forms(cells, train_lexicon(train), suffixes=suffixes)


def lexicon_class_metrics(train: DataFrame, test: DataFrame, by=()) -> DataFrame:
    """Train the lexicon tagger, tag the test corpus, score it per class."""
    cells = lexicon_predictions(form_tag_counts(train), form_tag_counts(test, by))
    counts = class_counts(cells, by=by, gold=f"GOLD_{STTS}", pred=f"PRED_{STTS}", weight="n")
    return class_metrics(counts, by=by)


def evaluation_cells(predictions: DataFrame, keep=()) -> DataFrame:
    """(keep, tagset, GOLD_TAG, PRED_TAG, n) for both tagsets from STTS predictions."""
    both = predictions.withColumns({
        f"GOLD_{UNIV}": universal_or_null(f"GOLD_{STTS}"),
        f"PRED_{UNIV}": universal_or_null(f"PRED_{STTS}"),
    })
    return by_tagset(both, keep=(*keep, "n"))


def evaluation_grid(predictions: DataFrame, keep=("CORP", "tagger")) -> DataFrame:
    """Score summary per corpus, tagger and tagset in one aggregate."""
    counts = class_counts(evaluation_cells(predictions, keep), by=(*keep, "tagset"), weight="n")
    return score_summary(counts, by=(*keep, "tagset"))


def evaluate(pred: DataFrame, gold: DataFrame, tagset, key=TOKEN_KEY, cut_gold=False):
    """(class metrics, summary) of an annotation table against its gold table.

    `cut_gold` compares with as many leading gold tokens as there are predictions.
    """
    if cut_gold:
        gold = head(gold, list(key), pred.count())
    counts = class_counts(aligned_cells(pred, gold, tagset, key), gold=GOLD_TAG, pred=PRED_TAG, weight="n")
    return class_metrics(counts), score_summary(counts)


def run_study(spark, models_dir, model, corpus, tokens: DataFrame, gold: DataFrame, vectors_root, test_size=0, key=TOKEN_KEY):
    """Tag a corpus with a saved model, score it, and record both in the model's metrics.

    The vectors are those that the model's settings name below `vectors_root`. Returns the annotation.
    """
    tagger = svm.load(spark, models_dir, model)
    s = tagger.settings
    vectors = read_vectors(spark, vectors_root, s.architecture, s.dimensionality, s.lowercase)
    began = time.time()
    tagged = stage(svm.annotate(tagger, tokens, vectors, test_size, keys=list(key)), "annotation")
    record_facts(spark, models_dir, model, corpus, test_size=test_size, test_time=time.time() - began)
    row = evaluate(tagged, gold, UNIV, key, cut_gold=test_size > 0)[1].first()
    record_facts(
        spark, models_dir, model, corpus, UNIV, eval_size=row["test_size"],
        **{c: row[c] for c in ("accuracy", "precision", "recall", "f1_weighted")},
    )
    return tagged
