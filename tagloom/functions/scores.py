"""Precision, recall, F1 and rounding as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_one(part: Column, whole: Column) -> Column:
    """part / whole, and 1 where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(1.0)).otherwise(F.try_divide(part.cast("double"), whole))


def precision(tp, fp) -> Column:
    return ratio_or_one(tp, tp + fp)


def recall(tp, fn) -> Column:
    return ratio_or_one(tp, tp + fn)


def f1(p, r) -> Column:
    return F.when(p + r == 0, F.lit(0.0)).otherwise(F.try_divide(2 * p * r, p + r))


def is_correct(pred="PRED_TAG", gold="GOLD_TAG") -> Column:
    """Null never equals anything, not even null."""
    return F.coalesce(F.col(pred) == F.col(gold), F.lit(False))


def round_half_even(value, digits=3) -> Column:
    """Scale, round to the nearest even integer, scale back: how array libraries round floats."""
    shift = F.lit(float(10 ** digits))
    value = F.col(value) if isinstance(value, str) else value
    return F.rint(value * shift) / shift
