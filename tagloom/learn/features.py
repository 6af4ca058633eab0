"""Training rows: weighted (form, class) pairs with scaled vectors, and kernel feature maps."""

from itertools import combinations_with_replacement
from math import comb

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tags import encode_class, folded
from tagloom.functions.vectors import as_doubles, literal_vector, min_max_scaled, rbf_kernel
from tagloom.learn.kernels import KernelMap
from tagloom.operators.joins import attach_vectors
from tagloom.operators.ordering import head
from tagloom.schemas import FORM, TOKEN_KEY, UNIV
from tagloom.staging import ship_package


def weighted_rows(tokens: DataFrame, tag=UNIV) -> DataFrame:
    """(FORM, tag, w): equal training rows collapse to one with their number as weight."""
    return tokens.groupBy(FORM, tag).agg(F.count(F.lit(1)).cast("double").alias("w"))


def featureset(
    tokens: DataFrame, vectors: DataFrame, size=0, lowercase=False, tag=UNIV, oov="error", keys=TOKEN_KEY
) -> DataFrame:
    """(FORM, tag, label, w, vec) from the first `size` tokens (all when size < 1)."""
    chosen = head(tokens.select(*keys, FORM, tag), keys, size)
    rows = weighted_rows(chosen.select(folded(FORM, lowercase).alias(FORM), tag), tag)
    return attach_vectors(rows, vectors, oov).select(
        FORM, tag, encode_class(tag).cast("double").alias("label"), "w", as_doubles("vec").alias("vec")
    )


def bounds(rows: DataFrame, vec="vec") -> DataFrame:
    """(dim, low, high) per dimension, from one aggregate without exploding the vectors."""
    stats = rows.select(Summarizer.metrics("min", "max").summary(array_to_vector(as_doubles(vec))).alias("s"))
    pair = F.arrays_zip(vector_to_array("s.min").alias("low"), vector_to_array("s.max").alias("high"))
    return stats.select(F.posexplode(pair).alias("dim", "b")).select("dim", "b.low", "b.high")


def fit_bounds(rows: DataFrame, vec="vec"):
    """([low], [high]); as long as the vectors."""
    found = sorted(bounds(rows, vec).collect())
    return [r["low"] for r in found], [r["high"] for r in found]


def scale(rows: DataFrame, low, high, vec="vec") -> DataFrame:
    return rows.withColumn(
        vec, min_max_scaled(F.col(vec), literal_vector(low), literal_vector(high))
    )


def kernel_block(rows: DataFrame, landmarks, gamma, id_col, vec="vec") -> DataFrame:
    """(id, landmark, k): the exact RBF kernel of every row with each of the given landmarks.

    `landmarks` is a list of (id, values). Its length is a model parameter, it does not grow
    with the rows.
    """
    marks = F.array(*[
        F.struct(F.lit(i).alias("landmark"), literal_vector(v).alias("mark")) for i, v in landmarks
    ])
    block = F.transform(
        marks,
        lambda m: F.struct(m["landmark"].alias("landmark"), rbf_kernel(F.col(vec), m["mark"], gamma).alias("k")),
    )
    return rows.select(id_col, F.inline(block))


EXACT_TERMS = 2048


def fit_kernel_map(rows: DataFrame, kernel, dim, components=128, gamma=None, vec="vec") -> KernelMap:
    """Choose the map; the landmarks are `components` distinct forms in hash order."""
    gamma = gamma or 1.0 / dim
    if kernel == "linear":
        return KernelMap(kernel, gamma)
    if kernel == "poly" and comb(dim + 2, 3) <= EXACT_TERMS:
        return KernelMap(kernel, gamma, exponents=list(combinations_with_replacement(range(dim), 3)))
    if kernel not in ("rbf", "poly"):
        raise ValueError(f"unknown kernel {kernel}")
    # Copies of one vector add nothing: a form counts once whatever its labels.
    pool = rows.groupBy(FORM).agg(F.first(vec).alias(vec))
    chosen = pool.orderBy(F.xxhash64(F.lit(17), FORM), FORM).limit(components).collect()
    marks = np.array([r[vec] for r in chosen])
    found = KernelMap(kernel, gamma, landmarks=marks)
    values, axes = np.linalg.eigh(found.exact(marks, marks))
    keep = values > values.max() * 1e-10
    found.whitening = axes[:, keep] / np.sqrt(values[keep])
    return found


def mapped(rows: DataFrame, kernel_map: KernelMap, vec="vec", out="features") -> DataFrame:
    """Add the ML vector column `out`; dense matrix products run on Arrow batches."""
    if kernel_map.kernel == "linear":
        return rows.withColumn(out, array_to_vector(vec))
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(kernel_map)

    @F.pandas_udf("array<double>")
    def project(batch: pd.Series) -> pd.Series:
        return pd.Series(list(shared.value.apply(np.stack(batch.to_numpy()).astype(float))))

    return rows.withColumn(out, array_to_vector(project(vec)))


def kernel_map_error(rows: DataFrame, kernel_map: KernelMap, probes=64, vec="vec") -> float:
    """Mean absolute difference between the map's kernel and the exact one on `probes` forms."""
    chosen = rows.orderBy(F.xxhash64(F.lit(18), FORM), FORM).limit(probes).select(vec).collect()
    x = np.array([r[vec] for r in chosen])
    z = kernel_map.apply(x)
    return float(np.abs(z @ z.T - kernel_map.exact(x, x)).mean())
