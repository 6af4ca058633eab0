"""Repeated lines, found as repeated windows of three consecutive lines.

Windows overlap; of equal windows anywhere in the corpus the first by (doc_id, line) stays and later
ones cover lines that go. A window of blank lines alone does not count.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import own_names
from tagloom.staging import ship_package


def _later_windows(rows, size):
    """(doc_id, text_key, line) of every window that occurs before in the corpus."""
    lines = rows.where(F.col("doc_id").isNotNull()).select(
        "doc_id", "text_key", F.split("text", "\n").alias("lines")
    ).where(F.size("lines") >= size)
    windows = F.transform(
        F.sequence(F.lit(1), F.size("lines") - (size - 1)), lambda i: F.slice("lines", i, F.lit(size))
    )
    every = lines.select("doc_id", "text_key", F.posexplode(windows).alias("line", "window"))
    joined = F.concat_ws("\n", "window")
    # Two hash functions make 128 bits.
    keyed = every.where(joined.rlike(r"[^\x20\x09-\x0D]")).select(
        F.xxhash64("window").alias("h1"), F.xxhash64(F.concat(joined, F.lit("\n")), F.length(joined)).alias("h2"),
        F.struct("doc_id", "text_key", "line").alias("at"),
    )
    first = keyed.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    repeated = first.where("first < last").select("h1", "h2", "first")
    return keyed.join(repeated, ["h1", "h2"]).where("at > first").select("at.*")


@own_names
def remove_repeated_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """`docs` with n_lines and n_removed added and the covered lines taken out of text.

    A row with null text or null id loses nothing (and takes nothing from others). Rows that share
    both id and text count as one place and do not take lines from each other; rows that share only
    the id are ordered by a hash of their text. A text whose every line goes becomes empty.
    """
    ship_package(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    later = _later_windows(rows, size)
    # One array per document: as long as its own lines at most.
    covered = later.groupBy("doc_id", "text_key").agg(F.collect_list("line").alias("_starts")).select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "_starts"
    )

    @F.pandas_udf("text string, gone int")
    def without(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        kept, gone = [], []
        for text, own in zip(texts, starts):
            if own is None:
                kept.append(text)
                gone.append(0)
                continue
            lines = text.split("\n")
            edges = np.zeros(len(lines) + 1, np.int64)
            np.add.at(edges, np.asarray(own), 1)
            np.add.at(edges, np.asarray(own) + size, -1)
            stay = np.flatnonzero(np.cumsum(edges)[:-1] == 0)
            kept.append("\n".join([lines[i] for i in stay]))
            gone.append(len(lines) - len(stay))
        return pd.DataFrame({"text": kept, "gone": gone})

    same = (F.col("doc_id") == F.col("_doc")) & (F.col("_text_key") == F.col("_key"))
    met = docs.withColumn("_text_key", F.xxhash64("text")).join(covered, same, "left")
    # Texts that lose nothing need not leave the JVM.
    cleaned = met.withColumn("_new", without(F.when(F.col("_starts").isNotNull(), F.col("text")), F.col("_starts")))
    lost = F.col("_starts").isNotNull()
    return cleaned.select(
        *[F.when(lost, F.col("_new.text")).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in docs.columns
          if c not in ("n_lines", "n_removed")],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).alias("n_lines"),
        F.when(lost, F.col("_new.gone")).otherwise(0).alias("n_removed"),
    )


#: Lines kept of every document, by the same rule on exact lines.
SQL = """
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS ln, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), wide AS (
  SELECT doc_id, i, ln, lead(ln, 1) OVER w AS l2, lead(ln, 2) OVER w AS l3 FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), marked AS (
  SELECT doc_id, i, ln,
         l3 IS NOT NULL AND regexp_matches(ln || l2 || l3, '[^\\x20\\x09-\\x0D]')
         AND row_number() OVER (PARTITION BY ln, l2, l3 ORDER BY doc_id, i) > 1 AS later
  FROM wide
), gone AS (
  SELECT doc_id, i, ln,
         later OR coalesce(lag(later, 1) OVER w, false) OR coalesce(lag(later, 2) OVER w, false) AS off
  FROM marked WINDOW w AS (PARTITION BY doc_id ORDER BY i)
)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (off) AS INTEGER) AS n_removed,
       sha256(coalesce(string_agg(ln, chr(10) ORDER BY i) FILTER (NOT off), '')) AS kept_sha256
FROM gone GROUP BY doc_id
UNION ALL
SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
