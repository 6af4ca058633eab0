"""Row numbers, sentence boundaries and ordered slices without one global window.

All of them are prefix sums over a total order. They run in two phases: every ordered unit of
rows (a range partition, or a file split) is handled on its own, one summary row per unit is
carried forward, and the carried values are joined back.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.schemas import CORP, ROW_ID, SENT_ID, TOKN_ID
from tagloom.staging import ship_package, stage

_SHIFT = 33  # monotonically_increasing_id keeps the partition number above this bit


def _sorted_ranges(df: DataFrame, keys, ranged=False) -> DataFrame:
    """Partitions that are sorted ranges of `keys`.

    Ranges are balanced over the whole composite key, so a hot leading key is cut into as many
    ranges as its share of the rows asks for. `ranged`: the partitions of `df` are ranges of its leading
    keys already, as those of rows that were expanded from range-partitioned ones; none is moved.
    """
    return (df if ranged else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)


def range_ordered(df: DataFrame, keys, ranged=False, keep=None) -> DataFrame:
    """Rows range-partitioned and sorted by the unique `keys`, staged with _unit and _pos; `keep` names the columns to stage."""
    stamp = F.monotonically_increasing_id()
    ordered = _sorted_ranges(df, keys, ranged).select(*(keep or df.columns), stamp.alias("_at"))
    staged = stage(ordered, "ordered")
    return (
        staged.withColumn("_unit", F.shiftright("_at", _SHIFT).cast("int"))
        .withColumn("_pos", F.col("_at").bitwiseAND(F.lit((1 << _SHIFT) - 1)))
        .drop("_at")
    )


def number_rows(df: DataFrame, keys, within=(), name=ROW_ID, ranged=False, keep=None) -> DataFrame:
    """Dense 1-based row numbers in key order, restarting for each `within` value.

    `ranged`: see `_sorted_ranges`. `keep`: columns of the result, `within` among them; all, if not given.
    """
    within = list(within)
    rows = range_ordered(df, within + [k for k in keys if k not in within], ranged, keep)
    before = Window.partitionBy(*within).orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    units = (
        rows.groupBy(*within, "_unit")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_base"))
        .withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_base") + 1)
        .drop("_n", "_base")
    )
    # Written, so that its size is known when the join is planned: the rows are not moved again.
    numbered = rows.join(stage(units, "units"), within + ["_unit"])
    return numbered.withColumn(name, F.col("_skip") + F.col("_pos")).drop("_unit", "_pos", "_skip")


def _carry(cells):
    """Add _prev, _seen and _nth to rows that come in order: what a row needs from those before it in its cell.

    A cell is a run of rows with equal `cells` columns. _prev is the TOKN_ID before, _seen the rows so far whose TOKN_ID
    is not larger than the one before, _nth the place from 1. One pass; only the last row is remembered.
    """
    def run(batches):
        last, token, seen, nth = None, None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(c) for c in cells]
            fresh = np.zeros(n, bool)
            for key in keys:
                fresh[1:] |= ~pc.equal(key[1:], key[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
            first = tuple(key[0].as_py() for key in keys)
            fresh[0] = first != last
            tokens = batch.column(TOKN_ID).cast(pa.int64())
            known = tokens.is_valid().to_numpy(zero_copy_only=False)
            values = tokens.fill_null(0).to_numpy(zero_copy_only=False)
            before = np.concatenate([[token or 0], values[:-1]])
            has = np.concatenate([[token is not None], known[:-1]]) & ~fresh
            falls = has & known & (values <= before)
            begin = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
            sums = np.cumsum(falls)
            whole = np.where(begin >= 0, sums - sums[np.maximum(begin, 0)], sums + seen)
            place = np.where(begin >= 0, np.arange(n) - begin + 1, np.arange(n) + 1 + nth)
            last, token = tuple(key[n - 1].as_py() for key in keys), tokens[n - 1].as_py()
            seen, nth = int(whole[-1]), int(place[-1])
            added = [pa.array(before, pa.int64(), mask=~has), pa.array(whole, pa.int64()), pa.array(place, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "_prev", "_seen", "_nth"])

    return run


def sentence_ids_in_order(rows: DataFrame, unit, within=(CORP,)) -> DataFrame:
    """Add BOUNDARY, SENT_ID and ROW_ID to rows that every task meets in order, as a scan or a sorted range gives them.

    `unit` are columns whose values name a stretch of such rows and order the stretches. A row is a boundary when its
    TOKN_ID is not larger than the one before it; the very first row is compared with 1. SENT_ID counts the
    boundaries so far.

    One pass over the rows as they are written; a stretch then gives one summary row, and what the stretches
    before it add up to comes back by a join with that small table. No row is moved for it.
    """
    unit, within = list(unit), list(within)
    ship_package(rows.sparkSession)
    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, T.LongType()) for c in ("_prev", "_seen", "_nth")]])
    inner = stage(rows.mapInArrow(_carry([*within, *unit]), schema), "carried")
    order = Window.partitionBy(*within).orderBy(*unit)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    units = (
        inner.groupBy(*within, *unit)
        .agg(
            F.max("_nth").alias("_n"),
            F.max("_seen").alias("_inside"),
            F.min_by(TOKN_ID, "_nth").alias("_first"),
            F.max_by(TOKN_ID, "_nth").alias("_last"),
        )
        .withColumn("_carried", F.coalesce(F.lag("_last").over(order), F.lit(1)))
        .withColumn("_head", F.coalesce((F.col("_first") <= F.col("_carried")).cast("long"), F.lit(0)))
        .withColumn("_sents", F.coalesce(F.sum(F.col("_inside") + F.col("_head")).over(before), F.lit(0)))
        .withColumn("_rows", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(*within, *unit, "_carried", "_head", "_sents", "_rows")
    )
    # Written, so that its size is known when the join is planned.
    joined = inner.join(stage(units, "units"), within + unit)
    return (
        joined.withColumn("BOUNDARY", F.col(TOKN_ID) <= F.coalesce("_prev", "_carried"))
        .withColumn(SENT_ID, F.col("_sents") + F.col("_head") + F.col("_seen"))
        .withColumn(ROW_ID, F.col("_rows") + F.col("_nth"))
        .drop("_prev", "_seen", "_nth", "_carried", "_head", "_sents", "_rows")
    )


def sentence_ids(df: DataFrame, keys, within=(CORP,), ranged=False) -> DataFrame:
    """`sentence_ids_in_order` for a table whose order is given by unique key columns: one range exchange, none if `ranged`."""
    within = list(within)
    keys = within + [k for k in keys if k not in within]
    ordered = _sorted_ranges(df, keys, ranged)
    return sentence_ids_in_order(ordered.withColumn("_unit", F.spark_partition_id()), ["_unit"], within).drop("_unit")


#: A slice of at most so many rows is picked by partition: each gives its first rows, a bounded number.
PICKED_ROWS = 10_000


def head(df: DataFrame, keys, n) -> DataFrame:
    """First n rows in key order; n < 1 keeps everything.

    A short slice is what remains of the first n rows of every partition; for a long one all rows are numbered by ranges.
    """
    if n < 1:
        return df
    if n <= PICKED_ROWS:
        return df.orderBy(*keys).limit(n)
    return number_rows(df, keys, name="_nth").where(F.col("_nth") <= n).drop("_nth")


def preview(df: DataFrame, keys, n) -> DataFrame:
    """n > 0: the first n rows, n < 0: the last -n rows, in key order; short and long slices as in `head`."""
    if n == 0:
        return df
    if abs(n) <= PICKED_ROWS:
        order = [F.col(k).asc() if n > 0 else F.col(k).desc() for k in keys]
        return df.orderBy(*order).limit(abs(n)).orderBy(*keys)
    numbered = number_rows(df, keys, name="_nth")
    if n > 0:
        kept = numbered.where(F.col("_nth") <= n)
    else:
        kept = numbered.where(F.col("_nth") > (numbered.agg(F.max("_nth")).first()[0] or 0) + n)
    return kept.orderBy(*keys).drop("_nth")
