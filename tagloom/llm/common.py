"""What several operators share: whole-text passes over Arrow batches, bucket counts, column names."""

from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles at once; a longer text is a step of its own.
STEP_BYTES = 2 << 20
#: Bytes of text behind one bucket of packed hashes.
BUCKET_BYTES = 16 << 20


def steps(batches, column="text", most=STEP_BYTES):
    """Cut record batches into runs of rows with at most `most` bytes of text, one row at least.

    What Arrow keeps of batches that are gone goes back to the system, as workers live on for the next stages.
    """
    for batch in batches:
        size = 0
        first = 0
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > most:
                yield batch.slice(first, i - first)
                first, size = i, 0
            size += n
        rest, batch = batch.slice(first), None
        if rest.num_rows:
            # No reference stays here while the next batch is read.
            last = [rest]
            del rest
            yield last.pop()
        pa.default_memory_pool().release_unused()


def bucket_count(df: DataFrame, column="text") -> int:
    """Buckets for hashes of all texts; grows with the bytes of text."""
    total = df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
    return max(8, -(-total // BUCKET_BYTES))


def own_names(operator):
    """Put columns that begin with an underscore aside while `operator` (docs first) works: it names its own so."""
    @wraps(operator)
    def run(docs, *args, **settings):
        given = {c.lower() for c in docs.columns}
        aside, n = {}, 0
        for column in docs.columns:
            if column.startswith("_"):
                while f"aside{n}" in given:
                    n += 1
                aside[column] = f"aside{n}"
                n += 1
        found = operator(docs.withColumnsRenamed(aside), *args, **settings)
        return found.withColumnsRenamed({name: column for column, name in aside.items()})

    return run
