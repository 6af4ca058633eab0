"""Best-fit packing planned on a histogram of lengths.

Texts become token pieces. The plan fits counts of lengths, not documents, into sequences; pieces
then take the planned slots by their rank within their length.
"""

import zlib
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagloom.llm.common import steps
from tagloom.staging import ship_package, stage

#: Ids of so many text units stay in a Python worker's memory; beyond that it starts anew.
CACHED_UNITS = 250_000
CACHED_LENGTH = 48
#: White space other than the space and the line feed.
OTHER_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
#: Units up to this character are encoded by rank file, others by the full tokenizer.
LATIN_END = "\u024f"
_encoders = {}


class UnitEncoder(dict):
    """Little-endian 32-bit ids of text units.

    The byte-level pattern never joins what stands on both sides of a space that is followed by a
    non-space, or of a single line feed; the text falls into units there and each is encoded once.
    A key stands for itself after a space, or for itself if it starts with a line feed.
    """

    def __init__(self, json_path, ranks_path=None):
        import base64

        from tokenizers import Tokenizer

        self.json_path = json_path
        self.special = [t.content for t in Tokenizer.from_file(json_path).get_added_tokens_decoder().values()]
        self.plain = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    @cached_property
    def full(self):
        """The full tokenizer; a worker that meets only plain Latin text never holds it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.json_path)

    def ids(self, text):
        if self.plain and (text.isascii() or max(text) <= LATIN_END):
            found = self.plain.encode_ordinary(text)
        else:
            found = self.full.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()

    def __missing__(self, key):
        found = self.ids(key if key[:1] == "\n" else " " + key)
        if len(key) <= CACHED_LENGTH:
            if len(self) >= CACHED_UNITS:
                self.clear()
            self[key] = found
        return found

    def encode(self, text):
        """Ids of a whole text as bytes."""
        if not text:
            return b""
        if (
            "  " in text or " \n" in text or "\n " in text or "\n\n" in text
            or any(s in text for s in self.special) or any(c in text for c in OTHER_SPACE)
        ):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *units = text.replace("\n", " \n").split(" ")
        return (self.ids(first) if first else b"") + b"".join(map(self.__getitem__, units))


def _encoder(*paths):
    if paths not in _encoders:
        _encoders[paths] = UnitEncoder(*paths)
    return _encoders[paths]


def token_pieces(
    docs: DataFrame, json_path: str, ranks_path: str | None = None, end_id: int = 2, size: int = 1024
) -> DataFrame:
    """Every text's ids and `end_id`, cut into pieces of `size`; the first piece of a long text may be shorter.

    Columns: doc_id, piece, start, length, ids_crc32, and part and nth, which number the pieces of
    one length within an input partition. A null text counts as empty and gives the end id alone.
    """
    ship_package(docs.sparkSession)
    end = array("I", [end_id]).tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]

    def run(batches):
        encoder = _encoder(json_path, ranks_path)
        part = TaskContext.get().partitionId()
        seen = [0] * (size + 1)
        for rows in steps(batches):
            out = [[] for _ in names]
            for doc, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                ids = encoder.encode(text) + end
                n = len(ids) // 4
                at = piece = 0
                while at < n:
                    length = (n - at - 1) % size + 1 if at == 0 else size
                    row = (doc, piece, at, length, zlib.crc32(ids[4 * at: 4 * (at + length)]), part, seen[length])
                    for values, value in zip(out, row):
                        values.append(value)
                    seen[length] += 1
                    at += length
                    piece += 1
            kinds = [rows.schema.field("doc_id").type, pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            rows = None  # frees the batch before the next one comes
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    )


def plan_slots(counts: dict[int, int], size: int = 1024) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, end rank, first sequence, offset) rows.

    Piece r of a length with first <= r < end goes to sequence first_sequence + r - first at `offset`.
    Work and rows depend on `size` alone, not on the counts.
    """
    room = {}  # free tokens -> [(first sequence, how many)]
    slots, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            free = next((f for f in range(length, size + 1) if room.get(f)), None)
            if free is None:
                free, fits = size, size // length
                many = -(-(total - rank) // fits)
                room[size] = [(opened, many)]
                opened += many
            first, many = room[free].pop()
            fits = free // length
            full = min(many, (total - rank) // fits)
            if full:
                each = fits
            else:  # the last few share one sequence
                full, each = 1, total - rank
            for k in range(each):
                slots.append((length, rank, rank + full, first, size - free + k * length))
                rank += full
            if full < many:
                room[free].append((first + full, many - full))
            if free - each * length:
                room.setdefault(free - each * length, []).append((first, full))
    return slots


_SLOT = "length long, rank_from long, rank_to long, first_sequence long, offset long"


def pack(
    docs: DataFrame, json_path: str, ranks_path: str | None = None, end_id: int = 2, size: int = 1024
) -> DataFrame:
    """Pack every document into sequences of at most `size` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Every row of the
    input is packed, repeated ones and null ids too; an empty table gives no rows. The pieces are
    written once, because their numbers must not change between the histogram and the join. Only the
    histogram (at most `size` rows) and the plan that follows from it pass through the driver.
    """
    spark = docs.sparkSession
    pieces = stage(token_pieces(docs, json_path, ranks_path, end_id, size), "pieces")
    cells = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = cells.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "length", "base")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(plan_slots(counts, size), _SLOT)
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    # The plan has a bound that follows from `size` (a few thousand rows), so it is broadcast.
    slot = F.broadcast(plan.withColumnRenamed("length", "slot_length"))
    fits = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    return ranked.join(slot, fits).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset",
    )
