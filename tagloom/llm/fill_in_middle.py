"""Fill-in-middle rewriting of texts, cut by a Fenwick tree over fixed blocks.

A text is cut into units (code points, words or lines). Its UTF-8 bytes are divided into blocks of a fixed
size, and two Fenwick trees over the blocks count the units and the code points that begin in each. A cut
after k units is found by binary lifting: the descent gives the block that holds the cut together with the
code points before it, and only that block is searched for the boundary.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import steps
from tagloom.llm.words import IS_SPACE, text_bytes
from tagloom.staging import ship_package

#: Bytes of a block.
BLOCK = 256
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def char_starts(data):
    """Of UTF-8 bytes, whether each begins a code point."""
    return (data & 0xC0) != 0x80


def word_starts(data):
    """Whether each byte begins a word; a word takes the white space behind it."""
    inside = ~IS_SPACE[data]
    out = inside.copy()
    out[1:] &= ~inside[:-1]
    return out


def line_starts(data):
    """Whether each byte begins a line; a line takes its line feed."""
    out = np.zeros(len(data), bool)
    out[1:] = data[:-1] == 10
    return out


#: Each maps the bytes of a text to the places where its units begin; the first byte always begins one.
UNITS = {"char": char_starts, "word": word_starts, "line": line_starts}


class Fenwick:
    """Prefix sums over blocks with descent."""

    def __init__(self, counts):
        self.tree = [0, *counts]
        for i in range(1, len(self.tree)):
            above = i + (i & -i)
            if above < len(self.tree):
                self.tree[above] += self.tree[i]

    def total(self):
        return self.before(len(self.tree) - 1)

    def before(self, block):
        """Sum over the blocks in front of number `block`."""
        out = 0
        while block:
            out += self.tree[block]
            block &= block - 1
        return out

    def descend(self, k):
        """(block, rest): the block that holds item k, counted from 0, and its place among the block's items."""
        at = 0
        size = len(self.tree)
        stride = 1 << size.bit_length()
        while stride:
            if at + stride < size and self.tree[at + stride] <= k:
                at += stride
                k -= self.tree[at]
            stride >>= 1
        return at, k


class CutIndex:
    """Finds unit boundaries of one text, given where its units and code points begin."""

    def __init__(self, units, chars, block=BLOCK):
        self.units, self.chars, self.block = units, chars, block
        edges = np.arange(0, len(units), block)
        self.unit_tree = Fenwick(np.add.reduceat(units, edges, dtype=np.int64).tolist() if len(edges) else [])
        self.char_tree = Fenwick(np.add.reduceat(chars, edges, dtype=np.int64).tolist() if len(edges) else [])
        self.n = self.unit_tree.total()

    def cut(self, k):
        """(bytes, code points) in front of the boundary after k units."""
        if k >= self.n:
            return len(self.units), self.char_tree.total()
        block, rest = self.unit_tree.descend(k)
        first = block * self.block
        inside = int(np.flatnonzero(self.units[first: first + self.block])[rest])
        return first + inside, self.char_tree.before(block) + int(np.count_nonzero(self.chars[first: first + inside]))


def _draw(hexdigest, i):
    return F.conv(F.substring(hexdigest, 1 + 8 * i, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, unit="char", fim_percent=90, spm_percent=20, seed=1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output (the rewritten text) of every row; other columns are left out.

    The draws h1 to h4 are the first 32-bit groups of the SHA-256 of `seed`:doc_id. The text is cut after
    h1 % (n+1) and h2 % (n+1) of its n units into prefix, middle and suffix. Form is plain (the text as it is,
    null lengths) where the text is null or empty, holds one of the markers <P>, <S>, <M>, or
    h3 % 100 >= fim_percent; else spm (<S>suffix<P>prefix<M>middle) where h4 % 100 < spm_percent, else psm
    (<P>prefix<S>suffix<M>middle). Lengths are in code points.

    A null id draws as an empty one; repeated rows draw alike. Texts are handled whole, however long; one
    pass without a shuffle, a worker holds one text and its output beside a step of short ones.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    ship_package(docs.sparkSession)
    starts = UNITS[unit]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    text = F.coalesce("text", F.lit(""))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (F.length(text) == 0) | marked | (_draw(digest, 2) % 100 >= fim_percent)
    form = F.when(plain, "plain").when(_draw(digest, 3) % 100 < spm_percent, "spm").otherwise("psm")
    drawn = docs.select("doc_id", text.alias("text"), form.alias("form"), _draw(digest, 0).alias("h1"), _draw(digest, 1).alias("h2"))
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches):
        for part in steps(batches):
            data, offsets = text_bytes(part.column("text"))
            chars, units = char_starts(data), starts(data)
            # A unit that would begin inside a code point is impossible: all marks are single bytes.
            begins = offsets[:-1][np.diff(offsets) > 0]
            units[begins] = True
            whole = data.tobytes()
            columns = [[], [], [], []]
            rows = zip(offsets[:-1].tolist(), offsets[1:].tolist(), *(part.column(c).to_pylist() for c in ("form", "h1", "h2")))
            for a, b, form, h1, h2 in rows:
                own = whole[a:b]
                if form == "plain":
                    found = (int(np.count_nonzero(units[a:b])), None, None, own)
                else:
                    index = CutIndex(units[a:b], chars[a:b])
                    first, last = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
                    (i, before), (j, until) = index.cut(first), index.cut(last)
                    prefix, middle, suffix = own[:i], own[i:j], own[j:]
                    parts = (s, suffix, p, prefix, m, middle) if form == "spm" else (p, prefix, s, suffix, m, middle)
                    found = (index.n, before, until - before, b"".join(parts))
                for column, value in zip(columns, found):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(columns[0], pa.int64()), part.column("form"), pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return drawn.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text behind a rewritten one; a marker never arises where text meets marker, so they split it uniquely."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


#: The same by SQL for units of one code point.
SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
), numbered AS (
  SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n,
    CAST('0x' || substr(hex, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(hex, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(hex, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(hex, 25, 8) AS BIGINT) AS h4
  FROM drawn
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbered
), parted AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cut
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parted
"""
