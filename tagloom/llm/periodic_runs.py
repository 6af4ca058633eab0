"""Maximal periodic runs of words, found by block convolution at dyadic scales.

At scale B the words of a text are cut into blocks of B. For each block the number-theoretic transform
gives, exactly in integers, the sum of squared differences to the words at every distance from B to
2B - 1; a zero is an occurrence of the block in the window behind it. A run of period q, B <= q < 2B, and
of at least 4q words holds two consecutive blocks that recur at distance q, so such chains of blocks seed
the runs, and each is extended word by word (by less than a block) to both sides.

The transform works on codes of the words that are small enough for the sums to stay below the modulus; chains
are checked on the words themselves. A chain that lies in a run of a smaller scale, at a multiple of its period,
is dropped before that. What is left are stretches of at least two primitive periods, of which a text of n
words has less than n, so extensions stay near n log n words even in texts that repeat one word.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import steps
from tagloom.staging import ship_package

#: A prime with roots of unity of order 2^27, and a generator.
MODULUS, GENERATOR = 15 * 2**27 + 1, 31
#: Numbers that one transform call handles at once.
CHUNK = 1 << 17

_P = np.uint64(MODULUS)
_roots = {}


def _reduced(x):
    """x modulo the prime for x below 2^64."""
    return x - x // _P * _P


def _powers(root, n):
    """root^i for i < n, modulo the prime."""
    out = np.ones(n, np.uint64)
    width, step = 1, root
    while width < n:
        more = min(width, n - width)
        out[width: width + more] = _reduced(out[:more] * np.uint64(step))
        step = step * step % MODULUS
        width *= 2
    return out


def _twiddles(size, inverse):
    """The first half of the powers of a root of unity of order `size`, as a column."""
    if (size, inverse) not in _roots:
        root = pow(GENERATOR, (MODULUS - 1) // size, MODULUS)
        if inverse:
            root = pow(root, -1, MODULUS)
        _roots[size, inverse] = _powers(root, size // 2)[:, None]
    return _roots[size, inverse]


def transform(x):
    """Forward transform of the columns of x, whose height is a power of two; rows come out in bit-reversed order."""
    n, width = x.shape
    size = n
    while size > 1:
        v = x.reshape(n // size, 2, size // 2, width)
        a, b = v[:, 0], v[:, 1]
        total = a + b
        gap = a + (_P - b)
        np.minimum(total, total - _P, out=v[:, 0])
        v[:, 1] = _reduced(gap * _twiddles(size, False)) if size > 2 else np.minimum(gap, gap - _P)
        size //= 2
    return x


def inverse_transform(x):
    """Undoes `transform`, times the height."""
    n, width = x.shape
    size = 2
    while size <= n:
        v = x.reshape(n // size, 2, size // 2, width)
        a = v[:, 0].copy()
        b = _reduced(v[:, 1] * _twiddles(size, True)) if size > 2 else v[:, 1].copy()
        total = a + b
        gap = a + (_P - b)
        np.minimum(total, total - _P, out=v[:, 0])
        np.minimum(gap, gap - _P, out=v[:, 1])
        size *= 2
    return x


def block_distances(codes, begins, block):
    """Sums of squared differences, modulo the prime, as an array (distance - block, block number).

    codes: small numbers, 3 * block - 1 of them from each begin on; begins: where the blocks begin.
    """
    height = 2 * block
    at = np.arange(block)[:, None]
    pattern = np.zeros((height, len(begins)), np.uint64)
    # Mirrored, so that the product of transforms correlates.
    pattern[-at[:, 0] % height] = codes[begins + at]
    window = codes[begins + block + np.arange(height)[:, None]]
    squares = window * window
    own = (codes[begins + at] ** np.uint64(2)).sum(axis=0)
    sums = np.zeros((height + 1, len(begins)), np.uint64)
    np.cumsum(squares, axis=0, out=sums[1:])
    product = inverse_transform(_reduced(transform(pattern) * transform(window)))[:block]
    # The transform's height is divided out with the factor of two.
    scale = np.uint64(2 * pow(height, -1, MODULUS) % MODULUS)
    return _reduced(_reduced(own + sums[block: height] - sums[:block]) + (_P - _reduced(product * scale)))


def _chains(block_ids, distances):
    """Chains of consecutive blocks at one distance, two blocks at least: first and last positions in the sorted order."""
    order = np.lexsort((block_ids, distances))
    b, d = block_ids[order], distances[order]
    fresh = np.ones(len(b), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (b[1:] != b[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(b)) - 1 if len(first) else first
    long = last > first
    return order, first[long], last[long]


def _covered(found, start, end, distance):
    """Whether a known run, a period of which divides `distance`, holds the words start to end."""
    if not len(found):
        return np.zeros(len(start), bool)
    known = found[np.argsort(found[:, 0], kind="stable")]
    # A run that holds two blocks is the only one: the one that reaches furthest of those that begin before.
    furthest = np.maximum.accumulate(known[:, 1])
    ahead = np.where(known[:, 1] == furthest, np.arange(len(known)), 0)
    reach = known[np.maximum.accumulate(ahead)]
    nth = np.searchsorted(known[:, 0], start, side="right") - 1
    run = reach[np.maximum(nth, 0)]
    return (nth >= 0) & (run[:, 1] >= end) & (distance % run[:, 2] == 0)


def _equal_stretch(words, at, step, distance, limit, low, high):
    """How many words from `at` on, going by `step`, equal those `distance` behind; `limit` at most, within low to high."""
    out = np.zeros(len(at), np.int64)
    rows = max(1, CHUNK // max(limit, 1))
    for i in range(0, len(at), rows):
        here = at[i: i + rows, None] + step * np.arange(limit)
        d = distance[i: i + rows, None]
        inside = (here >= low[i: i + rows, None]) & (here + d < high[i: i + rows, None])
        x = np.where(inside, here, 0)
        same = inside & (words[x] == words[np.where(inside, here + d, 0)])
        out[i: i + rows] = np.where(same.all(axis=1), limit, same.argmin(axis=1))
    return out


def runs_of(words, offsets, min_length=6, min_exponent=4):
    """Runs of several texts at once: rows (start, end, period), sorted by start and period.

    words: word numbers of all texts, one text after the other; offsets: where each begins, and the end.
    """
    found = np.zeros((0, 3), np.int64)
    sizes = np.diff(offsets)
    longest = int(sizes.max(initial=0))
    block = 1
    while min_exponent * block <= longest:
        use = np.flatnonzero(sizes >= max(min_exponent * block, min_length))
        if len(use):
            fresh = _runs_at(words, offsets[use], offsets[use + 1], block, found)
            length = fresh[:, 1] - fresh[:, 0]
            found = np.concatenate([found, fresh[length >= np.maximum(min_length, min_exponent * fresh[:, 2])]])
        block *= 2
    # A stretch is listed under its smallest period only.
    order = np.lexsort((found[:, 2], found[:, 1], found[:, 0]))
    found = found[order]
    repeat = np.zeros(len(found), bool)
    repeat[1:] = (found[1:, :2] == found[:-1, :2]).all(axis=1)
    found = found[~repeat]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _runs_at(words, begin, end, block, found):
    """Maximal stretches (start, end, period) with periods from `block` to 2 * block - 1 that chains of blocks seed."""
    # Squares of codes add up to less than the modulus.
    codes = (words % math.isqrt((MODULUS - 1) // block)).astype(np.uint64)
    codes = np.concatenate([codes, np.zeros(3 * block, np.uint64)])
    blocks = (end - begin) // block - 1
    text = np.repeat(np.arange(len(begin)), blocks)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = begin[text] + nth * block
    # A gap in the numbers keeps texts apart.
    number = np.arange(len(text)) + text
    hits, gaps = [], []
    rows = max(1, CHUNK // (2 * block))
    for i in range(0, len(at), rows):
        d, j = np.nonzero(block_distances(codes, at[i: i + rows], block) == 0)
        j = j + i
        d = d + block
        inside = at[j] + d + block <= end[text[j]]
        hits.append(j[inside])
        gaps.append(d[inside])
    hits, gaps = np.concatenate(hits), np.concatenate(gaps)
    order, first, last = _chains(number[hits], gaps)
    hits, gaps = hits[order], gaps[order]
    open_ = ~_covered(found, at[hits[first]], at[hits[last]] + block + gaps[first], gaps[first])
    first, last = first[open_], last[open_]
    # The words themselves decide.
    size = last - first + 1
    member = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    hits, gaps = hits[member], gaps[member]
    same = _equal_stretch(words, at[hits], 1, gaps, block, begin[text[hits]], end[text[hits]]) == block
    hits, gaps = hits[same], gaps[same]
    order, first, last = _chains(number[hits], gaps)
    head, tail, gaps = hits[order][first], hits[order][last], gaps[order][first]
    low, high = begin[text[head]], end[text[head]]
    left = at[head] - _equal_stretch(words, at[head] - 1, -1, gaps, block, low, high)
    right = at[tail] + block
    right = right + _equal_stretch(words, right, 1, gaps, block, low, high)
    return np.stack([left, right + gaps, gaps], axis=1)


def find_runs(docs: DataFrame, min_length=6, min_exponent=4) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and collapsed of every row; other columns are left out.

    Words are parted by space and the characters tab to carriage return and are compared as they are. A run
    is a stretch of smallest period q, of at least min_length and min_exponent * q words, that no neighbouring
    word extends. runs is sorted by start, then period. collapsed is the text's words joined by one space
    without those that a run contains after its first q words.

    A null or empty text has no words, no runs and an empty collapsed text. Null ids and repeated rows come
    back as they are. Texts are handled whole: a worker holds one text and some numbers per word. No shuffle.
    """
    if min_exponent < 4:
        raise ValueError("the chains of blocks are certain from four periods on")
    ship_package(docs.sparkSession)

    def run(batches):
        for part in steps(batches):
            texts = [t.encode().split() if t else [] for t in part.column("text").to_pylist()]
            numbers = {}
            words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, sum(map(len, texts)))
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            del numbers
            found = runs_of(words, offsets, min_length, min_exponent)
            row = np.searchsorted(offsets, found[:, 0], side="right") - 1
            keep = np.ones(len(words), bool)
            for start, end, period in found.tolist():
                keep[start + period: end] = False
            kept = []
            touched = set(row.tolist())
            for i, t in enumerate(texts):
                kept.append(b" ".join([w for w, k in zip(t, keep[offsets[i]: offsets[i + 1]].tolist()) if k] if i in touched else t))
            runs = pa.StructArray.from_arrays(
                [pa.array(found[:, 0] - offsets[row]), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], ["start", "length", "period"]
            )
            cuts = np.searchsorted(row, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def planted(doc_id: Column, text: Column) -> Column:
    """The text, of which every tenth (by a hash of its id) repeats a stretch of its words up to the end."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        places = F.sequence(F.lit(0), n - 1)
        return F.array_join(F.transform(places, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")

    # An array of one keeps the words from being taken anew for every place.
    again = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(text))[0]
    return F.when(h % 10 == 0, again).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """One row per text: the number of runs, the longest one, and hashes of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    start, length, period = -longest["start"], longest["length"], -longest["period"]
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
