"""Repeated passages across documents, found by difference-cover anchors.

A window of WINDOW words that two documents share is found through an anchor of ANCHOR words: anchors
are hashed only where a word's place modulo PERIOD lies in COVER. As every difference modulo PERIOD
is a difference of two members of COVER, any two places of a window have a place inside the window
where both documents hash an anchor. Three steps follow:

1. Anchors of every text are dealt out by hash. Within a step of text an anchor goes out once,
   however many documents hold it, so a passage that a third of the corpus has costs one entry a step.
   What is known to repeat inside a step needs no answer; other entries are answered if they repeat.
2. Around repeated anchors, the windows that contain one are hashed whole (128-bit arithmetic, of
   which 72 bits and the bucket number travel) and dealt out. Within a step only the smallest document
   of a window goes out; larger ones are already decided.
3. Places of windows that start in a smaller document come back to their text, and their words go.

Hashes travel packed, many to a row, addressed by the row's key (a hash of id and text).
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import bucket_count, steps
from tagloom.llm.words import Words, mix
from tagloom.staging import ship_package

PERIOD = 7
#: A perfect difference set modulo PERIOD.
COVER = (0, 1, 3)

_LOW = np.uint64((1 << 40) - 1)
_ANCHORS = "bucket int, kind int, keys binary, owners binary, sizes binary"
_WINDOWS = "bucket int, kind int, keys binary, owners binary, docs binary, sizes binary, places binary"
#: Kinds of rows: asked with an owner, known to repeat, decided and only passing through.
ASKED, KNOWN, DECIDED = 0, 1, 2


def _runs(values):
    """Starts of runs of equal values, with the length at the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)]


def _low_bytes(values, n):
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :n]


def _from_low_bytes(data, n):
    rows = np.frombuffer(data, np.uint8).reshape(-1, n)
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, :n] = rows
    return wide.view(np.uint64).ravel()


def _joined(column, dtype):
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _table(rows, kinds):
    names = [k.split()[0] for k in kinds.split(", ")]
    types = {"int": pa.int32(), "binary": pa.binary()}
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.Table.from_arrays([pa.array(c, types[k.split()[1]]) for c, k in zip(columns, kinds.split(", "))], names=names)


class _Anchors:
    """Anchors of a step of texts: word number, row and tag (bucket and 40 bits of hash)."""

    def __init__(self, words, anchor, buckets):
        at = np.zeros(0, np.int64)
        hashes = words.windows(anchor, 0)
        if len(hashes):
            chosen = words.whole(anchor) & np.isin(words.place[: len(hashes)] % PERIOD, COVER)
            at = np.flatnonzero(chosen)
        hashes = hashes[at]
        self.at = at
        self.rows = words.rows[at]
        self.tags = ((hashes >> np.uint64(40)) % np.uint64(buckets) << np.uint64(40)) | (hashes & _LOW)


def _ask_anchors(part, window, buckets):
    """Packed rows of one step of texts."""
    found = _Anchors(Words(part.column("text")), window - PERIOD + 1, buckets)
    keys = part.column("key").to_numpy(zero_copy_only=False)
    order = np.argsort(found.tags, kind="stable")
    tags, rows = found.tags[order], found.rows[order]
    cuts = _runs(tags)
    first, last = cuts[:-1], cuts[1:] - 1
    repeated = rows[first] != rows[last] if len(tags) else np.zeros(0, bool)
    lone = first[~repeated]
    yield from _packed_anchors(ASKED, tags[lone], rows[lone], keys)
    yield from _packed_anchors(KNOWN, tags[first[repeated]], None, keys)
    inside = np.repeat(repeated, np.diff(cuts))
    tags, owners = tags[inside], keys[rows[inside]]
    yield from _decided_anchors(tags, owners, buckets)


def _packed_anchors(kind, tags, rows, keys):
    buckets = (tags >> np.uint64(40)).astype(np.int64)
    order = np.argsort(buckets, kind="stable") if rows is None else np.lexsort((rows, buckets))
    tags, buckets = tags[order], buckets[order]
    cuts = _runs(buckets)
    low = _low_bytes(tags, 5)
    for a, b in zip(cuts[:-1], cuts[1:]):
        owners = sizes = b""
        if rows is not None:
            own = rows[order[a:b]]
            ends = _runs(own)
            owners, sizes = keys[own[ends[:-1]]].tobytes(), np.diff(ends).astype(np.uint32).tobytes()
        yield int(buckets[a]), kind, low[a:b].tobytes(), owners, sizes


def _decided_anchors(tags, owners, buckets):
    """Anchors known to repeat, on the way to the text with the owner's key."""
    to = owners % buckets
    order = np.lexsort((owners, to))
    tags, owners, to = tags[order], owners[order], to[order]
    cuts = _runs(to)
    for a, b in zip(cuts[:-1], cuts[1:]):
        ends = _runs(owners[a:b])
        yield int(to[a]), DECIDED, tags[a:b].tobytes(), owners[a:b][ends[:-1]].tobytes(), np.diff(ends).astype(np.uint32).tobytes()


def _answer_anchors(buckets):
    def run(key, table):
        kind = table.column("kind").to_numpy()
        asked, known, decided = (table.filter(pa.array(kind == k)) for k in (ASKED, KNOWN, DECIDED))
        tags = _from_low_bytes(b"".join(asked.column("keys").to_pylist()), 5)
        sure = _from_low_bytes(b"".join(known.column("keys").to_pylist()), 5)
        owners = np.repeat(_joined(asked.column("owners"), np.int64), _joined(asked.column("sizes"), np.uint32))
        every = np.sort(np.r_[tags, sure])
        repeated = np.unique(every[1:][every[1:] == every[:-1]])
        hit = _member(tags, repeated)
        bucket = np.uint64(key[0].as_py())
        rows = list(_decided_anchors((bucket << np.uint64(40)) | tags[hit], owners[hit], buckets))
        return pa.concat_tables([_table(rows, _ANCHORS), decided.cast(_table([], _ANCHORS).schema)])

    return run


def _member(values, ordered):
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _paired(owners, tags):
    return mix(owners.astype(np.int64).view(np.uint64)) ^ tags


def _ask_windows(window, buckets):
    def run(left, right):
        owners = np.repeat(_joined(right.column("owners"), np.int64), _joined(right.column("sizes"), np.uint32))
        hits = np.unique(_paired(owners, _joined(right.column("keys"), np.uint64)))
        rows = []
        if len(hits):
            for part in steps(left.to_batches()):
                rows += _step_windows(part, hits, window, buckets)
        return _table(rows, _WINDOWS)

    return run


def _step_windows(part, hits, window, buckets):
    # Rows without an id ask for nothing; with them the ids would also turn into floating point.
    part = part.filter(part.column("doc_id").is_valid())
    words = Words(part.column("text"))
    anchors = _Anchors(words, window - PERIOD + 1, buckets)
    keys = part.column("key").to_numpy(zero_copy_only=False)
    found = anchors.at[_member(_paired(keys[anchors.rows], anchors.tags), hits)]
    n = len(words) - window + 1
    if not len(found) or n < 1:
        return []
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.maximum(found - PERIOD + 1, 0), 1)
    np.add.at(edges, found + 1, -1)
    at = np.flatnonzero((np.cumsum(edges)[:n] > 0) & words.whole(window))
    high, low = (words.windows(window, w)[at] for w in (0, 1))
    docs = part.column("doc_id").to_numpy(zero_copy_only=False)[words.rows[at]].astype(np.int64)
    # Per distinct window the smallest document asks; larger ones of this step are decided.
    order = np.lexsort((docs, low, high))
    cuts = _runs_of_two(high[order], low[order])
    least = np.empty(len(at), np.int64)
    least[order] = np.repeat(docs[order][cuts[:-1]], np.diff(cuts))
    later = docs > least
    spots = np.rec.fromarrays([keys[words.rows[at]], docs, words.place[at]], names="key,doc,place")
    rows = list(_packed_windows(ASKED, (low[~later] >> np.uint64(8)) % np.uint64(buckets), spots[~later], (high[~later], low[~later])))
    return rows + list(_packed_windows(DECIDED, spots.key[later] % buckets, spots[later], None))


def _runs_of_two(a, b):
    if not len(a):
        return np.zeros(1, np.int64)
    return np.r_[0, np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1, len(a)]


def _packed_windows(kind, to, spots, hashes):
    """Rows of a bucket each: hashes, owners in runs, and places as differences within a run."""
    to = to.astype(np.int64)
    order = np.lexsort((spots.place, spots.doc, spots.key, to))
    to, spots = to[order], spots[order]
    if hashes is not None:
        packed = np.hstack([_low_bytes(hashes[0][order], 8), _low_bytes(hashes[1][order], 1)])
    cuts = _runs(to)
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = spots[a:b]
        ends = _runs_of_two(own.key, own.doc)
        places = np.diff(own.place, prepend=0)
        places[ends[:-1]] = own.place[ends[:-1]]
        # One byte each, with an escape of 255 for every full 255.
        wide = places // 255
        data = np.full(len(places) + int(wide.sum()), 255, np.uint8)
        data[np.cumsum(wide + 1) - 1] = places % 255
        yield (
            int(to[a]), kind, packed[a:b].tobytes() if hashes is not None else b"",
            own.key[ends[:-1]].tobytes(), own.doc[ends[:-1]].tobytes(), np.diff(ends).astype(np.uint32).tobytes(), data.tobytes(),
        )


def _spots(table):
    """The places of packed rows, one by one."""
    sizes = _joined(table.column("sizes"), np.uint32).astype(np.int64)
    data = _joined(table.column("places"), np.uint8)
    ends = np.flatnonzero(data != 255)
    sums = np.cumsum(data, dtype=np.int64)[ends]
    steps_ = np.diff(sums, prepend=0)
    first = np.cumsum(sizes) - sizes
    total = np.cumsum(steps_)
    before = np.repeat(total[first] - steps_[first], sizes) if len(sizes) else total
    return np.rec.fromarrays(
        [np.repeat(_joined(table.column(c), np.int64), sizes) for c in ("owners", "docs")] + [total - before],
        names="key,doc,place",
    )


def _answer_windows(buckets):
    def run(table):
        kind = table.column("kind").to_numpy()
        asked, decided = (table.filter(pa.array(kind == k)) for k in (ASKED, DECIDED))
        spots = _spots(asked)
        packed = _joined(asked.column("keys"), np.uint8).reshape(-1, 9)
        high, low = np.ascontiguousarray(packed[:, :8]).view(np.uint64).ravel(), packed[:, 8]
        order = np.lexsort((spots.doc, low, high))
        cuts = _runs_of_two(high[order], low[order])
        least = np.repeat(spots.doc[order][cuts[:-1]], np.diff(cuts))
        spots = spots[order][spots.doc[order] > least]
        rows = list(_packed_windows(DECIDED, spots.key % buckets, spots, None))
        return pa.concat_tables([_table(rows, _WINDOWS), decided.cast(_table([], _WINDOWS).schema)])

    return run


def _clean(window):
    names = ["doc_id", "n_words", "n_removed", "kept"]

    def run(left, right):
        covered = {}
        spots = _spots(right)
        spots = spots[np.lexsort((spots.doc, spots.key))]
        cuts = _runs_of_two(spots.key, spots.doc)
        for a, b in zip(cuts[:-1], cuts[1:]):
            covered[int(spots.key[a]), int(spots.doc[a])] = spots.place[a:b]
        out = [[] for _ in names]
        for doc, key, text in zip(*(left.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
            words = text.encode().split() if text else []
            n = len(words)
            starts = covered.get((key, doc))
            if starts is not None:
                edges = np.zeros(n + 1, np.int64)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + window, -1)
                kept = np.flatnonzero(np.cumsum(edges)[:n] == 0)
                words = [words[i] for i in kept]
            for values, value in zip(out, (doc, n, n - len(words), b" ".join(words).decode())):
                values.append(value)
        kinds = [left.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.string()]
        return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)

    return run


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """Remove every word that a window covers which also starts in a document with a smaller id.

    Windows are `window` consecutive words (PERIOD at least), judged on the input. Per row: doc_id,
    n_words, n_removed and kept (the kept words joined by one space). A null text has no words. A row
    with a null id loses nothing and makes no other row lose anything. Rows that share an id are judged
    one by one, and neither removes from the other. Other columns are left out.
    """
    if window < PERIOD:
        raise ValueError(f"a window takes {PERIOD} words or more, not {window}")
    ship_package(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    buckets = bucket_count(rows)

    def ask(batches):
        for part in steps(batches):
            yield from _table(list(_ask_anchors(part, window, buckets)), _ANCHORS).to_batches()

    known = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("key", "text")
    anchors = known.mapInArrow(ask, _ANCHORS).groupBy("bucket").applyInArrow(_answer_anchors(buckets), _ANCHORS)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Both meetings with the texts deal them out alike, so Spark does it once.
    texts = rows.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))
    asked = texts.groupBy("bucket").cogroup(anchors.groupBy("bucket")).applyInArrow(_ask_windows(window, buckets), _WINDOWS)
    places = asked.groupBy("bucket").applyInArrow(_answer_windows(buckets), _WINDOWS)
    return texts.groupBy("bucket").cogroup(places.groupBy("bucket")).applyInArrow(
        _clean(window), f"doc_id {kind}, n_words long, n_removed long, kept string"
    )
