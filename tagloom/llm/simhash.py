"""Near-duplicates by SimHash, linked through vantage-point shards.

Fingerprints are dealt to shards by a vantage-point tree whose level i measures the Hamming distance to
a fixed vantage within the i-th four bits. Distances on separate bits add up, so by the triangle
inequality two fingerprints at most `radius` bits apart have shard addresses whose level distances
differ by at most `radius` in sum. A fingerprint therefore queries its own shard and those around it
whose boundary its ball overlaps (one of each two directions is enough). The tree is as deep as keeps
shards small, whatever the number of fingerprints. A shard that is still too full (many fingerprints
close together) is dealt out over pairs of blocks, so that no task holds it whole.

Inside a shard a vantage-point split on the whole distance prunes before pairs are compared. A shard
gives a star for each of its connected parts, not its pairs; the stars are merged over all shards by
alternating large and small stars, each round written to the shared folder.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagloom.llm.common import own_names, steps
from tagloom.staging import ship_package, stage

#: Fingerprints that a shard should get at most, visitors included.
SHARD_ROWS = 20_000
#: Levels of the sharding tree, four bits each: at least and at most.
FIRST_LEVELS, LEVELS = 4, 16
#: Pairs that are compared at once.
BLOCK_PAIRS = 1 << 21

_VANTAGE = 0x9E3779B97F4A7C15
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text, size=3, seed=42):
    """XXH64 of every shingle of lower-cased words; of the whole sequence if it is shorter."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: -size].tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())]


def majority_bits(hashes, sizes):
    """Per group of hashes, the 64-bit number of the bits that over half of them have."""
    sizes = np.asarray(sizes, np.int64)
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    # Sums of 255 bits fit a byte: eight bits are counted at once.
    blocks = -(-n // 255)
    first = np.repeat(np.cumsum(n) - n, blocks)
    nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    cuts, groups = first + nth * 255, np.cumsum(blocks) - blocks
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, cuts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), groups, axis=0)
        for byte in range(8):
            out[full] |= (2 * counts[:, byte] > n).astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def fingerprints(docs: DataFrame, size=3) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fp (the fingerprint as a signed 64-bit number) of every row."""
    ship_package(docs.sparkSession)

    def run(batches):
        for part in steps(batches):
            hashes = [shingle_hashes(t, size) for t in part.column("text").to_pylist()]
            flat = np.fromiter((h for own in hashes for h in own), np.uint64, sum(map(len, hashes)))
            bits = majority_bits(flat, [len(own) for own in hashes])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(bits.view(np.int64))], ["doc_id", "text_key", "fp"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        run, f"doc_id {kind}, text_key long, fp long"
    )


def shard_levels(n, radius, shard_rows=SHARD_ROWS):
    """Levels at which an average shard has at most `shard_rows` of n random fingerprints and their visits."""
    for k in range(FIRST_LEVELS, LEVELS):
        # Four random bits split like 4.1 even parts.
        if n * len(_directions(k, radius)) / 4.1**k <= shard_rows:
            return k
    return LEVELS


def _directions(levels, radius):
    """Differences of shard addresses within `radius`, one of each two opposite ones, zero first."""
    found = {(0,) * levels}
    for _ in range(radius):
        found |= {
            (*d[:i], d[i] + s, *d[i + 1:]) for d in found for i in range(levels) for s in (-1, 1)
        }
    return sorted(d for d in found if d >= (0,) * levels)


def _address(levels):
    """Shard address of column fp: digits to base 5, one per level."""
    distances = (
        F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(_VANTAGE))).bitwiseAND(F.lit(_signed(0xF << 4 * i)))).cast("long")
        * F.lit(5**i)
        for i in range(levels)
    )
    return reduce(lambda a, b: a + b, distances)


def _signed(x):
    return x - 2**64 if x >= 2**63 else x


def _visits(levels, radius):
    """Rows (shard, home, fp) of each fingerprint's own shard and those it queries."""
    directions = np.array(_directions(levels, radius), np.int64)
    weights = 5 ** np.arange(levels, dtype=np.int64)

    def run(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            bits = fps.view(np.uint64) ^ np.uint64(_VANTAGE)
            own = np.stack(
                [np.bitwise_count(bits & np.uint64(0xF << 4 * i)).astype(np.int64) for i in range(levels)], axis=1
            ) if len(fps) else np.zeros((0, levels), np.int64)
            for d in directions:
                to = own + d
                inside = ((to >= 0) & (to <= 4)).all(axis=1)
                if inside.any():
                    home = np.full(int(inside.sum()), not d.any())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(to[inside] @ weights), pa.array(home), pa.array(fps[inside])], ["shard", "home", "fp"]
                    )

    return run


def _pairs(a, b, radius):
    """Positions (in a, in b) of all pairs within radius, in batches."""
    width = max(1, BLOCK_PAIRS // max(1, len(b)))
    for i in range(0, len(a), width):
        near = np.bitwise_count(a[i: i + width, None] ^ b[None, :]) <= radius
        x, y = np.nonzero(near)
        yield x + i, y


def _search(fps, a, b, radius, merge):
    """Find all pairs of a position of a and one of b within radius, by vantage-point splits."""
    if not len(a) or not len(b):
        return
    if len(a) * len(b) <= BLOCK_PAIRS:
        for x, y in _pairs(fps[a], fps[b], radius):
            merge(a[x], b[y])
        return
    vantage = fps[a[len(a) // 2]]
    da, db = np.bitwise_count(fps[a] ^ vantage), np.bitwise_count(fps[b] ^ vantage)
    order = np.argsort(db, kind="stable")
    b, db = b[order], db[order]
    shells = np.unique(da)
    if len(shells) == 1:
        for x, y in _pairs(fps[a], fps[b], radius):
            merge(a[x], b[y])
        return
    for d in shells.astype(int):
        # Triangle bounds: partners lie within radius of the shell.
        lo, hi = np.searchsorted(db, [d - radius, d + radius + 1])
        _search(fps, a[da == d], b[lo:hi], radius, merge)


class _Parts:
    """Connected parts of positions; a part's label is its smallest position."""

    def __init__(self, n):
        self.label = np.arange(n)

    def merge(self, a, b):
        label = self.label
        while True:
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label[:] = label[label]


def _stars(radius):
    """Stars (child, parent) of the connected parts of a shard."""
    def run(table):
        home = table.column("home").to_numpy(zero_copy_only=False).astype(bool)
        fps = table.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(fps.view(np.int64), kind="stable")
        home, fps = home[order], fps[order]
        parts = _Parts(len(fps))
        own = np.flatnonzero(home)
        _search(fps, own, np.arange(len(fps)), radius, parts.merge)
        child = np.flatnonzero(parts.label != np.arange(len(fps)))
        out = fps.view(np.int64)
        return pa.table({"child": out[child], "parent": out[parts.label[child]]})

    return run


def linked_stars(distinct: DataFrame, radius=2, shard_rows=SHARD_ROWS) -> DataFrame:
    """Stars (child > parent, by signed value) that connect distinct fingerprints as all links within radius do."""
    levels = shard_levels(distinct.count(), radius, shard_rows)
    visits = distinct.select("fp").mapInArrow(_visits(levels, radius), "shard long, home boolean, fp long")
    # How full each shard will be, from the homes alone.
    around = [int(sum(x * 5**i for i, x in enumerate(d))) for d in _directions(levels, radius)]
    homes = distinct.groupBy(_address(levels).alias("shard")).agg(F.count("*").alias("n"))
    digits = F.array(*[F.floor(F.col("shard") / F.lit(5**i)) % 5 for i in range(levels)])
    moves = F.array(*[F.array(*[F.lit(x) for x in d]) for d in _directions(levels, radius)])
    inside = F.forall(F.arrays_zip(digits.alias("a"), F.col("move").alias("b")), lambda z: (z["a"] + z["b"]).between(0, 4))
    full = (
        homes.select("*", F.posexplode(moves).alias("i", "move")).where(inside)
        .select((F.col("shard") + F.element_at(F.array(*map(F.lit, around)), F.col("i") + 1)).alias("shard"), "n")
        .groupBy("shard").agg(F.sum("n").alias("n"))
        .where(F.col("n") > 4 * shard_rows)
        .select("shard", F.ceil(F.col("n") / (2 * shard_rows)).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda t: F.least(t, block) * F.col("blocks") + F.greatest(t, block),
    )
    spread = visits.join(full, "shard", "left").select(
        "shard", "home", "fp", F.explode(F.coalesce(pair, F.array(F.lit(0)))).alias("pair")
    )
    return spread.groupBy("shard", "pair").applyInArrow(_stars(radius), "child long, parent long")


def merged_stars(stars: DataFrame) -> DataFrame:
    """(child, parent) with one parent per child, the smallest of its connected component."""
    stars = stage(stars.where("child <> parent").distinct(), "stars")
    while True:
        both = stars.select(F.col("child").alias("u"), F.col("parent").alias("v")).union(
            stars.select(F.col("parent").alias("u"), F.col("child").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        large = stage(large.where("x <> y").distinct(), "large")
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").select(
            F.explode(F.array(F.struct("x", "m"), F.struct(F.col("y").alias("x"), "m"))).alias("s")
        ).select(F.col("s.x").alias("child"), F.col("s.m").alias("parent"))
        stars = stage(small.where("child <> parent").distinct(), "stars")
        several = stars.groupBy("child").count().where("count > 1").select("child").limit(1)
        middle = stars.join(stars.select(F.col("child").alias("parent")), "parent", "left_semi").select("child").limit(1)
        if several.union(middle).isEmpty():
            return stars


def near_duplicates(docs: DataFrame, size=3, radius=2) -> DataFrame:
    """One row per input row: doc_id, text_key, fingerprint, root, component_id.

    component_id is the smallest doc_id that links of at most `radius` differing bits reach; root is
    the component's smallest fingerprint. Null and empty texts have fingerprint zero and link like any
    other. Null ids take part, but are never a component_id unless a component has no other.
    """
    rows = stage(fingerprints(docs, size), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    stars = merged_stars(linked_stars(distinct, radius))
    member = distinct.join(stars.withColumnRenamed("child", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("parent", "fp").alias("root")
    )
    groups = member.groupBy("root").agg(F.min("least").alias("component_id"))
    found = member.select("fp", "root").join(groups, "root")
    return rows.join(found, "fp").select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "root", "component_id"
    )


@own_names
def keep_one(docs: DataFrame, size=3, radius=2) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the smallest id stays.

    Columns are kept. If several rows of a component share that id, one of them stays; a component
    without any id keeps one row.
    """
    labelled = near_duplicates(docs, size, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = labelled.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("s")).select(
        F.col("s.doc_id").alias("_doc"), F.col("s.text_key").alias("_key")
    )
    # Repeats of a chosen row are told apart by a number that only has to differ.
    numbered = docs.withColumn("_text", F.xxhash64("text")).withColumn("_nth", F.monotonically_increasing_id())
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_key"))
    kept = numbered.join(chosen, same, "left_semi")
    one = F.row_number().over(W.partitionBy("doc_id", "_text").orderBy("_nth"))
    return kept.withColumn("_one", one).where("_one = 1").select(*docs.columns)
