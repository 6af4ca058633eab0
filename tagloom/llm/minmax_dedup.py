"""Near-duplicates by min-max hashing: one evaluation of a permutation gives two signature values.

Every text becomes the set of its distinct shingles. Under each permutation both the smallest and the
largest value are kept, so half as many permutations are evaluated as the signature has values. Bands of
the signature deal the sets to buckets. Equal sets are one from the start, whatever the number of copies.

Links are confirmed on full sets, in two steps that never list the pairs of a bucket:

1. Every member of a bucket is compared with the bucket's smallest. What is confirmed is merged into parts.
2. Buckets whose other members still lie in several parts are searched on their own: signatures say which
   members may be similar across parts, and only those bring their sets. A bucket gives links of a forest, not
   pairs. Full buckets are dealt out over pairs of blocks, so that no task holds one whole.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import steps
from tagloom.llm.simhash import merged_stars
from tagloom.llm.words import Words, mix
from tagloom.staging import ship_package, stage

#: Signature values per band, and bands. All bands miss a pair of similarity 0.85 once in 3.7 million times, of 0.8 once in 16,000.
BAND_SIZE, BANDS = 6, 32
PERMUTATIONS = BAND_SIZE * BANDS // 2
#: Sets that one leader is compared with in one task.
LEADER_SHARE = 1000
#: Members of a block where signatures are compared, and bytes of sets in a block where sets are.
BLOCK_MEMBERS, BLOCK_BYTES = 2000, 8 << 20
#: Standard deviations by which an estimate may fall short before a pair is passed over.
SLACK = 6

_rng = np.random.default_rng(20240611)
_XOR = _rng.integers(0, 2**64, PERMUTATIONS, np.uint64)
_TIMES = _rng.integers(0, 2**63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = _rng.integers(0, 2**63, BAND_SIZE, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column, size=5):
    """Distinct shingle hashes of a column of texts: (hashes, row of each), sorted by row, then hash.

    A to Z are lower-cased. A row of fewer than `size` words has its whole sequence, one without words nothing.
    """
    words = Words(pc.ascii_lower(column))
    counts = np.diff(words.first)
    hashes, rows = [], []
    for n in range(1, size + 1):
        whole = words.whole(n)
        if n < size:
            whole &= (counts[words.rows] == n)[: len(whole)]
        hashes.append(words.windows(n, 0)[whole])
        rows.append(words.rows[: len(whole)][whole])
    hashes, rows = np.concatenate(hashes), np.concatenate(rows)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[fresh], rows[fresh]


def signatures(hashes, begins):
    """Min-max signatures of the sets that begin at `begins`: smallest values under all permutations, then largest."""
    out = np.zeros((len(begins), 2 * PERMUTATIONS), np.uint64)
    if len(begins):
        for i, (xor, times) in enumerate(zip(_XOR, _TIMES)):
            values = (hashes ^ xor) * times
            out[:, i] = np.minimum.reduceat(values, begins)
            out[:, PERMUTATIONS + i] = np.maximum.reduceat(values, begins)
    return out


def band_keys(values):
    """One 64-bit bucket number per set and band."""
    folded = (mix(values.reshape(len(values), BANDS, BAND_SIZE)) * _FOLD).sum(axis=2, dtype=np.uint64)
    return mix(folded + np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def short_signatures(values):
    """One byte per signature value."""
    return (mix(values) >> np.uint64(56)).astype(np.uint8)


def _least_agreement(percent):
    """Signature values that a pair of just that similarity has in common, less the slack."""
    n, p = 2 * PERMUTATIONS, percent / 100
    return int(n * p - SLACK * (n * p * (1 - p)) ** 0.5)


def _similar(common, a, b, percent):
    """Whether the similarity of sets of a and b elements with so many in common is `percent` or more."""
    return 100 * common >= percent * (a + b - common)


def signed_rows(docs: DataFrame, size=5) -> DataFrame:
    """doc_id, text_key, id_key, node (128 bits of the set, null if it is empty), n_shingles, bands and sig of every row."""
    ship_package(docs.sparkSession)

    def run(batches):
        for part in steps(batches):
            hashes, rows = shingle_sets(part.column("text"), size)
            full, begins = np.unique(rows, return_index=True)
            counts = np.diff(np.append(begins, len(rows)))
            values = signatures(hashes, begins)
            bands, sigs = band_keys(values), short_signatures(values)
            node, band, sig, n = ([None] * part.num_rows for _ in range(4))
            for i, row in enumerate(full.tolist()):
                node[row] = xxhash.xxh3_128_digest(hashes[begins[i]: begins[i] + counts[i]].tobytes())
                band[row], sig[row], n[row] = bands[i], sigs[i].tobytes(), int(counts[i])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("text_key"), part.column("id_key"), pa.array(node, pa.binary()),
                    pa.array([x or 0 for x in n], pa.int64()), pa.array(band, pa.list_(pa.int64())), pa.array(sig, pa.binary()),
                ],
                ["doc_id", "text_key", "id_key", "node", "n_shingles", "bands", "sig"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _keyed(docs).mapInArrow(
        run, f"doc_id {kind}, text_key long, id_key long, node binary, n_shingles long, bands array<long>, sig binary"
    )


def _keyed(docs):
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.xxhash64("doc_id").alias("id_key"))


def _sets(docs, wanted, size):
    """(node, n, shingles) of each wanted node, made anew from one of its texts."""
    chosen = wanted.select("node", F.col("text_from.id_key").alias("id_key"), F.col("text_from.text_key").alias("text_key"))
    # Rows that repeat id and text are one here.
    texts = (
        _keyed(docs).join(chosen, ["id_key", "text_key"]).groupBy("id_key", "text_key", "node").agg(F.any_value("text").alias("text"))
    )

    def run(batches):
        for part in steps(batches):
            hashes, rows = shingle_sets(part.column("text"), size)
            cuts = np.searchsorted(rows, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array(np.diff(cuts)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64)))],
                ["node", "n", "shingles"],
            )

    return texts.select("node", "text").mapInArrow(run, "node binary, n long, shingles array<long>")


def _confirmed(edges, sets, percent):
    """Those of the edges (leader, node) whose sets are similar enough. A leader's edges are dealt out by shares."""
    shares = stage(edges.groupBy("leader").agg(F.ceil(F.count("*") / LEADER_SHARE).cast("int").alias("shares")), "shares")
    # Few leaders have several shares, one in LEADER_SHARE edges at most: only they are looked up.
    share = F.pmod(F.xxhash64("node"), F.coalesce("shares", F.lit(1))).cast("int")
    dealt = edges.join(stage(shares.where("shares > 1"), "several"), "leader", "left").select("leader", "node", share.alias("share"))
    dealt = dealt.join(sets, "node").select("leader", "share", "node", F.col("n").alias("m"), F.col("shingles").alias("others"))
    leaders = shares.join(sets.withColumnRenamed("node", "leader"), "leader").select(
        "leader", "n", "shingles", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    )
    both = dealt.join(leaders, ["leader", "share"]).where(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    common = F.size(F.array_intersect("shingles", "others"))
    return both.where(_similar(common, F.col("n"), F.col("m"), percent)).select("node", "leader")


def _dealt(members, blocks):
    """Deal the members of buckets with several blocks out over pairs of blocks."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda t: F.least(t, block) * F.col("blocks") + F.greatest(t, block)
    )
    return members.join(blocks, "bucket").withColumn("pair", F.explode(pairs)).drop("blocks")


def _candidates(sig, part, n, percent):
    """Positions (x, y, agreement) of pairs of different parts whose signatures and sizes allow the similarity, in batches."""
    least = _least_agreement(percent)
    rows = max(1, (16 << 20) // max(1, sig.size))
    for i in range(0, len(sig), rows):
        here = slice(i, i + rows)
        open_ = (part[here, None] != part[None, :]) & (np.arange(len(sig))[here, None] < np.arange(len(sig))[None, :])
        open_ &= 100 * np.minimum(n[here, None], n[None, :]) >= percent * np.maximum(n[here, None], n[None, :])
        x, y = np.nonzero(open_)
        for k in range(0, len(x), 1 << 16):
            a, b = x[k: k + (1 << 16)] + i, y[k: k + (1 << 16)]
            agree = np.count_nonzero(sig[a] == sig[b], axis=1)
            good = agree >= least
            yield a[good], b[good], agree[good]


def _arrays(table):
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(table.num_rows, -1)
    parts = table.column("part").combine_chunks().dictionary_encode().indices.to_numpy()
    return sig, parts, table.column("n").to_numpy()


def _promising(percent):
    """The members of a bucket that may be similar to one of another part."""
    def run(table):
        sig, part, n = _arrays(table)
        some = np.zeros(len(sig), bool)
        for a, b, _ in _candidates(sig, part, n, percent):
            some[a] = some[b] = True
        return table.filter(pa.array(some)).select(["bucket", "node"])

    return run


def _linked(percent):
    """Confirmed links between the parts of a bucket, the most promising first; none within a part."""
    def run(table):
        sig, part, n = _arrays(table)
        offsets = np.concatenate([[0], np.cumsum(n)])
        flat = np.concatenate([c.flatten().to_numpy() for c in table.column("shingles").chunks] or [np.zeros(0, np.int64)])
        found = []
        for a, b, agree in _candidates(sig, part, n, percent):
            for k in np.argsort(-agree, kind="stable").tolist():
                x, y = int(a[k]), int(b[k])
                if part[x] != part[y]:
                    common = len(np.intersect1d(flat[offsets[x]: offsets[x + 1]], flat[offsets[y]: offsets[y + 1]], assume_unique=True))
                    if _similar(common, int(n[x]), int(n[y]), percent):
                        found.append((x, y))
                        part = np.where(part == part[y], part[x], part)
        nodes = table.column("node")
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"node": nodes.take(pa.array(ends[:, 0])), "leader": nodes.take(pa.array(ends[:, 1]))}).cast(
            pa.schema([("node", pa.binary()), ("leader", pa.binary())])
        )

    return run


def links(docs: DataFrame, nodes: DataFrame, percent=85, size=5, block_members=BLOCK_MEMBERS, block_bytes=BLOCK_BYTES) -> DataFrame:
    """(child, parent) with one parent per child: the parts that all links between the sets `nodes` connect.

    nodes: node, n, bands, sig and text_from (id_key and text_key of a text in docs) of each distinct set.
    """
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = stage(buckets.join(shared, "bucket").where("node <> leader"), "met")
    edges = stage(met.select("leader", "node").distinct(), "edges")
    wanted = edges.select("leader").union(edges.select("node")).distinct().withColumnRenamed("leader", "node")
    sets = stage(_sets(docs, nodes.select("node", "text_from").join(wanted, "node"), size), "sets")
    stars = stage(_confirmed(edges, sets, percent).toDF("child", "parent"), "confirmed")
    first = merged_stars(stars)

    parts = first.select(F.col("child").alias("node"), F.col("parent").alias("part"))
    members = met.join(parts, "node", "left").select("bucket", "node", F.coalesce("part", "node").alias("part"))
    # The leader has met everyone: only the others may still have links to find.
    open_ = members.groupBy("bucket").agg(F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("m")).where("a <> b")
    open_ = stage(open_.select("bucket", F.ceil(F.col("m") / block_members).cast("int").alias("blocks")), "open")
    signed = _dealt(members, open_).join(nodes.select("node", F.col("n_shingles").alias("n"), "sig"), "node")
    promising = stage(
        signed.groupBy("bucket", "pair").applyInArrow(_promising(percent), "bucket long, node binary").distinct(), "promising"
    )
    blocks = promising.join(nodes.select("node", "n_shingles"), "node").groupBy("bucket").agg(
        F.ceil(F.sum("n_shingles") * 8 / block_bytes).cast("int").alias("blocks")
    )
    with_sets = (
        _dealt(promising, blocks).join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
        .join(nodes.select("node", "sig"), "node").join(sets, "node")
    )
    more = with_sets.groupBy("bucket", "pair").applyInArrow(_linked(percent), "node binary, leader binary").toDF("child", "parent")
    more = stage(more, "more")
    return first if more.isEmpty() else merged_stars(first.unionByName(more))


def near_duplicates(docs: DataFrame, percent=80, size=5, **blocks) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts are linked if their sets of `size`-word shingles (A to Z lower-cased; of a shorter text the whole
    sequence) have a Jaccard similarity of percent / 100 or more, from 80 on; the check is on full sets, exact
    but for equal 64-bit hashes of different shingles. component_id is the smallest doc_id that links
    reach, kept says whether it is the row's own.

    A null text or one without words has an empty set and is linked with nothing: its component_id is its own
    id. Null ids take part; a component has a null id only if it has no other, and its rows are kept. Rows
    that repeat are copies like any others and, under the smallest id, all kept. Texts are handled whole.
    """
    if percent < 80:
        raise ValueError("the bands are certain from a similarity of 0.8 on")
    rows = stage(signed_rows(docs, size), "signed")
    nodes = stage(
        rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("least"), F.min(F.struct("id_key", "text_key")).alias("text_from"),
            F.any_value("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"),
        ),
        "nodes",
    )
    stars = links(docs, nodes, percent, size, **blocks)
    member = nodes.select("node", "least").join(stars.withColumnRenamed("child", "node"), "node", "left").select(
        "node", "least", F.coalesce("parent", "node").alias("root")
    )
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    found = member.join(least, "root").select("node", "component_id")
    own = rows.select("doc_id", "node", "n_shingles").join(found, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return own.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
