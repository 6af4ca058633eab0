"""Nearest vectors by cosine, found through vantage-point trees.

Unit vectors are compared by chord length, which falls as the cosine rises. A small tree fitted on a bounded sample
routes every vector to a leaf; a leaf's vectors form shards, each with a tree of its own. A query first visits the
shards of its own leaf, which bounds its k-th best distance, then those leaves that the routing tree's triangle
bounds leave open. A branch, in either tree, is left out if its bound times `relax` exceeds the k-th best distance:
1 is exact, more prunes earlier. The few best of each shard are scored again on the original vectors and merged. Of
equal vectors only those whose ids are small enough to be found are kept, within each batch as vectors are routed
and within each shard.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tagloom.staging import ship_package, stage

SHARD_VECTORS = 8192
QUERY_BLOCK = 4096
LEAF = 96
#: Vectors that the routing tree is fitted on at most; each of its leaves holds at least LEAF_SAMPLE of them.
ROUTE_SAMPLE = 4096
LEAF_SAMPLE = 8
#: Rounding of a distance: what lies within it counts as a tie until it is scored exactly.
SLACK = 1e-7


def chord(a, b):
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def unit(rows):
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


class Route:
    """A vantage-point tree that deals unit vectors to numbered leaves."""

    def __init__(self, sample, leaves):
        self.leaves = 0
        self.root = self._split(sample, min(leaves, len(sample) // LEAF_SAMPLE))

    def _split(self, members, leaves):
        if leaves > 1:
            far = members[int(np.argmax(chord(members, members[:1])[:, 0]))]
            away = chord(members, far[None, :])[:, 0]
            middle = np.quantile(away, (leaves // 2) / leaves)
            near = away < middle
            if near.any() and not near.all():
                first = self._split(members[near], leaves // 2)
                return far, middle, first, self._split(members[~near], leaves - leaves // 2)
        self.leaves += 1
        return self.leaves - 1

    def home(self, rows):
        """The leaf of each vector."""
        found = np.zeros(len(rows), np.int32)

        def walk(node, at):
            if not len(at):
                return
            if isinstance(node, int):
                found[at] = node
                return
            vantage, middle, near, far = node
            inside = chord(rows[at], vantage[None, :])[:, 0] < middle
            walk(near, at[inside])
            walk(far, at[~inside])

        walk(self.root, np.arange(len(rows)))
        return found

    def reach(self, rows, limits, relax):
        """(row, leaf) of the leaves that may hold a vector within a row's limit."""
        found = []

        def walk(node, at):
            if not len(at):
                return
            if isinstance(node, int):
                found.append((at, np.full(len(at), node, np.int32)))
                return
            vantage, middle, near, far = node
            away = chord(rows[at], vantage[None, :])[:, 0]
            walk(near, at[(away - middle) * relax <= limits[at] + SLACK])
            walk(far, at[(middle - away) * relax <= limits[at] + SLACK])

        walk(self.root, np.arange(len(rows)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return tuple(np.concatenate(x) for x in zip(*found))


class Tree:
    """A vantage-point tree over unit vectors."""

    def __init__(self, units, leaf=LEAF):
        self.units = units
        self.leaf = leaf
        self.root = self._grow(np.arange(len(units)))

    def _grow(self, members):
        if len(members) <= self.leaf:
            return members
        away = chord(self.units[members], self.units[members[:1]])[:, 0]
        far = members[int(np.argmax(away))]
        away = chord(self.units[members], self.units[[far]])[:, 0]
        middle = np.median(away)
        near = away < middle
        if not near.any() or near.all():
            return members  # equal but for rounding
        inner, outer = members[near], members[~near]
        return (
            far, (away[near].min(), away[near].max()), (away[~near].min(), away[~near].max()),
            self._grow(inner), self._grow(outer),
        )

    def search(self, queries, ids, own, limits, k, relax):
        """(query, member) positions that may be among the k nearest.

        ids: of the members; own: of the queries, which do not find members of their own id. limits: distances
        that a query's k-th best does not exceed.
        """
        self.queries, self.ids, self.own, self.k, self.relax = queries, ids, own, k, relax
        self.best = np.repeat(limits[:, None], k, axis=1)
        self.found = []
        self._walk(self.root, np.arange(len(queries)))
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, m, d = (np.concatenate(x) for x in zip(*self.found))
        near = d <= self.best[q, -1] + SLACK
        return q[near], m[near]

    def _walk(self, node, qs):
        if not len(qs):
            return
        if isinstance(node, np.ndarray):
            away = chord(self.queries[qs], self.units[node])
            away[self.own[qs][:, None] == self.ids[node][None, :]] = np.inf
            pool = np.concatenate([self.best[qs], away], axis=1)
            self.best[qs] = np.sort(np.partition(pool, self.k - 1, axis=1)[:, : self.k], axis=1)
            x, y = np.nonzero(away <= np.minimum(self.best[qs, -1], 9.0)[:, None] + SLACK)
            self.found.append((qs[x], node[y], away[x, y]))
            return
        vantage, inner, outer, near, far = node
        d = chord(self.queries[qs], self.units[[vantage]])[:, 0]
        bounds = [np.maximum(0.0, np.maximum(lo - d, d - hi)) for lo, hi in (inner, outer)]
        first = bounds[0] <= bounds[1]
        for side, chosen in ((near, first), (far, ~first)):
            self._walk(side, qs[chosen])
        for side, chosen, bound in ((far, first, bounds[1]), (near, ~first, bounds[0])):
            open_ = bound * self.relax <= self.best[qs, -1] + SLACK
            self._walk(side, qs[chosen & open_])


def _matrix(table, name):
    column = table.column(name).combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(table.num_rows, -1)


def first_of_equal(raw, most, ids=None, rows_of_id=1):
    """Positions, in order, of the rows of the first `most` ids of each distinct vector, `rows_of_id` of each id."""
    packed = np.ascontiguousarray(raw).view(np.dtype((np.void, raw.shape[1] * raw.itemsize))).ravel()
    _, kind = np.unique(packed, return_inverse=True)
    ids = np.arange(len(kind)) if ids is None else ids
    order = np.lexsort((ids, kind))
    kind, ids = kind[order], ids[order]
    place = np.arange(len(kind))
    new_kind = np.r_[True, kind[1:] != kind[:-1]][: len(kind)]
    new_id = new_kind | np.r_[True, ids[1:] != ids[:-1]][: len(kind)]
    nth_row = place - np.maximum.accumulate(np.where(new_id, place, 0))
    count = np.cumsum(new_id)
    nth_id = count - np.maximum.accumulate(np.where(new_kind, count, 0))
    return np.sort(order[(nth_id < most) & (nth_row < rows_of_id)])


def exact_cosine(a, b):
    """Cosines of the rows of a and b, each summed in the same order wherever it stands."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _usable(vectors, id_col, vector_col):
    """id, v (components, floats stay floats) and dim of the vectors that take part."""
    kind = vectors.schema[vector_col].dataType
    exact = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = F.col(vector_col).cast("array<float>" if exact else "array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim")
    ).where(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def fit_routes(usable: DataFrame, n: int) -> dict:
    """A routing tree per number of components, from at most ROUTE_SAMPLE of the n vectors, chosen by a hash."""
    bound = min(1.0, 1.2 * ROUTE_SAMPLE / max(1, n))
    drawn = usable.withColumn("h", F.xxhash64("id", "v", F.lit("route"))).where(F.col("h") / F.lit(2.0**64) + 0.5 <= bound)
    sample = drawn.orderBy("h", "id").limit(ROUTE_SAMPLE).select("dim", "v").collect()
    routes = {}
    for dim in sorted({r["dim"] for r in sample}):
        own = np.array([r["v"] for r in sample if r["dim"] == dim], np.float64)
        routes[dim] = Route(unit(own), -(-n * len(own) // (len(sample) * SHARD_VECTORS)))
    return routes


def _by_dim(batches):
    """Record batches cut into tables of vectors with as many components."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        for dim in pc.unique(rows.column("dim")).to_pylist():
            yield dim, rows.filter(pc.equal(rows.column("dim"), dim))


def deal(usable: DataFrame, routes: dict, k: int) -> DataFrame:
    """id, v, dim and leaf; of equal vectors of a batch those that k + 1 ids have."""
    def run(batches):
        for dim, rows in _by_dim(batches):
            raw = _matrix(rows, "v")
            kept = first_of_equal(raw, k + 1, rows.column("id").to_numpy(), k)
            rows, raw = rows.take(pa.array(kept)), raw[kept]
            leaf = routes[dim].home(unit(raw)) if dim in routes else np.zeros(len(raw), np.int32)
            yield from rows.append_column("leaf", pa.array(leaf, pa.int32())).to_batches()

    return usable.mapInArrow(run, T.StructType([*usable.schema.fields, T.StructField("leaf", T.IntegerType())]))


def open_leaves(asked: DataFrame, routes: dict, relax: float) -> DataFrame:
    """A row of `asked` (id, v, dim, leaf, limit) for every other leaf that may hold one of its nearest."""
    def run(batches):
        for dim, rows in _by_dim(batches):
            if dim not in routes:
                continue
            limits = rows.column("limit").to_numpy()
            at, leaf = routes[dim].reach(unit(_matrix(rows, "v")), limits, relax)
            other = leaf != rows.column("leaf").to_numpy()[at]
            found = rows.take(pa.array(at[other]))
            place = found.schema.get_field_index("leaf")
            yield from found.set_column(place, "leaf", pa.array(leaf[other], pa.int32())).to_batches(max_chunksize=10_000)

    return asked.mapInArrow(run, asked.schema)


def search(dealt: DataFrame, sizes: DataFrame, asked: DataFrame, k: int, relax: float) -> DataFrame:
    """query_id, vec_id and score of what `asked` (id, v, dim, leaf, limit) may find in the shards of its leaf.

    A leaf of n vectors is cut into shards, its queries into blocks; a vector travels once for each block of its leaf.
    """
    parts = lambda n, size: F.ceil(F.col(n) / size).cast("int")
    plan = sizes.join(asked.groupBy("dim", "leaf").agg(F.count("*").alias("asks")), ["dim", "leaf"]).select(
        "dim", "leaf", parts("n", SHARD_VECTORS).alias("shards"), parts("asks", QUERY_BLOCK).alias("blocks")
    )
    plan = stage(plan, "search-plan")  # written, so that its size is known when the joins are planned
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt_to = lambda n, *by: F.pmod(F.xxhash64(*by), F.col(n)).cast("int")
    left = dealt.join(plan, ["dim", "leaf"]).select(
        "id", "v", "dim", "leaf", dealt_to("shards", "id", "v").alias("shard"), numbers("blocks").alias("block")
    )
    right = asked.join(plan, ["dim", "leaf"]).select(
        "id", "v", "limit", "dim", "leaf", numbers("shards").alias("shard"), dealt_to("blocks", "id", F.lit(1)).alias("block")
    )
    keys = ["dim", "leaf", "shard", "block"]

    def run(members, queries):
        if not members.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids = members.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")  # the tree does not depend on the order of rows
        ids, raw = ids[order], _matrix(members, "v")[order]
        chosen = first_of_equal(raw, k + 1, ids, k)
        ids, raw = ids[chosen], raw[chosen]
        asked_ids, asked_raw = queries.column("id").to_numpy(), _matrix(queries, "v")
        limits = queries.column("limit").to_numpy()
        q, m = Tree(unit(raw)).search(unit(asked_raw), ids, asked_ids, limits, k, relax)
        score = exact_cosine(asked_raw[q], raw[m])
        order = np.lexsort((ids[m], -score, q))
        q, m, score = q[order], m[order], score[order]
        first = np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1] if len(q) else np.zeros(0, np.int64)
        nth = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        top = nth < k
        return pa.table({"query_id": asked_ids[q[top]], "vec_id": ids[m[top]], "score": score[top]})

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")


def _ranked(found, k):
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, every: int = 50, k: int = 5, relax: float = 1.0, id_col="vec_id", vector_col="embedding"
) -> DataFrame:
    """The k nearest of every vector whose id is divisible by `every`: query_id, rank, vec_id, score.

    Candidates are all rows with another id and as many components. Equal scores go by smaller id.
    Null ids, null or zero vectors and vectors with null or non-finite components take no part. Rows
    that repeat an id are candidates of their own, and as queries each id counts once. Other columns are not read.
    """
    ship_package(vectors.sparkSession)
    usable = _usable(vectors, id_col, vector_col)
    n = usable.count()
    routes = fit_routes(usable, n)
    dealt = stage(deal(usable, routes, k), "dealt")
    sizes = stage(dealt.groupBy("dim", "leaf").agg(F.count("*").alias("n")), "leaf-sizes")
    everyone = 1 << 40  # equal queries all ask
    asked = stage(deal(usable.where(F.col("id") % every == 0).dropDuplicates(["id"]), routes, everyone), "asked")
    far = F.lit(9.0)  # above any chord
    home = stage(search(dealt, sizes, asked.withColumn("limit", far), k, relax), "home")
    last = _ranked(home, k).where(F.col("rank") == k).select(
        F.col("query_id").alias("id"), F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))).alias("limit")
    )
    limited = asked.join(last, "id", "left").withColumn("limit", F.coalesce("limit", far))
    away = stage(open_leaves(limited, routes, relax), "open")
    return _ranked(home.unionByName(search(dealt, sizes, away, k, relax)), k).select("query_id", "rank", "vec_id", "score")
