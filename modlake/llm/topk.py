"""Exact top-k inner-product search by dual-tree cover-tree search.

Vectors become integers, floor(scale * x), so scores are exact. A first level of centres, chosen far
from each other on a bounded sample (`sample` rows, smallest hash of the id), deals all vectors into
cells; cells are cut into shards of about `shard_rows` rows, so a cell that holds much of the data is
many shards. Queries are grouped in the same way. Each shard and each query group is a cover tree below
that level: nested nets at halved scales (CoverTree). For query node (q, s) and data node (c, r), each a
centre and a covering radius, no score exceeds

    <q, c> + |q| r + |c| s + s r

and the pair is pruned when that is below the worst kth score of the node's queries. First each query
group searches its own cell, which gives those kth scores; then the shards of the cells that the bound does
not exclude are searched, down the two trees in each task, with the kth scores so far as a start.
Equal bounds are searched, so ties go to the smaller id exactly.

Scale: data vectors are dealt to tiles (shard, query batch) of bounded size on both sides; a query group
meets the cells first, of which there are `cells` at most, and goes only to the shards of those left. The driver sees the sample of centres and counts.

Edge cases: vectors that are null or hold null or non-finite components, and null ids, take no part;
shorter vectors count as filled up with zeros; equal vectors under different ids all are candidates; of rows
with one id the one with the smallest vector counts; components whose scores could exceed 64 bits are refused; a query
with fewer than k candidates gets them all; an empty table gives no rows; other columns are not read.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlake.llm.store import parts_for, stored

FOUND = "query_id long, vec_id long, score long"
#: Rows of a leaf of a data tree.
DATA_LEAF = 256
#: Data rows that are scored at once.
BLOCK = 2048


class CoverTree:
    """A cover tree of the rows of x, its levels at scales R, R/2, R/4, ... built as nested nets.

    centres: rows of x in the order in which they joined; levels: (scale, number of centres so far). Centres of a
    level are more than its scale apart (separation), belong to all finer levels (nesting), and every row is
    within the scale of one (covering); parent: for each centre one of the level above, within that
    level's scale. Levels end when no centre has over `leaf` rows that differ.

    nodes: (centre, its norm, covering radius, from, to, children) over `rows`, root first, chains of one child
    left out. Children without children and of few rows are one child together: without structure in x half a
    scale covers next to nothing, a node has as many children as rows, and the bound of a single row is its score.
    """

    def __init__(self, x: np.ndarray, leaf: int, block: int = 256):
        squares = (x**2).sum(axis=1)
        self.centres, self.parent, joined = [0], [0], [0]
        near, owner = np.sqrt(((x - x[0]) ** 2).sum(axis=1)), np.zeros(len(x), np.int64)
        scale = float(near.max())
        self.levels = [(scale, 1)]
        while scale > 0 and np.bincount(owner, minlength=1)[np.unique(owner[near > 0])].max(initial=0) > leaf:
            scale /= 2
            above = owner.copy()
            while len(far := np.flatnonzero(near > scale)[:block]):
                new: list[int] = []
                apart, free = _apart(x, squares, far, far) > scale, np.ones(len(far), bool)
                for i in range(len(far)):
                    if free[i]:
                        new.append(int(far[i]))
                        free &= apart[i]
                others = np.flatnonzero(near > 0)
                to_new = _apart(x, squares, others, np.array(new))
                best = to_new.argmin(axis=1)
                d = to_new[np.arange(len(others)), best]
                closer = d < near[others]
                near[others[closer]], owner[others[closer]] = d[closer], len(self.centres) + best[closer]
                near[new], owner[new] = 0.0, len(self.centres) + np.arange(len(new))
                self.parent += above[new].tolist()
                joined += [len(self.levels)] * len(new)
                self.centres += new
            self.levels.append((scale, len(self.centres)))
        self.rows, self.nodes = np.zeros(len(x), np.int64), []
        members = np.split(np.argsort(owner, kind="stable"), np.cumsum(np.bincount(owner, minlength=len(self.centres)))[:-1])
        kids: list[dict[int, list[int]]] = [{} for _ in self.centres]
        for c in range(1, len(self.centres)):
            kids[self.parent[c]].setdefault(joined[c], []).append(c)
        self._node(x, 0, 0, 0, kids, members, leaf)
        self.x = x[self.rows]

    def _node(self, x: np.ndarray, c: int, level: int, lo: int, kids: list, members: list, leaf: int) -> int:
        """The node of centre c with what joined it below the level, its rows from lo on."""
        me, at, children = len(self.nodes), lo, []
        self.nodes.append(())
        following = min((k for k in kids[c] if k > level), default=None)
        if following is None:
            at += len(members[c])
            self.rows[lo:at] = members[c]
        else:
            few: list[np.ndarray] = []
            for k in [c, *kids[c][following]]:
                if len(members[k]) <= leaf // 8 and not any(b > following for b in kids[k]):
                    few.append(members[k])
                else:
                    children.append(self._node(x, k, following, at, kids, members, leaf))
                    at = self.nodes[children[-1]][4]
            if few:
                both = np.concatenate(few)
                self.rows[at : at + len(both)] = both
                children.append(len(self.nodes))
                self.nodes.append(self._tuple(x, c, at, at + len(both), []))
                at += len(both)
        self.nodes[me] = self._tuple(x, c, lo, at, children)
        return me

    def _tuple(self, x: np.ndarray, c: int, lo: int, hi: int, children: list[int]) -> tuple:
        centre = x[self.centres[c]]
        radius = float(np.sqrt(((x[self.rows[lo:hi]] - centre) ** 2).sum(axis=1).max()))
        return centre, float(np.sqrt((centre**2).sum())), radius, lo, hi, children


def _apart(x: np.ndarray, squares: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows a to the rows b of x."""
    return np.sqrt(np.maximum(squares[a][:, None] - 2 * (x[a] @ x[b].T) + squares[b][None, :], 0))


def bound(a: tuple, b: tuple) -> float:
    """No inner product of members of two nodes exceeds this."""
    most = float(a[0] @ b[0]) + a[1] * b[2] + b[1] * a[2] + a[2] * b[2]
    return most + 1e-9 * (a[1] + a[2]) * (b[1] + b[2]) + 1e-6


def dual_search(q: np.ndarray, q_ids: np.ndarray, worst: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int, tree: "CoverTree | None" = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of query, id, score) of the best k candidates of each query that reach its score in `worst`; tree: that of x, if there is one."""
    qt, xt = CoverTree(q, 64), tree or CoverTree(x, DATA_LEAF)
    ids, own, norm = x_ids[xt.rows], q_ids[qt.rows], np.sqrt((qt.x**2).sum(axis=1))
    least = worst[qt.rows].astype(np.float64)
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(q)
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1]) < 2.0**53
    heap = [(-bound(qt.nodes[0], xt.nodes[0]), 0, 0)]
    while heap:
        negative, i, j = heapq.heappop(heap)
        a, b = qt.nodes[i], xt.nodes[j]
        if -negative < least[a[3] : a[4]].min():
            continue
        if a[5] and (a[2] >= b[2] or not b[5]):
            for c in a[5]:
                heapq.heappush(heap, (-bound(qt.nodes[c], b), c, j))
            continue
        # the queries of a leaf are bounded one by one
        at = np.arange(a[3], a[4])
        if not a[5]:
            left, norms = qt.x[at], norm[at]
            at = at[left @ b[0] + norms * b[2] + 1e-9 * norms * (b[1] + b[2]) + 1e-6 >= least[at]]
        if b[5]:
            for c in b[5] if len(at) else ():
                heapq.heappush(heap, (-bound(a, xt.nodes[c]), i, c))
            continue
        for lo in range(b[3], b[4], BLOCK):
            if not len(at):
                break
            right, names = xt.x[lo : min(b[4], lo + BLOCK)], ids[lo : min(b[4], lo + BLOCK)]
            scores = qt.x[at] @ right.T if exact else (qt.x[at].astype(np.int64) @ right.astype(np.int64).T)
            good = (scores >= least[at, None]) & (names[None, :] != own[at, None])
            for r in np.flatnonzero(good.any(axis=1)):
                to = at[r]
                s, v = scores[r, good[r]], names[good[r]]
                if len(s) > k:
                    high = s >= np.partition(s, len(s) - k)[len(s) - k]
                    s, v = s[high], v[high]
                s, v = np.concatenate([best[to][0], s]), np.concatenate([best[to][1], v])
                first = np.lexsort((v, -s))[:k]
                best[to] = (s[first], v[first])
                if len(first) == k:
                    least[to] = max(least[to], s[first[-1]])
    place = np.repeat(qt.rows, [len(s) for s, _ in best])
    return place, np.concatenate([np.zeros(0, np.int64), *(v for _, v in best)]), np.concatenate([np.zeros(0), *(s for s, _ in best)])


def integers(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of each component, or null where the vector takes no part."""
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(sound, F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    lists = column.combine_chunks()
    flat, offsets = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lists.offsets.to_numpy().astype(np.int64)
    sizes, out = np.diff(offsets), np.zeros((len(lists), max(1, dim)))
    at = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[np.repeat(np.arange(len(lists)), sizes), at] = flat
    return out


def _far_centres(x: np.ndarray, n: int) -> np.ndarray:
    chosen, near = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, shard_rows: int = 4096, group_rows: int = 1024, batch_groups: int = 16,
    cells: int = 256, sample: int = 4096, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row where is_query holds, its own id left out.

    is_query may use the column vec_id.
    """
    spark = vectors.sparkSession
    largest = F.array_max(F.transform(F.col(embedding), lambda x: F.abs(x.cast("double") * F.lit(float(scale)))))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), integers(F.col(embedding), scale).alias("v"), largest.alias("largest"))
    rows = stored(rows.where("vec_id IS NOT NULL AND v IS NOT NULL").groupBy("vec_id").agg(F.min("v").alias("v"), F.max("largest").alias("largest")), "vectors")
    n, dim, most = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max("largest"), F.lit(0.0))).first()
    if dim * (most + 1) ** 2 >= 2.0**63:
        raise ValueError(f"components of up to {most:g} after scaling: their scores do not fit into 64 bits")
    rows = rows.select("vec_id", "v")
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    centres = _far_centres(_matrix(picked.column("v"), dim), min(cells, parts_for(n, shard_rows // 2)))

    def assign(batches):
        for b in batches:
            x = _matrix(pa.chunked_array([b.column(1)]), dim)
            apart = (x**2).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres**2).sum(axis=1)[None, :]
            cell = apart.argmin(axis=1)
            far = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(cell), pa.array(far)], names=["vec_id", "v", "cell", "far"])

    dealt = stored(rows.mapInArrow(assign, "vec_id long, v array<long>, cell long, far double").withColumn("query", F.coalesce(is_query, F.lit(False))), "cells")
    sizes = {r["cell"]: (r["n"], r["q"]) for r in dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("query").alias("q")).collect()}
    # numbers of shards and query groups: the first of each cell, and how many it has; one row a cell
    shards, groups, table = 0, 0, []
    for cell in sorted(sizes):
        s, g = parts_for(sizes[cell][0], shard_rows), parts_for(sizes[cell][1], group_rows)
        table.append((cell, shards, s, groups, g))
        shards, groups = shards + s, groups + g
    by_cell = spark.createDataFrame(table, "cell long, s0 long, s long, g0 long, g long")
    spread = dealt.join(F.broadcast(by_cell), "cell")
    place = F.xxhash64(F.lit(5), "vec_id")
    data = spread.select("vec_id", "v", "cell", "far", (F.col("s0") + F.pmod(place, F.col("s"))).alias("shard"))
    asking = spread.where("query").select("vec_id", "v", "cell", "far", (F.col("g0") + F.pmod(place, F.col("g"))).alias("group"))
    shard_stats = data.groupBy("shard", "cell").agg(F.max("far").alias("radius"))
    group_stats = asking.groupBy("group", "cell").agg(F.max("far").alias("radius"))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            x, q, q_ids = _matrix(left.column("v"), dim), _matrix(right.column("v"), dim), right.column("vec_id").to_numpy()
            worst = right.column("worst").to_numpy()
            of, tree = right.column("group").to_numpy(), CoverTree(x, DATA_LEAF)
            for g in np.unique(of):
                at = np.flatnonzero(of == g)
                place, v, s = dual_search(q[at], q_ids[at], worst[at], x, left.column("vec_id").to_numpy(), k, tree)
                found.append((q_ids[at][place], v, s))
        a, b, c = (np.concatenate(z) for z in zip(*found))
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c.astype(np.int64))})

    def searched(pairs: DataFrame, queries: DataFrame) -> DataFrame:
        tiles = stored(pairs.select("shard", "group", F.floor(F.col("group") / batch_groups).cast("long").alias("batch")), "pairs")
        left = data.select("shard", "vec_id", "v").join(tiles.select("shard", "batch").distinct(), "shard").select("shard", "batch", "vec_id", "v")
        right = queries.join(tiles, "group").select("shard", "batch", "group", "vec_id", "v", "worst")
        # both stem from one table; new names keep their columns apart
        left = left.toDF("l_shard", "l_batch", "vec_id_l", "v_l").select(F.col("l_shard"), F.col("l_batch"), F.col("vec_id_l").alias("vec_id"), F.col("v_l").alias("v"))
        return left.groupBy("l_shard", "l_batch").cogroup(right.groupBy("shard", "batch")).applyInArrow(search, FOUND)

    own = group_stats.join(shard_stats.select("cell", "shard"), "cell").select("shard", "group")
    first = stored(searched(own, asking.withColumn("worst", F.lit(float("-inf")))), "near")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.col("score").cast("double").alias("worst"))
    queries = stored(asking.join(kth, F.col("vec_id") == F.col("of"), "left").drop("of").withColumn("worst", F.coalesce("worst", F.lit(float("-inf")))), "queries")

    def bounded(batches):
        norms = np.sqrt((centres**2).sum(axis=1))
        for b in batches:
            i, j, s, r = (b.column(c).to_numpy() for c in ("cell", "other", "radius", "far"))
            most = (centres[i] * centres[j]).sum(axis=1) + norms[i] * r + norms[j] * s + s * r
            keep = pa.array(most + 1e-9 * (norms[i] + s) * (norms[j] + r) + 1e-6 >= b.column("worst").to_numpy())
            yield pa.record_batch([b.column("other").filter(keep), b.column("group").filter(keep)], names=["other", "group"])

    least = queries.groupBy("group", "cell").agg(F.max("far").alias("radius"), F.min("worst").alias("worst"))
    # the query groups against the cells, of which there are `cells` at most; then against the shards of what is left
    radii = shard_stats.groupBy(F.col("cell").alias("other")).agg(F.max("radius").alias("far"))
    every = least.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(len(centres) - 1)).cast("array<long>"))).where("cell <> other")
    roots = every.join(F.broadcast(radii), "other").select("group", "cell", "other", "radius", "far", "worst").mapInArrow(bounded, "other long, group long")
    of_cell = F.broadcast(by_cell.select(F.col("cell").alias("other"), "s0", "s"))
    pairs = roots.join(of_cell, "other").select(F.explode(F.sequence(F.col("s0"), F.col("s0") + F.col("s") - 1)).alias("shard"), "group")
    rest = searched(pairs, queries)
    return first.union(rest).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
