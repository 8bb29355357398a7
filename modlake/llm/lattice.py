"""Near-duplicate vectors by lattice hashing: random projections decoded to points of the E8 lattice.

A table projects the unit vector to 8 random directions (`blocks` times), divides by `cell` and takes the nearest
point of E8: all integers or all halves of odd ones, with an even sum. That point names the vector's cell; beside it
the vector probes the `probes` neighbouring cells (of the 240 next lattice points) that it lies closest to. Two
vectors meet where one's own cell is among the other's; every meeting is verified by the cosine in double precision.
At a cosine of 0.98 a pair meets in one table with a probability of 0.96 (measured, for 8 probes and cells of 1.0),
so five tables miss one pair in ten million at the threshold and fewer above it.

A pair may meet in several cells. It counts where it meets first, in the order of tables and cells, which each task
can tell from the cells that vectors carry along; so links are counted, and joined to components, without a list
of all pairs: a task returns a count and one link towards its component for each vector.

Scale: equal vectors are one class with a count. Cells are shuffled as 64-bit hashes with a class number and a sketch
of 128 signs of random projections; members without a partner in their cell whose signs agree as often as those of
near copies do (seven standard deviations of allowance) go before any vector is moved. Small cells are handled by
the thousand in a task, cells of more than TILE members in tiles of that size, each pair of tiles a group of its own.
The counts of links within a cell of n different vectors that are all near copies take n * n comparisons, dealt
out over tiles of bounded size.

Edge cases: a vector that is null, zero, or holds a null or non-finite component, and one without a label, links with
nothing, nor do vectors of different lengths; rows that repeat an id are vectors of their own; of equal vectors each
links all others; a null id comes after all others (a component of null ids has a null component_id); an empty
table gives no rows; other columns are not read.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.llm.fingerprints import mixed
from modlake.llm.hamming import components
from modlake.llm.store import parts_for, stored

#: Members of a cell that a task compares at once.
TILE = 2048
#: Members of small cells that a task gets at a time.
BIN = 4096
#: Coordinates of a projected vector that one lattice point takes.
SIDE = 8


@lru_cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two of the coordinates 1 or -1, or all of them 1/2 or -1/2 with an even number of minuses."""
    two = [np.bincount([i, j], [a, b], SIDE) for i, j in combinations(range(SIDE), 2) for a, b in product((1, -1), repeat=2)]
    halves = [np.array(s) / 2 for s in product((1, -1), repeat=SIDE) if s.count(-1) % 2 == 0]
    return np.array(two + halves)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: where the sum is odd, the coordinate that was rounded most goes the other way."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points of rows of 8 coordinates."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


@lru_cache
def projection(size: int, table: int, block: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size, table, block]).standard_normal((size, SIDE))


def cells_of(unit: np.ndarray, labels: np.ndarray, tables: int, probes: int, cell: float, blocks: int, seed: int) -> np.ndarray:
    """Hashes of the cells of unit vectors (rows), as signed longs: for each table the own cell, then the probed ones."""
    moves = np.concatenate([np.zeros((1, SIDE)), neighbours()])
    out = np.empty((len(unit), tables, 1 + probes), np.uint64)
    for t in range(tables):
        # the cheapest combinations of a move in each block; the first is none at all
        start = np.full((len(unit), 1), t, np.uint64) + mixed(labels.astype(np.int64).view(np.uint64))[:, None] * np.uint64(31)
        costs, keys = np.zeros((len(unit), 1)), mixed(start + np.uint64(unit.shape[1]))
        for b in range(blocks):
            x = unit @ projection(unit.shape[1], t, b, seed) / cell
            near = nearest_e8(x)
            cost = np.concatenate([np.zeros((len(unit), 1)), 2 - 2 * (x - near) @ neighbours().T], axis=1)
            order = np.argsort(cost, axis=1, kind="stable")[:, : 1 + probes]
            points = (2 * (near[:, None, :] + moves[order])).astype(np.int64).view(np.uint64)
            code = np.zeros(order.shape, np.uint64)
            for k in range(SIDE):
                code = mixed(code + points[:, :, k] + np.uint64(k + 1))
            sums = (costs[:, :, None] + np.take_along_axis(cost, order, 1)[:, None, :]).reshape(len(unit), -1)
            both = mixed(keys[:, :, None] + mixed(code + np.uint64(b + 1))[:, None, :]).reshape(len(unit), -1)
            order = np.argsort(sums, axis=1, kind="stable")[:, : 1 + probes]
            costs, keys = np.take_along_axis(sums, order, 1), np.take_along_axis(both, order, 1)
        out[:, t] = keys
    return out.reshape(len(unit), -1).view(np.int64)


def _lists(column: pa.ChunkedArray | pa.Array, kind: type) -> list[np.ndarray]:
    """The lists of an Arrow column as arrays."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False).astype(kind), column.offsets.to_numpy()
    return np.split(flat, offsets[1:-1] - offsets[0]) if len(column) else []


def unit_rows(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors of one length, as rows of length one in double precision; the largest component is taken out first, so no square overflows."""
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: Column, label: Column) -> Column:
    """True where a vector can link: with a label, not null, not zero, all components finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def sketches(unit: np.ndarray, seed: int) -> np.ndarray:
    """128 signs of random projections of unit vectors, as two signed longs a row."""
    signs = unit @ np.random.default_rng([seed, unit.shape[1]]).standard_normal((unit.shape[1], 128)) > 0
    return np.packbits(signs, axis=1, bitorder="little").view("<i8")


def signs_apart(cosine: float) -> int:
    """The most of 128 signs in which a pair with this cosine differs, by seven standard deviations."""
    share = float(np.arccos(np.clip(cosine, -1, 1)) / np.pi)
    return int(128 * share + 7 * np.sqrt(128 * share * (1 - share)))


def _pairs(k: np.ndarray, tile: np.ndarray, here: tuple[int, int] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of all pairs of members of a cell, in pieces; k ascends.

    here: the two tiles of one large cell, of which pairs across (or within, if equal) are wanted.
    """
    if here:
        left, right = np.flatnonzero(tile == here[0]), np.flatnonzero(tile == here[1])
        for at in range(0, len(left), 128):
            i, j = (x.ravel() for x in np.meshgrid(left[at : at + 128], right, indexing="ij"))
            some = i < j if here[0] == here[1] else np.ones(len(i), bool)
            yield i[some], j[some]
        return
    end = np.searchsorted(k, k, "right")
    i, shift = np.arange(len(k)), 1
    while len(i := i[i + shift < end[i]]):
        yield i, i + shift
        shift += 1


def _alike(members: pa.Table, apart: int, here: tuple[int, int] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs one of which has the cell as its own, and whose sketches differ in few signs."""
    k, base, tile = (members.column(c).to_numpy() for c in ("k", "base", "t"))
    s1, s2 = (members.column(c).to_numpy().view(np.uint64) for c in ("s1", "s2"))
    for i, j in _pairs(k, tile, here):
        near = (base[i] | base[j]) & (np.bitwise_count(s1[i] ^ s1[j]) + np.bitwise_count(s2[i] ^ s2[j]) <= apart)
        if near.any():
            yield i[near], j[near]


def _verified(members: pa.Table, cosine: float, tables: int, here: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of the members of some cells, sorted by cell: copies of partners first met here, and the first member reached."""
    k, label, m = (members.column(c).to_numpy() for c in ("k", "label", "copies"))
    vectors, cells = _lists(members.column("vector"), np.float64), np.array(_lists(members.column("cells"), np.int64)).reshape(len(k), tables, -1)
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    unit = np.zeros((len(k), sizes.max(initial=0)))
    for size in np.unique(sizes):
        of = np.flatnonzero(sizes == size)
        unit[of, :size] = unit_rows([vectors[i] for i in of])
    links, parent, none = np.zeros(len(k), np.int64), np.arange(len(k)), np.iinfo(np.int64).max

    def first_met(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The cell that pairs meet in first, by table and hash."""
        first = np.full(len(i), none)
        for t in range(tables - 1, -1, -1):
            a, b = cells[i, t, 0], cells[j, t, 0]
            met = np.minimum(np.where((cells[i, t] == b[:, None]).any(1), b, none), np.where((cells[j, t] == a[:, None]).any(1), a, none))
            first = np.where(met < none, met, first)
        return first

    for all_i, all_j in _alike(members, signs_apart(cosine), here):
        for at in range(0, len(all_i), 1 << 14):
            i, j = all_i[at : at + (1 << 14)], all_j[at : at + (1 << 14)]
            near = (label[i] == label[j]) & (sizes[i] == sizes[j]) & (np.einsum("nd,nd->n", unit[i], unit[j]) >= cosine)
            i, j = i[near], j[near]
            here_first = first_met(i, j) == k[i]
            i, j = i[here_first], j[here_first]
            np.add.at(links, i, m[j])
            np.add.at(links, j, m[i])
            while len(i):  # hook the larger root below the smaller until all pairs agree
                a, b = parent[i], parent[j]
                np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
                while not np.array_equal(up := parent[parent], parent):
                    parent = up
                split = parent[i] != parent[j]
                i, j = i[split], j[split]
    return links, parent


def _dealt(members: DataFrame) -> DataFrame:
    """members (node, k, ...) of cells that several share, dealt to tasks: columns large, bin, ti, tj and t added.

    Small cells go to bins of about BIN members; a member of tile t of a large one meets the tiles at and after t
    as the left side, those at and before t as the right.
    """
    sizes = stored(members.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("base").alias("known")).where("n > 1 AND known").select("k", "n"), "cells")
    bins = parts_for(sizes.where(F.col("n") <= TILE).agg(F.sum("n")).first()[0] or 0, BIN)
    # a table of its own, so that the join with it can split a cell that very many vectors share
    shared = members.join(sizes, "k").withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
    placed = shared.withColumn("t", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    large = F.col("tiles") > 1
    where = {"large": large, "bin": F.when(large, F.col("k")).otherwise(F.pmod(F.xxhash64("k"), F.lit(bins))), "ti": F.least("t", "o"), "tj": F.greatest("t", "o")}
    return placed.withColumns(where).drop("n", "tiles", "o")


def near_vectors(
    vectors: DataFrame, cosine: float = 0.98, tables: int = 5, probes: int = 8, cell: float = 1.0, blocks: int = 1, seed: int = 20,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; links join vectors of one label with at least this cosine.

    More `blocks` make cells finer, for labels of very many vectors: with two, `cell` 1.5 and 16 probes a pair at the
    threshold meets in one table with a probability of 0.90, and eight tables miss one in fifty million.
    """
    kind = vectors.schema[vec_id].dataType.simpleString()
    lists = F.transform(F.col(vector).cast("array<double>"), lambda x: x + 0.0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("long").alias("label"), lists.alias("vector"))
    marked = rows.withColumn("linking", usable(F.col("vector"), F.col("label")))
    hashes = [F.xxhash64(F.lit(s), F.col("label"), F.col("vector")).alias(f"h{s}") for s in (1, 2)]
    linking = marked.where("linking").select("vec_id", "label", "vector", *hashes)
    # equal vectors of a label are one class; first() takes any of them
    grouped = linking.groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    settings = (tables, probes, cell, blocks, seed)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                found, labels = _lists(b.column("vector"), np.float64), b.column("label").to_numpy()
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                cells, signs = np.empty((len(found), tables * (1 + probes)), np.int64), np.empty((len(found), 2), np.int64)
                for size in np.unique(sizes):
                    of = np.flatnonzero(sizes == size)
                    unit = unit_rows([found[i] for i in of])
                    cells[of], signs[of] = cells_of(unit, labels[of], *settings), sketches(unit, seed)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * cells.shape[1], pa.int32()), pa.array(cells.ravel()))
                yield pa.record_batch([*b.columns, lists, pa.array(signs[:, 0]), pa.array(signs[:, 1])], names=[*b.schema.names, "cells", "s1", "s2"])

    numbered = grouped.withColumn("node", F.monotonically_increasing_id())
    fields = f"h1 long, h2 long, least {kind}, copies long, label long, vector array<double>, node long, cells array<long>, s1 long, s2 long"
    classes = stored(numbered.mapInArrow(coded, fields), "vectors")

    own = F.array(*[F.col("cells")[t * (1 + probes)] for t in range(tables)])
    members = classes.select("node", "s1", "s2", own.alias("own"), F.explode(F.array_distinct("cells")).alias("k")).withColumn("base", F.array_contains("own", F.col("k"))).drop("own")

    def alike(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("k")
        some = np.zeros(group.num_rows, bool)
        for i, j in _alike(group, signs_apart(cosine), (key[2].as_py(), key[3].as_py()) if key[0].as_py() else None):
            some[i] = some[j] = True
        return group.select(["k", "node", "s1", "s2", "base"]).filter(pa.array(some))

    likely = _dealt(members).groupBy("large", "bin", "ti", "tj").applyInArrow(alike, "k long, node long, s1 long, s2 long, base boolean")
    likely = stored(likely.distinct(), "members")
    tasks = _dealt(likely).join(classes.select("node", "label", "copies", "vector", "cells"), "node")

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("k")
        links, parent = _verified(group, cosine, tables, (key[2].as_py(), key[3].as_py()) if key[0].as_py() else None)
        node = group.column("node").to_numpy()
        some = np.flatnonzero((links > 0) | (parent != np.arange(len(parent))))
        return pa.table({"node": node[some], "links": links[some], "root": node[parent[some]]})

    found = stored(tasks.groupBy("large", "bin", "ti", "tj").applyInArrow(compare, "node long, links long, root long"), "links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b")).toDF("member", "root")
    named = classes.select("node", "h1", "h2", "least", "copies").join(linked, "node", "left").join(roots, F.col("node") == F.col("member"), "left")
    named = named.select("h1", "h2", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("root", "node").alias("root"))
    named = stored(named, "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    by_class = stored(named.join(smallest, "root").select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "n", "component"), "by_class")
    joined = linking.select("vec_id", "h1", "h2").join(by_class, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")))
    alone = marked.where("NOT linking").select("vec_id", F.lit(0).cast("long").alias("n"), F.col("vec_id").alias("component"))
    every = joined.select("vec_id", "n", "component").union(alone)
    return every.select("vec_id", F.col("n").alias("n_links"), F.col("component").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))
