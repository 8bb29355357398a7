"""Pairs of texts with a Jaccard similarity of 0.8 or more on five-word shingles, found without loss.

A text is the set of the hashes of its shingles, words with A-Z lower-cased; fewer words than five make
one shingle, no words none. Texts of one set are one node, so copies are not expanded.

Prefix filter: shingles have one order for all texts, rare ones first. Two sets of a similarity of 0.8
share one of the first n - ceil(0.8 n) + 1 shingles of each, so such pairs meet in the bucket of a prefix
shingle. What is frequent is told by a sample; a poor sample makes larger buckets and loses nothing.

Parity filter: each shingle of a set flips one of as many bits as it has shingles. Bits that differ between two sets are at most as
many as shingles that only one of them holds, which bounds from above what they have in common. Pairs that
this leaves are verified by their shingles; no pair of similar sets is ever excluded.

Edge cases: a null, empty or blank text has the empty set, and all of them are one node.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.llm.fingerprints import MIX, mixed, word_arrays
from modlake.llm.hamming import TILE, components, slices
from modlake.llm.store import stored

SEED = 42
WIDTH = 5
#: The similarity from which texts are near copies: 4 of 5.
PART, WHOLE = 4, 5
#: One in so many rows tells which shingles are frequent: those that HOT of them hold, MOST at most.
SAMPLE, HOT, MOST = 32, 3, 200_000
#: Parity bits of a set at least, and those that go with each member of a bucket.
LOW = 512
#: Members of a bucket that are compared by a join; larger buckets are in tiles.
SMALL = 48
#: Likeliest pairs of each member of a bucket that are verified before all others that are still apart.
NEAREST = 3


def shingle_sets(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, sizes): the sorted distinct shingle hashes of the texts in a row, and how many each has."""
    n = np.where(counts >= WIDTH, counts - WIDTH + 1, counts > 0).astype(np.int64)
    doc = np.repeat(np.arange(len(counts)), n)
    ends = np.cumsum(counts)
    at = (ends - counts)[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    grams = hashes[at]
    for j in range(1, WIDTH):
        more = np.flatnonzero(at + j < ends[doc])
        grams[more] = mixed(grams[more] * MIX + hashes[at[more] + j])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    return grams[new], np.bincount(doc[new], minlength=len(counts))


def nodes_of(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number for each set."""
    ends = np.cumsum(sizes).tolist()
    return np.array([xxhash.xxh64_intdigest(shingles[a:b].tobytes(), SEED) for a, b in zip([0, *ends], ends)], np.uint64).view(np.int64)


def prefixes(shingles: np.ndarray, sizes: np.ndarray, hot: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sizes): the prefix of each set; hot are the sorted frequent shingles, with their ranks."""
    rank = np.zeros(len(shingles), np.int64)
    if len(hot):
        near = np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)
        rank = np.where(hot[near] == shingles, ranks[near], 0)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((shingles, rank, doc))
    place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    taken = np.where(sizes > 0, sizes - -(-PART * sizes // WHOLE) + 1, 0)
    return shingles[order][place < taken[doc]], taken


def parities(shingles: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(bits, low): parity bits of each set as lists of longs: a power of two of them as there are shingles, and LOW of them."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    spread = mixed(shingles) >> np.uint64(20)
    width = 1 << np.maximum(np.ceil(np.log2(np.maximum(sizes, LOW))).astype(np.int64), LOW.bit_length() - 1)
    out = []
    for of in (width, np.full(len(sizes), LOW)):
        begin = np.cumsum(of) - of
        bit = (spread & (of[doc] - 1).astype(np.uint64)).astype(np.int64)
        flips = np.bincount(begin[doc] + bit, minlength=int(of.sum())) & 1
        out.append(lists(np.packbits(flips.astype(np.uint8), bitorder="little").view("<u8"), of // 64))
    return out[0], out[1]


def folded(bits: np.ndarray, longs: int) -> np.ndarray:
    """Parity bits [sets, n] as fewer of them: bits of one place, modulo the lesser number, flip together."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, longs), axis=1)


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def shingled(docs: DataFrame) -> DataFrame:
    """(node, shingles) of rows whose only column is the text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            hashes, _, counts = word_arrays(b.column(0), SEED)
            found, sizes = shingle_sets(hashes, counts)
            yield pa.record_batch([pa.array(nodes_of(found, sizes)), lists(found, sizes)], names=["node", "shingles"])

    return docs.mapInArrow(sets, "node long, shingles array<long>")


def frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that many of a sample of rows (row, text) hold, sorted, and how many hold each."""
    seen = shingled(rows.where(F.pmod("row", F.lit(SAMPLE)) == 0).select("text")).dropDuplicates(["node"])
    many = seen.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT)
    table = many.orderBy(F.desc("n"), "s").limit(MOST).toArrow()
    hot, ranks = table.column("s").to_numpy().astype(np.int64).view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(hot)
    return hot[order], ranks[order]


def alike(shared: Column, a: Column, b: Column) -> Column:
    """Whether sets of sizes a and b with so many shingles in common are near copies."""
    return shared * (PART + WHOLE) >= (a + b) * PART


def possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of distinct pairs (a, b) of nodes (node, n, bits) that may be near copies by their sizes and parities."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
                held = []
                for c in ("pa", "pb"):
                    flat, ends = b.column(c).flatten().to_numpy().view(np.uint64), b.column(c).offsets.to_numpy().astype(np.int64)
                    held.append((flat, ends - ends[0]))
                (fa, ea), (fb, eb) = held
                la, lb = np.diff(ea), np.diff(eb)
                apart = np.zeros(len(na), np.int64)
                for x, y in np.unique(np.stack([la, lb]), axis=1).T.tolist():
                    of = np.flatnonzero((la == x) & (lb == y))
                    left, right = fa[ea[of][:, None] + np.arange(x)], fb[eb[of][:, None] + np.arange(y)]
                    apart[of] = np.bitwise_count(folded(left, min(x, y)) ^ folded(right, min(x, y))).sum(axis=1)
                most = np.minimum((na + nb - apart) // 2, np.minimum(na, nb))
                yield b.select(["a", "b"]).filter(pa.array(most * (PART + WHOLE) >= (na + nb) * PART))

    found = nodes.select("node", "n", "bits")
    left, right = (found.toDF(x, f"n{x}", f"p{x}") for x in "ab")
    n = F.col("na"), F.col("nb")
    sized = pairs.join(left.select("a", "na"), "a").join(right.select("b", "nb"), "b").where(alike(F.least(*n), *n))
    return sized.join(left.select("a", "pa"), "a").join(right.select("b", "pb"), "b").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(kept, "a long, b long")


def verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of pairs (a, b) of nodes (node, row) that are near copies, by the texts of rows (row, text)."""

    def ends(of: DataFrame) -> DataFrame:
        return stored(of.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node").select("row").distinct(), "wanted")

    pairs = stored(pairs, "pairs")
    sets = stored(shingled(rows.join(ends(pairs), "row", "left_semi").select("text")), "sets")
    left, right = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    both = pairs.join(left, "a").join(right, "b")
    same = F.size(F.array_intersect("sa", "sb"))
    return stored(both.where(alike(same, F.size("sa"), F.size("sb"))).select("a", "b").distinct(), "alike")


def pairs_of_tile(nearest: int | None = None):
    """The pairs of one tile of a bucket, of different components, that may be near copies by sizes and parities.

    If `nearest` is given, each node has only so many of its likeliest pairs.
    """

    def pairs(key: tuple, group: pa.Table) -> pa.Table:
        node, comp, n, t = (group.column(c).to_numpy() for c in ("node", "comp", "n", "t"))
        bits = group.column("low").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        left, right = np.flatnonzero(t == key[1].as_py()), np.flatnonzero(t == key[2].as_py())
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 2 + (np.empty(0),)]
        for at in range(0, len(left), 128):
            i = left[at : at + 128]
            apart = np.bitwise_count(bits[i][:, None, :] ^ bits[right][None, :, :]).sum(axis=2, dtype=np.int64)
            both = n[i][:, None] + n[right][None, :]
            most = np.minimum((both - apart) // 2, np.minimum(n[i][:, None], n[right][None, :]))
            ok = (most * (PART + WHOLE) >= both * PART) & (comp[i][:, None] != comp[right][None, :])
            x, y = np.nonzero(ok)
            found.append((i[x], right[y], most[x, y] / both[x, y]))
        x, y, weight = (np.concatenate(z) for z in zip(*found))
        if nearest:
            x, y = _nearest(x, y, weight, nearest)
        a, b = np.minimum(node[x], node[y]), np.maximum(node[x], node[y])
        once = np.unique(np.stack([a, b]), axis=1)
        return pa.table({"a": pa.array(once[0]), "b": pa.array(once[1])})

    return pairs


def _nearest(x: np.ndarray, y: np.ndarray, weight: np.ndarray, each: int) -> tuple[np.ndarray, np.ndarray]:
    """Of edges (x, y) those of greatest weight of each node, `each` of them at most."""
    of, to, w = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([weight, weight])
    order = np.lexsort((to, -w, of))
    of, to = of[order], to[order]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    return of[rank < each], to[rank < each]


def _members_apart(members: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """(k, node, comp, members, n, low) of the buckets (k, node) with members in different components."""
    named = members.join(roots, "node", "left").select("k", "node", F.coalesce("root", "node").alias("comp"))
    mixed_keys = stored(named.groupBy("k").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo < hi AND members > 2"), "mixed")
    return named.join(mixed_keys.select("k", "members"), "k").join(nodes.select("node", "n", "low"), "node")


def pairs_by_join(apart: DataFrame) -> DataFrame:
    """The pairs (a, b) of small buckets, of different components, that may be near copies: SMALL for each member at most."""
    wide = apart.where(F.col("members") <= SMALL).select("k", "node", "comp", "n", *[F.col("low")[i].alias(f"p{i}") for i in range(LOW // 64)])
    right = wide.select(*[F.col(c).alias(f"{c}_") for c in wide.columns])
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"p{i}_"))) for i in range(LOW // 64)])
    n, m = F.col("n"), F.col("n_")
    likely = alike(F.least(n, m), n, m) & ((n + m - differ) * (PART + WHOLE) >= (n + m) * 2 * PART)
    both = wide.join(right, (F.col("k") == F.col("k_")) & (F.col("node") < F.col("node_")) & (F.col("comp") != F.col("comp_")) & likely)
    return both.select(F.col("node").alias("a"), F.col("node_").alias("b"))


def pairs_by_tiles(apart: DataFrame, nearest: int | None) -> DataFrame:
    """The same of larger buckets, in tiles of bounded size; of each member only its nearest in a tile, if that is given."""
    rest = apart.where(F.col("members") > SMALL)
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    mine = F.when(tiles <= 1, 0).otherwise(F.pmod(F.xxhash64("node"), tiles).cast("int"))
    dealt = rest.select("k", "node", "comp", "n", "low", mine.alias("t"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("o"))
    cross = dealt.select("k", "node", "comp", "n", "low", "t", F.least("t", "o").alias("ti"), F.greatest("t", "o").alias("tj"))
    return cross.groupBy("k", "ti", "tj").applyInArrow(pairs_of_tile(nearest), "a long, b long")


def similar_components(marked: DataFrame, nodes: DataFrame, rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(node, root) of the nodes (node, row, n, bits, low) that have near copies.

    marked has (node, keys) of each row, candidates pairs (a, b) of nodes that are likely near copies. They
    and each node beside the smallest of its buckets are verified first, which is linear in the buckets.
    In buckets whose members are then still apart, all possible pairs of small ones and the likeliest
    pairs of each member of large ones are, and last all possible pairs of large ones that are still apart.
    """
    keys = marked.select("node", F.explode("keys").alias("k"))
    shared = keys.groupBy("k").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top").select("k", "hub")
    members = stored(keys.join(stored(shared, "shared"), "k").distinct(), "buckets")
    hubs = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    first = stored(hubs.union(candidates).distinct(), "pairs")
    roots = stored(components(verified(possible(first, nodes), nodes, rows)), "links")
    for nearest in (NEAREST, None):
        apart = _members_apart(members, roots, nodes)
        more = pairs_by_tiles(apart, nearest)
        # a pair that was compared with another of its bucket before needs no second time
        more = (more.union(pairs_by_join(apart)) if nearest else more).distinct().join(first, ["a", "b"], "left_anti")
        links = verified(possible(stored(more, "pairs"), nodes), nodes, rows)
        if not links.isEmpty():
            roots = stored(components(links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))), "links")
    return roots
