"""Linking of 64-bit fingerprints within a Hamming radius, and connected components, as Spark jobs."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modlake.llm.store import dropped, parts_for, stored

#: Fingerprints of one bucket that a task compares at once; larger buckets are cut into tiles of this size.
TILE = 2048


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """2^(radius+1) - 1 masks such that any `radius` bit positions all miss at least one of them.

    Bit i has a nonzero vector m(i) over GF(2) with radius + 1 components; mask v holds the bits
    with <m(i), v> = 1. The vectors of `radius` positions span too little to exclude a nonzero v
    that is orthogonal to all of them, so two fingerprints that differ there agree under mask v.
    """
    vectors = 2 ** (radius + 1) - 1
    m = [1 + (i * 7) % vectors for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (m[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def block_masks(radius: int, blocks: int, bits: int = 64) -> list[int]:
    """Permuted block tables: one mask for each choice of blocks - radius blocks of the fingerprint."""
    edges = [round(b * bits / blocks) for b in range(blocks + 1)]
    block = [sum(1 << i for i in range(edges[b], edges[b + 1])) for b in range(blocks)]
    return [sum(block[b] for b in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b: long): root is the smallest node it can reach.

    Alternating large-star and small-star rounds until one changes nothing; each is two aggregates and
    two joins by key, and is written to the shared folder in place of the one before. A hub with very
    many neighbours is only ever aggregated to a minimum and joined back, so no task gathers a
    neighbourhood. A round replaces neighbours by smaller ones or ends the loop, so the loop ends.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64(F.lit(2), "a", "b").cast("decimal(38,0)"))).first())
    before, after = None, state(now)
    while after[0] and after != before:
        both = now.union(now.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))
        then = stored(small.distinct(), "edges")
        before, after = after, state(then)
        dropped(now)
        now = then
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def bucket_keys(fps: DataFrame, masks: list[int], each: int = 1 << 18, tasks: int = 1 << 15) -> DataFrame:
    """(fp, k) for each table of the distinct fingerprints fps (fp: long): k names the bucket of the masked value.

    The fingerprints are dealt out first, so that no task makes many more than `each` of these rows; beyond that
    number of tasks the tasks get longer instead, since they hold none of what they make.
    """
    table = F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks)]))
    return fps.repartition(min(tasks, parts_for(fps.count() * len(masks), each)), "fp").select("fp", table.alias("k"))


def near_links(fps: DataFrame, masks: list[int], radius: int, tile: int = TILE) -> DataFrame:
    """(node, root) of the distinct fingerprints fps (fp: long) that have others within the radius.

    Fingerprints meet in the buckets of all masked values. First every fingerprint is compared with
    the smallest of its bucket, which is linear in the bucket and joins a group of near copies for
    the most part. Only buckets whose members are then still in different components are compared
    in full, in tiles of bounded size, each tile pair a group of its own; pairs that are already
    connected are left out, so no link between components is lost.
    """
    keys = bucket_keys(fps, masks)
    shared = keys.groupBy("k").agg(F.min("fp").alias("hub"), F.max("fp").alias("top"), F.count(F.lit(1)).alias("n")).where("hub < top")
    # a table of its own, so that the join with it can split a bucket that very many fingerprints share
    members = stored(keys.join(stored(shared.select("k", "hub", "n"), "shared"), "k"), "buckets")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= radius
    first = stored(components(members.where((F.col("fp") != F.col("hub")) & near).select(F.col("fp").alias("a"), F.col("hub").alias("b"))), "links")
    named = members.join(first, members["fp"] == first["node"], "left").select("k", "n", "fp", F.coalesce("root", "fp").alias("comp"))
    mixed = named.groupBy("k").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("k")
    rest = named.join(mixed, "k")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    # a fingerprint of tile t meets the tiles at and after t as the left side, those at and before t as the right
    mine = F.when(tiles <= 1, 0).otherwise(F.pmod(F.xxhash64("fp"), tiles).cast("int"))
    pairs = rest.select("k", "fp", "comp", mine.alias("t"), tiles.alias("tiles")).select(
        "k", "fp", "comp", "t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o")
    )
    cross = pairs.select("k", "fp", "comp", "t", F.least("t", "o").alias("ti"), F.greatest("t", "o").alias("tj"))
    more = cross.groupBy("k", "ti", "tj").applyInArrow(_cross_links(radius), "a long, b long")
    more = stored(more.distinct(), "links")
    if more.isEmpty():
        return first
    return components(more.union(first.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def _cross_links(radius: int):
    def links(key: tuple, group: pa.Table) -> pa.Table:
        comp, t = (group.column(c).to_numpy() for c in ("comp", "t"))
        fp = group.column("fp").to_numpy().view(np.uint64)  # of signed numbers the bits of the absolute value would be counted
        left, right = (t == key[1].as_py()), (t == key[2].as_py())
        a, ca, b, cb = fp[left], comp[left], fp[right], comp[right]
        found_a, found_b = [], []
        for i in range(0, len(a), 256):
            apart = np.bitwise_count(a[i : i + 256, None] ^ b[None, :]) <= radius
            apart &= ca[i : i + 256, None] != cb[None, :]
            x, y = np.nonzero(apart)
            # one link for two components is enough
            _, once = np.unique(np.stack([ca[i + x], cb[y]]), axis=1, return_index=True)
            found_a.append(ca[i + x[once]])
            found_b.append(cb[y[once]])
        none = [np.empty(0, np.int64)]
        return pa.table({"a": pa.array(np.concatenate(found_a or none), pa.int64()), "b": pa.array(np.concatenate(found_b or none), pa.int64())})

    return links


def near_classes(marked: DataFrame, masks: list[int], radius: int, doc_id: str = "doc_id", fp: str = "fp") -> DataFrame:
    """(fp, class_id) for each distinct fingerprint of marked: the smallest doc_id that it can reach.

    Null ids count after all others; a class of null ids only has class_id null.
    """
    fps = stored(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("first")), "fps")
    linked = stored(near_links(fps.select("fp"), masks, radius), "classes")
    smallest = stored(linked.join(fps, linked["node"] == fps["fp"]).groupBy("root").agg(F.min("first").alias("smallest")), "smallest")
    named = linked.join(smallest, "root").select("node", "smallest")
    # a table of its own, so that a join of documents with it can split a fingerprint that very many share
    return stored(fps.join(named, fps["fp"] == named["node"], "left").select("fp", F.coalesce("smallest", "first").alias("class_id")), "named")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small pieces of Arrow batches, so that a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
