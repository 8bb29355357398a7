"""A Merkle manifest of a table: one tree for each group, one tree over the groups' roots, and a proof for every row.

H is the lowercase hex sha256 of its inputs, concatenated; digests go in as their hex text. The leaf of a row is H
of its fields, each `-` if null, else the number of its UTF-8 bytes, `:` and the value. Rows of a group ascend by
key; while a level has several nodes, every `arity` consecutive ones (the last run may be shorter, even one) become
their H. What remains is the group's subroot, a lone leaf itself; subroots in the order of their groups (null first,
bytewise) become the root in the same way.

Sibling-shift self-joins: at each level every node sends its digest to the computed indices of its siblings (its own
slot plus each offset, within the run), one equijoin on (group, index) brings them together, and the rows at slot
zero emit the parents. The siblings that a node has received are its part of the proof; parts are joined down the
levels, from the root, by the index of the parent.

Scale: texts are hashed where they are read and never shuffled; a row is about 100 bytes from there on. Positions
within groups come from ranges of (group, key), counted and summed over ranges. The join at the lowest level moves
arity - 1 digests a row, and all higher levels together an eighth of that; each key of a join is unique on one side
and has arity - 1 rows at most on the other, so no group, however large, meets in one task.

Edge cases: rows with equal keys follow in order of their leaves, a null key comes first; repeated rows are leaves of
their own; an empty table gives no rows; columns beside those named are not read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlake.llm.store import parts_for, stored

#: Bytes of leaves of one range.
RANGE = 8 << 20
LEAF_BYTES = 128


def field(value: Column) -> Column:
    """`-` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: list[Column]) -> Column:
    """The leaf of a row with these values: 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def hex_of(digests: Column) -> Column:
    """The hex text of one digest, or of several in a row."""
    return F.lower(F.hex(digests))


def fold(leaf: Column, proof: Column) -> Column:
    """The root (hex) that a leaf (32 bytes) leads to with the siblings of a proof: array of (left, right)."""
    return F.aggregate(proof, hex_of(leaf), lambda at, level: F.sha2(F.concat(hex_of(level["left"]), at, hex_of(level["right"])), 256))


def proof_digest(proof: Column) -> Column:
    """H of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: hex_of(F.concat(level["left"], level["right"]))), ""), 256)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (tree, ...) with idx, the place of a row in its tree by `order`, and n, the rows of its tree.

    rows is a stored table. Ranges are counted by tree and the counts summed over ranges: a table of a row for each
    range and tree in it.
    """
    parts = parts_for(rows.count() * LEAF_BYTES, RANGE)
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, "tree", *order, "tie").sortWithinPartitions("tree", *order)
    ranged = stored(ranged.drop("tie").withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "ranges")
    counts = ranged.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    ranges = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.select("tree", "part", "first", F.coalesce(F.sum("rows").over(ranges), F.lit(0)).alias("before"), F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    return ranged.join(stored(sums, "offsets"), ["tree", "part"]).withColumn("idx", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """nodes (tree, idx, n, digest, ...) with the digests of the siblings before and after each, concatenated: left, right."""
    slot = F.pmod("idx", F.lit(arity))
    shifts = F.explode(F.array(*[F.lit(o) for o in range(1, arity)])).alias("shift")
    sent = nodes.where("n > 1").select(F.col("tree").alias("to_tree"), "idx", slot.alias("from"), F.col("digest").alias("sibling"), shifts)
    sent = sent.select("to_tree", (F.col("idx") - F.col("from") + F.pmod(F.col("from") + F.col("shift"), F.lit(arity))).alias("to_idx"), "from", "sibling")
    met = nodes.join(sent, (F.col("tree") == F.col("to_tree")) & (F.col("idx") == F.col("to_idx")), "left")
    rest = [c for c in nodes.columns if c not in ("tree", "idx")]
    met = met.groupBy("tree", "idx").agg(*[F.first(c).alias(c) for c in rest], F.sort_array(F.collect_list(F.when(F.col("from").isNotNull(), F.struct("from", "sibling")))).alias("met"))
    joined = lambda some: F.aggregate(some, F.lit(b""), lambda done, x: F.concat(done, x["sibling"]))
    return met.select("tree", "idx", *rest, joined(F.filter("met", lambda x: x["from"] < slot)).alias("left"), joined(F.filter("met", lambda x: x["from"] > slot)).alias("right"))


def _levels(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """Stored levels of the trees, lowest first; a tree's last node, with n = 1, is in the level that it ends in."""
    levels = [stored(_with_siblings(leaves, arity), "level")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        node = F.unhex(F.sha2(F.concat(hex_of(F.col("left")), hex_of(F.col("digest")), hex_of(F.col("right"))), 256))
        parents = levels[-1].where((F.col("n") > 1) & (F.pmod("idx", F.lit(arity)) == 0)).select(
            "tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), node.alias("digest")
        )
        levels.append(stored(_with_siblings(parents, arity), "level"))
        most = -(-most // arity)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the node that each tree ends in."""
    tops = levels[0].where("n = 1").select("tree", "digest")
    for level in levels[1:]:
        tops = tops.union(level.where("n = 1").select("tree", "digest"))
    return tops


def _down(levels: list[DataFrame], crowns: DataFrame, arity: int) -> DataFrame:
    """The lowest level with what crowns (tree, ..., path) has of its tree; path starts with the node's own siblings."""
    crowns = crowns.withColumnRenamed("tree", "of_tree")
    given = [c for c in crowns.columns if c not in ("of_tree", "path")]
    above = None
    for level in reversed(levels):
        rest = level.columns
        here = level.where("n = 1").join(crowns, F.col("tree") == F.col("of_tree")).select(*rest, *given, "path")
        if above is not None:
            up = above.select(F.col("tree").alias("up_tree"), F.col("idx").alias("up"), *given, F.col("path").alias("higher"))
            inner = level.where("n > 1").withColumn("parent", F.expr(f"idx div {arity}")).join(up, (F.col("tree") == F.col("up_tree")) & (F.col("parent") == F.col("up")))
            here = here.union(inner.select(*rest, *given, F.concat(F.array(F.struct("left", "right")), "higher").alias("path")))
        above = here
    return above


def manifest(docs: DataFrame, fields: list[str], group: str, key: str, arity: int = 8, keep: dict[str, Column] | None = None) -> DataFrame:
    """key, leaf (32 bytes), subroot, root (hex) and proof of every row, and the columns of `keep`, worked out from docs.

    proof: array of (left, right), the siblings before and after at each level up to the root, 32 bytes each.
    """
    keep = keep or {}
    tree = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string"))).alias("tree")
    leaves = stored(docs.select(tree, F.col(key).alias("key"), leaf_of([F.col(c) for c in fields]).alias("digest"), *[c.alias(f"kept_{n}") for n, c in keep.items()]), "leaves")
    levels = _levels(_placed(leaves, ["key", "digest"]), arity)
    subroots = stored(_tops(levels).select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), "subroots")
    upper = _levels(_placed(subroots, ["of"]), arity)
    roots = _tops(upper).select("tree", hex_of(F.col("digest")).alias("root"), F.array().cast("array<struct<left:binary,right:binary>>").alias("path"))
    crowns = stored(_down(upper, roots, arity).select(F.col("of").alias("tree"), hex_of(F.col("digest")).alias("subroot"), "root", "path"), "crowns")
    found = _down(levels, crowns, arity)
    return found.select(F.col("key").alias(key), *[F.col(f"kept_{n}").alias(n) for n in keep], F.col("digest").alias("leaf"), "subroot", "root", F.col("path").alias("proof"))
