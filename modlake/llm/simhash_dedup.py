"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprint: words of the text with A-Z lower-cased, shingles of `width` words, XXH64 (seed 42) of each
shingle, repeats included; a bit is 1 if set in over half of the hashes. Fingerprints at `radius` or
fewer differing bits are linked, candidates coming from covering masks (hamming.covering_masks), so
every such pair meets in some table; documents are grouped by connected component.

drop_near_copies() is to find all pairs with a Jaccard similarity of 0.8 or more on five-word shingles. Its
first candidates are fingerprints of the distinct words of a text, weighted by length, within `radius` bits by
covering masks. Many such pairs are farther apart; the exact prefix-filter join of `similar` finds those. Every
link, of whichever search, is verified by the shingles themselves before components are formed.

Scale: near_components() reads texts once and never shuffles them; after that only distinct fingerprints
move, 16 bytes for each of the 2^(radius+1) - 1 tables. drop_near_copies() also moves the prefix, a fifth of
the shingles of each text, and the shingle sets of the candidates.

Edge cases: a null, empty or blank text has fingerprint zero and is linked like any other; fewer words
than a shingle make one shingle; repeated rows have one fingerprint each and share a component.
"""

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modlake.llm.fingerprints import voted, word_arrays
from modlake.llm.hamming import bucket_keys, covering_masks, near_classes, slices
from modlake.llm.similar import frequent, lists, nodes_of, parities, prefixes, shingle_sets, similar_components
from modlake.llm.store import free_name, stored

SEED = 42
#: Texts of fewer words have no near copies at a similarity of 0.8 but those that differ at the ends.
SHORT = 24


def fingerprint(text: bytes, width: int) -> int:
    """Of a text with A-Z lower-cased already."""
    words = text.split()  # bytes split at ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, SEED)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a : b - 1], SEED) for a, b in zip(starts, starts[width:])], np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        votes += np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def simhash(docs: DataFrame, width: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp) of each row; fp is the fingerprint as a signed long."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lowered = pc.ascii_lower(pc.fill_null(b.column(1), ""))
            fps = [fingerprint(t, width) for t in lowered.cast(pa.binary()).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(marks, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def word_fingerprints(texts: pa.Array, words: tuple | None = None) -> np.ndarray:
    """Unsigned fingerprints by the distinct words of each text, or by the whole of a short text."""
    hashes, sizes, counts = words or word_arrays(texts, SEED)
    doc = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, doc))
    h, d, n = hashes[order], doc[order], sizes[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    new &= counts[d] >= SHORT
    # function words are short in most languages and say little
    weights = np.clip(n[new] - 3, 1, 9).astype(np.uint8)
    out = voted(h[new], weights, np.bincount(d[new], minlength=len(counts)))
    for k in np.flatnonzero((counts > 0) & (counts < SHORT)):
        out[k] = xxhash.xxh64_intdigest(hashes[counts[:k].sum() :][: counts[k]].tobytes(), SEED)
    return out


def simhash_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp) of each row by word_fingerprints."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            yield pa.record_batch([b.column(0), pa.array(word_fingerprints(b.column(1)).view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(marks, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def near_components(docs: DataFrame, width: int = 4, radius: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, component_id) of each row, by shingles of `width` words; by distinct words if that is 0."""
    marks = simhash(docs, width, text, doc_id) if width else simhash_words(docs, text, doc_id)
    marked = stored(marks, "simhash")
    classes = near_classes(marked, covering_masks(radius), radius)
    return marked.join(classes, "fp").select("doc_id", "fp", F.col("class_id").alias("component_id"))


def marked_rows(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, node, n, fp, keys, bits, low) of rows (doc_id, text, row): set of shingles, its size, fingerprint, prefix and parity bits."""
    hot, ranks = frequent(rows)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            words = word_arrays(b.column(1), SEED)
            found, sizes = shingle_sets(words[0], words[2])
            if width:
                lowered = pc.ascii_lower(pc.fill_null(b.column(1), "")).cast(pa.binary())
                fps = np.array([fingerprint(t, width) for t in lowered.to_pylist()], np.uint64)
            else:
                fps = word_fingerprints(b.column(1), words)
            columns = [b.column(0), b.column(2), pa.array(nodes_of(found, sizes)), pa.array(sizes), pa.array(fps.view(np.int64)), lists(*prefixes(found, sizes, hot, ranks)), *parities(found, sizes)]
            yield pa.record_batch(columns, names=["doc_id", "row", "node", "n", "fp", "keys", "bits", "low"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.select("doc_id", "text", "row").mapInArrow(marks, f"doc_id {kind}, row long, node long, n long, fp long, keys array<long>, bits array<long>, low array<long>"), "simhash")


def likely_pairs(nodes: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """(a, b) of nodes (node, fp): each beside the smallest fingerprint of its buckets, if within the radius."""
    fps = stored(nodes.groupBy("fp").agg(F.min("node").alias("rep")), "fps")
    keys = bucket_keys(fps.select("fp"), masks)
    shared = keys.groupBy("k").agg(F.min("fp").alias("hub"), F.max("fp").alias("top")).where("hub < top").select("k", "hub")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= radius
    pairs = keys.join(stored(shared, "shared"), "k").where((F.col("fp") != F.col("hub")) & near).select("fp", "hub").distinct()
    pairs = pairs.join(fps.toDF("fp", "a"), "fp").join(fps.toDF("hub", "b"), "hub").select("a", "b")
    return stored(pairs.union(nodes.join(fps, "fp").where("node <> rep").select("rep", "node")), "likely")


def drop_near_copies(docs: DataFrame, width: int = 0, radius: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with one row of each component of near copies, that with the smallest doc_id; all columns as they are.

    Only the texts decide which rows are near copies: rows with one doc_id but different texts, or without a
    doc_id, are compared like any other. Null ids come after all others; of rows with one doc_id the
    one with the smallest hash stays, of rows with the same doc_id and text any.
    """
    row = F.xxhash64(doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), row.alias("row"))
    marked = marked_rows(rows, width)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    nodes = stored(marked.groupBy("node").agg(F.min("row").alias("row"), F.min("n").alias("n"), F.min("fp").alias("fp"), F.min("bits").alias("bits"), F.min("low").alias("low"), first.alias("first")), "nodes")
    likely = likely_pairs(nodes, covering_masks(radius), radius)
    roots = similar_components(marked, nodes, rows, likely)
    grouped = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    k, h = free_name("stays", docs.columns), free_name("hash", docs.columns)
    stay = stored(grouped.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias(k), F.col("first.row").alias(h)), "stay")
    here = (row == F.col(h)) & F.col(doc_id).eqNullSafe(F.col(k))
    kept = docs.join(stay, here, "left_semi")
    again = stored(marked.groupBy(F.col("doc_id").alias(k), F.col("row").alias(h)).count().where("count > 1").select(k, h), "again")
    if again.isEmpty():
        return kept
    once = kept.join(again, here, "left_semi").withColumn(h, row).dropDuplicates([doc_id, h]).drop(h)
    return kept.join(again, here, "left_anti").unionByName(once)


def hex_fingerprint(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
