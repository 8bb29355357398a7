"""Document fingerprints: SimHash of weighted terms, and groups of near fingerprints by permuted block tables.

Terms are pairs of neighbouring words (and single words where a text has one only), A-Z lower-cased.
A term's 64-bit hash votes on each bit, for it or against it, with the number of letters of its words
as weight, so that function words count little. A bit is 1 where the votes are in its favour.
Equal texts have equal fingerprints; the likeness of two is the share of equal bits.

near_groups() cuts fingerprints into `blocks` blocks and keeps one table for each choice of blocks -
radius of them: two fingerprints within the radius agree on the chosen blocks in some table.

Scale: compare_with_edits() shuffles the texts once, by ranges of doc_id, and streams each partition in
order. Only the last document of a partition needs a text from another one; those few are joined
afterwards by partition number.

Edge cases: a null or empty text has no terms and fingerprint zero; repeated rows follow each other in
order of their text, null doc_ids come first; the document after the last is the first, so one
document alone follows itself; an empty table gives no rows; other columns are not read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modlake.llm.encode import own_texts
from modlake.llm.hamming import block_masks, near_classes
from modlake.llm.store import parts_for, stored, text_size

#: The most that a word weighs.
HEAVIEST = 12
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_arrays(texts: pa.Array, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, bytes, counts): hash and length of every word of the texts in a row, and words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(own_texts(texts)))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = coded.indices.to_numpy().astype(np.int64)
    counts = np.diff(offsets)
    real = sizes[codes] > 0  # empty pieces stand before and after white space at the ends
    if not real.all():
        counts = counts - np.bincount(np.repeat(np.arange(len(counts)), counts)[~real], minlength=len(counts))
        codes = codes[real]
    return hashes[codes], sizes[codes], counts


def voted(terms: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of texts whose terms stand in a row: bits where the weighted votes are in favour. Weights are uint8."""
    out = np.zeros(len(counts), np.uint64)
    holding = np.flatnonzero(counts)
    bounds = np.concatenate([[0], np.cumsum(counts[holding])])
    votes = np.zeros((len(holding), 64), np.int64)
    total = np.zeros(len(holding), np.int64)
    step = 1 << 16
    for a in range(0, len(terms), step):
        b = min(a + step, len(terms))
        bits = np.unpackbits(terms[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") * weights[a:b, None]
        first, last = np.searchsorted(bounds, a, "right") - 1, np.searchsorted(bounds, b, "left")
        cuts = np.maximum(bounds[first:last], a) - a
        votes[first:last] += np.add.reduceat(bits, cuts, axis=0, dtype=np.uint32)
        total[first:last] += np.add.reduceat(weights[a:b], cuts, dtype=np.uint32)
    ones = np.packbits(2 * votes > total[:, None], axis=1, bitorder="little")
    out[holding] = ones.view("<u8").ravel()
    return out


def fingerprints(texts: pa.Array) -> np.ndarray:
    """Unsigned 64-bit fingerprints of texts."""
    hashes, sizes, counts = word_arrays(texts)
    if not len(hashes):
        return np.zeros(len(counts), np.uint64)
    weights = np.minimum(sizes, HEAVIEST).astype(np.uint8)
    ends = np.cumsum(counts)
    starts = ends - counts
    # a term begins at each word but the last of its text, or is the only word
    begins = np.ones(len(hashes), bool)
    begins[ends[counts > 1] - 1] = False
    at = np.flatnonzero(begins)
    alone = np.zeros(len(hashes), bool)
    alone[starts[counts == 1]] = True
    after = np.minimum(at + 1, len(hashes) - 1)
    second = np.where(alone[at], np.uint64(0), hashes[after])
    terms = mixed(hashes[at] * MIX + second)
    heavy = weights[at] + np.where(alone[at], 0, weights[after]).astype(np.uint8)
    return voted(terms, heavy, np.where(counts > 1, counts - 1, counts))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - np.bitwise_count(a ^ b) / 64.0


def mark(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp) of each row; fp is the fingerprint as a signed long."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                yield pa.record_batch([b.column(0), pa.array(fingerprints(b.column(1)).view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(marks, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def near_groups(marked: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(fp, class_id) for each distinct fingerprint of marked (doc_id, fp): the smallest doc_id it can reach."""
    return near_classes(marked, block_masks(radius, blocks), radius)


COMPARED = "n_chars long, edited_sha256 string, fp long, edited_fp long, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """Columns of COMPARED; following: the text after each."""
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, following)]
    own, other = fingerprints(pa.array(texts, pa.string())), fingerprints(pa.array(edited, pa.string()))
    beside = fingerprints(pa.array(following, pa.string())) if following[:-1] != texts[1:] else np.concatenate([own[1:], fingerprints(pa.array(following[-1:], pa.string()))])
    return [
        pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
        pa.array(own.view(np.int64)), pa.array(other.view(np.int64)), pa.array(likeness(own, other)), pa.array(likeness(own, beside)),
    ]


def compare_with_edits(docs: DataFrame, part_bytes: int = 16 << 20, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and COMPARED for each row: its fingerprint beside that of its edited text and of the next row.

    The edited text has the last half of the code points (rounded down) replaced by as many of the
    first ones of the next text in ascending doc_id order.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # by the beginning of the text too, so that rows of one id need not be one part
    ordered = rows.repartitionByRange(parts_for(text_size(rows)[1], part_bytes), F.col("doc_id"), F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    names = ["doc_id", *(c.split()[0] for c in COMPARED.split(", ")), "part", "edge", "text"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, first = TaskContext.get().partitionId(), None, True
        type_of = pa.int64()

        def edge(key, what: str, content: str) -> pa.RecordBatch:
            n = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            return pa.record_batch([pa.array([key], type_of), *n, pa.array([part], pa.int64()), pa.array([what]), pa.array([content], pa.string())], names=names)

        for batch in batches:
            type_of = batch.column(0).type
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
                if first:
                    yield edge(ids[0], "first", texts[0])
                    first = False
                if waiting is not None:
                    ids, texts = [waiting[0], *ids], [waiting[1], *texts]
                waiting = (ids[-1], texts[-1])
                if len(ids) > 1:
                    out = _compared(ids[:-1], texts[:-1], texts[1:])
                    n = len(ids) - 1
                    yield pa.record_batch([pa.array(ids[:-1], type_of), *out, pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names=names)
        if waiting is not None:
            yield edge(waiting[0], "last", waiting[1])

    both = stored(ordered.mapInArrow(stream, f"doc_id {kind}, {COMPARED}, part long, edge string, text string"), "compared")
    firsts = both.where("edge = 'first'").select("part", F.col("text").alias("following"))
    # one number a partition; the partition after the last is the first
    order = Window.orderBy("part")
    after = firsts.select("part").withColumn("then", F.lead("part").over(order))
    lowest = firsts.agg(F.min("part").alias("lowest"))
    after = after.crossJoin(F.broadcast(lowest)).select(F.col("part").alias("of"), F.coalesce("then", "lowest").alias("then"))
    lasts = both.where("edge = 'last'").select("doc_id", "text", "part")
    pairs = lasts.join(after, lasts["part"] == after["of"]).join(firsts.withColumnRenamed("part", "p"), F.col("then") == F.col("p")).select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                out = _compared([None], [b.column(1)[k].as_py()], [b.column(2)[k].as_py()])
                yield pa.record_batch([b.column(0).slice(k, 1), *out], names=names[:-3])

    ended = pairs.mapInArrow(finish, f"doc_id {kind}, {COMPARED}")
    return both.where("edge IS NULL").select(ended.columns).union(ended)
