"""Token ids in binary files of fixed-width codes, written in document order and read back.

File format (little-endian), one file for each stretch of documents:

    blocks        each of `block` ids, bit-packed least significant bit first in `bits` bits an id,
                  filled up to a whole byte
    doc ids       n_docs * int64
    doc nulls     n_docs bits, filled up to a whole byte: set where the document has no id
    doc starts    n_docs + 1 * uint64, the first id of each document, and the number of ids
    block offsets n_blocks + 1 * uint64, the byte at which each block begins, and the end of the last
    footer        7 * uint64: magic, bits, block, n_docs, n_ids, n_blocks, payload bytes

`bits` is the least width that holds the vocabulary. Block offsets give random access: read_ids() reads
only the footer, one table and the blocks that hold the ids asked for. A block is unpacked with numpy
at once.

Scale: one range shuffle of the texts by doc_id; each task then writes its stretch in files of about
`file_ids` ids, under names of the attempt's own, via a temporary name. One row a file goes to the manifest, which
names the files that count, gives each file's first id, and leaves out what a lost attempt has written.

Edge cases: a null or empty text is its end id alone; null doc_ids come first and read back as null; doc_ids
have to be whole numbers, others are refused; repeated rows follow each other, in order of their text; an empty
table has no files and reads back without rows; columns beside the two named are not read.
"""

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modlake.llm.encode import encoder, text_slices, with_end
from modlake.llm.store import new_path, parts_for, stored, text_size

MAGIC = int.from_bytes(b"IDPACK02", "little")
MANIFEST = "file string, part long, no long, n_docs long, n_ids long"


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):  # whole bytes: the same layout
        return ids.astype(f"<u{bits // 8}").tobytes()
    rows = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(rows[:, :bits].ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    rows = np.zeros((n, 32), np.uint8)
    rows[:, :bits] = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    return np.packbits(rows, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


def file_bytes(doc_ids: np.ndarray, nulls: np.ndarray, starts: np.ndarray, ids: np.ndarray, bits: int, block: int) -> bytes:
    blocks = [pack_bits(ids[a : a + block], bits) for a in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    footer = struct.pack("<7Q", MAGIC, bits, block, len(doc_ids), len(ids), len(blocks), int(offsets[-1]))
    return b"".join([*blocks, doc_ids.astype("<i8").tobytes(), np.packbits(nulls, bitorder="little").tobytes(), starts.astype("<u8").tobytes(), offsets.tobytes(), footer])


def tables_at(payload: int, n_docs: int) -> tuple[int, int]:
    """Where the doc starts and the block offsets of a file begin."""
    starts = payload + 8 * n_docs + (n_docs + 7) // 8
    return starts, starts + 8 * (n_docs + 1)


def parse(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, nulls, starts, ids) of a whole file."""
    magic, bits, block, n_docs, n_ids, n_blocks, payload = struct.unpack("<7Q", content[-56:])
    if magic != MAGIC:
        raise ValueError("not a file of packed ids")
    doc_ids = np.frombuffer(content, "<i8", n_docs, payload)
    nulls = np.unpackbits(np.frombuffer(content, np.uint8, (n_docs + 7) // 8, payload + 8 * n_docs), bitorder="little", count=n_docs).astype(bool)
    at, table = tables_at(payload, n_docs)
    starts = np.frombuffer(content, "<u8", n_docs + 1, at).astype(np.int64)
    offsets = np.frombuffer(content, "<u8", n_blocks + 1, table).astype(np.int64)
    view = memoryview(content)
    parts = [unpack_bits(view[offsets[k] : offsets[k + 1]], bits, min(block, n_ids - k * block)) for k in range(n_blocks)]
    return doc_ids, nulls, starts, np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def read_ids(path: str, start: int, n: int) -> np.ndarray:
    """Ids start to start + n of a file, reading only the blocks that hold them."""
    system, name = pafs.FileSystem.from_uri(path)
    with system.open_input_file(name) as f:
        end = f.size()
        magic, bits, block, n_docs, n_ids, n_blocks, payload = struct.unpack("<7Q", f.read_at(56, end - 56))
        if magic != MAGIC or start < 0 or start + n > n_ids:
            raise ValueError("no such ids")
        first, last = start // block, -(-(start + n) // block)
        table = tables_at(payload, n_docs)[1]
        offsets = np.frombuffer(f.read_at(8 * (last - first + 1), table + 8 * first), "<u8").astype(np.int64)
        data = f.read_at(int(offsets[-1] - offsets[0]), int(offsets[0]))
        parts = [
            unpack_bits(data[offsets[k] - offsets[0] : offsets[k + 1] - offsets[0]], bits, min(block, n_ids - (first + k) * block)) for k in range(last - first)
        ]
    return np.concatenate([np.zeros(0, np.uint32), *parts])[start - first * block :][:n]


def write_tokens(
    docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2, block: int = 4096, file_ids: int = 4 << 20,
    part_bytes: int = 16 << 20, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """Write the ids of docs in ascending doc_id order below folder (a URI); the manifest, with first_id."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "ids")
    if docs.schema[doc_id].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{doc_id} has to be a whole number")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n = parts_for(text_size(rows)[1], part_bytes)
    # by the beginning of the text too, so that rows of one id need not be one part
    ordered = rows.repartitionByRange(n, F.col("doc_id"), F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        bits = width(max(enc.size, end_id + 1))
        system, base = pafs.FileSystem.from_uri(folder)
        attempt = TaskContext.get().taskAttemptId()
        held: list[tuple[np.ndarray, ...]] = []  # doc ids, whether they are null, lengths, ids
        no = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, no, size
            doc_ids, nulls, lengths, ids = (np.concatenate(x) for x in zip(*held))
            # a name of this attempt's own: no store has to replace what a lost attempt has left, and the manifest names the one that counts
            name = f"part-{part:07d}-{no:05d}-{attempt}.ids"
            system.create_dir(base, recursive=True)
            with system.open_output_stream(f"{base}/_{name}") as f:
                f.write(file_bytes(doc_ids, nulls, np.concatenate([[0], np.cumsum(lengths)]), ids, bits, block))
            system.move(f"{base}/_{name}", f"{base}/{name}")
            row = pa.record_batch([[name], [part], [no], [len(doc_ids)], [len(ids)]], names=[x.split()[0] for x in MANIFEST.split(", ")])
            held, no, size = [], no + 1, 0
            return row

        for batch in batches:
            for x in text_slices(batch):
                ids, offsets = with_end(*enc.encode(x.column("text")), end_id)
                keys = x.column("doc_id")
                held.append((keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False), np.diff(offsets), ids))
                size += len(ids)
                if size >= file_ids:
                    yield flush()
        if held:
            yield flush()

    manifest = stored(ordered.mapInArrow(write, MANIFEST), "manifest").withColumn("file", F.concat(F.lit(folder + "/"), "file"))
    # one row a file, so one task for their running sum is no bottleneck
    earlier = Window.orderBy("part", "no").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).cast("long"))


def read_tokens(spark: SparkSession, manifest: DataFrame, max_broadcast_files: int = 200_000) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document in the files; ids as little-endian 32-bit."""
    schema = "doc_id long, start long, n_tokens long, ids binary"
    folder = manifest.select(F.regexp_extract("file", "^(.*)/[^/]*$", 1).alias("folder")).first()
    if folder is None:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.ids").load(folder["folder"])
    firsts = manifest.select(F.element_at(F.split("file", "/"), -1).alias("name"), "first_id")
    # the ids stay where they were unpacked as long as a row of some 60 bytes a file fits everywhere
    few = manifest.count() <= max_broadcast_files

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
                doc_ids, nulls, starts, ids = parse(content.as_py())
                for a in range(0, len(doc_ids), 1024):
                    s = starts[a : a + 1025]
                    data = [ids[x:y].astype("<u4").tobytes() for x, y in zip(s[:-1].tolist(), s[1:].tolist())]
                    keys = doc_ids[a : a + 1024]
                    yield pa.record_batch(
                        [pa.array([name] * len(data)), pa.array(keys, pa.int64(), mask=nulls[a : a + 1024]), pa.array(s[:-1]), pa.array(np.diff(s)), pa.array(data, pa.binary())],
                        names=["name", "doc_id", "start", "n_tokens", "ids"],
                    )

    content = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    local = content.mapInArrow(documents, f"name string, {schema}")
    return local.join(F.broadcast(firsts) if few else firsts, "name").select("doc_id", (F.col("start") + F.col("first_id")).alias("start"), "n_tokens", "ids")
