"""Packing of documents into sequences of bounded length by order-preserving dynamic programming.

The documents of a partition, in the order in which they stand there, are one stream of ids. Windows
of at most `length` ids are cut from it. A cut costs nothing at the end of a document, `sentence_cost`
at the end of a sentence, `inner_cost` within one (possible every length / 64 ids), and a window costs its padding; the plan with the least total is found with a monotone queue, in time
linear in the number of possible cuts: the best predecessor of cut j is the least f[i] + pos[i] among
cuts at most `length` ids before it. What remains at the end of a partition is cut at powers of two,
which need no padding.

Scale: there is no shuffle; a task streams its partition and holds `segment` ids at a time. Sequence
ids hold the partition number, so they are unique without any exchange between tasks.

Edge cases: a null or empty text is the end id alone; a document longer than a window spans several;
repeated rows are packed as they come; an empty table gives no rows. A retried task gives the same
sequences if its partition comes in the same order, as that of a table scan does.
"""

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modlake.llm.encode import encoder, text_slices, with_end

PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def best_cuts(positions: list[int], costs: list[int], length: int, total: int, last: bool) -> list[int]:
    """Positions of the chosen cuts, in order; positions ascend from above 0, no gap over `length`.

    If last, the ids after the final cut are fewer than a window and left to the caller; else too,
    but they come again with what follows. So the plan ends at the cheapest cut within a window of the end.
    """
    pos, f, parent = [0, *positions], [0], [0]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (f + pos, index), ascending
    for j in range(1, len(pos)):
        here = pos[j]
        while pos[queue[0][1]] < here - length:
            queue.popleft()
        least, i = queue[0]
        cost = least + length - here + costs[j - 1]
        f.append(cost)
        parent.append(i)
        cost += here
        while queue and queue[-1][0] > cost:
            queue.pop()
        queue.append((cost, j))
    ends = [j for j in range(len(pos)) if total - pos[j] < length]
    # the rest counts as if it were full, so of equal plans the longer one wins
    j = min(ends, key=lambda j: (f[j] + pos[j], -pos[j]))
    cuts = []
    while j:
        cuts.append(pos[j])
        j = parent[j]
    return cuts[::-1]


def possible_cuts(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray, length: int, sentence_cost: int, inner_cost: int) -> tuple[list[int], list[int]]:
    cost = np.full(len(ids) + 1, -1, np.int64)
    cost[1:][stops[ids]] = sentence_cost
    cost[doc_ends] = 0
    at = np.flatnonzero(cost[1:] >= 0) + 1
    gaps = np.diff(np.concatenate([[0], at, [len(ids)]]))
    step = max(1, length // 64)
    for k in np.flatnonzero(gaps > step):
        begin = at[k - 1] if k else 0
        inner = np.arange(begin + step, begin + gaps[k], step)
        cost[inner] = np.where(cost[inner] < 0, inner_cost, cost[inner])
    at = np.flatnonzero(cost[1:] >= 0) + 1
    return at.tolist(), cost[at].tolist()


def powers_of_two(start: int, n: int) -> list[int]:
    """Ends of windows of falling powers of two that hold n ids from start on."""
    ends, at = [], start
    for k in range(n.bit_length() - 1, -1, -1):
        if n >> k & 1:
            at += 1 << k
            ends.append(at)
    return ends


def pack(
    docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2, sentence_cost: int = 16, inner_cost: int = 256,
    segment: int = 1 << 19, text: str = "text", doc_id: str = "doc_id", times: float = 2, slice_bytes: int = 4 << 20,
) -> DataFrame:
    """One row for each piece of a document: doc_id and PIECES; ids are little-endian 32-bit.

    start counts the ids of the document before the piece, offset those of the sequence. The memory of a task follows
    the words that it remembers (times the usual number) and the bytes of text that it encodes at once; ids are the same
    whatever these are, and cuts can move only with the bytes, as a plan is made whenever `segment` ids wait.
    """
    if length & (length - 1):
        raise ValueError("length has to be a power of two")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, times)  # most of the time goes into words that are new
        vocabulary = enc.tok.get_vocab(with_added_tokens=False)
        stops = np.zeros(max(enc.size, end_id + 1), bool)
        stops[[i for s, i in vocabulary.items() if s.removesuffix("</w>")[-1:] in (".", "!", "?")]] = True
        sequence = (TaskContext.get().partitionId() << 33) - 1
        # waiting ids, and of each waiting document: id, place of its first waiting id, ids before that, all ids
        wait, known, at, before, whole = np.zeros(0, np.uint32), [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def flush(last: bool) -> pa.RecordBatch | None:
            nonlocal wait, known, at, before, whole, sequence
            ends = np.concatenate([at[1:], [len(wait)]])
            cuts = best_cuts(*possible_cuts(wait, ends, stops, length, sentence_cost, inner_cost), length, len(wait), last)
            if last:
                done = cuts[-1] if cuts else 0
                cuts += powers_of_two(done, len(wait) - done)
            if not cuts:
                return None
            done = cuts[-1]
            windows = np.array([0, *cuts[:-1]], np.int64)
            begins = np.union1d(windows, at[at < done])
            stop = np.append(begins[1:], done)
            doc = np.searchsorted(at, begins, "right") - 1
            window = np.searchsorted(windows, begins, "right") - 1
            out = pa.record_batch(
                [
                    pa.array([known[d] for d in doc.tolist()], type_of[0]), pa.array(begins - at[doc] + before[doc]), pa.array(stop - begins),
                    pa.array([wait[a:b].astype("<u4").tobytes() for a, b in zip(begins.tolist(), stop.tolist())], pa.binary()),
                    pa.array(whole[doc]), pa.array(sequence + 1 + window), pa.array(begins - windows[window]),
                ],
                names=["doc_id", *(x.split()[0] for x in PIECES.split(", "))],
            )
            sequence += len(cuts)
            # what comes after the last cut waits; its first document may have begun before
            first = int(np.searchsorted(at, done, "right")) - 1
            keep = first if ends[first] > done else first + 1
            known, whole = known[keep:], whole[keep:]
            before = np.where(at < done, done - at + before, before)[keep:]
            at = np.maximum(at - done, 0)[keep:]
            wait = wait[done:]
            return out

        type_of: list[pa.DataType] = []
        for batch in batches:
            type_of[:] = [batch.column("doc_id").type]
            for part in text_slices(batch, size=slice_bytes):
                ids, offsets = with_end(*enc.encode(part.column("text")), end_id)
                at = np.concatenate([at, offsets[:-1] + len(wait)])
                before = np.concatenate([before, np.zeros(len(offsets) - 1, np.int64)])
                whole = np.concatenate([whole, np.diff(offsets)])
                known = known + part.column("doc_id").to_pylist()
                wait = np.concatenate([wait, ids])
                if len(wait) >= segment and (out := flush(False)) is not None:
                    yield out
        if len(wait) and (out := flush(True)) is not None:
            yield out

    return rows.mapInArrow(pieces, f"doc_id {kind}, {PIECES}")
