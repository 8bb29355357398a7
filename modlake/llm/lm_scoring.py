"""Language-model scoring by deleted interpolation of n-gram estimates.

The model mixes maximum-likelihood estimates of orders 0 (uniform over the vocabulary and one unknown
word) to n. The weights of a mixture belong to a bucket of context frequency (powers of two of the
count of the longest context), and are learned by expectation-maximisation on counts of a deleted
part of the training rows, against estimates from the kept part. Final estimates use all training
rows. Tokens are words between ASCII white space, A-Z lower-cased, then one end of text.

How it runs. Each task turns the texts of its partition into blocks of about BLOCK token numbers, so no
text is shuffled. A block sends the sorted 64-bit hashes of its distinct n-grams, in slices by hash range,
to the task that adds up that range over all blocks; the answer comes back as plain arrays of totals in the
order of the question. Two things keep this small without changing a count:

- the most frequent n-grams of a bounded sample, HOT of an order at most, are counted apart: each block adds
  up its own, and Spark sums these with partial results; so no hash range holds an n-gram of all blocks;
- an n-gram of order 3 or more is asked for only if both n-grams of one word less within it occur in other
  blocks too; else all its occurrences are here, and its count is known.

Counts and vocabulary cover every training row; nothing is pruned. EM reads the probabilities of the deleted
part, as 32-bit floats, from a table, a Spark job a round; the driver sees sums by bucket and order only.

Edge cases: a null text is an empty one, which is one token, the end; a null id counts as the empty
string for the split; repeated rows count and score each by itself; without training rows every word
is unknown and orders above 0 have weight 0; an empty table gives no rows; other columns are not read.
"""

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.llm.encode import text_slices
from modlake.llm.fingerprints import MIX, mixed, word_arrays
from modlake.llm.store import dropped, parts_for, stored, text_size

HELD_OUT, DELETED, KEPT = 0, 1, 2
SEED = 1
END = np.uint64(xxhash.xxh64_intdigest(b"", SEED))
#: Buckets of context frequency: 0, 1, 2-3, 4-7, ... and all above.
BUCKETS = 24
#: Tokens of a block, and n-grams of a hash range that one task adds up.
BLOCK, RANGE = 3 << 18, 3 << 18
#: Frequent n-grams of an order that are counted apart, and bytes of text that tell which they are.
HOT, SAMPLE = 1 << 15, 16 << 20
#: EM ends when no weight moves by more, or after so many rounds.
SETTLED, ROUNDS = 1e-3, 40


def split_of(doc_id: Column) -> Column:
    """HELD_OUT where crc32(id as text) mod 10 is 0; a tenth of the rest is DELETED, the others KEPT."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.when(crc % 10 == 0, HELD_OUT).when(F.floor(crc / 10) % 10 == 0, DELETED).otherwise(KEPT)


def squeezed(values: np.ndarray) -> bytes:
    """An array byte by byte over all values, so that high bytes compress away."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unsqueezed(data: bytes, kind: str = "<u8") -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, kind)
    raw = pa.decompress(data[8:], decompressed_size=n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, sizes): hashes of the tokens of the texts in a row, and how many each text has, ends included."""
    hashes, _, counts = word_arrays(texts, SEED)
    tokens = np.full(len(hashes) + len(counts), END, np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[np.cumsum(counts + 1) - 1] = False
    tokens[inner] = hashes
    return tokens, counts + 1


class Grams:
    """The n-grams that end at each token of texts in a row, and the distinct ones of each order."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, order: int):
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        grams, begun = tokens, np.uint64(7)
        self.orders = [tokens]
        for _ in range(1, order):
            before = np.empty_like(grams)
            before[1:] = grams[:-1]
            before[self.starts] = begun
            begun = mixed(np.array([begun], np.uint64) * MIX + np.uint64(9))[0]
            grams = mixed(before * MIX + tokens)
            self.orders.append(grams)

    @cached_property
    def keys(self) -> list[tuple[np.ndarray, ...]]:
        """For each order the sorted distinct n-grams, the place of one of each, the number at each token, and counts."""
        return [np.unique(g, return_index=True, return_inverse=True, return_counts=True) for g in self.orders]


def frequent(rows: DataFrame, order: int, size: int) -> list[np.ndarray]:
    """The sorted hashes of the n-grams of each order that a sample of rows (text) holds most often, HOT at most."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch):
                for k, (found, _, _, n) in enumerate(Grams(*tokens_of(b.column("text")), order).keys):
                    yield pa.record_batch([pa.array(np.full(len(found), k, np.int64)), pa.array(found.view(np.int64)), pa.array(n)], names=["k", "gram", "n"])

    some = rows.where(F.rand(1) < min(1.0, SAMPLE / max(1, size))).select("text").mapInArrow(counts, "k long, gram long, n long")
    many = some.groupBy("k", "gram").agg(F.sum("n").alias("n")).where("n >= 16")
    top = [many.where(F.col("k") == k).orderBy(F.desc("n"), "gram").limit(HOT).select("gram").toArrow() for k in range(order)]
    return [np.sort(t.column("gram").to_numpy().astype(np.int64).view(np.uint64)) for t in top]


BLOCKS = "block long, kind int, ids array<{}>, n_docs long, n_tokens long, sizes binary, words binary, codes binary, hot binary"


def blocks_of(rows: DataFrame, order: int, hot: list[np.ndarray]) -> DataFrame:
    """BLOCKS of rows (doc_id, text, kind): texts of one kind as numbers of distinct words, and counts of the hot n-grams."""
    kind_of = rows.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {HELD_OUT: [], DELETED: [], KEPT: []}
        size, number = dict.fromkeys(held, 0), TaskContext.get().partitionId() << 33

        def flush(kind: int) -> pa.RecordBatch:
            nonlocal number
            ids, tokens, sizes = zip(*held[kind])
            held[kind], size[kind] = [], 0
            tokens, sizes = np.concatenate(tokens), np.concatenate(sizes)
            words, codes = np.unique(tokens, return_inverse=True)
            ids = pa.concat_arrays(ids)
            counted = [np.zeros(0, np.int64)]
            for grams, known in zip(Grams(tokens, sizes, order).orders, hot):
                if len(known):
                    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                    counted.append(np.bincount(at[known[at] == grams], minlength=len(known)))
            number += 1
            columns = [
                pa.array([number]), pa.array([kind], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([len(ids)]), pa.array([len(tokens)]),
                *(pa.array([squeezed(x)], pa.binary()) for x in (sizes.astype("<u4"), words, codes.astype("<u4"), np.concatenate(counted).astype("<u8"))),
            ]
            return pa.record_batch(columns, names=[c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            for kind in held:
                for b in text_slices(batch.filter(pc.equal(batch.column("kind"), kind))):
                    tokens, sizes = tokens_of(b.column("text"))
                    held[kind].append((b.column("doc_id"), tokens, sizes))
                    size[kind] += len(tokens)
                    if size[kind] >= BLOCK:
                        yield flush(kind)
        for kind in held:
            if held[kind]:
                yield flush(kind)

    return stored(rows.mapInArrow(blocks, BLOCKS.format(kind_of)), "blocks")


class Block:
    """One row of BLOCKS with its n-grams."""

    def __init__(self, row: dict, order: int):
        self.kind = row["kind"]
        self.grams = Grams(unsqueezed(row["words"])[unsqueezed(row["codes"], "<u4")], unsqueezed(row["sizes"], "<u4").astype(np.int64), order)

    def wanted(self, k: int, hot: list[np.ndarray], elsewhere: np.ndarray | None) -> np.ndarray:
        """Which distinct n-grams of order k + 1 other blocks may hold too; elsewhere says it of those of order k."""
        keys, first, _, _ = self.grams.keys[k]
        asked = ~np.isin(keys, hot[k], assume_unique=True)
        if k >= 2:
            number = self.grams.keys[k - 1][2]
            before = np.ones(len(number), bool)
            before[1:] = elsewhere[number[:-1]]
            before[self.grams.starts] = True
            asked &= elsewhere[number[first]] & before[first]
        return asked

    def totals(self, answers: dict[str, dict[int, bytes]], upto: int, ranges: list[int], hot: list[np.ndarray], hot_totals: dict[str, list[np.ndarray]], column: str = "all") -> tuple[list[np.ndarray], np.ndarray]:
        """(totals, elsewhere): for each order up to `upto` the totals of its distinct n-grams in all training text, or
        in the kept part; and which of the last order occur in other blocks."""
        out: list[np.ndarray] = []
        elsewhere = None
        for k in range(upto):
            keys, _, _, counts = self.grams.keys[k]
            asked = np.flatnonzero(self.wanted(k, hot, elsewhere))
            of = (np.unique(range_of(keys[asked], ranges[k])) + RANGES_OF_ORDER * k).tolist()
            # what is not asked for occurs nowhere else
            total = counts.astype(np.float64) if column == "all" and self.kind != HELD_OUT else np.zeros(len(keys))
            elsewhere = np.zeros(len(keys), bool)
            if len(hot[k]):
                at = np.minimum(np.searchsorted(hot[k], keys), len(hot[k]) - 1)
                known = hot[k][at] == keys
                total[known] = hot_totals[column][k][at[known]]
                elsewhere[known] = True
            if len(asked):
                total[asked] = np.concatenate([unsqueezed(answers[column][r]) for r in of])
                elsewhere[asked] = np.concatenate([unsqueezed(answers["elsewhere"][r], "<u1") for r in of]).astype(bool)
            out.append(total)
        return out, elsewhere


#: Ranges of one order are numbered from a multiple of this.
RANGES_OF_ORDER = 1 << 40


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys >> np.uint64(64 - (ranges.bit_length() - 1))).astype(np.int64) if ranges > 1 else np.zeros(len(keys), np.int64)


ASKED = "range long, block long, kind int, keys binary, counts binary"
ANSWERED = "block long, range long, kept binary, all binary, elsewhere binary, n_kept long, n_all long, v_kept long, v_all long"


def _questions(number: int, block: Block, asked: list[tuple[int, np.ndarray]], ranges: list[int]) -> pa.Table:
    rows: dict[str, list] = {"range": [], "block": [], "kind": [], "keys": [], "counts": []}
    for k, which in asked:
        keys, counts = block.grams.keys[k][0][which], block.grams.keys[k][3][which]
        found, begin = np.unique(range_of(keys, ranges[k]), return_index=True)
        for r, a, b in zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(keys)]):
            rows["range"].append(r + RANGES_OF_ORDER * k)
            rows["block"].append(number)
            rows["kind"].append(block.kind)
            rows["keys"].append(squeezed(np.diff(keys[a:b], prepend=np.uint64(0))))
            rows["counts"].append(squeezed(counts[a:b].astype("<u8")))
    types = {"range": pa.int64(), "block": pa.int64(), "kind": pa.int32(), "keys": pa.binary(), "counts": pa.binary()}
    return pa.table({n: pa.array(v, types[n]) for n, v in rows.items()})


def answer_range(key: tuple, group: pa.Table) -> pa.Table:
    """The totals of a hash range over all blocks: to each block, those of the n-grams that it asked for."""
    of, blocks, kinds = key[0].as_py(), group.column("block").to_pylist(), group.column("kind").to_numpy()
    keys = [np.cumsum(unsqueezed(k), dtype=np.uint64) for k in group.column("keys").to_pylist()]
    counts = np.concatenate([unsqueezed(c) for c in group.column("counts").to_pylist()]).astype(np.float64)
    sizes = [len(k) for k in keys]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    kind = np.repeat(kinds, sizes)
    kept = np.bincount(inverse, np.where(kind == KEPT, counts, 0), len(distinct))
    every = kept + np.bincount(inverse, np.where(kind == DELETED, counts, 0), len(distinct))
    others = np.bincount(inverse, minlength=len(distinct)) > 1  # a block sends an n-gram once
    edges = [0, *np.cumsum(sizes).tolist()]
    rows: dict[str, list] = {"block": blocks + [-1], "range": [of] * (len(blocks) + 1), "kept": [], "all": [], "elsewhere": []}
    for b, x, y in zip(kinds.tolist(), edges, edges[1:]):
        to = inverse[x:y]
        rows["elsewhere"].append(squeezed(others[to].astype("<u1")))
        rows["kept"].append(squeezed(kept[to].astype("<u8")) if b == DELETED else None)
        rows["all"].append(squeezed(every[to].astype("<u8")))
    sums = [int(kept.sum()), int(every.sum()), int((kept > 0).sum()), int((every > 0).sum())] if of < RANGES_OF_ORDER else [0] * 4
    for name, value in zip(("n_kept", "n_all", "v_kept", "v_all"), sums):
        rows[name] = [0] * len(blocks) + [value]
    types = {c.split()[0]: pa.binary() if c.endswith("binary") else pa.int64() for c in ANSWERED.split(", ")}
    return pa.table({n: pa.array([*v, None] if t == pa.binary() else v, t) for (n, t), v in zip(types.items(), (rows[n] for n in types))})


def _answers(reply: pa.Table) -> dict[str, dict[int, bytes]]:
    of = reply.column("range").to_pylist()
    return {c: dict(zip(of, reply.column(c).to_pylist())) for c in ("kept", "all", "elsewhere") if c in reply.column_names}


def _estimates(grams: Grams, totals: list[np.ndarray], n_tokens: float, n_docs: float) -> tuple[np.ndarray, np.ndarray]:
    """(p, bucket) at each token: p[k - 1] the estimates of order k, bucket by the frequency of the longest context."""
    p = []
    at = [total[number] for total, (_, _, number, _) in zip(totals, grams.keys)]
    context = np.full(len(at[0]), n_tokens)
    for k, total in enumerate(at):
        if k:
            context = np.empty_like(total)
            context[1:] = at[k - 1][:-1]
            context[grams.starts] = n_docs
        p.append(np.divide(total, context, out=np.zeros_like(total), where=context > 0))
    bucket = np.minimum(np.floor(np.log2(context + 1) + 1e-12).astype(np.int64), BUCKETS - 1)
    return np.array(p), bucket


def shares_of(p: np.ndarray, n: np.ndarray, bucket: np.ndarray, weights: np.ndarray, uniform: float) -> np.ndarray:
    """[BUCKETS, order + 1]: how often each order is expected to have given the events, p being [order, events]."""
    share = weights[bucket] * np.concatenate([np.full((1, len(n)), uniform), p]).T
    share *= (n / share.sum(axis=1))[:, None]
    return np.stack([np.bincount(bucket, column, BUCKETS) for column in share.T], axis=1)


def learn_weights(events: DataFrame, uniform: float, order: int) -> np.ndarray:
    """Weights [BUCKETS, order + 1] by EM of events (bucket, p, n: binary), each round one aggregate over all of them.

    One imagined uniform event a bucket keeps an unknown word from having no probability at all. Buckets
    without events take the weights of the nearest with some, below first.
    """
    weights, seen = np.full((BUCKETS, order + 1), 1 / (order + 1)), np.zeros(BUCKETS, bool)
    for _ in range(ROUNDS):

        def expect(batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            got = np.zeros((BUCKETS, order + 1))
            for batch in batches:
                for bucket, p, n in zip(*(batch.column(c).to_pylist() for c in ("bucket", "p", "n"))):
                    n = unsqueezed(n).astype(np.float64)
                    got += shares_of(unsqueezed(p, "<f4").astype(np.float64).reshape(order, len(n)), n, unsqueezed(bucket, "<u1").astype(np.int64), weights, uniform)
            b, k = np.nonzero(got)
            yield pa.record_batch([pa.array(b), pa.array(k), pa.array(got[b, k])], names=["b", "k", "got"])

        got = np.zeros((BUCKETS, order + 1))
        for r in events.mapInArrow(expect, "b long, k long, got double").groupBy("b", "k").agg(F.sum("got").alias("got")).collect():
            got[r["b"], r["k"]] = r["got"]
        seen = got.sum(axis=1) > 0
        then = got + np.eye(order + 1)[0]
        then = np.where(seen[:, None], then / then.sum(axis=1, keepdims=True), weights)
        moved, weights = np.abs(then - weights).max(), then
        if moved < SETTLED:
            break
    known = np.flatnonzero(seen)
    if not len(known):
        return np.tile(np.eye(order + 1)[0], (BUCKETS, 1))
    for b in np.flatnonzero(~seen):
        below = known[known < b]
        weights[b] = weights[below[-1] if len(below) else known[0]]
    return weights


SCORES = "doc_id {}, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, order: int = 3, add: float = 0.1, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    base_score is the log10 probability by unigram counts with `add` added, score that of the model.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("kind", split_of(F.col("doc_id")))
    kind_of = rows.schema["doc_id"].dataType.simpleString()
    hot = frequent(rows, order, text_size(rows)[1])
    blocks = blocks_of(rows, order, hot)
    sizes = {r["kind"]: r for r in blocks.groupBy("kind").agg(F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens")).collect()}
    docs_of = lambda *kinds: sum(sizes[k]["docs"] for k in kinds if k in sizes)
    n_tokens = sum(r["tokens"] for r in sizes.values())
    ranges = [1 << max(0, parts_for(n_tokens // 2, RANGE).bit_length() - 1)] * order

    hot_sizes = [len(h) for h in hot]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, sum(hot_sizes)), np.int64)
        for batch in batches:
            for kind, counts in zip(batch.column("kind").to_pylist(), batch.column("hot").to_pylist()):
                if kind != HELD_OUT:
                    sums[:, :] += np.outer([kind == KEPT, True], unsqueezed(counts).astype(np.int64))
        at = np.flatnonzero(sums[1])
        yield pa.record_batch([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], names=["i", "kept", "all"])

    hot_sums = np.zeros((2, sum(hot_sizes)))
    for r in blocks.select("kind", "hot").mapInArrow(add_up, "i long, kept long, all long").groupBy("i").agg(F.sum("kept").alias("kept"), F.sum("all").alias("all")).collect():
        hot_sums[:, r["i"]] = r["kept"], r["all"]
    cuts = np.cumsum(hot_sizes)[:-1]
    hot_totals = {c: np.split(s, cuts) for c, s in zip(("kept", "all"), hot_sums)}
    needed = blocks.select("block", "kind", "sizes", "words", "codes")

    def ask_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, min(2, order))
                asked = [(k, block.wanted(k, hot, None)) for k in range(min(2, order))]
                yield from _questions(row["block"], block, asked, ranges).combine_chunks().to_batches()

    def ask_more(k: int):
        def ask(key: tuple, mine: pa.Table, reply: pa.Table) -> pa.Table:
            row = mine.to_pylist()[0]
            block = Block(row, k + 1)
            _, elsewhere = block.totals(_answers(reply), k, ranges, hot, hot_totals)
            return _questions(row["block"], block, [(k, block.wanted(k, hot, elsewhere))], ranges)

        return ask

    def with_replies(which: DataFrame, found: list[DataFrame], function, schema: str, to: str = "block >= 0", column: str = "all") -> DataFrame:
        replies = found[0]
        for f in found[1:]:
            replies = replies.union(f)
        replies = replies.where(to).select("block", "range", column, "elsewhere")
        return which.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(function, schema)

    answer = lambda asked: stored(asked.groupBy("range").applyInArrow(answer_range, ANSWERED), "totals")
    found = [answer(needed.mapInArrow(ask_first, ASKED))]
    for k in range(2, order):
        found.append(answer(with_replies(needed, found, ask_more(k), ASKED)))
    sums = found[0].where("block = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_kept", "n_all", "v_kept", "v_all")]).first()
    words_kept, words_all = hot_totals["kept"][0], hot_totals["all"][0]
    n_kept, v_kept = sums["n_kept"] + words_kept.sum(), sums["v_kept"] + int((words_kept > 0).sum())
    n_all, v_all = int(sums["n_all"] + words_all.sum()), sums["v_all"] + int((words_all > 0).sum())
    kept_docs, all_docs = docs_of(KEPT), docs_of(KEPT, DELETED)

    def events_of(key: tuple, mine: pa.Table, reply: pa.Table) -> pa.Table:
        block = Block(mine.to_pylist()[0], order)
        totals = block.totals(_answers(reply), order, ranges, hot, hot_totals, "kept")[0]
        p, bucket = _estimates(block.grams, totals, n_kept, kept_docs)
        events, n = np.unique(np.concatenate([bucket[None].astype("<f4"), p.astype("<f4")]), axis=1, return_counts=True)
        data = (squeezed(events[0].astype("<u1")), squeezed(events[1:].ravel()), squeezed(n.astype("<u8")))
        return pa.table({c: pa.array([x], pa.binary()) for c, x in zip(("bucket", "p", "n"), data)})

    events = stored(with_replies(needed.where(F.col("kind") == DELETED), found, events_of, "bucket binary, p binary, n binary", "kept IS NOT NULL", "kept"), "events")
    weights = learn_weights(events, 1 / (v_kept + 1), order)
    dropped(events)

    def scores(key: tuple, mine: pa.Table, reply: pa.Table) -> pa.Table:
        row = mine.select(["kind", "sizes", "words", "codes"]).to_pylist()[0]
        block = Block(row, order)
        totals = block.totals(_answers(reply), order, ranges, hot, hot_totals)[0]
        p, bucket = _estimates(block.grams, totals, n_all, all_docs)
        w = weights[bucket]
        mixture = w[:, 0] / (v_all + 1)
        for k in range(order):
            mixture += w[:, k + 1] * p[k]
        words = totals[0][block.grams.keys[0][2]]
        base = np.log10((words + add) / (n_all + add * (v_all + 1)))
        each = lambda x: np.add.reduceat(x, block.grams.starts)
        ids = mine.column("ids").combine_chunks().flatten()
        return pa.table(
            {
                "doc_id": ids, "held_out": pa.array(np.full(len(ids), row["kind"] == HELD_OUT)), "n_tokens": pa.array(block.grams.sizes, pa.int64()),
                "n_known": pa.array(each((words > 0).astype(np.int64)), pa.int64()), "base_score": pa.array(each(base)), "score": pa.array(each(np.log10(mixture))),
            }
        )

    scored = with_replies(blocks.select("block", "kind", "ids", "sizes", "words", "codes"), found, scores, SCORES.format(kind_of))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")
