"""Divergence between the sources of each language, by their smoothed term shares.

Terms are runs of letters (every code point above ASCII counts as one), only A-Z lower-cased. A language keeps the V
terms that occur in at least `min_docs` of its documents. A group (language, source), and the language as a whole,
gives each kept term the share p = 1 + floor(10^digits * (count + 2) / (N + 2 V)) in parts of 10^digits, N being the
occurrences of kept terms there. Two shares differ by floor((p - q)^2 / (p + q)). All arithmetic is in whole numbers.

Pair-task sparse merge: the kept terms of a group are arrays of (term id, count), ascending, cut into blocks of
BLOCK ids. For each unordered pair of a language's groups the two arrays of a block are co-grouped; the ids of the
shorter one gallop through the longer one, which prices terms that both hold; those of one side are priced against
the share of a term that does not occur, and the terms that neither holds, all of one price, are counted afterwards.
A price is the same both ways, so each pair gives two rows.

Scale: texts are read once and not shuffled. What is shuffled first is a row for each (language, source, term) of a
slice of texts, by (language, term): counts, document counts and term ids come from that one exchange. A vector
block has BLOCK entries at most whatever the vocabulary, two bytes an id and one a count where they are small, and
is sent to each pair of its group, as the pairs are the result. Groups of a language meet in tiles of TILE by TILE.

Edge cases: null text, language and source count as ''; every row is a document of its own, repeated ids too; groups
and languages without kept terms have values of zero; ties go by the item, bytewise; an empty table gives no rows;
columns beside those named are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlake.llm.encode import own_texts, text_slices
from modlake.llm.store import parts_for, stored, text_size

#: Term ids of one vector block; a place in it fits into two bytes.
BLOCK = 1 << 15
#: Groups of a language that meet in one join key, squared.
TILE = 512
#: Bytes of text whose terms make one partition after the exchange.
PART = 48 << 20
#: Each byte as part of a term (A-Z lower-cased), or a blank.
AS_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTED = "lang string, source string, term string, n long, docs long"


def term_lists(texts: pa.Array) -> pa.Array:
    """The terms of each text; pieces may be empty."""
    texts = own_texts(texts)
    _, offsets, data = texts.buffers()
    letters = pa.py_buffer((data.to_pybytes() if data else b"").translate(AS_TERM))
    return pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(texts), offsets, letters))


def count_slice(lang: pa.Array, source: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Rows of COUNTED of some documents; a row without a term has the documents of its group."""
    fill = lambda x: pc.fill_null(x.cast(pa.string()), "").dictionary_encode()
    lang, source, lists = fill(lang), fill(source), term_lists(texts)
    pair, group = np.unique(lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy(), return_inverse=True)
    coded = lists.flatten().dictionary_encode()
    k = max(1, len(coded.dictionary))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(lists)), np.diff(offsets))
    held, n = np.unique(doc * k + coded.indices.to_numpy(), return_counts=True)  # (document, term)
    keys, place = np.unique(group[held // k] * k + held % k, return_inverse=True)  # (group, term)
    real = pc.greater(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)[keys % k] if len(keys) else np.zeros(0, bool)
    n = np.bincount(place, n, len(keys)).astype(np.int64)[real]
    docs = np.bincount(place, minlength=len(keys)).astype(np.int64)[real]
    keys = keys[real]
    of = np.concatenate([keys // k, np.arange(len(pair))])
    terms = pa.concat_arrays([coded.dictionary.take(pa.array(keys % k)).cast(pa.string()), pa.nulls(len(pair), pa.string())])
    return pa.record_batch(
        [
            lang.dictionary.take(pa.array(pair[of] // len(source.dictionary))), source.dictionary.take(pa.array(pair[of] % len(source.dictionary))), terms,
            pa.array(np.concatenate([n, np.zeros(len(pair), np.int64)])), pa.array(np.concatenate([docs, np.bincount(group, minlength=len(pair)).astype(np.int64)])),
        ],
        names=[c.split()[0] for c in COUNTED.split(", ")],
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, size=8 << 20, rows=1 << 20):
            if part.num_rows:
                yield count_slice(*(part.column(c) for c in ("lang", "source", "text")))


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, all_n, first, tid) stored: the kept terms of each group, and a row with a null term for each group.

    all_n: occurrences in the language; first: true for one group of each kept term; tid: number of the term
    within the language. Each partition counts its terms, and the counts interleave, so the numbers are dense.
    """
    rows = docs.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    parts = parts_for(text_size(rows)[1], PART)
    counted = rows.mapInArrow(_count, COUNTED).repartition(parts, "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    known = counted.withColumns({"all_n": F.sum("n").over(of_term), "all_docs": F.sum("docs").over(of_term), "first": F.col("source") == F.min("source").over(of_term)})
    kept = known.where(F.col("term").isNull() | (F.col("all_docs") >= min_docs)).select("lang", "source", "term", "n", "all_n", "first").sortWithinPartitions("lang", "term")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, last, lang_of, seen = TaskContext.get().partitionId(), None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            langs, terms = (b.column(c).dictionary_encode() for c in ("lang", "term"))
            lang, term = langs.indices.to_numpy(), pc.fill_null(terms.indices, -1).to_numpy()
            fresh = np.ones(b.num_rows, bool)
            fresh[1:] = (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])
            fresh[0] = (b.column("lang")[0].as_py(), b.column("term")[0].as_py()) != last
            last = (b.column("lang")[-1].as_py(), b.column("term")[-1].as_py())
            counts = np.cumsum(fresh & (term >= 0))
            begins = np.ones(b.num_rows, bool)
            begins[1:] = lang[1:] != lang[:-1]
            at = np.flatnonzero(begins)
            # counted from the language's first row on; what this batch goes on with has been counted before
            base = np.where(at, counts[np.maximum(at - 1, 0)], 0)
            if b.column("lang")[0].as_py() == lang_of:
                base[0] -= seen
            numbers = counts - base[np.cumsum(begins) - 1]
            lang_of, seen = last[0], int(numbers[-1])
            number = pa.array(numbers - 1, mask=term < 0)
            yield pa.record_batch([*b.columns, number, pa.array(np.full(b.num_rows, mine))], names=[*b.schema.names, "number", "part"])

    out = stored(kept.mapInArrow(numbered, "lang string, source string, term string, n long, all_n long, first boolean, number long, part long"), "terms")
    ways = (out.agg(F.max("part")).first()[0] or 0) + 1
    return out.withColumn("tid", F.col("number") * ways + F.col("part")).drop("number", "part")


def planes(x: np.ndarray) -> bytes:
    """Whole numbers in as many bytes as the largest needs, low bytes first, each place together: compresses well."""
    x = np.ascontiguousarray(x, "<u8")
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        flat = np.frombuffer(data, np.uint8).reshape(-1, n)
        out[:, : len(flat)] = flat.T
    return out.view("<u8").ravel().astype(np.int64)


def _vector(group: pa.Table) -> pa.Table:
    """One row for a block of a group: ids (gaps) and counts in planes."""
    tid, n = (group.column(c).to_numpy() for c in ("tid", "n"))
    order = np.argsort(tid)
    tid, n = tid[order], n[order]
    one = {c: group.column(c).slice(0, 1) for c in ("lang", "source", "block")}
    return pa.table(one | {"n": pa.array([len(tid)], pa.int32()), "ids": pa.array([planes(np.diff(tid % BLOCK, prepend=0))], pa.binary()), "counts": pa.array([planes(n)], pa.binary())})


def share(count: np.ndarray, total: int, digits: int) -> np.ndarray:
    """1 + floor(10^digits * (count + 2) / total), by long division of a few digits at a time, which fits for totals below 9 * 10^15."""
    x = np.asarray(count, np.int64) + 2
    out, rest = x // total, x % total
    for k in range(0, digits, 3):
        step = 10 ** min(3, digits - k)
        rest *= step
        out = out * step + rest // total
        rest %= total
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def gallop(few: np.ndarray, many: np.ndarray, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Places (in few, in many) of the ids that both ascending arrays hold.

    `step` ids of few at a time: from where the last search ended the range in many doubles until it reaches
    beyond them, then it is searched.
    """
    mine, theirs, at = [], [], 0
    for a in range(0, len(few), step):
        some = few[a : a + step]
        width = step
        while at + width < len(many) and many[at + width - 1] < some[-1]:
            width *= 2
        found = at + np.searchsorted(many[at : at + width], some)
        hit = found < len(many)
        hit[hit] = many[found[hit]] == some[hit]
        mine.append(a + np.flatnonzero(hit))
        theirs.append(found[hit])
        at = int(found[-1])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(mine or none), np.concatenate(theirs or none)


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], total_a: int, total_b: int, digits: int) -> tuple[int, int]:
    """(sum of prices over terms that a or b holds, number of these terms) of (ids, counts) of two groups."""
    if len(a[0]) > len(b[0]):
        a, b, total_a, total_b = b, a, total_b, total_a
    in_a, in_b = gallop(a[0], b[0])
    p, q = share(a[1], total_a, digits), share(b[1], total_b, digits)
    none_a, none_b = share(np.zeros(1, np.int64), total_a, digits), share(np.zeros(1, np.int64), total_b, digits)
    both = price(p[in_a], q[in_b]).sum()
    only_a, only_b = np.ones(len(p), bool), np.ones(len(q), bool)
    only_a[in_a] = only_b[in_b] = False
    alone = price(p[only_a], none_b).sum() + price(none_a, q[only_b]).sum()
    return int(both + alone), len(p) + len(q) - len(in_a)


def _pair_task(digits: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        some = left if left.num_rows else right
        key = {c: some.column(c).slice(0, 1) for c in ("lang", "a", "b")}
        total_a, total_b = (some.column(c)[0].as_py() for c in ("total_a", "total_b"))

        def arrays(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            if not t.num_rows:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            n = t.column("n")[0].as_py()
            return np.cumsum(from_planes(t.column("ids")[0].as_py(), n)), from_planes(t.column("counts")[0].as_py(), n)

        value, terms = merged(arrays(left), arrays(right), total_a, total_b, digits)
        return pa.table(key | {"value": pa.array([value], pa.int64()), "terms": pa.array([terms], pa.int64())})

    return run


def _share(count: Column, total: Column, digits: int) -> Column:
    """The same in SQL, in decimals that hold every product."""
    return 1 + F.call_function("div", F.lit(10**digits).cast("decimal(18,0)") * (count + 2).cast("decimal(19,0)"), total.cast("decimal(19,0)"))


def divergence(docs: DataFrame, min_docs: int = 10, digits: int = 9, top: int = 10, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' against each other source of the language, part 'term' the terms that set a source apart."""
    terms = kept_terms(docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")), min_docs)
    groups = terms.groupBy("lang", "source").agg(F.sum(F.when(F.col("term").isNotNull(), F.col("n")).otherwise(0)).alias("group_n"))
    langs = terms.groupBy("lang").agg(F.sum(F.when(F.col("term").isNotNull(), F.col("n")).otherwise(0)).alias("lang_n"), F.count(F.when(F.col("term").isNotNull() & F.col("first"), 1)).alias("v"), F.countDistinct(F.when(F.col("term").isNull(), F.col("source"))).alias("groups"))
    groups = stored(groups.join(langs, "lang").withColumn("total", F.col("group_n") + 2 * F.col("v")), "groups")

    # the groups of a language meet tile by tile
    tiles = F.ceil(F.col("groups") / TILE).cast("int")
    tiled = groups.select("lang", "source", "total", "v", F.pmod(F.xxhash64("source"), tiles).cast("int").alias("tile"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
    left = tiled.select("lang", F.col("tile").alias("i"), F.col("other").alias("j"), F.col("source").alias("a"), F.col("total").alias("total_a"), "v")
    right = tiled.select("lang", F.col("other").alias("i"), F.col("tile").alias("j"), F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = stored(left.join(right, ["lang", "i", "j"]).where("a < b").drop("i", "j"), "pairs")

    entries = terms.where("term IS NOT NULL").select("lang", "source", F.expr(f"tid div {BLOCK}").alias("block"), "tid", "n")
    vectors = stored(entries.groupBy("lang", "source", "block").applyInArrow(_vector, "lang string, source string, block long, n int, ids binary, counts binary"), "vectors")
    held = ["lang", "a", "b", "total_a", "total_b", "block", "n", "ids", "counts"]
    side = lambda name: vectors.withColumnRenamed("source", name).join(pairs.drop("v"), ["lang", name]).select(held).toDF(*held)
    keys = ["lang", "a", "b", "block"]
    priced = side("a").groupBy(*keys).cogroup(side("b").groupBy(*keys)).applyInArrow(_pair_task(digits), "lang string, a string, b string, value long, terms long")
    sums = priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    p, q = _share(F.lit(0), F.col("total_a"), digits), _share(F.lit(0), F.col("total_b"), digits)
    absent = F.when(F.col("v") == 0, 0).otherwise((F.col("v") - F.coalesce("terms", F.lit(0))) * F.call_function("div", (p - q) * (p - q), p + q))
    valued = pairs.join(sums, ["lang", "a", "b"], "left").select("lang", "a", "b", (F.coalesce("value", F.lit(0)) + absent).alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pair = valued.select("lang", ways.alias("way"), "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

    shares = terms.where("term IS NOT NULL").join(groups, ["lang", "source"])
    shares = shares.select("lang", "source", F.col("term").alias("item"), _share(F.col("n"), F.col("total"), digits).alias("p"), _share(F.col("all_n"), F.col("lang_n") + 2 * F.col("v"), digits).alias("q"))
    term = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pair.withColumn("rank", rank).union(term.withColumn("rank", rank).where(F.col("rank") <= top))
