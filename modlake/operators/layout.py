"""Audits of table layout and of query cost, as jobs over files, their footers and logs."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modlake.operators.percentiles import aggregated
from modlake.sources.events import write_table
from modlake.sources.footers import file_ranges, listed, row_groups
from modlake.sources.workspace import workspace

#: Ends of ranges in one part of the ordered ends, and the most parts there are.
ENDS, PARTS = 50_000, 256


def overlaps(units: DataFrame) -> DataFrame:
    """(unit, overlaps): for each (unit, low, high) how many other ranges touch its own.

    Ranges that touch one begin no later than it ends, and end no earlier than it begins, so two counts over
    the ordered ends give the number without comparing ranges in pairs. The counts are a prefix sum in two levels:
    the ends are dealt out in ranges of their order, counted within each, and the totals of the ranges before are
    joined to them, so no task sees all ends.
    """
    spark = units.sparkSession
    ends = units.where("low IS NOT NULL").select("unit", F.explode(F.array(
        F.struct(F.col("low").alias("v"), F.lit(0).alias("kind")), F.struct(F.col("high").alias("v"), F.lit(1).alias("kind")))).alias("e")).select("unit", "e.*")
    parts = max(2, min(PARTS, -(-2 * units.count() // ENDS)))
    # a table, as its parts are read twice and have to be the same; ends that are equal lie in one part
    dealt = write_table(ends.repartitionByRange(parts, "v", "kind").withColumn("part", F.spark_partition_id()), workspace(spark, "ends"))
    begun, ended = (F.sum(F.when(F.col("kind") == k, 1).otherwise(0)) for k in (0, 1))
    totals = dealt.groupBy("part").agg(begun.alias("begun_before"), ended.alias("ended_before"))
    later = totals.select(F.explode(F.sequence(F.col("part") + 1, F.lit(parts))).alias("of"), "begun_before", "ended_before")
    before = later.groupBy("of").agg(F.sum("begun_before").alias("begun_before"), F.sum("ended_before").alias("ended_before"))
    order = Window.partitionBy("part").orderBy("v", "kind").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = dealt.select("unit", "kind", "part", begun.over(order).alias("begun"), ended.over(order).alias("ended")).join(before, F.col("part") == F.col("of"), "left")
    total = lambda c: F.col(c) + F.coalesce(f"{c}_before", F.lit(0))
    return counted.groupBy("unit").agg((F.max(F.when(F.col("kind") == 1, total("begun"))) - F.max(F.when(F.col("kind") == 0, total("ended"))) - 1).alias("overlaps"))


def layout_profile(spark: SparkSession, path: str, col: str) -> DataFrame:
    """Rows and range of a column for each file, and how many other files' ranges touch its own.

    Ranges come from the files' footers; only files whose footers do not tell are read.
    """
    # by path: files of one name lie in several partitions
    rows = write_table(file_ranges(spark, path, col), workspace(spark, "ranges"))
    touching = overlaps(rows.select(F.col("path").alias("unit"), "low", "high"))
    return rows.join(touching, F.col("path") == F.col("unit"), "left").select(F.element_at(F.split("path", "/"), -1).alias("file"), "low", "high", "n_rows", "overlaps")


def row_group_profile(spark: SparkSession, path: str, col: str) -> DataFrame:
    """The same for row groups, of the files whose footers tell; also the compressed bytes of each group."""
    rows = write_table(row_groups(spark, path, col).withColumn("unit", F.concat_ws("#", "path", "row_group")), workspace(spark, "ranges"))
    touching = overlaps(rows.select("unit", "low", "high")).withColumnRenamed("unit", "of")
    return rows.join(touching, F.col("unit") == F.col("of"), "left").select(F.element_at(F.split("path", "/"), -1).alias("file"), "row_group", "low", "high", "n_rows", "n_bytes", "overlaps")


def average_overlaps(profile: DataFrame) -> DataFrame:
    return profile.agg(F.count(F.lit(1)).alias("files"), F.avg("overlaps").alias("average_overlaps"))


def merge_probe(target: DataFrame, piece: DataFrame, key: str) -> DataFrame:
    """For each file of the target, the rows that an upsert of piece would replace."""
    touched = target.withColumn("file", F.col("_metadata.file_path")).join(piece.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_semi")
    return touched.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))


#: Bits a key, and bits set for each, of the summaries of files: about one key in 3000 that a file lacks seems to be there.
KEY_BITS, KEY_HASHES = 16, 8
#: Bytes of summaries, and keys, that one task compares.
SUMMARY_BYTES, KEYS = 64 << 20, 100_000


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each hash in a filter of `size` bits, a power of two: one row a hash."""
    h = hashes.view(np.uint64)
    first, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((first[:, None] + np.arange(KEY_HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(size - 1)).astype(np.int64)


def key_summaries(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(path, low, high, n_rows, filter) of each file: the range of its keys, and a Bloom filter of them.

    Made once, when files are written, and kept as a table like any other. Every task sets the bits of the pieces of
    files that it reads; the pieces of a file are joined bit by bit. Filters have one size, by the largest file.
    """
    ranges = write_table(file_ranges(spark, path, key), workspace(spark, "ranges"))
    size = 1 << max(10, int((ranges.agg(F.max("n_rows")).first()[0] or 1) * KEY_BITS - 1).bit_length())
    keys = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"), F.xxhash64(key).alias("h"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, bits = None, np.zeros(0, bool)
        out = lambda: pa.record_batch([pa.array([at]), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["path", "bits"])
        for b in batches:
            paths, hashes = b.column(0).dictionary_encode(), b.column(1).to_numpy()
            for code, name in enumerate(paths.dictionary.to_pylist()):
                if name != at:
                    if at is not None:
                        yield out()
                    at, bits = name, np.zeros(size, bool)
                bits[_places(hashes[paths.indices.to_numpy() == code], size)] = True
        if at is not None:
            yield out()

    def joined(group: pa.Table) -> pa.Table:
        whole = np.bitwise_or.reduce([np.frombuffer(x.as_buffer(), np.uint8) for x in group.column("bits")])
        return pa.table({"of": group.column("path").slice(0, 1), "filter": pa.array([whole.tobytes()], pa.binary())})

    filters = keys.mapInArrow(pieces, "path string, bits binary").groupBy("path").applyInArrow(joined, "of string, filter binary")
    return ranges.join(filters, F.col("path") == F.col("of")).drop("of")


def files_that_may_hold(summaries: DataFrame, piece: DataFrame, key: str) -> DataFrame:
    """(path) of the files of the summaries that may hold a key of the piece: all that do, and hardly any other.

    Keys and files meet by ranges of the key, cut at keys of the files' own beginnings; within a range in blocks, so a
    task holds so many keys and so many bytes of filters at most.
    """
    keys = piece.where(F.col(key).isNotNull()).select(F.col(key).alias("k")).distinct()
    n_keys, n_files, bytes_each = keys.count(), *summaries.agg(F.count(F.lit(1)), F.max(F.octet_length("filter"))).first()
    if not n_keys or not n_files:
        return summaries.select("path").limit(0)
    lows = summaries.where("low IS NOT NULL").select("low").distinct().orderBy("low")
    every = max(1, -(-lows.count() // 64))
    cuts = [r.low for i, r in enumerate(lows.toLocalIterator()) if i % every == 0]  # 64 at most are kept
    bounds = F.array(*[F.lit(c).cast(summaries.schema["low"].dataType) for c in cuts])
    part = lambda c: F.size(F.filter(bounds, lambda x: x <= c))
    blocks, packs = max(1, -(-n_keys // (KEYS * len(cuts)))), max(1, -(-n_files * bytes_each // SUMMARY_BYTES))
    left = keys.select(F.xxhash64("k").alias("h"), part(F.col("k")).alias("part"), "k").withColumns({"block": F.pmod("h", F.lit(blocks)), "pack": F.explode(F.sequence(F.lit(0), F.lit(packs - 1)))})
    right = summaries.withColumns({"part": F.explode(F.sequence(part(F.col("low")), part(F.col("high")))), "pack": F.pmod(F.xxhash64("path"), F.lit(packs)).cast("int")})
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def hits(keys: pa.Table, files: pa.Table) -> pa.Table:
        found = []
        if keys.num_rows and files.num_rows:
            hashes, values = keys.column("h").to_numpy(), keys.column("k")
            for path, low, high, bits in zip(*(files.column(c) for c in ("path", "low", "high", "filter"))):
                inside = pa.compute.and_(pa.compute.greater_equal(values, low), pa.compute.less_equal(values, high)).to_numpy()
                flags = np.frombuffer(bits.as_buffer(), np.uint8)
                at = _places(hashes[inside], len(flags) * 8)
                if ((flags[at >> 3] >> (at & 7)) & 1).all(axis=1).any():
                    found.append(path.as_py())
        return pa.table({"path": pa.array(found, pa.string())})

    on = ["part", "pack", "block"]
    return left.select(*on, "h", "k").groupBy(*on).cogroup(right.select(*on, "path", "low", "high", "filter").groupBy(*on)).applyInArrow(hits, "path string").distinct()


def probe(spark: SparkSession, path: str, piece: DataFrame, key: str, summaries: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """What an upsert of piece would replace in a table of files, and what it takes to find out.

    The first table has (file, n_rows) of each file with such rows; the second one row of files and bytes: those
    opened (all, without summaries) and those there are.
    """
    files = write_table(listed(spark, path), workspace(spark, "files"))
    if summaries is None:
        chosen = files
    else:
        chosen = write_table(files.join(files_that_may_hold(summaries, piece, key), "path", "left_semi"), workspace(spark, "chosen"))
    opened = [r.path for r in chosen.select("path").toLocalIterator()]
    rows = merge_probe(spark.read.parquet(*opened) if opened else spark.read.parquet(path).limit(0), piece, key)
    sums = lambda df, n: df.agg(F.count(F.lit(1)).alias(f"files{n}"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias(f"bytes{n}"))
    return rows, sums(chosen, "_opened").crossJoin(sums(files, ""))  # one row each


def pruning_report(profile: DataFrame, low=None, high=None) -> DataFrame:
    """Files that a range predicate leaves to read, of all."""
    kept = F.lit(True)
    if low is not None:
        kept = kept & (F.col("high") >= (low if isinstance(low, Column) else F.lit(low)))
    if high is not None:
        kept = kept & (F.col("low") <= (high if isinstance(high, Column) else F.lit(high)))
    return profile.agg(F.count_if(kept).alias("files_kept"), F.count(F.lit(1)).alias("files"), F.sum(F.when(kept, F.col("n_rows")).otherwise(0)).alias("rows_kept"))


def query_cost_rollup(log: DataFrame, now: str, days: int = 7, pattern: str = r'"node_id":\s*"([^"]+)"') -> DataFrame:
    """Runs and cost of each model named in the query texts of the last days, successes only."""
    since = F.lit(now).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    model = F.regexp_extract("query_text", pattern, 1)
    rows = log.where((F.col("execution_status") == "SUCCESS") & (F.col("start_time") >= since)).withColumn("model", model).where("model <> ''")
    spilled = F.coalesce("bytes_spilled_to_local_storage", F.lit(0)) + F.coalesce("bytes_spilled_to_remote_storage", F.lit(0))
    most = [F.count(F.lit(1)).alias("runs"), F.max("bytes_scanned").alias("max_bytes_scanned"), F.max("partitions_scanned").alias("max_partitions_scanned"), F.max(spilled).alias("max_bytes_spilled")]
    return aggregated(rows, {"model": F.col("model")}, most, {"median_elapsed": ("total_elapsed_time", 0.5)})
