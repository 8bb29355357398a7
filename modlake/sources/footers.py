"""What Parquet footers say of files: a listing dealt to tasks that read no data pages.

Files that a task cannot open (a store that only Spark reads), and columns of which a footer has no exact range
(texts and floating-point numbers, times in the old 96-bit form, files written without statistics), are marked unknown;
file_ranges() reads the column of just those files instead.
"""

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files of which one task reads the footers.
FILES_A_TASK = 256
#: Unknown files that are read by name; beyond that the whole table is read and filtered.
NAMED = 10_000
#: Types whose footers have exact ranges, as whole numbers.
WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz")
FOOTER = "path string, n_bytes long, row_group int, n_rows long, group_bytes long, low long, high long, known boolean, footer_bytes long"


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, n_bytes) of all files below a path; the files are listed, not opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("n_bytes"))


def opened(path: str) -> pa.NativeFile:
    """A file of a local or remote path, at random access."""
    if path.startswith(("file:", "/")):
        return pa.OSFile(re.sub("^file:/*", "/", path))
    fs, at = pyarrow.fs.FileSystem.from_uri(path)
    return fs.open_input_file(at)


def _range(column: pq.ColumnChunkMetaData, n_rows: int) -> tuple[bool, int | None, int | None]:
    """(known, low, high): raw values, times in microseconds."""
    s, kind = column.statistics, json.loads(column.statistics.logical_type.to_json()) if column.statistics is not None else {}
    name = kind.get("Type", "None")
    if s is None or column.physical_type not in ("INT32", "INT64") or name not in ("None", "Int", "Date", "Timestamp") or kind.get("isSigned") is False:
        return False, None, None
    if s.has_null_count and s.null_count == n_rows:
        return True, None, None
    unit = {"microseconds": 1, "milliseconds": 1000}.get(kind.get("timeUnit"), None if name == "Timestamp" else 1)
    if not s.has_min_max or unit is None:
        return False, None, None
    return True, s.min_raw * unit, s.max_raw * unit


def footers(spark: SparkSession, path: str, col: str) -> DataFrame:
    """FOOTER of every row group of the files below a path; one row without a row group for a file that cannot be opened."""
    files = listed(spark, path)
    tasks = max(1, -(-files.count() // FILES_A_TASK))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    with opened(at) as f:
                        meta = pq.ParquetFile(f).metadata
                        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
                        for g in range(meta.num_row_groups):
                            group = meta.row_group(g)
                            found = _range(group.column(names.index(col)), group.num_rows) if col in names else (False, None, None)
                            packed = sum(group.column(i).total_compressed_size for i in range(group.num_columns))
                            rows.append((at, size, g, group.num_rows, packed, found[1], found[2], found[0], meta.serialized_size + 8))
                        if not meta.num_row_groups:
                            rows.append((at, size, None, 0, 0, None, None, True, meta.serialized_size + 8))
                except (OSError, ValueError, pa.ArrowException):
                    rows.append((at, size, None, None, None, None, None, False, 0))
            names, kinds = zip(*(x.split() for x in FOOTER.split(", ")))
            types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
            yield pa.record_batch([pa.array([r[i] for r in rows], types[k]) for i, k in enumerate(kinds)], names=list(names))

    return files.repartition(tasks).mapInArrow(read, FOOTER)


def as_type(raw: Column, kind: str) -> Column:
    """Raw whole numbers of a footer as values of a type of WHOLE_NUMBERS."""
    if kind == "date":
        return F.date_from_unix_date(raw.cast("int"))
    if kind == "timestamp":
        return F.timestamp_micros(raw)
    if kind == "timestamp_ntz":
        seconds = (raw.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
        return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return raw.cast(kind)


def scanned(rows: DataFrame, col: str) -> DataFrame:
    """(path, low, high, n_rows) of the files that rows come from, by reading the column."""
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min(col).alias("low"), F.max(col).alias("high"), F.count(F.lit(1)).alias("n_rows"))


def row_groups(spark: SparkSession, path: str, col: str) -> DataFrame:
    """(path, row_group, low, high, n_rows, n_bytes) of the row groups whose footers are known."""
    kind = spark.read.parquet(path).schema[col].dataType.simpleString()
    known = footers(spark, path, col).where("known AND row_group IS NOT NULL")
    return known.select("path", "row_group", *[as_type(F.col(c), kind if kind in WHOLE_NUMBERS else "bigint").alias(c) for c in ("low", "high")], "n_rows", F.col("group_bytes").alias("n_bytes"))


def file_ranges(spark: SparkSession, path: str, col: str) -> DataFrame:
    """(path, low, high, n_rows) of every file below a path: from footers where they tell, else from the column itself."""
    table = spark.read.parquet(path)
    kind = table.schema[col].dataType.simpleString()
    if kind not in WHOLE_NUMBERS:
        return scanned(table, col)
    found = footers(spark, path, col)
    files = found.groupBy("path").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n_rows").alias("n_rows"), F.min("known").alias("known"))
    told = files.where("known AND n_rows > 0").select("path", as_type(F.col("low"), kind).alias("low"), as_type(F.col("high"), kind).alias("high"), "n_rows")
    unknown = [r.path for r in files.where("NOT known").select("path").limit(NAMED + 1).collect()]
    if not unknown:
        return told
    if len(unknown) <= NAMED:
        return told.unionByName(scanned(spark.read.parquet(*unknown), col))
    return scanned(table, col)


def latest(spark: SparkSession, path: str, col: str):
    """The largest value of a column: one value, from footers where they tell."""
    return file_ranges(spark, path, col).agg(F.max("high")).first()[0]
