"""Incremental upserts of an event table kept in Parquet by date, with a table of keys beside it."""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.functions.exprs import at, minutes_between
from modlake.sources.footers import latest


def projected(events: DataFrame) -> DataFrame:
    """Rows of the incremental table from a stream of events with documents."""
    lag = minutes_between("event_ts", "import_ts")
    fields = [at("payload", f).alias(f) for f in ("trace_id", "content_fingerprint")]
    return events.select("event_id", "job_id", "event", "queue_slug", "actor_email", "event_ts", "import_ts", *fields, lag.alias("ingestion_lag_minutes"))


def watermark(target: DataFrame | str | None, event_ts: str = "event_ts", spark: SparkSession | None = None):
    """The latest event time of the target: one value. Of a path, it comes from the footers of the files."""
    if isinstance(target, str):
        return latest(spark, target, event_ts)
    return target.agg(F.max(event_ts)).first()[0] if target is not None else None


def incremental_slice(source: DataFrame, target: DataFrame | str | None, lookback_hours: int = 3, event_ts: str = "event_ts") -> DataFrame:
    """Source rows from the target's latest event time less the lookback; all of them for an empty target.

    A target given by its path is not read beyond its files' footers. The limit is a literal, so the scan of the source skips what lies before it.
    """
    last = watermark(target, event_ts, source.sparkSession)
    if last is None:
        return source
    kind = source.schema[event_ts].dataType.simpleString()
    return source.where(F.col(event_ts) >= (F.lit(last).cast(kind) - F.make_dt_interval(hours=F.lit(lookback_hours))))


def late_rows(source: DataFrame, target: DataFrame, lookback_hours: int = 3, key: str = "event_id", event_ts: str = "event_ts") -> DataFrame:
    """Source rows that are not in the target and that the slice leaves out: they came too late."""
    last = watermark(target, event_ts)
    if last is None:
        return source.limit(0)
    limit = F.lit(last).cast(source.schema[event_ts].dataType.simpleString()) - F.make_dt_interval(hours=F.lit(lookback_hours))
    return source.where(F.col(event_ts) < limit).join(target.select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")


def _sortable(df: DataFrame, column: str):
    """A column as something that can be compared; documents and maps go by their JSON text."""
    kind = df.schema[column].dataType.simpleString()
    return F.to_json(F.col(column)) if "variant" in kind or "map<" in kind else F.col(column)


def latest_rows(piece: DataFrame, key: str = "event_id", order: str = "import_ts") -> DataFrame:
    """One row for each key, the latest; values of one row stay together, and equal times are told apart by all values.

    Partial results are taken before the shuffle. Columns of any type, documents included, pass.
    """
    columns = [c for c in piece.columns if c != key]
    best = F.max_by(F.struct(*columns), F.struct(F.col(order), *[_sortable(piece, c) for c in columns if c != order]))
    return piece.groupBy(key).agg(best.alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in columns])


def merged(target: DataFrame | None, piece: DataFrame, key: str = "event_id", order: str = "import_ts") -> DataFrame:
    """Target rows with those of the piece in place of the same keys; columns new in the piece are added.

    Of several piece rows with one key the latest counts.
    """
    best = latest_rows(piece, key, order)
    if target is None:
        return best
    kept = target.join(best.select(F.col(key).alias("__k")), F.col(key).eqNullSafe(F.col("__k")), "left_anti")
    return kept.unionByName(best, allowMissingColumns=True)


def touched_dates(piece: DataFrame, event_ts: str = "event_ts") -> list:
    """Dates that a piece falls on, None for rows without a time; as many as days in it."""
    return [r[0] for r in piece.select(F.to_date(event_ts).alias("d")).distinct().orderBy("d").collect()]


def on_dates(df: DataFrame, dates: list, column: str = "event_date") -> DataFrame:
    """The rows of df on the dates; None among them stands for rows without a date."""
    wanted = F.col(column).isin([d for d in dates if d is not None])
    return df.where(wanted | F.col(column).isNull() if None in dates else wanted)


def _table(spark: SparkSession, path: str) -> DataFrame:
    """The table at path, whatever columns its files have; event_date is a date even where all of them are null."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows if rows.schema["event_date"].dataType.simpleString() == "date" else rows.withColumn("event_date", F.col("event_date").cast("date"))


def keys_path(path: str) -> str:
    return path.rstrip("/") + "__keys"


def key_dates(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, event_date): the partition that each key of the table at path lies in, from the table kept beside it.

    That table is a log: each upsert adds the keys that it wrote, and the latest batch of a key counts. Where there
    is none yet, the two columns of the table itself are read.
    """
    log = keys_path(path)
    if not Files(spark, log).exists(log):
        return _table(spark, path).select(key, "event_date")
    rows = spark.read.parquet(log)
    return rows.groupBy(key).agg(F.max_by("event_date", "batch").alias("event_date"))


def compact_keys(spark: SparkSession, path: str, key: str = "event_id") -> None:
    """Write the log of keys again with one row a key, after many upserts."""
    log, files = keys_path(path), Files(spark, path)
    batches = [int(p.rsplit("=", 1)[1]) for p in files.children(log)]
    if len(batches) > 1:
        fresh = f"{log}-{uuid.uuid4().hex}"
        key_dates(spark, path, key).withColumn("batch", F.lit(max(batches))).write.partitionBy("batch").parquet(fresh)
        files.delete(log)
        files.rename(fresh, log)


class Files:
    """The few file operations that a table of several steps needs, on whatever store holds it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def children(self, path: str) -> list[str]:
        """Paths of the folders and files in a folder, hidden ones left out."""
        found = [s.getPath().toString() for s in self.fs.listStatus(self._path(path))]
        return sorted(p for p in found if p.rsplit("/", 1)[1][0] not in "_.")

    def matching(self, pattern: str) -> list[str]:
        return sorted(s.getPath().toString() for s in self.fs.globStatus(self._path(pattern)) or [])

    def write_text(self, path: str, text: str) -> None:
        out = self.fs.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read_text(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _apply(spark: SparkSession, path: str, staged: str) -> None:
    """Carry out what a staged folder says; doing it twice gives the same table."""
    files, plan = Files(spark, path), json.loads(Files(spark, path).read_text(f"{staged}/plan.json"))
    rows = spark.read.option("mergeSchema", True).parquet(f"{staged}/rows")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
    for date in plan["emptied"]:
        files.delete(f"{path}/event_date={date or '__HIVE_DEFAULT_PARTITION__'}")
    if plan["first_keys"]:
        _log_keys(_table(spark, path), path, plan["key"], 0)
    _log_keys(spark.read.parquet(f"{staged}/rows"), path, plan["key"], plan["batch"])
    files.delete(staged)


def _log_keys(rows: DataFrame, path: str, key: str, batch: int) -> None:
    rows.select(key, "event_date").write.mode("overwrite").parquet(f"{keys_path(path)}/batch={batch}")


def recover(spark: SparkSession, path: str) -> None:
    """Finish upserts that were cut off after all they write had been staged, and drop those cut off before."""
    files = Files(spark, path)
    for staged in files.matching(f"{path.rstrip('/')}__staged-*"):
        if files.exists(f"{staged}/plan.json"):
            _apply(spark, path, staged)
        else:
            files.delete(staged)


def upsert(spark: SparkSession, path: str, piece: DataFrame, key: str = "event_id", event_ts: str = "event_ts", order: str = "import_ts") -> DataFrame:
    """Upsert of a table in Parquet by event_date; a key whose time moves to another date leaves its old one.

    Read and written again are the dates of the piece and those that its keys lie in by the table of keys
    (key_dates), no others. A date that is left without rows goes. Rows without an event time have a partition of
    their own, which is read and written like a date; a null key is a key like any other.

    What the dates are to hold is staged beside the table first, with a plan, and goes when table and keys are
    written; whatever is cut off on the way is finished by the next call (recover). One writer at a time.
    """
    files = Files(spark, path)
    recover(spark, path)
    if piece.isEmpty():
        return _table(spark, path) if files.exists(path) else piece.withColumn("event_date", F.to_date(event_ts))
    dated = piece.withColumn("event_date", F.to_date(event_ts))
    staged = f"{path.rstrip('/')}__staged-{uuid.uuid4().hex}"
    target, old, first_keys, batch = None, [], False, 1
    if files.exists(path):
        wanted = piece.select(F.col(key).alias("__k")).distinct()
        held = key_dates(spark, path, key).join(wanted, F.col(key).eqNullSafe(F.col("__k")), "left_semi")
        old = [r[0] for r in held.select("event_date").distinct().collect()]
        dates = list({*touched_dates(piece, event_ts), *old})
        target = on_dates(_table(spark, path), dates) if dates else None
        first_keys = not files.exists(keys_path(path))
        batch = 1 if first_keys else 1 + max(int(p.rsplit("=", 1)[1]) for p in files.children(keys_path(path)))
    merged(target, dated, key, order).write.parquet(f"{staged}/rows")
    left = {r[0] for r in spark.read.parquet(f"{staged}/rows").select("event_date").distinct().collect()}
    emptied = [d and str(d) for d in old if d not in left]
    files.write_text(f"{staged}/plan.json", json.dumps({"emptied": emptied, "key": key, "batch": batch, "first_keys": first_keys}))
    _apply(spark, path, staged)
    return _table(spark, path)
