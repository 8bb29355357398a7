"""Landing surfaces: seed files, raw tables, their union, and full-refresh sinks."""

import logging
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LANDING = "event string, payload variant, import_ts timestamp_ntz"
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SourceConfig:
    """Where deliveries come from. A surface is a table name or a path of Parquet files."""

    mode: str = "seed"
    overrides: dict[str, str] = field(default_factory=dict)
    seeds: dict[str, str] = field(default_factory=dict)
    raw: dict[str, str] = field(default_factory=dict)
    minimum_date: str = "2020-01-01"
    skew_tolerance_hours: int = 24

    def mode_of(self, event: str) -> str:
        mode = self.overrides.get(event, self.mode)
        if mode not in ("seed", "raw", "union"):
            raise ValueError(f"mode of {event}: {mode!r} is none of seed, raw, union")
        return mode


def read_seed_events(spark: SparkSession, path: str, event: str) -> DataFrame:
    """Deliveries of a CSV with JSON text; text that is no JSON becomes a null payload."""
    rows = spark.read.schema("event string, payload string, import_ts timestamp_ntz").option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return rows.where(F.col("event") == event).select(F.lit("seed").alias("record_source"), "event", F.try_parse_json("payload").alias("payload"), "import_ts")


def _exists(spark: SparkSession, surface: str) -> bool:
    if "/" not in surface:
        return spark.catalog.tableExists(surface)
    path = spark._jvm.org.apache.hadoop.fs.Path(surface)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_raw_events(spark: SparkSession, surface: str, event: str) -> DataFrame | None:
    """Deliveries of a raw table; None, with a line in the log, if there is no such surface."""
    if not _exists(spark, surface):
        log.warning("no raw surface %s for %s", surface, event)
        return None
    rows = spark.read.parquet(surface) if "/" in surface else spark.table(surface)
    return rows.where(F.col("event") == event).select(F.lit("raw").alias("record_source"), "event", "payload", "import_ts")


def empty_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "record_source string, event string, payload string, import_ts timestamp_ntz").withColumn("payload", F.try_parse_json("payload"))


def resolve_events(spark: SparkSession, event: str, config: SourceConfig) -> DataFrame:
    """All deliveries of an event by the configured mode, none dropped; empty but typed if nothing can be read."""
    mode = config.mode_of(event)
    found = []
    if mode in ("seed", "union") and event in config.seeds:
        found.append(read_seed_events(spark, config.seeds[event], event))
    if mode in ("raw", "union") and event in config.raw and (raw := read_raw_events(spark, config.raw[event], event)) is not None:
        found.append(raw)
    return bag_union(spark, found)


def bag_union(spark: SparkSession, surfaces: list[DataFrame]) -> DataFrame:
    if not surfaces:
        return empty_events(spark)
    out = surfaces[0]
    for s in surfaces[1:]:
        out = out.unionByName(s)
    return out


def read_policy_areas(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("policy_area_id string, policy_area_name string").option("header", True).csv(path)


@contextmanager
def _with(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def whole_documents(spark: SparkSession):
    """Tables written meanwhile hold each document as one value.

    Taken apart into a column for each path (shredded), a document is put together again whenever a later step reads it as a whole.
    """
    return _with(spark, {"spark.sql.variant.inferShreddingSchema": "false"})


def small_methods(spark: SparkSession):
    """Steps run meanwhile are compiled in methods of up to 8000 bytes, beyond which the JVM interprets a method for good.

    Steps of many columns are beyond it when a whole stage is one method; Spark then takes them operator by operator.
    """
    return _with(spark, {"spark.sql.codegen.hugeMethodLimit": "8000"})


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Full refresh of a table: overwritten and read back."""
    with whole_documents(df.sparkSession), small_methods(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lazy_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def eval_questions(df: DataFrame) -> DataFrame:
    """Flat questions with the expected answer as a one-key document."""
    return df.withColumn("ground_truth", F.to_variant_object(F.struct(F.col("ground_truth").alias("ground_truth_output"))))
