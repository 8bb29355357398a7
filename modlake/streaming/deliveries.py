"""The delivery stream: at-least-once webhooks deduplicated and upserted batch by batch."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modlake.functions.exprs import event_sk, event_time
from modlake.operators.incremental import Files, upsert
from modlake.sources.events import write_table
from modlake.sources.workspace import workspace


def delivery_stream(spark: SparkSession, path: str) -> DataFrame:
    """Landing files (event, payload as JSON text, import_ts) as a stream of parsed deliveries."""
    rows = spark.readStream.schema("event string, payload string, import_ts timestamp_ntz").parquet(path)
    parsed = rows.withColumn("payload", F.try_parse_json("payload"))
    return parsed.withColumns({"event_sk": event_sk(F.col("event"), F.col("payload")), "event_ts": event_time("payload", "timestamp")})


def deduplicated(stream: DataFrame, lateness: str = "72 hours") -> DataFrame:
    """One row for each delivery that repeats within the lateness; later repeats pass again. counted() counts them too."""
    return stream.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(["event_sk"])


def counted(stream: DataFrame, lateness: str = "72 hours") -> DataFrame:
    """One row for each delivery with the columns of the batch dedup: first and last import, deliveries so far.

    The state of a delivery is one row, kept until the watermark has passed its event time: the time is part of the
    content that the key stands for, so grouping by both is grouping by the key, and the engine drops the state by
    the time. Repeats after that are too late and leave the counts as they are. A delivery without an event time
    stays in the state. Rows come in update mode: each batch has the new totals of the deliveries that it brought.
    """
    held = stream.withWatermark("event_ts", lateness).groupBy("event_sk", "event", "event_ts").agg(
        F.first(F.to_json("payload")).alias("payload"), F.max(F.col("record_source") == "raw").alias("raw"), F.min("import_ts").alias("first_seen_at"),
        F.max("import_ts").alias("last_seen_at"), F.count(F.lit(1)).alias("delivery_count"),
    )
    return held.select(
        "event_sk", "event", "event_ts", "payload", F.when(F.col("raw"), "raw").otherwise("seed").alias("record_source"), "first_seen_at", "last_seen_at",
        "delivery_count", (F.col("delivery_count") > 1).alias("was_redelivered"),
    )


@contextmanager
def landed(batch: DataFrame) -> Iterator[DataFrame]:
    """The batch as a table while it is worked on: an upsert reads it several times, and each time would run the stream's plan again."""
    path = workspace(batch.sparkSession, "batch")
    try:
        yield write_table(batch, path)
    finally:
        Files(batch.sparkSession, path).delete(path)


def upserting(path: str, key: str = "event_sk") -> Callable[[DataFrame, int], None]:
    """A batch writer that upserts, so a batch that is run again changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with landed(batch.select("event_sk", "event", F.to_json("payload").alias("payload"), "import_ts", "event_ts")) as rows:
            upsert(batch.sparkSession, path, rows, key=key)

    return write


def upserting_counts(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer of counted(): the totals of a delivery replace those before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with landed(batch) as rows:
            upsert(batch.sparkSession, path, rows, key="event_sk", order="delivery_count")

    return write


def count_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there of a counted() stream and stop."""
    query = stream.writeStream.outputMode("update").foreachBatch(upserting_counts(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop."""
    query = stream.writeStream.foreachBatch(upserting(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
