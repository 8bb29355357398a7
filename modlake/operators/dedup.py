"""Collapse of redeliveries to one row per content."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modlake.functions.exprs import event_sk

#: Paths whose values tell most deliveries apart; which they are only decides how much is compared by whole documents.
TELLING = ("timestamp", "job.id")


def _likeness(rows: DataFrame) -> DataFrame:
    """rows with a number that equal deliveries share: documents with the same canonical text have the same text at a path."""
    return rows.withColumn("__like", F.xxhash64("event", *[F.to_json(F.try_variant_get("payload", f"$.{path}", "variant")) for path in TELLING]))


def repeated(events: DataFrame) -> DataFrame:
    """The likenesses of deliveries that came, or may have come, more than once: one number each."""
    return _likeness(events).groupBy("__like").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__like")


def dedup_apart(events: DataFrame, alike: DataFrame) -> DataFrame:
    """dedup_deliveries(events), given repeated(events) as a table: only what is in it is grouped by whole documents.

    The others came once, so they are neither moved nor, unless their key is read, written out as canonical text.
    """
    rows, alike = _likeness(events), alike.select(F.col("__like").alias("__again"))
    like = F.col("__like") == F.col("__again")
    raw = F.col("record_source") == "raw"
    once = rows.join(alike, like, "left_anti").select(
        event_sk(F.col("event"), F.col("payload")).alias("event_sk"), "event", "payload", F.col("import_ts").alias("first_seen_at"), F.col("import_ts").alias("last_seen_at"),
        F.lit(1).cast("long").alias("delivery_count"), F.lit(False).alias("was_redelivered"), F.when(raw, "raw").otherwise("seed").alias("record_source"),
    )
    return once.unionByName(dedup_deliveries(rows.join(alike, like, "left_semi").drop("__like")))


def dedup_deliveries(events: DataFrame) -> DataFrame:
    """One row for each event type and canonical payload, with when and how often it came.

    Counts and extremes combine before the shuffle, so a delivery repeated very often is one row a task.
    A delivery seen on any raw surface counts as raw. An event_sk that the rows have already is taken.
    """
    keyed = events if "event_sk" in events.columns else events.withColumn("event_sk", event_sk(F.col("event"), F.col("payload")))
    grouped = keyed.groupBy("event_sk", "event").agg(
        F.any_value("payload").alias("payload"),
        F.min("import_ts").alias("first_seen_at"),
        F.max("import_ts").alias("last_seen_at"),
        F.count(F.lit(1)).alias("delivery_count"),
        F.max(F.col("record_source") == "raw").alias("raw"),
    )
    return grouped.select(
        "event_sk", "event", "payload", "first_seen_at", "last_seen_at", "delivery_count", (F.col("delivery_count") > 1).alias("was_redelivered"),
        F.when(F.col("raw"), "raw").otherwise("seed").alias("record_source"),
    )
