from datetime import datetime, timedelta

from pyspark.sql import functions as F

from modlake.functions.exprs import event_sk
from modlake.operators.dedup import dedup_deliveries
from modlake.streaming.deliveries import count_available, counted

SCHEMA = "record_source string, event string, payload string, import_ts timestamp_ntz"


def keyed(rows):
    parsed = rows.withColumn("payload", F.try_parse_json("payload"))
    at = F.try_variant_get("payload", "$.at", "string").cast("timestamp")
    return parsed.withColumns({"event_sk": event_sk(F.col("event"), F.col("payload")), "event_ts": at})


def delivery(day, k, hours, source="raw"):
    at = datetime(2026, 1, 1) + timedelta(days=day)
    return (source, "job.closed", f'{{"at": "{at}", "k": {k}}}', at + timedelta(hours=hours))


def run(spark, folder, batches, lateness):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    return count_available(counted(keyed(stream), lateness), f"{folder}/table", f"{folder}/checkpoint")


def test_counts_equal_those_of_the_batch(spark, tmp_path):
    days = [[delivery(d, k, 1) for k in range(8)] + [delivery(d, k, 1 + k, "seed" if k % 2 else "raw") for k in range(5)] + [delivery(d - 1, k, 30) for k in range(3) if d] for d in range(4)]
    run(spark, tmp_path, days, "72 hours")
    columns = ["event_sk", "event", "record_source", "first_seen_at", "last_seen_at", "delivery_count", "was_redelivered"]
    got = spark.read.parquet(f"{tmp_path}/table").select(columns)
    want = dedup_deliveries(spark.createDataFrame(sum(days, []), SCHEMA).withColumn("payload", F.try_parse_json("payload"))).select(columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 32
    assert not (tmp_path / "table__staged").exists()


def test_state_ends_with_the_lateness(spark, tmp_path):
    days = [[delivery(d, k, 1) for k in range(50)] for d in range(0, 40, 2)] + [[delivery(0, 0, 2), delivery(38, 1, 2)], [delivery(60, 0, 1)]]
    query = run(spark, tmp_path, days, "5 days")
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(held) <= 50 * 5 and held[-1] <= 51  # a few days' deliveries, not all twenty
    counts = {r.payload: r.delivery_count for r in spark.read.parquet(f"{tmp_path}/table").where("delivery_count > 1").collect()}
    assert len(counts) == 1 and '"k":1' in next(iter(counts))  # the repeat after the lateness left its count alone
