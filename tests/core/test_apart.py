from pyspark.sql import functions as F

from modlake.operators.dedup import dedup_apart, dedup_deliveries, repeated
from modlake.plans.lake import Lake, bridged

DATA = "/root/testdata/sf0.001"


def test_told_apart_as_by_whole_documents(spark):
    doc = '{"timestamp": "t%s", "job": {"id": %s}, "n": %s}'
    texts = [doc % (k, k, 0) for k in range(5)] + [doc % (1, 1, 0), doc % (2, 2, 1), '{"n": 0, "job": {"id": 3}, "timestamp": "t3"}', doc % (4, "4.0", 0), doc % (4, '"4"', 0)]
    texts += [None, None, "no document", "[1]", "[1]", "{}", '{"job": 7}', '{"job": null}', '{"job": {"id": null}}', '{"job": {"id": {"b": 1, "a": 2}}}', '{"job": {"id": {"a": 2, "b": 1}}}']
    rows = [("raw" if k % 3 else "seed", e, t, f"2026-01-{k + 1:02d} 00:00:00") for k, t in enumerate(texts) for e in ("e", None)]
    events = spark.createDataFrame(rows, "record_source string, event string, payload string, import_ts string")
    events = events.withColumns({"payload": F.try_parse_json("payload"), "import_ts": F.col("import_ts").cast("timestamp_ntz")})
    shown = lambda df: sorted(map(str, df.withColumn("payload", F.to_json("payload")).collect()))
    alike = repeated(events)
    assert shown(dedup_apart(events, alike)) == shown(dedup_deliveries(events))
    assert dedup_apart(events, alike).schema.simpleString() == dedup_deliveries(events).schema.simpleString()
    assert alike.count() < events.select("payload", "event").count()


def test_a_single_reader_keeps_nothing_but_what_tells_deliveries_apart(spark):
    """Times of decisions are read without a table of decisions or closures, and without the keys that hash documents."""
    base, kept = bridged(spark, DATA), []

    def keep(name, df):
        kept.append(name)
        return df

    lake = Lake({n: base[n] for n in base.surfaces}, keep)
    times = lake.of("stg_decisions", {"decided_at"})
    assert kept == ["repeated_job_closed", "stg_decisions_narrow"]
    plan = times._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan.split("Aggregate")[0]
    lake.of("stg_decisions", {"decided_at", "job_id"})
    assert set(kept) == {"repeated_job_closed", "stg_decisions_narrow", "stg_job_closures", "stg_decisions"}
