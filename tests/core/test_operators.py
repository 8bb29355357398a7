import os
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from modlake.operators import checks, incremental, layout, privacy
from modlake.operators.dims import latest_wins


def test_latest_wins_is_stable(spark):
    rows = [("a", 1, "old"), ("a", 2, "x"), ("a", 2, "y"), ("b", None, "only"), ("c", None, "null"), ("c", 0, "zero")]
    df = spark.createDataFrame(rows, "k string, t int, v string").repartition(3)
    got = {r.k: r.v for r in latest_wins(df, ["k"], [F.desc_nulls_last("t"), F.desc("v")]).collect()}
    assert got == {"a": "y", "b": "only", "c": "zero"}


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", 0.0), (2, None, 9.0), (None, "a", None), (None, "z", 1.0)], "k int, s string, x double")
    assert [(r.k, r.n_rows) for r in checks.unique(df, "k").collect()] == [(1, 2)]
    assert checks.unique(df, "k", "s").count() == 0
    assert checks.not_null(df, "s").count() == 1
    assert [(r.s, r.n_rows) for r in checks.accepted_values(df, "s", ["a", "b"]).collect()] == [("z", 1)]
    dim = spark.createDataFrame([(1,)], "pk int")
    assert [r.k for r in checks.relationships(df, "k", dim, "pk").collect()] == [2]
    assert checks.accepted_range(df, "x", 0, 5).count() == 1 and checks.accepted_range(df, "x", 0, 5, inclusive=False).count() == 3


def test_score_gate_refuses_empty_and_falling_runs(spark):
    s = "input string, metric_name string, eval_agg_score double"
    now = spark.createDataFrame([("q1", "m", 0.9), ("q2", "m", 0.5)], s)
    before = spark.createDataFrame([("q1", "m", 0.9), ("q2", "m", 0.8)], s)
    assert checks.score_gate(now, None, {"m": 0.6}).count() == 0
    assert [r.reason for r in checks.score_gate(now, before, {"m": 0.8}).orderBy("reason").collect()] == ["below_minimum", "regression"]
    assert [r.reason for r in checks.score_gate(now.limit(0), before, {"m": 0.8}).collect()] == ["no_scores"]


def test_freshness_states(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2026-01-01 00:00:00' AS import_ts")
    state = lambda now: checks.freshness(df, now).first().status
    assert [state("2026-01-01 05:00:00"), state("2026-01-01 07:00:00"), state("2026-01-02 01:00:00")] == ["pass", "warn", "error"]
    assert checks.freshness(df.limit(0), "2026-01-01 00:00:00").first().status == "error"


def test_masks(spark):
    df = spark.createDataFrame([("a@b.test",), ("plain",), (None,)], "c string")
    got = [[r[0] for r in df.select(privacy.mask_text(F.col("c"), k)).collect()] for k in ("EMAIL", "NAME", "FREE_TEXT", "UNHEARD_OF")]
    assert got == [["***@b.test", "***", None], [privacy.REDACTED, privacy.REDACTED, None], ["*** 8 CHARS REDACTED ***", "*** 5 CHARS REDACTED ***", None], [privacy.REDACTED, privacy.REDACTED, None]]
    assert df.select(privacy.mask_text(F.col("c"), "IDENTIFIER").alias("m")).where("m = sha2(c, 256) OR m IS NULL AND c IS NULL").count() == 3
    bag = spark.sql("""SELECT parse_json('{"id": "x", "email": "a@b.test", "media_count": 3}') AS b UNION ALL SELECT NULL""")
    out = [r[0] for r in bag.select(F.to_json(privacy.mask_bag(F.col("b")))).collect()]
    assert out[1] is None and "a@b.test" not in out[0] and '"media_count":3' in out[0] and "_redacted" in out[0] and '"x"' not in out[0]
    assert bag.select(F.to_json(privacy.withhold_payload(F.col("b"))).alias("w")).where("w LIKE '%withheld%'").count() == 1


def test_tags_are_audited_and_applied(spark):
    df = spark.createDataFrame([("k", "a@b.test", "Ann")], "reviewer_key string, reviewer_email string, reviewer_name string")
    assert {x[1] for x in privacy.audit_tags({"dim_reviewer": df})} == {"reviewer_email", "reviewer_name"}
    assert privacy.audit_tags({"dim_reviewer": privacy.tag(df, "dim_reviewer")}) == []
    row = privacy.apply_masking(df, "dim_reviewer").first()
    assert tuple(row) == ("k", "***@b.test", privacy.REDACTED)
    assert tuple(privacy.apply_masking(df, "dim_reviewer", privileged=True).first()) == ("k", "a@b.test", "Ann")


def test_layout_of_sorted_and_shuffled_files(spark, tmp_path):
    rows = spark.range(0, 1000)
    rows.repartitionByRange(5, "id").write.parquet(f"{tmp_path}/sorted")
    rows.repartition(5).write.parquet(f"{tmp_path}/mixed")
    good, bad = (layout.layout_profile(spark, f"{tmp_path}/{d}", "id") for d in ("sorted", "mixed"))
    assert sum(r.n_rows for r in good.collect()) == 1000
    assert {r.overlaps for r in good.collect()} == {0} and {r.overlaps for r in bad.collect()} == {4}
    assert layout.average_overlaps(bad).first().average_overlaps == 4
    kept = lambda p: (lambda r: (r.files_kept, r.files))(layout.pruning_report(p, low=900).first())
    assert kept(good) == (1, 5) and kept(bad) == (5, 5)
    piece = spark.range(0, 10).withColumnRenamed("id", "key")
    assert layout.merge_probe(spark.read.parquet(f"{tmp_path}/sorted"), piece.withColumnRenamed("key", "id"), "id").count() == 1


def brute_overlaps(ranges):
    return [sum(1 for j, b in enumerate(ranges) if j != i and a[0] <= b[1] and b[0] <= a[1]) for i, a in enumerate(ranges)]


def test_overlaps_against_brute_force(spark, tmp_path):
    ranges = [(0, 10), (10, 20), (5, 6), (30, 40), (35, 35), (40, 50)]
    for a, b in ranges:
        spark.createDataFrame([(a,), (b,)], "v int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
    got = {(r.low, r.high): r.overlaps for r in layout.layout_profile(spark, f"{tmp_path}/t", "v").collect()}
    assert [got[r] for r in ranges] == brute_overlaps(ranges)


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id int, ts string, v string").select("event_id", F.col("ts").cast("timestamp_ntz").alias("event_ts"), F.col("ts").cast("timestamp_ntz").alias("import_ts"), "v")


def test_incremental_upsert_rewrites_touched_dates_only(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = events(spark, [(1, "2026-01-01 10:00:00", "a"), (2, "2026-01-02 10:00:00", "b"), (3, "2026-01-02 11:00:00", "c")])
    incremental.upsert(spark, path, first)
    untouched = {f: os.path.getmtime(f"{tmp_path}/t/event_date=2026-01-01/{f}") for f in os.listdir(f"{tmp_path}/t/event_date=2026-01-01")}
    target = spark.read.parquet(path)
    source = events(spark, [(1, "2026-01-01 10:00:00", "late"), (3, "2026-01-02 11:00:00", "new"), (4, "2026-01-02 09:00:00", "d"), (9, "2026-01-01 12:00:00", "missed")]).withColumn("extra", F.lit(7))
    piece = incremental.incremental_slice(source, target)
    assert sorted(r.event_id for r in piece.collect()) == [3, 4]
    assert [r.event_id for r in incremental.late_rows(source, target).collect()] == [9]
    out = incremental.upsert(spark, path, piece)
    assert sorted((r.event_id, r.v, r.extra) for r in out.collect()) == [(1, "a", None), (2, "b", None), (3, "new", 7), (4, "d", 7)]
    assert untouched == {f: os.path.getmtime(f"{tmp_path}/t/event_date=2026-01-01/{f}") for f in os.listdir(f"{tmp_path}/t/event_date=2026-01-01")}
    again = incremental.upsert(spark, path, piece)
    assert again.count() == 4
    assert incremental.incremental_slice(source, None).count() == 4 and incremental.late_rows(source, target.limit(0)).count() == 0
    assert not [f for f in os.listdir(tmp_path) if "__staged" in f]
    two = events(spark, [(5, "2026-01-03 00:00:00", "x"), (5, "2026-01-03 00:00:00", "y")])
    assert incremental.merged(None, two).count() == 1


def test_upsert_keeps_rows_without_a_time(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = lambda *ids: events(spark, [(i, None if i % 2 else "2026-01-02 10:00:00", f"{i}") for i in ids])
    incremental.upsert(spark, path, rows(1, 2))
    out = incremental.upsert(spark, path, rows(3, 4))
    assert sorted((r.event_id, r.v) for r in out.collect()) == [(1, "1"), (2, "2"), (3, "3"), (4, "4")]
    again = incremental.upsert(spark, path, rows(1, 6))
    assert sorted(r.event_id for r in again.collect()) == [1, 2, 3, 4, 6]


def test_stream_drops_redeliveries(spark, tmp_path):
    from modlake.streaming.deliveries import deduplicated, delivery_stream, run_available

    doc = '{{"timestamp": "2026-01-01T0{}:00:00Z", "n": {}}}'
    land = lambda rows, name: spark.createDataFrame([("e", doc.format(h, n), f"2026-01-01 0{h}:00:00") for h, n in rows], "event string, payload string, t string").select(
        "event", "payload", F.col("t").cast("timestamp_ntz").alias("import_ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    land([(1, 1), (1, 1), (2, 2)], "a")
    run = lambda: run_available(deduplicated(delivery_stream(spark, f"{tmp_path}/in")), f"file://{tmp_path}/out", f"file://{tmp_path}/ck")
    run()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    land([(1, 1), (3, 3)], "b")
    run()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_projection_of_the_volume_stream(spark):
    from modlake.sources.bridge import volume_events

    rows = incremental.projected(volume_events(spark, 50, 2))
    assert rows.where("trace_id IS NULL OR content_fingerprint IS NULL OR ingestion_lag_minutes NOT BETWEEN 0 AND 4320").count() == 0


def _moved(spark, *rows):
    return spark.createDataFrame([(k, t and datetime.fromisoformat(t), datetime(2026, 2, n), n) for k, t, n in rows], "event_id long, event_ts timestamp_ntz, import_ts timestamp_ntz, n int")


def test_upsert_moves_rows_whose_time_moves(spark, tmp_path):
    path = f"{tmp_path}/t"
    incremental.upsert(spark, path, _moved(spark, (1, "2026-01-01 00:00:00", 1), (2, "2026-01-01 01:00:00", 1), (3, None, 1), (None, "2026-01-05 00:00:00", 1), (4, "2026-01-09 00:00:00", 1)))
    quiet = [f for f in os.listdir(f"{path}/event_date=2026-01-09")]
    out = incremental.upsert(spark, path, _moved(spark, (1, "2026-01-02 00:00:00", 2), (3, "2026-01-01 05:00:00", 2), (None, None, 2), (2, "2026-01-03 00:00:00", 3), (2, "2026-01-04 00:00:00", 2)))
    rows = lambda df: sorted(((r.event_id, str(r.event_date), r.n) for r in df.collect()), key=str)
    want = [(1, "2026-01-02", 2), (2, "2026-01-03", 3), (3, "2026-01-01", 2), (4, "2026-01-09", 1), (None, "None", 2)]
    assert rows(out) == want and quiet == os.listdir(f"{path}/event_date=2026-01-09")
    assert not os.path.exists(f"{path}/event_date=2026-01-05")  # a date left without rows goes
    incremental.compact_keys(spark, path)
    assert [f for f in os.listdir(incremental.keys_path(path)) if "batch" in f] == ["batch=2"] and rows(incremental.upsert(spark, path, _moved(spark, (3, None, 9)))) == sorted([*want[:2], (3, "None", 9), *want[3:]], key=str)
    shutil.rmtree(incremental.keys_path(path))  # a table from before there were keys beside it
    assert (1, "2026-01-07", 8) in (got := rows(incremental.upsert(spark, path, _moved(spark, (1, "2026-01-07 00:00:00", 8))))) and len(got) == 5


def test_upserts_cut_off_are_finished_or_dropped(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    incremental.upsert(spark, path, _moved(spark, (1, "2026-01-01 00:00:00", 1), (2, "2026-01-02 00:00:00", 1)))
    broken = lambda *a: (_ for _ in ()).throw(OSError("lost"))
    with monkeypatch.context() as m:
        m.setattr(incremental.Files, "write_text", broken)
        with pytest.raises(OSError):
            incremental.upsert(spark, path, _moved(spark, (1, "2026-01-03 00:00:00", 2)))
    incremental.recover(spark, path)
    ids = lambda: sorted((r.event_id, r.n) for r in spark.read.parquet(path).collect())
    assert ids() == [(1, 1), (2, 1)]
    with monkeypatch.context() as m:
        m.setattr(incremental, "_log_keys", broken)
        with pytest.raises(OSError):
            incremental.upsert(spark, path, _moved(spark, (1, "2026-01-03 00:00:00", 2)))
    incremental.recover(spark, path)
    assert ids() == [(1, 2), (2, 1)] and not [f for f in os.listdir(tmp_path) if "staged" in f]
    incremental.upsert(spark, path, _moved(spark, (1, "2026-01-04 00:00:00", 3)))
    assert ids() == [(1, 3), (2, 1)]


def test_documents_pass_the_merge(spark):
    df = spark.createDataFrame([(1, "a", '{"x": 1}'), (1, "b", '{"x": 2}'), (2, "a", None)], "event_id long, import_ts string, doc string").withColumn("doc", F.try_parse_json("doc"))
    got = {r.event_id: r.d for r in incremental.merged(None, df).select("event_id", F.to_json("doc").alias("d")).collect()}
    assert got == {1: '{"x":2}', 2: None}


def test_categories_follow_columns(spark, tmp_path):
    df = privacy.tag(spark.createDataFrame([("k", "a@b.test", "Ann", "x", 3)], "reviewer_key string, reviewer_email string, reviewer_name string, phone string, n int"), "dim_reviewer")
    df.write.parquet(f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert privacy.audit_tags({"dim_reviewer": back}) == []
    row = privacy.apply_masking(back, "dim_reviewer").first()
    assert tuple(row) == ("k", "***@b.test", privacy.REDACTED, privacy.REDACTED, 3)  # a column that nobody has declared is withheld
    other = spark.createDataFrame([("k", True)], "id string, flag boolean")
    copy = back.select(F.col("reviewer_key").alias("id"), F.col("reviewer_email").alias("job_id"), F.col("n").alias("m")).join(other, "id").groupBy("job_id", "flag").agg(F.max("m").alias("m"), F.max("job_id").alias("top"))
    assert tuple(privacy.readable(copy).first()) == ("***@b.test", True, 3, privacy.REDACTED)
    assert tuple(privacy.readable(copy, privileged=True).first()) == ("a@b.test", True, 3, "a@b.test")
    built = back.select(F.lower("reviewer_name").alias("a"), F.array("reviewer_email").alias("b"), F.length("reviewer_name").alias("c"), F.struct("reviewer_name").alias("d"))
    assert tuple(privacy.readable(built).first()) == (privacy.REDACTED, None, 3, None)
    renamed = privacy.tag(copy, "fct_jobs")  # the name of a readable column does not undo the category it brings
    assert privacy.readable(renamed).first().job_id == "***@b.test"
