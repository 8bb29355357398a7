"""Documents in all the shapes that senders produce, from landing to facts."""

import json

import pytest
from pyspark.sql import functions as F

from modlake.functions import exprs
from modlake.operators import staging
from modlake.operators.dedup import dedup_deliveries
from modlake.operators.dims import dim_enforcement_action, dim_entity, dim_reviewer
from modlake.plans.lake import BuildStopped, Lake, build_all
from modlake.sources.bridge import volume_events
from modlake.sources.events import SourceConfig, empty_events, eval_questions, read_policy_areas, resolve_events


def landed(spark, rows):
    """rows: (source, event, document or text, import time)."""
    rows = [(s, e, d if isinstance(d, str) or d is None else json.dumps(d), t) for s, e, d, t in rows]
    df = spark.createDataFrame(rows, "record_source string, event string, payload string, import_ts string")
    return df.withColumns({"payload": F.try_parse_json("payload"), "import_ts": F.col("import_ts").cast("timestamp_ntz")})


def test_times_of_all_forms(spark):
    texts = ["2026-07-01T10:00:00.5+05:00", "2026-07-01T10:00:00Z", "2026-07-01 10:00:00+00:00", "2024", "junk", None, "2026-13-01T00:00:00Z"]
    df = spark.createDataFrame([(json.dumps({"t": t}) if t else "{}", t) for t in texts], "p string, t string").withColumn("p", F.try_parse_json("p"))
    got = df.select(exprs.event_time("p", "t").cast("timestamp_ntz").alias("t"), exprs.utc_offset_seconds(F.col("t")).alias("o"), F.to_date(exprs.local_time(F.col("t"))).alias("d")).collect()
    assert [str(r.t)[:21] if r.t else None for r in got] == ["2026-07-01 05:00:00.5", "2026-07-01 10:00:00", "2026-07-01 10:00:00", None, None, None, None]
    assert [r.o for r in got[:3]] == [18000, 0, 0] and str(got[0].d) == "2026-07-01"


def test_boundaries_not_elapsed_time(spark):
    t = lambda s: F.lit(s).cast("timestamp")
    row = spark.range(1).select(
        exprs.seconds_between(t("2026-01-01 00:00:00.9"), t("2026-01-01 00:00:01.1")).alias("s"), exprs.minutes_between(t("2026-01-01 00:00:59"), t("2026-01-01 00:01:01")).alias("m"),
        exprs.seconds_between(F.lit(None).cast("timestamp"), t("2026-01-01 00:00:01")).alias("n"),
    ).first()
    assert (row.s, row.m, row.n) == (1, 1, None)


def test_arrays_null_missing_and_of_other_kinds(spark):
    docs = ['{"a": [{"x": false}, {"x": null}]}', '{"a": []}', '{"a": null}', "{}", '{"a": {"k": 1}}', '{"a": "text"}', None]
    df = spark.createDataFrame([(d,) for d in docs], "p string").select(F.try_variant_get(F.try_parse_json("p"), "$.a", "variant").alias("a"))
    got = df.select(exprs.length_of(F.col("a")).alias("n"), exprs.any_flag(F.col("a"), "x", False).alias("f")).collect()
    assert [r.n for r in got] == [2, 0, 0, 0, 0, 0, 0]
    assert [r.f for r in got] == [True] + [False] * 6


def test_delivery_identity_ignores_key_order_and_import_time(spark):
    rows = [
        ("seed", "e", '{"b": 1, "a": {"x": 1.0}}', "2026-01-01 00:00:00"), ("raw", "e", '{ "a": {"x": 1}, "b": 1 }', "2026-01-02 00:00:00"), ("seed", "f", '{"b": 1, "a": {"x": 1.0}}', "2026-01-01 00:00:00"),
        ("seed", "e", "not json", "2026-01-01 00:00:00"), ("seed", None, None, "2026-01-01 00:00:00"),
    ]
    got = {(r.event, r.event_sk): r for r in dedup_deliveries(landed(spark, rows)).collect()}
    assert len(got) == 4
    twice = next(r for r in got.values() if r.delivery_count == 2)
    assert twice.record_source == "raw" and twice.was_redelivered and str(twice.first_seen_at) == "2026-01-01 00:00:00" and str(twice.last_seen_at) == "2026-01-02 00:00:00"


def test_surrogate_keys_tell_nulls_from_text(spark):
    import hashlib

    row = spark.sql("SELECT 'a' AS x, CAST(NULL AS INT) AS y").select(exprs.surrogate_key("x", "y").alias("k")).first()
    assert row.k == hashlib.md5(f"a-{exprs.NULL_KEY}".encode()).hexdigest()


CLOSED = {
    "timestamp": "2026-07-01T12:00:00Z",
    "job": {"id": "j1", "created_at": "2026-07-01T10:00:00Z", "category": "qa_appeal", "queue": {"slug": "q-one", "is_multi_review": True}, "entity": {"entity_schema": "user", "attributes": {"id": "u1", "email": "u@x.test"}}},
    "decisions": [
        {"timestamp": "2026-07-01T11:00:00Z", "source": {"type": "manual", "user": {"name": "Ann", "email": " ANN@Example.com ", "groups": [{"name": "Acme BPO Moderator - Spam"}, {"name": "QA"}]}},
         "policies": [{"id": "p1", "name": "P1", "is_illegal": False, "is_non_violating": False, "enforcement_actions": ["ban_user"]}, {"id": "p2", "name": "P2", "parent_id": "p1", "is_illegal": True, "is_non_violating": True}],
         "enforcement_actions": ["ban_user", "brand_new"], "notes": " "},
        {"timestamp": "2026-07-01T11:30:00Z", "source": {}, "entity": {"entity_schema": "post", "attributes": {"id": "x9"}}, "policies": [], "enforcement_actions": None, "notes": "seen"},
    ],
}
ACTED = {
    "timestamp": "2026-07-01T10:30:00+00:00", "action": "brand_new_action", "source": "workflow", "notes": "",
    "job": {"id": "j1", "created_at": "2026-07-01T10:00:00Z", "queue": {"slug": "q-one"}, "status": "open", "priority": 2, "num_reports": 4, "job_category": "standard"},
    "action_made_by": {"workflow": {"id": "w1", "name": "W", "rule": {"id": "r", "name": "R"}, "trigger_type": "t", "event": {"event_name": "n", "entity": {"entity_schema": "user", "attributes": {"id": "u1"}}}}},
}


NOW = "2026-07-01 16:00:00"


@pytest.fixture
def lake(spark):
    closed = [("raw", "job.closed", CLOSED, "2026-07-01 13:00:00"), ("raw", "job.closed", CLOSED, "2026-07-01 14:00:00"), ("raw", "job.closed", {"job": {"id": "j2"}, "decisions": []}, "2026-07-01 13:00:00")]
    acted = [("seed", "job.actioned", ACTED, "2026-07-01 13:00:00"), ("seed", "job.actioned", {**ACTED, "action_made_by": {}, "timestamp": "2026-07-01T10:40:00+00:00"}, "2026-07-01 13:00:00")]
    areas = spark.createDataFrame([("area-1", "Area 1")], "policy_area_id string, policy_area_name string")
    return Lake({"landed_job_closed": landed(spark, closed), "landed_job_actioned": landed(spark, acted), "policy_areas": areas}, now=NOW)


def test_staging_of_planted_cases(lake):
    d = {r.decision_ordinal: r for r in lake["stg_decisions"].collect()}
    assert set(d) == {0, 1}
    assert (d[0].is_human_decision, d[0].is_automated, d[0].handle_time_seconds, d[0].has_notes, d[0].is_violating_outcome, d[0].is_illegal_outcome) == (True, False, 3600, False, True, True)
    assert (d[1].is_human_decision, d[1].is_automated, d[1].entity_schema, d[1].policy_count, d[1].enforcement_action_count, d[1].is_final_decision) == (None, True, "post", 0, 0, True)
    assert (d[0].entity_schema, d[0].entity_id, d[0].delivery_count, d[0].record_source) == ("user", "u1", 2, "raw")
    p = sorted(lake["stg_decision_policies"].collect(), key=lambda r: r.policy_ordinal)
    assert [(r.policy_id, r.is_root_policy, r.is_primary_policy, r.decision_count_allocated, r.policy_enforcement_action_count) for r in p] == [("p1", True, True, 0.5, 1), ("p2", False, False, 0.5, 0)]
    e = sorted(r.enforcement_action_slug for r in lake["stg_decision_enforcement_actions"].collect())
    assert e == ["ban_user", "brand_new"]
    a = {r.actor_type: r for r in lake["stg_job_actions"].collect()}
    assert set(a) == {"workflow", "none"}
    assert not a["none"].has_entity and a["workflow"].trigger_entity_id == "u1" and a["workflow"].job_category == "standard" and a["workflow"].job_age_at_action_seconds == 1800


def test_dimensions_of_planted_cases(lake):
    (r,) = lake["dim_reviewer"].collect()
    assert (r.reviewer_email, r.vendor_name, r.vendor_specialism, r.staffing_model, r.is_qa, r.is_admin, r.reviewer_groups_label) == ("ann@example.com", "Acme", "Spam", "Acme", True, False, "Acme BPO Moderator - Spam, QA")
    e = {(x.entity_schema, x.entity_id): x for x in lake["dim_entity"].collect()}
    assert e[("user", "u1")].entity_email == "u@x.test" and e[("user", "u1")].triggered_a_workflow and e[("user", "u1")].was_reviewed
    assert e[("post", "x9")].has_attributes and e[("post", "x9")].entity_email is None
    p = {x.policy_id: x for x in lake["dim_policy"].collect()}
    assert (p["p2"].policy_parent_name, p["p2"].policy_parent_name_source, p["p2"].policy_group_name, p["p2"].policy_severity_class) == ("P1", "observed_policy", "P1", "non_violating")
    s = {x.enforcement_action_slug: x for x in lake["dim_enforcement_action"].collect()}
    assert (s["brand_new"].enforcement_severity_rank, s["brand_new"].enforcement_category, s["brand_new"].is_recognised_action) == (0, "unclassified", False)
    assert s["ban_user"].enforcement_action_name == "Ban User"
    (q,) = lake["dim_queue"].collect()
    assert q.queue_name == "Q One" and q.observed_event_type_count == 3


def test_facts_of_planted_cases(lake):
    d = {r.decision_ordinal: r for r in lake["fct_decisions"].collect()}
    assert (d[0].staffing_model, d[1].staffing_model, d[0].included_account_ban, d[0].enforcement_action_count, d[0].distinct_policy_group_count) == ("Acme", "Automated", True, 2, 1)
    assert d[0].is_multi_review_decision and not d[0].is_cleared_outcome and d[0].primary_policy_group_name == "P1"
    jobs = {r.job_id: r for r in lake["fct_jobs"].collect()}
    assert set(jobs) == {"j1", "j2"} and jobs["j1"].closed_by_automated_decision and jobs["j1"].decision_count == 2 and jobs["j2"].decision_count == 0
    a = {r.actor_type: r for r in lake["fct_job_actions"].collect()}
    assert a["workflow"].acted_on_other_entity and a["workflow"].workflow_key and not a["none"].acted_on_other_entity and a["workflow"].trigger_entity_key


def test_build_stops_below_a_failing_table(spark, lake, tmp_path):
    with pytest.raises(BuildStopped, match="stg_job_closures__not_null_closed_at"):
        build_all(spark, Lake(lake.surfaces, now=NOW), f"file://{tmp_path}/c")
    sound = {**CLOSED, "decisions": [{**d, "source": {**d["source"], "type": d["source"].get("type", "api")}} for d in CLOSED["decisions"]]}
    lake = Lake({**lake.surfaces, "landed_job_closed": landed(spark, [("raw", "job.closed", sound, "2026-07-01 13:00:00")])}, now=NOW)
    built = build_all(spark, Lake(lake.surfaces, now=NOW), f"file://{tmp_path}/a")
    assert set(built) == {n for n in built if n.startswith(("dim_", "fct_"))} and len(built) == 10
    assert spark.read.parquet(f"file://{tmp_path}/a/_failed/stg_job_actions__accepted_action").count() == 2
    bad = Lake(lake.surfaces, now=NOW)
    dims = lake["dim_queue"]
    bad.made["dim_queue"] = dims.union(dims)
    with pytest.raises(BuildStopped, match="unique_queue_key"):
        build_all(spark, bad, f"file://{tmp_path}/b")
    assert not (tmp_path / "b" / "fct_jobs").exists()


@pytest.mark.parametrize("case", ["fresh", "stale", "old", "future", "empty"])
def test_build_stops_at_times_that_cannot_be(spark, lake, tmp_path, case):
    day = {"old": "2019-12-31", "future": "2026-07-03"}.get(case, "2026-07-01")
    decision = {**CLOSED["decisions"][0], "timestamp": f"{day}T11:00:00Z"}
    closed = landed(spark, [("raw", "job.closed", {**CLOSED, "decisions": [decision]}, "2026-07-01 13:00:00")])
    surfaces = {**lake.surfaces, "landed_job_closed": closed.limit(0) if case == "empty" else closed}
    at = Lake(surfaces, now={"stale": "2026-07-02 14:00:00"}.get(case, "2026-07-01 20:00:00"))
    if case == "fresh":
        build_all(spark, at, f"file://{tmp_path}/t")
        assert spark.read.parquet(f"file://{tmp_path}/t/_failed/landed_job_closed__freshness_warn").count() == 1  # seven hours are worth a warning
        return
    with pytest.raises(BuildStopped, match={"stale": "freshness_error", "empty": "freshness_error", "old": "implausibly_old", "future": "in_the_future"}[case]):
        build_all(spark, at, f"file://{tmp_path}/t")
    assert not (tmp_path / "t" / "dim_queue").exists()


def test_counts_of_tests_take_one_shuffle_of_keys(spark, lake):
    from modlake.operators import checks

    keyed = [t for name in checks.COLUMNS for t in checks.tests_of(name) if t.key]
    by_rows = {(t.table, t.kind): t.run(lake).count() for t in keyed}
    counts = {(r.table_name, r.test): r.n_failing for r in checks.failing_counts(lake).collect()}
    assert {k: counts[k] for k in by_rows} == by_rows and len(keyed) > 30
    df = spark.createDataFrame([("1:a", None), ("1", "a"), (None, "a"), (None, "a"), ("x", "a")], "a string, b string")
    one = checks.Test("t", "u", "error", key=("a", "b"))
    assert df.select(checks._key_text(one.key).alias("k")).distinct().count() == 4


def test_a_key_is_given_once_whatever_tests_look_at_it(spark):
    from modlake.operators import checks

    tests = [t for name in checks.COLUMNS for t in checks.tests_of(name)]
    places, given = checks._marks(tests)
    # its key, which two other tables refer to, and its reference to closures
    assert len(given["stg_decisions"]) == 2 and len(given["stg_job_closures"]) == 2
    assert len(set(places)) == len(tests)


def test_surfaces_by_mode(spark, tmp_path):
    (tmp_path / "s.csv").write_text('"event","payload","import_ts"\n"job.closed","{""a"": ""x, \\"" y""}","2026-01-01 00:00:00"\n"job.closed","broken {","2026-01-01 00:00:01"\n"other","{}","2026-01-01 00:00:01"\n')
    raw = landed(spark, [("raw", "job.closed", {"a": 1}, "2026-01-01 00:00:00")]).drop("record_source")
    raw.write.parquet(f"{tmp_path}/raw")
    config = lambda mode, **o: SourceConfig(mode=mode, overrides=o.get("o", {}), seeds={"job.closed": f"{tmp_path}/s.csv"}, raw={"job.closed": f"{tmp_path}/raw", "job.actioned": f"{tmp_path}/none"})
    count = lambda mode, event="job.closed", **o: resolve_events(spark, event, config(mode, **o)).count()
    assert [count("seed"), count("raw"), count("union"), count("seed", o={"job.closed": "raw"})] == [2, 1, 3, 1]
    assert count("raw", "job.actioned") == 0
    assert resolve_events(spark, "job.actioned", config("raw")).dtypes == empty_events(spark).dtypes == [("record_source", "string"), ("event", "string"), ("payload", "variant"), ("import_ts", "timestamp_ntz")]
    assert resolve_events(spark, "job.closed", config("seed")).where("payload IS NULL").count() == 1
    with pytest.raises(ValueError):
        resolve_events(spark, "job.closed", config("both"))
    (tmp_path / "areas.csv").write_text("policy_area_id,policy_area_name\na,A\n")
    assert read_policy_areas(spark, f"{tmp_path}/areas.csv").count() == 1


def test_volume_stream_and_questions(spark):
    df = volume_events(spark, 2000, 4)
    assert df.where("import_ts < event_ts OR import_ts > event_ts + INTERVAL 3 DAYS").count() == 0
    kinds = {r.event: r["count"] for r in df.groupBy("event").count().collect()}
    assert 5 < kinds["job.actioned"] / kinds["job.closed"] < 9
    q = eval_questions(spark.createDataFrame([("q1", "why?", "because")], "question_id string, query_text string, ground_truth string"))
    assert q.select(exprs.at("ground_truth", "ground_truth_output").alias("g")).first().g == "because"


def test_on_or_after_is_the_truncated_comparison_and_is_pushed_down(spark, tmp_path):
    df = spark.range(0, 2000).select(F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, id)").alias("t"))
    df.write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    for unit in ("day", "week", "month", "hour"):
        for limit in ("2024-01-15 00:00:00", "2024-01-17 05:30:00", "2024-02-01 00:00:00"):
            lit = F.expr(f"TIMESTAMP_NTZ '{limit}'")
            assert rows.where(exprs.on_or_after("t", unit, lit)).count() == rows.where(F.date_trunc(unit, F.col("t")) >= lit).count()
    plan = rows.where(exprs.on_or_after("t", "week", F.expr("TIMESTAMP_NTZ '2024-01-17 05:30:00'")))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(t" in plan


def test_closures_without_time_keep_null_durations(lake):
    row = lake["stg_job_closures"].where("job_id = 'j2'").first()
    assert row.time_to_close_seconds is None and row.closure_decision_count == 0
    assert staging.decisions(lake["stg_job_closures"].where("job_id = 'j2'")).count() == 0
    assert dim_reviewer(lake["stg_decisions"].limit(0), lake["stg_job_actions"].limit(0)).count() == 0
    assert dim_entity(lake["stg_decisions"].limit(0), lake["stg_job_actions"].limit(0), lake["stg_job_closures"].limit(0)).count() == 0
    assert dim_enforcement_action(lake["stg_decision_enforcement_actions"].limit(0)).count() == 0


def test_local_calendar_keeps_the_senders_day(spark):
    here = {**CLOSED, "timestamp": "2026-07-01T00:00:00.5+05:00", "decisions": [{**CLOSED["decisions"][0], "timestamp": "2026-06-30T23:30:00-08:00"}]}
    areas = spark.createDataFrame([], "policy_area_id string, policy_area_name string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            lake = Lake({"landed_job_closed": landed(spark, [("raw", "job.closed", here, "2026-07-01 13:00:00")]), "landed_job_actioned": landed(spark, []), "policy_areas": areas})
            d = lake["fct_decisions"].select("decided_date", "decided_hour_of_day", "decided_utc_offset_seconds", exprs.without_zone(F.col("decided_at")).alias("t")).first()
            assert (str(d.decided_date), d.decided_hour_of_day, d.decided_utc_offset_seconds, str(d.t)) == ("2026-06-30", 23, -28800, "2026-07-01 07:30:00")
            j = lake["fct_jobs"].select("closed_date", "closed_month", "created_date").first()
            assert (str(j.closed_date), str(j.closed_month), str(j.created_date)) == ("2026-07-01", "2026-07-01", "2026-07-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_every_column_test_finds_what_breaks_it(spark, lake):
    from modlake.operators import checks

    counts = {(r.table_name, r.test): r.n_failing for r in checks.failing_counts(lake).collect()}
    assert counts[("stg_job_closures", "not_null_closed_at")] == 1 and counts[("stg_job_actions", "accepted_action")] == 2 and counts[("stg_decisions", "not_null_decision_source_type")] == 1
    assert counts[("stg_job_closures", "without_decisions")] == 1 and counts[("fct_decisions", "unique_decision_sk")] == 0
    for name in ("stg_decisions", "fct_decision_policies", "fct_jobs"):
        broken = Lake({**lake.surfaces})
        broken.made = {**lake.made, name: lake[name].unionByName(lake[name].select(*[F.lit(None).cast(t).alias(c) for c, t in lake[name].dtypes]))}
        got = {r.test: r.n_failing for r in checks.failing_counts(broken, [name]).collect()}
        assert all(n > 0 for t, n in got.items() if t.startswith("not_null_"))
        twice = Lake({**lake.surfaces})
        twice.made = {**lake.made, name: lake[name].unionByName(lake[name])}
        got = {r.test: r.n_failing for r in checks.failing_counts(twice, [name]).collect()}
        assert all(n > 0 for t, n in got.items() if t.startswith("unique_"))


def test_written_documents_stay_whole(spark, tmp_path):
    import pyarrow.parquet as pq

    from modlake.sources.events import write_table

    name = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(name, None)
    rows = spark.range(100).select(F.try_parse_json(F.concat(F.lit('{"job": {"id": "j'), F.col("id"), F.lit('"}}'))).alias("payload"))
    again = write_table(rows, f"file://{tmp_path}/t")
    assert all("typed_value" not in str(pq.read_schema(f)) for f in (tmp_path / "t").glob("*.parquet"))
    assert again.where(F.try_variant_get("payload", "$.job.id", "string") == "j7").count() == 1
    assert spark.conf.get(name, None) == before
