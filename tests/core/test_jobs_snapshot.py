"""The two cases of the job snapshot that fix its meaning: an open job, and the durations of a closed one."""

import hashlib

from pyspark.sql import functions as F

from modlake.operators.facts import fct_jobs

ACTIONS = "job_id string, action string, action_source string, actor_type string, actioned_at timestamp, queue_slug string, job_status_after string, job_category string, job_created_at timestamp, job_num_reports long, job_priority long, entity_schema string, entity_id string, actor_user_email string"
CLOSURES = "job_closure_event_sk string, job_id string, closed_at timestamp, job_created_at timestamp, job_category string, queue_slug string, queue_is_multi_review boolean, entity_schema string, entity_id string"
DECISIONS = "job_id string, decided_at timestamp, handle_time_seconds long, is_automated boolean, is_human_decision boolean, is_final_decision boolean, reviewer_email string, decision_source_type string, first_id string, enforcement_action_count long, max_enforcement_severity_rank long, is_violating_outcome boolean, is_illegal_outcome boolean, is_cleared_outcome boolean"


def frame(spark, rows, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    text = ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([tuple(None if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in r) for r in rows], text)
    return df.select(*[F.col(n).cast(c.split()[1]).alias(n) for n, c in zip(names, schema.split(", "))])


def snapshot(spark, actions, closures, decisions):
    local = lambda df, *names: df.withColumns({f"{n}_local": F.col(f"{n}_at").cast("timestamp_ntz") for n in names})
    acted, closed = local(frame(spark, actions, ACTIONS), "job_created"), local(frame(spark, closures, CLOSURES), "closed", "job_created")
    policies = spark.createDataFrame([("pol-1", "Platform Integrity"), ("pol-2", "Another")], "policy_id string, policy_group_name string")
    out = fct_jobs(acted, closed, frame(spark, decisions, DECISIONS), policies)
    return [r.asDict() for r in out.collect()]


def expect(row, **wanted):
    assert {k: row[k] for k in wanted} == wanted


def test_open_job_without_closure(spark):
    t = "2026-07-01 {}:00:00+00:00"
    act = lambda action, source, actor, at, queue, mail: ("job-open", action, source, actor, t.format(at), queue, "open", "standard", t.format("08"), 1, 0, "text_post", "ent-open", mail)
    (row,) = snapshot(
        spark,
        [
            act("created", "manual", "user", "09", "flagged-text", "a@example.com"),
            act("changed_queue", "manual", "user", "10", "escalations", "a@example.com"),
            act("changed_queue", "workflow", "workflow", "11", "high-harm-review", None),
        ],
        [],
        [],
    )
    expect(row, job_id="job-open", is_closed=False, is_open=True, action_count=3, queue_change_count=2, was_moved_between_queues=True, current_queue_slug="high-harm-review", job_status="open")
    expect(row, workflow_action_count=1, human_action_count=2, closed_at=None, time_to_close_seconds=None, decision_count=0, has_action_history=True, missing_action_history=False, final_queue_key=hashlib.md5(b"high-harm-review").hexdigest())
    expect(row, open_age_at_last_action_secs=3 * 3600)


def test_durations_of_a_closed_job(spark):
    t = "2026-07-05 {}:00:00+00:00"
    (row,) = snapshot(
        spark,
        [("job-closed", "created", "manual", "user", t.format("09"), "user-reports", "open", "appeal", t.format("08"), 3, 1, "user", "ent-closed", "b@example.com")],
        [("c-closed", "job-closed", t.format("14"), t.format("08"), "appeal", "user-reports", False, "user", "ent-closed")],
        [("job-closed", t.format("13"), 18000, True, False, True, None, "automated", "pol-1", 1, 4, True, False, False)],
    )
    expect(row, is_closed=True, is_open=False, job_status="closed", time_to_close_seconds=21600, time_to_first_action_seconds=3600, handle_time_seconds=18000, decision_to_close_seconds=3600)
    expect(row, open_age_at_last_action_secs=None, decision_count=1, automated_decision_count=1, human_decision_count=0, closed_by_automated_decision=True, had_violating_outcome=True)
    expect(row, queue_change_count=0, was_moved_between_queues=False, final_policy_group_name="Platform Integrity")


def test_two_closures_and_a_closure_without_history(spark):
    t = "2026-07-05 {}:00:00+00:00"
    close = lambda key, job, at, queue: (key, job, t.format(at), t.format("08"), None, queue, None, None, None)
    rows = {r["job_id"]: r for r in snapshot(spark, [], [close("k1", "twice", "15", "a"), close("k2", "twice", "12", "b"), close("k3", "once", "10", None)], [])}
    expect(rows["twice"], closed_at=rows["twice"]["closed_at"], job_closure_event_sk="k2", final_queue_slug="b", time_to_close_seconds=4 * 3600, action_count=0)
    expect(rows["once"], job_status="closed", missing_action_history=True, decision_count=0, closed_by_automated_decision=False, final_queue_slug=None)


def test_distinct_counts_of_jobs_copy_no_rows(spark):
    from modlake.operators.facts import _distinct

    rows = spark.createDataFrame([("j", "a", "q"), ("j", None, "r"), ("j", "a", "q"), ("k", None, None)], "job_id string, x string, y string")
    got = rows.groupBy("job_id").agg(_distinct("x").alias("x"), _distinct("y").alias("y"))
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in got.collect()} == {("j", 1, 2), ("k", 0, 0)} and dict(got.dtypes)["x"] == "bigint"
