import os

import pytest

from modlake.plans import metrics
from modlake.plans.metrics import DERIVED, DIMENSIONS, FACTS, METRICS, QUESTIONS, RELATIONSHIPS, TABLES, metrics_query, path, resolve

DATA = "/root/testdata/sf0.001"


def test_registry_sizes():
    sizes = [len(x) for x in (TABLES, RELATIONSHIPS, FACTS, DIMENSIONS, METRICS, DERIVED, QUESTIONS)]
    assert sizes == [8, 11, 12, 34, 28, 6, 16]
    for q in QUESTIONS.values():
        assert all(resolve(x) == x for x in (*q.dimensions, *q.metrics))


def test_names_and_synonyms():
    assert resolve("decisions.total_decisions") == "total_decisions" and resolve("handle time") == "median_handle_time_hours" and resolve("queue") == "queue_name"
    assert set(metrics.DIMENSION_WORDS) == set(DIMENSIONS) and set(metrics.METRIC_WORDS) == {*METRICS, *DERIVED} and set(metrics.COMMENTS) <= {*DIMENSIONS, *METRICS, *DERIVED}
    for kind, words in (("dimension", metrics.DIMENSION_WORDS), ("metric", metrics.METRIC_WORDS)):
        listed = [w.strip().lower() for ws in words.values() for w in ws.split(",")]
        assert len(listed) == len(set(listed))
        for name, ws in words.items():
            spoken = name.replace("_", " ")
            for w in [*ws.split(","), name, *([] if spoken in listed else [spoken])]:
                assert resolve(w.strip(), kind) == name
    assert resolve("violation type") == "policy_name" and resolve("vendor") == "decision_staffing_model" and resolve("reviewer vendor") == "staffing_model"
    assert resolve("cleared", "metric") == "cleared_decisions" and resolve("cleared", "dimension") == "decision_is_cleared"
    for name in ("nothing of the kind", "cleared"):
        with pytest.raises(KeyError):
            resolve(name)


def test_join_paths():
    assert [r[0] for r in path("decision_policies", "queues")] == ["decision_policies_to_decisions", "decisions_to_queues"]
    assert path("jobs", "jobs") == []
    for start in TABLES:
        for goal in TABLES:
            try:
                path(start, goal)
            except ValueError as e:
                assert "cannot be reached" in str(e)
    for start, goal in (("decisions", "policies"), ("jobs", "decisions"), ("queues", "jobs")):
        with pytest.raises(ValueError, match="cannot be reached"):
            path(start, goal)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver tables")
def test_grains_are_kept(spark):
    from modlake.plans.lake import bridged

    lake = bridged(spark, DATA)
    n = lake["fct_decisions"].count()
    one = metrics_query(lake, (), ("total_decisions", "policy_applications", "allocated_decisions", "automation_rate", "total_jobs")).first()
    assert one.total_decisions == n and one.policy_applications == lake["fct_decision_policies"].count() and one.total_jobs == lake["fct_jobs"].count()
    assert abs(one.allocated_decisions - lake["fct_decisions"].where("policy_count > 0").count()) < 0.01
    by = metrics_query(lake, ("queue_name",), ("total_decisions", "policy_applications"))
    assert sum(r.total_decisions for r in by.collect()) == n
    with pytest.raises(ValueError):
        metrics_query(lake, ("policy_area",), ("median_handle_time_hours",))
    top = metrics_query(lake, ("moderator_email",), ("total_job_actions",), order_by=("-total_job_actions", "moderator_email"), limit=3).collect()
    assert len(top) == 3 and top[0].total_job_actions >= top[-1].total_job_actions
    assert metrics_query(lake, ("job_status",), ("total_jobs",), where="job_status = 'nowhere'").count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver tables")
def test_facts_are_made_of_what_a_query_reads(spark):
    from modlake.plans.lake import Lake, bridged, landed

    whole = bridged(spark, DATA)
    for name in ("fct_jobs", "fct_decisions", "fct_decision_policies", "fct_job_actions"):
        whole[name]
    surfaces = {**whole.surfaces, "landed_job_actioned": lambda: landed(spark, DATA, "job.actioned"), "landed_job_closed": lambda: landed(spark, DATA, "job.closed")}

    def narrow(dimensions, names, unmade, **surface):
        lake = Lake({**surfaces, **surface})
        assert sorted(metrics_query(lake, dimensions, names).collect(), key=str) == sorted(metrics_query(whole, dimensions, names).collect(), key=str)
        assert not set(unmade) & set(lake.made)

    def unread():
        raise AssertionError("closures are not needed")

    narrow(("moderator_email",), ("total_job_actions",), ("stg_decisions", "dim_reviewer"), landed_job_closed=unread)
    narrow(("queue_name",), ("total_job_actions", "median_job_age_at_action_hours"), ("dim_queue",), landed_job_closed=unread)
    narrow((), ("jobs_cancelled_by_workflow",), ("stg_decisions", "dim_policy"))
    narrow(("queue_name",), ("median_handle_time_hours", "total_decisions"), ("stg_job_actions", "dim_reviewer", "dim_queue", "dim_policy"))
    narrow(("entity_type",), ("median_handle_time_hours",), ("dim_entity", "dim_policy"))
    narrow(("queue_name", "decision_staffing_model"), ("policy_applications",), ("dim_queue", "dim_policy"))
    lake = Lake(surfaces)
    lake.of("fct_jobs", {"job_id", "action_count"}), lake.of("fct_jobs", {"job_id", "is_closed"})
    assert "fct_jobs" in lake.made  # two queries share it
