"""One walk over a document gives what a path for each column gave, whatever shape the document has."""

import json

import pytest
from pyspark.sql import functions as F

from modlake.functions.exprs import at
from modlake.operators import staging
from modlake.operators.dedup import dedup_deliveries
from modlake.plans import lake as lakes
from modlake.plans.registry import QUERIES
from modlake.sources import bridge
from modlake.sources.events import write_table
from tests.core.test_events import ACTED, landed

SF = "/root/testdata/sf0.001"
ODD = [
    "[]", '"text"', "7", "null", "{}", '{"job": null}', '{"job": []}', '{"job": "j"}', '{"job": {"queue": "q", "entity": []}}',
    '{"action": 5, "notes": {"a": [1, "b"]}, "source": true, "job": {"id": 12, "priority": "3", "num_reports": 2.0, "queue": {"slug": 1.5, "is_multi_review": "true"}}}',
    '{"action": null, "action_made_by": {"user": {"name": ["x"], "email": 1, "groups": {"name": "no list"}}, "workflow": {"rule": "r", "event": {"entity": {"attributes": [1]}}}}}',
    '{"job": {"job_category": null, "category": "appeal", "priority": 99999999999999999999, "entity": {"entity_schema": "s", "attributes": {"id": {"deep": 1}}}}}',
]


def test_actions_of_odd_documents(spark):
    paths = {
        "action": "action", "action_source": "source", "notes": "notes", "job_id": "job.id", "queue_slug": "job.queue.slug", "job_status_after": "job.status", "entity_schema": "job.entity.entity_schema",
        "entity_id": "job.entity.attributes.id", "actor_user_name": "action_made_by.user.name", "actor_user_email": "action_made_by.user.email", "actor_workflow_id": "action_made_by.workflow.id",
        "actor_workflow_rule_id": "action_made_by.workflow.rule.id", "trigger_entity_id": "action_made_by.workflow.event.entity.attributes.id",
    }
    base = dedup_deliveries(landed(spark, [("raw", "e", d, "2026-01-01 00:00:00") for d in [*ODD, json.dumps(ACTED), None]]))
    wanted = {c: at("payload", p) for c, p in paths.items()} | {
        "queue_is_multi_review": at("payload", "job.queue.is_multi_review", "boolean"), "job_priority": at("payload", "job.priority", "bigint"), "job_num_reports": at("payload", "job.num_reports", "bigint"),
        "job_category": F.coalesce(at("payload", "job.job_category"), at("payload", "job.category")),
    }
    rows = staging.job_actions(base)
    got = {r[0]: r for r in rows.select("job_action_event_sk", *wanted).collect()}
    assert got == {r[0]: r for r in base.select(F.col("event_sk").alias("job_action_event_sk"), *[c.alias(n) for n, c in wanted.items()]).collect()} and len(got) == len(ODD) + 2
    walks = rows._jdf.queryExecution().optimizedPlan().toString().count("variant_get(payload")
    assert walks == 1  # before, one for each column and more for times


def test_decisions_of_odd_documents(spark):
    odd = ["null", "7", "[]", '"x"', "{}", '{"source": "s", "policies": {}, "enforcement_actions": "ban_user"}', '{"entity": {"attributes": {"id": 5}}, "source": {"type": 1, "user": {"groups": ["g", {"name": 3}, {"name": null}]}}}',
           '{"policies": [null, 1, "p", [], {"id": 4, "is_illegal": "true", "is_non_violating": null}, {"parent_id": "x", "is_non_violating": false, "enforcement_actions": [1, null, "a"]}], "enforcement_actions": [null, 2, "warn_user", {"a": 1}]}']
    docs = ["{" + f'"job": {{"id": "j{i}"}}, "decisions": {d}' + "}" for i, d in enumerate([f"[{', '.join(odd)}]", "[]", "{}", "null", '"text"'])]
    closures = staging.job_closures(dedup_deliveries(landed(spark, [("raw", "e", d, "2026-01-01 00:00:00") for d in docs])))
    assert {r.job_id: r.closure_decision_count for r in closures.collect()} == {"j0": len(odd), "j1": 0, "j2": 0, "j3": 0, "j4": 0}
    decided = staging.decisions(closures)
    by_path = closures.select(F.posexplode(F.try_variant_get("closure_decisions", "$", "array<variant>")).alias("n", "d")).select(
        F.col("n").cast("long"), at("d", "source.type"), at("d", "entity.attributes.id"), at("d", "notes"), F.coalesce(F.size(F.try_variant_get("d", "$.policies", "array<variant>")), F.lit(0)).cast("long"),
        F.coalesce(F.size(F.try_variant_get("d", "$.enforcement_actions", "array<variant>")), F.lit(0)).cast("long"),
    )
    got = decided.select("decision_ordinal", "decision_source_type", "entity_id", "notes", "policy_count", "enforcement_action_count").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, by_path.collect())) and len(got) == len(odd)
    (last,) = decided.where("policy_count > 0").collect()
    assert last.is_violating_outcome and last.is_illegal_outcome
    policies = [(r.policy_ordinal, r.policy_id, r.policy_parent_id, r.policy_is_illegal, r.policy_enforcement_actions) for r in staging.decision_policies(decided).collect()]
    assert sorted(policies, key=lambda p: p[0]) == [*[(i, None, None, None, None) for i in range(4)], (4, "4", None, True, None), (5, None, "x", None, ["1", None, "a"])]
    slugs = {r.action_ordinal: r.enforcement_action_slug for r in staging.decision_enforcement_actions(decided).collect()}
    assert slugs == {0: None, 1: "2", 2: "warn_user", 3: '{"a":1}'}
    assert dict(decided.dtypes)["policies"].startswith("array<struct")  # a document before, walked again by each later step


def test_closures_are_made_without_lambdas_over_lines(spark):
    """Lines are written as rows, which is compiled; a function over the elements of an array is interpreted for each."""
    made = bridge.closure_payloads(bridge.Tables(spark, SF))
    assert "lambdafunction" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_tables_are_written_by_methods_that_the_jvm_compiles(spark, tmp_path):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name, None)

    class Written:
        sparkSession, schema = spark, spark.range(1).schema

        @property
        def write(self):
            seen.append(spark.conf.get(name))
            return spark.range(1).write

    assert write_table(Written(), f"file://{tmp_path}/t").count() == 1
    assert seen == ["8000"] and spark.conf.get(name, None) == before


def test_an_event_lands_when_it_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lakes, "_landed", {})
    monkeypatch.setattr(lakes, "_bridged", {})
    assert QUERIES["t2_job_closures"](spark, SF).count() > 0
    assert {event for *_, event in lakes._landed} == {"job.closed"}


@pytest.mark.parametrize("name", ["t4_decision_policies", "t5_decision_enforcement_actions", "fct_decision_policies"])
def test_ordinals_come_without_a_join_of_decisions(spark, name):
    found = QUERIES[name](spark, SF)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "decision_sk" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_marks_are_audited_without_tables_between(spark, monkeypatch):
    monkeypatch.setattr(lakes, "_bridged", {})
    assert QUERIES["tag_audit"](spark, SF).count() == 5
    assert not [n for lake in lakes._bridged.values() for n in lake.made if n not in lake.surfaces]
