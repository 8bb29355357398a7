"""Relations at the grain of action, closure, decision, applied policy and enforcement action."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.functions.exprs import at, event_times, has_text, length_of, read_as, seconds_between, surrogate_key

LINEAGE = ["first_seen_at", "delivery_count", "was_redelivered", "record_source"]

#: What is read of documents, in one walk over each; what has no field here stays in the documents that base relations hold.
_ENTITY = "struct<entity_schema string, attributes variant>"
_USER = "struct<name string, email string, groups array<struct<name string>>>"
_QUEUE = "struct<slug string, is_multi_review boolean>"
#: Two events name the category differently.
_JOB = f"id string, created_at string, job_category string, category string, queue {_QUEUE}, entity {_ENTITY}"
ACTION = f"""struct<timestamp string, action string, source string, notes string, job struct<{_JOB}, status string, priority bigint, num_reports bigint>,
    action_made_by struct<user {_USER}, workflow struct<id string, name string, rule struct<id string, name string>, trigger_type string, event struct<event_name string, entity {_ENTITY}>>>>"""
CLOSURE = f"struct<timestamp string, job struct<{_JOB}>, decisions variant>"
POLICY = "struct<id string, name string, parent_id string, is_illegal boolean, is_non_violating boolean, customer_ref string, enforcement_actions array<string>>"
DECISION = f"struct<timestamp string, source struct<type string, user {_USER}>, entity {_ENTITY}, policies array<{POLICY}>, enforcement_actions array<string>, notes string>"


def _entity(path: str) -> dict[str, Column]:
    return {"entity_schema": F.col(f"{path}.entity_schema"), "entity_id": at(f"{path}.attributes", "id"), "entity_attributes": F.col(f"{path}.attributes")}


def _count(items: str) -> Column:
    return F.coalesce(F.size(items), F.lit(0)).cast("long")


def _any(items: str, holds: Callable[[Column], Column]) -> Column:
    """Whether something holds for any element; false for no array."""
    return F.coalesce(F.exists(items, lambda x: F.coalesce(holds(x), F.lit(False))), F.lit(False))


def job_actions(base: DataFrame) -> DataFrame:
    """One row for each delivered action on a job."""
    workflow = "p.action_made_by.workflow"
    columns = {
        "job_action_event_sk": F.col("event_sk"), "action": F.col("p.action"), "action_source": F.col("p.source"), **event_times(F.col("p.timestamp"), "actioned"), "notes": F.col("p.notes"),
        "job_id": F.col("p.job.id"), **event_times(F.col("p.job.created_at"), "job_created"), "queue_slug": F.col("p.job.queue.slug"),
        "queue_is_multi_review": F.col("p.job.queue.is_multi_review"), "job_status_after": F.col("p.job.status"), "job_priority": F.col("p.job.priority"),
        "job_num_reports": F.col("p.job.num_reports"), "job_category": F.coalesce("p.job.job_category", "p.job.category"), **_entity("p.job.entity"),
        "actor_user_name": F.col("p.action_made_by.user.name"), "actor_user_email": F.col("p.action_made_by.user.email"), "actor_user_groups": F.col("p.action_made_by.user.groups"),
        **{f"actor_workflow_{n}": F.col(f"{workflow}.{path}") for n, path in (
            ("id", "id"), ("name", "name"), ("rule_id", "rule.id"), ("rule_name", "rule.name"), ("trigger_type", "trigger_type"), ("event_name", "event.event_name"))},
        "trigger_entity_schema": F.col(f"{workflow}.event.entity.entity_schema"), "trigger_entity_id": at(f"{workflow}.event.entity.attributes", "id"),
    }
    rows = base.select("event_sk", read_as("payload", ACTION).alias("p"), *LINEAGE).select(*[c.alias(n) for n, c in columns.items()], *LINEAGE)
    return rows.withColumns(
        {
            "actor_type": F.when(F.col("actor_user_email").isNotNull(), "user").when(F.col("actor_workflow_id").isNotNull(), "workflow").otherwise("none"),
            "is_escalation": F.col("action") == "escalated",
            "is_cancellation": F.col("action") == "cancelled",
            "has_notes": has_text("notes"),
            "job_age_at_action_seconds": seconds_between("job_created_at", "actioned_at"),
            "has_entity": F.col("entity_id").isNotNull(),
        }
    )


def job_closures(base: DataFrame) -> DataFrame:
    """One row for each delivered closure of a job."""
    columns = {
        "job_closure_event_sk": F.col("event_sk"), "job_id": F.col("p.job.id"), **event_times(F.col("p.timestamp"), "closed"), **event_times(F.col("p.job.created_at"), "job_created"),
        "job_category": F.coalesce("p.job.job_category", "p.job.category"), "queue_slug": F.col("p.job.queue.slug"), "queue_is_multi_review": F.col("p.job.queue.is_multi_review"),
        **_entity("p.job.entity"), "closure_decisions": F.col("p.decisions"),
    }
    rows = base.select("event_sk", read_as("payload", CLOSURE).alias("p"), *LINEAGE).select(*[c.alias(n) for n, c in columns.items()], *LINEAGE)
    return rows.withColumns({"closure_decision_count": length_of(F.col("closure_decisions")), "time_to_close_seconds": seconds_between("job_created_at", "closed_at")})


def decisions(closures: DataFrame) -> DataFrame:
    """One row for each decision of a closure; a closure without any gives no row."""
    kept = ["job_closure_event_sk", "job_id", "closed_at", "job_created_at", "job_category", "queue_slug", "queue_is_multi_review"]
    opened = closures.select(
        *kept, F.col("entity_schema").alias("job_schema"), F.col("entity_id").alias("job_entity"), F.col("closure_decision_count").alias("decisions_on_job"), *LINEAGE,
        F.posexplode(read_as("closure_decisions", f"array<{DECISION}>")).alias("decision_ordinal", "d"),
    )
    rows = opened.select(
        *kept, "decisions_on_job", *LINEAGE, F.col("decision_ordinal").cast("long").alias("decision_ordinal"),
        *[c.alias(n) for n, c in event_times(F.col("d.timestamp"), "decided").items()], F.col("d.source.type").alias("decision_source_type"),
        F.col("d.source.user.name").alias("reviewer_name"), F.col("d.source.user.email").alias("reviewer_email"), F.col("d.source.user.groups").alias("reviewer_groups"),
        F.coalesce("d.entity.entity_schema", "job_schema").alias("entity_schema"), F.coalesce(at("d.entity.attributes", "id"), "job_entity").alias("entity_id"),
        F.col("d.entity.attributes").alias("entity_attributes"), "d.policies", "d.enforcement_actions", "d.notes",
    )
    manual = F.col("decision_source_type") == "manual"
    return rows.withColumns(
        {
            "decision_sk": surrogate_key("job_closure_event_sk", "decision_ordinal"),
            "policy_count": _count("policies"),
            "enforcement_action_count": _count("enforcement_actions"),
            "is_human_decision": manual,  # unknown for an unknown source, which yet counts as automated
            "is_automated": ~F.coalesce(manual, F.lit(False)),
            "handle_time_seconds": seconds_between("job_created_at", "decided_at"),
            "has_notes": has_text("notes"),
            "is_violating_outcome": _any("policies", lambda p: ~p["is_non_violating"]),
            "is_illegal_outcome": _any("policies", lambda p: p["is_illegal"]),
            "is_final_decision": F.col("decision_ordinal") == F.col("decisions_on_job") - 1,
        }
    )


_DECISION = [
    "decision_sk", "job_closure_event_sk", "decision_ordinal", "decided_at", "decided_local", "closed_at", "job_id", "job_category", "queue_slug", "entity_schema", "entity_id",
    "decision_source_type", "is_automated", "is_human_decision", "reviewer_email", "handle_time_seconds",
]


def decision_policies(decided: DataFrame) -> DataFrame:
    """One row for each policy applied by a decision; a decision counts once over all its rows."""
    rows = decided.select(*_DECISION, F.col("policy_count").alias("policies_on_decision"), F.posexplode("policies").alias("pos", "p"))
    rows = rows.select(
        *_DECISION, "policies_on_decision", F.col("pos").cast("long").alias("policy_ordinal"), F.col("p.id").alias("policy_id"), F.col("p.name").alias("policy_name"),
        F.col("p.parent_id").alias("policy_parent_id"), F.col("p.is_illegal").alias("policy_is_illegal"), F.col("p.is_non_violating").alias("policy_is_non_violating"),
        F.col("p.customer_ref").alias("policy_customer_ref"), F.col("p.enforcement_actions").alias("policy_enforcement_actions"),
    )
    return rows.withColumns(
        {
            "decision_policy_sk": surrogate_key("decision_sk", "policy_id", "policy_ordinal"),
            "is_root_policy": F.col("policy_parent_id").isNull(),
            "is_primary_policy": F.col("policy_ordinal") == 0,
            "policy_enforcement_action_count": F.coalesce(F.size("policy_enforcement_actions"), F.lit(0)).cast("long"),
            "decision_count_allocated": F.when(F.col("policies_on_decision") > 0, 1.0 / F.col("policies_on_decision").cast("double")),
        }
    )


def decision_enforcement_actions(decided: DataFrame) -> DataFrame:
    """One row for each enforcement action of a decision as a whole (those of its policies would count twice)."""
    rows = decided.select(*_DECISION, F.col("enforcement_action_count").alias("actions_on_decision"), F.posexplode("enforcement_actions").alias("pos", "enforcement_action_slug"))
    rows = rows.select(*_DECISION, "actions_on_decision", F.col("pos").cast("long").alias("action_ordinal"), "enforcement_action_slug")
    return rows.withColumns(
        {
            "decision_enforcement_action_sk": surrogate_key("decision_sk", "enforcement_action_slug", "action_ordinal"),
            "is_no_action": F.col("enforcement_action_slug") == "no_action",
        }
    )
