"""Facts at the grain of decision, applied policy, action and job.

Whatever is finer than a fact's grain is aggregated before it is joined, so no join multiplies rows.
"""

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.functions.exprs import calendar, email_key, has_text, hours, seconds_between, surrogate_key
from modlake.operators.dims import LADDER, Dimension, _row


def key_of(*cols: str) -> Column:
    """The key that a dimension gives these values, null if one is: every value seen is in the dimension, so no join is needed."""
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    return F.when(present, surrogate_key(*cols))


def reviewer_key(mail: str) -> Column:
    return F.when(has_text(mail), surrogate_key(email_key(mail)))


def decision_measures(decided: DataFrame, ladder: list[tuple[str, int, str]] = LADDER) -> DataFrame:
    """Decisions with what their own arrays tell: counts of policies and enforcement actions, and the first policy."""
    ranks = F.create_map(*[F.lit(x) for slug, rank, _ in ladder for x in (slug, rank)])
    rows = decided.withColumns({"es": F.col("enforcement_actions"), "ps": F.col("policies"), "first_id": F.get("policies", F.lit(0))["id"]})
    rows = rows.withColumns(
        {
            "acted": F.size(F.filter("es", lambda s: s != "no_action")), "no_action_count": F.size(F.filter("es", lambda s: s == "no_action")),
            "max_enforcement_severity_rank": F.array_max(F.transform("es", lambda s: F.when(s.isNotNull(), F.coalesce(ranks[s], F.lit(0))))).cast("long"),
            "n_policies": F.size("ps"), "illegal": F.size(F.filter("ps", lambda p: p["is_illegal"])), "harmless": F.size(F.filter("ps", lambda p: p["is_non_violating"])),
            "groups": F.size(F.array_distinct(F.filter(F.transform("ps", lambda p: F.coalesce(p["parent_id"], p["id"])), lambda x: x.isNotNull()))), "primary_policy_name": F.get(F.col("ps"), F.lit(0))["name"],
        }
    )
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    made = {
        "policy_count": count("n_policies"), "illegal_policy_count": count("illegal"), "non_violating_policy_count": count("harmless"), "distinct_policy_group_count": count("groups"),
        "enforcement_action_count": count("acted"), "no_action_count": count("no_action_count"), "is_cleared_outcome": (count("n_policies") > 0) & (count("harmless") == count("n_policies")),
    }
    kept = [c for c in decided.columns if c not in made and c not in ("policies", "enforcement_actions", "entity_attributes", "reviewer_groups", "notes")]
    return rows.select(*kept, "first_id", "primary_policy_name", "max_enforcement_severity_rank", *[c.alias(n) for n, c in made.items()])


def fct_decisions(measured: DataFrame, reviewers: DataFrame, policies: DataFrame) -> DataFrame:
    """One row for each decision on a closed job. measured: rows of decision_measures.

    Only the staffing of the reviewer and the group of the first policy come from dimensions, which are small.
    """
    r = reviewers.select(F.col("reviewer_email").alias("r_mail"), F.col("staffing_model").alias("r_staffing"))
    g = policies.select(F.col("policy_id").alias("g_id"), F.col("policy_group_name").alias("primary_policy_group_name"))
    rows = measured.join(r, email_key("reviewer_email") == F.col("r_mail"), "left").join(g, F.col("first_id") == F.col("g_id"), "left")
    rows = rows.withColumns({"queue_key": key_of("queue_slug"), "reviewer_key": reviewer_key("reviewer_email"), "entity_key": key_of("entity_schema", "entity_id")})
    made = {
        **calendar("decided_local", "decided", ("date", "week", "month", "day_of_week", "hour_of_day")),
        "staffing_model": F.coalesce("r_staffing", F.lit("Automated")), "decision_count": F.lit(1).cast("long"),
        "handle_time_minutes": F.col("handle_time_seconds").cast("double") / 60.0, "handle_time_hours": hours("handle_time_seconds"),
        "included_account_ban": F.coalesce(F.col("max_enforcement_severity_rank") == 5, F.lit(False)),
        "is_multi_review_decision": F.col("queue_is_multi_review") & (F.col("decisions_on_job") > 1),
    }
    plain = [
        "decision_sk", "job_closure_event_sk", "queue_key", "reviewer_key", "entity_key", "decided_at", "decided_local", "decided_utc_offset_seconds", "job_id", "job_created_at", "closed_at", "job_category", "queue_slug",
        "queue_is_multi_review", "decision_source_type", "entity_schema", "entity_id", "reviewer_email", "decision_ordinal", "primary_policy_name", "primary_policy_group_name",
        "handle_time_seconds", "max_enforcement_severity_rank", "decisions_on_job", "is_human_decision", "is_automated", "is_violating_outcome", "is_illegal_outcome",
        "is_final_decision", "has_notes", "first_seen_at", "delivery_count", "was_redelivered", "record_source", "policy_count", "illegal_policy_count", "non_violating_policy_count",
        "distinct_policy_group_count", "enforcement_action_count", "no_action_count", "is_cleared_outcome",
    ]
    return rows.select(*plain, *[c.alias(n) for n, c in made.items()])


def fct_decision_policies(applied: DataFrame, policies: DataFrame) -> DataFrame:
    """One row for each applied policy, with its raw count and its share of the decision."""
    p = policies.select(F.col("policy_id").alias("__p"), "policy_parent_name", "policy_group_name", "policy_severity_class")
    rows = applied.join(p, F.col("policy_id") == F.col("__p"), "left").drop("__p", "policy_enforcement_actions", "policy_customer_ref")
    keys = {"queue_key": key_of("queue_slug"), "reviewer_key": reviewer_key("reviewer_email"), "entity_key": key_of("entity_schema", "entity_id"), "policy_key": key_of("policy_id")}
    made = {"policy_application_count": F.lit(1).cast("long"), "handle_time_hours": hours("handle_time_seconds")}
    return rows.withColumns({**keys, **calendar("decided_local", "decided", ("date", "week", "month")), **made})


def fct_job_actions(acted: DataFrame) -> DataFrame:
    """One row for each action; it has a reviewer or a workflow or neither, and maybe another entity as trigger."""
    rows = acted.withColumns(
        {
            "queue_key": key_of("queue_slug"), "reviewer_key": reviewer_key("actor_user_email"), "workflow_key": key_of("actor_workflow_id"),
            "entity_key": key_of("entity_schema", "entity_id"), "trigger_entity_key": key_of("trigger_entity_schema", "trigger_entity_id"),
        }
    ).drop("entity_attributes", "actor_user_groups", "notes")
    return rows.withColumns(
        {
            **calendar("actioned_local", "actioned", ("date", "month", "day_of_week", "hour_of_day")),
            "job_action_count": F.lit(1).cast("long"),
            "job_age_at_action_hours": hours("job_age_at_action_seconds"),
            "is_automated": F.col("actor_type") == "workflow",
            "acted_on_other_entity": F.col("trigger_entity_id").isNotNull() & ~F.col("trigger_entity_id").eqNullSafe(F.col("entity_id")),
        }
    ).withColumnRenamed("job_num_reports", "reports_on_job_at_action")


#: Counted kinds of actions: column, condition on an action row.
ACTION_COUNTS = {
    "create_action_count": "action = 'created'",
    "queue_change_count": "action = 'changed_queue'",
    "escalation_count": "action = 'escalated'",
    "cancellation_count": "action = 'cancelled'",
    "skip_count": "action = 'skipped'",
    "defer_count": "action = 'deferred'",
    "assignment_count": "action = 'assigned'",
    "workflow_action_count": "actor_type = 'workflow'",
    "human_action_count": "actor_type = 'user'",
    "system_action_count": "actor_type = 'none'",
    "workflow_cancellation_count": "action_source = 'workflow' AND action = 'cancelled'",
}
SNAPSHOT_COUNTS = [
    "action_count", *[c for c in ACTION_COUNTS if c != "create_action_count"], "decision_count", "automated_decision_count", "human_decision_count",
    "enforcement_action_count", "violating_decision_count", "illegal_decision_count", "cleared_decision_count",
]

#: Columns of decisions that a job's row is made of, and columns of that row that come of them.
DECIDED = (
    "job_id string, decided_at timestamp, handle_time_seconds long, is_automated boolean, is_human_decision boolean, is_final_decision boolean, reviewer_email string,"
    " decision_source_type string, first_id string, enforcement_action_count long, max_enforcement_severity_rank long, is_violating_outcome boolean, is_illegal_outcome boolean, is_cleared_outcome boolean"
)
OF_DECISIONS = {
    "decision_count", "automated_decision_count", "human_decision_count", "enforcement_action_count", "violating_decision_count", "illegal_decision_count", "cleared_decision_count",
    "first_decided_at", "last_decided_at", "handle_time_seconds", "handle_time_hours", "final_reviewer_email", "final_reviewer_key", "final_decision_source_type", "final_policy_group_name",
    "distinct_reviewer_count", "max_enforcement_severity_rank", "closed_by_automated_decision", "decision_to_close_seconds", "had_violating_outcome", "had_illegal_outcome",
}


def _earliest(at: str, local: str) -> Column:
    """An instant with its local time, to take the earliest of."""
    return F.when(F.col(at).isNotNull(), F.struct(F.col(at).alias("at"), F.col(local).alias("local")))


def fct_jobs(acted: DataFrame, closed: DataFrame, measured: DataFrame, policies: DataFrame) -> DataFrame:
    """One row for each job of either event: its lifecycle so far. measured: rows of decision_measures."""
    return with_policy_groups(job_rows(acted, closed, measured), policies)


def with_policy_groups(jobs: DataFrame, policies: DataFrame) -> DataFrame:
    """Jobs with the group of the policy that their final decision names first; of several final decisions, the last group by name."""
    g = policies.select(F.col("policy_id").alias("g_id"), F.col("policy_group_name").alias("group_name"))
    named = jobs.select(F.col("job_id").alias("of_job"), F.explode("final_policy_ids").alias("id")).join(g, F.col("id") == F.col("g_id"))
    groups = named.groupBy("of_job").agg(F.max("group_name").alias("final_policy_group_name"))
    return jobs.join(groups, F.col("job_id") == F.col("of_job"), "left").drop("of_job", "final_policy_ids")


_LATEST = ["queue_slug", "job_status_after", "job_category", "entity_schema", "entity_id", "action"]
_final = lambda x: F.when(F.col("is_final_decision"), F.col(x))
#: What the actions, the closures and the decisions of a job each come to, as parts that merge (see Dimension). The few people and
#: queues of a job are sets, since distinct counts would copy each row and shuffle it apart.
OF_ACTIONS = {
    "action_count": ("sum", lambda: F.lit(1)), **{n: ("sum", lambda cond=cond: F.expr(cond).cast("long")) for n, cond in ACTION_COUNTS.items()},
    "actors": ("set", lambda: F.col("actor_user_email")), "queues": ("set", lambda: F.col("queue_slug")),
    "first_actioned_at": ("min", lambda: F.col("actioned_at")), "last_actioned_at": ("max", lambda: F.col("actioned_at")),
    "created_by_actions": ("min", lambda: _earliest("job_created_at", "job_created_local")), "max_reports_on_job": ("max", lambda: F.col("job_num_reports")),
    "max_priority": ("max", lambda: F.col("job_priority")), "l": ("max", lambda: _row(_LATEST, "actioned_at")), "has_actions": ("max", lambda: F.lit(True)),
}
OF_CLOSURES = {
    "close": ("min", lambda: _earliest("closed_at", "closed_local")), "created_by_closure": ("min", lambda: _earliest("job_created_at", "job_created_local")),
    **{f"c_{x}": ("max", lambda x=x: F.col(x)) for x in ("job_closure_event_sk", "job_category", "queue_slug", "queue_is_multi_review", "entity_schema", "entity_id")},
    "has_closure": ("max", lambda: F.lit(True)),
}
OF_DECIDED = {
    "decision_count": ("sum", lambda: F.lit(1)), "automated_decision_count": ("sum", lambda: F.col("is_automated").cast("long")),
    "human_decision_count": ("sum", lambda: F.col("is_human_decision").cast("long")), "reviewers": ("set", lambda: F.col("reviewer_email")),
    "enforcement_action_count": ("sum", lambda: F.col("enforcement_action_count")), "max_enforcement_severity_rank": ("max", lambda: F.col("max_enforcement_severity_rank")),
    **{n: ("sum", lambda c=c: F.col(c).cast("long")) for n, c in (
        ("violating_decision_count", "is_violating_outcome"), ("illegal_decision_count", "is_illegal_outcome"), ("cleared_decision_count", "is_cleared_outcome"))},
    "first_decided_at": ("min", lambda: F.col("decided_at")), "last_decided_at": ("max", lambda: F.col("decided_at")), "handle_time_seconds": ("max", lambda: F.col("handle_time_seconds")),
    "final_reviewer_email": ("max", lambda: _final("reviewer_email")), "final_decision_source_type": ("max", lambda: _final("decision_source_type")),
    "final_policy_ids": ("set", lambda: _final("first_id")), "by_automation": ("max", lambda: F.col("is_final_decision") & F.col("is_automated")),
}


@dataclass(frozen=True)
class _Jobs(Dimension):
    def state(self, acted: DataFrame, closed: DataFrame, decided: DataFrame) -> DataFrame:
        """Each relation is aggregated by job; the joins are on job_id, which the aggregates are dealt by already."""
        a, c, d = (replace(self, parts=parts, rows=lambda df: df.where("job_id IS NOT NULL")) for parts in (OF_ACTIONS, OF_CLOSURES, OF_DECIDED))
        a, c, d = (super(_Jobs, of).state(df) for of, df in ((a, acted), (c, closed), (d, decided)))
        return a.join(c, "job_id", "full_outer").join(d, "job_id", "left")


def job_rows(acted: DataFrame, closed: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of fct_jobs with the ids of the final decisions' first policies, whose groups depend on other jobs too."""
    return JOB.build(acted, closed, decided)


def _job_rows(jobs: DataFrame) -> DataFrame:
    """Rows of jobs of their states."""
    many = lambda values, some: F.when(F.col(some).isNotNull(), F.size(values).cast("long"))
    jobs = jobs.withColumns({n: many(v, some) for n, v, some in (
        ("distinct_actor_count", "actors", "has_actions"), ("distinct_queue_count", "queues", "has_actions"), ("distinct_reviewer_count", "reviewers", "decision_count"))})
    no = lambda x: F.coalesce(F.col(x), F.lit(False))
    jobs = jobs.withColumns({n: F.coalesce(F.col(n), F.lit(0)).cast("long") for n in SNAPSHOT_COUNTS})
    jobs = jobs.withColumns(
        {
            "job_created_at": F.coalesce("created_by_closure.at", "created_by_actions.at"), "closed_at": F.col("close.at"),
            "created_local": F.when(F.col("created_by_closure").isNotNull(), F.col("created_by_closure.local")).otherwise(F.col("created_by_actions.local")), "closed_local": F.col("close.local"), "job_closure_event_sk": F.col("c_job_closure_event_sk"),
            "job_category": F.coalesce("c_job_category", "l.job_category"), "final_queue_slug": F.coalesce("c_queue_slug", "l.queue_slug"), "current_queue_slug": F.col("l.queue_slug"),
            "queue_is_multi_review": F.col("c_queue_is_multi_review"), "entity_schema": F.coalesce("c_entity_schema", "l.entity_schema"), "entity_id": F.coalesce("c_entity_id", "l.entity_id"),
            "latest_action": F.col("l.action"), "is_closed": no("has_closure"), "has_action_history": no("has_actions"), "closed_by_automated_decision": no("by_automation"),
            "job_status": F.when(no("has_closure"), "closed").otherwise(F.coalesce("l.job_status_after", F.lit("unknown"))),
        }
    )
    jobs = jobs.withColumn("entity_key", key_of("entity_schema", "entity_id"))
    open_age: Column = F.when(F.col("closed_at").isNull(), seconds_between("job_created_at", "last_actioned_at"))
    made = {
        "job_key": surrogate_key("job_id"), "final_queue_key": key_of("final_queue_slug"), "final_reviewer_key": reviewer_key("final_reviewer_email"),
        **calendar("created_local", "created", ("date", "month")), **calendar("closed_local", "closed", ("date", "week", "month", "day_of_week")),
        "time_to_close_seconds": seconds_between("job_created_at", "closed_at"), "time_to_close_hours": hours(seconds_between("job_created_at", "closed_at")),
        "time_to_first_action_seconds": seconds_between("job_created_at", "first_actioned_at"), "handle_time_hours": hours("handle_time_seconds"),
        "decision_to_close_seconds": seconds_between("last_decided_at", "closed_at"), "open_age_at_last_action_secs": open_age, "job_count": F.lit(1).cast("long"),
        "is_open": ~F.col("is_closed"), "was_moved_between_queues": F.col("queue_change_count") > 0, "was_escalated": F.col("escalation_count") > 0,
        "was_cancelled": F.col("cancellation_count") > 0, "was_cancelled_by_workflow": F.col("workflow_cancellation_count") > 0,
        "had_violating_outcome": F.col("violating_decision_count") > 0, "had_illegal_outcome": F.col("illegal_decision_count") > 0, "missing_action_history": ~F.col("has_action_history"),
    }
    plain = [
        "job_id", "job_closure_event_sk", "entity_key", "job_created_at", "first_actioned_at", "first_decided_at", "last_decided_at", "last_actioned_at", "closed_at", "handle_time_seconds",
        "job_category", "final_queue_slug", "current_queue_slug", "queue_is_multi_review", "entity_schema", "entity_id", "latest_action", "final_reviewer_email",
        "final_decision_source_type", "final_policy_ids", "job_status", *SNAPSHOT_COUNTS, "distinct_actor_count", "distinct_queue_count", "max_reports_on_job", "max_priority",
        "distinct_reviewer_count", "max_enforcement_severity_rank", "is_closed", "closed_by_automated_decision", "has_action_history",
    ]
    return jobs.select(*plain, *[c.alias(n) for n, c in made.items()])


#: Jobs as states that merge, as dimensions are.
JOB = _Jobs(("job_id",), lambda df: df, {**OF_ACTIONS, **OF_CLOSURES, **OF_DECIDED}, _job_rows)
