"""Declarative metrics over the star: names are resolved, join paths found, grains kept apart."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.functions.exprs import email_key, has_text, title
from modlake.operators.percentiles import aggregated
from modlake.operators.privacy import marked
from modlake.plans.lake import Lake

#: Logical tables: relation and key.
TABLES = {
    "queues": ("dim_queue", "queue_key"), "policies": ("dim_policy", "policy_key"), "reviewers": ("dim_reviewer", "reviewer_key"), "entities": ("dim_entity", "entity_key"),
    "jobs": ("fct_jobs", "job_key"), "decisions": ("fct_decisions", "decision_sk"), "job_actions": ("fct_job_actions", "job_action_event_sk"),
    "decision_policies": ("fct_decision_policies", "decision_policy_sk"),
}

#: Many-to-one relationships: name, from table, column, to table, its key.
RELATIONSHIPS = [
    ("jobs_to_queues", "jobs", "final_queue_key", "queues", "queue_key"),
    ("jobs_to_entities", "jobs", "entity_key", "entities", "entity_key"),
    ("jobs_to_reviewers", "jobs", "final_reviewer_key", "reviewers", "reviewer_key"),
    ("decisions_to_queues", "decisions", "queue_key", "queues", "queue_key"),
    ("decisions_to_reviewers", "decisions", "reviewer_key", "reviewers", "reviewer_key"),
    ("decisions_to_entities", "decisions", "entity_key", "entities", "entity_key"),
    ("decision_policies_to_decisions", "decision_policies", "decision_sk", "decisions", "decision_sk"),
    ("decision_policies_to_policies", "decision_policies", "policy_key", "policies", "policy_key"),
    ("job_actions_to_queues", "job_actions", "queue_key", "queues", "queue_key"),
    ("job_actions_to_reviewers", "job_actions", "reviewer_key", "reviewers", "reviewer_key"),
    ("job_actions_to_entities", "job_actions", "entity_key", "entities", "entity_key"),
]
#: Columns of the from table that a relationship's key is made of, and dimensions that these tell as the to table does,
#: which has every value seen: rows hold these dimensions without a join.
MADE_OF = {
    **{n: (c,) for n, c in (
        ("jobs_to_queues", "final_queue_slug"), ("decisions_to_queues", "queue_slug"), ("job_actions_to_queues", "queue_slug"),
        ("jobs_to_reviewers", "final_reviewer_email"), ("decisions_to_reviewers", "reviewer_email"), ("job_actions_to_reviewers", "actor_user_email"))},
    **{f"{t}_to_entities": ("entity_schema", "entity_id") for t in ("jobs", "decisions", "job_actions")},
}
TOLD = {
    "queue_slug": lambda slug: slug, "queue_name": lambda slug: title(slug, "-"), "moderator_email": lambda mail: F.when(has_text(mail), email_key(mail)),
    "entity_type": lambda schema, key: F.when(key.isNotNull(), schema),
}

#: Row-level facts: name, table, expression.
FACTS = {
    "job_time_to_close_hours": ("jobs", "time_to_close_hours"), "job_handle_time_hours": ("jobs", "handle_time_hours"), "job_queue_changes": ("jobs", "queue_change_count"),
    "job_actions_taken": ("jobs", "action_count"), "job_decisions_taken": ("jobs", "decision_count"), "job_wait_time_hours": ("jobs", "time_to_first_action_seconds / 3600.0D"),
    "job_post_decision_lag_hours": ("jobs", "decision_to_close_seconds / 3600.0D"), "decision_handle_time_hours": ("decisions", "handle_time_hours"),
    "decision_enforcement_actions": ("decisions", "enforcement_action_count"), "decision_policies_applied": ("decisions", "policy_count"),
    "action_job_age_hours": ("job_actions", "job_age_at_action_hours"), "policy_allocated_decisions": ("decision_policies", "decision_count_allocated"),
}

#: Dimensions: name, table, column.
DIMENSIONS = {
    "queue_name": ("queues", "queue_name"), "queue_slug": ("queues", "queue_slug"), "queue_is_multi_review": ("queues", "queue_is_multi_review"),
    "policy_name": ("policies", "policy_name"), "policy_area": ("policies", "policy_group_name"), "policy_severity_class": ("policies", "policy_severity_class"),
    "policy_is_illegal": ("policies", "policy_is_illegal"),
    "moderator_name": ("reviewers", "reviewer_name"), "moderator_email": ("reviewers", "reviewer_email"), "staffing_model": ("reviewers", "staffing_model"),
    "moderator_is_outsourced": ("reviewers", "is_outsourced"), "moderator_is_qa": ("reviewers", "is_qa"), "entity_type": ("entities", "entity_schema"),
    "job_status": ("jobs", "job_status"), "job_category": ("jobs", "job_category"), "job_is_closed": ("jobs", "is_closed"), "job_closed_by_automation": ("jobs", "closed_by_automated_decision"),
    "job_was_escalated": ("jobs", "was_escalated"), "job_was_moved_between_queues": ("jobs", "was_moved_between_queues"), "job_created_date": ("jobs", "created_date"),
    "job_closed_date": ("jobs", "closed_date"), "job_closed_month": ("jobs", "closed_month"),
    "decision_source": ("decisions", "decision_source_type"), "decision_staffing_model": ("decisions", "staffing_model"), "decision_is_automated": ("decisions", "is_automated"),
    "decision_is_cleared": ("decisions", "is_cleared_outcome"), "decision_date": ("decisions", "decided_date"), "decision_month": ("decisions", "decided_month"),
    "decision_hour_of_day": ("decisions", "decided_hour_of_day"),
    "action_type": ("job_actions", "action"), "action_source": ("job_actions", "action_source"), "action_actor_type": ("job_actions", "actor_type"),
    "action_date": ("job_actions", "actioned_date"), "action_workflow_name": ("job_actions", "actor_workflow_name"),
}

# Fixed vocabulary of the metric layer. A name with spaces for its underscores is understood without being listed.
#: Other words for dimensions.
DIMENSION_WORDS = {
    "queue_name": "queue, inbox, review queue", "queue_slug": "queue id", "queue_is_multi_review": "multi review queue, requires multiple reviews, double review",
    "policy_name": "policy, violation, violation type, rule", "policy_area": "policy group, parent policy, policy category, harm area",
    "policy_severity_class": "severity, policy severity, illegal or violating, harm class", "policy_is_illegal": "illegal, illegal content, legally reportable",
    "moderator_name": "moderator, reviewer, agent, who decided", "moderator_email": "reviewer email, agent email", "staffing_model": "reviewer staffing, reviewer vendor, reviewer team",
    "moderator_is_outsourced": "outsourced, is BPO, external moderator", "moderator_is_qa": "QA, quality assurance, auditor", "entity_type": "content type, object type, what was reviewed",
    "job_status": "status, open or closed, state", "job_category": "job type, work type, appeal or standard", "job_is_closed": "closed, is closed, resolved",
    "job_closed_by_automation": "closed automatically, automated close, auto resolved", "job_was_escalated": "escalated, was escalated",
    "job_was_moved_between_queues": "moved queue, changed queue, requeued", "job_created_date": "date created, when the job was created",
    "job_closed_date": "closed date, date closed, closure date, day closed", "job_closed_month": "closed month, month closed",
    "decision_source": "how it was decided, manual or automated, decision origin",
    "decision_staffing_model": "staffing, staffing model, vendor, BPO, outsourced or in-house, supplier, team", "decision_is_automated": "automated decision, machine decision, auto decided",
    "decision_is_cleared": "cleared, no violation found, reviewed and cleared", "decision_date": "date decided, day decided", "decision_month": "month decided",
    "decision_hour_of_day": "hour of day, time of day decided, shift hour", "action_type": "action, what happened, movement type", "action_source": "who or what acted",
    "action_actor_type": "actor, actor type, human or workflow", "action_date": "date actioned, day actioned", "action_workflow_name": "workflow, workflow name, automation name",
}
#: Other words for metrics.
METRIC_WORDS = {
    "total_jobs": "jobs, number of jobs, job count, total cases", "closed_jobs": "jobs closed, resolved jobs, completed jobs", "open_jobs": "backlog, unresolved jobs, jobs still open",
    "median_time_to_close_hours": "median time to close, typical time to close, median resolution time", "avg_time_to_close_hours": "average time to close, mean time to close",
    "median_queue_wait_hours": "queue wait, waiting time, time before first action, time in queue", "median_post_decision_lag_hours": "lag after decision, time from decision to close",
    "avg_queue_changes_per_job": "queue changes per job, average requeues, how many times jobs move queue", "total_queue_changes": "queue changes, total requeues",
    "escalated_jobs": "jobs escalated", "jobs_cancelled_by_workflow": "cancelled by workflow, jobs cancelled by automation, auto cancelled jobs",
    "jobs_closed_by_automation": "jobs closed automatically, automated closures", "total_decisions": "decisions, number of decisions, decision count, verdicts",
    "median_handle_time_hours": "handle time, median handle time, typical handle time, AHT", "avg_handle_time_hours": "average handle time, mean handle time, average AHT",
    "p90_handle_time_hours": "p90 handle time, 90th percentile handle time, slowest decisions, tail handle time, worst case handle time, SLA handle time",
    "automated_decisions": "machine decisions", "human_decisions": "manual decisions, decisions by people", "violating_decisions": "violations, enforcement decisions",
    "cleared_decisions": "cleared, no violation, decisions with no violation", "illegal_decisions": "illegal content decisions, legally reportable decisions",
    "total_enforcement_actions": "enforcement actions, actions applied, enforcement volume", "active_moderators": "moderators deciding, distinct moderators, moderators who decided",
    "total_job_actions": "job actions, actions, activity, moderator activity, throughput",
    "active_moderators_by_activity": "active moderators, moderators active, daily active moderators, headcount active",
    "median_job_age_at_action_hours": "job age when actioned, median age of actioned jobs, age at action", "policy_applications": "times a policy was applied, policy volume",
    "allocated_decisions": "decisions by policy, share of decisions", "automation_rate": "share automated, percent automated, automation share",
    "automated_closure_rate": "share of jobs closed automatically, automated close rate", "clearance_rate": "no violation rate, share cleared",
    "violation_rate": "share violating, enforcement rate", "escalation_rate": "share escalated", "decisions_per_moderator": "productivity, output per moderator",
}
#: What a reader of a result should know of a column; it goes with the column as metadata.
COMMENTS = {
    "policy_area": "The parent of the policy, or the policy itself; for distributions, since single policies are thin.",
    "policy_severity_class": "illegal, violating or non_violating; the last means reviewed and found fine.",
    "moderator_email": "Identifies a moderator; deliveries carry no user id.", "staffing_model": "Of human reviewers only; decision_staffing_model also covers automated decisions.",
    "entity_type": "The schema of what was reviewed.", "job_status": "closed once a closure came, else the status after the latest action.", "job_closed_by_automation": "Whether the final decision was automated.",
    "decision_source": "manual is a person, anything else a machine.", "decision_staffing_model": "The vendor, In-house or Automated.",
    "decision_is_cleared": "True where every policy of the decision, of one at least, is marked harmless.", "decision_date": "By the sender's own calendar.", "action_date": "By the sender's own calendar.",
    "action_actor_type": "user, workflow or none.", "total_jobs": "Jobs of either event, open or closed.", "closed_jobs": "Jobs with a closure among the deliveries; the sender tells of no closure without a decision, so more may be closed.",
    "open_jobs": "Jobs without a closure so far.", "median_time_to_close_hours": "From creation to closure.", "median_queue_wait_hours": "From creation to the first action.",
    "median_post_decision_lag_hours": "From the last decision to the closure.", "total_decisions": "Decisions on closed jobs.", "median_handle_time_hours": "From a job's creation to a decision.",
    "p90_handle_time_hours": "Nine of ten decisions took no longer, interpolated between neighbouring values.", "active_moderators": "People who decided something.",
    "active_moderators_by_activity": "People who acted on a job, whether or not they decided.", "policy_applications": "Counts a decision once for each of its policies.",
    "allocated_decisions": "Splits a decision over its policies, so that shares add up to the decisions.", "automation_rate": "Of decisions.", "automated_closure_rate": "Of closed jobs, by the final decision.",
}


def _count_where(column: str) -> Column:
    return F.sum(F.when(F.col(column), 1).otherwise(0))


def _count_unless(column: str) -> Column:
    return F.sum(F.when(F.col(column), 0).otherwise(1))


#: Metrics at the grain of their own table: name, table, an aggregate or the share of values below the wanted one, and its column.
METRICS = {
    "total_jobs": ("jobs", F.count, "job_key"), "closed_jobs": ("jobs", _count_where, "is_closed"),
    "open_jobs": ("jobs", _count_unless, "is_closed"),
    "median_time_to_close_hours": ("jobs", 0.5, "job_time_to_close_hours"), "avg_time_to_close_hours": ("jobs", F.avg, "job_time_to_close_hours"),
    "median_queue_wait_hours": ("jobs", 0.5, "job_wait_time_hours"), "median_post_decision_lag_hours": ("jobs", 0.5, "job_post_decision_lag_hours"),
    "avg_queue_changes_per_job": ("jobs", F.avg, "job_queue_changes"), "total_queue_changes": ("jobs", F.sum, "job_queue_changes"),
    "escalated_jobs": ("jobs", _count_where, "was_escalated"), "jobs_cancelled_by_workflow": ("jobs", _count_where, "was_cancelled_by_workflow"),
    "jobs_closed_by_automation": ("jobs", _count_where, "closed_by_automated_decision"),
    "total_decisions": ("decisions", F.count, "decision_sk"), "median_handle_time_hours": ("decisions", 0.5, "decision_handle_time_hours"),
    "avg_handle_time_hours": ("decisions", F.avg, "decision_handle_time_hours"), "p90_handle_time_hours": ("decisions", 0.9, "decision_handle_time_hours"),
    "automated_decisions": ("decisions", _count_where, "is_automated"), "human_decisions": ("decisions", _count_where, "is_human_decision"),
    "violating_decisions": ("decisions", _count_where, "is_violating_outcome"), "cleared_decisions": ("decisions", _count_where, "is_cleared_outcome"),
    "illegal_decisions": ("decisions", _count_where, "is_illegal_outcome"), "total_enforcement_actions": ("decisions", F.sum, "decision_enforcement_actions"),
    "active_moderators": ("decisions", F.countDistinct, "reviewer_email"),
    "total_job_actions": ("job_actions", F.count, "job_action_event_sk"), "active_moderators_by_activity": ("job_actions", F.countDistinct, "actor_user_email"),
    "median_job_age_at_action_hours": ("job_actions", 0.5, "action_job_age_hours"),
    "policy_applications": ("decision_policies", F.count, "decision_policy_sk"), "allocated_decisions": ("decision_policies", F.sum, "policy_allocated_decisions"),
}

#: Metrics of metrics: name, numerator, denominator.
DERIVED = {
    "automation_rate": ("automated_decisions", "total_decisions"),
    "automated_closure_rate": ("jobs_closed_by_automation", "closed_jobs"),
    "clearance_rate": ("cleared_decisions", "total_decisions"),
    "violation_rate": ("violating_decisions", "total_decisions"),
    "escalation_rate": ("escalated_jobs", "total_jobs"),
    "decisions_per_moderator": ("total_decisions", "active_moderators"),
}


def _words(words: dict[str, str], names) -> dict[str, str]:
    spoken = {n.replace("_", " ").lower(): n for n in names}
    return {**spoken, **{w.strip().lower(): n for n, listed in words.items() for w in listed.split(",")}}


def resolve(name: str, kind: str | None = None) -> str:
    """The registered name of a dimension or metric, given that or another word, or either after its table.

    kind is "dimension" or "metric" where the place says which is meant; else a word for one of each is refused.
    """
    short = name.split(".")[-1].strip()
    found = {}
    for of, names, words in (("dimension", DIMENSIONS, DIMENSION_WORDS), ("metric", {**METRICS, **DERIVED}, METRIC_WORDS)):
        if kind in (None, of):
            found[of] = short if short in names else _words(words, names).get(short.lower())
    known = {n for n in found.values() if n is not None}
    if not known:
        raise KeyError(f"no {kind or 'dimension or metric'} is called {name!r}")
    if len(known) > 1:
        raise KeyError(f"{name!r} may be any of {sorted(known)}")
    return known.pop()


def path(start: str, goal: str) -> list[tuple]:
    """The relationships from one table to another, towards the one side; there is one path at most."""
    if start == goal:
        return []
    found = [[r] if r[3] == goal else [r, *rest] for r in RELATIONSHIPS if r[1] == start and (r[3] == goal or (rest := _path_or_none(r[3], goal)))]
    if not found:
        raise ValueError(f"{goal} cannot be reached from {start} without leaving its grain")
    if len(found) > 1:
        raise ValueError(f"more than one path from {start} to {goal}")
    return found[0]


def _path_or_none(start: str, goal: str) -> list[tuple] | None:
    try:
        return path(start, goal)
    except ValueError:
        return None


@dataclass(frozen=True)
class Query:
    dimensions: tuple[str, ...] = ()
    metrics: tuple[str, ...] = ()
    where: str | None = None
    order_by: tuple[str, ...] = ()
    limit: int | None = None


def _needed(table: str, dimensions: list[str], metrics: list[str], used: list[tuple]) -> set[str]:
    """Columns of a table that its metrics by the dimensions are worked out from."""
    read = {METRICS[m][2] for m in metrics} | {r[2] for r in used if r[1] == table} | {c for r in used if r[1] == table for c in MADE_OF.get(r[0], ())}
    read |= {DIMENSIONS[d][1] for d in dimensions if DIMENSIONS[d][0] == table}
    return {FACTS[c][1].split()[0] if c in FACTS else c for c in read}


def _held(relationship: str, wanted: dict[str, str]) -> bool:
    """Whether rows on the from side of a relationship hold the dimensions that are wanted of the other."""
    return relationship in MADE_OF and bool(wanted) and all(d in TOLD for d in wanted)


def _aggregated(lake: Lake, table: str, dimensions: list[str], metrics: list[str]) -> DataFrame:
    """The metrics of one table by the dimensions, which rows hold or which are joined from the one side only."""
    columns: dict[str, Column] = {}
    # nearer tables first, so that what a later join needs is there
    used = sorted({r for d in dimensions for r in map(tuple, path(table, DIMENSIONS[d][0]))}, key=lambda r: r[1] != table)
    shares = {m: METRICS[m][:0:-1] for m in metrics if isinstance(METRICS[m][1], float)}
    rows = lake.of(TABLES[table][0], _needed(table, dimensions, metrics, used))
    rows = rows.withColumns({f: F.expr(e) for f, (t, e) in FACTS.items() if t == table and f in {METRICS[m][2] for m in metrics}})
    for name, source, column, target, key in used:
        wanted = {d: c for d in dimensions for t, c in [DIMENSIONS[d]] if t == target}
        left = lambda c: F.col(c) if source == table else F.col(f"__k_{source}_{c}")  # noqa: B023, E731
        if _held(name, wanted):
            rows = rows.select("*", *[TOLD[d](*map(left, MADE_OF[name])).alias(f"__d_{d}", metadata=marked(TABLES[target][0], c)) for d, c in wanted.items()])
        else:
            further = {c for r in used if r[1] == target for c in (r[2], *MADE_OF.get(r[0], ()))}
            side = lake.of(TABLES[target][0], {key, *wanted.values(), *further})
            side = side.select(F.col(key).alias(f"__{target}"), *[F.col(c).alias(f"__d_{d}") for d, c in wanted.items()], *[F.col(c).alias(f"__k_{target}_{c}") for c in sorted(further)])
            rows = rows.join(side, left(column) == F.col(f"__{target}"), "left")
        columns |= {d: F.col(f"__d_{d}") for d in wanted}
    columns |= {d: F.col(DIMENSIONS[d][1]) for d in dimensions if DIMENSIONS[d][0] == table}
    out = aggregated(rows, {d: columns[d] for d in dimensions}, [METRICS[m][1](METRICS[m][2]).alias(m) for m in metrics if m not in shares], shares)
    return out.select(*dimensions, *metrics)


def metrics_query(lake: Lake, dimensions=(), metrics=(), where: str | None = None, order_by=(), limit: int | None = None) -> DataFrame:
    """Metrics by dimensions. where applies to the result, after aggregation.

    Metrics of different tables are aggregated each by itself and joined on the dimensions, so no fact
    is ever joined to another. A dimension that a metric's table cannot reach is an error.
    """
    dims, wanted = [resolve(d, "dimension") for d in dimensions], [resolve(m, "metric") for m in metrics]
    base = list(dict.fromkeys(x for m in wanted for x in (DERIVED[m] if m in DERIVED else (m,))))
    by_table: dict[str, list[str]] = {}
    for m in base:
        by_table.setdefault(METRICS[m][0], []).append(m)
    parts = [_aggregated(lake, t, dims, ms) for t, ms in by_table.items()]

    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        if not dims:
            return a.crossJoin(b)  # one row each
        b = b.withColumnsRenamed({d: f"__r_{d}" for d in dims})
        joined = a.join(b, reduce(lambda x, y: x & y, [a[d].eqNullSafe(b[f"__r_{d}"]) for d in dims]), "full_outer")
        return joined.select(*[F.coalesce(d, f"__r_{d}").alias(d) for d in dims], *[c for c in [*a.columns, *b.columns] if c not in dims and not c.startswith("__r_")])

    out = reduce(both, parts)
    rates = {m: F.when(F.col(DERIVED[m][1]) != 0, F.col(DERIVED[m][0]).cast("double") / F.col(DERIVED[m][1]).cast("double")) for m in wanted if m in DERIVED}
    noted = [F.col(c).alias(c, metadata={"comment": COMMENTS[c]}) if c in COMMENTS else F.col(c) for c in (*dims, *wanted)]
    out = (out.withColumns(rates) if rates else out).select(*noted)
    out = out.where(where) if where else out
    if order_by:
        out = out.orderBy(*[F.desc_nulls_last(o[1:]) if o.startswith("-") else F.asc_nulls_last(o) for o in order_by])
    return out.limit(limit) if limit else out


#: Named questions.
QUESTIONS = {
    "v01_closed_jobs_per_day": Query(("job_closed_date",), ("closed_jobs",), order_by=("job_closed_date",)),
    "v02_top_moderators_by_activity": Query(("moderator_email",), ("total_job_actions",), order_by=("-total_job_actions", "moderator_email"), limit=20),
    "v03_active_moderators_per_day": Query(("action_date",), ("active_moderators_by_activity",), order_by=("action_date",)),
    "v04_policy_distribution": Query(("policy_area",), ("policy_applications",), order_by=("-policy_applications",)),
    "v05_escalations_and_queue_changes_per_day": Query(("action_date", "action_type"), ("total_job_actions",), "action_type IN ('escalated', 'changed_queue')", ("action_date",)),
    "v06_jobs_cancelled_by_workflow": Query((), ("jobs_cancelled_by_workflow",)),
    "v07_median_age_of_actioned_jobs": Query(("action_type",), ("median_job_age_at_action_hours",), order_by=("-median_job_age_at_action_hours",)),
    "v08_handle_time_by_queue": Query(("queue_name",), ("median_handle_time_hours", "total_decisions"), order_by=("-median_handle_time_hours",)),
    "v09_handle_time_tail_by_queue": Query(("queue_name",), ("median_handle_time_hours", "p90_handle_time_hours", "total_decisions"), order_by=("-p90_handle_time_hours",)),
    "v10_handle_time_by_moderator": Query(("moderator_name",), ("median_handle_time_hours", "total_decisions"), order_by=("-total_decisions",)),
    "v11_handle_time_by_entity_type": Query(("entity_type",), ("median_handle_time_hours", "total_decisions"), order_by=("-median_handle_time_hours",)),
    "v12_median_time_to_close_by_queue": Query(("queue_name",), ("median_time_to_close_hours", "closed_jobs"), order_by=("-median_time_to_close_hours",)),
    "v13_automated_closure_share": Query((), ("automated_closure_rate", "closed_jobs", "jobs_closed_by_automation")),
    "v14_queue_changes_before_closure": Query(("job_is_closed",), ("avg_queue_changes_per_job", "total_queue_changes", "total_jobs")),
    "v15_moderator_best_queue_by_handle_time": Query(("moderator_name", "queue_name"), ("median_handle_time_hours", "total_decisions"), order_by=("moderator_name", "median_handle_time_hours")),
    "v16_handle_time_by_staffing_model": Query(("decision_staffing_model",), ("median_handle_time_hours", "total_decisions"), order_by=("-median_handle_time_hours",)),
}


def ask(lake: Lake, question: Query) -> DataFrame:
    return metrics_query(lake, question.dimensions, question.metrics, question.where, question.order_by, question.limit)
