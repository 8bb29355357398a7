"""Type-1 dimensions of what the events mention. Ties of time are broken by a stable row hash."""

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlake.functions.exprs import at, email_key, surrogate_key, title

#: The ladder of enforcement actions: slug, rank, category. Fixed values; replace them by your own.
LADDER = [
    ("no_action", 0, "none"),
    ("warn_user", 1, "advisory"),
    ("shadow_ban", 2, "visibility"),
    ("remove_content", 3, "content"),
    ("restrict_account", 4, "account"),
    ("ban_user", 5, "account"),
]


def latest_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; Spark keeps one candidate a key before the shuffle."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


@dataclass(frozen=True)
class Dimension:
    """A type-1 dimension as states that can be merged: rows of fragments, what a group of them comes to, and the columns made of that.

    parts: name to (kind, value); the kinds min, max, sum and set each merge with themselves, a set being a sorted
    array of distinct values.
    """

    keys: tuple[str, ...]
    rows: Callable[..., DataFrame]
    parts: dict[str, tuple[str, Callable[[], Column]]]
    finish: Callable[..., DataFrame]

    def state(self, *relations: DataFrame) -> DataFrame:
        made = {"min": F.min, "max": F.max, "sum": F.sum, "set": lambda c: F.sort_array(F.collect_set(c))}
        return self.rows(*relations).groupBy(*self.keys).agg(*[made[kind](value()).alias(n) for n, (kind, value) in self.parts.items()])

    def merged(self, states: DataFrame) -> DataFrame:
        """One state a key, of any number of them."""
        again = {"min": F.min, "max": F.max, "sum": F.sum, "set": lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_list(c))))}
        return states.groupBy(*self.keys).agg(*[again[kind](n).alias(n) for n, (kind, _) in self.parts.items()])

    def build(self, *relations: DataFrame) -> DataFrame:
        return self.finish(self.state(*relations))


def _row(values: Iterable[str], when: str = "observed_at", first: tuple[Column, ...] = ()) -> Column:
    """The values of a row as a struct that is larger the later the row is, so that its maximum is the row that latest_wins would choose.

    max of a struct compares field by field, so one aggregation gives extremes and latest values
    together, with partial results before the shuffle; a null time is less than any other.
    """
    return F.struct(*first, F.col(when).alias("__t"), *[F.col(v).alias(v) for v in values])


#: What every dimension has of its observations.
SEEN = {
    "first_seen_at": ("min", lambda: F.col("observed_at")),
    "last_seen_at": ("max", lambda: F.col("observed_at")),
    "observation_count": ("sum", lambda: F.lit(1)),
}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _queue_rows(actions: DataFrame, closures: DataFrame, decided: DataFrame) -> DataFrame:
    return _union([
        df.where("queue_slug IS NOT NULL").select("queue_slug", "queue_is_multi_review", F.col(t).alias("observed_at"), F.lit(e).alias("event"))
        for df, t, e in ((actions, "actioned_at", "job.actioned"), (closures, "closed_at", "job.closed"), (decided, "decided_at", "decision.created"))
    ])


def _queues(state: DataFrame) -> DataFrame:
    return state.select(
        surrogate_key("queue_slug").alias("queue_key"), "queue_slug", "l.queue_is_multi_review", title("queue_slug", "-").alias("queue_name"),
        "first_seen_at", "last_seen_at", "observation_count", F.size("events").cast("long").alias("observed_event_type_count"),
    )


QUEUE = Dimension(("queue_slug",), _queue_rows, {**SEEN, "events": ("set", lambda: F.col("event")), "l": ("max", lambda: _row(["queue_is_multi_review"]))}, _queues)


def dim_queue(actions: DataFrame, closures: DataFrame, decided: DataFrame) -> DataFrame:
    return QUEUE.build(actions, closures, decided)


POLICY_VALUES = ["policy_name", "policy_parent_id", "policy_is_illegal", "policy_is_non_violating", "policy_customer_ref", "policy_enforcement_actions"]


def _policy_rows(applied: DataFrame) -> DataFrame:
    return applied.where("policy_id IS NOT NULL").withColumn("observed_at", F.col("decided_at"))


def _policies(state: DataFrame, areas: DataFrame) -> DataFrame:
    """Policies with their parents' names: seen themselves, else from the lookup of areas, else unknown."""
    own = state.select("policy_id", "observation_count", "first_seen_at", "last_seen_at", *[f"l.{v}" for v in POLICY_VALUES])
    names = own.select(F.col("policy_id").alias("o_id"), F.col("policy_name").alias("o_name"))
    parents = names.join(areas, F.col("o_id") == F.col("policy_area_id"), "full_outer").select(
        F.coalesce("o_id", "policy_area_id").alias("parent_id"), F.coalesce("o_name", "policy_area_name").alias("policy_parent_name"), F.col("o_id").isNotNull().alias("observed"),
    )
    actions = F.coalesce("policy_enforcement_actions", F.array().cast("array<string>"))
    root, named = F.col("policy_parent_id").isNull(), F.col("policy_parent_name").isNotNull()
    return own.join(parents, F.col("policy_parent_id") == F.col("parent_id"), "left").select(
        surrogate_key("policy_id").alias("policy_key"), "policy_id", "policy_name", "policy_customer_ref", "policy_parent_id", "policy_parent_name",
        root.alias("is_root_policy"), (~root & named).alias("policy_parent_name_resolved"),
        F.when(root, "root_policy").when(~named, "unresolved").when(F.col("observed"), "observed_policy").otherwise("policy_area_seed").alias("policy_parent_name_source"),
        F.coalesce("policy_parent_name", "policy_name").alias("policy_group_name"), "policy_is_illegal", "policy_is_non_violating",
        F.when(F.col("policy_is_non_violating"), "non_violating").when(F.col("policy_is_illegal"), "illegal").otherwise("violating").alias("policy_severity_class"),
        actions.alias("policy_enforcement_actions"), F.size(actions).cast("long").alias("policy_action_count"),
        F.col("observation_count").alias("application_count"), "first_seen_at", "last_seen_at",
    )


POLICY = Dimension(("policy_id",), _policy_rows, {**SEEN, "l": ("max", lambda: _row(POLICY_VALUES))}, _policies)


def dim_policy(applied: DataFrame, areas: DataFrame) -> DataFrame:
    return _policies(POLICY.state(applied), areas)


def _reviewer_rows(decided: DataFrame, actions: DataFrame) -> DataFrame:
    parts = [
        df.where(F.length(F.trim(mail)) > 0).select(
            email_key(mail).alias("reviewer_email"), F.col(name).alias("reviewer_name"), F.col(groups).alias("g"), F.col(t).alias("observed_at"), F.lit(e).alias("event"))
        for df, mail, name, groups, t, e in (
            (decided, "reviewer_email", "reviewer_name", "reviewer_groups", "decided_at", "job.closed"),
            (actions, "actor_user_email", "actor_user_name", "actor_user_groups", "actioned_at", "job.actioned"))
    ]
    names = F.filter("g.name", lambda x: x.isNotNull())
    return _union(parts).withColumn("reviewer_group_array", F.sort_array(F.coalesce(names, F.array().cast("array<string>"))))


def _reviewers(state: DataFrame) -> DataFrame:
    """People who decided or acted, by lower-case e-mail; vendors are read from group names."""
    out = state.select("*", "l.reviewer_name", "l.reviewer_group_array", F.size("events").cast("long").alias("observed_event_type_count")).drop("l")
    outside = F.filter("reviewer_group_array", lambda x: x.ilike("% BPO %"))
    special = F.filter(outside, lambda x: x.like("% - %"))
    vendor = F.array_max(F.transform(outside, lambda x: F.trim(F.split_part(x, F.lit(" BPO "), F.lit(1)))))
    member = lambda g: F.array_contains("reviewer_group_array", g)
    return out.select(
        surrogate_key("reviewer_email").alias("reviewer_key"), "reviewer_email", "reviewer_name", "reviewer_group_array",
        F.array_join("reviewer_group_array", ", ").alias("reviewer_groups_label"), vendor.alias("vendor_name"),
        F.array_max(F.transform(special, lambda x: F.trim(F.split_part(x, F.lit(" - "), F.lit(-1))))).alias("vendor_specialism"),
        vendor.isNotNull().alias("is_outsourced"), F.coalesce(vendor, F.lit("In-house")).alias("staffing_model"),
        member("Admin").alias("is_admin"), member("QA").alias("is_qa"), member("Escalation Team").alias("is_escalation_team"),
        "observation_count", "decision_observation_count", "action_observation_count", "observed_event_type_count", "first_seen_at", "last_seen_at",
    )


REVIEWER = Dimension(
    ("reviewer_email",), _reviewer_rows,
    {
        **SEEN, "events": ("set", lambda: F.col("event")), "decision_observation_count": ("sum", lambda: (F.col("event") == "job.closed").cast("long")),
        "action_observation_count": ("sum", lambda: (F.col("event") == "job.actioned").cast("long")), "l": ("max", lambda: _row(["reviewer_name", "reviewer_group_array"])),
    },
    _reviewers,
)


def dim_reviewer(decided: DataFrame, actions: DataFrame) -> DataFrame:
    return REVIEWER.build(decided, actions)


def _entity_rows(decided: DataFrame, actions: DataFrame, closures: DataFrame) -> DataFrame:
    """The document travels as its canonical text through the aggregation and is parsed once at the end."""
    parts = [
        df.where("entity_id IS NOT NULL").select("entity_schema", "entity_id", F.to_json("entity_attributes").alias("bag"), F.col(t).alias("observed_at"), F.lit(False).alias("trigger"))
        for df, t in ((decided, "decided_at"), (actions, "actioned_at"), (closures, "closed_at"))
    ]
    parts.append(
        actions.where("trigger_entity_id IS NOT NULL").select(
            F.col("trigger_entity_schema").alias("entity_schema"), F.col("trigger_entity_id").alias("entity_id"), F.lit(None).cast("string").alias("bag"),
            F.col("actioned_at").alias("observed_at"), F.lit(True).alias("trigger"))
    )
    return _union(parts).where("entity_schema IS NOT NULL")


def _entities(state: DataFrame) -> DataFrame:
    """What was reviewed, by schema and id. The latest document of attributes stays open-ended."""
    rows = state.withColumn("entity_attributes", F.try_parse_json("l.bag"))
    return rows.select(
        surrogate_key("entity_schema", "entity_id").alias("entity_key"), "entity_schema", "entity_id", "entity_attributes",
        *[at("entity_attributes", a).alias(f"entity_{a}") for a in ("object_url", "username", "email", "caption")],
        F.col("l.bag").isNotNull().alias("has_attributes"), "was_reviewed", "triggered_a_workflow", "first_seen_at", "last_seen_at", "observation_count",
    )


ENTITY = Dimension(
    ("entity_schema", "entity_id"), _entity_rows,
    {
        **SEEN, "was_reviewed": ("max", lambda: ~F.col("trigger")), "triggered_a_workflow": ("max", lambda: F.col("trigger")),
        "l": ("max", lambda: _row(["bag"], first=(F.col("bag").isNotNull().alias("__has"),))),
    },
    _entities,
)


def dim_entity(decided: DataFrame, actions: DataFrame, closures: DataFrame) -> DataFrame:
    return ENTITY.build(decided, actions, closures)


WORKFLOW_VALUES = ["workflow_name", "workflow_rule_id", "workflow_rule_name", "workflow_trigger_type"]


def _workflow_rows(actions: DataFrame) -> DataFrame:
    columns = [*WORKFLOW_VALUES, "workflow_event_name"]
    return actions.where("actor_workflow_id IS NOT NULL").select(
        F.col("actor_workflow_id").alias("workflow_id"), *[F.col(f"actor_{c}").alias(c) for c in columns], F.col("actioned_at").alias("observed_at")
    )


def _workflows(state: DataFrame) -> DataFrame:
    return state.select(
        surrogate_key("workflow_id").alias("workflow_key"), "workflow_id", *[f"l.{v}" for v in WORKFLOW_VALUES], F.col("observation_count").alias("action_count"),
        F.size("rules").cast("long").alias("distinct_rule_count"), F.size("event_names").cast("long").alias("distinct_event_name_count"), "first_seen_at", "last_seen_at",
    )


WORKFLOW = Dimension(
    ("workflow_id",), _workflow_rows,
    {**SEEN, "rules": ("set", lambda: F.col("workflow_rule_id")), "event_names": ("set", lambda: F.col("workflow_event_name")), "l": ("max", lambda: _row(WORKFLOW_VALUES))},
    _workflows,
)


def dim_workflow(actions: DataFrame) -> DataFrame:
    return WORKFLOW.build(actions)


def _enforcement_rows(enforced: DataFrame) -> DataFrame:
    return enforced.where("enforcement_action_slug IS NOT NULL").withColumn("observed_at", F.col("decided_at"))


def _enforcement_actions(state: DataFrame, ladder: list[tuple[str, int, str]] = LADDER) -> DataFrame:
    slug = F.col("enforcement_action_slug")
    chosen = lambda k: F.coalesce(*[F.when(slug == row[0], F.lit(row[k])) for row in ladder])
    return state.select(
        surrogate_key("enforcement_action_slug").alias("enforcement_action_key"), slug, title("enforcement_action_slug", "_").alias("enforcement_action_name"),
        F.coalesce(chosen(1), F.lit(0)).cast("long").alias("enforcement_severity_rank"), F.coalesce(chosen(2), F.lit("unclassified")).alias("enforcement_category"),
        slug.isin(*[row[0] for row in ladder]).alias("is_recognised_action"), (slug == "no_action").alias("is_no_action"),
        F.col("observation_count").alias("application_count"), "automated_application_count",
        (F.col("observation_count") - F.col("automated_application_count")).alias("human_application_count"), "first_seen_at", "last_seen_at",
    )


ENFORCEMENT_ACTION = Dimension(
    ("enforcement_action_slug",), _enforcement_rows, {**SEEN, "automated_application_count": ("sum", lambda: F.coalesce(F.col("is_automated").cast("long"), F.lit(0)))}, _enforcement_actions
)


def dim_enforcement_action(enforced: DataFrame, ladder: list[tuple[str, int, str]] = LADDER) -> DataFrame:
    return _enforcement_actions(ENFORCEMENT_ACTION.state(enforced), ladder)
