"""Masking of personal data by category. Access is a parameter; the default is masked.

Columns carry their category as metadata, which the engine keeps through selection, renaming, joins, grouping and
Parquet files, so what derives from a tagged column as it is stays tagged under any name. An expression loses the
mark; what has none is withheld if it is text or a document, so that a new or derived column has to be declared
before anybody unprivileged reads it. Numbers, times and truth values pass.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REDACTED = "*** REDACTED ***"
#: Name of the mark in a column's metadata, and its value for a column that anybody may read.
MARK, PUBLIC = "pii", "NONE"
#: Category of each column that holds personal data, by its name, which is the same in every relation.
CATEGORIES = {
    "reviewer_email": "EMAIL", "reviewer_name": "NAME", "final_reviewer_email": "EMAIL", "actor_user_email": "EMAIL", "actor_user_name": "NAME",
    "entity_id": "IDENTIFIER", "trigger_entity_id": "IDENTIFIER", "entity_email": "EMAIL", "entity_username": "USERNAME", "entity_caption": "FREE_TEXT",
    "entity_attributes": "BAG", "notes": "FREE_TEXT", "payload": "PAYLOAD", "closure_decisions": "PAYLOAD",
}
#: Columns of texts and documents that anybody may read.
READABLE = set(
    """event_sk event record_source job_action_event_sk job_closure_event_sk decision_sk decision_policy_sk decision_enforcement_action_sk
    queue_key policy_key reviewer_key entity_key trigger_entity_key workflow_key enforcement_action_key job_key final_queue_key final_reviewer_key
    action action_source actor_type job_id job_category job_status job_status_after queue_slug queue_name current_queue_slug final_queue_slug latest_action entity_schema
    trigger_entity_schema entity_object_url actor_user_groups reviewer_groups reviewer_group_array reviewer_groups_label vendor_name vendor_specialism staffing_model
    actor_workflow_id actor_workflow_name actor_workflow_rule_id actor_workflow_rule_name actor_workflow_trigger_type actor_workflow_event_name
    workflow_id workflow_name workflow_rule_id workflow_rule_name workflow_trigger_type decision_source_type final_decision_source_type
    policies policy_id policy_name policy_customer_ref policy_parent_id policy_parent_name policy_parent_name_source policy_group_name policy_severity_class
    policy_area_id policy_area_name policy_enforcement_actions primary_policy_name primary_policy_group_name final_policy_group_name
    enforcement_actions enforcement_action_slug enforcement_action_name enforcement_category decided_day_of_week actioned_day_of_week closed_day_of_week""".split()
)
_HELD = {
    "dim_reviewer": "reviewer_email reviewer_name", "dim_entity": "entity_id entity_email entity_username entity_caption entity_attributes",
    "fct_decisions": "reviewer_email entity_id", "fct_decision_policies": "reviewer_email entity_id", "fct_job_actions": "actor_user_email actor_user_name entity_id trigger_entity_id",
    "fct_jobs": "final_reviewer_email entity_id", "stg_job_actions": "notes entity_id entity_attributes actor_user_name actor_user_email trigger_entity_id",
    "stg_job_closures": "entity_id entity_attributes closure_decisions", "stg_decisions": "reviewer_name reviewer_email entity_id entity_attributes notes",
    "stg_decision_policies": "entity_id reviewer_email", "stg_decision_enforcement_actions": "entity_id reviewer_email", "base_job_actioned": "payload", "base_job_closed": "payload",
    "landed_job_actioned": "payload", "landed_job_closed": "payload", "landed": "payload",
}
#: Category of each column that holds personal data, by table and column.
TAGS = {(table, c): CATEGORIES[c] for table, columns in _HELD.items() for c in columns.split()}
#: Attributes that stay readable in a masked bag.
ALLOWED = ["created", "media_count", "duration_seconds", "account_age_days", "transcript_available"]


def mask_text(c: Column, category: str | None) -> Column:
    """The masked form by category; an unknown category hides all. A null stays null."""
    if category == "EMAIL":
        shown = F.when(c.contains("@"), F.concat(F.lit("***@"), F.split_part(c, F.lit("@"), F.lit(-1)))).otherwise("***")
    elif category == "IDENTIFIER":
        shown = F.sha2(c, 256)
    elif category == "FREE_TEXT":
        shown = F.concat(F.lit("*** "), F.char_length(c).cast("string"), F.lit(" CHARS REDACTED ***"))
    else:
        shown = F.lit(REDACTED)
    return F.when(c.isNotNull(), shown)


def mask_bag(bag: Column) -> Column:
    """A document with its id hashed and the allowed attributes as they are; anything else is left out."""
    kept = [F.try_variant_get(bag, f"$.{a}", "variant").alias(a) for a in ALLOWED]
    hashed = F.sha2(F.try_variant_get(bag, "$.id", "string"), 256).alias("id")
    return F.when(bag.isNotNull(), F.to_variant_object(F.struct(hashed, *kept, F.lit("attributes withheld").alias("_redacted"))))


def withhold_payload(payload: Column) -> Column:
    return F.when(payload.isNotNull(), F.to_variant_object(F.struct(F.lit("payload withheld").alias("_redacted"))))


def masked(c: Column, category: str) -> Column:
    return mask_bag(c) if category == "BAG" else withhold_payload(c) if category == "PAYLOAD" else mask_text(c, category)


def tag(df: DataFrame, table: str, tags: dict = TAGS) -> DataFrame:
    """df with its category as metadata of each mapped column, and the mark of readable ones; a category that a column brings along stays."""
    marks = {}
    for f in df.schema.fields:
        brought = f.metadata.get(MARK)
        mark = brought if brought not in (None, PUBLIC) else tags.get((table, f.name), PUBLIC if f.name in READABLE else brought)
        if mark and mark != brought:
            marks[f.name] = {**f.metadata, MARK: mark}
    return df.select(*[F.col(f"`{c}`").alias(c, metadata=marks[c]) if c in marks else F.col(f"`{c}`") for c in df.columns])


def marked(table: str, column: str, tags: dict = TAGS) -> dict[str, str]:
    """The mark that a column of a table carries, for an expression that gives the same."""
    mark = tags.get((table, column), PUBLIC if column in READABLE else None)
    return {MARK: mark} if mark else {}


def audit_tags(tables: dict[str, DataFrame], tags: dict = TAGS) -> list[tuple[str, str, str, str | None]]:
    """(table, column, wanted, found) of mapped columns of the given tables that do not carry their category."""
    out = []
    for (table, column), wanted in tags.items():
        if table in tables:
            fields = {f.name: f for f in tables[table].schema.fields}
            found = fields[column].metadata.get(MARK) if column in fields else None
            if found != wanted:
                out.append((table, column, wanted, found))
    return out


def _withheld(c: Column, kind: str) -> Column:
    """A column of texts or documents that nobody has declared."""
    if kind == "variant":
        return withhold_payload(c)
    return mask_text(c, None) if kind.startswith(("string", "char", "varchar")) else F.lit(None).cast(kind)


def readable(df: DataFrame, privileged: bool = False) -> DataFrame:
    """df as someone may see it, by the marks that its columns carry, whatever they are called by now."""
    if privileged:
        return df
    out = []
    for f in df.schema.fields:
        c, kind, mark = F.col(f"`{f.name}`"), f.dataType.simpleString(), f.metadata.get(MARK)
        plain = not kind.startswith(("string", "char", "varchar", "variant", "array", "map", "struct", "binary"))
        if mark == PUBLIC or mark is None and plain:
            out.append(c)
        else:
            # a category is for one kind of column; what has another by now is withheld
            fits = kind == "variant" if mark in ("BAG", "PAYLOAD") else kind.startswith(("string", "char", "varchar"))
            out.append((masked(c, mark) if mark and fits else _withheld(c, kind)).alias(f.name))
    return df.select(*out)


def apply_masking(df: DataFrame, table: str, privileged: bool = False, tags: dict = TAGS) -> DataFrame:
    """df, a table of the map, as someone may see it: its texts and documents masked by category, or withheld where the map does not know them."""
    return df if privileged else readable(tag(df, table, tags))
