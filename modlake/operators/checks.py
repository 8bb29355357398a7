"""Data assertions: each returns the rows that fail it. Severity is kept beside the test."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modlake.functions.exprs import seconds_between, utc


def unique(df: DataFrame, *cols: str) -> DataFrame:
    """Values of the columns that stand in several rows, nulls left out for a single column."""
    rows = df.where(F.col(cols[0]).isNotNull()) if len(cols) == 1 else df
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Unexpected values, with how often they occur; nulls are no concern of this test."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(values)).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))


def relationships(df: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    return df.where(F.col(fk).isNotNull()).join(dim.select(F.col(pk).alias("__pk")).distinct(), F.col(fk) == F.col("__pk"), "left_anti")


def accepted_range(df: DataFrame, col: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    c = F.col(col)
    bad = F.lit(False)
    if low is not None:
        bad = bad | ((c < low) if inclusive else (c <= low))
    if high is not None:
        bad = bad | ((c > high) if inclusive else (c >= high))
    return df.where(bad)


def closures_without_decisions(closures: DataFrame) -> DataFrame:
    return closures.where("closure_decision_count = 0").select("job_closure_event_sk", "job_id", "closed_at")


def allocation_disagrees(decided: DataFrame, applied: DataFrame) -> DataFrame:
    """The decisions that carry policies, and the sum of their policies' shares, if these are too far apart."""
    n = decided.where("policy_count > 0").agg(F.count(F.lit(1)).alias("decision_count"))
    shares = applied.agg(F.coalesce(F.sum("decision_count_allocated"), F.lit(0.0)).alias("allocated"))
    both = n.crossJoin(shares)  # one row each
    return both.where(F.abs(F.col("decision_count") - F.col("allocated")) > F.greatest(F.lit(0.01), F.col("decision_count") * 0.0001))


def decisions_before_creation(decided: DataFrame) -> DataFrame:
    early = seconds_between("decided_at", "job_created_at")
    return decided.where(F.col("decided_at") < F.col("job_created_at")).select("decision_sk", "job_id", "decided_at", "job_created_at", early.alias("seconds_before"))


def _event_times(acted: DataFrame, closed: DataFrame, decided: DataFrame) -> DataFrame:
    """All times of events; without a key where a relation was read without."""
    parts = [
        df.select(F.lit(e).alias("source_event"), (F.col(k) if k in df.columns else F.lit(None).cast("string")).alias("event_key"), F.col(t).alias("event_at"))
        for df, e, k, t in (
            (acted, "job.actioned", "job_action_event_sk", "actioned_at"), (closed, "job.closed", "job_closure_event_sk", "closed_at"), (decided, "decision", "decision_sk", "decided_at"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def implausibly_old(acted: DataFrame, closed: DataFrame, decided: DataFrame, minimum_date: str) -> DataFrame:
    return _event_times(acted, closed, decided).where(F.col("event_at") < utc(f"{minimum_date} 00:00:00"))


def in_the_future(acted: DataFrame, closed: DataFrame, decided: DataFrame, now: str, tolerance_hours: int) -> DataFrame:
    limit = utc(now) + F.make_dt_interval(hours=F.lit(tolerance_hours))
    return _event_times(acted, closed, decided).where(F.col("event_at") > limit)


def actions_disagree(job_actions: DataFrame, jobs: DataFrame) -> DataFrame:
    """Jobs of which the snapshot counts other actions than the action fact has."""
    counted = job_actions.where("job_id IS NOT NULL").groupBy(F.col("job_id").alias("a_id")).agg(F.count(F.lit(1)).alias("fact_count"))
    both = jobs.select("job_id", F.col("action_count").alias("job_count")).join(counted, F.col("job_id") == F.col("a_id"), "full_outer")
    shown = both.select(F.coalesce("job_id", "a_id").alias("job_id"), F.coalesce("fact_count", F.lit(0)).alias("fact_count"), "job_count")
    return shown.where(~F.col("fact_count").eqNullSafe(F.col("job_count")))


def orphan_decisions(decided: DataFrame, closed: DataFrame) -> DataFrame:
    keys = closed.select(F.col("job_closure_event_sk").alias("__k"))
    return decided.join(keys, F.col("job_closure_event_sk") == F.col("__k"), "left_anti")


def freshness(landed: DataFrame, now: str, warn_hours: int = 6, error_hours: int = 24) -> DataFrame:
    """One row: age of the last import, and pass, warn or error."""
    last = landed.agg(F.max("import_ts").alias("last_import"))
    age = (F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.col("last_import").cast("timestamp"))) / 3600.0
    status = F.when(age.isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass")
    return last.select("last_import", age.alias("age_hours"), status.alias("status"))


def continuous_metrics(df: DataFrame, table: str, now: str, fresh: str, null_columns: list[str]) -> DataFrame:
    """FRESHNESS (seconds), ROW_COUNT and NULL_COUNT of each column as rows of a results table, by one pass."""
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.max(F.col(fresh)).cast("timestamp"))
    one = df.agg(age.cast("double").alias("FRESHNESS"), F.count(F.lit(1)).cast("double").alias("ROW_COUNT"), *[F.count_if(F.col(c).isNull()).cast("double").alias(f"NULL_COUNT:{c}") for c in null_columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("metric_name"), F.col(f"`{c}`").alias("value")) for c in one.columns]))
    return one.select(pairs.alias("m")).select(F.lit(now).cast("timestamp").alias("measurement_time"), F.lit(table).alias("table_name"), "m.metric_name", "m.value")


def stalled(results: DataFrame, now: str, max_age_hours: int = 6, window_hours: int = 2) -> DataFrame:
    """Recent measurements that say a table is older than it may be."""
    since = F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(window_hours))
    return results.where((F.col("metric_name") == "FRESHNESS") & (F.col("measurement_time") >= since) & (F.col("value") > max_age_hours * 3600))


def score_gate(current: DataFrame, previous: DataFrame | None, minimum: dict[str, float], max_drop: float = 0.2) -> DataFrame:
    """Reasons to refuse a run of evaluation scores (input, metric_name, eval_agg_score).

    A metric's mean below its minimum, an input that lost more than max_drop on a metric since the
    previous run, and a run without any score.
    """
    reason = lambda r, m, i, v, w: [F.lit(r).alias("reason"), m.alias("metric_name"), i.alias("input"), v.cast("double").alias("value"), w.cast("double").alias("wanted")]
    no = F.lit(None).cast("string")
    means = current.groupBy("metric_name").agg(F.avg("eval_agg_score").alias("mean"))
    least = F.create_map(*[F.lit(x) for kv in minimum.items() for x in kv])[F.col("metric_name")]
    out = means.withColumn("least", least).where("mean < least").select(*reason("below_minimum", F.col("metric_name"), no, F.col("mean"), F.col("least")))
    empty = current.agg(F.count("eval_agg_score").alias("n")).where("n = 0").select(*reason("no_scores", no, no, F.col("n"), F.lit(1)))
    out = out.unionByName(empty)
    if previous is not None:
        mean = lambda df, n: df.groupBy("input", "metric_name").agg(F.avg("eval_agg_score").alias(n))
        both = mean(current, "now").join(mean(previous, "before"), ["input", "metric_name"])
        worse = both.where(F.col("before") - F.col("now") > max_drop)
        out = out.unionByName(worse.select(*reason("regression", F.col("metric_name"), F.col("input"), F.col("now"), F.col("before"))))
    return out


@dataclass(frozen=True)
class Test:
    """A named test of a table: run() gives what fails it.

    Tests of single rows have a predicate, in SQL, those of keys the columns of the key, and those of references the
    table and column referred to; so one pass counts them all.
    """

    __test__ = False  # not one of pytest's

    table: str
    kind: str
    severity: str
    call: Callable | None = None
    fails: str | None = None
    key: tuple[str, ...] = ()
    of: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        return f"{self.table}__{self.kind}"

    def run(self, lake) -> DataFrame:
        rows = lake[self.table] if not self.call else None
        if self.of:
            return relationships(rows, self.key[0], lake[self.of[0]], self.of[1])
        if self.key:
            return unique(rows, *self.key)
        return self.call(lake) if self.call else rows.where(self.fails)


# Fixed values of the event contract.
ACTIONS = ["created", "made_decision", "skipped", "changed_queue", "escalated", "returned", "deferred", "cancelled", "paused", "resumed", "assigned", "commented"]
ACTION_SOURCES = ["auto", "workflow", "api", "manual", "agent"]
DECISION_SOURCES = ["manual", "automated", "workflow", "api", "agent"]
JOB_CATEGORIES = ["standard", "appeal", "qa", "golden", "qa_appeal", "training", "multi_review"]
ACTION_CATEGORIES = ["none", "advisory", "visibility", "content", "account", "unclassified"]

#: What each column has to be: "key" (unique, not null), "required", ("in", values), ("range", low, high) or ("of", table, column),
#: each with a severity after it where that is not error.
COLUMNS: dict[str, dict[str, list]] = {
    "landed_job_actioned": {"event": ["required", ("in", ["job.actioned"])], "payload": ["required"], "import_ts": ["required"]},
    "landed_job_closed": {"event": ["required", ("in", ["job.closed"])], "payload": ["required"], "import_ts": ["required"]},
    "policy_areas": {"policy_area_id": ["key"], "policy_area_name": ["required"]},
    "stg_job_actions": {
        "job_action_event_sk": ["key"], "action": ["required", ("in", ACTIONS, "warn")], "action_source": ["required", ("in", ACTION_SOURCES, "warn")],
        "actor_type": ["required", ("in", ["user", "workflow", "none"])], "actioned_at": ["required"], "job_id": ["required"], "job_category": [("in", JOB_CATEGORIES, "warn")],
        "has_entity": ["required"], "queue_slug": ["required"], "delivery_count": ["required", ("range", 1, None)],
    },
    "stg_job_closures": {
        "job_closure_event_sk": ["key"], "job_id": ["required", ("unique", "warn")], "closed_at": ["required"], "job_category": [("in", JOB_CATEGORIES, "warn")],
        "closure_decision_count": ["required", ("range", 1, None, "warn")], "time_to_close_seconds": [("range", 0, None, "warn")],
    },
    "stg_decisions": {
        "decision_sk": ["key"], "job_closure_event_sk": ["required", ("of", "stg_job_closures", "job_closure_event_sk")], "decided_at": ["required"],
        "decision_source_type": ["required", ("in", DECISION_SOURCES, "warn")], "handle_time_seconds": [("range", 0, None, "warn")], "policy_count": ["required"], "is_final_decision": ["required"],
    },
    "stg_decision_policies": {
        "decision_policy_sk": ["key"], "decision_sk": ["required", ("of", "stg_decisions", "decision_sk")], "policy_id": ["required"], "is_root_policy": ["required"],
        "decision_count_allocated": [("range", 0, 1)],
    },
    "stg_decision_enforcement_actions": {
        "decision_enforcement_action_sk": ["key"], "decision_sk": ["required", ("of", "stg_decisions", "decision_sk")], "enforcement_action_slug": ["required"], "is_no_action": ["required"],
    },
    "dim_queue": {"queue_key": ["key"], "queue_slug": ["key"]},
    "dim_policy": {"policy_name": ["required"], "policy_group_name": ["required"],"policy_key": ["key"], "policy_id": ["key"], "policy_severity_class": ["required", ("in", ["illegal", "violating", "non_violating"])]},
    "dim_reviewer": {"staffing_model": ["required"], "is_outsourced": ["required"], "reviewer_key": ["key"], "reviewer_email": ["key"]},
    "dim_entity": {"entity_schema": ["required"], "entity_id": ["required"], "has_attributes": ["required"], "entity_key": ["key"]},
    "dim_workflow": {"workflow_key": ["key"], "workflow_id": ["key"]},
    "dim_enforcement_action": {
        "is_recognised_action": ["required"],
        "enforcement_action_key": ["key"], "enforcement_action_slug": ["key"], "enforcement_severity_rank": ["required", ("range", 0, 5)], "enforcement_category": [("in", ACTION_CATEGORIES)],
    },
    "fct_decisions": {
        **{c: ["required"] for c in ("job_closure_event_sk", "decided_at", "decision_count", "is_automated", "is_cleared_outcome", "is_final_decision")},
        "decision_sk": ["key"], "queue_key": [("of", "dim_queue", "queue_key")], "reviewer_key": [("of", "dim_reviewer", "reviewer_key")], "entity_key": [("of", "dim_entity", "entity_key")],
    },
    "fct_decision_policies": {
        "decision_policy_sk": ["key"], "decision_sk": ["required", ("of", "fct_decisions", "decision_sk")], "policy_key": [("of", "dim_policy", "policy_key")],
        "decision_count_allocated": [("range", 0, 1)],
    },
    "fct_job_actions": {
        "actioned_at": ["required"], "job_action_count": ["required"],
        "job_action_event_sk": ["key"], "queue_key": [("of", "dim_queue", "queue_key")], "reviewer_key": [("of", "dim_reviewer", "reviewer_key")], "workflow_key": [("of", "dim_workflow", "workflow_key")],
    },
    "fct_jobs": {
        **{c: ["required"] for c in ("job_status", "is_closed", "is_open", "missing_action_history")},
        "job_key": ["key"], "job_id": ["key"], "final_queue_key": [("of", "dim_queue", "queue_key")], "entity_key": [("of", "dim_entity", "entity_key")],
        "final_reviewer_key": [("of", "dim_reviewer", "reviewer_key")], "queue_change_count": ["required", ("range", 0, None)], "time_to_close_hours": [("range", 0, None, "warn")],
    },
}


def _column_tests(table: str, column: str, rule) -> list[Test]:
    kind, *args = rule if isinstance(rule, tuple) else (rule,)
    severity = args.pop() if args and args[-1] == "warn" else "error"
    missing = Test(table, f"not_null_{column}", severity, fails=f"{column} IS NULL")
    once = Test(table, f"unique_{column}", severity, key=(column,))
    if kind == "key":
        return [once, missing]
    if kind == "required":
        return [missing]
    if kind == "unique":
        return [once]
    if kind == "in":
        listed = ", ".join(f"'{v}'" for v in args[0])
        return [Test(table, f"accepted_{column}", severity, fails=f"{column} NOT IN ({listed})")]
    if kind == "of":
        return [Test(table, f"relationships_{column}", severity, key=(column,), of=(args[0], args[1]))]
    low, high = args
    beyond = [f"{column} {sign} {limit}" for sign, limit in (("<", low), (">", high)) if limit is not None]
    return [Test(table, f"range_{column}", severity, fails=" OR ".join(beyond))]


def _between(lake) -> tuple[DataFrame, DataFrame, DataFrame]:
    return lake["stg_job_actions"], lake["stg_job_closures"], lake["stg_decisions"]


def _age(table: str) -> list[Test]:
    """An import that is older than the first limit is worth a warning, one older than the second stops the build."""
    return [Test(table, f"freshness_{s}", s, lambda lake, s=s: freshness(lake[table], lake.now).where(F.col("status") == s)) for s in ("warn", "error")]


#: Tests of more than a column, by the table after which they run.
WHOLE = {
    "landed_job_actioned": _age("landed_job_actioned"),
    "landed_job_closed": _age("landed_job_closed"),
    "stg_job_closures": [Test("stg_job_closures", "without_decisions", "warn", fails="closure_decision_count = 0")],
    "stg_decisions": [
        Test("stg_decisions", "implausibly_old", "error", lambda lake: implausibly_old(*_between(lake), lake.config.minimum_date)),
        Test("stg_decisions", "in_the_future", "error", lambda lake: in_the_future(*_between(lake), lake.now, lake.config.skew_tolerance_hours)),
    ],
    "dim_entity": [Test("dim_entity", "unique_entity_schema_entity_id", "error", key=("entity_schema", "entity_id"))],
    "fct_decisions": [
        Test("fct_decisions", "before_creation", "warn", fails="decided_at < job_created_at"),
        Test("fct_decisions", "orphans", "error", lambda lake: orphan_decisions(lake["fct_decisions"], lake["stg_job_closures"])),
    ],
    "fct_decision_policies": [Test("fct_decision_policies", "allocation", "error", lambda lake: allocation_disagrees(lake["fct_decisions"], lake["fct_decision_policies"]))],
    "fct_jobs": [Test("fct_jobs", "actions_reconcile", "error", lambda lake: actions_disagree(lake["stg_job_actions"], lake["fct_jobs"]))],
}


def tests_of(table: str) -> list[Test]:
    """The tests that a table has to pass when it is built."""
    columns = [t for column, rules in COLUMNS.get(table, {}).items() for rule in rules for t in _column_tests(table, column, rule)]
    return columns + WHOLE.get(table, [])


def _key_text(columns: tuple[str, ...]):
    """A key as one text, different for different keys; null where a key of one column is null."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    text = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def failing_counts(lake, tables: list[str] | None = None) -> DataFrame:
    """(table_name, test, severity, n_failing) of every test.

    What rows fail by themselves is counted in one aggregation a table. For tests of keys and references each row gives
    its key, once whatever tests look at it, and its references; those of all tables meet in one shuffle by (place, key),
    where partial counts come first, so a key very many rows share is a row a task.
    """
    tests = [t for table in tables or [*COLUMNS, *(t for t in WHOLE if t not in COLUMNS)] for t in tests_of(table)]
    places, given = _marks(tests)
    n_slots = 1 + max([slot for _, slot in places], default=0)
    alone: dict[str, list[tuple[int, Test]]] = {}
    counted = []
    for (place, slot), t in zip(places, tests):
        if slot < 0 and t.fails is not None:
            alone.setdefault(t.table, []).append((place, t))
        elif slot < 0:
            counted.append(t.run(lake).agg(F.count(F.lit(1)).alias("n")).select(F.lit(place).alias("place"), F.lit(-1).alias("slot"), "n"))
    for table, held in alone.items():
        one = lake[table].agg(*[F.count_if(F.expr(t.fails)).alias(f"n{place}") for place, t in held])
        counts = F.explode(F.array(*[F.struct(F.lit(place).alias("place"), F.lit(-1).alias("slot"), F.col(f"n{place}").alias("n")) for place, _ in held]))
        counted.append(one.select(counts.alias("c")).select("c.*"))
    # rows without a key go after the array is taken apart: a filter of the array itself would not be compiled
    parts = [lake[table].select(F.explode(F.array(*marks)).alias("m")).where("m.key IS NOT NULL").select("m.*") for table, marks in given.items()]
    if parts:
        role = [F.count_if(F.col("slot") == slot).alias(f"n{slot}") for slot in range(n_slots)]
        met = reduce(DataFrame.unionByName, parts).groupBy("place", "key").agg(*role)
        # by slots: keys of several rows, and references to a key that no row has
        fails = [(F.col("n0") > 1).cast("long"), *[F.when(F.col("n0") == 0, F.col(f"n{slot}")).otherwise(0) for slot in range(1, n_slots)]]
        counted.append(met.groupBy("place").agg(F.array(*[F.sum(c) for c in fails]).alias("n")).select("place", F.posexplode("n").alias("slot", "n")))
    found = reduce(DataFrame.unionByName, counted).select(F.col("place").alias("__place"), F.col("slot").alias("__slot"), "n")
    rows = [(*at, t.table, t.kind, t.severity) for at, t in zip(places, tests)]
    names = found.sparkSession.createDataFrame(rows, "place int, slot int, table_name string, test_name string, severity string")
    out = names.join(found, (F.col("place") == F.col("__place")) & (F.col("slot") == F.col("__slot")), "left")
    return out.select("table_name", F.col("test_name").alias("test"), "severity", F.coalesce("n", F.lit(0)).cast("long").alias("n_failing"))


def _marks(tests: list[Test]) -> tuple[list[tuple[int, int]], dict[str, list]]:
    """(place, slot) of each test, and of each table the marks (place, key, slot) that a row of it gives for keys and references.

    A place is a key of a table, or a test by itself. Slot 0 is of rows that have the key, each test of references to the
    key has one of its own, and -1 is of tests by themselves.
    """
    place_of: dict[tuple, int] = {}
    slots: dict[int, int] = {}
    places: list[tuple[int, int]] = []
    given: dict[str, list] = {}

    def mark(table: str, place: int, columns: tuple[str, ...], slot: int) -> None:
        given.setdefault(table, []).append(F.struct(F.lit(place).alias("place"), _key_text(columns).alias("key"), F.lit(slot).alias("slot")))

    def place_of_key(table: str, columns: tuple[str, ...]) -> int:
        if (table, columns) not in place_of:
            place_of[table, columns] = len(place_of)
            mark(table, place_of[table, columns], columns, 0)
        return place_of[table, columns]

    for i, t in enumerate(tests):
        if t.of:
            place = place_of_key(t.of[0], (t.of[1],))
            slot = slots[place] = slots.get(place, 0) + 1
            mark(t.table, place, t.key, slot)
        elif t.key:
            place, slot = place_of_key(t.table, t.key), 0
        else:
            place, slot = place_of.setdefault((i,), len(place_of)), -1
        places.append((place, slot))
    return places, given
