"""Registered queries of the checks, of masking, layout, incremental and streaming operators.

Checks over sound data return no rows, so each gets a frame in which arithmetic breaks something.
"""

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.functions.exprs import event_sk, on_or_after, without_zone
from modlake.operators import checks, incremental, layout, privacy
from modlake.operators.percentiles import exact_percentiles
from modlake.plans.lake import RELATIONS, Lake, bridged
from modlake.plans.oracle import FLAT
from modlake.plans.oracle import ORACLES as RELATIONS_SQL
from modlake.sources import bridge
from modlake.sources import events as sources
from modlake.sources.workspace import workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def a01_unique(spark, sf_dir):
    return checks.unique(table(spark, sf_dir, "events"), "user_id")


def a02_unique_combination(spark, sf_dir):
    return checks.unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def a03_not_null(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("user", F.when(F.col("event_id") % 17 != 0, F.col("user_id")))
    return checks.not_null(e, "user").select("event_id", "event_type")


def a04_accepted_values(spark, sf_dir):
    return checks.accepted_values(table(spark, sf_dir, "events"), "event_type", ["view", "click"])


def a05_relationships(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("fk", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")))
    return checks.relationships(o, "fk", table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0"), "c_custkey").select("o_orderkey", "o_custkey")


def a06_accepted_range(spark, sf_dir):
    return checks.accepted_range(table(spark, sf_dir, "lineitem"), "l_quantity", 3, 48).select("l_orderkey", "l_linenumber", "l_quantity")


def a07_closures_without_decisions(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    o = table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'")
    closures = o.join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("job_closure_event_sk"), F.concat(F.lit("job-"), F.col("o_orderkey")).alias("job_id"), F.col("o_orderdate").alias("closed_at"),
        F.coalesce("n", F.lit(0)).alias("closure_decision_count"),
    )
    return checks.closures_without_decisions(closures).select("job_id", "closed_at")


def a08_allocation_agrees(spark, sf_dir):
    lake = bridged(spark, sf_dir)
    out = checks.allocation_disagrees(lake["stg_decisions"], lake["stg_decision_policies"].where("policy_id <> 'pol-3'"))
    return out.select("decision_count", F.round("allocated", 4).alias("allocated"))


def a09_decisions_before_creation(spark, sf_dir):
    d = bridged(spark, sf_dir)["stg_decisions"].withColumn("job_created_at", F.col("job_created_at") + F.expr("INTERVAL 2 HOURS"))
    return checks.decisions_before_creation(d).select("job_id", "seconds_before")


def _times(lake):
    return [lake.of(name, {time}) for name, time in (("stg_job_actions", "actioned_at"), ("stg_job_closures", "closed_at"), ("stg_decisions", "decided_at"))]


def a10_plausible_times(spark, sf_dir):
    found = checks.implausibly_old(*_times(bridged(spark, sf_dir)), "1996-01-01")
    return found.select("source_event", without_zone(F.col("event_at")).alias("event_at"))


def a11_no_future_times(spark, sf_dir):
    found = checks.in_the_future(*_times(bridged(spark, sf_dir)), "2000-06-01 00:00:00", 24)
    return found.groupBy("source_event").agg(F.count(F.lit(1)).alias("n_rows"))


def a12_actions_reconcile(spark, sf_dir):
    lake = bridged(spark, sf_dir)
    return checks.actions_disagree(lake["stg_job_actions"].where("action <> 'skipped'"), lake.of("fct_jobs", {"job_id", "action_count"}))


def a13_no_orphan_decisions(spark, sf_dir):
    lake = bridged(spark, sf_dir)
    return checks.orphan_decisions(lake["stg_decisions"], lake["stg_job_closures"].where("NOT queue_is_multi_review")).select("job_id", "decision_ordinal")


NOW = "2024-02-01 00:00:00"


def a14_freshness(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("ts", "import_ts")
    return checks.freshness(e, NOW).select("last_import", F.round("age_hours", 6).alias("age_hours"), "status")


def a15_continuous_metrics(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("user", F.when(F.col("event_id") % 17 != 0, F.col("user_id")))
    return checks.continuous_metrics(e, "events", NOW, "ts", ["user", "event_type"]).select("table_name", "metric_name", "value")


def a16_stalled(spark, sf_dir):
    """Hourly measurements of the age of the last event of each type; the last two hours that are too old."""
    last = table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("ts").alias("last"))
    hours = last.select("event_type", "last", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("h"))
    at = F.lit(NOW).cast("timestamp") - F.make_dt_interval(hours=F.col("h"))
    age = (F.unix_seconds(at) - F.unix_seconds(F.col("last").cast("timestamp"))).cast("double")
    results = hours.select(at.alias("measurement_time"), F.col("event_type").alias("table_name"), F.lit("FRESHNESS").alias("metric_name"), age.alias("value"))
    return checks.stalled(results, NOW).select("table_name", "value")


def a17_score_gate(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    scores = lambda rows, salt: rows.select(
        F.col("event_type").alias("metric_name"), F.concat(F.lit("q"), F.col("user_id") % 20).alias("input"), (F.col("event_id") * salt % 101 / 101.0).alias("eval_agg_score")
    )
    out = checks.score_gate(scores(e.where("event_id % 2 = 0"), 37), scores(e.where("event_id % 2 = 1"), 53), {"view": 0.9, "click": 0.1, "error": 0.6}, 0.2)
    return out.select("reason", "metric_name", "input", F.round("value", 6).alias("value"), F.round("wanted", 6).alias("wanted"))


def mask_text(spark, sf_dir):
    s = table(spark, sf_dir, "customer").withColumn("mail", F.when(F.col("c_custkey") % 9 != 0, F.concat(F.lower("c_name"), F.when(F.col("c_custkey") % 4 != 0, F.lit("@host.test")).otherwise(""))))
    kinds = ["EMAIL", "NAME", "IDENTIFIER", "FREE_TEXT", "SOMETHING_ELSE"]
    return s.select("c_custkey", *[privacy.mask_text(F.col("mail"), k).alias(k.lower()) for k in kinds])


def mask_bag(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    bag = F.to_variant_object(F.struct(F.concat(F.lit("e"), F.col("event_id")).alias("id"), F.col("value").alias("secret"), (F.col("user_id") % 9).alias("media_count")))
    m = privacy.mask_bag(bag)
    get = lambda f, t: F.try_variant_get("m", f"$.{f}", t)
    return e.select("event_id", m.alias("m")).select(
        "event_id", get("id", "string").alias("id"), get("secret", "string").alias("secret"), get("media_count", "bigint").alias("media_count"), get("_redacted", "string").alias("note")
    )


def masked_reviewers(spark, sf_dir):
    columns = ["reviewer_key", "reviewer_email", "reviewer_name", "staffing_model"]
    return privacy.apply_masking(bridged(spark, sf_dir).of("dim_reviewer", set(columns)), "dim_reviewer").select(*columns)


def withheld_payloads(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("payload"))
    shown = privacy.apply_masking(e, "landed")
    return shown.select("event_id", F.try_variant_get("payload", "$._redacted", "string").alias("note"), F.try_variant_get("payload", "$.k", "string").alias("k"))


def masked_by_lineage(spark, sf_dir):
    """Copies of personal columns under other names, joined and built on, as the unprivileged see them; nothing lists these columns."""
    lake = bridged(spark, sf_dir)
    queues = lake["dim_queue"].select(F.col("queue_slug").alias("slug"), F.col("queue_name").alias("team"))
    d = lake["stg_decisions"].select(
        F.col("job_id").alias("case"), "decision_ordinal", F.col("reviewer_email").alias("contact"), F.upper("reviewer_name").alias("loud"), F.col("entity_id").alias("about"),
        F.struct("reviewer_email").alias("inner"), "handle_time_seconds", F.col("queue_slug").alias("q"),
    )
    out = privacy.readable(d.join(queues, F.col("q") == F.col("slug")).withColumnRenamed("contact", "person"))
    return out.select("case", "decision_ordinal", "person", "loud", "about", F.col("inner").isNull().alias("inner_withheld"), "handle_time_seconds", "team")


def touched_dates(spark, sf_dir):
    """The dates that an upsert of the incremental slice reads and writes again; None for rows without a time."""
    piece = incremental.incremental_slice(*_split(spark, sf_dir))
    early = table(spark, sf_dir, "events").where("event_id < 5").select("event_id", F.lit(None).cast("timestamp_ntz").alias("event_ts"))
    dates = incremental.touched_dates(piece.select("event_id", "event_ts").unionByName(early))
    return spark.createDataFrame([(d,) for d in dates], "event_date date")


def layout_pruning(spark, sf_dir):
    profile = layout.layout_profile(spark, f"{sf_dir}/orders.parquet", "o_orderdate")
    return layout.pruning_report(profile, low=F.expr("TIMESTAMP_NTZ '1997-01-01 00:00:00'"))


def layout_profile(spark, sf_dir):
    return layout.layout_profile(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey")


def _split(spark, sf_dir):
    """A target that lacks the last week and every tenth row before, and the stream it is built from."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_ts"), F.col("ts").alias("import_ts"), "value")
    last = e.agg(F.max("event_ts")).first()[0]
    return e, e.where((F.col("event_ts") < F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS")) & (F.col("event_id") % 10 != 3))


def merge_probe(spark, sf_dir):
    e, target = _split(spark, sf_dir)
    return layout.merge_probe(table(spark, sf_dir, "events"), incremental.incremental_slice(e, target), "event_id").select("n_rows")


def incremental_slice(spark, sf_dir):
    return incremental.incremental_slice(*_split(spark, sf_dir)).select("event_id", "event_ts")


def late_rows(spark, sf_dir):
    return incremental.late_rows(*_split(spark, sf_dir)).select("event_id", "event_ts")


def incremental_upsert(spark, sf_dir):
    e, target = _split(spark, sf_dir)
    piece = incremental.incremental_slice(e, target).withColumn("value", F.col("value") + 1).withColumn("note", F.lit("new"))
    return incremental.merged(target, piece).select("event_id", "event_ts", F.round("value", 6).alias("value"), "note")


def query_cost_rollup(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    log = e.select(
        F.concat(F.lit('/* {"node_id": "model.'), F.col("event_type"), F.lit('"} */ SELECT 1')).alias("query_text"), F.col("ts").alias("start_time"),
        F.when(F.col("event_id") % 7 == 0, "FAIL").otherwise("SUCCESS").alias("execution_status"), (F.col("event_id") * 31 % 1009).alias("total_elapsed_time"),
        (F.col("user_id") * 1000).alias("bytes_scanned"), (F.col("event_id") % 385).alias("partitions_scanned"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("bytes_spilled_to_local_storage"), (F.col("event_id") % 5).alias("bytes_spilled_to_remote_storage"),
    )
    return layout.query_cost_rollup(log, NOW, days=10)


def narrowed_percentiles(spark, sf_dir):
    """Percentiles of few groups of very many rows, in passes that narrow the interval of each rank; few rows count as small here."""
    rows = table(spark, sf_dir, "lineitem").withColumn("late", F.when(F.col("l_linenumber") > 1, F.col("l_quantity")))
    wanted = {"median_price": ("l_extendedprice", 0.5), "p90_price": ("l_extendedprice", 0.9), "median_late": ("late", 0.5)}
    out = exact_percentiles(rows, ["l_returnflag"], wanted, small=500)
    return out.select("l_returnflag", *[F.round(c, 4).alias(c) for c in wanted])


def pruned_weeks(spark, sf_dir):
    e = table(spark, sf_dir, "events").where(on_or_after("ts", "week", F.expr("TIMESTAMP_NTZ '2024-01-17 05:00:00'")))
    return e.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as an at-least-once stream, deduplicated by content and upserted as they come."""
    from modlake.streaming.deliveries import deduplicated, run_available

    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    parsed = rows.select(F.col("event_type").alias("event"), F.try_parse_json("props").alias("payload"), F.col("ts").alias("import_ts"), F.col("ts").cast("timestamp").alias("event_ts"))
    keyed = parsed.withColumn("event_sk", event_sk(F.col("event"), F.col("payload")))
    out = workspace(spark, "stream")
    run_available(deduplicated(keyed, "3650 days"), f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table").select("event_sk", "event")


def upsert_write(spark, sf_dir):
    """The target written by date, the slice with changed values and rows without a time upserted, and the table read back."""
    e, target = _split(spark, sf_dir)
    timeless = lambda rows: rows.withColumn("event_ts", F.when(F.col("event_id") % 7 != 0, F.col("event_ts")))
    path = workspace(spark, "upsert")
    incremental.upsert(spark, path, timeless(target))
    piece = incremental.incremental_slice(e, target).withColumn("value", F.col("value") + 1).withColumn("note", F.lit("new"))
    incremental.upsert(spark, path, timeless(piece))
    again = incremental.upsert(spark, path, timeless(piece))
    return again.select("event_id", "event_ts", F.round("value", 6).alias("value"), "note")


def moved_keys(spark, sf_dir):
    """Rows whose event time moves: to another date, to none, and from none back; each key stays in one row."""
    path = workspace(spark, "moved")
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_ts"), F.col("ts").alias("import_ts"), "value")
    moved = lambda rows, ts, n: rows.withColumns({"event_ts": ts, "value": F.col("value") + n, "import_ts": F.col("import_ts") + F.make_dt_interval(days=F.lit(n))})
    incremental.upsert(spark, path, e)
    later = F.when(F.col("event_id") % 3 != 0, F.col("event_ts") + F.make_dt_interval(days=F.lit(5)))
    incremental.upsert(spark, path, moved(e.where("event_id % 10 = 3"), later, 1))
    out = incremental.upsert(spark, path, moved(e.where("event_id % 20 = 3"), F.col("event_ts") - F.make_dt_interval(days=F.lit(40)), 2))
    return out.select("event_id", "event_ts", "event_date", F.round("value", 6).alias("value"))


def _surfaces(spark, sf_dir):
    """Events landed as a seed file (CSV) and as a raw table, and the configuration that reads them."""
    path = workspace(spark, "surfaces")
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("event"), F.col("props").alias("payload"), F.col("ts").alias("import_ts"))
    e.where("hour(import_ts) < 12").write.option("header", True).option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{path}/seed")
    e.withColumn("payload", F.try_parse_json("payload")).write.parquet(f"{path}/raw")
    return sources.SourceConfig(seeds={"view": f"{path}/seed"}, raw={"view": f"{path}/raw", "click": f"{path}/nowhere"}, overrides={"signup": "seed"}), path


def source_modes(spark, sf_dir):
    """Deliveries of an event by mode, and none of one without a surface."""
    config, _ = _surfaces(spark, sf_dir)
    parts = []
    for mode, event in (("seed", "view"), ("raw", "view"), ("union", "view"), ("raw", "click"), ("union", "signup")):
        rows = sources.resolve_events(spark, event, replace(config, mode=mode))
        k = F.try_variant_get("payload", "$.k", "bigint")
        parts.append(rows.agg(F.lit(mode).alias("mode"), F.lit(event).alias("event"), F.count(F.lit(1)).alias("n_rows"), F.sum(k).alias("k"), F.max("import_ts").alias("last")))
    return reduce(DataFrame.unionByName, parts)


def seed_and_raw_rows(spark, sf_dir):
    """All deliveries of one event from both surfaces, none dropped."""
    config, _ = _surfaces(spark, sf_dir)
    rows = sources.resolve_events(spark, "view", replace(config, mode="union"))
    return rows.select("record_source", "event", F.try_variant_get("payload", "$.k", "bigint").alias("k"), "import_ts")


def policy_area_file(spark, sf_dir):
    """A lookup read from a CSV file with a header."""
    path = workspace(spark, "areas")
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("policy_area_id"), F.col("n_name").alias("policy_area_name")).write.option("header", True).csv(path)
    return sources.read_policy_areas(spark, path)


def volume_stream(spark, sf_dir):
    """As many synthetic events as the event table has, projected for the incremental table; times and lags are checked."""
    rows = incremental.projected(bridge.volume_events(spark, table(spark, sf_dir, "events").count()))
    sound = (F.col("ingestion_lag_minutes").between(0, 4320)) & (F.length("trace_id") == 64) & F.col("job_id").startswith("job-")
    return rows.select("event_id", "event_ts", sound.alias("sound"))


def projected_events(spark, sf_dir):
    """The measures of the incremental table, from events with documents."""
    e = table(spark, sf_dir, "events")
    late = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 5000).cast("decimal(18,6)"))
    doc = F.to_variant_object(F.struct(F.concat(F.lit("t"), F.col("event_id")).alias("trace_id"), F.when(F.col("event_id") % 3 > 0, F.col("user_id").cast("string")).alias("content_fingerprint")))
    named = e.select("event_id", F.concat(F.lit("job-"), F.col("user_id")).alias("job_id"), F.col("event_type").alias("event"), F.lit("q").alias("queue_slug"), F.lit(None).cast("string").alias("actor_email"),
                     F.col("ts").alias("event_ts"), late.alias("import_ts"), doc.alias("payload"))
    return incremental.projected(named).select("event_id", "job_id", "event_ts", "trace_id", "content_fingerprint", "ingestion_lag_minutes")


def eval_questions(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("q"), F.col("event_id")).alias("question_id"), F.col("event_type").alias("query_text"), F.col("value").cast("string").alias("ground_truth"))
    made = sources.eval_questions(rows)
    return made.select("question_id", "query_text", F.try_variant_get("ground_truth", "$.ground_truth_output", "string").alias("answer"))


def lazy_view(spark, sf_dir):
    """A view over a query, read by its name."""
    sources.lazy_view(table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_mktsegment"), "modlake_customers_in_credit")
    return spark.sql("SELECT c_mktsegment, count(*) AS n_rows FROM modlake_customers_in_credit GROUP BY c_mktsegment")


def full_refresh(spark, sf_dir):
    """A table written twice; what was there before is gone."""
    path, s = workspace(spark, "refresh"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    sources.write_table(s, path)
    return sources.write_table(s.where("s_suppkey % 3 = 0"), path)


def stored_failures(spark, sf_dir):
    """Failing rows of a check, kept as a table and read back."""
    path = workspace(spark, "failed")
    sources.write_table(checks.accepted_range(table(spark, sf_dir, "lineitem"), "l_discount", 0.02, 0.05), path)
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_discount")


TESTS_NOW = "1998-06-01 00:00:00"


def column_tests(spark, sf_dir):
    """Every test of columns and tables from landing rows to facts, with the number of rows that fail it, as of a time within the data."""
    base = bridged(spark, sf_dir)
    lake = replace(base, now=TESTS_NOW)
    lake.made = base.made  # what either makes the other has
    return checks.failing_counts(lake)


def broken_column_tests(spark, sf_dir):
    """The same over tables that are broken: unknown and missing values, keys that repeat, references that lead nowhere."""
    base = bridged(spark, sf_dir)
    lake = replace(base, now=TESTS_NOW)
    job = F.substring("job_id", 5, 20).cast("long")
    every = lambda n, column, value: F.when(job % n == 0, value).otherwise(F.col(column))
    acted, decided, jobs, queues = (base[n] for n in ("stg_job_actions", "fct_decisions", "fct_jobs", "dim_queue"))
    decided = decided.withColumns({"decided_at": every(23, "decided_at", F.lit(None)), "queue_key": every(11, "queue_key", F.lit("lost"))})
    lake.made = {
        **{n: base[n] for n in (*base.surfaces, *RELATIONS)},
        "stg_job_actions": acted.withColumns({"action": every(13, "action", F.lit("unheard")), "delivery_count": every(31, "delivery_count", F.lit(0))}),
        "fct_decisions": decided.unionByName(decided.where(job % 17 == 0)),
        "fct_jobs": jobs.withColumns({"queue_change_count": every(19, "queue_change_count", F.lit(-1)), "entity_key": every(29, "entity_key", F.lit("lost"))}),
        "dim_queue": queues.unionByName(queues.where("queue_slug = '2-high'").withColumn("queue_key", F.lit(None).cast("string"))),
    }
    return checks.failing_counts(lake)


def tag_audit(spark, sf_dir):
    """Mapped columns without their category, of two dimensions of which one has lost its marks.

    Marks are in the schemas that the relations come to over the landed deliveries, so nothing between is written.
    """
    base = bridged(spark, sf_dir)
    lake = Lake({n: base[n] for n in base.surfaces})
    bare = lake["dim_entity"]
    tables = {"dim_reviewer": lake["dim_reviewer"], "dim_entity": bare.select(*[F.col(c).alias(c, metadata={}) for c in bare.columns])}
    return spark.createDataFrame(privacy.audit_tags(tables), "table_name string, column_name string, wanted string, found string")


def _dealt(spark, sf_dir):
    """Events in files of a day each, and in files that each span all days."""
    path, e = workspace(spark, "layout"), table(spark, sf_dir, "events")
    for name, group in (("sorted", F.to_date("ts").cast("string")), ("mixed", (F.col("event_id") % 8).cast("string"))):
        e.withColumn("g", group).repartition("g").write.partitionBy("g").parquet(f"{path}/{name}")
    return path


def layout_of_files(spark, sf_dir):
    path = _dealt(spark, sf_dir)
    parts = [layout.layout_profile(spark, f"{path}/{n}", "ts").select(F.lit(n).alias("layout"), "low", "high", "n_rows", "overlaps") for n in ("sorted", "mixed")]
    return parts[0].unionByName(parts[1])


def pruning_of_files(spark, sf_dir):
    """Files that a range of times leaves to read, and the average overlap, by layout."""
    path, parts = _dealt(spark, sf_dir), []
    for n in ("sorted", "mixed"):
        profile = layout.layout_profile(spark, f"{path}/{n}", "ts")
        kept = layout.pruning_report(profile, low=F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'"), high=F.expr("TIMESTAMP_NTZ '2024-01-12 00:00:00'"))
        parts.append(kept.crossJoin(layout.average_overlaps(profile).select(F.round("average_overlaps", 6).alias("average_overlaps"))).withColumn("layout", F.lit(n)))  # one row each
    return parts[0].unionByName(parts[1])


def probe_of_files(spark, sf_dir):
    """Rows of each file that an upsert of the last three hours would replace."""
    path, e = _dealt(spark, sf_dir), table(spark, sf_dir, "events")
    last = e.agg(F.max("ts")).first()[0]
    piece = e.where(F.col("ts") >= F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL 3 HOURS"))
    parts = [layout.merge_probe(spark.read.parquet(f"{path}/{n}"), piece, "event_id").select(F.lit(n).alias("layout"), "n_rows") for n in ("sorted", "mixed")]
    return parts[0].unionByName(parts[1])


def row_groups_of_files(spark, sf_dir):
    """Row groups of files written with small groups, by their footers; groups of a file do not overlap if it is sorted."""
    path = workspace(spark, "groups")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").coalesce(1)
    o.orderBy("o_orderkey").coalesce(1).write.option("parquet.block.row.count.limit", 1000).parquet(path)
    return layout.row_group_profile(spark, path, "o_orderkey").select("row_group", "low", "high", "n_rows", "overlaps")


def summaries_of_files(spark, sf_dir):
    """Files that a probe by key summaries opens, of all, and the rows it finds: keys of the last three hours."""
    path, e = _dealt(spark, sf_dir), table(spark, sf_dir, "events")
    last = e.agg(F.max("ts")).first()[0]
    piece = e.where(F.col("ts") >= F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL 3 HOURS"))
    parts = []
    for n in ("sorted", "mixed"):
        summaries = sources.write_table(layout.key_summaries(spark, f"{path}/{n}", "event_id"), workspace(spark, "summaries"))
        rows, cost = layout.probe(spark, f"{path}/{n}", piece, "event_id", summaries)
        parts.append(rows.agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("files_with_rows")).crossJoin(cost).select(F.lit(n).alias("layout"), "n_rows", "files_with_rows", "files_opened", "files"))  # one row each
    return parts[0].unionByName(parts[1])


def footer_slice(spark, sf_dir):
    """The slice of a target given by its path: the limit comes from footers."""
    e, target = _split(spark, sf_dir)
    path = workspace(spark, "target")
    target.withColumn("event_date", F.to_date("event_ts")).repartition("event_date").write.partitionBy("event_date").parquet(path)
    return incremental.incremental_slice(e, path).select("event_id", "event_ts")


def stream_lateness(spark, sf_dir):
    """A stream with 72 hours of lateness: the second batch brings redeliveries, the third these again and rows for the first time, some too late.

    A batch tells what is too late by the watermark that the batch before it began with.
    """
    from modlake.streaming.deliveries import deduplicated, run_available

    out, e = workspace(spark, "late"), table(spark, sf_dir, "events")
    for batch in ("event_id % 10 <> 3", "event_id % 10 = 1", "event_id % 10 IN (1, 3)"):
        e.where(batch).select("event_id", "event_type", "ts").coalesce(1).write.mode("append").parquet(f"{out}/in")
    rows = spark.readStream.schema("event_id long, event_type string, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    doc = F.to_variant_object(F.struct("event_id", "event_type"))
    keyed = rows.select(F.col("event_type").alias("event"), doc.alias("payload"), F.col("ts").alias("import_ts"), F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC").alias("event_ts"))
    run_available(deduplicated(keyed.withColumn("event_sk", event_sk(F.col("event"), F.col("payload"))), "72 hours"), f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table").select(F.get_json_object("payload", "$.event_id").cast("long").alias("event_id"), "event", "import_ts")


def stream_counts(spark, sf_dir):
    """Deliveries of a stream with their counts: the second batch repeats every fifth, the third every tenth, each an hour later."""
    from modlake.streaming.deliveries import count_available, counted

    out, e = workspace(spark, "counts"), table(spark, sf_dir, "events")
    for n, batch in enumerate(("event_id >= 0", "event_id % 5 = 1", "event_id % 10 = 1")):
        e.where(batch).select("event_id", "event_type", "ts", F.lit(n).alias("hours")).coalesce(1).write.mode("append").parquet(f"{out}/in")
    rows = spark.readStream.schema("event_id long, event_type string, ts timestamp_ntz, hours int").option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    keyed = rows.select(
        F.lit("raw").alias("record_source"), F.col("event_type").alias("event"), F.to_variant_object(F.struct("event_id", "event_type")).alias("payload"),
        (F.col("ts") + F.make_dt_interval(hours=F.col("hours"))).alias("import_ts"), F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC").alias("event_ts"),
    )
    count_available(counted(keyed.withColumn("event_sk", event_sk(F.col("event"), F.col("payload"))), "3650 days"), f"{out}/table", f"{out}/checkpoint")
    found = spark.read.parquet(f"{out}/table")
    return found.select(F.get_json_object("payload", "$.event_id").cast("long").alias("event_id"), "event", "first_seen_at", "last_seen_at", "delivery_count", "was_redelivered")


def _slices(spark, sf_dir, n):
    """Landed deliveries by event, in n slices by their text, which is made once a delivery and gives its identity too."""
    out = {}
    for event in ("job.actioned", "job.closed"):
        rows, path = bridged(spark, sf_dir)[f"landed_{event.replace('.', '_')}"], workspace(spark, "slices")
        text = F.to_json("payload")
        keyed = rows.withColumns({"event_sk": event_sk(F.col("event"), F.col("payload")), "slice": F.pmod(F.crc32(text.cast("binary")), F.lit(n)).cast("int")})
        with sources.whole_documents(spark), sources.small_methods(spark):
            keyed.write.partitionBy("slice").option("compression", "zstd").parquet(path)
        out[event] = spark.read.schema(keyed.schema).parquet(path)
    return out


def refreshed_jobs(spark, sf_dir):
    """The job snapshot after three slices of deliveries by day of import, the last one with redeliveries, without building it as a whole."""
    from modlake.plans.refresh import Refreshed

    out = Refreshed(spark, workspace(spark, "refresh"), buckets=8, tables=("jobs", "dim_policy"))
    landed = _slices(spark, sf_dir, 3)
    for n in range(3):
        out.apply({e: df.where(F.col("slice") == n if n < 2 else F.col("slice") != 0).drop("slice") for e, df in landed.items()})
    jobs = out.jobs(bridged(spark, sf_dir)["policy_areas"])
    columns = ["job_key", "final_queue_key", "entity_key", "job_status", "action_count", "decision_count", "distinct_actor_count", "final_reviewer_email", "final_policy_group_name"]
    # written, so that a snapshot of many columns is compiled as a step is
    return sources.write_table(jobs.select(*columns, without_zone(F.col("closed_at")).alias("closed_at")), workspace(spark, "snapshot"))


def refreshed_queues(spark, sf_dir):
    """A dimension after two slices, from states that merge."""
    from modlake.plans.refresh import Refreshed

    out = Refreshed(spark, workspace(spark, "refresh"), buckets=8, tables=("dim_queue",))
    landed = _slices(spark, sf_dir, 2)
    for n in range(2):
        out.apply({e: df.where(F.col("slice") == n).drop("slice") for e, df in landed.items()})
    queues = out.dimension("dim_queue")
    return queues.select("queue_key", "queue_slug", "queue_is_multi_review", "queue_name", *[without_zone(F.col(c)).alias(c) for c in ("first_seen_at", "last_seen_at")], "observation_count", "observed_event_type_count")


QUERIES = {
    f.__name__: f
    for f in (
        a01_unique, a02_unique_combination, a03_not_null, a04_accepted_values, a05_relationships, a06_accepted_range, a07_closures_without_decisions, a08_allocation_agrees,
        a09_decisions_before_creation, a10_plausible_times, a11_no_future_times, a12_actions_reconcile, a13_no_orphan_decisions, a14_freshness, a15_continuous_metrics, a16_stalled,
        a17_score_gate, mask_text, mask_bag, masked_reviewers, masked_by_lineage, withheld_payloads, touched_dates, layout_pruning, layout_profile, merge_probe, incremental_slice, late_rows, incremental_upsert, query_cost_rollup, narrowed_percentiles, pruned_weeks, stream_dedup,
        upsert_write, moved_keys, source_modes, seed_and_raw_rows, policy_area_file, volume_stream, projected_events, eval_questions, lazy_view, full_refresh, stored_failures, column_tests, broken_column_tests, tag_audit,
        layout_of_files, pruning_of_files, probe_of_files, row_groups_of_files, summaries_of_files, footer_slice, stream_lateness, stream_counts, refreshed_jobs, refreshed_queues,
    )
}

_TARGET = """WITH e AS (SELECT event_id, ts AS event_ts, value FROM events), t AS (SELECT * FROM e WHERE event_ts < (SELECT max(event_ts) FROM e) - INTERVAL 7 DAY AND event_id % 10 <> 3),
    w AS (SELECT max(event_ts) - INTERVAL 3 HOUR AS since FROM t)"""
_K = "CAST(json_extract(props, '$.k') AS BIGINT)"
_CATEGORIES = ", ".join(f"'{c}'" for c in checks.JOB_CATEGORIES)
_FILES = """WITH g AS (SELECT 'sorted' AS layout, ts::DATE::VARCHAR AS g, ts FROM events UNION ALL SELECT 'mixed', (event_id % 8)::VARCHAR, ts FROM events),
    f AS (SELECT layout, g, min(ts) AS low, max(ts) AS high, count(*)::BIGINT AS n_rows FROM g GROUP BY 1, 2),
    o AS (SELECT f.*, (SELECT count(*) FROM f x WHERE x.layout = f.layout AND x.g <> f.g AND x.low <= f.high AND x.high >= f.low)::BIGINT AS n_over FROM f)"""
_JOB = "CAST(substr(job_id, 5) AS BIGINT)"
_ALL_TIMES = "(SELECT actioned_at AS t FROM a UNION ALL SELECT closed_at FROM c UNION ALL SELECT decided_at FROM d)"
#: Rows that fail a test, where there are any: over the tables as they are, and over those broken on purpose.
_SOUND = {
    "stg_job_actions.accepted_job_category": f"SELECT count(*) FROM a WHERE category NOT IN ({_CATEGORIES})",
    "stg_job_closures.accepted_job_category": f"SELECT count(*) FROM c WHERE category NOT IN ({_CATEGORIES})",
    "stg_decisions.implausibly_old": f"SELECT count(*) FROM {_ALL_TIMES} WHERE t < TIMESTAMP '2020-01-01'",
    "stg_decisions.in_the_future": f"SELECT count(*) FROM {_ALL_TIMES} WHERE t > TIMESTAMP '1998-06-02'",
}
_BROKEN = {
    "stg_job_actions.accepted_action": f"SELECT count(*) FROM a WHERE {_JOB} % 13 = 0",
    "stg_job_actions.range_delivery_count": f"SELECT count(*) FROM a WHERE {_JOB} % 31 = 0",
    "fct_decisions.not_null_decided_at": "SELECT sum(CASE WHEN k % 17 = 0 THEN 2 ELSE 1 END) FROM d WHERE k % 23 = 0",
    "fct_decisions.relationships_queue_key": "SELECT sum(CASE WHEN k % 17 = 0 THEN 2 ELSE 1 END) FROM d WHERE k % 11 = 0",
    "fct_decisions.unique_decision_sk": "SELECT count(*) FROM d WHERE k % 17 = 0",
    "fct_decision_policies.allocation": "SELECT count(*) FROM (SELECT 1 FROM d WHERE k % 17 = 0 AND n_pol > 0 LIMIT 1)",
    "fct_jobs.range_queue_change_count": f"SELECT count(*) FROM (SELECT job_id FROM a UNION SELECT job_id FROM c) WHERE {_JOB} % 19 = 0",
    "fct_jobs.relationships_entity_key": f"SELECT count(*) FROM (SELECT job_id FROM a UNION SELECT job_id FROM c) WHERE {_JOB} % 29 = 0",
    "dim_queue.not_null_queue_key": "SELECT count(*) FROM dq WHERE queue_slug = '2-high'",
    "dim_queue.unique_queue_slug": "SELECT count(*) FROM dq WHERE queue_slug = '2-high'",
}


def _counts(found: dict[str, str]) -> str:
    tests = ", ".join(f"('{t.table}', '{t.kind}', '{t.severity}')" for name in [*checks.COLUMNS, *(t for t in checks.WHOLE if t not in checks.COLUMNS)] for t in checks.tests_of(name))
    cases = " ".join(f"WHEN '{test}' THEN ({sql})" for test, sql in found.items())
    return f"SELECT t.*, coalesce(CASE table_name || '.' || test {cases} END, 0)::BIGINT AS n_failing FROM (VALUES {tests}) t(table_name, test, severity)"


_AGE = "epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(date_trunc('second', max(ts)))"
ORACLES = {
    "a01_unique": "SELECT user_id, count(*)::BIGINT AS n_rows FROM events WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "a02_unique_combination": "SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "a03_not_null": "SELECT event_id, event_type FROM events WHERE event_id % 17 = 0",
    "a04_accepted_values": "SELECT event_type, count(*)::BIGINT AS n_rows FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1",
    "a05_relationships": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 7 <> 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)",
    "a06_accepted_range": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 3 OR l_quantity > 48",
    "a07_closures_without_decisions": "SELECT 'job-' || o_orderkey AS job_id, o_orderdate AS closed_at FROM orders WHERE o_orderstatus <> 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "a08_allocation_agrees": FLAT + "SELECT (SELECT count(*) FROM d WHERE n_pol > 0)::BIGINT AS decision_count, round(sum(1.0::DOUBLE / n_pol), 4) AS allocated FROM p1 WHERE pid <> 3",
    "a09_decisions_before_creation": FLAT + "SELECT job_id, (7200 - handle)::BIGINT AS seconds_before FROM d WHERE handle < 7200",
    "a10_plausible_times": FLAT + """SELECT * FROM (SELECT 'job.actioned' AS source_event, actioned_at AS event_at FROM a UNION ALL SELECT 'job.closed', closed_at FROM c UNION ALL SELECT 'decision', decided_at FROM d)
        WHERE event_at < TIMESTAMP '1996-01-01'""",
    "a11_no_future_times": FLAT + """SELECT source_event, count(*)::BIGINT AS n_rows FROM (SELECT 'job.actioned' AS source_event, actioned_at AS event_at FROM a UNION ALL SELECT 'job.closed', closed_at FROM c UNION ALL SELECT 'decision', decided_at FROM d)
        WHERE event_at > TIMESTAMP '2000-06-02' GROUP BY 1""",
    "a12_actions_reconcile": FLAT + "SELECT job_id, count(*) FILTER (WHERE action <> 'skipped')::BIGINT AS fact_count, count(*)::BIGINT AS job_count FROM a GROUP BY 1 HAVING count(*) <> count(*) FILTER (WHERE action <> 'skipped')",
    "a13_no_orphan_decisions": FLAT + "SELECT job_id, ord::BIGINT AS decision_ordinal FROM d WHERE multi",
    "a14_freshness": f"SELECT max(ts) AS last_import, round(({_AGE}) / 3600.0, 6) AS age_hours, CASE WHEN ({_AGE}) / 3600.0 > 24 THEN 'error' WHEN ({_AGE}) / 3600.0 > 6 THEN 'warn' ELSE 'pass' END AS status FROM events",
    "a15_continuous_metrics": f"""SELECT 'events' AS table_name, 'FRESHNESS' AS metric_name, ({_AGE})::DOUBLE AS value FROM events UNION ALL SELECT 'events', 'ROW_COUNT', count(*)::DOUBLE FROM events
        UNION ALL SELECT 'events', 'NULL_COUNT:user', count(*) FILTER (WHERE event_id % 17 = 0)::DOUBLE FROM events UNION ALL SELECT 'events', 'NULL_COUNT:event_type', count(*) FILTER (WHERE event_type IS NULL)::DOUBLE FROM events""",
    "a16_stalled": f"SELECT event_type AS table_name, age - h * 3600.0 AS value FROM (SELECT event_type, ({_AGE})::DOUBLE AS age FROM events GROUP BY 1) CROSS JOIN (VALUES (0), (1), (2)) v(h) WHERE age - h * 3600 > 21600",
    "a17_score_gate": """WITH s AS (SELECT event_type AS m, 'q' || (user_id % 20) AS i, event_id % 2 AS prev, event_id * CASE WHEN event_id % 2 = 0 THEN 37 ELSE 53 END % 101 / 101.0::DOUBLE AS x FROM events),
        w AS (SELECT * FROM (VALUES ('view', 0.9::DOUBLE), ('click', 0.1), ('error', 0.6)) v(m, least)), g AS (SELECT i, m, avg(x) FILTER (WHERE prev = 0) AS now, avg(x) FILTER (WHERE prev = 1) AS before FROM s GROUP BY 1, 2)
        SELECT 'below_minimum' AS reason, m AS metric_name, NULL::VARCHAR AS input, round(avg(x), 6) AS value, round(any_value(least), 6) AS wanted FROM s JOIN w USING (m) WHERE prev = 0 GROUP BY m HAVING avg(x) < any_value(least)
        UNION ALL SELECT 'regression', m, i, round(now, 6), round(before, 6) FROM g WHERE before - now > 0.2""",
    "mask_text": """WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN lower(c_name) || CASE WHEN c_custkey % 4 <> 0 THEN '@host.test' ELSE '' END END AS m FROM customer)
        SELECT c_custkey, CASE WHEN m IS NULL THEN NULL WHEN contains(m, '@') THEN '***@' || split_part(m, '@', -1) ELSE '***' END AS email, CASE WHEN m IS NOT NULL THEN '*** REDACTED ***' END AS name, sha256(m) AS identifier,
        '*** ' || length(m) || ' CHARS REDACTED ***' AS free_text, CASE WHEN m IS NOT NULL THEN '*** REDACTED ***' END AS something_else FROM s""",
    "mask_bag": "SELECT event_id, sha256('e' || event_id) AS id, NULL::VARCHAR AS secret, (user_id % 9)::BIGINT AS media_count, 'attributes withheld' AS note FROM events",
    "masked_reviewers": FLAT + "SELECT reviewer_key, '***@' || split_part(mail, '@', -1) AS reviewer_email, '*** REDACTED ***' AS reviewer_name, staffing AS staffing_model FROM dr",
    "masked_by_lineage": FLAT + """SELECT job_id AS "case", ord::BIGINT AS decision_ordinal, CASE WHEN mail IS NOT NULL THEN '***@' || split_part(mail, '@', -1) END AS person,
        CASE WHEN who IS NOT NULL THEN '*** REDACTED ***' END AS loud, sha256(eid) AS about, true AS inner_withheld, handle::BIGINT AS handle_time_seconds, queue_name AS team FROM d JOIN dq USING (queue_slug)""",
    "withheld_payloads": "SELECT event_id, 'payload withheld' AS note, NULL::VARCHAR AS k FROM events WHERE props IS NOT NULL",
    "touched_dates": _TARGET + " SELECT DISTINCT event_ts::DATE AS event_date FROM e, w WHERE event_ts >= since UNION ALL SELECT NULL",
    "layout_pruning": "SELECT CASE WHEN max(o_orderdate) >= TIMESTAMP '1997-01-01' THEN 1 ELSE 0 END::BIGINT AS files_kept, 1::BIGINT AS files, CASE WHEN max(o_orderdate) >= TIMESTAMP '1997-01-01' THEN count(*) ELSE 0 END::BIGINT AS rows_kept FROM orders",
    "layout_profile": "SELECT 'lineitem.parquet' AS file, min(l_orderkey) AS low, max(l_orderkey) AS high, count(*)::BIGINT AS n_rows, 0::BIGINT AS overlaps FROM lineitem",
    "merge_probe": _TARGET + " SELECT count(*)::BIGINT AS n_rows FROM e, w WHERE event_ts >= since",
    "incremental_slice": _TARGET + " SELECT event_id, event_ts FROM e, w WHERE event_ts >= since",
    "late_rows": _TARGET + " SELECT event_id, event_ts FROM e, w WHERE event_ts < since AND event_id NOT IN (SELECT event_id FROM t)",
    "incremental_upsert": _TARGET + """ SELECT event_id, event_ts, round(value + 1, 6) AS value, 'new' AS note FROM e, w WHERE event_ts >= since
        UNION ALL SELECT event_id, event_ts, round(value, 6), NULL FROM t, w WHERE event_ts < since""",
    "query_cost_rollup": """SELECT 'model.' || event_type AS model, count(*)::BIGINT AS runs, median(event_id * 31 % 1009)::DOUBLE AS median_elapsed, max(user_id * 1000)::BIGINT AS max_bytes_scanned, max(event_id % 385)::BIGINT AS max_partitions_scanned,
        max(CASE WHEN event_id % 3 = 0 THEN event_id ELSE 0 END + event_id % 5)::BIGINT AS max_bytes_spilled FROM events WHERE event_id % 7 <> 0 AND ts >= TIMESTAMP '2024-02-01' - INTERVAL 10 DAY GROUP BY event_type""",
    "narrowed_percentiles": """SELECT l_returnflag, round(quantile_cont(l_extendedprice::DOUBLE, 0.5), 4) AS median_price, round(quantile_cont(l_extendedprice::DOUBLE, 0.9), 4) AS p90_price,
        round(quantile_cont(l_quantity::DOUBLE, 0.5) FILTER (WHERE l_linenumber > 1), 4) AS median_late FROM lineitem GROUP BY 1""",
    "pruned_weeks": "SELECT ts::DATE AS day, count(*)::BIGINT AS n_rows FROM events WHERE date_trunc('week', ts) >= TIMESTAMP '2024-01-17 05:00:00' GROUP BY 1",
    "stream_dedup": "SELECT DISTINCT md5(event_type || '|' || json(props)::VARCHAR) AS event_sk, event_type AS event FROM events",
    "upsert_write": _TARGET + """ SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_ts END AS event_ts, round(value + 1, 6) AS value, 'new' AS note FROM e, w WHERE event_ts >= since
        UNION ALL SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_ts END, round(value, 6), NULL FROM t, w WHERE event_ts < since""",
    "moved_keys": """SELECT event_id, t AS event_ts, t::DATE AS event_date, round(value + n, 6) AS value FROM (SELECT *, CASE n WHEN 2 THEN ts - INTERVAL 40 DAY WHEN 0 THEN ts ELSE CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL 5 DAY END END AS t
        FROM (SELECT *, CASE WHEN event_id % 20 = 3 THEN 2 WHEN event_id % 10 = 3 THEN 1 ELSE 0 END AS n FROM events))""",
    "source_modes": f"""WITH v AS (SELECT ts, {_K} AS k, hour(ts) < 12 AS seed FROM events WHERE event_type = 'view')
        SELECT 'seed' AS mode, 'view' AS event, count(*)::BIGINT AS n_rows, sum(k)::BIGINT AS k, max(ts) AS last FROM v WHERE seed UNION ALL SELECT 'raw', 'view', count(*), sum(k)::BIGINT, max(ts) FROM v
        UNION ALL SELECT 'union', 'view', count(*), sum(k)::BIGINT, max(ts) FROM (SELECT * FROM v UNION ALL SELECT * FROM v WHERE seed) UNION ALL SELECT 'raw', 'click', 0, NULL, NULL UNION ALL SELECT 'union', 'signup', 0, NULL, NULL""",
    "seed_and_raw_rows": f"""SELECT 'raw' AS record_source, event_type AS event, {_K} AS k, ts AS import_ts FROM events WHERE event_type = 'view'
        UNION ALL SELECT 'seed', event_type, {_K}, ts FROM events WHERE event_type = 'view' AND hour(ts) < 12""",
    "policy_area_file": "SELECT n_nationkey::VARCHAR AS policy_area_id, n_name AS policy_area_name FROM nation",
    "volume_stream": "SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(2 * i) AS event_ts, true AS sound FROM range((SELECT count(*) FROM events)) r(i)",
    "projected_events": """SELECT event_id, 'job-' || user_id AS job_id, ts AS event_ts, 't' || event_id AS trace_id, CASE WHEN event_id % 3 > 0 THEN user_id::VARCHAR END AS content_fingerprint,
        date_diff('minute', ts, ts + to_seconds(event_id % 5000))::BIGINT AS ingestion_lag_minutes FROM events""",
    "eval_questions": "SELECT 'q' || event_id AS question_id, event_type AS query_text, value::VARCHAR AS answer FROM events",
    "lazy_view": "SELECT c_mktsegment, count(*)::BIGINT AS n_rows FROM customer WHERE c_acctbal > 0 GROUP BY 1",
    "full_refresh": "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 = 0",
    "stored_failures": "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.05",
    "column_tests": FLAT + _counts(_SOUND),
    "broken_column_tests": FLAT + _counts({**_SOUND, **_BROKEN}),
    "tag_audit": "SELECT 'dim_entity' AS table_name, column_name, wanted, NULL::VARCHAR AS found FROM (VALUES ('entity_id', 'IDENTIFIER'), ('entity_email', 'EMAIL'), ('entity_username', 'USERNAME'), ('entity_caption', 'FREE_TEXT'), ('entity_attributes', 'BAG')) v(column_name, wanted)",
    "layout_of_files": _FILES + " SELECT layout, low, high, n_rows, n_over AS overlaps FROM o",
    "pruning_of_files": _FILES + """ SELECT layout, count(*) FILTER (WHERE high >= TIMESTAMP '2024-01-10' AND low <= TIMESTAMP '2024-01-12')::BIGINT AS files_kept, count(*)::BIGINT AS files,
        sum(CASE WHEN high >= TIMESTAMP '2024-01-10' AND low <= TIMESTAMP '2024-01-12' THEN n_rows ELSE 0 END)::BIGINT AS rows_kept, round(avg(n_over), 6) AS average_overlaps FROM o GROUP BY layout""",
    "probe_of_files": """WITH e AS (SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 HOUR) SELECT 'sorted' AS layout, count(*)::BIGINT AS n_rows FROM e GROUP BY ts::DATE
        UNION ALL SELECT 'mixed', count(*)::BIGINT FROM e GROUP BY event_id % 8""",
    "row_groups_of_files": """SELECT g::INTEGER AS row_group, min(o_orderkey) AS low, max(o_orderkey) AS high, count(*)::BIGINT AS n_rows, 0::BIGINT AS overlaps
        FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS g FROM orders) GROUP BY g""",
    "summaries_of_files": """WITH e AS (SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 HOUR)
        SELECT 'sorted' AS layout, count(*)::BIGINT AS n_rows, count(DISTINCT ts::DATE)::BIGINT AS files_with_rows, count(DISTINCT ts::DATE)::BIGINT AS files_opened, (SELECT count(DISTINCT ts::DATE) FROM events)::BIGINT AS files FROM e
        UNION ALL SELECT 'mixed', count(*)::BIGINT, count(DISTINCT event_id % 8)::BIGINT, count(DISTINCT event_id % 8)::BIGINT, (SELECT count(DISTINCT event_id % 8) FROM events)::BIGINT FROM e""",
    "footer_slice": _TARGET + " SELECT event_id, event_ts FROM e, w WHERE event_ts >= since",
    "stream_counts": """SELECT event_id, event_type AS event, ts AS first_seen_at, ts + to_hours(n) AS last_seen_at, (n + 1)::BIGINT AS delivery_count, n > 0 AS was_redelivered
        FROM (SELECT *, CASE WHEN event_id % 10 = 1 THEN 2 WHEN event_id % 5 = 1 THEN 1 ELSE 0 END AS n FROM events)""",
    "refreshed_jobs": f"SELECT job_key, final_queue_key, entity_key, job_status, action_count, decision_count, distinct_actor_count, final_reviewer_email, final_policy_group_name, closed_at FROM ({RELATIONS_SQL['fct_jobs']})",
    "refreshed_queues": RELATIONS_SQL["dim_queue"],
    "stream_lateness": """SELECT event_id, event_type AS event, ts AS import_ts FROM events WHERE event_id % 10 <> 3 OR ts > (SELECT max(ts) FROM events WHERE event_id % 10 <> 3) - INTERVAL 72 HOUR""",
}
