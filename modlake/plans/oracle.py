"""SQL over the driver tables that must give the rows of the registered queries.

It starts from flat relations, by the arithmetic that sources/bridge.py builds documents from, and never
touches a document, so it checks extraction, deduplication and unnesting independently.
"""

FLAT = """
WITH j AS (SELECT o_orderkey AS k, 'job-' || o_orderkey AS job_id, o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS created_at,
    lower(replace(o_orderpriority, ' ', '-')) AS queue_slug, starts_with(o_orderpriority, '1') AS multi,
    ['user_report', 'proactive', 'appeal', 'qa', 'bulk', 'escalation', 'qa_appeal'][o_orderkey % 7 + 1] AS category,
    lower(c_mktsegment) AS es, 'c' || o_custkey AS eid, o_orderstatus <> 'O' AS closes FROM orders JOIN customer ON o_custkey = c_custkey),
slugs AS (SELECT ['no_action', 'warn_user', 'shadow_ban', 'remove_content', 'restrict_account', 'ban_user', 'custom_freeze'] AS s),
l AS (SELECT j.*, lineitem.*, s_nationkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS ord, l_returnflag IN ('N', 'R') AS manual
    FROM lineitem JOIN j ON l_orderkey = k AND closes JOIN supplier ON l_suppkey = s_suppkey),
d0 AS (SELECT k, ord, job_id, created_at, category, queue_slug, multi, es, eid, created_at + to_seconds((ord + 1) * 3600 + l_partkey * 11 % 1800) AS decided_at, CASE l_partkey % 3 WHEN 1 THEN 19800 WHEN 2 THEN -28800 ELSE 0 END AS off, l_partkey AS part, l_linenumber AS ln,
    CASE WHEN manual THEN 'manual' ELSE ['automated', 'workflow', 'api', 'agent'][l_partkey % 4 + 1] END AS kind,
    CASE WHEN manual THEN 'Moderator ' || l_suppkey END AS who, CASE WHEN NOT manual THEN NULL WHEN l_suppkey % 2 = 0 THEN '  MOD' || l_suppkey || '@Example.com ' ELSE 'mod' || l_suppkey || '@example.com' END AS mail,
    CASE WHEN manual THEN s_nationkey % 4 END AS grp, CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE 1 + l_linenumber % 3 END AS n_pol, l_partkey % 6 = 1 AS has_notes,
    count(*) OVER (PARTITION BY k) AS on_job FROM l),
c AS (SELECT k, any_value(job_id) AS job_id, any_value(created_at) AS created_at, any_value(category) AS category, any_value(queue_slug) AS queue_slug, any_value(multi) AS multi,
    any_value(es) AS es, any_value(eid) AS eid, max(decided_at) + to_seconds(k % 7200) AS closed_at, count(*) AS n_dec FROM d0 GROUP BY k),
p AS (SELECT d0.*, kk AS pord, (part + 7 * kk) % 25 AS pid FROM d0 CROSS JOIN (VALUES (0), (1), (2)) ks(kk) WHERE kk < n_pol),
p1 AS (SELECT *, 'pol-' || pid AS policy_id, 'Policy ' || pid AS policy_name, CASE WHEN pid % 5 = 0 THEN NULL WHEN pid % 5 = 1 THEN 'pol-' || (pid - 1) ELSE 'area-' || (pid % 6) END AS parent,
    pid % 7 = 0 AS illegal, pid % 4 = 0 AS harmless FROM p),
d1 AS (SELECT d0.*, CASE WHEN n_pol = 0 OR part % 25 % 4 = 0 THEN (CASE WHEN part % 3 = 0 THEN ['no_action'] ELSE [] END)
    WHEN ln % 2 = 0 THEN [s[part % 25 % 7 + 1], 'warn_user'] ELSE [s[part % 25 % 7 + 1]] END AS acts FROM d0 CROSS JOIN slugs),
d AS (SELECT d1.*, closed_at, k % 50 = 0 AS twice, date_diff('second', d1.created_at, decided_at) AS handle, kind = 'manual' AS human,
    coalesce((SELECT bool_or(NOT harmless) FROM p1 WHERE p1.k = d1.k AND p1.ord = d1.ord), false) AS violating,
    coalesce((SELECT bool_or(illegal) FROM p1 WHERE p1.k = d1.k AND p1.ord = d1.ord), false) AS unlawful FROM d1 JOIN c USING (k)),
e AS (SELECT k, ord, decided_at, kind, generate_subscripts(acts, 1) - 1 AS aord, unnest(acts) AS slug, len(acts) AS n_acts FROM d),
a AS (SELECT event_id, job_id, created_at, category, queue_slug, multi, created_at + to_seconds(event_id) AS actioned_at, CASE event_id % 3 WHEN 1 THEN 19800 WHEN 2 THEN -28800 ELSE 0 END AS off, event_type, user_id, n,
    CASE WHEN n % 10 = 8 THEN 'skipped' WHEN n % 10 = 9 THEN 'deferred' WHEN event_type = 'view' THEN 'assigned' WHEN event_type = 'signup' THEN 'created' WHEN event_type = 'error' THEN 'escalated'
      WHEN event_type = 'click' THEN 'changed_queue' WHEN event_type = 'purchase' THEN 'cancelled' END AS action,
    CASE n % 3 WHEN 0 THEN 'manual' WHEN 1 THEN 'workflow' ELSE ['auto', 'api', 'agent'][event_id % 3 + 1] END AS source, CASE n % 3 WHEN 0 THEN 'user' WHEN 1 THEN 'workflow' ELSE 'none' END AS actor,
    CASE WHEN n % 4 <> 0 THEN es END AS es, CASE WHEN n % 4 <> 0 THEN eid END AS eid, CASE WHEN n % 3 = 0 THEN 'mod' || (user_id % 50) || '@example.com' END AS mail,
    CASE WHEN n % 3 = 0 THEN 'Moderator ' || (user_id % 50) END AS who, CASE WHEN n % 3 = 0 THEN user_id % 50 % 4 END AS grp, CASE WHEN n % 3 = 1 THEN 'wf-' || (n % 5) END AS wf,
    CASE WHEN n % 3 = 1 THEN 'user' END AS tes, CASE WHEN n % 3 = 1 THEN 'u' || user_id END AS teid, event_id % 50 = 0 AS twice
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS n FROM events) ev
    JOIN j ON j.k = event_id * 7 % greatest(1, (SELECT count(*) FROM orders) // 5)),
qf AS (SELECT queue_slug, multi, actioned_at AS t, 1 AS ev FROM a UNION ALL SELECT queue_slug, multi, closed_at, 2 FROM c UNION ALL SELECT queue_slug, multi, decided_at, 3 FROM d),
dq AS (SELECT md5(queue_slug) AS queue_key, queue_slug, arg_max(multi, t) AS queue_is_multi_review,
    array_to_string([upper(x[1]) || lower(x[2:]) for x in string_split(replace(queue_slug, '-', ' '), ' ')], ' ') AS queue_name,
    min(t) AS first_seen_at, max(t) AS last_seen_at, count(*) AS observation_count, count(DISTINCT ev) AS observed_event_type_count FROM qf GROUP BY queue_slug),
ar AS (SELECT 'area-' || i AS id, 'Area ' || i AS name FROM range(4) r(i)),
dp0 AS (SELECT policy_id, any_value(policy_name) AS policy_name, any_value(parent) AS parent, any_value(illegal) AS illegal, any_value(harmless) AS harmless, any_value(pid) AS pid,
    count(*) AS n, min(decided_at) AS t0, max(decided_at) AS t1 FROM p1 GROUP BY policy_id),
dp AS (SELECT md5(x.policy_id) AS policy_key, x.*, coalesce(o.policy_name, ar.name) AS parent_name, o.policy_id IS NOT NULL AS seen FROM dp0 x LEFT JOIN dp0 o ON x.parent = o.policy_id LEFT JOIN ar ON x.parent = ar.id),
dpn AS (SELECT *, coalesce(parent_name, policy_name) AS grp_name, CASE WHEN harmless THEN 'non_violating' WHEN illegal THEN 'illegal' ELSE 'violating' END AS severity FROM dp),
gl AS (SELECT * FROM (VALUES (0, 'Acme BPO Moderator - Spam, QA', 'Acme', 'Spam', true, false), (1, 'Escalation Team', NULL, NULL, false, true), (2, 'Globex BPO Moderator - Safety', 'Globex', 'Safety', false, false), (3, '', NULL, NULL, false, false)) g(grp, label, vendor, special, qa, esc)),
rf AS (SELECT lower(trim(mail)) AS mail, who, grp, decided_at AS t, 1 AS ev FROM d WHERE mail IS NOT NULL UNION ALL SELECT lower(trim(mail)), who, grp, actioned_at, 2 FROM a WHERE mail IS NOT NULL),
dr0 AS (SELECT mail, min(t) AS t0, max(t) AS t1, count(*) AS n, count(DISTINCT ev) AS n_ev, count(*) FILTER (WHERE ev = 1) AS n1, count(*) FILTER (WHERE ev = 2) AS n2,
    arg_max(who, t) AS who, arg_max(grp, (t, [(SELECT label FROM gl WHERE gl.grp = rf.grp)])) AS grp FROM rf GROUP BY mail),
dr AS (SELECT md5(mail) AS reviewer_key, dr0.*, label, vendor, special, qa, esc, coalesce(vendor, 'In-house') AS staffing FROM dr0 JOIN gl USING (grp)),
ef AS (SELECT es, eid, decided_at AS t, false AS trig, false AS bag FROM d UNION ALL SELECT es, eid, actioned_at, false, true FROM a WHERE eid IS NOT NULL
    UNION ALL SELECT es, eid, closed_at, false, true FROM c UNION ALL SELECT tes, teid, actioned_at, true, false FROM a WHERE teid IS NOT NULL),
de AS (SELECT md5(es || '-' || eid) AS entity_key, es, eid, min(t) AS t0, max(t) AS t1, count(*) AS n, bool_or(NOT trig) AS reviewed, bool_or(trig) AS triggers, bool_or(bag) AS bag FROM ef GROUP BY es, eid),
dw AS (SELECT md5(wf) AS workflow_key, wf, count(*) AS n, count(DISTINCT n % 10) AS n_rules, count(DISTINCT event_type) AS n_names, min(actioned_at) AS t0, max(actioned_at) AS t1,
    arg_max(n % 10, (actioned_at, 'rule-' || (n % 10))) AS rule FROM a WHERE wf IS NOT NULL GROUP BY wf),
lad AS (SELECT * FROM (VALUES ('no_action', 0, 'none'), ('warn_user', 1, 'advisory'), ('shadow_ban', 2, 'visibility'), ('remove_content', 3, 'content'), ('restrict_account', 4, 'account'), ('ban_user', 5, 'account')) v(slug, rank, cat)),
da AS (SELECT md5(e.slug) AS key, e.slug, coalesce(any_value(rank), 0) AS rank, coalesce(any_value(cat), 'unclassified') AS cat, any_value(rank) IS NOT NULL AS known,
    count(*) AS n, count(*) FILTER (WHERE kind <> 'manual') AS n_auto, min(decided_at) AS t0, max(decided_at) AS t1 FROM e LEFT JOIN lad USING (slug) GROUP BY e.slug),
es1 AS (SELECT k, ord, count(*) FILTER (WHERE e.slug <> 'no_action') AS acted, count(*) FILTER (WHERE e.slug = 'no_action') AS idle, max(rank) AS top, coalesce(bool_or(rank = 5), false) AS ban FROM e JOIN da USING (slug) GROUP BY k, ord),
ps1 AS (SELECT k, ord, count(*) AS n_p, count(*) FILTER (WHERE p1.illegal) AS n_i, count(*) FILTER (WHERE p1.harmless) AS n_h, count(DISTINCT coalesce(p1.parent, p1.policy_id)) AS n_g,
    max(CASE WHEN pord = 0 THEN grp_name END) AS main_group, max(CASE WHEN pord = 0 THEN p1.policy_name END) AS main_policy FROM p1 JOIN dpn USING (policy_id) GROUP BY k, ord),
fd AS (SELECT d.*, queue_key, reviewer_key, entity_key, queue_name, coalesce(staffing, 'Automated') AS staffing, dr.mail AS rmail, dr.who AS rwho, coalesce(acted, 0) AS acted, coalesce(idle, 0) AS idle, top, coalesce(ban, false) AS ban, coalesce(n_p, 0) AS n_p, coalesce(n_i, 0) AS n_i,
    coalesce(n_h, 0) AS n_h, coalesce(n_g, 0) AS n_g, main_group, main_policy, coalesce(n_p, 0) > 0 AND coalesce(n_h, 0) = coalesce(n_p, 0) AS cleared
    FROM d JOIN dq USING (queue_slug) LEFT JOIN dr ON lower(trim(d.mail)) = dr.mail LEFT JOIN de ON d.es = de.es AND d.eid = de.eid LEFT JOIN es1 USING (k, ord) LEFT JOIN ps1 USING (k, ord)),
fa AS (SELECT a.*, queue_key, queue_name, reviewer_key, workflow_key, de.entity_key, te.entity_key AS trigger_key, dr.mail AS rmail, date_diff('second', created_at, actioned_at) AS age FROM a JOIN dq USING (queue_slug)
    LEFT JOIN dr ON a.mail = dr.mail LEFT JOIN dw USING (wf) LEFT JOIN de ON a.es = de.es AND a.eid = de.eid LEFT JOIN de te ON tes = te.es AND teid = te.eid),
ja AS (SELECT job_id, count(*) AS n, count(*) FILTER (WHERE action = 'changed_queue') AS n_queue, count(*) FILTER (WHERE action = 'escalated') AS n_esc, count(*) FILTER (WHERE action = 'cancelled') AS n_can,
    count(*) FILTER (WHERE action = 'cancelled' AND source = 'workflow') AS n_wcan, count(*) FILTER (WHERE action = 'skipped') AS n_skip, count(*) FILTER (WHERE action = 'deferred') AS n_defer,
    count(*) FILTER (WHERE action = 'assigned') AS n_assign, count(*) FILTER (WHERE actor = 'workflow') AS n_wf, count(*) FILTER (WHERE actor = 'user') AS n_user, count(*) FILTER (WHERE actor = 'none') AS n_sys,
    count(DISTINCT mail) AS n_actors, count(DISTINCT queue_slug) AS n_queues, min(actioned_at) AS t0, max(actioned_at) AS t1, min(created_at) AS created, max(event_id % 11) AS reports, max(event_id % 5) AS prio,
    arg_max(queue_slug, actioned_at) AS queue_slug, arg_max(CASE WHEN action = 'cancelled' THEN 'cancelled' ELSE 'open' END, actioned_at) AS status, arg_max(category, actioned_at) AS category,
    arg_max(action, actioned_at) AS action, max_by({'es': es, 'eid': eid}, actioned_at) AS ent FROM a GROUP BY job_id),
jd AS (SELECT job_id, count(*) AS n, count(*) FILTER (WHERE NOT human) AS n_auto, count(*) FILTER (WHERE human) AS n_human, count(DISTINCT mail) AS n_rev, sum(acted) AS n_act, max(top) AS top,
    count(*) FILTER (WHERE violating) AS n_viol, count(*) FILTER (WHERE unlawful) AS n_ill, count(*) FILTER (WHERE cleared) AS n_clear, min(decided_at) AS t0, max(decided_at) AS t1, max(handle) AS handle,
    max(CASE WHEN ord = on_job - 1 THEN mail END) AS mail, max(CASE WHEN ord = on_job - 1 THEN kind END) AS kind, max(CASE WHEN ord = on_job - 1 THEN main_group END) AS grp, bool_or(ord = on_job - 1 AND NOT human) AS auto_closed FROM fd GROUP BY job_id),
fj AS (SELECT coalesce(ja.job_id, c.job_id) AS job_id, coalesce(c.created_at, ja.created) AS created_at, c.closed_at, c.k IS NOT NULL AS closed, ja.job_id IS NOT NULL AS acted, coalesce(c.queue_slug, ja.queue_slug) AS qs, ja.queue_slug AS cur,
    coalesce(c.es, ja.ent.es) AS es, coalesce(c.eid, ja.ent.eid) AS eid, coalesce(c.category, ja.category) AS category, c.multi, ja.action, CASE WHEN c.k IS NOT NULL THEN 'closed' ELSE coalesce(status, 'unknown') END AS status,
    ja.n AS a_n, n_queue, n_esc, n_can, n_wcan, n_skip, n_defer, n_assign, n_wf, n_user, n_sys, n_actors, n_queues, ja.t0 AS a0, ja.t1 AS a1, reports, prio, jd.n AS d_n, n_auto, n_human, n_rev, n_act, top, n_viol, n_ill, n_clear,
    jd.t0 AS d0, jd.t1 AS d1, handle, jd.mail, jd.kind, jd.grp, coalesce(auto_closed, false) AS auto_closed
    FROM ja FULL JOIN c ON ja.job_id = c.job_id LEFT JOIN jd ON jd.job_id = coalesce(ja.job_id, c.job_id)),
fk AS (SELECT fj.*, queue_key, queue_name, entity_key, reviewer_key FROM fj LEFT JOIN dq ON qs = dq.queue_slug LEFT JOIN de ON fj.es = de.es AND fj.eid = de.eid LEFT JOIN dr ON lower(trim(fj.mail)) = dr.mail)
"""


def _int(*names: str) -> str:
    return ", ".join(f"{a}::BIGINT AS {b}" for a, b in (n.split(":") for n in names))


_SEEN = "t0 AS first_seen_at, t1 AS last_seen_at"
SQL = {
    "d3_dedup": """WITH e AS (SELECT md5(event_type || '|' || json(props)::VARCHAR) AS event_sk, event_type AS event, ts FROM events)
        SELECT event_sk, event, min(ts) AS first_seen_at, max(ts) AS last_seen_at, count(*)::BIGINT AS delivery_count, count(*) > 1 AS was_redelivered, 'raw' AS record_source FROM e GROUP BY event_sk, event""",
    "t1_job_actions": FLAT + """SELECT job_id, action, source AS action_source, actor AS actor_type, actioned_at, actioned_at + to_seconds(off) AS actioned_local, off::BIGINT AS actioned_utc_offset_seconds, created_at AS job_created_at, event_id::BIGINT AS job_age_at_action_seconds,
        CASE WHEN action = 'cancelled' THEN 'cancelled' ELSE 'open' END AS job_status_after, category AS job_category, (event_id % 5)::BIGINT AS job_priority, (event_id % 11)::BIGINT AS job_num_reports, queue_slug, multi AS queue_is_multi_review,
        es AS entity_schema, eid AS entity_id, eid IS NOT NULL AS has_entity, who AS actor_user_name, mail AS actor_user_email, wf AS actor_workflow_id, CASE WHEN wf IS NOT NULL THEN 'on_' || event_type END AS actor_workflow_event_name,
        CASE WHEN wf IS NOT NULL THEN 'rule-' || (n % 10) END AS actor_workflow_rule_id, tes AS trigger_entity_schema, teid AS trigger_entity_id, event_id % 6 = 1 AS has_notes, action = 'escalated' AS is_escalation, action = 'cancelled' AS is_cancellation,
        actioned_at + to_seconds(60) AS first_seen_at, CASE WHEN twice THEN 2 ELSE 1 END::BIGINT AS delivery_count, twice AS was_redelivered, CASE WHEN twice THEN 'raw' ELSE 'seed' END AS record_source FROM a""",
    "t2_job_closures": FLAT + """SELECT job_id, closed_at, created_at AS job_created_at, category AS job_category, queue_slug, multi AS queue_is_multi_review, es AS entity_schema, eid AS entity_id, n_dec::BIGINT AS closure_decision_count,
        date_diff('second', created_at, closed_at)::BIGINT AS time_to_close_seconds, CASE WHEN k % 50 = 0 THEN 2 ELSE 1 END::BIGINT AS delivery_count FROM c""",
    "t3_decisions": FLAT + """SELECT job_id, ord::BIGINT AS decision_ordinal, decided_at, decided_at + to_seconds(off) AS decided_local, off::BIGINT AS decided_utc_offset_seconds, closed_at, handle::BIGINT AS handle_time_seconds, kind AS decision_source_type, human AS is_human_decision, NOT human AS is_automated, who AS reviewer_name,
        mail AS reviewer_email, es AS entity_schema, eid AS entity_id, n_pol::BIGINT AS policy_count, len(acts)::BIGINT AS enforcement_action_count, has_notes, violating AS is_violating_outcome, unlawful AS is_illegal_outcome,
        on_job::BIGINT AS decisions_on_job, ord = on_job - 1 AS is_final_decision, twice AS was_redelivered FROM d""",
    "t4_decision_policies": FLAT + """SELECT job_id, ord::BIGINT AS decision_ordinal, pord::BIGINT AS policy_ordinal, policy_id, policy_name, parent AS policy_parent_id, parent IS NULL AS is_root_policy, illegal AS policy_is_illegal,
        harmless AS policy_is_non_violating, CASE WHEN harmless THEN 0 ELSE 1 END::BIGINT AS policy_enforcement_action_count, pord = 0 AS is_primary_policy, n_pol::BIGINT AS policies_on_decision, round(1.0::DOUBLE / n_pol, 6) AS decision_count_allocated FROM p1""",
    "t5_decision_enforcement_actions": FLAT + """SELECT 'job-' || k AS job_id, ord::BIGINT AS decision_ordinal, aord::BIGINT AS action_ordinal, slug AS enforcement_action_slug, n_acts::BIGINT AS actions_on_decision, slug = 'no_action' AS is_no_action FROM e""",
    "dim_queue": FLAT + "SELECT queue_key, queue_slug, queue_is_multi_review, queue_name, first_seen_at, last_seen_at, observation_count::BIGINT AS observation_count, observed_event_type_count::BIGINT AS observed_event_type_count FROM dq",
    "dim_policy": FLAT + f"""SELECT policy_key, policy_id, policy_name, parent AS policy_parent_id, parent_name AS policy_parent_name, parent IS NULL AS is_root_policy, parent IS NOT NULL AND parent_name IS NOT NULL AS policy_parent_name_resolved,
        CASE WHEN parent IS NULL THEN 'root_policy' WHEN parent_name IS NULL THEN 'unresolved' WHEN seen THEN 'observed_policy' ELSE 'policy_area_seed' END AS policy_parent_name_source, grp_name AS policy_group_name,
        illegal AS policy_is_illegal, harmless AS policy_is_non_violating, severity AS policy_severity_class, CASE WHEN harmless THEN 0 ELSE 1 END::BIGINT AS policy_action_count, n::BIGINT AS application_count, {_SEEN} FROM dpn""",
    "dim_reviewer": FLAT + f"""SELECT reviewer_key, mail AS reviewer_email, who AS reviewer_name, label AS reviewer_groups_label, vendor AS vendor_name, special AS vendor_specialism, vendor IS NOT NULL AS is_outsourced, staffing AS staffing_model,
        false AS is_admin, qa AS is_qa, esc AS is_escalation_team, {_int("n:observation_count", "n1:decision_observation_count", "n2:action_observation_count", "n_ev:observed_event_type_count")}, {_SEEN} FROM dr""",
    "dim_entity": FLAT + f"""SELECT entity_key, es AS entity_schema, eid AS entity_id, CASE WHEN bag AND es <> 'building' THEN 'https://host.test/' || eid END AS entity_object_url, CASE WHEN bag AND es = 'building' THEN 'name-' || eid END AS entity_username,
        CASE WHEN bag AND es = 'building' THEN eid || '@mail.test' END AS entity_email, CASE WHEN bag AND es = 'machinery' THEN 'About ' || eid END AS entity_caption, bag AS has_attributes, reviewed AS was_reviewed, triggers AS triggered_a_workflow,
        n::BIGINT AS observation_count, {_SEEN} FROM de""",
    "dim_workflow": FLAT + f"""SELECT workflow_key, wf AS workflow_id, 'Flow ' || substr(wf, 4) AS workflow_name, 'rule-' || rule AS workflow_rule_id, 'Rule ' || rule AS workflow_rule_name, 'event' AS workflow_trigger_type,
        {_int("n:action_count", "n_rules:distinct_rule_count", "n_names:distinct_event_name_count")}, {_SEEN} FROM dw""",
    "dim_enforcement_action": FLAT + f"""SELECT key AS enforcement_action_key, slug AS enforcement_action_slug, array_to_string([upper(x[1]) || lower(x[2:]) for x in string_split(slug, '_')], ' ') AS enforcement_action_name,
        rank::BIGINT AS enforcement_severity_rank, cat AS enforcement_category, known AS is_recognised_action, slug = 'no_action' AS is_no_action, {_int("n:application_count", "n_auto:automated_application_count")},
        (n - n_auto)::BIGINT AS human_application_count, {_SEEN} FROM da""",
    "fct_decisions": FLAT + f"""SELECT job_id, ord::BIGINT AS decision_ordinal, queue_key, reviewer_key, entity_key, decided_at, (decided_at + to_seconds(off))::DATE AS decided_date, date_trunc('week', (decided_at + to_seconds(off)))::DATE AS decided_week, date_trunc('month', (decided_at + to_seconds(off)))::DATE AS decided_month,
        left(dayname((decided_at + to_seconds(off))), 3) AS decided_day_of_week, hour((decided_at + to_seconds(off)))::BIGINT AS decided_hour_of_day, staffing AS staffing_model, main_policy AS primary_policy_name, main_group AS primary_policy_group_name, {_int("handle:handle_time_seconds", "n_p:policy_count", "n_i:illegal_policy_count", "n_h:non_violating_policy_count", "n_g:distinct_policy_group_count", "acted:enforcement_action_count", "idle:no_action_count", "top:max_enforcement_severity_rank")},
        round(handle / 3600.0::DOUBLE, 6) AS handle_time_hours, ban AS included_account_ban, cleared AS is_cleared_outcome, multi AND on_job > 1 AS is_multi_review_decision, has_notes FROM fd""",
    "fct_decision_policies": FLAT + """SELECT p1.job_id, p1.ord::BIGINT AS decision_ordinal, p1.pord::BIGINT AS policy_ordinal, policy_key, fd.queue_key, fd.reviewer_key, fd.entity_key, (p1.decided_at + to_seconds(p1.off))::DATE AS decided_date, policy_id, dpn.parent_name AS policy_parent_name,
        grp_name AS policy_group_name, severity AS policy_severity_class, 1::BIGINT AS policy_application_count, round(1.0::DOUBLE / p1.n_pol, 6) AS decision_count_allocated, round(handle / 3600.0::DOUBLE, 6) AS handle_time_hours FROM p1 JOIN fd USING (k, ord) JOIN dpn USING (policy_id)""",
    "fct_job_actions": FLAT + """SELECT job_id, actioned_at, queue_key, reviewer_key, workflow_key, entity_key, trigger_key AS trigger_entity_key, (actioned_at + to_seconds(off))::DATE AS actioned_date, date_trunc('month', (actioned_at + to_seconds(off)))::DATE AS actioned_month, left(dayname((actioned_at + to_seconds(off))), 3) AS actioned_day_of_week,
        hour((actioned_at + to_seconds(off)))::BIGINT AS actioned_hour_of_day, action, actor AS actor_type, age::BIGINT AS job_age_at_action_seconds, round(age / 3600.0::DOUBLE, 6) AS job_age_at_action_hours, actor = 'workflow' AS is_automated,
        teid IS NOT NULL AND teid IS DISTINCT FROM eid AS acted_on_other_entity, (event_id % 11)::BIGINT AS reports_on_job_at_action FROM fa""",
    "fct_jobs": FLAT + f"""SELECT md5(job_id) AS job_key, job_id, queue_key AS final_queue_key, entity_key, reviewer_key AS final_reviewer_key, created_at AS job_created_at, created_at::DATE AS created_date, closed_at, closed_at::DATE AS closed_date, date_trunc('week', closed_at)::DATE AS closed_week,
        date_trunc('month', closed_at)::DATE AS closed_month, left(dayname(closed_at), 3) AS closed_day_of_week, a0 AS first_actioned_at, a1 AS last_actioned_at, d0 AS first_decided_at, d1 AS last_decided_at, category AS job_category, qs AS final_queue_slug, cur AS current_queue_slug,
        multi AS queue_is_multi_review, es AS entity_schema, eid AS entity_id, action AS latest_action, mail AS final_reviewer_email, kind AS final_decision_source_type, grp AS final_policy_group_name, status AS job_status,
        {", ".join(f"coalesce({x}, 0)::BIGINT AS {y}" for x, y in (("a_n", "action_count"), ("n_queue", "queue_change_count"), ("n_esc", "escalation_count"), ("n_can", "cancellation_count"), ("n_wcan", "workflow_cancellation_count"), ("n_skip", "skip_count"), ("n_defer", "defer_count"), ("n_assign", "assignment_count"), ("n_wf", "workflow_action_count"), ("n_user", "human_action_count"), ("n_sys", "system_action_count"), ("d_n", "decision_count"), ("n_auto", "automated_decision_count"), ("n_human", "human_decision_count"), ("n_act", "enforcement_action_count"), ("n_viol", "violating_decision_count"), ("n_ill", "illegal_decision_count"), ("n_clear", "cleared_decision_count")))},
        {_int("n_actors:distinct_actor_count", "n_queues:distinct_queue_count", "reports:max_reports_on_job", "prio:max_priority", "n_rev:distinct_reviewer_count", "top:max_enforcement_severity_rank")},
        closed AS is_closed, auto_closed AS closed_by_automated_decision, acted AS has_action_history, coalesce(n_esc, 0) > 0 AS was_escalated, coalesce(n_wcan, 0) > 0 AS was_cancelled_by_workflow, coalesce(n_viol, 0) > 0 AS had_violating_outcome FROM fk""",
    "f4_durations": FLAT + """SELECT job_id, date_diff('second', created_at, closed_at)::BIGINT AS time_to_close_seconds, date_diff('second', created_at, a0)::BIGINT AS time_to_first_action_seconds, handle::BIGINT AS handle_time_seconds,
        date_diff('second', d1, closed_at)::BIGINT AS decision_to_close_seconds, CASE WHEN closed_at IS NULL THEN date_diff('second', created_at, a1) END::BIGINT AS open_age_at_last_action_secs FROM fk""",
}

_H = "round(median(handle / 3600.0::DOUBLE), 6) AS median_handle_time_hours, count(*)::BIGINT AS total_decisions"
QUESTION_SQL = {
    "v01_closed_jobs_per_day": "SELECT closed_at::DATE AS job_closed_date, count(*) FILTER (WHERE closed)::BIGINT AS closed_jobs FROM fk GROUP BY 1",
    "v02_top_moderators_by_activity": "SELECT rmail AS moderator_email, count(*)::BIGINT AS total_job_actions FROM fa GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 20",
    "v03_active_moderators_per_day": "SELECT (actioned_at + to_seconds(off))::DATE AS action_date, count(DISTINCT mail)::BIGINT AS active_moderators_by_activity FROM fa GROUP BY 1",
    "v04_policy_distribution": "SELECT grp_name AS policy_area, count(*)::BIGINT AS policy_applications FROM p1 JOIN dpn USING (policy_id) GROUP BY 1",
    "v05_escalations_and_queue_changes_per_day": "SELECT (actioned_at + to_seconds(off))::DATE AS action_date, action AS action_type, count(*)::BIGINT AS total_job_actions FROM fa WHERE action IN ('escalated', 'changed_queue') GROUP BY 1, 2",
    "v06_jobs_cancelled_by_workflow": "SELECT count(*) FILTER (WHERE n_wcan > 0)::BIGINT AS jobs_cancelled_by_workflow FROM fk",
    "v07_median_age_of_actioned_jobs": "SELECT action AS action_type, round(median(age / 3600.0::DOUBLE), 6) AS median_job_age_at_action_hours FROM fa GROUP BY 1",
    "v08_handle_time_by_queue": f"SELECT queue_name, {_H} FROM fd GROUP BY 1",
    "v09_handle_time_tail_by_queue": f"SELECT queue_name, round(quantile_cont(handle / 3600.0::DOUBLE, 0.9), 6) AS p90_handle_time_hours, {_H} FROM fd GROUP BY 1",
    "v10_handle_time_by_moderator": f"SELECT rwho AS moderator_name, {_H} FROM fd GROUP BY 1",
    "v11_handle_time_by_entity_type": f"SELECT es AS entity_type, {_H} FROM fd GROUP BY 1",
    "v12_median_time_to_close_by_queue": "SELECT queue_name, round(median(date_diff('second', created_at, closed_at) / 3600.0::DOUBLE), 6) AS median_time_to_close_hours, count(*) FILTER (WHERE closed)::BIGINT AS closed_jobs FROM fk GROUP BY 1",
    "v13_automated_closure_share": "SELECT round(count(*) FILTER (WHERE auto_closed)::DOUBLE / nullif(count(*) FILTER (WHERE closed), 0), 6) AS automated_closure_rate, count(*) FILTER (WHERE closed)::BIGINT AS closed_jobs, count(*) FILTER (WHERE auto_closed)::BIGINT AS jobs_closed_by_automation FROM fk",
    "v14_queue_changes_before_closure": "SELECT closed AS job_is_closed, round(avg(coalesce(n_queue, 0)), 6) AS avg_queue_changes_per_job, sum(coalesce(n_queue, 0))::BIGINT AS total_queue_changes, count(*)::BIGINT AS total_jobs FROM fk GROUP BY 1",
    "v15_moderator_best_queue_by_handle_time": f"SELECT rwho AS moderator_name, queue_name, {_H} FROM fd GROUP BY 1, 2",
    "v16_handle_time_by_staffing_model": f"SELECT staffing AS decision_staffing_model, {_H} FROM fd GROUP BY 1",
    "metric_rates": """SELECT d.queue_name, round(n_auto::DOUBLE / nullif(n, 0), 6) AS automation_rate, round(n_clear::DOUBLE / nullif(n, 0), 6) AS clearance_rate, round(n_viol::DOUBLE / nullif(n, 0), 6) AS violation_rate, round(n::DOUBLE / nullif(n_rev, 0), 6) AS decisions_per_moderator,
        round(j_auto::DOUBLE / nullif(j_closed, 0), 6) AS automated_closure_rate, round(j_esc::DOUBLE / nullif(j_n, 0), 6) AS escalation_rate
        FROM (SELECT queue_name, count(*) AS n, count(*) FILTER (WHERE NOT human) AS n_auto, count(*) FILTER (WHERE cleared) AS n_clear, count(*) FILTER (WHERE violating) AS n_viol, count(DISTINCT mail) AS n_rev FROM fd GROUP BY 1) d
        FULL JOIN (SELECT queue_name, count(*) AS j_n, count(*) FILTER (WHERE closed) AS j_closed, count(*) FILTER (WHERE auto_closed) AS j_auto, count(*) FILTER (WHERE n_esc > 0) AS j_esc FROM fk GROUP BY 1) j ON d.queue_name IS NOT DISTINCT FROM j.queue_name""",
    "metric_multi_fact": """SELECT coalesce(d.queue_name, a.queue_name, j.queue_name) AS queue_name, total_decisions, total_job_actions, total_jobs, total_enforcement_actions, open_jobs FROM
        (SELECT queue_name, count(*)::BIGINT AS total_decisions, sum(acted)::BIGINT AS total_enforcement_actions FROM fd GROUP BY 1) d FULL JOIN (SELECT queue_name, count(*)::BIGINT AS total_job_actions FROM fa GROUP BY 1) a ON d.queue_name = a.queue_name
        FULL JOIN (SELECT queue_name, count(*)::BIGINT AS total_jobs, count(*) FILTER (WHERE NOT closed)::BIGINT AS open_jobs FROM fk GROUP BY 1) j ON coalesce(d.queue_name, a.queue_name) = j.queue_name""",
    "metric_policy_through_decision": "SELECT queue_name, staffing AS decision_staffing_model, count(*)::BIGINT AS policy_applications, round(sum(1.0::DOUBLE / p1.n_pol), 6) AS allocated_decisions FROM p1 JOIN fd USING (k, ord) GROUP BY 1, 2",
}
ORACLES = {**SQL, **{q: FLAT + s for q, s in QUESTION_SQL.items()}}
