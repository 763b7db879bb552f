"""Queries over assertions: assess, decide, signals, audit, review, backtest."""

from __future__ import annotations

from pyspark.sql import functions as F

from accordion.functions.numbers import exact_round_sql as _exact
from accordion.operators import audit, backtest, decide, scoring
from accordion.plans import tables as T
from accordion.plans.policy import RISK, WEIGHTS

_rows = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
_WEIGHTS = _rows([(f, c, w) for f, row in WEIGHTS.items() for c, w in row.items()])
_RISK = _rows(RISK.items())

ASSESS = f"""{T.ASSERTIONS}, {T.CURRENT},
w as (select * from (values {_WEIGHTS}) t(field, source_class, weight)),
rk as (select * from (values {_RISK}) t(field, risk_class)),
s as (select a.*, coalesce(w.weight, 0.40) as weight, case when data_as_of is null then 1.0
    else greatest(pow(0.5, greatest(date_diff('day', data_as_of, date '2001-08-02'), 0) / 540.0), 0.3) end as freshness
    from a left join w on a.field = w.field and a.source_class = w.source_class where value is not null),
s2 as (select *, weight * freshness as strength from s),
d as (select *, strength * case when row_number() over (partition by provider_id, field, source_class order by strength desc, _src_ord) = 1 then 1 else 0.5 end as in_all,
    strength * case when row_number() over (partition by provider_id, field, value, source_class order by strength desc, _src_ord) = 1 then 1 else 0.5 end as in_value from s2),
v as (select provider_id, field, value, sum(in_value) as eff, sum(in_all) as part, 1 - product(1 - greatest(least(in_value, 0.999), 0)) as noisy_or,
    list(distinct source_class) as classes, min(_src_ord) as ord, arg_min(raw_value, _src_ord) as raw from d group by provider_id, field, value),
r as (select *, sum(part) over (partition by provider_id, field) as denom, min(ord) over (partition by provider_id, field) as first_ord,
    row_number() over (partition by provider_id, field order by eff desc, ord) as k,
    lead(eff) over (partition by provider_id, field order by eff desc, ord) as alt from v),
best as (select * from r where k = 1 and denom > 0),
fc as (select b.provider_id, b.field, bool_or(not list_contains(b.classes, d.source_class)) as foreign_class from best b join d
    on b.provider_id = d.provider_id and b.field = d.field and b.value <> d.value group by all),
lb as (select provider_id, field, string_agg(source_label, ', ' order by m desc, o) as supporting from (select d.provider_id, d.field, d.source_label, max(strength) as m, min(_src_ord) as o
    from d join best b on b.provider_id = d.provider_id and b.field = d.field and b.value = d.value group by all) group by all),
lc as (select provider_id, field, string_agg(source_label, ', ' order by m desc, o) as competing from (select d.provider_id, d.field, d.source_label, max(strength) as m, min(_src_ord) as o
    from d join best b on b.provider_id = d.provider_id and b.field = d.field and b.value <> d.value group by all) group by all),
ds as (select r.provider_id, r.field, arg_max(r.value, struct_pack(e := r.eff, o := -r.ord)) as dissent_value, max(r.eff / r.denom) as share
    from r join cur on r.provider_id = cur.provider_id and r.field = cur.field where cur.cur is not null and r.value <> cur.cur group by all),
assessed as (select b.provider_id, b.field, coalesce(rk.risk_class, 'medium') as risk_class, cur.cur as current_value, b.value as proposed_value,
    b.value is distinct from cur.cur as changed, {_exact('b.noisy_or * (b.eff / b.denom)', 4)} as confidence,
    coalesce(fc.foreign_class, false) and coalesce(b.alt, 0) / b.denom >= 0.25 as conflict, len(b.classes) as corroborating_classes,
    coalesce(ds.share >= 0.25, false) as dissent, case when ds.share >= 0.25 then ds.dissent_value end as dissent_value,
    lb.supporting as supporting_sources, coalesce(lc.competing, '') as competing_sources, cur.raw_cur as raw_current,
    case when b.value is distinct from cur.cur then b.raw else cur.raw_cur end as raw_proposed, b.first_ord as field_ord
    from best b left join cur on b.provider_id = cur.provider_id and b.field = cur.field left join rk on rk.field = b.field
    left join fc on fc.provider_id = b.provider_id and fc.field = b.field left join lb on lb.provider_id = b.provider_id and lb.field = b.field
    left join lc on lc.provider_id = b.provider_id and lc.field = b.field left join ds on ds.provider_id = b.provider_id and ds.field = b.field)"""

DECIDE = f"""{ASSESS},
x as (select *, case risk_class when 'low' then 0 when 'medium' then 1 else 2 end as lvl, case risk_class when 'low' then 1 else 2 end as need from assessed),
g as (select provider_id, bool_or(changed) as any_change, list_reduce(list_prepend(0.0::double, list(confidence order by field_ord) filter (where changed)), lambda p, q: p + q) / count(*) filter (where changed) as mean_ch,
    list_reduce(list_prepend(0.0::double, list(confidence order by field_ord)), lambda p, q: p + q) / count(*) as mean_all,
    min(confidence) filter (where changed) as low, max(lvl) filter (where changed) as lvl, coalesce(bool_and(corroborating_classes >= need) filter (where changed), true) as enough,
    bool_or(changed and field = 'npi') as npi_changed,
    arg_min(struct_pack(f := field, s := supporting_sources, c := competing_sources), field_ord) filter (where changed and conflict) as clash,
    coalesce(string_agg(distinct field, ', ' order by field) filter (where changed and field in ('provider_name', 'npi', 'active')), '') as held,
    arg_min(struct_pack(f := field, v := dissent_value, c := current_value), field_ord) filter (where dissent and risk_class = 'high') as dh,
    string_agg(field, ', ' order by field_ord) filter (where changed) as names,
    count(*) filter (where changed) as n_changes from x group by provider_id),
h as (select *, [0.85, 0.90, 0.95][lvl + 1] as threshold, 'A reliable source reports ' || dh.f || '=''' || dh.v || ''' while the record still shows ''' || dh.c || '''' as stale from g),
decided as (select provider_id, any_change as change_detected, n_changes, coalesce(names, '') as changed_fields, {_exact('case when any_change then mean_ch else mean_all end', 2)} as overall_confidence,
    case when not any_change and dh is not null then 'human_review' when not any_change then 'no_change' when npi_changed then 'human_review' when clash is not null then 'human_review'
        when held <> '' then 'human_review' when dh is not null then 'human_review' when low >= threshold and enough then 'auto_update' when low >= 0.5 then 'human_review' else 'discard' end as recommended_action,
    case when not any_change and dh is not null then stale || '; flagged for verification (high-risk field never silently left stale).'
        when not any_change then 'All checked fields match authoritative sources; record confirmed accurate.'
        when npi_changed then 'NPI differs from the record — this indicates a data-entry error or a merged duplicate, not a field update. Routed to repair/dedup.'
        when clash is not null then clash.s || ' and ' || case when clash.c = '' then 'the existing record' else clash.c end || ' disagree on ' || clash.f || '; manual verification recommended.'
        when held <> '' then 'High-risk field(s) changed (' || held || '); never updated silently - routed to human confirmation.'
        when dh is not null then stale || '; routed to human review before any update.'
        when low >= threshold and enough then 'Updated ' || names || ' confirmed by independent reliable sources (min confidence ' || printf('%.2f', {_exact('low', 2)}) || ' >= ' || printf('%.2f', threshold) || ').'
        when low >= 0.5 then 'Change detected but below the auto-update bar (min confidence ' || printf('%.2f', {_exact('low', 2)}) || ' < ' || printf('%.2f', threshold) || case when enough then '' else '; insufficient independent corroboration' end || '); routed to human review.'
        else 'Evidence too weak (min confidence ' || printf('%.2f', {_exact('low', 2)}) || ' < 0.50); holding the record unchanged and re-queuing.' end as reason from h)"""


def assessments(spark, sf):
    return scoring.assess(T.assertions(spark, sf), T.current(spark, sf), T.POLICY)


def recommendations(spark, sf):
    return decide.decide(assessments(spark, sf), T.POLICY)


def assess(spark, sf):
    joined = {c: F.array_join(c, ", ") for c in ("supporting_sources", "competing_sources")}
    return assessments(spark, sf).withColumns(joined).drop("_field_ord")


def decide_records(spark, sf):
    r = recommendations(spark, sf)
    return r.select("provider_id", "change_detected", F.size("changes").cast("long").alias("n_changes"), F.array_join(F.transform("changes", lambda x: x["field"]), ", ").alias("changed_fields"), "overall_confidence", "recommended_action", "reason")


def recommendation_changes(spark, sf):
    rows = recommendations(spark, sf).select("provider_id", F.posexplode("changes").alias("pos", "c"))
    return rows.select("provider_id", F.col("pos").cast("long").alias("pos"), "c.field", "c.old_value", "c.new_value", "c.confidence_score", F.array_join("c.supporting_sources", ", ").alias("supporting_sources"))


def recommendation_json(spark, sf):
    """The recommendation as one JSON text a record, as the JSON sink writes it."""
    r = recommendations(spark, sf)
    return r.select("provider_id", F.to_json(F.struct("provider_id", "change_detected", "overall_confidence", "recommended_action")).alias("body"))


def life_signals(spark, sf):
    records = T.directory(spark, sf).select("provider_id", F.when(F.pmod(F.col("_ord"), F.lit(3)) != 0, F.col("provider_name")).alias("provider_name"), "practice_name")
    return decide.signals(recommendations(spark, sf), records).select("provider_id", F.array_join("signals", "; ").alias("signals"))


def audit_events(spark, sf):
    rows = audit.events(recommendations(spark, sf), assessments(spark, sf), at="2001-08-02 00:00:00")
    return rows.select("provider_id", "field", "old_value", "new_value", "decision", "field_confidence", "overall_confidence", "risk_class", "conflict", "actor")


def audit_evidence(spark, sf):
    weighted = scoring.weighted(T.assertions(spark, sf), T.POLICY)
    rows = audit.evidence(weighted, assessments(spark, sf))
    return rows.select("provider_id", "field", F.size("sources").cast("long").alias("n_sources"), F.array_join(F.transform("sources", lambda x: F.concat_ws(":", x["source_label"], x["asserted_value"])), ", ").alias("evidence"))


def _decided(spark, sf):
    return T.read(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("provider_id"))


def review_queue(spark, sf):
    return audit.review_queue(audit_events(spark, sf), _decided(spark, sf)).withColumn("n_fields", F.col("n_fields").cast("long"))


def review_counts(spark, sf):
    return audit.review_counts(audit_events(spark, sf), _decided(spark, sf))


_EVENTS = f"""{DECIDE},
ev as (select d.provider_id, x.field, x.raw_current as old_value, x.raw_proposed as new_value, d.recommended_action as decision, {_exact('x.confidence', 2)} as field_confidence,
    d.overall_confidence, x.risk_class, coalesce(x.conflict, false) as conflict, 'pipeline' as actor from decided d left join x on x.provider_id = d.provider_id and x.changed)"""


def _truth(spark, sf):
    c = T.current(spark, sf)
    nxt = F.translate("cur", "FOP", "OPF")
    return c.where("cur is not null and field in ('phone', 'address', 'specialty')").select("provider_id", "field", F.concat(F.lit("raw "), nxt).alias("value"))


def _expected(spark, sf):
    return T.read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("provider_id"), F.get(F.array(F.lit("human_review"), F.lit("auto_update"), F.lit("no_change")), F.pmod("c_custkey", F.lit(3)).cast("int")).alias("expected_action"))


def backtest_report(spark, sf):
    r = backtest.report(recommendations(spark, sf), _truth(spark, sf), _expected(spark, sf))
    return r.withColumns({c: F.round(c, 6) for c in ("recall", "detection_precision", "auto_update_precision", "routing_accuracy")})


_JUDGED = f"""{DECIDE},
tr as (select provider_id, field, 'raw ' || translate(cur, 'FOP', 'OPF') as value from cur where cur is not null and field in ('phone', 'address', 'specialty')),
nv as (select x.provider_id, x.field, {_exact('x.confidence', 2)} as confidence, x.raw_proposed as new_value, d.recommended_action = 'auto_update' as auto, tr.value as expected
    from x join decided d on d.provider_id = x.provider_id left join tr on tr.provider_id = x.provider_id and tr.field = x.field where x.changed),
j as (select *, case when expected is null then false when field = 'phone' then true when field = 'address' then upper(new_value) = upper(expected) else new_value = expected end as ok from nv)"""


def _samples(spark, sf):
    return backtest.judged(recommendations(spark, sf), _truth(spark, sf))


def calibration_bins(spark, sf):
    bins = backtest.calibration(_samples(spark, sf))
    return bins.select("lo", "hi", "n", F.round("mean_confidence", 4).alias("mean_confidence"), F.round("accuracy", 4).alias("accuracy"))


def brier_score(spark, sf):
    return backtest.brier(_samples(spark, sf))


def calibration_error(spark, sf):
    return backtest.calibration_error(backtest.calibration(_samples(spark, sf)))


QUERIES = {
    "assess": (assess, f"with {ASSESS} select * exclude (field_ord) from assessed"),
    "decide": (decide_records, f"with {DECIDE} select * from decided"),
    "recommendation_changes": (recommendation_changes, f"with {ASSESS} select provider_id, row_number() over (partition by provider_id order by field_ord) - 1 as pos, field, raw_current as old_value, raw_proposed as new_value, {_exact('confidence', 2)} as confidence_score, supporting_sources from assessed where changed"),
    "recommendation_json": (recommendation_json, f"""with {DECIDE} select provider_id, '{{"provider_id":"' || provider_id || '","change_detected":' || cast(change_detected as varchar)
    || coalesce(',"overall_confidence":' || cast(cast(overall_confidence as double) as varchar), '') || ',"recommended_action":"' || recommended_action || '"}}' as body from decided"""),
    "life_signals": (life_signals, f"""with {ASSESS}, {T.DIRECTORY},
b as (select dir.provider_id, dir.practice_name is not null and dir._ord % 3 = 0 as firm from dir where provider_id in (select provider_id from assessed)),
p as (select b.provider_id, max(case when field = 'address' and changed and upper(coalesce(raw_current, '')) <> '' and upper(raw_current) <> upper(raw_proposed) then case when firm then 'practice relocation' else 'provider movement' end || ': ' || coalesce(raw_current, 'None') || ' -> ' || raw_proposed end) as s1,
    max(case when field = 'practice_name' and changed then 'practice rebrand: ' || coalesce(raw_current, 'None') || ' -> ' || raw_proposed end) as s3 from b left join assessed x on x.provider_id = b.provider_id group by b.provider_id)
select provider_id, concat_ws('; ', s1, s3) as signals from p"""),
    "audit_events": (audit_events, f"with {_EVENTS} select * from ev"),
    "audit_evidence": (audit_evidence, f"""with {ASSESS} select x.provider_id, x.field, count(*) as n_sources, string_agg(d.source_label || ':' || d.raw_value, ', ' order by d._src_ord) as evidence
from assessed x join d on d.provider_id = x.provider_id and d.field = x.field and d.value = x.proposed_value where x.changed group by all"""),
    "review_queue": (review_queue, f"""with {_EVENTS} select provider_id, min(coalesce(2 - case risk_class when 'low' then 0 when 'medium' then 1 when 'high' then 2 end, 3)) as risk_rank, bool_or(conflict) as conflict,
count(field) as n_fields, max(overall_confidence) as overall_confidence from ev where decision = 'human_review' and provider_id not in (select cast(doc_id as varchar) from labels) group by provider_id"""),
    "review_counts": (review_counts, f"""with {_EVENTS}, q as (select distinct provider_id from ev where decision = 'human_review')
select count(*) as queue, count(*) filter (where provider_id in (select cast(doc_id as varchar) from labels)) as reviewed, count(*) filter (where provider_id not in (select cast(doc_id as varchar) from labels)) as pending from q"""),
    "backtest_report": (backtest_report, f"""with {_JUDGED},
c as (select count(*) as detected_changes, count(*) filter (where ok) as correct_detections, count(*) filter (where auto) as auto_updates, count(*) filter (where auto and ok) as correct_auto_updates from j),
t as (select count(*) as true_changes from tr where provider_id in (select provider_id from decided)),
e as (select count(*) as records, count(c_custkey) as routing_total, count(*) filter (where recommended_action = ['human_review', 'auto_update', 'no_change'][cast(c_custkey % 3 + 1 as int)]) as routing_correct
    from decided left join customer on cast(c_custkey as varchar) = provider_id)
select *, round(case when true_changes = 0 then 1 else correct_detections / true_changes end, 6) as recall, round(case when detected_changes = 0 then 1 else correct_detections / detected_changes end, 6) as detection_precision,
    round(case when auto_updates = 0 then 1 else correct_auto_updates / auto_updates end, 6) as auto_update_precision, round(case when routing_total = 0 then 1 else routing_correct / routing_total end, 6) as routing_accuracy from c, t, e"""),
    "calibration_bins": (calibration_bins, f"""with {_JUDGED}, b as (select least(floor(confidence * 5), 4) as id, count(*) as n, avg(confidence) as m, avg(case when ok then 1.0 else 0.0 end) as acc from j group by 1)
select i / 5 as lo, (i + 1) / 5 as hi, coalesce(n, 0) as n, coalesce(round(m, 4), 0) as mean_confidence, coalesce(round(acc, 4), 0) as accuracy from (select unnest([0, 1, 2, 3, 4]) as i) left join b on b.id = i"""),
    "brier_score": (brier_score, f"with {_JUDGED} select round(avg(pow(confidence - case when ok then 1 else 0 end, 2)), 4) as brier from j"),
    "calibration_error": (calibration_error, f"""with {_JUDGED}, b as (select count(*) as n, avg(confidence) as m, avg(case when ok then 1.0 else 0.0 end) as acc from j group by least(floor(confidence * 5), 4))
select round(sum(n * abs(m - acc)) / sum(n), 4) as ece from b"""),
}
