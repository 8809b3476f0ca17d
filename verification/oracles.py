"""DuckDB SQL that gives each query's result another way.

Hours come from minute rows, winners from ``row_number``, reports from joining the
calendar with raw run days, overlaps from one plain ``lag``. Shared inputs are
written once as common table expressions and put before each query that uses them.
"""

from __future__ import annotations

from verification.views import SPARSE

TEAM = "case when event_id % 40 = 7 then 'guest' else 'team-' || user_id end"
MINUTES = "cast(floor(case when event_id % 20 = 0 then value * 60 else value end) as int)"
STATE = "case event_id % 3 when 0 then 'finished' when 1 then 'running' else 'crashed' end"
HOST = "case when event_id % 23 = 0 then null else 'host-' || (user_id % 7) end"
TAGS_TEXT = """case event_id % 20 when 0 then '["Other_GPU"]' when 1 then '["ablation", "baseline"]'
    when 2 then '["others_gpu"]' else '[]' end"""
IGNORED = "(tags like '%\"other_gpu\"%' or tags like '%\"others_gpu\"%')"
TARGET = "date '2024-02-06'"

# Each entry: name -> (names it reads, body).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "company": (
        (),
        """select s_suppkey k, 'company-' || s_suppkey company,
             (3 * s_suppkey + 1) // 2 first_team, 2 - s_suppkey % 2 n_teams from supplier""",
    ),
    "team": (
        ("company",),
        """select company, 'team-' || t team, t, k from (
             select *, unnest(generate_series(first_team, first_team + n_teams - 1)) t from company)""",
    ),
    "schedule": (
        ("company",),
        """select k, company, date '2024-03-01' as date, 2 node from company where k % 11 = 10
           union all select k, company, date '2024-05-01', 0 from company where k % 11 = 10
           union all select k, company, date '2024-01-03' + cast(k % 5 as int), 1 + k % 3
             from company where k % 11 <> 10
           union all select k, company, date '2024-01-15', 2 + k % 4 from company where k % 11 <> 10
           union all select k, company, date '2024-01-29', case when k % 7 = 3 then 3 else 0 end
             from company where k % 11 <> 10""",
    ),
    "win": (
        ("schedule", "team"),
        """select team, k, min(date) start_date,
             case when arg_max(node, date) = 0 then max(date) else date '2100-01-01' end end_date
           from schedule join team using (company, k) group by team, k""",
    ),
    "calendar": (
        ("schedule",),
        f"""select company, d as date, arg_max(node, s.date) assigned_gpu_node from (
             select company, cast(unnest(generate_series(min(date),
                 least(max(date), {TARGET}), interval 1 day)) as date) d
             from schedule group by company) days
           join schedule s using (company) where s.date <= d
           group by company, d having arg_max(node, s.date) > 0""",
    ),
    "run": (
        (),
        f"""select event_id, {TEAM} company_name, event_type project, 'r' || event_id run_id,
             {TAGS_TEXT} tags, ts + interval 9 hours created_at,
             ts + interval 9 hours + to_minutes({MINUTES}) updated_at, {STATE} state,
             1 + event_id % 16 gpu_count,
             case when event_id % 11 <> 0 then cast((event_id * 37) % 101 as double) end au,
             case when event_id % 11 <> 0 then cast((event_id * 53) % 101 as double) end am,
             case when event_id % 11 <> 0 then cast(least(100, (event_id * 37) % 101 + 10) as double) end mu,
             case when event_id % 11 <> 0 then cast(least(100, (event_id * 53) % 101 + 10) as double) end mm,
             {HOST} host_name
           from events""",
    ),
    "tick": (
        ("run",),
        f"""select run_id, cast(tick_at as date) as date, count(*) ticks from (
             select run_id, unnest(generate_series(created_at, updated_at, interval 1 minute)) tick_at
             from run) where cast(tick_at as date) between date '2024-01-01' and {TARGET}
           group by all""",
    ),
    "run_day": (
        ("run", "tick"),
        "select run.*, date, ticks, ticks / 60.0 duration_hour from run join tick using (run_id)",
    ),
    "company_day": (
        ("run_day", "team"),
        "select d.*, company from run_day d left join team on company_name = team",
    ),
    "hours": (
        ("calendar", "company_day"),
        """select company, date, assigned_gpu_node,
             round(coalesce(sum(ticks * gpu_count), 0) / 60.0, 1) raw_hour,
             least(round(coalesce(sum(ticks * gpu_count), 0) / 60.0, 1), assigned_gpu_node * 192.0) as hour
           from calendar left join company_day using (company, date)
           group by company, date, assigned_gpu_node""",
    ),
    "node": (
        (),
        f"""select event_id, {TEAM} team, event_type project, 'r' || event_id run_id,
             ts + interval 9 hours created_at,
             ts + interval 9 hours + to_minutes({MINUTES}) updated_at, {STATE} state,
             case event_id % 20 when 0 then 'Other_GPU' when 1 then 'ablation,baseline'
               when 2 then 'others_gpu' else '' end tags,
             {HOST} host_name,
             case when event_id % 17 = 0 then null when event_id % 19 = 0 then '' else 'A100' end gpu_name,
             case when event_id % 17 = 0 then 0 else event_id % 16 end own_count,
             case when event_id % 6 = 0 then '{{}}' when event_id % 6 = 1 then '{{"num_nodes":5}}'
               when event_id % 6 = 2 then '{{"num_nodes":{{"value":"x"}},"num_gpus":{{"value":8}}}}'
               else '{{"num_nodes":{{"value":' || json_extract_string(props, '$.k')
                 || '}},"num_gpus":{{"value":"8"}},"world size":{{"value":16}},"trainer.num_nodes":{{"value":3}}}}'
             end config
           from events""",
    ),
    "valid": (
        ("node", "win"),
        f"""select node.* from node join win using (team)
           where coalesce(gpu_name, '') <> ''
             and not list_has_any(string_split(lower(tags), ','), ['other_gpu', 'others_gpu'])
             and created_at <> updated_at
             and cast(updated_at as date) >= greatest(date '2024-01-01', start_date)
             and cast(created_at as date) <= least({TARGET}, end_date)
             and case k % 5 when 1 then project = 'click' when 3 then project like 'v%'
                   when 2 then project not like 'e%r'
                   when 4 then not (substr(project, 2, 1) = 'i' and substr(project, 3, 1) <> 'e')
                   else true end""",
    ),
    "entry": (
        ("node", "team"),
        """select event_id, run_id, node.team, own_count, t, key,
             json_extract(config, '$."' || key || '"') entry,
             coalesce(try_cast(json_extract_string(config, '$."' || key || '".value') as bigint), 0) n
           from node left join team using (team) cross join (values ('num_nodes'), ('num_gpus'),
             ('world size'), ('NUM_NODES'), ('trainer.num_nodes'), ('NNODES')) as keys(key)""",
    ),
    "counted": (
        ("entry",),
        """select event_id, run_id, team, case
             when t % 7 = 1 then case when bad_nodes then own_count else num_nodes * num_gpus end
             when t % 7 = 2 then world_size
             when t % 7 = 3 then 8 * case when upper_nodes <> 0 then upper_nodes else trainer_nodes end
             when t % 7 = 4 then 8 * nnodes
             else own_count end gpu_count
           from (select event_id, run_id, team, t, own_count,
             bool_or(key in ('num_nodes', 'num_gpus') and json_type(entry) <> 'OBJECT') bad_nodes,
             max(n) filter (key = 'num_nodes') num_nodes, max(n) filter (key = 'num_gpus') num_gpus,
             max(n) filter (key = 'world size') world_size, max(n) filter (key = 'NUM_NODES') upper_nodes,
             max(n) filter (key = 'trainer.num_nodes') trainer_nodes, max(n) filter (key = 'NNODES') nnodes
             from entry group by all)""",
    ),
    "sample": (
        (),
        f"""select {TEAM} || '/' || event_type || '/r' || event_id run_path, event_id, k,
             epoch_us(ts) / 1000000.0 + k * 3600.0 _timestamp,
             cast(ts + interval 9 hours + to_hours(cast(k as int)) as date) as date
           from (select *, unnest(generate_series(0, case when event_id % 13 = 0 then 0 else 3 end)) k
                 from events)""",
    ),
    "reading": (
        ("sample",),
        """select run_path, event_id, k, _timestamp, date, 0 gpu_index, 'gpu' metric,
             cast((event_id * 31 + k * 17) % 101 as double) as value from sample where event_id % 29 <> 0
           union all select run_path, event_id, k, _timestamp, date, 0, 'memory',
             (event_id * 41 + k * 13) % 101 from sample where event_id % 29 <> 0
           union all select run_path, event_id, k, _timestamp, date, 1, 'gpu',
             (event_id * 29 + k * 7) % 101 from sample where event_id % 29 <> 0 and event_id % 2 = 1
           union all select run_path, event_id, k, _timestamp, date, 1, 'memory',
             (event_id * 23 + k * 5) % 101 from sample where event_id % 29 <> 0 and event_id % 2 = 1""",
    ),
    "metric_day": (
        ("reading",),
        f"""select run_path, date, avg(value) filter (metric = 'gpu') average_gpu_utilization,
             max(value) filter (metric = 'gpu') max_gpu_utilization,
             avg(value) filter (metric = 'memory') average_gpu_memory,
             max(value) filter (metric = 'memory') max_gpu_memory
           from reading where event_id % 13 <> 0 and date between date '2024-01-01' and {TARGET}
           group by all""",
    ),
    "sparse": (
        (),
        f"""select {TEAM} || '/' || event_type || '/r' || event_id run_path, event_id, has,
             epoch_us(ts) / 1000000.0 + off _timestamp,
             case when has = 1 then cast((event_id * 31 + off) % 101 + 101 as double) end gpu,
             case when has = 1 then cast((event_id * 41 + off) % 101 + 101 as double) end memory,
             cast(ts + interval 9 hours + to_seconds(cast(off as int)) as date) as date
           from events join (values {", ".join(map(str, SPARSE))}) as s(m, off, has) on m = event_id % 6""",
    ),
    "sparse_day": (
        ("sparse",),
        f"""select run_path, event_id, date, avg(gpu) average_gpu_utilization, max(gpu) max_gpu_utilization,
             avg(memory) average_gpu_memory, max(memory) max_gpu_memory
           from (select *, count(*) over w as n, sum(has) over w as readings from sparse window w as (partition by event_id))
           where n > 1 and readings > 0 and date between date '2024-01-01' and {TARGET} group by all""",
    ),
    "run_row": (
        ("run_day",),
        """select date, company_name, project, run_id, tags, created_at, updated_at, state,
             duration_hour, gpu_count, au average_gpu_utilization, am average_gpu_memory,
             mu max_gpu_utilization, mm max_gpu_memory, host_name,
             timestamp '2024-02-01 00:00:00' logged_at from run_day""",
    ),
    "week_row": (
        ("run_day",),
        "select * from run_day where date >= date '2024-01-15' and date < date '2024-01-22'",
    ),
    "registry": (
        (),
        """select s_suppkey k, 'p-' || s_suppkey run_id,
             'Tables_2024-01-' || case when s_suppkey % 10 = 2 then '19' else '20' end as name,
             case when s_suppkey = 8 then ['overall', 'latest']
               when s_suppkey % 9 = 1 then ['company-' || s_suppkey, 'extra', 'latest']
               when s_suppkey % 9 = 3 then ['company-' || s_suppkey]
               when s_suppkey % 9 = 5 then ['someone', 'latest']
               else ['company-' || s_suppkey, 'latest'] end tags from supplier""",
    ),
    "expected": (
        ("schedule",),
        """select company from schedule group by company
             having min(date) <= date '2024-01-20' and date '2024-01-20' < max(date)
           union all select 'overall' where exists (select 1 from schedule group by company
             having min(date) <= date '2024-01-20' and date '2024-01-20' < max(date))""",
    ),
    "found": (
        ("registry",),
        """select tags[1] company from registry
           where list_contains(tags, 'latest') and len(tags) = 2""",
    ),
    "finding": (
        ("registry", "expected", "found"),
        """select 'Error of number of tags' title, '[''' || array_to_string(tags, ''', ''') || ''']' as text
             from registry where list_contains(tags, 'latest') and len(tags) <> 2
           union all select 'Error of target date', '2024-01-20, ' || name
             from registry where list_contains(tags, 'latest') and right(name, 10) <> '2024-01-20'
           union all select 'Error of number of latest runs', ''
             where (select count(*) from expected) <> (select count(*) from found)
           union all select 'Error of companies',
               (select '[' || string_agg('''' || company || '''', ', ' order by company) || ']' from found)
             where exists (select company from expected except select company from found)
                or exists (select company from found except select company from expected)""",
    ),
}


def report(keys: str, calendar: str, metrics_on: str, hours: str) -> tuple[tuple[str, ...], str]:
    """A report the long way: the calendar with every run day of its period."""
    of_calendar = ", ".join(f"c.{key}" for key in keys.split(", "))
    return (
        ("calendar", "company_day", "hours"),
        f"""select {keys}, round(coalesce(h.hour, 0), 1) total_gpu_hour,
             round(coalesce(case when h.hour > node * 192 then 100
               else h.hour / nullif(node * 192, 0) * 100 end, 0), 1) utilization_rate,
             round(coalesce(su / nullif(ticks, 0), 0), 1) average_gpu_utilization,
             round(coalesce(mu, 0), 1) max_gpu_utilization,
             round(coalesce(sm / nullif(ticks, 0), 0), 1) average_gpu_memory,
             round(coalesce(mm, 0), 1) max_gpu_memory,
             n_runs, cast(node as bigint) assigned_gpu_node, cast(node * 192 as bigint) assigned_gpu_hour,
             h.raw_hour _total_gpu_hour, coalesce(ticks, 0) / 60.0 total_metrics_hour
           from (select {of_calendar}, any_value(node) node,
               sum(case when au is not null then ticks end) ticks,
               sum(au * ticks) su, sum(am * ticks) sm, max(mu) mu, max(mm) mm,
               count(distinct run_id) + max(case when run_id is null then 1 else 0 end) n_runs
             from ({calendar}) c left join company_day d on {metrics_on}
             group by all) m
           left join ({hours}) h using ({keys})""",
    )


SUNDAY = "cast({0} - cast(dayofweek({0}) as int) as date)"
SHIFTED = "cast({0} - cast(isodow({0}) as int) as date)"
ROLLED = "round(sum(hour), 1) as hour, round(sum(raw_hour), 1) raw_hour from hours group by all"


def _weekly(bucket: str) -> tuple[tuple[str, ...], str]:
    return report(
        "company, week_start",
        f"""select company, {SUNDAY.format("date")} week_start, sum(assigned_gpu_node) node
            from calendar where date <= date '2024-02-03' group by all""",
        f"c.company = d.company and c.week_start = {bucket.format('d.date')}",
        f"select company, {SUNDAY.format('date')} week_start, {ROLLED}",
    )


CTES["report_daily"] = report(
    "company, date",
    "select company, date, assigned_gpu_node node from calendar",
    "c.company = d.company and c.date = d.date",
    "select company, date, hour, raw_hour from hours",
)
CTES["report_weekly"] = _weekly(SHIFTED)
CTES["report_weekly_aligned"] = _weekly(SUNDAY)
CTES["report_monthly"] = report(
    "company, year_month",
    """select company, strftime(date, '%Y-%m') year_month, sum(assigned_gpu_node) node
       from calendar where date < date '2024-02-01' group by all""",
    "c.company = d.company and c.year_month = strftime(d.date, '%Y-%m')",
    f"select company, strftime(date, '%Y-%m') year_month, {ROLLED}",
)
CTES["report_overall"] = report(
    "company",
    "select company, sum(assigned_gpu_node) node from calendar group by all",
    "c.company = d.company",
    f"select company, {ROLLED}",
)

RUNS_WITH_PREVIOUS = """select *, lag(updated_at) over (
      partition by company_name, project, host_name order by created_at, run_id) prev_updated_at
    from (select company_name, project, run_id, min(created_at) created_at,
        max(updated_at) updated_at, arg_max(host_name, date) host_name,
        sum(ticks * gpu_count) ticks, bool_or(gpu_count >= 9) multi, bool_or({ignored}) ignored
      from {source} group by all)"""

# Each entry: name -> (names it reads, final select).
FINALS: dict[str, tuple[tuple[str, ...], str]] = {
    "team_dim": (("team",), "select company, team from team"),
    "team_windows": (("win",), "select team, start_date, end_date from win"),
    "daily_calendar": (
        ("calendar",),
        "select company, date, cast(assigned_gpu_node as bigint) assigned_gpu_node from calendar",
    ),
    "daily_calendar_open_end": (
        ("schedule",),
        f"""select company, d as date, cast(arg_max(node, s.date) as bigint) assigned_gpu_node from (
              select company, cast(unnest(generate_series(min(date), {TARGET}, interval 1 day)) as date) d
              from schedule group by company) x join schedule s using (company)
            where s.date <= d group by company, d having arg_max(node, s.date) > 0""",
    ),
    "weekly_calendar": (
        ("calendar",),
        f"""select company, {SUNDAY.format('date')} week_start,
              cast(sum(assigned_gpu_node) as bigint) assigned_gpu_node
            from calendar where date <= date '2024-02-03' group by all""",
    ),
    "monthly_calendar": (
        ("calendar",),
        """select company, strftime(date, '%Y-%m') year_month,
             cast(sum(assigned_gpu_node) as bigint) assigned_gpu_node
           from calendar where date < date '2024-02-01' group by all""",
    ),
    "overall_calendar": (
        ("calendar",),
        """select company, cast(sum(assigned_gpu_node) as bigint) assigned_gpu_node
           from calendar group by all""",
    ),
    "project_filter": (
        ("win",),
        f"""select distinct team, event_type project from (select {TEAM} team, event_type from events)
            join win using (team)
            where case k % 5 when 1 then event_type = 'click' when 3 then event_type like 'v%'
                when 2 then event_type not like 'e%r'
                when 4 then not (substr(event_type, 2, 1) = 'i' and substr(event_type, 3, 1) <> 'e')
                else true end and start_date <= {TARGET} and end_date >= date '2024-01-01'""",
    ),
    "valid_runs": (
        ("valid",),
        """select team || '/' || project || '/' || run_id run_path, created_at, updated_at, state, tags,
             host_name, gpu_name, own_count gpu_count from valid""",
    ),
    "valid_run_counts": (
        ("valid",),
        "select team, project, count(*) n_runs from valid group by all",
    ),
    "gpu_count": (
        ("counted",),
        "select team, run_id, cast(gpu_count as bigint) gpu_count from counted",
    ),
    "run_days": (("run_row",), "select * from run_row"),
    "metrics_long": (
        ("reading",),
        "select run_path, _timestamp, cast(gpu_index as int) gpu_index, metric, value from reading",
    ),
    "metrics_daily": (("metric_day",), "select * from metric_day"),
    "metrics_daily_long": (("metric_day",), "select * from metric_day"),
    "metrics_long_all": (
        ("sample", "reading"),
        """select run_path, _timestamp, cast(gpu_index as int) gpu_index, metric, r.value
           from sample cross join (values (0), (1)) as g(gpu_index) cross join (values ('gpu'), ('memory')) as m(metric)
           left join reading r using (run_path, _timestamp, gpu_index, metric)""",
    ),
    "metrics_daily_span": (
        ("metric_day", "sample"),
        """select m.*, hours as metrics_hours from metric_day m join (
             select run_path, date, (max(_timestamp) - min(_timestamp)) / 3600 as hours from sample group by all)
           using (run_path, date)""",
    ),
    "metrics_daily_sparse": (("sparse_day",), "select * exclude (event_id) from sparse_day"),
    "metrics_of_runs": (
        ("sparse_day", "valid"),
        "select * exclude (event_id) from sparse_day where event_id in (select event_id from valid)",
    ),
    "run_days_with_metrics": (
        ("valid", "counted", "metric_day"),
        f"""select t.date, v.team company_name, project, v.run_id,
              case when tags = '' then '[]' else '["' || replace(tags, ',', '", "') || '"]' end tags,
              created_at, updated_at, state, ticks / 60.0 duration_hour,
              cast(counted.gpu_count as bigint) gpu_count, average_gpu_utilization, average_gpu_memory,
              max_gpu_utilization, max_gpu_memory, host_name, timestamp '2024-02-07 00:15:00' logged_at
            from valid v join counted using (event_id)
            join (select event_id, cast(tick_at as date) as date, count(*) ticks from (
                select event_id, unnest(generate_series(created_at, updated_at, interval 1 minute)) tick_at
                from valid) where cast(tick_at as date) between date '2024-01-01' and {TARGET}
              group by all) t using (event_id)
            left join metric_day m on m.run_path = v.team || '/' || project || '/' || v.run_id
              and m.date = t.date""",
    ),
    "merge_history": (
        ("run_row",),
        """select * exclude (rn) from (
             select *, row_number() over (partition by date, company_name, project, run_id
               order by logged_at desc) rn
             from (select * from run_row where date < date '2024-01-21'
               union all by name
               select * replace (gpu_count + 1 as gpu_count, timestamp '2024-02-02 00:00:00' as logged_at)
               from run_row where date >= date '2024-01-15')) where rn = 1""",
    ),
    "with_company": (
        ("company_day",),
        "select company, date, project, run_id, duration_hour, gpu_count from company_day",
    ),
    "usage_facts": (
        ("company_day",),
        f"""with row as (select *, min(date) over (partition by company, run_id) first_day,
                min(date) over (partition by company, run_id, {SHIFTED.format('date')}) first_shifted,
                min(date) over (partition by company, run_id, {SUNDAY.format('date')}) first_sunday,
                min(date) over (partition by company, run_id, strftime(date, '%Y-%m')) first_month
              from company_day where company is not null)
            select company, date, cast(sum(ticks * gpu_count) as double) gpu_minutes,
              cast(sum(case when au is not null then ticks end) as double) metric_minutes,
              sum(au * ticks) utilization_minutes, sum(am * ticks) memory_minutes,
              max(mu) max_gpu_utilization, max(mm) max_gpu_memory,
              count(distinct run_id) day_runs,
              count(distinct case when date = first_shifted then run_id end) week_runs,
              count(distinct case when date = first_sunday then run_id end) aligned_week_runs,
              count(distinct case when date = first_month then run_id end) month_runs,
              count(distinct case when date = first_day then run_id end) all_runs
            from row group by all""",
    ),
    "gpu_hours_daily": (
        ("hours",),
        "select company, date, hour total_gpu_hour, raw_hour _total_gpu_hour from hours",
    ),
    "gpu_hours_weekly": (
        ("hours",),
        f"""select company, {SUNDAY.format('date')} week_start, round(sum(hour), 1) total_gpu_hour,
              round(sum(raw_hour), 1) _total_gpu_hour from hours group by all""",
    ),
    "gpu_hours_monthly": (
        ("hours",),
        """select company, strftime(date, '%Y-%m') year_month, round(sum(hour), 1) total_gpu_hour,
             round(sum(raw_hour), 1) _total_gpu_hour from hours group by all""",
    ),
    "gpu_hours_overall": (
        ("hours",),
        """select company, round(sum(hour), 1) total_gpu_hour, round(sum(raw_hour), 1) _total_gpu_hour
           from hours group by all""",
    ),
    "report_daily": (("report_daily",), "select * from report_daily"),
    "report_weekly": (("report_weekly",), "select * from report_weekly"),
    "report_weekly_aligned": (("report_weekly_aligned",), "select * from report_weekly_aligned"),
    "report_monthly": (("report_monthly",), "select * from report_monthly"),
    "report_overall": (("report_overall",), "select * from report_overall"),
    "report_recent_daily": (
        ("report_daily",),
        """select * from report_daily
           qualify row_number() over (partition by company order by date desc) <= 30""",
    ),
    "report_recent_weekly": (
        ("report_weekly",),
        """select * from report_weekly
           qualify row_number() over (partition by company order by week_start desc) <= 4""",
    ),
    "report_daily_labelled": (
        ("report_daily",),
        """select company as "企業名", strftime(date, '%Y-%m-%d') as "日付",
             total_gpu_hour as "合計GPU使用時間(h)", utilization_rate as "GPU稼働率(%)",
             average_gpu_utilization as "平均GPUパフォーマンス率(%)",
             max_gpu_utilization as "最大GPUパフォーマンス率(%)",
             average_gpu_memory as "平均GPUメモリ利用率(%)", max_gpu_memory as "最大GPUメモリ利用率(%)",
             n_runs, assigned_gpu_node, assigned_gpu_hour, _total_gpu_hour, total_metrics_hour
           from report_daily""",
    ),
    "low_utilization_alerts": (
        ("report_daily",),
        """select 'Too low utilization rate found.' title, company as text from report_daily
           qualify row_number() over (partition by company order by date desc) = 1
             and utilization_rate < 10""",
    ),
    "project_summary": (
        ("week_row",),
        f"""select company_name, project, round(sum(ticks) / 60.0, 2) "Total hours",
              count(*) "Total runs", count(case when multi then 1 end) master_node_runs,
              count(case when created_at < prev_updated_at then 1 end) overlap_runs, count(case when ignored then 1 end) ignore_runs
            from ({RUNS_WITH_PREVIOUS.format(source='week_row', ignored=IGNORED)})
            group by company_name, project""",
    ),
    "weekly_project_report": (
        ("week_row",),
        f"""select company_name, project, sum(ticks * gpu_count) / 60.0 "Total hours",
              count(distinct run_id) "Total runs",
              count(distinct case when gpu_count >= 9 then run_id end) master_node_runs,
              count(distinct case when host_name is not null and created_at < prev_updated_at
                then run_id end) overlap_runs,
              count(distinct case when {IGNORED} then run_id end) ignore_runs
            from (select *, lag(updated_at) over (partition by company_name, project, host_name
                order by created_at, run_id, date) prev_updated_at from week_row)
            group by company_name, project""",
    ),
    "overlapping_runs": (
        ("run_day",),
        f"""select company_name, project, host_name, run_id, created_at, updated_at, prev_updated_at
            from ({RUNS_WITH_PREVIOUS.format(source='run_day', ignored=IGNORED)})
            where created_at < prev_updated_at""",
    ),
    "company_row_counts": (
        ("run_day",),
        "select company_name, count(*) n_rows from run_day group by rollup (company_name)",
    ),
    "retag_latest": (
        ("registry", "company"),
        """select run_id, name, array_to_string(case when hit
               then list_filter(tags, lambda t: t <> 'latest') else tags end, ',') tags, hit untagged
           from (select *, list_contains(tags, 'latest') and (list_contains(tags, 'overall')
               or list_has_any(tags, (select list(company) from company))) hit from registry)""",
    ),
    "untagged_count": (
        ("registry", "company"),
        """select count(*) removed from registry where list_contains(tags, 'latest')
           and (list_contains(tags, 'overall')
             or list_has_any(tags, (select list(company) from company)))""",
    ),
    "latest_tables": (
        ("report_daily", "registry"),
        """select 'p-' || substr(company, 9) published_by, d.* from report_daily d
           where substr(company, 9) in (select cast(k as varchar) from registry
             where list_contains(tags, 'latest'))""",
    ),
    "in_progress_companies": (("expected",), "select company from expected"),
    "health_checks": (("finding",), "select title, text from finding"),
    "health_checks_inactive": (
        ("schedule",),
        """select 'No active companies' title, 'There are no companies currently active.' as text
           where not exists (select 1 from schedule group by company
             having min(date) <= date '2025-01-01' and date '2025-01-01' < max(date))""",
    ),
    "health_message": (
        ("finding",),
        """select 'Dashboard health check' title,
             string_agg(title || ': ' || text, chr(10) order by title || ': ' || text) as text from finding""",
    ),
    "missing_companies": (
        ("company", "report_daily"),
        """select 'warning' title, 'No data available for company: ' || company as text from company
           where company not in (select company from report_daily)""",
    ),
}

FINALS |= {
    "history_update_late": (
        ("run_row",),
        """with days as (select * from run_row where date in (date '2024-01-04', date '2024-01-18')),
           late as (select * replace (gpu_count + 100 as gpu_count, case when gpu_count % 3 = 0
               then timestamp '2024-01-01' else timestamp '2024-02-03' end as logged_at) from days),
           new as (select * from late union all by name
             select * replace (run_id || '-late' as run_id) from late where gpu_count = 101)
           select * exclude (rn, fresh) from (select *, row_number() over (partition by date, company_name, project, run_id
               order by logged_at desc, fresh desc) rn
             from (select *, 0 as fresh from run_row union all by name select *, 1 as fresh from new)) where rn = 1""",
    ),
    "csv_round_trip_text": (
        ("run_row",),
        """select * replace (case cast(substr(run_id, 2) as bigint) % 9 when 0 then 'a' || chr(10) || 'b'
               when 1 then 'c' || chr(13) || chr(10) || ',"d"' when 2 then '' when 3 then ' e '
               when 4 then 'f' || chr(92) || 'ng' when 5 then chr(92) when 6 then '"' when 7 then null
               else chr(92) || 'e' end as host_name,
             case when cast(substr(run_id, 2) as bigint) % 5 = 0 then '' else tags end as tags) from run_row""",
    ),
    "latest_history_version": (("run_row",), "select * from run_row where date < date '2024-01-21'"),
    "registry_update": (
        ("registry", "company"),
        """select run_id, name, array_to_string(case when list_contains(tags, 'latest') and (list_contains(tags, 'overall')
               or list_has_any(tags, (select list(company) from company)))
               then list_filter(tags, lambda t: t <> 'latest') else tags end, ',') tags from registry
           union all select name || '/' || owner, name, owner || case when name = 'Tables_2024-02-06' then ',latest' else '' end
           from (values ('Tables_2024-02-05'), ('Tables_2024-02-06')) as n(name)
             cross join (select company as owner from company union all select 'overall')""",
    ),
    "latest_published": (
        ("report_daily",),
        """select *, 'Tables_2024-02-06/' || company published_by, 'Tables_2024-02-06' as run from report_daily""",
    ),
    "alerts_table": (
        ("company", "report_daily"),
        """select *, 'daily_update' as source, '2024-02-06' as raised_for from (
             select 'warning' title, 'No data available for company: ' || company as text from company
             where company not in (select company from report_daily)
             union all select 'warning', 'No data available for overall, monthly, and weekly tables'
             where not exists (select 1 from report_daily)
             union all select 'Too low utilization rate found.', company from (
               select company, arg_max(utilization_rate, date) rate from report_daily group by company) where rate < 10)""",
    ),
}

# What was written must come back whole.
for _sink, _source in {
    "usage_facts_kept": "usage_facts",
    "landed_samples": "metrics_long",
    "published_overall": "report_overall",
    "published_monthly": "report_monthly",
    "published_weekly": "report_weekly",
    "csv_round_trip": "run_days",
    "history_update": "merge_history",
    "weekly_files": "weekly_project_report",
    "published_daily": "report_daily",
}.items():
    FINALS[_sink] = FINALS[_source]


def _ordered(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _ordered(CTES[name][0], seen)
            seen.append(name)
    return seen


def sql_of(name: str) -> str:
    needs, final = FINALS[name]
    ctes = ",\n".join(f"{n} as ({CTES[n][1]})" for n in _ordered(needs, []))
    if final.startswith("with "):
        return f"with {ctes},\n{final[5:]}"
    return f"with {ctes}\n{final}"


ORACLES: dict[str, str] = {name: sql_of(name) for name in FINALS}
