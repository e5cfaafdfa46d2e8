"""DuckDB SQL with the same result as each registered query, written independently of the Spark operators."""

from __future__ import annotations

from beaconlake.sources.derived import duckdb_select

SQL: dict[str, str] = {}

# Daily summary tables as CTEs over the derived raw tables.
_CTE = {
    "metrics": duckdb_select("mobile_telemetry_api_metrics"),
    "mobile": duckdb_select("mobile_telemetry_events"),
    "stats": duckdb_select("stats_history"),
    "gauges": duckdb_select("app_metrics2"),
    "deliveries": duckdb_select("github_app_metrics"),
    "incidents": duckdb_select("incidents"),
    "logs": duckdb_select("log_events"),
    "probes": duckdb_select("health_probes"),
    "runs": duckdb_select("ci_runs"),
    "usage": duckdb_select("usage_samples"),
    "normal": r"""
        select *, make_timestamp("timestamp" * 1000)::date as day,
            regexp_replace(regexp_replace(trim(endpoint), '/\d+', '/:id', 'g'),
                '/[^/]+\.(webp|jpg|jpeg|png|gif)$', '/:filename', 'i') as path
        from metrics""",
    "performance": """
        select day as snapshot_date, platform as os_platform,
            quantile_disc(latency_ms, 0.5)::bigint as p50_ms, quantile_disc(latency_ms, 0.95)::bigint as p95_ms,
            quantile_disc(latency_ms, 0.99)::bigint as p99_ms, count(*)::bigint as total_requests,
            count(*) filter (status_code <> 200)::bigint as error_requests
        from normal group by all""",
    "endpoints": """
        select day as snapshot_date, path as endpoint, method, round(avg(latency_ms), 2) as avg_latency_ms,
            count(*)::bigint as call_count
        from normal group by all""",
    "dated": """
        select *, make_timestamp("timestamp" * 1000)::date as day, json_extract_string(attributes, '$.query_text') as kw
        from mobile""",
    "searches": """
        select day, platform, kw, count(*)::bigint as n,
            row_number() over (partition by day, platform order by count(*) desc, kw nulls first) as rn
        from dated where event_name = 'BOOK_SEARCH' group by day, platform, kw""",
    "daily_kw": """
        select day, platform, to_json(list({'keyword': kw, 'count': n} order by rn))::varchar as top_searched_keywords
        from searches where rn <= 5 group by day, platform""",
    "funnel": """
        select day as snapshot_date, platform as os_platform,
            count(*) filter (event_name = 'SCANNER_SCREEN')::bigint as scan_opened_count,
            count(*) filter (event_name = 'BOOK_ADD_CART'
                and json_extract_string(attributes, '$.trigger_source') = 'BARCODE_SCANNER')::bigint as scan_success_count,
            count(*) filter (event_name in ('HOME_DATA_LOAD_FAILURE', 'BOOK_DETAIL_LOAD_FAILURE')
                and json_extract_string(attributes, '$.message') ilike '%ISBN%')::bigint as scan_miss_count,
            count(*) filter (event_name = 'CART_SCREEN')::bigint as cart_viewed_count,
            count(*) filter (event_name = 'BOOK_RENT_ACTION')::bigint as rent_success_count
        from dated group by day, platform""",
    "errors": """
        select day as snapshot_date, platform as os_platform, event_name as error_name, count(*)::bigint as occurrence_count
        from dated where event_name ilike '%_FAILURE' group by all""",
    "screens": """
        select day as snapshot_date, platform as os_platform, event_name as screen_name, count(*)::bigint as visit_count
        from dated where event_name ilike '%_SCREEN' group by all""",
    "pushes": """
        select *, json_array_length(payload, '$.commits')::bigint as commits,
            coalesce(json_array_length(payload, '$.head_commit.added'), 0)
            + coalesce(json_array_length(payload, '$.head_commit.removed'), 0)
            + coalesce(json_array_length(payload, '$.head_commit.modified'), 0) as growth,
            case when repository_name ilike '%api%' or repository_name ilike '%reports%' then 'Python'
                when repository_name ilike '%mobile%' or repository_name ilike '%tablet%' then 'Dart' end as lang
        from deliveries where event_type = 'push'""",
    "classified": """
        select *, case when error = 'timeout' then 'Connection timeout (10s)'
            when http_status is null or http_status not between 200 and 299
                then concat('HTTP Server Error: ', coalesce(http_status::varchar, 'none'))
            when body_status is distinct from 'UP'
                then concat('Health endpoint answered ', coalesce(body_status, 'undefined')) end as problem
        from probes""",
    "probe_steps": """
        select *, lag(problem is null, 1, true) over w as was_up,
            min(case when problem is null then probe_ts end)
                over (w rows between 1 following and unbounded following) as up_at
        from classified window w as (partition by component order by probe_ts, probe_id)""",
    "outages": """
        select sha256(concat(component, '|', epoch_us(probe_ts))) as id, 'INFRA' as source, component,
            'CRITICAL' as level, 'Health check failed' as title, problem as message,
            case when up_at is null then 'active' else 'resolved' end as status, probe_ts as created_at, up_at as resolved_at
        from probe_steps where problem is not null and was_up""",
    "finished": """
        select *, split_part(repository, '/', 2) as repo,
            concat('gh-pipeline-', split_part(repository, '/', 2), '-', workflow_id) as key
        from runs where action = 'completed' and conclusion in ('failure', 'success')""",
    "steps": """
        select *, lag(conclusion) over (partition by key order by updated_at, run_id) as before,
            row_number() over (partition by key, conclusion order by updated_at desc, run_id desc) as newest,
            concat('Commit ''', coalesce(head_message, 'No commit message'), ''' (',
                coalesce(substr(head_sha, 1, 7), 'unknown'), ') by ', coalesce(author_name, 'unknown'),
                ' triggered a failure in run #', run_number, '. Review logs at: ', html_url) as message
        from finished""",
    "levels": """
        select *, case when rows_read_24h >= 4000000 then 'FATAL' when rows_read_24h >= 2000000 then 'CRITICAL'
            when rows_read_24h >= 500000 then 'WARNING' end as level
        from (select *, (sum(rows_read) over (partition by resource order by sample_ts
            range between interval 24 hours preceding and current row))::bigint as rows_read_24h from usage)""",
    "poll_steps": f"""
        select *, lag(level) over w as before,
            min(case when level is null then {{'ts': sample_ts, 'id': sample_id, 'n': rows_read_24h}} end)
                over (w rows between 1 following and unbounded following) as nominal,
            {{'ts': sample_ts, 'id': sample_id, 'n': rows_read_24h}} as poll
        from levels window w as (partition by resource order by sample_ts, sample_id)""",
    "breach_days": """
        select resource, level, sample_ts::date as day, min(sample_ts) as created_at, max(poll) as last,
            min(nominal) as nominal
        from poll_steps where level is not null group by all""",
}

_NEEDS = {
    "normal": ["metrics"], "performance": ["normal"], "endpoints": ["normal"], "dated": ["mobile"],
    "searches": ["dated"], "daily_kw": ["searches"], "funnel": ["dated"], "errors": ["dated"], "screens": ["dated"],
    "pushes": ["deliveries"], "classified": ["probes"], "probe_steps": ["classified"], "outages": ["probe_steps"],
    "finished": ["runs"], "steps": ["finished"], "levels": ["usage"], "poll_steps": ["levels"],
    "breach_days": ["poll_steps"],
}


def _with(names: list[str]) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ",\n".join(f"{name} as ({_CTE[name]})" for name in ordered)


def _add(key: str, ctes: str, body: str) -> None:
    SQL[key] = f"with {_with(ctes.split())}\n{body}"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _at(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _half_up(x: str, places: int) -> str:
    """Decimal half-up rounding of a double's shortest decimal form, as Spark rounds."""
    return f"round(({x})::varchar::decimal(38, 18), {places})"


def _human(n: str) -> str:
    return (
        f"case when {n} < 1000 then {n}::varchar when {n} < 1000000 then concat(printf('%.1f', round({n} / 1000.0::double, 1)), 'K')"
        f" else concat(printf('%.2f', round({n} / 1000000.0::double, 2)), 'M') end"
    )


_SNAPSHOT = f"{_day('snapshot_date')} as snapshot_date"
_INCIDENT = (
    f"id, source, component, level, title, message, status, {_at('created_at')} as created_at,"
    f" {_at('resolved_at')} as resolved_at"
)
_LAST_DAY = "\"timestamp\" >= epoch_us(timestamp '2024-01-30') // 1000"
_WEEK = "snapshot_date between date '2024-01-25' and date '2024-01-31'"

_add(
    "day_window", "mobile",
    f"""select platform, count(*)::bigint as row_count, min("timestamp") as first_ms, max("timestamp") as last_ms
    from mobile where {_LAST_DAY} and "timestamp" < epoch_us(timestamp '2024-01-31') // 1000 group by platform""",
)
_add("daily_api_performance", "performance", f"select * replace ({_SNAPSHOT}) from performance")
_add("daily_endpoint_latency", "endpoints", f"select * replace ({_SNAPSHOT}) from endpoints")
_add("normalize_endpoint", "normal", "select path as endpoint, count(*)::bigint as calls from normal group by path")
_add(
    "daily_funnel", "funnel daily_kw",
    f"""select f.* replace ({_day('snapshot_date')} as snapshot_date),
        coalesce(k.top_searched_keywords, '[]') as top_searched_keywords
    from funnel f left join daily_kw k on k.day = f.snapshot_date and k.platform = f.os_platform""",
)
_add(
    "daily_top_keywords", "daily_kw",
    f"select {_day('day')} as snapshot_date, platform as os_platform, top_searched_keywords from daily_kw",
)
_add("daily_errors", "errors", f"select * replace ({_SNAPSHOT}) from errors")
_add("daily_screens", "screens", f"select * replace ({_SNAPSHOT}) from screens")

_add(
    "stats_24h", "stats",
    f"""select strftime("timestamp", '%H:00') as day, max(books) as books, max(users) as users, max(loans) as loans,
        max(reviews) as reviews, max(review_images) as review_images, {_at('max("timestamp")')} as "timestamp"
    from stats where "timestamp" > timestamp '2024-01-30' group by 1
    order by max(stats."timestamp") desc limit 24""",
)
_add(
    "stats_daily", "stats",
    f"""select {_day('"timestamp"')} as day, max(books) as books, max(users + 500) as users, max(loans) as loans,
        max(reviews) as reviews, max(review_images) as review_images, {_at('max("timestamp")')} as "timestamp"
    from stats group by 1 order by 1 desc limit 30""",
)
for _key, _label, _since, _extra in (
    ("runtime_series", "%H:%M", "2024-01-30", " + 1"),
    ("runtime_series_daily", "%m-%d", "2024-01-01", ""),
):
    _add(
        _key, "gauges",
        f"""select strftime("timestamp", '{_label}') as time_label, {_half_up('max(cpu_usage) * 100', 1)}::double as cpu,
            round(max(jvm_memory_used) / 1024 / 1024, 0) as memory, max(http_requests) as requests,
            max(active_db_connections){_extra} as db_conn, round(max(uptime) / 3600, 1) as uptime,
            {_at('max("timestamp")')} as raw_time
        from gauges where "timestamp" > timestamp '{_since}' group by 1""",
    )
_add(
    "performance_series", "performance",
    f"""select {_SNAPSHOT}, os_platform, p50_ms, p95_ms, p99_ms, total_requests as total_calls,
        round(error_requests::double / total_requests * 100, 2) as error_rate
    from performance where snapshot_date >= date '2024-01-01'""",
)
_MERGED = """
    select platform as os_platform, to_json(list({'keyword': kw, 'count': n} order by rn))::varchar as top_searched_keywords
    from (select platform, kw, sum(n)::bigint as n,
            row_number() over (partition by platform order by sum(n) desc, kw nulls first) as rn
        from searches where rn <= 5 and day >= date '2024-01-01' group by platform, kw)
    where rn <= 5 group by platform"""
_add("merged_keywords", "searches", _MERGED)
_add(
    "funnel_totals", "funnel searches",
    f"""select os_platform, sum(scan_opened_count)::bigint as total_scan_open,
        sum(scan_success_count)::bigint as total_scan_success, sum(scan_miss_count)::bigint as total_scan_miss,
        sum(cart_viewed_count)::bigint as total_cart_view, sum(rent_success_count)::bigint as total_rent_success,
        coalesce(any_value(m.top_searched_keywords), '[]') as top_searched_keywords
    from funnel left join ({_MERGED}) m using (os_platform)
    where snapshot_date >= date '2024-01-01' group by os_platform""",
)
for _key, _cte, _name, _value, _total, _n in (
    ("top_errors", "errors", "error_name", "occurrence_count", "total_occurrences", 10),
    ("top_screens", "screens", "screen_name", "visit_count", "total_views", 12),
):
    _add(
        _key, _cte,
        f"""select {_name}, os_platform, sum({_value})::bigint as {_total} from {_cte}
        where snapshot_date >= date '2024-01-01' group by all order by {_total} desc, {_name}, os_platform limit {_n}""",
    )
_add(
    "slow_endpoints", "endpoints",
    """select endpoint, method, round(avg(avg_latency_ms), 2) as latency_ms, sum(call_count)::bigint as total_calls
    from endpoints where snapshot_date >= date '2024-01-01' group by endpoint, method
    order by latency_ms desc, endpoint, method limit 8""",
)
_add(
    "latest_incidents", "incidents",
    f"""select {_INCIDENT} from (select * from incidents
        order by case when status = 'active' then 0 else 1 end, created_at desc, id limit 50)""",
)
for _key, _kind, _alias in (("dash_top_screens", "SCREEN_VIEW", "screen_name"), ("dash_top_events", "CUSTOM_EVENT", "event_name")):
    _add(
        _key, "mobile",
        f"""select event_name as {_alias}, count(*)::bigint as count from mobile
        where event_type = '{_kind}' and {_LAST_DAY} group by event_name order by 2 desc, 1 limit 5""",
    )
_add(
    "dash_top_errors", "mobile",
    f"""select event_name as error_type, error_message as message, count(*)::bigint as count from mobile
    where event_type = 'ERROR' and {_LAST_DAY} group by all order by 3 desc, 1, 2 nulls first limit 5""",
)
_add(
    "dash_api_latency", "metrics",
    f"""select endpoint, avg(latency_ms) as avg_latency_ms, count(*)::bigint as total_requests,
        count(*) filter (status_code >= 200 and status_code < 400) * 100.0::double / count(*) as success_rate
    from metrics where {_LAST_DAY} group by endpoint""",
)
_add(
    "live_tail", "mobile",
    """select * replace (json(attributes)::varchar as attributes) from mobile order by "timestamp" desc, id limit 50""",
)

_add(
    "commit_activity", "pushes",
    f"""select {_day('created_at')} as metric_key, sum(commits)::bigint as metric_value from pushes
    where created_at >= timestamp '2001-08-02' - interval 9999 day group by 1""",
)
_add(
    "commit_activity_weekly", "pushes",
    """select strftime(created_at, '%Y-W%W') as metric_key, sum(commits)::bigint as metric_value from pushes
    where created_at >= timestamp '2001-08-02' - interval 90 day group by 1""",
)
_DATASETS = {
    "code_growth": ("strftime(created_at, '%Y-%m')", "growth", "true"),
    "repo_activity": ("repository_name", "commits", "json_extract_string(payload, '$.repository.private') = 'false'"),
    "language_dist": ("lang", "commits", "lang is not null"),
}


def _dataset(key: str, value: str, where: str) -> str:
    return f"{key} as metric_key, sum({value})::bigint as metric_value from pushes where {where} group by 1"


for _key, _parts in _DATASETS.items():
    _add(_key, "pushes", f"select {_dataset(*_parts)}")
_UNION = {"commit_activity": ("strftime(created_at, '%Y-%m')", "commits", "true"), **_DATASETS}
_add(
    "github_metrics", "pushes",
    " union all ".join(
        f"select '{_key}' as dataset_type, metric_key, metric_value from (select {_dataset(*_parts)})"
        for _key, _parts in _UNION.items()
    ),
)
_add(
    "latest_per_repo", "deliveries",
    f"""select id, event_type, action, repository_name, sender_login, payload, {_at('created_at')} as created_at
    from deliveries where id in (select max(id) from deliveries where repository_name in ('acme/mobile',
        'acme/tablet', 'acme/api', 'acme/reports', 'acme/docs') group by repository_name)""",
)
_add(
    "github_totals", "deliveries",
    """select count(*) filter (event_type = 'push')::bigint as total_pushes,
        sum(case when event_type = 'push' then coalesce(json_array_length(payload, '$.commits'), 0) else 0 end)::bigint
            as total_commits,
        count(distinct repository_name)::bigint as total_repos,
        round(count(*) filter (event_type = 'check_suite' and c = 'success') * 100.0::double
            / nullif(count(*) filter (event_type = 'check_suite' and c is not null), 0), 1) as ci_success_rate
    from (select *, json_extract_string(payload, '$.check_suite.conclusion') as c from deliveries)""",
)
_add(
    "latest_push", "pushes",
    f"""select replace(repository_name, 'acme/', '') as repository_name, sender_login, {_at('created_at')} as created_at,
        case when ref like 'refs/tags/%' then concat('Tag: ', replace(ref, 'refs/tags/', ''))
            else replace(ref, 'refs/heads/', '') end as branch,
        json_extract_string(payload, '$.repository.language') as language, growth::int as changed_count
    from (select *, json_extract_string(payload, '$.ref') as ref from pushes order by id desc limit 1)""",
)

_add(
    "date_span_7d", "dated",
    """select strftime(day, '%Y-%m-%d') as target_date, count(*)::bigint as event_count,
        concat(strftime(day - interval 6 day, '%Y.%m.%d'), ' - ', strftime(day, '%Y.%m.%d')) as display_span
    from dated group by day""",
)
_PERF7 = f"""
    select os_platform, sum(total_requests)::bigint as total_requests, sum(error_requests)::bigint as error_requests,
        round(sum(error_requests)::double / sum(total_requests) * 100, 2) as error_rate,
        floor(avg(p95_ms) + 0.5)::bigint as p95_latency_ms
    from performance where {_WEEK} group by os_platform"""
_CONV7 = f"""
    select os_platform, case when sum(cart_viewed_count) > 0
        then round(sum(rent_success_count)::double / sum(cart_viewed_count) * 100, 1) else 100.0 end::double
        as funnel_conversion_rate
    from funnel where {_WEEK} group by os_platform"""
_KEY7 = """
    select platform as os_platform, kw as top_keyword, sum(n)::bigint as keyword_count from searches
    where rn <= 5 and day between date '2024-01-25' and date '2024-01-31' and kw <> 'ALL_BOOKS'
        and not regexp_full_match(kw, '[0-9]+')
    group by platform, kw qualify row_number() over (partition by platform order by sum(n) desc, kw) = 1"""
_CRASH7 = f"""
    select os_platform, error_name as top_crash_name, sum(occurrence_count)::bigint as top_crash_count from errors
    where {_WEEK} group by os_platform, error_name
    qualify row_number() over (partition by os_platform order by sum(occurrence_count) desc, error_name) = 1"""
_add("platform_perf_7d", "performance", _PERF7)
_add("platform_conversion_7d", "funnel", _CONV7)
_add("platform_top_keyword_7d", "searches", _KEY7)
_add("platform_top_crash_7d", "errors", _CRASH7)
_add(
    "mobile_snapshot_7d", "performance funnel searches errors",
    f"""select p.os_platform, coalesce(total_requests, 0)::bigint as total_requests, coalesce(error_rate, 0.0) as error_rate,
        coalesce(p95_latency_ms, 0)::bigint as p95_latency_ms,
        coalesce(funnel_conversion_rate, 100.0)::double as funnel_conversion_rate,
        coalesce(top_keyword, 'N/A') as top_keyword,
        coalesce(top_crash_name, 'Zero runtime exceptions captured.') as top_crash_name,
        coalesce(top_crash_count, 0)::bigint as top_crash_count
    from (values ('Android'), ('iOS')) p(os_platform) left join ({_PERF7}) using (os_platform)
        left join ({_CONV7}) using (os_platform) left join ({_KEY7}) using (os_platform)
        left join ({_CRASH7}) using (os_platform)""",
)
_add("incident_active_count", "incidents", "select count(*) filter (status = 'active')::bigint as active_incidents from incidents")
_add(
    "incident_clearance_rate", "incidents",
    """select round(count(*) filter (status = 'resolved')::double / count(*) * 100, 1) as clearance_rate from incidents""",
)
_add(
    "incident_mttr", "incidents",
    """select m as mttr_minutes, case when m is null then '0 m' when m > 60 then concat(m // 60, 'h ', m % 60, 'm')
        else concat(m, 'm') end as avg_mttr
    from (select floor(avg((epoch_us(resolved_at) // 1000000 - epoch_us(created_at) // 1000000) // 60) + 0.5)::bigint as m
        from incidents where status = 'resolved' and resolved_at is not null)""",
)
_add(
    "latest_incident_per_component", "incidents",
    """select component, status, title, strftime(created_at, '%d/%m %H:%M UTC') as created_at from incidents
    where component in ('api-probe', 'ci')
    qualify row_number() over (partition by component order by created_at desc, id) = 1""",
)
_RECENT = 'select * from logs order by "timestamp" desc, id limit'
_add(
    "log_snapshot", "logs",
    f"""select (select count(*)::bigint from logs) as total_logs,
        count(*) filter (level in ('ERROR', 'FATAL'))::bigint as error_count,
        count(distinct nullif(traceId, ''))::bigint as active_traces,
        to_json(list(id order by "timestamp" desc, id)[1:5])::varchar as recent_logs
    from ({_RECENT} 50)""",
)
_add(
    "log_platform_share", "logs",
    "select "
    + ", ".join(
        f"floor(count(*) filter (platform = '{p}') * 100.0::double / greatest(count(*), 1) + 0.5)::bigint as pct_{p}"
        for p in ("backend", "android", "ios")
    )
    + f" from ({_RECENT} 5)",
)
_add(
    "log_lines", "logs",
    """select id, level, concat(prefix, case when length(message) > 66 - length(prefix)
            then concat(substr(message, 1, 63 - length(prefix)), '...') else message end) as line,
        strftime("timestamp", '%H:%M:%S') as at
    from (select *, concat('[', platform, '::', coalesce(nullif(substr(traceId, 1, 4), ''), '----'), '] ') as prefix from logs)""",
)
_add(
    "latest_scale", "stats",
    f"""select {_at('"timestamp"')} as "timestamp", books, users, loans, reviews, review_images,
        concat(printf('%.1f', round(case when books > 0 then loans::double / books * 100 else 0 end, 1)), '%') as utilization,
        printf('%.2f', round(case when reviews > 0 then review_images::double / reviews else 0 end, 2)) as media_density,
        printf('%.2f', round(case when users > 0 then reviews::double / users else 0 end, 2)) as engagement
    from stats order by stats."timestamp" desc, books desc, loans desc limit 1""",
)
_add(
    "latest_runtime_unpivot", "gauges",
    """select unnest(['process.cpu.usage', 'jvm.memory.used', 'spring.security.http.secured.requests',
            'hikaricp.connections.active', 'process.uptime']) as metric_name,
        unnest([cpu_usage, jvm_memory_used, http_requests, active_db_connections, uptime]) as metric_value
    from (select * from gauges order by "timestamp" desc, http_requests desc limit 1)""",
)
_add(
    "runtime_labels", "gauges",
    f"""select {_at('"timestamp"')} as "timestamp",
        case when s <= 0 then '0h' when s >= 86400 then concat(s // 86400, 'd ', s % 86400 // 3600, 'h')
            else concat(s // 3600, 'h') end as uptime,
        concat({_half_up('cpu_usage * 100', 1)}, '%') as cpu,
        concat(floor(jvm_memory_used / 1024 / 1024)::bigint, 'M') as heap,
        format('{{:,}}', floor(http_requests)::bigint) as requests
    from (select *, floor(uptime)::bigint as s from gauges)""",
)
_add(
    "relative_time", "incidents",
    """select id, case when m < 1 then 'Just now' when m < 60 then concat(m, 'm ago')
        when m < 1440 then concat(m // 60, 'h ago') else concat(m // 1440, 'd ago') end as pulse
    from (select id, (epoch_us(timestamp '2001-08-02') - epoch_us(created_at)) // 60000000 as m from incidents)""",
)
_add(
    "log_relative_time", "logs",
    """select id, case when m <= 2 then 'Just Now' else concat(m, 'm ago') end as sync
    from (select id, (epoch_us(timestamp '2024-01-31') // 1000 - epoch_us("timestamp") // 1000) // 60000 as m from logs)""",
)
_add(
    "humanize_count", "usage",
    f"select sample_id, n, {_human('n')} as label from (select sample_id, rows_read * 37 as n from usage)",
)
_add(
    "status_labels", "incidents logs",
    f"""select case when (select count(*) from incidents where status = 'active') > 0 then 'SYSTEM DEGRADED'
            else 'ALL SYSTEMS OPERATIONAL' end as incident_status,
        case when (select count(*) from ({_RECENT} 50) where level in ('ERROR', 'FATAL')) > 0 then 'ERRORS'
            else 'HEALTHY' end as log_status""",
)
_add(
    "keyword_cleanup", "logs",
    "select id, case when level = 'FATAL' then 'N/A' else replace(message, ' ', '') end as keyword from logs",
)

_add(
    "ci_incidents", "steps",
    f"""select f.key as id, 'GITHUB' as source, f.repo as component, 'CRITICAL' as level,
        concat('GitHub CI/CD Pipeline Failure: ', f.workflow_name, ' #', f.run_number) as title, f.message,
        case when s.at is null then 'active' else 'resolved' end as status, {_at('f.updated_at')} as created_at,
        {_at('s.at')} as resolved_at
    from (select * from steps where conclusion = 'failure' and newest = 1) f
    left join (select s.key, min(s.updated_at) as at from steps s join steps l
            on l.key = s.key and l.conclusion = 'failure' and l.newest = 1
            and (s.updated_at, s.run_id) > (l.updated_at, l.run_id)
        where s.conclusion = 'success' group by s.key) s on s.key = f.key""",
)
_add("probe_classify", "classified", "select probe_id, component, problem from classified")
_add("probe_incidents", "outages", f"select {_INCIDENT} from outages")
_add("quota_levels", "levels", "select sample_id, resource, rows_read_24h, level from levels")
_add(
    "quota_incidents", "breach_days",
    f"""select concat('billing-breach-', resource, '-', level, '-', {_day('day')}) as id, 'INFRA' as source,
        concat('billing-', resource) as component, level,
        concat('Read quota at level ', level) as title,
        case when nominal is null or last > nominal then concat({_human('last.n')},
                ' rows read in 24 hours, past the ', level, ' limit.')
            else concat('Back below all limits at ', {_human('nominal.n')}, ' rows in 24 hours.') end as message,
        case when nominal is null then 'active' else 'resolved' end as status, {_at('created_at')} as created_at,
        null::varchar as resolved_at
    from breach_days""",
)
_add(
    "notification_outbox", "steps outages poll_steps",
    f"""select 'trigger' as action, key as dedup_key, concat('[CI/CD Failure] ', repo, ' #', run_number, ' failed!') as summary,
        'github-webhook-pipeline-monitor' as source, 'critical' as severity, message as details, {_at('updated_at')} as at
    from steps where conclusion = 'failure'
    union all
    select 'resolve', key, concat('[CI/CD Fixed] ', repo, ' pipeline recovered in run #', run_number),
        'github-webhook-pipeline-monitor', 'critical', concat('Workflow run #', run_number, ' succeeded for commit: ',
        coalesce(head_message, ''), '. Tracked via token: ', key), {_at('updated_at')}
    from steps where conclusion = 'success' and before = 'failure'
    union all
    select 'trigger', id, concat(component, ': health check failed'), 'probe-fold', 'critical', message, {_at('created_at')}
    from outages
    union all
    select 'resolve', id, concat(component, ': health check passes again'), 'probe-fold', 'critical',
        'A later probe succeeded.', {_at('resolved_at')}
    from outages where resolved_at is not null
    union all
    select 'trigger', concat('billing-quota-breach-', resource, '-', lower(level)),
        concat(level, ': ', {_human('rows_read_24h')}, ' rows read in 24 hours'), 'quota-fold',
        case level when 'WARNING' then 'warning' when 'CRITICAL' then 'error' else 'critical' end,
        {_human('rows_read_24h')}, {_at('sample_ts')}
    from poll_steps where level is not null
    union all
    select 'resolve', concat('billing-quota-breach-', resource, '-', name),
        concat('Below all limits: ', {_human('rows_read_24h')}, ' rows in 24 hours'), 'quota-fold', severity,
        {_human('rows_read_24h')}, {_at('sample_ts')}
    from poll_steps join (values ('warning', 'warning'), ('critical', 'error'), ('fatal', 'critical')) v(name, severity)
        on level is null and before is not null""",
)
_add(
    "active_incident_alert", "incidents",
    """select 'trigger' as action, id as dedup_key, concat('[Mock Chaos] ', title) as summary, 'alert-check' as source,
        case when lower(level) = 'critical' then 'critical' else 'error' end as severity, message as details,
        '2001-08-02 00:00:00' as at
    from incidents where component = 'api-probe' and status = 'active' order by created_at, id limit 1""",
)

_add(
    "upsert_full", "normal endpoints",
    f"""select {_day('day')} as snapshot_date, path as endpoint, method,
        round(avg(latency_ms) filter (method = 'GET' or platform = 'Android'), 2) as avg_latency_ms,
        count(*) filter (method = 'GET' or platform = 'Android')::bigint as call_count
    from normal group by day, path, method having count(*) filter (method = 'GET' or platform = 'Android') > 0""",
)
_BREACH = "concat('breach ', title)"
_add(
    "upsert_partial", "incidents",
    f"""select {_INCIDENT} from (
        select * replace (case when level = 'FATAL' then {_BREACH} else message end as message) from incidents
        union all
        select * replace (concat(id, '-new') as id, {_BREACH} as message, 'active' as status) from incidents
        where level = 'CRITICAL')""",
)
_add(
    "insert_or_replace", "incidents",
    f"""select {_INCIDENT} from (
        select * replace (case when level = 'FATAL' then {_BREACH} else message end as message,
            case when level = 'FATAL' then 'active' else status end as status) from incidents
        union all
        select * replace (concat(id, '-new') as id, {_BREACH} as message, 'active' as status) from incidents
        where level = 'CRITICAL')""",
)
_add(
    "conditional_update", "incidents",
    f"""select {_INCIDENT} from (select * replace (case when open then 'resolved' else status end as status,
            case when open then timestamp '2001-08-02' else resolved_at end as resolved_at)
        from (select *, component = 'api-probe' and status = 'active' as open from incidents))""",
)
_add(
    "insert_incident", "incidents",
    f"""select {_INCIDENT} from incidents union all
    select 'uuid', 'INFRA', 'api-probe', 'CRITICAL', 'Health check failed', 'Connection timeout (5s) - test', 'active',
        '2001-08-02 00:00:00', null""",
)
_add(
    "retain_raw", "mobile metrics",
    """select * from (select 'events' as table_name, id, "timestamp" from mobile union all
        select 'metrics', id, "timestamp" from metrics)
    where "timestamp" >= epoch_us(timestamp '2024-01-28') // 1000""",
)
_add(
    "retain_history", "stats",
    f"""select {_at('"timestamp"')} as "timestamp", books, users from stats where stats."timestamp" >= timestamp '2024-01-11'""",
)

_add(
    "ingest_events", "mobile",
    """select id, case when event_name = 'BOOK_RENT_ACTION' then epoch_us(timestamp '2024-01-31') // 1000 else "timestamp" end
        as "timestamp", platform, event_type, event_name, error_message,
        case when platform = 'Android' then app_version else '1.0.0' end as app_version,
        json(attributes)::varchar as attributes
    from mobile where event_name <> 'USER_SIGNUP' and error_message is distinct from 'E4'""",
)
_add(
    "ingest_events_quarantine", "mobile",
    """select case when error_message = 'E4' then 'malformed_json' else 'missing: event_name' end as reason,
        count(*)::bigint as rejected
    from mobile where event_name = 'USER_SIGNUP' or error_message = 'E4' group by 1""",
)
_add("ingest_api_metrics", "metrics", "select * from metrics where status_code <> 201")
_add(
    "ingest_api_metrics_quarantine", "metrics",
    "select 'missing: status_code' as reason, count(*)::bigint as rejected from metrics where status_code = 201 group by 1",
)
_add(
    "append_webhook_audit", "runs",
    f"""select run_id as id, 'workflow_run' as event_type, action, repository as repository_name,
        author_name as sender_login, case when conclusion <> 'failure' then nullif(workflow_id, 0) end as installation_id,
        {_at('updated_at')} as created_at
    from runs where head_sha is not null""",
)
_add(
    "webhook_audit_quarantine", "runs",
    """select '{not json' as body, 'malformed_json' as reason, count(*)::bigint as rejected from runs
    where head_sha is null group by 1, 2""",
)
_add(
    "extract_ci_runs", "runs",
    f"""select run_id, action, split_part(repository, '/', 2) as repository, workflow_id, workflow_name, run_number, conclusion,
        head_sha, head_message, case when run_id % 3 <> 0 then author_name else concat('login-', author_name) end as author_name,
        html_url, {_at('updated_at')} as updated_at
    from runs where run_id % 50 <> 0""",
)
_add(
    "append_counts_snapshot", "stats",
    f"""select books, users, loans, reviews, review_images, {_at('"timestamp"')} as "timestamp" from stats""",
)
_add(
    "pivot_gauges", "gauges",
    f"""select {_at('t')} as "timestamp", max(case when cpu_usage >= 0.005 then cpu_usage end) as cpu_usage,
        max(jvm_memory_used) as jvm_memory_used, max(http_requests) as http_requests,
        max(active_db_connections) as active_db_connections, max(uptime) as uptime
    from (select *, gauges."timestamp" as t from gauges) group by t""",
)
_add(
    "extract_usage", "usage",
    """select sample_id, case when rows_read > 1000 then rows_read else 0 end as rows_read, rows_written, read_queries
    from usage""",
)
_add(
    "extract_log_page", "logs",
    """select page, case when page % 2 = 0 then n + 1000 else n end as total_logs, id, platform, level, traceId, message
    from (select *, id // 50 as page, count(*) over (partition by id // 50)::bigint as n from logs)""",
)

_SUMMARIES = {
    "summary_api_performance": "performance",
    "summary_business_funnel": "funnel",
    "summary_crash_errors": "errors",
    "summary_screen_visits": "screens",
    "summary_api_endpoints": "endpoints",
}
_add(
    "atomic_batch_write", "performance funnel errors screens endpoints",
    " union all ".join(
        f"select '{name}' as table_name, {_SNAPSHOT}, count(*)::bigint as row_count from {cte} group by snapshot_date"
        for name, cte in _SUMMARIES.items()
    ),
)
_add(
    "route_tagged_stream", "dated normal",
    f"""select 'mobile_telemetry_events' as table_name, {_day('day')} as event_date, platform,
        count(*)::bigint as row_count, count(distinct id)::bigint as id_count
    from dated where event_type <> 'ERROR' group by day, platform
    union all
    select 'mobile_telemetry_api_metrics', {_day('day')}, platform, count(*)::bigint, count(distinct id)::bigint
    from normal group by day, platform""",
)
_add(
    "ingest_to_raw", "dated normal",
    f"""select 'mobile_telemetry_events' as table_name, {_day('day')} as event_date, platform,
        count(*)::bigint as row_count, count(distinct id)::bigint as id_count
    from (select id, platform, case when event_name = 'BOOK_RENT_ACTION' then date '2024-01-31' else day end as day from dated
        where event_name <> 'USER_SIGNUP' and error_message is distinct from 'E4')
    group by day, platform
    union all
    select 'mobile_telemetry_api_metrics', {_day('day')}, platform, count(*)::bigint, count(distinct id)::bigint
    from normal where status_code <> 201 group by day, platform""",
)
# The streams end in the tables the batch queries compute.
for _stream, _batch in (
    ("stream_api_performance", "daily_api_performance"),
    ("stream_endpoint_latency", "daily_endpoint_latency"),
    ("stream_funnel", "daily_funnel"),
    ("stream_errors", "daily_errors"),
    ("stream_screens", "daily_screens"),
    ("stream_ci_incidents", "ci_incidents"),
    ("stream_probe_incidents", "probe_incidents"),
    ("compact_routed", "route_tagged_stream"),
    ("filed_github_metrics", "github_metrics"),
    ("stream_quota_levels", "quota_levels"),
):
    SQL[_stream] = SQL[_batch]
