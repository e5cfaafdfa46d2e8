"""Declared schemas of the stored tables, as DDL. Readers never infer."""

from __future__ import annotations

TABLES = {
    "mobile_telemetry_events": """
        id string, timestamp bigint, platform string, event_type string, event_name string,
        error_message string, app_version string, attributes string""",
    "mobile_telemetry_api_metrics": """
        id string, timestamp bigint, platform string, endpoint string, method string,
        status_code int, latency_ms int""",
    "incidents": """
        id string, source string, component string, level string, title string, message string,
        status string, created_at timestamp, resolved_at timestamp""",
    "github_app_metrics": """
        id bigint, event_type string, action string, repository_name string, sender_login string,
        installation_id bigint, payload string, created_at timestamp""",
    "stats_history": """
        books bigint, users bigint, loans bigint, reviews bigint, review_images bigint, timestamp timestamp""",
    "app_metrics2": """
        timestamp timestamp, cpu_usage double, jvm_memory_used double, http_requests double,
        active_db_connections double, uptime double""",
    "summary_api_performance": """
        snapshot_date date, os_platform string, p50_ms bigint, p95_ms bigint, p99_ms bigint,
        total_requests bigint, error_requests bigint""",
    "summary_api_endpoints": """
        snapshot_date date, endpoint string, method string, avg_latency_ms double, call_count bigint""",
    "summary_business_funnel": """
        snapshot_date date, os_platform string, scan_opened_count bigint, scan_success_count bigint,
        scan_miss_count bigint, cart_viewed_count bigint, rent_success_count bigint,
        top_searched_keywords array<struct<keyword: string, count: bigint>>""",
    "summary_crash_errors": """
        snapshot_date date, os_platform string, error_name string, occurrence_count bigint""",
    "summary_screen_visits": """
        snapshot_date date, os_platform string, screen_name string, visit_count bigint""",
    "log_events": """
        id bigint, timestamp timestamp, environment string, platform string, level string,
        traceId string, tag string, message string, stackTrace string""",
}

SUMMARY_KEYS = {
    "summary_api_performance": ["snapshot_date", "os_platform"],
    "summary_api_endpoints": ["snapshot_date", "endpoint", "method"],
    "summary_business_funnel": ["snapshot_date", "os_platform"],
    "summary_crash_errors": ["snapshot_date", "os_platform", "error_name"],
    "summary_screen_visits": ["snapshot_date", "os_platform", "screen_name"],
}
