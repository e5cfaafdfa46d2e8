from datetime import datetime

from beaconlake.operators import ci, reads, snapshots
from beaconlake.schemas import TABLES


def incidents(spark, rows):
    parse = lambda t: t and datetime.fromisoformat(t)
    full = [(str(n), "INFRA", c, "CRITICAL", f"t{n}", None, s, parse(a), parse(b)) for n, (c, s, a, b) in enumerate(rows)]
    return spark.createDataFrame(full, TABLES["incidents"])


def test_mean_time_to_resolve(spark):
    rows = [
        ("api-probe", "active", "2026-06-20 05:10:00", None),
        ("billing", "resolved", "2026-06-19 22:05:00", "2026-06-19 22:15:00"),
    ]
    found = snapshots.incident_summary(incidents(spark, rows)).first()
    assert (found.active_incidents, found.clearance_rate, found.avg_mttr) == (1, 50.0, "10m")


def test_whole_minutes_per_incident(spark):
    rows = [
        ("api-probe", "resolved", "2026-06-16 06:09:01", "2026-06-16 06:12:57"),
        ("billing", "resolved", "2026-06-17 06:04:59", "2026-06-17 06:19:59"),
        ("billing", "resolved", "2026-06-17 06:04:59", None),
    ]
    found = snapshots.incident_summary(incidents(spark, rows)).first()
    assert (found.clearance_rate, found.avg_mttr) == (100.0, "9m")


def test_no_incidents(spark):
    found = snapshots.incident_summary(incidents(spark, [])).first()
    assert (found.active_incidents, found.clearance_rate, found.avg_mttr) == (0, 100.0, "0 m")


def test_latest_incident_breaks_ties_by_id(spark):
    rows = [
        ("b", "active", "2026-01-01 00:00:00", None),
        ("a", "resolved", "2026-01-02 10:30:00", None),
        ("a", "active", "2026-01-02 10:30:00", None),
        ("z", "active", "2026-01-03 00:00:00", None),
    ]
    found = snapshots.latest_incident_per_component(incidents(spark, rows), ["a", "b", "c"]).collect()
    assert [(r.component, r.title, r.created_at) for r in found] == [
        ("a", "t1", "02/01 10:30 UTC"), ("b", "t0", "01/01 00:00 UTC")
    ]


def test_active_incidents_come_first(spark):
    rows = [("a", "resolved", "2026-01-05", None), ("a", "active", "2026-01-01", None), ("a", "active", "2026-01-02", None)]
    assert [r.id for r in reads.latest_incidents(incidents(spark, rows)).collect()] == ["2", "1", "0"]


def test_log_lines_cut_to_the_line_width(spark):
    logs = spark.createDataFrame(
        [
            (1, datetime(2024, 1, 1, 3, 4, 5), "prod", "ios", "INFO", "abcdef", None, "x" * 80, None),
            (2, datetime(2024, 1, 1), "prod", "ios", "INFO", "", None, "short", None),
        ],
        TABLES["log_events"],
    )
    lines = {r.id: r for r in snapshots.log_lines(logs).collect()}
    assert len(lines[1].line) == 66 and lines[1].line.startswith("[ios::abcd] xxx") and lines[1].line.endswith("...")
    assert (lines[2].line, lines[1].at) == ("[ios::----] short", "03:04:05")


def test_zero_denominators(spark):
    row = spark.createDataFrame([(0, 0, 5, 0, 3, datetime(2024, 1, 1))], TABLES["stats_history"])
    found = snapshots.latest_scale(row).first()
    assert (found.utilization, found.media_density, found.engagement) == ("0.0%", "0.00", "0.00")


def test_failed_gauges_read_zero(spark):
    row = spark.createDataFrame([(datetime(2024, 1, 1), None, 2.0, None, 1.0, None)], TABLES["app_metrics2"])
    found = {r.metric_name: r.metric_value for r in snapshots.latest_runtime_unpivot(row).collect()}
    assert found["process.cpu.usage"] == 0.0 and found["jvm.memory.used"] == 2.0 and len(found) == 5


def deliveries(spark, rows):
    full = [(n, kind, None, repo, "u", None, payload, datetime(2024, 1, 15)) for n, (kind, repo, payload) in enumerate(rows)]
    return spark.createDataFrame(full, TABLES["github_app_metrics"])


def test_ci_reads_survive_odd_payloads(spark):
    rows = [
        ("push", "o/a", '{"commits": [{"id": 1}, {"id": 2}], "repository": {"private": false}}'),
        ("push", "o/a", "{broken"),
        ("push", "o/b", '{"head_commit": {"added": ["x"], "modified": null}, "repository": {"private": true}}'),
        ("push", "o/c", '{"commits": []}'),
    ]
    d, as_of = deliveries(spark, rows), datetime(2024, 2, 1)
    assert [tuple(r) for r in ci.repo_activity(d, as_of).collect()] == [("o/a", 2)]
    assert [tuple(r) for r in ci.commit_activity(d, as_of).collect()] == [("2024-01-15", 2)]
    assert [tuple(r) for r in ci.code_growth(d, as_of).collect()] == [("2024-01-15", 1)]
    latest = {r.repository_name: r.payload for r in ci.latest_per_repo(d, ["o/a", "o/c"]).collect()}
    assert latest == {"o/a": None, "o/c": '{"commits": []}'}
    assert ci.github_totals(d).first().ci_success_rate is None


def test_github_metrics_equal_the_four_datasets(spark, data):
    from beaconlake.plans.registry import LANGUAGES, ORDERS_AS_OF
    from beaconlake.sources.derived import table

    d = table(spark, data, "github_app_metrics")
    together = sorted(map(tuple, ci.github_metrics(d, ORDERS_AS_OF, LANGUAGES, "900d").collect()))
    apart = {
        "commit_activity": ci.commit_activity(d, ORDERS_AS_OF, "900d"),
        "code_growth": ci.code_growth(d, ORDERS_AS_OF, "900d"),
        "repo_activity": ci.repo_activity(d, ORDERS_AS_OF, "900d"),
        "language_dist": ci.language_dist(d, ORDERS_AS_OF, LANGUAGES, "900d"),
    }
    assert together == sorted((name, *row) for name, df in apart.items() for row in map(tuple, df.collect()))


def test_the_snapshot_of_one_pass_equals_the_parts(spark, data):
    from pyspark.sql import functions as F

    from beaconlake.operators import rollups
    from beaconlake.sources.derived import table

    as_of = datetime(2024, 1, 20)
    metrics, events = (table(spark, data, f"mobile_telemetry_{name}") for name in ("api_metrics", "events"))
    odd = [
        ("x1", 1705622400000, "Web", None, "login_FAILURE", None, None, None),
        ("x2", 1705622400000, "Web", None, "BOOK_SEARCH", None, None, '{"query_text": " “978” "}'),
        ("x3", 1705622400000, "Web", None, "BOOK_SEARCH", None, None, None),
        ("x4", None, "Web", None, "CART_SCREEN", None, None, None),
        ("x5", 1705622400000, None, None, None, None, None, "broken"),
    ]
    events = events.unionByName(spark.createDataFrame(odd, TABLES["mobile_telemetry_events"]))
    slow = [("y1", 1705622400000, "TV", "/a", "GET", 200, None), ("y2", 1705622400000, "TV", "/a", "GET", None, 7)]
    metrics = metrics.unionByName(spark.createDataFrame(slow, TABLES["mobile_telemetry_api_metrics"]))
    platforms = ["Android", "iOS", "Web", "TV", "none"]
    parts = snapshots.mobile_snapshot_7d(
        rollups.daily_api_performance(metrics), rollups.daily_funnel(events), rollups.daily_errors(events), as_of, platforms
    )
    one = snapshots.mobile_snapshot_of(rollups.daily_figures(metrics, events), as_of, platforms)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, parts.collect()))
    totals = rollups.daily_figures(metrics, events).groupBy("snapshot_date", "os_platform").agg(*(F.sum(c).alias(c) for c in rollups.FUNNEL_COUNTS))
    apart = rollups.daily_funnel(events).select(*totals.columns)
    assert apart.exceptAll(totals).isEmpty()
