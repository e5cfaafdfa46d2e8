from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from beaconlake.functions.clock import epoch_ms
from beaconlake.operators import rollups
from beaconlake.plans import jobs
from beaconlake.plans.publish import ConflictingRuns, Store, folder_names
from beaconlake.sources import payloads
from beaconlake.sources.derived import table
from beaconlake.sources.tables import read_raw, read_table


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def rows(df):
    return sorted(map(str, df.collect()))


def test_nothing_is_visible_before_publish(spark, store):
    run = store.begin()
    run.stage("t", spark.range(3))
    assert store.read("t") is None
    run.publish()
    assert store.read("t").count() == 3


def test_a_run_that_died_leaves_no_trace(spark, store):
    first = store.begin()
    first.stage("t", spark.range(3))
    first.publish()
    store.begin().stage("t", spark.range(100))
    # A manifest without its success marker is a publish that died.
    spark.createDataFrame([("table", "t", "", "t/version=2")], "kind string, name string, part string, path string").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).json(f"{store.root}/manifest/version=2")
    assert store.read("t").count() == 3
    again = store.begin()
    again.stage("t", spark.range(5))
    again.publish()
    assert store.read("t").count() == 5


def test_dated_tables_replace_only_their_dates(spark, store):
    def day(d, v):
        return spark.createDataFrame([(d, v)], "d date, v int") if v else spark.createDataFrame([], "d date, v int")

    one, two = datetime(2024, 1, 1).date(), datetime(2024, 1, 2).date()
    for df in (day(one, 1).unionByName(day(two, 2)), day(two, 3), day(one, 0)):
        run = store.begin()
        run.stage("t", df, "d")
        run.publish()
    assert sorted(map(tuple, store.read("t").select("d", "v").collect())) == [(one, 1), (two, 3)]
    assert store.read("t", ["d=2024-01-02"]).first().v == 3 and store.read("t", ["d=2024-01-09"]) is None


def test_nightly_runs_day_by_day_equal_one_run(spark, store, data, tmp_path):
    raw = {
        "events": table(spark, data, "mobile_telemetry_events"),
        "metrics": table(spark, data, "mobile_telemetry_api_metrics"),
    }
    for day in (2, 3, 3):
        assert jobs.nightly_for(store, raw, datetime(2024, 1, day)) == []
    other = Store(spark, str(tmp_path / "other"))
    jobs.nightly(other, raw, datetime(2024, 1, 1), datetime(2024, 1, 3))
    for name, *_ in jobs.NIGHTLY:
        columns = sorted(store.read(name).columns)
        assert rows(store.read(name).select(columns)) == rows(other.read(name).select(columns)) != []


def test_a_failing_rollup_does_not_stop_the_others(spark, store, data):
    def broken(raw, since, until):
        raise RuntimeError("no input")

    raw = {"metrics": table(spark, data, "mobile_telemetry_api_metrics")}
    work = [("summary_crash_errors", "metrics", broken), ("summary_api_performance", "metrics", rollups.daily_api_performance)]
    assert jobs.nightly(store, raw, datetime(2024, 1, 1), datetime(2024, 1, 2), work) == ["summary_crash_errors"]
    assert store.read("summary_api_performance").count() == 2 and store.read("summary_crash_errors") is None


def test_expiry_drops_whole_dates_and_keeps_the_cutoff_day(spark, data, tmp_path):
    path = str(tmp_path / "raw")
    raw = table(spark, data, "mobile_telemetry_events")
    jobs.append_raw(raw, path)
    kept_before = raw.where(F.col("timestamp") >= epoch_ms(datetime(2024, 1, 27))).count()
    expired = jobs.expire_dates(spark, path, datetime(2024, 1, 30, 12), 3)
    assert expired[0] == "event_date=2024-01-01" and expired[-1] == "event_date=2024-01-26"
    assert len(folder_names(spark, path)) == 30 - len(expired) + 1  # and the success marker
    assert read_raw(spark, path, "mobile_telemetry_events").count() == kept_before


def test_daily_job_expires_raw_rows_only_after_success(spark, store, data, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    for name in jobs.RAW_TABLES.values():
        jobs.append_raw(table(spark, data, name), f"{root}/{name}")
    as_of = datetime(2024, 1, 10)
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "NIGHTLY", [("summary_crash_errors", "nowhere", rollups.daily_errors), *jobs.NIGHTLY])
        assert jobs.daily(spark, store, root, as_of) == ["summary_crash_errors"]
    assert "event_date=2024-01-01" in folder_names(spark, f"{root}/mobile_telemetry_events")
    assert jobs.daily(spark, store, root, as_of) == []
    kept = [n for n in folder_names(spark, f"{root}/mobile_telemetry_events") if n.startswith("event_date")]
    assert min(kept) == "event_date=2024-01-07"
    dates = {str(r.snapshot_date) for r in store.read("summary_api_performance").collect()}
    assert dates == {"2024-01-09"}


def test_half_hourly_job(spark, store):
    usage = '{"data":{"viewer":{"accounts":[{"d1AnalyticsAdaptiveGroups":[{"sum":{"rowsRead":%d}}]}]}}}'
    gauge = '{"measurements": [{"statistic": "VALUE", "value": 0.5}]}'
    for day, reads in ((1, 2500000), (2, 10), (40, 600000), (40, 600000)):  # the last poll is run twice
        at = datetime(2024, 1, 1) + timedelta(days=day)
        jobs.half_hourly(
            spark, store,
            spark.createDataFrame([(at, '{"books": 1, "reviewImage": 2}')], "polled_at timestamp, body string"),
            spark.createDataFrame([(at, "process.uptime", gauge)], "polled_at timestamp, name string, body string"),
            spark.createDataFrame([("main", usage % reads)], "resource string, body string"),
            at,
        )
    sent = sorted((r.action, r.dedup_key, str(r.at)[:10]) for r in store.read("quota_notices").collect())
    assert sent == [
        *(("resolve", f"billing-quota-breach-main-{level}", "2024-01-03") for level in ("critical", "fatal", "warning")),
        ("trigger", "billing-quota-breach-main-critical", "2024-01-02"),
        ("trigger", "billing-quota-breach-main-warning", "2024-02-10"),
    ]
    assert store.read("stats_history").count() == store.read("app_metrics2").count() == 1
    found = {r.id: (r.status, r.message) for r in store.read("quota_incidents").collect()}
    assert found == {
        "billing-breach-main-CRITICAL-2024-01-02": ("resolved", "Back below all limits at 10 rows in 24 hours."),
        "billing-breach-main-WARNING-2024-02-10": (
            "active", "600.0K rows read in 24 hours, past the WARNING limit."
        ),
    }


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_tables_read_with_their_declared_schema(spark, data, tmp_path, fmt):
    written = table(spark, data, "mobile_telemetry_api_metrics").limit(20)
    path = str(tmp_path / fmt)
    written.write.format(fmt).save(path)
    found = read_table(spark, path, "mobile_telemetry_api_metrics", fmt, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    assert dict(found.dtypes) == dict(written.dtypes) and found.count() == 20


def test_unknown_tables_and_formats_are_refused(spark):
    with pytest.raises(ValueError, match="unknown table"):
        read_table(spark, "/nowhere", "t")
    with pytest.raises(ValueError, match="unsupported format"):
        read_table(spark, "/nowhere", "incidents", "xml")


def test_overlapping_runs_both_publish(spark, store):
    first, second = store.begin(), store.begin()
    first.stage("a", spark.range(3))
    second.stage("b", spark.range(5))
    first.publish()
    second.publish()
    assert store.read("a").count() == 3 and store.read("b").count() == 5


def test_overlapping_runs_do_not_overwrite_each_other(spark, store):
    first, second = store.begin(), store.begin()
    first.stage("a", spark.range(3))
    second.stage("a", spark.range(5))
    first.publish()
    with pytest.raises(ConflictingRuns):
        second.publish()
    assert store.read("a").count() == 3


def test_partial_days_are_refused(store):
    with pytest.raises(ValueError, match="whole UTC days"):
        jobs.nightly(store, {}, datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 12))


def test_dates_before_any_century_expire(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [("a", 0, "iOS"), ("b", None, "iOS"), ("c", epoch_ms(datetime(2024, 1, 9)), "iOS")]
    jobs.append_raw(spark.createDataFrame(rows, "id string, timestamp bigint, platform string"), path)
    assert jobs.expire_dates(spark, path, datetime(2024, 1, 10), 3) == ["event_date=1970-01-01"]
    assert {r.id for r in spark.read.parquet(path).collect()} == {"b", "c"}


def test_superseded_versions_go_after_the_grace_period(spark, store):
    for n in (3, 5):
        run = store.begin()
        run.stage("t", spark.range(n))
        run.publish()
    now = datetime.now(timezone.utc)
    spark.range(1).write.json(f"{store.root}/manifest/_staged-dead")  # a run that died while it published
    assert store.clean(now) == [] and "_staged-dead" in folder_names(spark, f"{store.root}/manifest")
    assert len(store.clean(now + timedelta(days=2))) == 1
    assert not any(name.startswith("_staged") for name in folder_names(spark, f"{store.root}/manifest"))
    assert store.read("t").count() == 5 and len(folder_names(spark, f"{store.root}/t")) == 1


def test_days_do_not_follow_the_session_zone(spark, data, store, tmp_path):
    root = str(tmp_path / "raw")
    expected = rows(rollups.daily_errors(table(spark, data, "mobile_telemetry_events")).select("error_name", F.col("snapshot_date").cast("string")))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in jobs.RAW_TABLES.values():
            jobs.append_raw(table(spark, data, name), f"{root}/{name}")
        raw = read_raw(spark, f"{root}/mobile_telemetry_events", "mobile_telemetry_events")
        found = rollups.daily_errors(raw).select("error_name", F.col("snapshot_date").cast("string"))
        assert rows(found) == expected
        assert jobs.daily(spark, store, root, datetime(2024, 1, 3)) == []
        dates = {r[0] for r in store.read("summary_api_performance").select(F.col("snapshot_date").cast("string")).collect()}
        assert dates == {"2024-01-02"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_webhooks_filed_twice_are_stored_once(spark, tmp_path):
    at = datetime(2024, 1, 2, 3)
    rows = [(1, "push", '{"action": "a", "sender": {"login": "ann"}}', at), (2, "push", "{broken", at)]
    deliveries = spark.createDataFrame(rows, "id bigint, event_type string, body string, created_at timestamp")
    for _ in range(2):
        jobs.append_webhooks(deliveries, str(tmp_path), "poll-1")
    stored = spark.read.parquet(f"{tmp_path}/github_app_metrics").collect()
    assert [(r.id, r.sender_login, str(r.event_date)) for r in stored] == [(1, "ann", "2024-01-02")]
    assert [r.reason for r in spark.read.parquet(f"{tmp_path}/quarantined_webhooks").collect()] == ["malformed_json"]


def test_filed_payloads_are_read_without_a_parse(spark, data, tmp_path, monkeypatch):
    from beaconlake.operators import ci
    from beaconlake.plans.registry import LANGUAGES, ORDERS_AS_OF, OWNER, REPOSITORIES

    deliveries = table(spark, data, "github_app_metrics")
    odd = ['{"ref": "refs/tags/v2", "commits": null, "head_commit": {"added": [1]}}', "[1, 2]", '{"commits": [1, {"a": []}]}', "7"]
    at = datetime(2001, 1, 1)
    extra = [(10**9 + n, "push", None, "acme/api", "ann", None, body, at) for n, body in enumerate(odd)]
    deliveries = deliveries.unionByName(spark.createDataFrame(extra, deliveries.schema))
    jobs.append_webhooks(deliveries.withColumnRenamed("payload", "body"), str(tmp_path), "1")
    filed = jobs.filed_webhooks(spark, str(tmp_path))
    # the derived rows name their repository beside the payload; a filed row takes it from there
    filed = filed.drop("repository_name", "sender_login").join(deliveries.select("id", "repository_name", "sender_login"), "id")
    reads_ = {
        "metrics": lambda rows: ci.github_metrics(rows, ORDERS_AS_OF, LANGUAGES, "all_time"),
        "totals": ci.github_totals,
        "push": lambda rows: ci.latest_push(rows, OWNER),
        "latest": lambda rows: ci.latest_per_repo(rows, REPOSITORIES).drop("payload", "event_type", "action"),
    }
    for name, read in reads_.items():
        found, text = read(filed), read(filed)._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in text and "parse_json" not in text and "get_json" not in text, name
        assert sorted(map(str, found.collect())) == sorted(map(str, read(deliveries).select(*found.columns).collect())), name
    audit = payloads.webhook_audit(deliveries.withColumnRenamed("payload", "body")).accepted
    assert audit._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_ten_minute_job(spark, store):
    schema = "probe_id bigint, probe_ts timestamp, component string, http_status int, body_status string, error string"
    for n, status in enumerate((503, 503, 200)):
        at = datetime(2024, 1, 1, 0, 10 * n)
        jobs.ten_minutely(store, spark.createDataFrame([(n, at, "api", status, "UP", None)], schema), at, "api")
    assert [(r.action, r.at.minute) for r in store.read("probe_incidents_notices").orderBy("at").collect()] == [("trigger", 0), ("resolve", 20)]
    assert sorted(r.at.minute for r in store.read("alerts").collect()) == [10, 20]
    assert [r.status for r in store.read("probe_incidents").collect()] == ["resolved"]
