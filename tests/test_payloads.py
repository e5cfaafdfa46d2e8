from datetime import datetime

from beaconlake.functions.clock import epoch_ms
from beaconlake.sources import payloads

AS_OF = datetime(2024, 1, 31)


def bodies(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "body string")


def test_event_spellings_and_defaults(spark):
    got = payloads.ingest_events(
        bodies(
            spark,
            '{"id": "1", "platform": "iOS", "eventType": "E", "event_type": "e", "event_name": "n", "timestamp": 5}',
            '{"id": "2", "platform": "iOS", "eventType": null, "event_type": "e", "eventName": "n", "timestamp": 0,'
            ' "appVersion": "2", "attributes": {"b": 1, "a": [true]}, "error_message": "m"}',
        ),
        AS_OF,
    )
    one, two = got.accepted.orderBy("id").collect()
    assert (one.event_type, one.timestamp, one.app_version, one.attributes, one.error_message) == ("E", 5, "1.0.0", None, None)
    assert (two.event_type, two.timestamp, two.app_version, two.error_message) == ("e", epoch_ms(AS_OF), "2", "m")
    assert two.attributes == '{"b":1,"a":[true]}'
    assert got.quarantine.count() == 0


def test_ids_are_generated_when_missing_or_empty(spark):
    body = '"platform": "iOS", "eventType": "E", "eventName": "n"}'
    got = payloads.ingest_events(bodies(spark, "{" + body, '{"id": "", ' + body), AS_OF).accepted.collect()
    assert len({r.id for r in got}) == 2 and all(len(r.id) == 36 for r in got)


def test_rejects_carry_a_reason(spark):
    got = payloads.ingest_events(
        bodies(spark, '{"platform": "", "eventName": "n"}', "{broken", None, "[]"), AS_OF
    )
    reasons = {r.body: r.reason for r in got.quarantine.collect()}
    assert reasons['{"platform": "", "eventName": "n"}'] == "missing: platform,event_type"
    assert reasons["{broken"] == reasons[None] == "malformed_json"
    assert len(reasons) == 4 and got.accepted.count() == 0


def test_metric_spellings(spark):
    got = payloads.ingest_api_metrics(
        bodies(
            spark,
            '{"id": "1", "platform": "iOS", "endpoint": "/x", "method": "GET", "statusCode": 200, "latency_ms": 14.7}',
            '{"id": "2", "platform": "iOS", "endpoint": "/x", "method": "GET", "statusCode": 0, "latencyMs": 0}',
            '{"id": "3", "platform": "iOS", "endpoint": "/x", "method": "GET", "latencyMs": 1}',
        ),
        AS_OF,
    )
    assert [(r.id, r.status_code, r.latency_ms) for r in got.accepted.orderBy("id").collect()] == [("1", 200, 14), ("2", 0, 0)]
    assert [r.reason for r in got.quarantine.collect()] == ["missing: status_code"]


def test_the_payload_is_parsed_once(spark):
    accepted = payloads.ingest_events(bodies(spark, "{}"), AS_OF).accepted
    plan = accepted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_usage_defaults_to_zero(spark):
    sums = '{"data":{"viewer":{"accounts":[{"d1AnalyticsAdaptiveGroups":[{"sum":%s}]}]}}}'
    got = payloads.extract_usage(
        bodies(spark, sums % '{"rowsRead": 12, "readQueries": 3.0}', '{"data": null}', "{broken", None)
    )
    assert [tuple(r) for r in got.collect()] == [(12, 0, 3), (0, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_log_pages(spark):
    line = '{"id": 1, "timestamp": "2024-01-02T03:04:05Z", "level": "INFO", "message": "m"}'
    got = payloads.extract_log_page(
        bodies(
            spark, f'{{"content": [{line}, {line}], "totalElements": 9}}', f'{{"content": [{line}], "totalElements": 0}}',
            '{"content": []}', "{}",
        )
    ).collect()
    assert sorted((r.total_logs, r.id) for r in got if r.id) == [(1, 1), (9, 1), (9, 1)]
    assert [r.total_logs for r in got if r.id is None] == [0, 0]
    assert {r.timestamp for r in got if r.id} == {datetime(2024, 1, 2, 3, 4, 5)}


def test_gauges(spark):
    at = datetime(2024, 1, 1)
    polls = spark.createDataFrame(
        [
            (at, "process.cpu.usage", '{"measurements": [{"statistic": "VALUE", "value": 0.5}, {"statistic": "X", "value": 9}]}'),
            (at, "spring.security.http.secured.requests", '{"measurements": [{"statistic": "TOTAL", "value": 1}, {"statistic": "COUNT", "value": 7}]}'),
            (at, "jvm.memory.used", None),
            (at, "process.uptime", '{"measurements": []}'),
        ],
        "polled_at timestamp, name string, body string",
    )
    row = payloads.pivot_gauges(polls).first()
    assert (row.cpu_usage, row.http_requests, row.jvm_memory_used, row.uptime, row.active_db_connections) == (0.5, 7.0, None, 0.0, None)


def test_webhook_audit(spark):
    deliveries = spark.createDataFrame(
        [
            (1, "push", '{"action": "", "repository": {"full_name": "o/r"}, "installation": {"id": 0}}', AS_OF),
            (2, "push", "{broken", AS_OF),
            (3, "push", None, AS_OF),
        ],
        "id bigint, event_type string, body string, created_at timestamp",
    )
    got = payloads.webhook_audit(deliveries)
    row = got.accepted.first()
    assert (row.action, row.repository_name, row.sender_login, row.installation_id) == (None, "o/r", None, None)
    assert got.accepted.count() == 1 and got.quarantine.count() == 2


def test_texts_that_look_empty_are_kept(spark):
    body = '{"platform": "iOS", "eventType": "E", "eventName": "n", "attributes": %s}'
    values = ['"0"', '"false"', "0", "false", '""', "null", '{"a":0}']
    bodies = spark.createDataFrame([(body % v,) for v in values], "body string")
    found = payloads.ingest_events(bodies, datetime(2024, 1, 1)).accepted
    assert sorted(r.attributes for r in found.collect() if r.attributes is not None) == ["0", "false", '{"a":0}']


def test_whole_numbers_may_be_written_as_decimals(spark):
    body = '{"platform": "iOS", "endpoint": "/x", "method": "GET", "statusCode": %s, "latencyMs": 5.0}'
    bodies = spark.createDataFrame([(body % v,) for v in ("200.0", '"x"')], "body string")
    found = payloads.ingest_api_metrics(bodies, datetime(2024, 1, 1))
    assert [r.status_code for r in found.accepted.collect()] == [200]
    assert [r.reason for r in found.quarantine.collect()] == ["invalid: status_code"]


def test_ci_runs_fall_back_and_skip_other_events(spark):
    run = '{"action": "completed", "workflow": {"id": 7}, "workflow_run": {"id": 1, "run_number": 2, "conclusion": "failure", %s}}'
    rows = [
        ("workflow_run", run % '"repository": {"name": "api"}, "actor": {"login": "ann"}, "updated_at": "2024-01-01T02:03:04Z"'),
        ("workflow_run", run % '"head_commit": {"id": "abc", "author": {"name": "bob"}}, "updated_at": "2024-01-01 02:03:04"'),
        ("push", run % '"name": "x"'), ("workflow_run", '{"action": "completed", "workflow": {"id": 7}}'), ("workflow_run", None),
        ("workflow_run", "{broken"),
    ]
    found = payloads.ci_runs(spark.createDataFrame(rows, "event_type string, body string")).orderBy("repository").collect()
    assert [(r.repository, r.author_name, r.workflow_id, r.head_sha) for r in found] == [(None, "bob", 7, "abc"), ("api", "ann", 7, None)]
    assert {r.updated_at for r in found} == {datetime(2024, 1, 1, 2, 3, 4)}
