"""Incident folds against a sequential replay of the same rows, on data with bursts, gaps and equal times."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from beaconlake.operators import incidents as folds
from beaconlake.operators.ordered import rolling_sum, with_neighbours
from beaconlake.schemas import TABLES

START = datetime(2024, 1, 1)


def times(rng, n):
    """Ascending times with ties, gaps longer than a slice, and slice borders."""
    at, out = START, []
    for _ in range(n):
        at += rng.choice([timedelta(0), timedelta(microseconds=1), timedelta(minutes=7), timedelta(hours=1), timedelta(hours=30)])
        out.append(at)
    return out


@pytest.mark.parametrize("width", [timedelta(minutes=10), timedelta(hours=1), timedelta(days=400)])
def test_neighbours_equal_a_scan(spark, width):
    rng = random.Random(1)
    rows = []
    for key in "abc":
        # Key c holds most of the rows.
        n = 300 if key == "c" else 40
        rows += [(key, at, i, rng.choice([None, None, i])) for i, at in enumerate(times(rng, n))]
    df = spark.createDataFrame(rows, "k string, t timestamp, i int, v int")
    found = with_neighbours(df, ["k"], ["t", "i"], previous=F.col("v"), following=F.col("v"), width=width)
    got = {(r.k, r.i): (r.previous, r.following) for r in found.collect()}
    want = {}
    for key in "abc":
        mine = [r for r in rows if r[0] == key]
        for n, r in enumerate(mine):
            before = [x[3] for x in mine[:n] if x[3] is not None]
            after = [x[3] for x in mine[n + 1 :] if x[3] is not None]
            want[(key, r[2])] = (before[-1] if before else None, after[0] if after else None)
    assert got == want


@pytest.mark.parametrize("width", [timedelta(hours=1), timedelta(hours=24)])
def test_rolling_sum_equals_a_scan(spark, width):
    rng, span = random.Random(2), timedelta(hours=24)
    rows = [(k, at, i, rng.choice([None, 1, 10, 1000])) for k in "ab" for i, at in enumerate(times(rng, 150))]
    # Exactly one span apart, and one microsecond more.
    rows += [("e", START, 0, 1), ("e", START + span, 1, 2), ("e", START + span + timedelta(microseconds=1), 2, 4)]
    df = spark.createDataFrame(rows, "k string, t timestamp, i int, v int")
    got = {(r.k, r.i): r.rolling for r in rolling_sum(df, ["k"], "t", "v", span, width).collect()}
    want = {(k, i): sum(v or 0 for k2, at2, _, v in rows if k2 == k and at - span <= at2 <= at) for k, at, i, _ in rows}
    assert got == want and got[("e", 1)] == 3 and got[("e", 2)] == 6


def test_span_must_be_whole_slices(spark):
    df = spark.createDataFrame([("a", START, 1)], "k string, t timestamp, v int")
    with pytest.raises(ValueError, match="multiple"):
        rolling_sum(df, ["k"], "t", "v", timedelta(minutes=90))


PROBE = "probe_id bigint, probe_ts timestamp, component string, http_status int, body_status string, error string"


def probe_rows(seed, n=200):
    rng = random.Random(seed)
    kinds = [(200, "UP", None), (200, "UP", None), (503, None, None), (200, "DOWN", None), (None, None, "timeout"), (None, None, "refused")]
    return [(i, at, f"svc-{i % 2}", *rng.choice(kinds)) for i, at in enumerate(times(rng, n))]


def replay_probes(rows):
    opened, out = {}, []
    for _, at, component, status, body, error in rows:
        healthy = status == 200 and body == "UP"
        if not healthy and component not in opened:
            opened[component] = [component, at, None]
            out.append(opened[component])
        elif healthy and component in opened:
            opened.pop(component)[2] = at
    return sorted(map(tuple, out), key=str)


def test_probe_incidents_equal_replay(spark):
    rows = probe_rows(3)
    found = folds.probe_incidents(spark.createDataFrame(rows, PROBE)).collect()
    assert sorted(((r.component, r.created_at, r.resolved_at) for r in found), key=str) == replay_probes(rows)
    assert len({r.id for r in found}) == len(found)
    assert all((r.status == "active") == (r.resolved_at is None) for r in found)


def test_probe_messages(spark):
    rows = [
        (0, START, "a", 200, "UP", None),
        (1, START, "a", 301, None, None),
        (2, START, "a", 200, "DOWN", None),
        (3, START, "a", 200, None, None),
        (4, START, "a", None, None, "timeout"),
        (5, START, "a", None, None, "refused"),
    ]
    found = folds.probe_classify(spark.createDataFrame(rows, PROBE)).orderBy("probe_id").collect()
    assert [r.problem for r in found] == [
        None, "HTTP Server Error: 301", "Health endpoint answered DOWN", "Health endpoint answered undefined",
        "Connection timeout (10s)", "refused",
    ]


RUN = (
    "run_id bigint, action string, repository string, workflow_id bigint, workflow_name string, run_number bigint,"
    " conclusion string, head_sha string, head_message string, author_name string, html_url string, updated_at timestamp"
)


def run_rows(seed, n=300):
    rng = random.Random(seed)
    return [
        (
            i, rng.choice(["completed", "completed", "requested"]), f"o/r{rng.choice([0, 0, 0, 1])}", rng.randrange(2), "w", i,
            rng.choice(["failure", "success", "cancelled"]), None, None, None, "u", at,
        )
        for i, at in enumerate(times(rng, n))
    ]


def replay_runs(rows):
    table, notices = {}, []
    for run_id, action, repo, workflow, _, number, conclusion, *_, at in rows:
        key = f"gh-pipeline-{repo[2:]}-{workflow}"
        if action != "completed":
            continue
        if conclusion == "failure":
            table[key] = [key, "active", at, None, number]
            notices.append(("trigger", key, at))
        elif conclusion == "success" and key in table and table[key][1] == "active":
            table[key][1], table[key][3] = "resolved", at
            notices.append(("resolve", key, at))
    return sorted(map(tuple, table.values()), key=str), sorted(notices, key=str)


def test_ci_incidents_equal_replay(spark):
    rows = run_rows(4)
    moves = folds.ci_transitions(spark.createDataFrame(rows, RUN))
    table, notices = replay_runs(rows)
    found = folds.ci_incidents(moves).collect()
    got = [(r.id, r.status, r.created_at, r.resolved_at, int(r.title.rsplit("#")[-1])) for r in found]
    assert sorted(got, key=str) == table
    outbox = [(r.action, r.dedup_key, r["at"]) for r in folds.ci_outbox(moves).collect()]
    assert sorted(outbox, key=str) == notices
    assert found[0].message.startswith("Commit 'No commit message' (unknown) by unknown triggered a failure in run #")


def test_quota_incidents_equal_replay(spark):
    rng = random.Random(5)
    rows = [(i, at, "db", rng.choice([0, 300000, 900000, 2500000])) for i, at in enumerate(times(rng, 250))]
    df = spark.createDataFrame(rows, "sample_id bigint, sample_ts timestamp, resource string, rows_read bigint")
    levels = folds.quota_levels(df)
    polls = sorted(((r.sample_ts, r.sample_id, r.rows_read_24h, r.level) for r in levels.collect()))
    assert {p[3] for p in polls} == {None, "WARNING", "CRITICAL", "FATAL"}
    table = {}
    for at, _, reads, level in polls:
        if level:
            key = f"billing-breach-db-{level}-{at:%Y-%m-%d}"
            row = table.setdefault(key, [key, "active", at, None])
            row[3] = ("breach", reads)
        else:
            for row in table.values():
                if row[1] == "active":
                    row[1], row[3] = "resolved", ("nominal", reads)
    found = folds.quota_incidents(levels)
    assert sorted((r.id, r.status, r.created_at) for r in found.collect()) == sorted(tuple(v[:3]) for v in table.values())
    kinds = {r.id: "breach" if "past the" in r.message else "nominal" for r in found.collect()}
    assert kinds == {key: row[3][0] for key, row in table.items()}
    assert found.where("resolved_at is not null").count() == 0

    outbox = folds.quota_outbox(levels)
    ends = sum(1 for a, b in zip(polls, polls[1:]) if a[3] and not b[3])
    assert outbox.where("action = 'trigger'").count() == sum(1 for p in polls if p[3])
    assert outbox.where("action = 'resolve'").count() == 3 * ends


def test_applying_polls_one_by_one_equals_the_fold(spark):
    rng = random.Random(6)
    rows = [(i, at, "db", rng.choice([0, 400000, 1500000])) for i, at in enumerate(times(rng, 12))]
    df = spark.createDataFrame(rows, "sample_id bigint, sample_ts timestamp, resource string, rows_read bigint")
    levels = folds.quota_levels(df)
    table = spark.createDataFrame([], TABLES["incidents"])
    for poll in levels.orderBy("sample_ts", "sample_id").collect():
        one = spark.createDataFrame([("db", poll.rows_read_24h)], "resource string, rows_read_24h bigint")
        after = folds.apply_quota_poll(table, one, poll.sample_ts)
        table = spark.createDataFrame(after.collect(), TABLES["incidents"])
    whole = folds.quota_incidents(levels)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, whole.collect())) != []


@pytest.mark.parametrize("reads, level", [(499999, None), (500000, "WARNING"), (2000000, "CRITICAL"), (4000000, "FATAL")])
def test_quota_tiers(spark, reads, level):
    assert spark.range(1).select(folds.quota_level(F.lit(reads))).first()[0] == level


def test_alert_repeats_while_active_and_stops_after(spark):
    from beaconlake.operators.sinks import insert_incident, resolve_component
    empty = spark.createDataFrame([], TABLES["incidents"])
    assert folds.active_incident_alert(empty, "api-probe", START).count() == 0
    # Materialised, since the random id is drawn anew whenever the plan runs.
    opened = spark.createDataFrame(
        insert_incident(empty, "INFRA", "api-probe", "Critical", "Down", "m", START).collect(), TABLES["incidents"]
    )
    alert = folds.active_incident_alert(opened, "api-probe", START).first()
    assert (alert.severity, alert.dedup_key) == ("critical", opened.first().id)
    closed = resolve_component(opened, "api-probe", START)
    assert folds.active_incident_alert(closed, "api-probe", START).count() == 0
    assert closed.first().resolved_at == START


def test_a_null_component_is_one_component(spark):
    at = [START + timedelta(hours=n) for n in range(5)]
    rows = [(n, at[n], c, 503, None, None) for n in range(5) for c in (None, "x")]
    opened = folds.probe_incidents(spark.createDataFrame(rows, PROBE)).groupBy("component").count().collect()
    assert {r.component: r["count"] for r in opened} == {None: 1, "x": 1}
