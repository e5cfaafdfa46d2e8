"""Streams fed in many batches, with duplicates, replays and late rows, against one batch run."""

import json
import random
import shutil
from collections import Counter
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from test_incidents import PROBE, RUN, probe_rows, replay_probes, replay_runs, run_rows, times

from beaconlake.functions.clock import epoch_ms
from beaconlake.operators import incidents as folds
from beaconlake.operators import rollups
from beaconlake.plans import jobs
from beaconlake.plans.publish import Store
from beaconlake.sources import payloads
from beaconlake.sources.derived import table
from beaconlake.sources.tables import stream_table
from beaconlake.streaming import incidents as incident_streams
from beaconlake.streaming import quota as quota_streams
from beaconlake.streaming import rollups as rollup_streams
from beaconlake.streaming.ingest import compact, drop_landed, filed_to, read_routed, route_tagged_stream, tagged_messages

DRAIN = {"availableNow": True}


def feed(spark, path, batches, first=0):
    """One file per batch, read one file at a time in order of their names."""
    for n, df in enumerate(batches, first):
        df.coalesce(1).write.mode("append").parquet(f"{path}/{n:03d}")
    schema = batches[0].schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_rollup_stream_counts_late_rows_once(spark, data, tmp_path):
    raw = table(spark, data, "mobile_telemetry_api_metrics").persist()
    # Batches cut across days, so most days receive rows in every batch.
    batches = [raw.where(F.pmod(F.xxhash64("id"), F.lit(4)) == n) for n in range(4)]
    store = Store(spark, str(tmp_path / "store"))
    stream = feed(spark, str(tmp_path / "in"), batches)
    for _ in range(2):  # a restart finds nothing to do
        query = rollup_streams.maintain(
            stream, rollup_streams.METRIC_PARTS, store, "metrics", str(tmp_path / "checkpoint"), DRAIN
        )
        query.awaitTermination()
    assert query.exception() is None
    assert rows(rollup_streams.api_performance(store)) == rows(rollups.daily_api_performance(raw))
    assert rows(rollup_streams.endpoint_latency(store)) == rows(rollups.daily_endpoint_latency(raw))


def test_a_batch_writes_what_it_adds_and_crowded_dates_are_merged(spark, data, tmp_path):
    raw = table(spark, data, "mobile_telemetry_events").where(F.col("timestamp") < epoch_ms(datetime(2024, 1, 4))).persist()
    batches = [raw.where(F.pmod(F.xxhash64("id"), F.lit(6)) == n) for n in range(6)]
    parts = {"part_screens": rollup_streams.EVENT_PARTS["part_screens"]}
    each = Counter(str(r.snapshot_date) for b in batches for r in rollups.daily_screens(b).select("snapshot_date").distinct().collect())
    assert max(each.values()) > 3
    for name, most, expected in (("plain", 64, each), ("merged", 2, None)):
        store = Store(spark, str(tmp_path / name))
        stream = feed(spark, str(tmp_path / f"{name}-in"), batches)
        rollup_streams.maintain(stream, parts, store, "events", str(tmp_path / f"{name}-checkpoint"), DRAIN, most).awaitTermination()
        assert rows(rollup_streams.screens(store)) == rows(rollups.daily_screens(raw))
        folders = Counter(p.removeprefix("part=").split("~")[0] for p in store.begin().parts("part_screens"))
        if expected:
            # one folder of each date for each batch, with the rows of that batch alone
            assert folders == expected
            for path in Path(store.root, "part_screens").glob("version=*"):
                stored = spark.read.parquet(str(path)).agg(F.sum("visit_count")).first()[0]
                assert stored < raw.where(F.col("event_name").ilike("%_SCREEN")).count() / 3
        else:
            assert max(folders.values()) <= most + 1


def test_a_replayed_batch_adds_nothing(spark, data, tmp_path):
    raw = table(spark, data, "mobile_telemetry_events")
    store = Store(spark, str(tmp_path / "store"))
    stream = feed(spark, str(tmp_path / "in"), [raw])
    # A lost checkpoint makes the stream deliver batch 0 again.
    for attempt in range(2):
        rollup_streams.maintain(
            stream, rollup_streams.EVENT_PARTS, store, "events", str(tmp_path / f"checkpoint{attempt}"), DRAIN
        ).awaitTermination()
    assert rows(rollup_streams.errors(store)) == rows(rollups.daily_errors(raw))
    assert rows(rollup_streams.screens(store)) == rows(rollups.daily_screens(raw))
    assert rows(rollup_streams.funnel(store)) == rows(rollups.daily_funnel(raw))


@pytest.mark.parametrize("pieces", [1, 5])
def test_probe_stream_equals_replay(spark, tmp_path, pieces):
    data = probe_rows(7, 150)
    size = len(data) // pieces
    batches = [spark.createDataFrame(data[n * size : (n + 1) * size], PROBE) for n in range(pieces)]
    store = Store(spark, str(tmp_path / "store"))
    incident_streams.maintain_probes(
        feed(spark, str(tmp_path / "in"), batches), store, str(tmp_path / "checkpoint"), DRAIN
    ).awaitTermination()
    found = store.read("probe_incidents").collect()
    assert sorted(((r.component, r.created_at, r.resolved_at) for r in found), key=str) == replay_probes(data)
    assert all((r.status == "active") == (r.resolved_at is None) for r in found)
    sent = store.read("probe_incidents_notices")
    whole = folds.probe_outbox(folds.probe_incidents(spark.createDataFrame(data, PROBE)))
    assert rows(sent.select(*folds.NOTICE)) == rows(whole.select(*folds.NOTICE))


@pytest.mark.parametrize("pieces", [1, 6])
def test_ci_stream_equals_replay(spark, tmp_path, pieces):
    data = run_rows(8, 120)
    size = len(data) // pieces
    batches = [spark.createDataFrame(data[n * size : (n + 1) * size], RUN) for n in range(pieces)]
    store = Store(spark, str(tmp_path / "store"))
    incident_streams.maintain_ci(
        feed(spark, str(tmp_path / "in"), batches), store, str(tmp_path / "checkpoint"), DRAIN
    ).awaitTermination()
    found = store.read("ci_incidents").collect()
    got = [(r.id, r.status, r.created_at, r.resolved_at, int(r.title.rsplit("#")[-1])) for r in found]
    assert sorted(got, key=str) == replay_runs(data)[0]


def split(rng, data, pieces):
    """Rows dealt to batches at random; some come twice, in the same batch or a later one."""
    batches = [[] for _ in range(pieces)]
    for row in data:
        batches[rng.randrange(pieces)].append(row)
        if rng.random() < 0.1:
            batches[rng.randrange(pieces)].append(row)
    return [batch for batch in batches if batch]


def notices(df):
    return sorted(map(str, df.select(*folds.NOTICE).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_probes_dealt_to_batches_at_random_equal_one_run(spark, tmp_path, seed):
    data = [*probe_rows(seed, 60), (900, None, "svc-0", 503, None, None), (901, datetime(2024, 1, 2), None, 503, None, None)]
    store = Store(spark, str(tmp_path / "store"))
    for number, batch in enumerate(split(random.Random(seed), data, 5)):
        run = store.begin("probes", number)
        incident_streams.fold_probes(run, spark.createDataFrame(batch, PROBE))
        run.publish()
        found = store.read("probe_incidents").collect()
        assert all(r.resolved_at is None or r.created_at is None or r.resolved_at >= r.created_at for r in found)
    whole = folds.probe_incidents(spark.createDataFrame(data, PROBE)).persist()
    assert rows(store.read("probe_incidents").select(*folds.INCIDENT)) == rows(whole)
    assert rows(store.read("probe_incidents_open").select(*folds.INCIDENT)) == rows(whole.where("status = 'active'"))
    sent = store.read("probe_incidents_notices")
    assert notices(sent) == notices(folds.probe_outbox(whole))
    # what was published once and does not hold any more can be taken back
    gone = store.read("probe_incidents_withdrawn")
    assert gone.count() > 0 and gone.where("action = 'trigger'").join(sent, ["dedup_key", "action", "at"], "left_semi").count() < gone.count()


@pytest.mark.parametrize("seed", [3, 4])
def test_runs_dealt_to_batches_at_random_equal_one_run(spark, tmp_path, seed):
    data = run_rows(seed, 90)
    store = Store(spark, str(tmp_path / "store"))
    for number, batch in enumerate(split(random.Random(seed), data, 5)):
        run = store.begin("runs", number)
        incident_streams.fold_runs(run, spark.createDataFrame(batch, RUN))
        run.publish()
        assert store.read("ci_incidents").where("resolved_at < created_at").count() == 0
    moves = folds.ci_transitions(spark.createDataFrame(data, RUN)).persist()
    assert rows(store.read("ci_incidents").select(*folds.INCIDENT)) == rows(folds.ci_incidents(moves))
    assert notices(store.read("ci_incidents_notices")) == notices(folds.ci_outbox(moves))


def test_a_late_healthy_probe_does_not_end_a_later_outage(spark, tmp_path):
    at = datetime(2024, 1, 1, 3)
    store = Store(spark, str(tmp_path / "store"))
    steps = [
        ([(2, at + timedelta(minutes=10), "a", 503, None, None)], [("active", 10, None)], 0),
        ([(1, at, "a", 200, "UP", None)], [("active", 10, None)], 0),  # before the failure: nothing ends
        ([(3, at + timedelta(minutes=20), "a", 200, "UP", None)], [("resolved", 10, 20)], 0),
        ([(0, at + timedelta(minutes=5), "a", 503, None, None)], [("resolved", 5, 20)], 2),  # the outage began earlier
        ([(4, at + timedelta(minutes=7), "a", 200, "UP", None)], [("resolved", 5, 7), ("resolved", 10, 20)], 3),  # and was two
    ]
    for number, (batch, expected, withdrawn) in enumerate(steps):
        for again in range(2):  # a repeated batch changes nothing
            run = store.begin("probes", 2 * number + again)
            incident_streams.fold_probes(run, spark.createDataFrame(batch, PROBE))
            run.publish()
            found = [
                (r.status, *(None if t is None else (t - at) // timedelta(minutes=1) for t in (r.created_at, r.resolved_at)))
                for r in store.read("probe_incidents").collect()
            ]
            assert sorted(found) == expected
            gone = store.read("probe_incidents_withdrawn")
            assert (0 if gone is None else gone.count()) == withdrawn
    assert notices(store.read("probe_incidents_notices")) == notices(folds.probe_outbox(store.read("probe_incidents").select(*folds.INCIDENT)))


def test_a_poll_run_twice_leaves_one_notice(spark, tmp_path):
    store, at = Store(spark, str(tmp_path / "store")), datetime(2024, 1, 1, 3)
    probes = spark.createDataFrame([(1, at, "a", 503, None, None)], PROBE)
    for _ in range(2):
        jobs.ten_minutely(store, probes, at, "a")
    assert store.read("probe_incidents_notices").count() == 1 and store.read("probe_incidents").count() == 1
    for _ in range(2):
        jobs.ten_minutely(store, probes, at + timedelta(minutes=10), "a")
    assert store.read("alerts").count() == 2  # one each for the run that found it open, and the next


SAMPLE = "sample_id bigint, sample_ts timestamp, resource string, rows_read bigint"


@pytest.mark.parametrize("pieces", [1, 4])
def test_samples_dealt_to_batches_at_random_have_the_levels_of_one_run(spark, tmp_path, pieces):
    rng = random.Random(pieces)
    data = [(i, at, f"db{i % 2}", rng.choice([None, 0, 300000, 900000, 2500000])) for i, at in enumerate(times(rng, 120))]
    # a dense stretch, in which hours a day apart both have samples
    data += [(200 + i, datetime(2025, 1, 1) + i * timedelta(minutes=25), "db0", rng.choice([100000, 200000])) for i in range(150)]
    batches = [[] for _ in range(pieces)]
    for row in data:
        batches[rng.randrange(pieces)].append(row)
    batches[-1].append((999, None, "db0", 5))
    store = Store(spark, str(tmp_path / "store"))
    stream = feed(spark, str(tmp_path / "in"), [spark.createDataFrame(b, SAMPLE) for b in batches])
    provider = spark.conf.get(quota_streams.PROVIDER)
    query = quota_streams.maintain_quota(stream, store, str(tmp_path / "checkpoint"), DRAIN, "1000 days")
    query.awaitTermination()
    assert query.exception() is None and spark.conf.get(quota_streams.PROVIDER) == provider
    columns = ["sample_id", "sample_ts", "resource", "rows_read_24h", "level"]
    whole = folds.quota_levels(spark.createDataFrame(data, SAMPLE))
    assert rows(quota_streams.levels(store).select(columns)) == rows(whole.select(columns))


def test_hours_that_nothing_can_change_leave_the_state(spark, tmp_path):
    start = datetime(2024, 1, 1)
    batches = [[(n, start + timedelta(days=n), "db", 10)] for n in range(8)]
    store = Store(spark, str(tmp_path / "store"))
    stream = feed(spark, str(tmp_path / "in"), [spark.createDataFrame(b, SAMPLE) for b in batches])
    query = quota_streams.maintain_quota(stream, store, str(tmp_path / "checkpoint"), DRAIN, "1 day")
    query.awaitTermination()
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(kept) < 8 * 25 and kept[-1] < 4 * 25 * 2
    # a day apart to the microsecond: both samples count
    assert {r.sample_id: r.rows_read_24h for r in quota_streams.levels(store).collect()} == {0: 10} | {n: 20 for n in range(1, 8)}


def message(tag, id, at=1704067200000, **data):
    return (json.dumps({"queueType": tag, "data": {"id": id, "timestamp": at, **data}}),)


def routed(spark, tmp_path, batches, name="in", **options):
    stream = feed(spark, str(tmp_path / name), [spark.createDataFrame(b, "value string") for b in batches])
    query = route_tagged_stream(stream, str(tmp_path / "raw"), str(tmp_path / "checkpoint"), DRAIN, **options)
    query.awaitTermination()
    assert query.exception() is None
    return str(tmp_path / "raw")


def test_routing_drops_duplicates_and_unknown_tags(spark, tmp_path):
    event = message("EVENT", "1", platform="iOS", eventType="E", eventName="n", attributes='{"a": 1}')
    metric = message("METRIC", "1", platform="iOS", endpoint="/x", method="GET", statusCode=200, latencyMs=5)
    late = message("EVENT", "0", 946684800000, platform="iOS", eventType="E", eventName="old")
    root = routed(spark, tmp_path, [[event, metric, event], [event, message("OTHER", "2")], [late, ("{broken",), ("{broken",)]])
    events = read_routed(spark, root, "mobile_telemetry_events").orderBy("id").collect()
    assert [(r.id, r.event_name, str(r.event_date)) for r in events] == [("0", "old", "2000-01-01"), ("1", "n", "2024-01-01")]
    assert events[1].attributes == '{"a": 1}'
    metrics = read_routed(spark, root, "mobile_telemetry_api_metrics").collect()
    assert [(r.id, r.status_code, r.latency_ms) for r in metrics] == [("1", 200, 5)]
    faults = read_routed(spark, root, "quarantined_messages").collect()
    assert [(r.value, r.reason) for r in faults] == [("{broken", "unreadable")]
    assert read_routed(spark, str(tmp_path / "none"), "mobile_telemetry_events").count() == 0


def test_messages_far_from_their_arrival_are_quarantined(spark, tmp_path):
    now = epoch_ms(datetime.now(timezone.utc))
    batch = [message("EVENT", "1", now), message("EVENT", "2", now - 10 * 86_400_000), message("METRIC", "3", 9 * 10**15)]
    root = routed(spark, tmp_path, [batch], horizon=timedelta(days=7))
    assert [r.id for r in read_routed(spark, root, "mobile_telemetry_events").collect()] == ["1"]
    faults = read_routed(spark, root, "quarantined_messages").collect()
    assert sorted(json.loads(r.value)["data"]["id"] for r in faults) == ["2", "3"]
    assert {r.reason for r in faults} == {"implausible timestamp"}


def files(root, table):
    return [f for f in Path(root).rglob("*.parquet") if any(table in part for part in f.parts)]


def test_a_batch_becomes_visible_with_all_its_tables_or_not_at_all(spark, tmp_path):
    tables = ("mobile_telemetry_events", "mobile_telemetry_api_metrics")
    pairs = [[message("EVENT", str(n)), message("METRIC", str(n))] for n in range(4)]
    root = routed(spark, tmp_path, pairs[:2])

    def visible():
        return [sorted(r.id for r in read_routed(spark, root, t).collect()) for t in tables]

    assert visible() == [["0", "1"]] * 2
    # a batch that has written the files of one table when it stops: they stand there, and nobody reads them
    for f in files(root, tables[0]):
        shutil.copy(f, f.with_name(f"part-9{f.name[6:]}"))
    assert len(files(root, tables[0])) == 2 * len(files(root, tables[1]))
    assert visible() == [["0", "1"]] * 2

    # a batch that fails in one table only: the writer of the metrics meets a row it cannot write
    stream = feed(spark, str(tmp_path / "in"), [spark.createDataFrame(b, "value string") for b in pairs[2:]], 2)
    broken = stream.withColumn("value", F.when(F.col("value").contains("METRIC"), F.raise_error(F.lit("stopped"))).otherwise(F.col("value")))
    query = route_tagged_stream(broken, root, str(tmp_path / "checkpoint"), DRAIN)
    with pytest.raises(Exception, match="stopped"):
        query.awaitTermination()
    assert visible() == [["0", "1"]] * 2
    route_tagged_stream(stream, root, str(tmp_path / "checkpoint"), DRAIN).awaitTermination()
    assert visible() == [["0", "1", "2", "3"]] * 2
    with pytest.raises(ValueError, match="another checkpoint"):
        route_tagged_stream(stream, root, str(tmp_path / "checkpoint2"), DRAIN)


def test_compaction_of_many_batches(spark, tmp_path, monkeypatch):
    day = 86_400_000
    batches = [[message(tag, f"{n}-{i}", 1704067200000 + i * day) for i in range(3) for tag in ("EVENT", "METRIC")] + [("{" + str(n),)] for n in range(6)]
    root = routed(spark, tmp_path, batches)
    tables = ("mobile_telemetry_events", "mobile_telemetry_api_metrics", "quarantined_messages")

    def stored():
        return [rows(read_routed(spark, root, t)) for t in tables]

    before = stored()
    assert [len(t) for t in before] == [18, 18, 6]
    assert len(files(root, tables[0])) >= 18
    assert compact(spark, root) == []  # the date of arrival may still grow
    today = datetime.now(timezone.utc).date()

    # a compaction that stops before its date is entered changes nothing for readers, and is repeated
    with monkeypatch.context() as patch:
        patch.setattr(SparkSession, "createDataFrame", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact(spark, root, through=today)
    assert filed_to(spark, root) is None and stored() == before
    assert compact(spark, root, through=today) == [today] and filed_to(spark, root) == today
    assert stored() == before
    for table in tables[:2]:
        compacted = list(Path(root, table).rglob("*.parquet"))
        assert len(compacted) == 3 and len({f.parent for f in compacted}) == 3
    assert drop_landed(spark, root, today) == []
    assert len(drop_landed(spark, root, today + timedelta(days=1))) == 3 and stored() == before
    assert compact(spark, root, through=today) == []
    with pytest.raises(ValueError, match="are compacted"):
        routed(spark, tmp_path, [[message("EVENT", "late")]], "again")


def test_compacted_files_have_a_set_size(spark, tmp_path):
    root = routed(spark, tmp_path, [[message("EVENT", str(n)) for n in range(90)]])
    compact(spark, root, datetime.now(timezone.utc).date(), rows_per_file=20)
    assert sorted(spark.read.parquet(str(f)).count() for f in Path(root, "mobile_telemetry_events").rglob("*.parquet")) == [10, 20, 20, 20, 20]


def test_finished_dates_are_those_before_the_last(spark, tmp_path):
    """Arrival dates of a running stream: all but the newest are compacted, and the nightly job reads both kinds."""
    root, landing = str(tmp_path / "raw"), str(tmp_path / "raw" / "landing")
    names = ["id", "timestamp", "platform", "event_type", "event_name"]
    arrived = [("1", 1704153600000, "iOS", "E", "A_FAILURE", "2024-01-02"), ("2", 1704153600001, "iOS", "E", "A_FAILURE", "2024-01-03")]
    rows_ = spark.createDataFrame(arrived, f"{', '.join(n + (' long' if n == 'timestamp' else ' string') for n in names)}, arrived_on string")
    filed = rows_.select(
        *names, F.lit("mobile_telemetry_events").alias("table_name"), F.to_date("arrived_on").alias("arrived_on"), F.to_date(F.lit("2024-01-02")).alias("event_date")
    )
    source = feed(spark, str(tmp_path / "in"), [filed])
    source.writeStream.format("parquet").partitionBy("table_name", "arrived_on", "event_date").option(
        "checkpointLocation", str(tmp_path / "checkpoint")
    ).trigger(**DRAIN).start(landing).awaitTermination()
    store = Store(spark, str(tmp_path / "store"))
    assert jobs.daily(spark, store, root, datetime(2024, 1, 3, 4)) == []
    assert filed_to(spark, root) == date(2024, 1, 2)
    assert len(list(Path(root, "mobile_telemetry_events").rglob("*.parquet"))) == 1
    found = store.read("summary_crash_errors").collect()
    assert [(str(r.snapshot_date), r.error_name, r.occurrence_count) for r in found] == [("2024-01-02", "A_FAILURE", 2)]


def test_accepted_payloads_are_tagged_and_routed(spark, tmp_path):
    at = datetime(2024, 1, 5)
    bodies = [('{"platform":"iOS","event_type":"E","eventName":"n","attributes":{"a":1},"id":"7","timestamp":1704067200000}',), ('{"platform":1}',)]
    events = payloads.ingest_events(spark.createDataFrame(bodies, "body string"), at).accepted
    body = '{"platform":"iOS","endpoint":"/x","method":"GET","status_code":200,"latencyMs":5,"timestamp":1704067200000}'
    metrics = payloads.ingest_api_metrics(spark.createDataFrame([(body,)], "body string"), at).accepted
    text = tagged_messages(events, "EVENT").unionByName(tagged_messages(metrics, "METRIC"))
    root = routed(spark, tmp_path, [[tuple(r) for r in text.collect()]])
    stored = read_routed(spark, root, "mobile_telemetry_events").drop("event_date")
    assert rows(stored) == rows(events)
    assert read_routed(spark, root, "mobile_telemetry_api_metrics").select("endpoint", "status_code", "latency_ms").first() == ("/x", 200, 5)


def test_stored_tables_stream_with_their_schema(spark, data, tmp_path):
    path = str(tmp_path / "json")
    table(spark, data, "mobile_telemetry_events").limit(10).write.json(path)
    stream = stream_table(spark, path, "mobile_telemetry_events", "json")
    query = stream.writeStream.format("memory").queryName("streamed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("streamed").count() == 10


def test_shared_folder_comes_from_the_session(spark):
    from beaconlake.session import run_dir, shared_dir

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x") and run_dir(spark, "x").startswith(shared_dir(spark))
