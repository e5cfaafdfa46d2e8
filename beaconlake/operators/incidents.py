"""Incident lifecycles folded from probe, usage and CI logs, and the notifications they cause.

Each fold has two steps: transitions (which row opened or closed something), found with sliced ordered lookups, and
the incident table, a plain aggregation of the transitions. Ids derive from the data, so a rerun gives the same rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.functions.clock import DAY, utc, utc_day
from beaconlake.functions.text import humanize_count
from beaconlake.operators.ordered import rolling_sum, slice_window, with_neighbours
from beaconlake.operators.sinks import conditional_update, upsert_partial

INCIDENT = ["id", "source", "component", "level", "title", "message", "status", "created_at", "resolved_at"]
NOTICE = ["action", "dedup_key", "summary", "source", "severity", "details", "at"]

# Rows read within 24 hours that raise each level, and the pager severity of each level.
QUOTA_TIERS = [("FATAL", 4000000), ("CRITICAL", 2000000), ("WARNING", 500000)]
QUOTA_SEVERITY = {"WARNING": "warning", "CRITICAL": "error", "FATAL": "critical"}


# Ids and texts of incidents and notices.
CI_ID = "gh-pipeline-%s-%s"
CI_TITLE = "GitHub CI/CD Pipeline Failure: %s #%s"
CI_MESSAGE = "Commit '%s' (%s) by %s triggered a failure in run #%s. Review logs at: %s"
CI_FAILED = "[CI/CD Failure] %s #%s failed!"
CI_FIXED = "[CI/CD Fixed] %s pipeline recovered in run #%s"
CI_RECOVERED = "Workflow run #%s succeeded for commit: %s. Tracked via token: %s"
CI_SOURCE = "github-webhook-pipeline-monitor"
PROBE_TIMEOUT = "Connection timeout (%s)"
PROBE_HTTP = "HTTP Server Error: %s"
QUOTA_ID = "billing-breach-%s-%s-%s"
QUOTA_DEDUP = "billing-quota-breach-%s-%s"
ALERT_SUMMARY = "[Mock Chaos] %s"

# Wording of this library.
PROBE_STATUS = "Health endpoint answered %s"
PROBE_TITLE = "Health check failed"
PROBE_DOWN = "%s: health check failed"
PROBE_UP = "%s: health check passes again"
PROBE_RECOVERED = "A later probe succeeded."
PROBE_SOURCE = "probe-fold"
QUOTA_TITLE = "Read quota at level %s"
QUOTA_MESSAGE = "%s rows read in 24 hours, past the %s limit."
QUOTA_NOMINAL = "Back below all limits at %s rows in 24 hours."
QUOTA_BREACHED = "%s: %s rows read in 24 hours"
QUOTA_RECOVERED = "Below all limits: %s rows in 24 hours"
QUOTA_SOURCE = "quota-fold"
ALERT_SOURCE = "alert-check"


def _fill(form: str, *values: Column | str) -> Column:
    return F.format_string(form, *(F.col(v) if isinstance(v, str) else v for v in values))


def _or(column: str, instead: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(instead))


# CI runs: one incident per workflow, reopened by every failure, closed by the first success after it.


def ci_rows(runs: DataFrame) -> DataFrame:
    """Finished runs of known workflows, with the ``component`` and ``id`` of their incident."""
    repository = F.substring_index("repository", "/", -1)
    known = F.col("workflow_id").isNotNull() & F.col("repository").isNotNull()
    finished = (F.col("action") == "completed") & F.col("conclusion").isin("failure", "success")
    return runs.where(known & finished).select(
        "*", repository.alias("component"), _fill(CI_ID, repository, "workflow_id").alias("id")
    )


def ci_transitions(runs: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Failures (trigger) and the successes that end one (resolve), in order of (updated_at, run_id).

    ``prior`` holds incidents of earlier batches; a success also resolves one that was still active there.
    """
    return ci_moves(ci_rows(runs), prior)


def ci_moves(relevant: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """``ci_transitions`` of ``ci_rows``; ``previous`` is the conclusion before each."""
    failed, ended = F.col("conclusion") == "failure", F.col("previous") == "failure"
    ordered = with_neighbours(
        relevant, ["id"], ["updated_at", "run_id"], previous=F.col("conclusion"), wanted=failed | ended | F.col("previous").isNull()
    )
    if prior is not None:
        # At most one row per workflow on the prior side, so a busy workflow only repeats, it does not multiply.
        state = prior.select("id", F.when(F.col("status") == "active", "failure").alias("_prior"))
        ordered = ordered.join(state, "id", "left").withColumn("previous", F.coalesce("previous", "_prior")).drop("_prior")
    return ordered.where(failed | ended).withColumn("action", F.when(failed, "trigger").otherwise("resolve"))


def _ci_message() -> Column:
    sha = F.coalesce(F.substring("head_sha", 1, 7), F.lit("unknown"))
    commit, author = _or("head_message", "No commit message"), _or("author_name", "unknown")
    return _fill(CI_MESSAGE, commit, sha, author, "run_number", "html_url")


def ci_incidents(transitions: DataFrame) -> DataFrame:
    """Current incident row per workflow: its last failure, and the success after it if there is one.

    The last transition of each kind is cut out before the shuffle, so a workflow is two rows when they meet.
    """
    newest = [F.col("updated_at").desc(), F.col("run_id").desc()]
    last = F.row_number().over(Window.partitionBy("id", "action").orderBy(*newest))
    two = transitions.withColumn("_rank", last).where("_rank = 1")
    workflow = Window.partitionBy("id").orderBy("updated_at", "run_id")
    two = two.select("*", F.lead("updated_at").over(workflow).alias("_next"), F.count("*").over(Window.partitionBy("id")).alias("_rows"))
    failed = F.col("action") == "trigger"
    closed = F.when(failed, F.col("_next")).otherwise(F.col("updated_at"))
    return two.where(failed | (F.col("_rows") == 1)).select(
        "id",
        F.lit("GITHUB").alias("source"),
        "component",
        F.lit("CRITICAL").alias("level"),
        F.when(failed, _fill(CI_TITLE, "workflow_name", "run_number")).alias("title"),
        F.when(failed, _ci_message()).alias("message"),
        F.when(closed.isNull(), "active").otherwise("resolved").alias("status"),
        F.when(failed, F.col("updated_at")).alias("created_at"),
        closed.alias("resolved_at"),
    )


def ci_outbox(transitions: DataFrame) -> DataFrame:
    failed = F.col("action") == "trigger"
    summary = F.when(failed, _fill(CI_FAILED, "component", "run_number")).otherwise(
        _fill(CI_FIXED, "component", "run_number")
    )
    recovered = _fill(CI_RECOVERED, "run_number", _or("head_message", ""), "id")
    return transitions.select(
        "action",
        F.col("id").alias("dedup_key"),
        summary.alias("summary"),
        F.lit(CI_SOURCE).alias("source"),
        F.lit("critical").alias("severity"),
        F.when(failed, _ci_message()).otherwise(recovered).alias("details"),
        F.col("updated_at").alias("at"),
    )


# Health probes: an incident opens at the first unhealthy probe and closes at the next healthy one.


def probe_classify(probes: DataFrame, timeout: str = "10s") -> DataFrame:
    """Add ``problem``: why a probe counts as unhealthy, NULL when it is healthy."""
    status = F.col("http_status")
    refused = status.isNull() | ~status.between(200, 299)
    problem = (
        F.when(F.col("error") == "timeout", PROBE_TIMEOUT % timeout)
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(refused, _fill(PROBE_HTTP, _or("http_status", "none")))
        .when(~F.col("body_status").eqNullSafe("UP"), _fill(PROBE_STATUS, _or("body_status", "undefined")))
    )
    return probes.withColumn("problem", problem)


def probe_incidents(probes: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """One row per outage: message and time of its first unhealthy probe, resolved by the first healthy one after it.

    With ``prior`` incidents, a component that was already down opens nothing until it has been healthy again.
    """
    healthy = F.col("problem").isNull()
    ordered = with_neighbours(
        probe_classify(probes),
        ["component"],
        ["probe_ts", "probe_id"],
        previous=healthy,
        following=F.when(healthy, F.col("probe_ts")),
        wanted=~healthy & F.coalesce("previous", F.lit(True)),
    )
    if prior is not None:
        down = prior.where(F.col("status") == "active").select("component", F.lit(False).alias("_prior")).distinct()
        ordered = ordered.join(down, "component", "left").withColumn("previous", F.coalesce("previous", "_prior"))
    first = ordered.where(~healthy & F.coalesce("previous", F.lit(True)))
    started = F.unix_micros("probe_ts").cast("string")
    return first.select(
        F.sha2(F.concat_ws("|", "component", started), 256).alias("id"),
        F.lit("INFRA").alias("source"),
        "component",
        F.lit("CRITICAL").alias("level"),
        F.lit(PROBE_TITLE).alias("title"),
        F.col("problem").alias("message"),
        F.when(F.col("following").isNull(), "active").otherwise("resolved").alias("status"),
        F.col("probe_ts").alias("created_at"),
        F.col("following").alias("resolved_at"),
    )


def probe_recoveries(probes: DataFrame) -> DataFrame:
    """First healthy probe of each component, which closes an incident left open by an earlier batch."""
    healthy = probe_classify(probes).where(F.col("problem").isNull())
    return healthy.groupBy("component").agg(F.min("probe_ts").alias("recovered_at"))


def probe_outbox(incidents: DataFrame) -> DataFrame:
    def notice(action: str, summary: str, details: Column, at: str) -> Column:
        return F.struct(
            F.lit(action).alias("action"),
            F.col("id").alias("dedup_key"),
            _fill(summary, "component").alias("summary"),
            F.lit(PROBE_SOURCE).alias("source"),
            F.lit("critical").alias("severity"),
            details.alias("details"),
            F.col(at).alias("at"),
        )

    opened = notice("trigger", PROBE_DOWN, F.col("message"), "created_at")
    closed = notice("resolve", PROBE_UP, F.lit(PROBE_RECOVERED), "resolved_at")
    notices = F.array(opened, F.when(F.col("resolved_at").isNotNull(), closed))
    return incidents.select(F.explode(notices).alias("notice")).where("notice is not null").select("notice.*")


# Usage quota: rolling 24-hour reads, one incident per (resource, level, day).


def quota_level(reads: Column) -> Column:
    level = F.lit(None).cast("string")
    for name, threshold in reversed(QUOTA_TIERS):
        level = F.when(reads >= threshold, name).otherwise(level)
    return level


def quota_levels(samples: DataFrame, span: timedelta = timedelta(hours=24)) -> DataFrame:
    """Rows read in the trailing 24 hours at every sample, and the alarm level that reaches."""
    rolling = rolling_sum(samples, ["resource"], "sample_ts", "rows_read", span)
    return rolling.withColumnRenamed("rolling", "rows_read_24h").withColumn(
        "level", quota_level(F.col("rows_read_24h"))
    )


def _quota_rows(breaches: DataFrame, message: Column, status: Column) -> DataFrame:
    """Incident rows of (resource, level, day, created_at) breaches."""
    return breaches.select(
        _fill(QUOTA_ID, "resource", "level", F.date_format("day", "yyyy-MM-dd")).alias("id"),
        F.lit("INFRA").alias("source"),
        _component("resource").alias("component"),
        "level",
        _fill(QUOTA_TITLE, "level").alias("title"),
        message.alias("message"),
        status.alias("status"),
        "created_at",
        F.lit(None).cast("timestamp").alias("resolved_at"),
    )


def _component(resource: str) -> Column:
    return F.concat(F.lit("billing-"), F.col(resource))


def _breach_message(reads: str) -> Column:
    return _fill(QUOTA_MESSAGE, humanize_count(F.col(reads)), "level")


def _nominal_message(reads: str) -> Column:
    return _fill(QUOTA_NOMINAL, humanize_count(F.col(reads)))


def quota_incidents(levels: DataFrame) -> DataFrame:
    """Final incident rows of the poll sequence.

    A breach inserts the (resource, level, day) incident or only refreshes its message. The first nominal poll after
    the insert resolves it, rewrites the message and leaves ``resolved_at`` empty; breaches later that day refresh the
    message of the resolved row.
    """
    poll = F.struct("sample_ts", "sample_id", F.col("rows_read_24h").alias("reads"))
    order, day = ["sample_ts", "sample_id"], utc_day(F.col("sample_ts"))
    breached = F.col("level").isNotNull()
    # Slices are days, so that the breaches of one incident stand in one slice; its first and its last are all it needs.
    incident = slice_window("level")
    ends = [F.row_number().over(incident.orderBy(*(F.col(name).asc() if first else F.col(name).desc() for name in order))) == 1 for first in (True, False)]
    ordered = with_neighbours(
        levels, ["resource"], order, following=F.when(~breached, poll), width=DAY, wanted=breached & (ends[0] | ends[1])
    )
    breaches = ordered.select("resource", "level", day.alias("day"), poll.alias("poll"), F.col("following").alias("nominal"))
    same = Window.partitionBy("resource", "level", "day").orderBy("poll")
    # The nominal poll that ends the first breach of an incident is the earliest of those that end any of them.
    folded = breaches.select(
        "*", F.col("poll.sample_ts").alias("created_at"), F.row_number().over(same).alias("_row"),
        F.last("poll").over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"),
    ).where("_row = 1")
    ended = F.col("nominal").isNotNull()
    refreshed = ~ended | (F.col("last") > F.col("nominal"))
    message = F.when(refreshed, _breach_message("last.reads")).otherwise(_nominal_message("nominal.reads"))
    return _quota_rows(folded, message, F.when(ended, "resolved").otherwise("active"))


def apply_quota_poll(incidents: DataFrame, polls: DataFrame, as_of: datetime) -> DataFrame:
    """The incident table after one poll per resource (resource, rows_read_24h), the scheduled form of the fold.

    A breach inserts its incident of the day or refreshes the message only; a nominal poll resolves every active
    incident of the component and rewrites its message.
    """
    now = F.lit(utc(as_of)).cast("timestamp")
    levels = polls.withColumn("level", quota_level(F.col("rows_read_24h")))
    breaches = levels.where(F.col("level").isNotNull()).select(
        "*", utc_day(now).alias("day"), now.alias("created_at")
    )
    incoming = _quota_rows(breaches, _breach_message("rows_read_24h"), F.lit("active"))
    nominal = levels.where(F.col("level").isNull()).select(
        _component("resource").alias("component"), _nominal_message("rows_read_24h").alias("_nominal")
    )
    stored = upsert_partial(incidents, incoming, ["id"], ["message"]).join(nominal, "component", "left")
    ended = F.col("_nominal").isNotNull() & (F.col("status") == "active")
    changed = conditional_update(stored, ended, {"status": F.lit("resolved"), "message": F.col("_nominal")})
    return changed.select(*INCIDENT)


def quota_outbox(levels: DataFrame) -> DataFrame:
    """A trigger per breaching poll; on the first nominal poll after a breach, a resolve for every level."""
    breached, before = F.col("level").isNotNull(), F.col("previous")
    return _quota_notices(
        with_neighbours(levels, ["resource"], ["sample_ts", "sample_id"], previous=breached, wanted=breached | F.coalesce(before, F.lit(True)))
    )


def quota_poll_outbox(incidents: DataFrame, polls: DataFrame, as_of: datetime) -> DataFrame:
    """The notices of one scheduled poll, given the incidents before it: an active one means that a breach came before."""
    before = incidents.where(F.col("status") == "active").select("component", F.lit(True).alias("previous")).distinct()
    levels = polls.select(
        "resource",
        "rows_read_24h",
        quota_level(F.col("rows_read_24h")).alias("level"),
        F.lit(utc(as_of)).cast("timestamp").alias("sample_ts"),
        _component("resource").alias("component"),
    )
    return _quota_notices(levels.join(before, "component", "left"))


def _quota_notices(ordered: DataFrame) -> DataFrame:
    reads = humanize_count(F.col("rows_read_24h"))
    breached = F.col("level").isNotNull()

    def notice(action: str, level: str) -> Column:
        summary = _fill(QUOTA_BREACHED, F.lit(level), reads) if action == "trigger" else _fill(QUOTA_RECOVERED, reads)
        return F.struct(
            F.lit(action).alias("action"),
            _fill(QUOTA_DEDUP, "resource", F.lit(level.lower())).alias("dedup_key"),
            summary.alias("summary"),
            F.lit(QUOTA_SOURCE).alias("source"),
            F.lit(QUOTA_SEVERITY[level]).alias("severity"),
            reads.alias("details"),
            F.col("sample_ts").alias("at"),
        )

    nominal_again = ~breached & F.coalesce("previous", F.lit(False))
    notices = F.array(
        *(F.when(F.col("level") == name, notice("trigger", name)) for name, _ in QUOTA_TIERS),
        *(F.when(nominal_again, notice("resolve", name)) for name, _ in QUOTA_TIERS),
    )
    return ordered.select(F.explode(notices).alias("notice")).where("notice is not null").select("notice.*")


def notification_outbox(runs: DataFrame, probes: DataFrame, levels: DataFrame) -> DataFrame:
    """Every trigger and resolve the three folds cause, as one append-only table.

    ``levels`` is read more than once; pass the stored output of ``quota_levels``.
    """
    folds = [
        lambda: ci_outbox(ci_transitions(runs)),
        lambda: probe_outbox(probe_incidents(probes)),
        lambda: quota_outbox(levels),
    ]
    # Each fold runs a job of its own for its slices; the three do not wait for one another.
    with ThreadPoolExecutor(len(folds)) as pool:
        parts = [part.select(*NOTICE) for part in pool.map(lambda fold: fold(), folds)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def active_incident_alert(incidents: DataFrame, component: str, as_of: datetime) -> DataFrame:
    """A trigger for one active incident of a component, repeated on each run while it stays active."""
    active = incidents.where((F.col("component") == component) & (F.col("status") == "active"))
    severity = F.when(F.lower("level") == "critical", "critical").otherwise("error")
    return (
        active.orderBy("created_at", "id")
        .limit(1)
        .select(
            F.lit("trigger").alias("action"),
            F.col("id").alias("dedup_key"),
            _fill(ALERT_SUMMARY, "title").alias("summary"),
            F.lit(ALERT_SOURCE).alias("source"),
            severity.alias("severity"),
            F.col("message").alias("details"),
            F.lit(utc(as_of)).cast("timestamp").alias("at"),
        )
    )
