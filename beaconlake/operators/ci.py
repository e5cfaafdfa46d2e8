"""Analytics over CI webhooks: activity datasets, totals and latest deliveries.

Filed deliveries carry the ``facts`` of their payload as typed columns and are read without a parse. Rows without that column
have their payload parsed, once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions.clock import days_back, label, parse_days, stamp, utc_day, utc_midnight, week_label
from beaconlake.functions.payload import (
    CHECK, COMMITS, HEAD, REF, REPOSITORY, changed_files, is_json, length, parse_once
)

ALL_TIME = "all_time"

# (LIKE patterns, language): the first rule that matches a repository name wins, case-insensitively.
LanguageRules = list[tuple[tuple[str, ...], str]]


def _facts(deliveries: DataFrame, kept: list[str], *needed: str) -> DataFrame:
    """``kept`` columns and the needed facts: ref, commits, changed_files, public, language, conclusion."""
    if "facts" in deliveries.columns:
        return deliveries.select(*kept, *(F.col(f"facts.{name}") for name in needed))
    fields = {
        "ref": (REF, F.col("ref")),
        "commits": (COMMITS, length(F.col("commits"))),
        "changed_files": (HEAD, changed_files(F.col("head_commit"))),
        "public": (REPOSITORY, F.col("repository.private") == "false"),
        "language": (REPOSITORY, F.col("repository.language")),
        "conclusion": (CHECK, F.col("check_suite.conclusion")),
    }
    schema = ", ".join(dict.fromkeys(fields[name][0] for name in needed))
    return parse_once(deliveries, kept, "payload", schema).select(*kept, *(fields[name][1].alias(name) for name in needed))


def _pushes(deliveries: DataFrame, as_of: datetime, window: str) -> tuple[DataFrame, Column]:
    """Push deliveries of the range with parsed payload columns, and the label that buckets them by time."""
    window = window.lower()
    pushes = deliveries.where(F.col("event_type") == "push")
    if window == ALL_TIME:
        bucket = label(F.col("created_at"), "yyyy-MM")
    else:
        since = days_back(as_of, parse_days(window.replace("d", "", 1), default=30))
        pushes = pushes.where(F.col("created_at") >= F.lit(utc_midnight(since)))
        bucket = week_label(utc_day(F.col("created_at"))) if window == "90d" else label(F.col("created_at"), "yyyy-MM-dd")
    rows = _facts(pushes, ["created_at", "repository_name"], "commits", "changed_files", "public")
    return rows.withColumnRenamed("changed_files", "growth"), bucket


def _sum_by(rows: DataFrame, key: Column, value: str) -> DataFrame:
    return rows.groupBy(key.alias("metric_key")).agg(F.sum(value).alias("metric_value"))


def language(repository: Column, rules: LanguageRules) -> Column:
    """Language by repository name; NULL when no rule matches."""
    chosen = F.lit(None).cast("string")
    for patterns, name in reversed(rules):
        matches = F.lit(False)
        for pattern in patterns:
            matches = matches | repository.ilike(pattern)
        chosen = F.when(matches, F.lit(name)).otherwise(chosen)
    return chosen


def commit_activity(deliveries: DataFrame, as_of: datetime, window: str = "30d") -> DataFrame:
    rows, bucket = _pushes(deliveries, as_of, window)
    return _sum_by(rows, bucket, "commits")


def code_growth(deliveries: DataFrame, as_of: datetime, window: str = "30d") -> DataFrame:
    rows, bucket = _pushes(deliveries, as_of, window)
    return _sum_by(rows, bucket, "growth")


def repo_activity(deliveries: DataFrame, as_of: datetime, window: str = "30d") -> DataFrame:
    rows, _ = _pushes(deliveries, as_of, window)
    return _sum_by(rows.where("public"), F.col("repository_name"), "commits")


def language_dist(deliveries: DataFrame, as_of: datetime, rules: LanguageRules, window: str = "30d") -> DataFrame:
    rows, _ = _pushes(deliveries, as_of, window)
    key = language(F.col("repository_name"), rules)
    return _sum_by(rows.where(key.isNotNull()), key, "commits")


def github_metrics(deliveries: DataFrame, as_of: datetime, rules: LanguageRules, window: str = "30d") -> DataFrame:
    """The four datasets in one scan and one shuffle.

    Each push becomes up to four (dataset, key, value) rows, which the map side sums away again before the shuffle.
    """
    rows, bucket = _pushes(deliveries, as_of, window)
    commits = F.col("commits").cast("bigint")

    def entry(dataset: str, key: Column, value: Column, wanted: Column) -> Column:
        item = F.struct(
            F.lit(dataset).alias("dataset_type"), key.alias("metric_key"), value.cast("bigint").alias("metric_value")
        )
        return F.when(wanted, item)

    written_in = language(F.col("repository_name"), rules)
    entries = F.array(
        entry("commit_activity", bucket, commits, F.lit(True)),
        entry("code_growth", bucket, F.col("growth"), F.lit(True)),
        entry("repo_activity", F.col("repository_name"), commits, F.col("public")),
        entry("language_dist", written_in, commits, written_in.isNotNull()),
    )
    return (
        rows.select(F.explode(entries).alias("entry"))
        .where(F.col("entry").isNotNull())
        .groupBy("entry.dataset_type", "entry.metric_key")
        .agg(F.sum("entry.metric_value").alias("metric_value"))
        .orderBy("dataset_type", "metric_key")
    )


def latest_per_repo(deliveries: DataFrame, repositories: list[str]) -> DataFrame:
    """Newest delivery of each listed repository; a payload that is not JSON reads as NULL.

    The first pass reads ids only. Its result has at most one row per listed repository, which bounds the broadcast.
    """
    listed = deliveries.where(F.col("repository_name").isin(*repositories))
    readable = F.lit(True) if "facts" in deliveries.columns else is_json(F.col("payload"))
    newest = listed.groupBy("repository_name").agg(F.max("id").alias("id"))
    return listed.join(F.broadcast(newest), ["repository_name", "id"]).select(
        "id",
        "event_type",
        "action",
        "repository_name",
        "sender_login",
        F.when(readable, F.col("payload")).alias("payload"),
        "created_at",
    )


def github_totals(deliveries: DataFrame) -> DataFrame:
    rows = _facts(deliveries, ["event_type", "repository_name"], "commits", "conclusion")
    push = F.col("event_type") == "push"
    check = F.col("event_type") == "check_suite"
    conclusion = F.col("conclusion")
    commits = F.when(push, F.coalesce("commits", F.lit(0))).otherwise(0)
    rate = F.try_divide(
        F.count_if(check & (conclusion == "success")).cast("double") * 100,
        F.count_if(check & conclusion.isNotNull()),
    )
    return rows.agg(
        F.count_if(push).alias("total_pushes"),
        F.sum(commits).alias("total_commits"),
        F.count_distinct("repository_name").alias("total_repos"),
        F.round(rate, 1).alias("ci_success_rate"),
    )


def push_labels(pushes: DataFrame, owner: str) -> DataFrame:
    """Display columns of push deliveries: repository without its owner, branch or tag, language, changed files."""
    kept = ["id", "repository_name", "sender_login", "created_at"]
    ref = F.col("ref")
    branch = F.when(
        ref.ilike("refs/tags/%"), F.concat(F.lit("Tag: "), F.replace(ref, F.lit("refs/tags/"), F.lit("")))
    ).otherwise(F.replace(ref, F.lit("refs/heads/"), F.lit("")))
    return _facts(pushes, kept, "ref", "language", "changed_files").select(
        "id",
        F.replace(F.col("repository_name"), F.lit(f"{owner}/"), F.lit("")).alias("repository_name"),
        "sender_login",
        stamp(F.col("created_at")).alias("created_at"),
        branch.alias("branch"),
        "language",
        F.col("changed_files").alias("changed_count"),
    )


def latest_push(deliveries: DataFrame, owner: str) -> DataFrame:
    """Newest push by id. Only the surviving row's payload is parsed."""
    newest = deliveries.where(F.col("event_type") == "push").orderBy(F.col("id").desc()).limit(1)
    return push_labels(newest, owner).drop("id")
