"""Expressions over webhook and polling payloads kept as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts of a webhook payload. Array elements stay text: only their number is used.
REF = "ref string"
COMMITS = "commits array<string>"
HEAD = "head_commit struct<added: array<string>, removed: array<string>, modified: array<string>>"
REPOSITORY = "repository struct<private: string, language: string>"
CHECK = "check_suite struct<conclusion: string>"


def parse_once(df: DataFrame, kept: list[str], text: str, schema: str, options: dict | None = None) -> DataFrame:
    """``kept`` columns plus the parsed top-level fields; all fields NULL where the text is NULL.

    The parse runs inside a generator. Filters on a plain projected ``from_json`` would be pushed below it, each
    carrying its own copy of the parse; filters on generator output stay above and the text is parsed once.
    """
    return df.select(*kept, F.inline(F.array(F.from_json(text, schema, options or {}))))


def length(items: Column) -> Column:
    """Array length, NULL for a missing array (``size`` would give -1 or NULL depending on settings)."""
    return F.when(items.isNotNull(), F.array_size(items))


def changed_files(head: Column) -> Column:
    """Files added, removed and modified by a push's head commit."""
    parts = [F.coalesce(length(head[name]), F.lit(0)) for name in ("added", "removed", "modified")]
    return parts[0] + parts[1] + parts[2]


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def whole_number(text: Column) -> Column:
    """JSON number text as bigint, also when written as 12.0 or 1.2E3."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def number_or_zero(payload: Column, path: str) -> Column:
    return F.coalesce(whole_number(F.get_json_object(payload, path)), F.lit(0).cast("bigint"))
