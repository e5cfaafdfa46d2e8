"""Native string expressions: endpoint and keyword normalisation, display labels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from beaconlake.functions.clock import epoch_ms

# Whitespace of ECMAScript's trim, and the two path rewrites.
SPACE = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
NUMERIC_SEGMENT = r"/\d+"
NUMERIC_PLACEHOLDER = "/:id"
IMAGE_SEGMENT = r"(?i)/[^/]+\.(webp|jpg|jpeg|png|gif)\z"
IMAGE_PLACEHOLDER = "/:filename"

# Fixed value: search text the apps send for "no filter".
PLACEHOLDER_KEYWORD = "ALL_BOOKS"


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def normalize_endpoint(endpoint: Column) -> Column:
    """Collapse ids and image names so that the number of distinct endpoints stays small."""
    path = F.regexp_replace(trim_space(endpoint), NUMERIC_SEGMENT, NUMERIC_PLACEHOLDER)
    return F.regexp_replace(path, IMAGE_SEGMENT, IMAGE_PLACEHOLDER)


def clean_keyword(keyword: Column) -> Column:
    """Keyword without quotes and outer whitespace; NULL for empty, all-digit and placeholder keywords."""
    text = trim_space(F.regexp_replace(keyword, "[\"']", ""))
    noise = (text == "") | text.rlike(r"\A[0-9]+\z") | (text == PLACEHOLDER_KEYWORD)
    return F.when(~noise, text)


def display_keyword(keyword: Column) -> Column:
    """Keyword for display: no straight or curly quotes, no whitespace."""
    return F.regexp_replace(F.coalesce(keyword, F.lit("N/A")), rf"[\"'“”]|{SPACE}", "")


def fixed(value: Column, places: int) -> Column:
    """Half-up rounding to text with a fixed number of decimals."""
    rounded = F.round(value.cast("double"), places)
    return F.when(rounded.isNotNull(), F.format_string(f"%.{places}f", rounded))


def humanize_count(n: Column) -> Column:
    """950 -> '950', 104600 -> '104.6K', 2000000 -> '2.00M'."""
    return (
        F.when(n < 1000, n.cast("string"))
        .when(n < 1000000, F.concat(fixed(n / 1000, 1), F.lit("K")))
        .otherwise(F.concat(fixed(n / 1000000, 2), F.lit("M")))
    )


def _minutes_since(at: Column, as_of: datetime) -> Column:
    return F.floor((F.lit(epoch_ms(as_of)) - F.unix_millis(at)) / 60000)


def relative_time(at: Column, as_of: datetime) -> Column:
    minutes = _minutes_since(at, as_of)
    hours = F.floor(minutes / 60)
    return (
        F.when(at.isNull(), F.lit("Active Sync"))
        .when(minutes < 1, F.lit("Just now"))
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit("m ago")))
        .when(hours < 24, F.concat(hours.cast("string"), F.lit("h ago")))
        .otherwise(F.concat(F.floor(hours / 24).cast("string"), F.lit("d ago")))
    )


def log_relative_time(at: Column, as_of: datetime) -> Column:
    minutes = _minutes_since(at, as_of)
    return (
        F.when(at.isNull(), F.lit("Live"))
        .when(minutes <= 2, F.lit("Just Now"))
        .otherwise(F.concat(minutes.cast("string"), F.lit("m ago")))
    )


def duration_label(minutes: Column) -> Column:
    """Whole minutes as 'Nm', above an hour as 'Xh Ym'; '0 m' when there is nothing to average."""
    return (
        F.when(minutes.isNull(), F.lit("0 m"))
        .when(
            minutes > 60,
            F.concat(
                F.floor(minutes / 60).cast("string"), F.lit("h "), (minutes % 60).cast("string"), F.lit("m")
            ),
        )
        .otherwise(F.concat(minutes.cast("string"), F.lit("m")))
    )


def uptime_label(seconds: Column) -> Column:
    whole = F.floor(seconds)
    days = F.floor(whole / 86400)
    hours = F.concat(F.floor(F.pmod(whole, F.lit(86400)) / 3600).cast("string"), F.lit("h"))
    return (
        F.when(whole <= 0, F.lit("0h"))
        .when(days > 0, F.concat(days.cast("string"), F.lit("d "), hours))
        .otherwise(hours)
    )
