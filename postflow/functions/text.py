"""Column expressions over text and time. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a tag is '#' and a run of Unicode letters, digits or '_'.
HASHTAG_PATTERN = r"#([\p{L}\p{N}_]+)"


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def hashtags(text) -> Column:
    """Every tag of a text, in order and with repeats; no text gives an empty array."""
    found = F.regexp_extract_all(_col(text), F.lit(HASHTAG_PATTERN), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>"))


def hashtag_count(text) -> Column:
    return F.size(hashtags(text))


def double_quotes(text) -> Column:
    """Single quotes doubled, for a sink that splices values into SQL text."""
    return F.replace(_col(text), F.lit("'"), F.lit("''"))


def plain_newlines(text) -> Column:
    return F.regexp_replace(_col(text), r"\r\n?", "\n")


def event_time(text) -> Column:
    """Text to timestamp; text that is not a time gives null instead of an error."""
    return F.try_to_timestamp(_col(text))


def iso_text(ts) -> Column:
    """ISO 8601 text, with microseconds only where there are any."""
    ts = _col(ts)
    whole = F.date_trunc("second", ts) == ts
    return (F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))


def now_second() -> Column:
    return F.date_trunc("second", F.current_timestamp())


def ratio(total, count) -> Column:
    """``total / count`` as double, and 0 where the count is not positive."""
    return (F.when(_col(count) > 0, _col(total).cast("double") / _col(count))
            .otherwise(F.lit(0.0)))


def two_digits(value) -> Column:
    return F.format_string("%.2f", _col(value))
