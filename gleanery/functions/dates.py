"""Date text to timestamps, by searching for the documented forms inside the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"

# What is searched for in the text: (name, pattern with one group).
_SEARCHES = {
    "_iso": r"([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})",
    "_year_first": r"([0-9]{4}/[0-9]{1,2}/[0-9]{1,2})",
    "_month_name_first": rf"(?i)\b({_MONTH}\.? +[0-9]{{1,2}}(?:st|nd|rd|th)?,? +[0-9]{{4}})",
    "_day_then_name": rf"(?i)\b([0-9]{{1,2}}(?:st|nd|rd|th)? +{_MONTH}\.?,? +[0-9]{{4}})",
    "_slashes": r"\b([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})",
    "_dots": r"\b([0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})",
    "_clock": r"([0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?)",
    "_half": r"(?i)[0-9] ?([ap])\.?m\b",
    "_zone": r"[0-9] ?(Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2})",
}
# How the dates found are read, in order of preference; month first where both readings are possible.
_READINGS = (
    ("_iso", "y-M-d"),
    ("_year_first", "y/M/d"),
    ("_month_name_first", "MMM d y"),
    ("_day_then_name", "d MMM y"),
    ("_slashes", "M/d/y"),
    ("_slashes", "d/M/y"),
    ("_dots", "M.d.y"),
    ("_dots", "d.M.y"),
)


def with_datetime(frame: DataFrame, raw: Column, into: str) -> DataFrame:
    """Add the timestamp found in a text, NULL if none; text without a zone is taken as UTC.

    Forms: ISO dates, y/m/d, month-first and (where that is impossible) day-first numbers,
    ``June 15, 2024`` and ``15 June 2024``; each with an optional clock time, AM/PM and offset.
    Every pattern runs once per row: searches, pieces and result are projections of their own.
    """
    found = frame.withColumn("_text", raw).withColumns(
        {name: F.regexp_extract("_text", pattern, 1) for name, pattern in _SEARCHES.items()}
    )
    short_names = found.withColumns(
        {
            "_month_name_first": F.initcap(
                F.regexp_replace("_month_name_first", r"(?i)([a-z]{3})[a-z]*\.? +([0-9]+)[a-z]*,? +([0-9]{4})", "$1 $2 $3")
            ),
            "_day_then_name": F.initcap(
                F.regexp_replace("_day_then_name", r"(?i)([0-9]+)[a-z]* +([a-z]{3})[a-z]*\.?,? +([0-9]{4})", "$1 $2 $3")
            ),
            "_half": F.lower("_half"),
            "_clock": F.split("_clock", ":"),
            "_zone": F.replace("_zone", F.lit(":"), F.lit("")),
        }
    )
    # Only text that is there goes to the parser: a failed parse costs far more than a search.
    readings = [F.when(F.col(name) != "", F.try_to_timestamp(F.col(name), F.lit(form))) for name, form in _READINGS]
    hour, minute, second = (F.get("_clock", F.lit(i)) for i in range(3))
    sign = F.when(F.startswith("_zone", F.lit("-")), -1).otherwise(1)
    away = F.substr("_zone", F.lit(2), F.lit(2)).try_cast("int") * 3600 + F.substr("_zone", F.lit(4), F.lit(2)).try_cast("int") * 60
    pieces = short_names.withColumns(
        {
            "_date": F.coalesce(*readings).cast("date"),
            "_hour": F.coalesce(hour.try_cast("int"), F.lit(0)),
            "_minute": F.coalesce(minute.try_cast("int"), F.lit(0)),
            "_second": F.coalesce(second.try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)")),
            "_offset": F.when((hour != "") & F.col("_zone").rlike("^[+-]"), sign * away).otherwise(0),
        }
    ).withColumn(
        "_hour",
        F.when(F.col("_half") == "p", F.col("_hour") % 12 + 12).when(F.col("_half") == "a", F.col("_hour") % 12).otherwise(F.col("_hour")),
    )
    # Days since the epoch do not depend on the session time zone, so neither does the instant.
    days = F.unix_date("_date").cast("bigint")
    whole = days * 86400 + F.col("_hour") * 3600 + F.col("_minute") * 60 - F.col("_offset")
    micros = whole * 1_000_000 + (F.col("_second") * 1_000_000).cast("bigint")
    valid = (F.col("_hour") < 24) & (F.col("_minute") < 60) & (F.col("_second") < 60)
    helpers = ["_text", *_SEARCHES, "_date", "_hour", "_minute", "_second", "_offset"]
    return pieces.withColumn(into, F.when(valid, F.timestamp_micros(micros))).drop(*helpers)
