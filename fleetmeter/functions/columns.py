"""Column-to-column helpers. All stay in the JVM; none depends on the session zone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetmeter.functions.dates import REPORT_TZ

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
MINUTE = 60_000_000  # microseconds
DAY = 24 * 60 * MINUTE


# --- numbers ---------------------------------------------------------------


def fill_round(c: Column, places: int = 1) -> Column:
    """Null and NaN become 0, then round half up."""
    return F.round(F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)), places)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def whole_minutes(hours: Column) -> Column:
    """Hours as minutes, with the noise of the earlier division by 60 removed.

    Run hours are minute ticks over 60, so this gives whole numbers back. Sums of
    whole numbers are exact in a double, hence the same in whatever order the
    shuffle delivers the rows.
    """
    return F.round(hours * 60, 3)


# --- calendar buckets ------------------------------------------------------


def sunday_week(d: Column) -> Column:
    """Start of the Sunday-to-Saturday week."""
    return F.date_sub(d, (F.weekday(d) + 1) % 7)


def shifted_week(d: Column) -> Column:
    """As ``sunday_week``, but a Sunday belongs to the week before."""
    return F.date_sub(d, F.weekday(d) + 1)


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def monday_of(d: Column) -> Column:
    return F.date_sub(d, F.weekday(d))


# --- time zones ------------------------------------------------------------


def utc_text_to_local(c: Column, tz: str = REPORT_TZ) -> Column:
    """ISO 8601 UTC text, with or without ``Z``, to zone-naive local time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), F.to_timestamp_ntz(c))


def epoch_to_local(seconds: Column, tz: str = REPORT_TZ) -> Column:
    utc = F.expr(EPOCH) + F.expr("INTERVAL '1' SECOND") * seconds
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def local_day(
    seconds: Column, start: dt.date, end: dt.date, tz: str = REPORT_TZ
) -> Column:
    """Local date of an epoch time, null outside ``start`` to ``end``.

    While the zone keeps one offset over the range, whole days are counted from the
    first midnight. Only a range with a change of clocks converts each time.
    """
    zone = ZoneInfo(tz)
    midnights = [
        dt.datetime.combine(start + dt.timedelta(days=n), dt.time(), zone)
        for n in range((end - start).days + 2)
    ]
    if len({m.utcoffset() for m in midnights}) > 1:
        day = F.to_date(epoch_to_local(seconds, tz))
        return F.when(day.between(F.lit(start), F.lit(end)), day)
    first, stop = (round(m.timestamp()) * 1_000_000 for m in (midnights[0], midnights[-1]))
    # A time that is no number is on no day.
    micros = F.rint(seconds * 1_000_000).try_cast("bigint")
    nth = whole_div(micros - first, DAY).cast("int")
    return F.when((micros >= first) & (micros < stop), F.date_add(F.lit(start), nth))


# Differences of zone-naive times, by their parts: casting to a zoned timestamp
# would let daylight saving of the session zone in.


def micros_of_day(ts: Column) -> Column:
    minutes = (F.hour(ts) * 60 + F.minute(ts)).cast("bigint")
    return minutes * MINUTE + (F.date_part(F.lit("SECONDS"), ts) * 1_000_000).cast("bigint")


def micros_between(start: Column, end: Column) -> Column:
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")
    return days * DAY + micros_of_day(end) - micros_of_day(start)


def minute_number(ts: Column) -> Column:
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def whole_div(value: Column, by: int) -> Column:
    """Integer division; for values that are not negative."""
    return F.call_function("div", value, F.lit(by).cast("bigint"))


# --- text, tags and JSON ---------------------------------------------------


def _json_text(item: Column) -> Column:
    boxed = F.to_json(F.array(item))
    return F.substring(boxed, F.lit(2), F.length(boxed) - 2)


def tags_to_json(tags: Column) -> Column:
    """``["a", "b"]``: a JSON array with a space after each comma."""
    items = F.array_join(F.transform(tags, _json_text), ", ", "null")
    return F.when(tags.isNotNull(), F.concat(F.lit("["), items, F.lit("]"))).otherwise(
        F.lit("null")
    )


def tags_from_json(text: Column) -> Column:
    """Malformed text gives null."""
    return F.from_json(text, "array<string>")


def lower_tags_overlap(tags: Column, wanted: Sequence[str]) -> Column:
    """Whether any tag, lower-cased, is in ``wanted``. Null tags never match."""
    lowered = F.transform(
        F.coalesce(tags, F.array().cast("array<string>")),
        lambda t: F.coalesce(F.lower(t), F.lit("")),
    )
    return F.arrays_overlap(lowered, text_array(wanted))


def json_tags_overlap(text: Column, wanted: Sequence[str]) -> Column:
    """Whether a tag in the JSON array ``text``, stripped of brackets and quotes, is in
    ``wanted``. Case matters. Malformed text and null tags never match."""
    stripped = F.transform(
        tags_from_json(text),
        lambda t: F.coalesce(F.btrim(t, F.lit("[]\"'")), F.lit("")),
    )
    return F.coalesce(F.arrays_overlap(stripped, text_array(wanted)), F.lit(False))


def text_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def list_text(items: Column) -> Column:
    """A list of strings as ``['a', 'b']``."""

    def quoted(item: Column) -> Column:
        body = F.replace(item, F.lit("\\"), F.lit("\\\\"))
        return (
            F.when(~F.contains(item, F.lit("'")), F.concat(F.lit("'"), body, F.lit("'")))
            .when(~F.contains(item, F.lit('"')), F.concat(F.lit('"'), body, F.lit('"')))
            .otherwise(
                F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
            )
        )

    return F.concat(
        F.lit("["), F.array_join(F.transform(items, quoted), ", ", "None"), F.lit("]")
    )


def glob_to_regex(pattern: Column) -> Column:
    """A shell glob (``*``, ``?``, ``[seq]``, ``[!seq]``) as an anchored regular expression.

    The pattern is cut into tokens, a bracket set being one token; each becomes
    its regular-expression form. An unclosed ``[`` stands for itself, and a set
    without any character, such as ``[z-a]``, matches none.
    """
    tokens = F.regexp_extract_all(pattern, F.lit(r"(?s)\[!?\]?[^\]]*\]|."), F.lit(0))

    def bracket_set(token: Column) -> Column:
        negated = F.startswith(token, F.lit("[!"))
        body = F.when(negated, F.substring(token, F.lit(3), F.length(token) - 3)).otherwise(
            F.substring(token, F.lit(2), F.length(token) - 2)
        )
        # Ranges and single characters; a range from high to low has no character.
        members = F.regexp_extract_all(body, F.lit(r"(?s).-.|."), F.lit(0))
        some = F.filter(
            members,
            lambda m: (F.length(m) == 1) | (F.ascii(m) <= F.ascii(F.substring(m, F.lit(3), F.lit(1)))),
        )
        safe = F.regexp_replace(F.array_join(some, ""), r"([\\\[\]^&~])", r"\\$1")
        shown = F.concat(F.when(negated, F.lit("[^")).otherwise(F.lit("[")), safe, F.lit("]"))
        nothing = F.when(negated, F.lit(".")).otherwise(F.lit("(?!)"))
        return F.when(safe == "", nothing).otherwise(shown)

    def piece(token: Column) -> Column:
        return (
            F.when(token == "*", F.lit(".*"))
            .when(token == "?", F.lit("."))
            .when(F.length(token) > 1, bracket_set(token))
            .otherwise(F.regexp_replace(token, r"([^\w\s])", r"\\$1"))
        )

    return F.concat(
        F.lit(r"\A(?s:"), F.array_join(F.transform(tokens, piece), ""), F.lit(r")\z")
    )
