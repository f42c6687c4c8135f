"""Dates and calendar windows.  All instants are UTC wall time (TIMESTAMP_NTZ).

Three rules hold for text without a zone, and the name says which: ``parse_hk`` reads Hong Kong
time, ``parse_utc`` reads UTC; stored datetimes are UTC already.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted patterns of dates without a time.
DATES = ["yyyy-M-d", "yyyy/M/d", "yyyy.M.d", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy"]
HOUR = 3_600_000_000
HONG_KONG = 8


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def _try(c: Column, patterns: list[str]) -> Column:
    """Zoned patterns give the instant in UTC (session zone UTC), naive ones the wall time."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(p)).cast("timestamp_ntz") for p in patterns])


def _clean(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def _read(t: Column, naive: int) -> Column:
    """The instant of a cleaned text: its shape says which pattern can fit, so one or two are tried and not all.  ``naive`` hours are taken off where no zone is given."""
    to = lambda p: F.try_to_timestamp(t, F.lit(p)).cast("timestamp_ntz")
    local = lambda p: to(p) - hours(naive) if naive else to(p)
    has = lambda pattern: t.rlike(pattern)
    fraction, seconds = t.contains("."), has(r":\d+:")

    def zoned(part: str) -> Column:
        body = f"yyyy-M-d'T'H:m:s{part}"
        return F.when(t.endswith("Z"), to(body + "XXX")).when(has(r"[+-]\d\d:\d\d$"), to(body + "xxx")).when(has(r"[+-]\d{4}$"), to(body + "xx")).otherwise(local(body))

    english = has(r"[A-Za-z]{4,} |[A-Za-z]{4,}$")  # May is both a short and a full name
    return (
        F.when(has(r"^\d+-\d+-\d+T"), F.when(fraction, zoned(".SSSSSS")).otherwise(zoned("")))
        .when(has(r"^\d+-\d+-\d+ "), F.when(seconds, local("yyyy-M-d H:m:s")).otherwise(local("yyyy-M-d H:m")))
        .when(has(r"^\d+/\d+/\d+ "), F.when(seconds, local("yyyy/M/d H:m:s")).otherwise(local("yyyy/M/d H:m")))
        .when(has(r"^\d+-"), local("yyyy-M-d")).when(has(r"^\d+/"), local("yyyy/M/d")).when(has(r"^\d+\."), local("yyyy.M.d"))
        .when(has(r"^\d+ [A-Za-z]"), F.when(english, local("d MMMM yyyy")).otherwise(local("d MMM yyyy")))
        .when(has(r"^[A-Za-z]"), F.when(english, local("MMMM d, yyyy")).otherwise(local("MMM d, yyyy")))
    )


def _parsed(c: Column, naive: int) -> Column:
    """``_read`` of the cleaned text, which is bound once as the only element of an array."""
    return F.get(F.transform(F.array(_clean(c)), lambda t: _read(t, naive)), F.lit(0))


def parse_hk(c: Column) -> Column:
    """First accepted pattern; without a zone it is Hong Kong time, a date alone is its midnight there; else null."""
    return _parsed(c, HONG_KONG)


def parse_utc(c: Column) -> Column:
    """As ``parse_hk``, but text without a zone is UTC."""
    return _parsed(c, 0)


def parse_rfc822(c: Column) -> Column:
    """Feed dates: the day name is cut off, a numeric zone or GMT read; falls back to ``parse_hk``."""
    text = F.regexp_replace(_clean(c), r"^[A-Za-z]{3}, ", "")
    return F.coalesce(_try(F.regexp_replace(text, " (GMT|UTC|Z)$", " +0000"), ["d MMM yyyy HH:mm:ss xx"]), parse_hk(c))


def date_iso(c: Column) -> Column:
    """The first year-month-day of a text, zero-padded; else an English date; else the text."""
    found = r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"
    part = lambda k: F.regexp_extract(c, found, k)
    iso = F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0"))
    english = F.date_format(_try(_clean(c), DATES[3:]), "yyyy-MM-dd")
    return F.when(c.rlike(found), iso).otherwise(F.coalesce(english, c))


def first_time(*values: Column) -> Column:
    """The first text that parses."""
    return F.coalesce(*[parse_hk(v) for v in values])


def modified_time(provider: Column, values: list[Column], published: Column, disclosed: Column, summary: Column) -> Column:
    """The newest edit.  In summaries of three feeds an edit equal to the publication is none; three providers fall back to disclosure."""
    newest = F.greatest(*values) if len(values) > 1 else values[0]
    edited = F.when(provider.isin("fortiguard", "hpe", "wiz") & summary & (newest == published), None).otherwise(newest)
    return F.coalesce(edited, F.when(provider.isin("cve", "msrc", "qianxin"), disclosed))


def news_time(published: Column, modified: Column) -> Column:
    """The later of publication and edit; when something was observed never counts."""
    return F.greatest(published, modified)


def hk_day(t: Column) -> Column:
    return (t + hours(HONG_KONG)).cast("date")


def window_bounds(now: Column, days: int) -> tuple[Column, Column]:
    """[start of the Hong Kong day ``days`` - 1 before now, start of the next one)."""
    if days < 1:
        raise ValueError("days is 1 or more")
    today = hk_day(now).cast("timestamp_ntz") - hours(HONG_KONG)
    return today - F.make_dt_interval(F.lit(days - 1)), today + F.make_dt_interval(F.lit(1))


def in_window(t: Column, bounds: tuple[Column, Column]) -> Column:
    """False for an unknown time: it is never taken for today."""
    return F.coalesce((t >= bounds[0]) & (t < bounds[1]), F.lit(False))


def listing_outdated(published: Column, modified: Column, summary: Column, bounds: tuple[Column, Column]) -> Column:
    """True where a listing row proves by itself that it is too old; a summary without an edit time proves nothing."""
    newest = news_time(published, modified)
    return newest.isNotNull() & ~in_window(newest, bounds) & ~(summary & modified.isNull())


def updated_since(t: Column, boundary: Column) -> Column:
    """Null where there is nothing to compare."""
    return t >= boundary


def range_split(since: Column, until: Column, days: int = 120) -> Column:
    """array(struct(since, until)) of pieces of at most ``days`` days that cover [since, until)."""
    step = F.make_dt_interval(F.lit(days))
    starts = F.when(since < until, F.filter(F.sequence(since, until, step), lambda s: s < until)).otherwise(F.array().cast("array<timestamp_ntz>"))
    return F.transform(starts, lambda s: F.struct(s.alias("since"), F.least(s + step, until).alias("until")))


def stamp(t: Column) -> Column:
    """An instant as text with milliseconds."""
    return F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSS")
