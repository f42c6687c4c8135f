"""Severity functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of each level.
ALIASES = {
    "Critical": ["1", "超危", "严重", "critical", "crit"],
    "High": ["2", "高危", "高", "high", "important"],
    "Medium": ["3", "中危", "中", "medium", "moderate", "med"],
    "Low": ["4", "低危", "低", "low", "informational", "info", "none"],
}
LEVELS = list(ALIASES)
_LEVEL_OF = {word: level for level, words in ALIASES.items() for word in words}
#: Every text with a level begins like this; some that do have none.
LEVEL_WORDS = "(?i)^ *(?:" + "|".join(_LEVEL_OF) + ")"


def severity_normalize(c: Column) -> Column:
    """A level name of a text: an alias in any case, else a beginning; null with a digit or when blank, else 'Unknown'.

    Numbers are cut to whole text first by the caller (see ``severity_of_number``), so 1.9 reads as '1'.
    """
    text = F.trim(c.cast("string"))
    low = F.lower(text)
    alias = F.create_map(*[F.lit(x) for pair in _LEVEL_OF.items() for x in pair])
    begins = F.when(low.startswith("critical"), "Critical").when(low.startswith("high"), "High")
    begins = begins.when(low.startswith("medium") | low.startswith("moderate"), "Medium").when(low.startswith("low"), "Low")
    known = F.coalesce(F.try_element_at(alias, low), begins)
    return F.when(text == "", None).when(known.isNotNull(), known).when(text.rlike(r"\d"), None).when(text.isNotNull(), "Unknown")


def severity_of_number(c: Column) -> Column:
    """Numbers name a level by their whole part: 1.9 is '1', which is Critical."""
    return severity_normalize(c.cast("double").cast("long").cast("string"))


def severity_from_score(c: Column) -> Column:
    score = c.cast("double")
    return F.when(score >= 9, "Critical").when(score >= 7, "High").when(score >= 4, "Medium").when(score > 0, "Low")


def severity_from_scores(scores: Column) -> Column:
    """The level of the first score that has one."""
    return F.get(F.filter(F.transform(scores, severity_from_score), lambda x: x.isNotNull()), F.lit(0))


def severity_first_real(texts: Column, scores: Column) -> Column:
    """The first text with a real level, else the first score's level."""
    real = F.filter(F.transform(texts, severity_normalize), lambda x: x.isNotNull() & (x != "Unknown"))
    return F.coalesce(F.get(real, F.lit(0)), severity_from_scores(scores))


def severity_title_rule(title: Column) -> Column:
    return F.when(F.lower(title).contains("high threat"), "Critical").otherwise("Medium")


def severity_rank(c: Column) -> Column:
    """0 for the highest level; null for no level."""
    out = F.when(c == LEVELS[0], 0)
    for k, level in enumerate(LEVELS[1:], 1):
        out = out.when(c == level, k)
    return out


def severity_by_provider(provider: Column, scores: dict[str, Column], texts: dict[str, Column]) -> Column:
    """The raw severity by provider: CVE records prefer the newest score, qianxin and splunk have fallback fields, cnvd its status."""
    newest = F.coalesce(scores["v4_0"], scores["v3_1"], scores["v3_0"], scores["v2_0"])
    return (
        F.when(provider == "cve", severity_from_score(newest))
        .when(provider == "cnvd", severity_normalize(F.coalesce(texts["status"], texts["severity"])))
        .when(provider == "qianxin", severity_normalize(F.coalesce(texts["level"], texts["rating"], texts["severity"], texts["status"])))
        .when(provider == "splunk", severity_normalize(F.coalesce(texts["severity"], texts["rating"], texts["level"])))
        .otherwise(severity_normalize(F.coalesce(texts["severity"], texts["status"])))
    )
