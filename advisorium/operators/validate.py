"""Contract of the stored envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import parse_hk
from .classify import STATUSES
from .documents import REGISTERED

# The envelope.
REQUIRED = ["_id", "schema_version", "code", "title", "observed_at", "source", "details"]
ALLOWED = [*REQUIRED, "severity", "change_type", "published_at", "updated_at", "cve_ids", "classification"]
OLD_FIELDS = ["type", "cve_code", "cve_codes", "vuln_type", "disclosure_date", "status", "scraped_at"]
SEVERITIES = ["Critical", "High", "Medium", "Low"]
CHANGE_TYPES = ["new", "updated"]
SOURCE_FIELDS = ["provider", "url", "detail_url"]
CVE = r"^CVE-\d{4}-\d{4,}$"


def violations(provider: Column, cols: dict[str, Column], keys: Column | None = None) -> Column:
    """array<string> of the violated rules of a row; ``keys`` are its field names where documents are open.

    A rule is checked where ``cols`` has what it reads: code, title, change_type, source (a struct of
    provider, url, detail_url), source_keys (field names of an open source), classification_status and,
    as texts, published_at, updated_at, which must be dates.
    """
    c = cols
    blank = lambda x: F.coalesce(F.length(x), F.lit(0)) == 0
    optional = [
        ("no_code", "code", lambda x: blank(x)), ("no_title", "title", lambda x: blank(x)), ("change_type", "change_type", lambda x: x.isNotNull() & ~x.isin(*CHANGE_TYPES)),
        ("source_provider", "source", lambda x: ~F.coalesce(x["provider"].isin(*REGISTERED), F.lit(False))), ("source_address", "source", lambda x: (x["url"] == "") | (x["detail_url"] == "")),
        ("source_field", "source_keys", lambda x: F.size(F.array_except(x, F.array(*[F.lit(f) for f in SOURCE_FIELDS]))) > 0),
        ("classification_status", "classification_status", lambda x: c["classification"].isNotNull() & ~F.coalesce(x.isin(*STATUSES), F.lit(False))),
        ("published_at_date", "published_at", lambda x: x.isNotNull() & parse_hk(x).isNull()), ("updated_at_date", "updated_at", lambda x: x.isNotNull() & parse_hk(x).isNull()),
    ]
    rules = [
        ("provider_unknown", ~F.coalesce(provider.isin(*REGISTERED), F.lit(False))), ("provider_mismatch", F.substring_index(c["_id"], ":", 1) != provider),
        ("version", ~c["schema_version"].eqNullSafe(F.lit(2))), ("empty_id", F.coalesce(F.trim(c["_id"]), F.lit("")) == ""), ("no_observation", c["observed_at"].isNull()), ("no_details", c["details"].isNull()),
        ("classification_off_cve", c["classification"].isNotNull() & (provider != "cve")), ("cve_ids_on_cve", c["cve_ids"].isNotNull() & (provider == "cve")),
        ("cve_ids_repeat", F.size(F.array_distinct(c["cve_ids"])) < F.size(c["cve_ids"])), ("cve_ids_form", F.exists(c["cve_ids"], lambda x: ~x.rlike(CVE))), ("severity", c["severity"].isNotNull() & ~c["severity"].isin(*SEVERITIES)),
    ]
    rules += [(name, test(c[field])) for name, field, test in optional if field in c]
    if keys is not None:
        rules += [("old_field", F.arrays_overlap(keys, F.array(*[F.lit(x) for x in OLD_FIELDS]))), ("unknown_field", F.size(F.array_except(keys, F.array(*[F.lit(x) for x in ALLOWED + OLD_FIELDS]))) > 0)]
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules]))


def split_valid(rows: DataFrame, found: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with their violations)."""
    marked = rows.withColumn("violations", found)
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


def summary(rows: DataFrame) -> DataFrame:
    return rows.select("provider", F.explode("violations").alias("rule")).groupBy("provider", "rule").agg(F.count("*").alias("n"))


def schema_problems(schema: T.StructType) -> list[str]:
    """What a table's own schema lacks or has beyond the closed envelope."""
    names = set(schema.names)
    return [f"missing:{c}" for c in REQUIRED if c not in names] + [f"old:{c}" for c in OLD_FIELDS if c in names] + [f"unknown:{c}" for c in sorted(names - {*ALLOWED, *OLD_FIELDS})]
