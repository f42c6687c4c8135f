"""Landing zone and sinks: raw payloads in, tables and logs out."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LANDING = "provider string, url string, page long, content_type string, body string, fetched_at timestamp_ntz"
_OWN: dict[str, str] = {}


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``; where that is unset, in a temporary one on a local master, an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = named.rstrip("/") if named else _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-"))
    return f"{root}/{label}-{uuid.uuid4().hex}"


def read_landing(spark: SparkSession, path: str, kind: str = "parquet", content_type: str = "application/json") -> DataFrame:
    """Raw payloads from parquet or JSON tables in the LANDING layout, or from whole text or binary files."""
    if kind in ("parquet", "json"):
        return spark.read.schema(LANDING).format(kind).load(path)
    if kind == "text":
        files = spark.read.text(path, wholetext=True).select(F.col("value").alias("body"), F.input_file_name().alias("url"))
    elif kind == "binaryFile":
        files = spark.read.format("binaryFile").load(path).select(F.col("content").cast("string").alias("body"), F.col("path").alias("url"))
    else:
        raise ValueError(f"unknown kind {kind}")
    return files.select(F.lit(None).cast("string").alias("provider"), "url", F.lit(0).cast("long").alias("page"), F.lit(content_type).alias("content_type"), "body", F.lit(None).cast("timestamp_ntz").alias("fetched_at"))


def stream_landing(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(LANDING).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def landing_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))


def write_snapshot(df: DataFrame, label: str) -> DataFrame:
    """A new version of a table under a path of its own; the caller swaps it in."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def last_failures(failures: DataFrame) -> DataFrame:
    """The latest failure of each (provider, identity), ordered by both; equal times go by the larger error."""
    last = failures.groupBy("provider", "identity").agg(F.max(F.struct("updated_at", "error", "phase", "url", "status_code")).alias("f"))
    return last.select("provider", "identity", "f.phase", "f.url", "f.status_code", "f.error", "f.updated_at").orderBy("provider", "identity")


def run_output(records: DataFrame, failures: DataFrame) -> DataFrame:
    """Selected records without failed ones, written as JSON lines and read back."""
    kept = records.join(failures.select("identity").distinct(), "identity", "left_anti")
    path = shared_path(records.sparkSession, "run-output")
    kept.write.json(path)
    return records.sparkSession.read.schema(kept.schema).json(path)


def run_report(records: DataFrame, failures: DataFrame, listed: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report, selected records, sorted failures) of a run.

    records(provider, identity, pos, ...), failures as in ``last_failures``, listed(provider, total, stop_reason): what each
    provider's listing said.  Of each provider the first ``limit`` records by position are selected,
    and failed ones are then taken out of these.  The report has one row a provider: total (the listing's, else the
    number of records), result_count, failed, raw_limit, stop_reason; providers that only failed are there too.
    """
    failed = last_failures(failures)
    first = records
    if limit is not None:
        order = Window.partitionBy("provider").orderBy("pos", "identity")
        first = records.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit).drop("_rank")
    selected = first.join(failed.select("provider", "identity"), ["provider", "identity"], "left_anti")
    seen, kept = records.groupBy("provider").agg(F.count("*").alias("_seen")), selected.groupBy("provider").agg(F.count("*").alias("_kept"))
    lost = failed.groupBy("provider").agg(F.count("*").alias("_failed"))
    whole = listed.groupBy("provider").agg(F.max("total").alias("_total"), F.max("stop_reason").alias("stop_reason"))
    report = seen.join(kept, "provider", "full").join(lost, "provider", "full").join(whole, "provider", "full")
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    report = report.select(
        "provider", F.coalesce(F.nullif(F.col("_total"), F.lit(0)), number("_seen")).alias("total"), number("_kept").alias("result_count"), number("_failed").alias("failed"), F.lit(limit).cast("int").alias("raw_limit"), "stop_reason"
    )
    return report, selected, failed


def append_failure_log(failures: DataFrame, path: str) -> None:
    """JSON lines with fixed columns, appended."""
    failures.select("updated_at", "provider", "phase", "identity", "url", "status_code", "error").write.mode("append").json(path)


def source_catalog(names: Column, known: list[str]) -> Column:
    """struct(providers, unknown): names trimmed, blanks dropped, each once in first order."""
    cleaned = F.array_distinct(F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))
    return F.struct(cleaned.alias("providers"), F.array_except(cleaned, F.array(*[F.lit(k) for k in known])).alias("unknown"))
