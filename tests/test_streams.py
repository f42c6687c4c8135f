"""Change logs and alerts: restarts, queued batches, acknowledgements, repeat windows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from advisorium.operators import monitor as M
from advisorium.streaming import stream as W

KIND = "k long, t timestamp_ntz, v string"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_tables_of_streams_survive_a_restart(spark, tmp_path):
    batch = lambda *rows: spark.createDataFrame(list(rows), KIND)
    table = W.upsert_log(spark, KIND, "k", "t", str(tmp_path / "t"))
    assert table.read().collect() == []
    W.log_sink(table)(batch((1, at(2), "b"), (2, at(1), "x")), 0)
    table = W.upsert_log(spark, KIND, "k", "t", str(tmp_path / "t"))  # a new driver
    write = W.log_sink(table)
    write(batch((1, at(9), "again")), 0)  # the batch before, handed out again
    write(batch((1, at(1), "late"), (3, at(1), "y")), 1)  # queued before, arrives later: hides nothing
    batch((7, at(1), "torn")).write.parquet(f"{tmp_path}/t/batch-3")  # a write that broke off before its commit
    assert sorted(map(tuple, table.read().collect())) == [(1, at(2), "b"), (2, at(1), "x"), (3, at(1), "y")]
    write(batch((7, at(1), "whole")), 3)
    assert table.read().where("k = 7").first().v == "whole"

    retries = W.retry_log(spark, 7, str(tmp_path / "r"))
    write = W.log_sink(retries)
    rows = lambda *x: W.retry_rows(spark.createDataFrame(list(x), "identity string, at timestamp_ntz, failed boolean"))
    write(rows(("a", at(3), False), ("old", at(1), True), ("b", at(2), True)), 0)
    write(rows(("a", at(2), True), ("b", at(4), True), ("c", at(5), True)), 1)  # a's failure came late, behind its success
    assert {r.identity for r in W.waiting(retries.read()).collect()} == {"old", "b", "c"}
    write(rows(("c", at(9), False)), 2)
    assert {r.identity for r in W.waiting(retries.read()).collect()} == {"b"} and retries.read().count() == 3


def test_a_batch_writes_its_own_rows_and_compaction_keeps_the_view(spark, tmp_path):
    log = W.upsert_log(spark, KIND, "k", "t", str(tmp_path / "c"), least=25)
    written = []
    for n in range(12):
        W.log_sink(log)(spark.createDataFrame([(k, at(1 + n), f"{n}") for k in range(n, n + 10)], KIND), n)
        (base, held), since = log.commits()
        written.append((base, held, sum(since.values())))
    assert [x for x in written if x[0] >= 0] and max(x[2] for x in written) < 50
    assert sorted((r.k, r.v) for r in log.read().collect()) == [(k, str(min(k, 11))) for k in range(21)]
    plain = W.upsert_log(spark, KIND, "k", "t", str(tmp_path / "p"))
    for n in range(4):
        W.log_sink(plain)(spark.createDataFrame([(n, at(1), "x")], KIND), n)
    assert all(spark.read.parquet(f"{tmp_path}/p/batch-{n}").count() == 1 for n in range(4)) and not os.path.exists(f"{tmp_path}/p/base-3")


def test_progress_waits_for_the_rows(spark, tmp_path):
    log, progress = W.upsert_log(spark, KIND, "k", "t", str(tmp_path / "a")), W.progress_log(spark, str(tmp_path / "b"))
    write = W.acknowledged(log, progress, "v", "t")
    rows = lambda day: spark.createDataFrame([(1, at(day), "s")], KIND)
    write(rows(3), 0)

    class Broken:
        schema, spark = KIND, log.spark
        collapse = staticmethod(log.collapse)

        def append(self, df, number):
            raise OSError("not acknowledged")

    with pytest.raises(OSError):
        W.acknowledged(Broken(), progress, "v", "t")(rows(5), 1)
    assert progress.read().first().until == at(3)
    write(rows(5), 1)
    write(rows(4), 2)
    assert progress.read().first().until == at(5) and log.read().first().t == at(5)


def test_gate_moves_with_the_batches(spark, tmp_path):
    log = W.upsert_log(spark, KIND, "k", "t", str(tmp_path / "g"))
    sink = W.gated(W.log_sink(log), "t", 2, lambda batch: F.lit(batch.agg(F.max("t")).first()[0]))
    for n, days in enumerate([(1, 2, 9), (9, 12, 20)]):
        sink(spark.createDataFrame([(100 * n + d, at(d), "x") for d in days], KIND), n)
    assert sorted(r.k for r in log.read().collect()) == [9, 120]


COLS = "provider string, run long, run_at timestamp_ntz, phase string, identity string, url string, error string, delivered boolean"


def failed(run, day, hour, *who, delivered=None):
    return [("p", run, at(day, hour), "x", w, "u", "e", delivered) for w in who]


def nack(run, day, hour):
    return ("p", run, at(day, hour), None, None, None, None, False)


CASES = [
    ("repeat within the window", [failed(1, 1, 0, "a"), failed(2, 1, 5, "a")], [(1, 1, 0, True), (2, 0, 1, False)]),
    ("again behind the window", [failed(1, 1, 0, "a"), failed(2, 2, 1, "a")], [(1, 1, 0, True), (2, 1, 0, True)]),
    ("a new one beside a known one", [failed(1, 1, 0, "a"), failed(2, 1, 5, "a", "b"), failed(3, 1, 6, "a", "b")], [(1, 1, 0, True), (2, 1, 1, True), (3, 0, 2, False)]),
    ("sending failed", [failed(1, 1, 0, "a") + [nack(1, 1, 0)], failed(2, 1, 5, "a"), failed(3, 1, 6, "a")], [(1, 1, 0, False), (2, 1, 0, True), (3, 0, 1, False)]),
    ("sending failed, said with the failure", [failed(1, 1, 0, "a", "b", delivered=False), failed(2, 1, 5, "a")], [(1, 2, 0, False), (2, 1, 0, True)]),
]


@pytest.mark.parametrize("name,files,want", CASES, ids=[c[0] for c in CASES])
def test_alert_cases(spark, name, files, want):
    got = M.alert_runs(spark.createDataFrame(sum(files, []), COLS), 24).orderBy("run").collect()
    assert [(r.run, r.fresh, r.repeats, r.alert) for r in got] == want


def test_stream_alerts_with_acknowledgements_in_any_order(spark, tmp_path):
    files = [failed(1, 1, 0, "a") + [nack(1, 1, 0)], failed(2, 1, 5, "a", "b"), failed(3, 1, 6, "a"), failed(4, 20, 0, "a", "c")]
    for k in (2, 0, 3, 1):
        spark.createDataFrame(files[k], COLS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.createDataFrame([("p", None, dt.datetime(2025, 1, 1), None, None, None, None, None)], COLS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = W.drain(W.alert_stream(W.read_files(spark, str(tmp_path / "in"), COLS, 1), 24, late="60 days"), "append")
    want = M.alert_runs(spark.createDataFrame(sum(files, []), COLS), 24)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 4


def test_crashes_have_a_key_of_their_own(spark):
    crashes = spark.createDataFrame([("cve", 1, at(1), "RuntimeError", "mongo down"), ("cve", 2, at(1, 3), "RuntimeError", "mongo down"), ("cve", 3, at(1, 4), "OSError", "x" * 900), ("cve", 4, at(1, 5), "OSError", "x" * 950)], "provider string, run long, run_at timestamp_ntz, kind string, message string")
    failures = M.crash_failures(crashes)
    assert failures.select(M.failure_key()).first()[0] == "cve|EXCEPTION|||RuntimeError: mongo down" and failures.agg(F.max(F.length("error"))).first()[0] == M.ERROR_CHARS
    assert [(r.run, r.alert) for r in M.alert_runs(failures, 24).orderBy("run").collect()] == [(1, True), (2, False), (3, True), (4, False)]


def test_sessions_keep_no_state_and_meet_across_batches(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=m)
    log = W.session_log(spark, "user_id long", F.make_dt_interval(hours=F.lit(6)), str(tmp_path / "log"), least=3)
    batches = [[(1, at(12)), (1, at(0)), (2, at(0)), (None, at(1))], [(1, at(18, 1)), (2, None), (None, at(2))], [(1, at(6)), (1, at(6))]]  # the last one comes late and joins two
    for number, rows in enumerate(batches):
        W.log_sink(log)(W.session_rows(spark.createDataFrame(rows, "user_id long, ts timestamp_ntz"), "user_id", "ts"), number)
    assert sorted(map(tuple, log.read().collect()), key=str) == sorted([(1, at(0), at(12), 4), (1, at(18, 1), at(18, 1), 1), (2, at(0), at(0), 1), (None, at(1), at(2), 2)], key=str)
