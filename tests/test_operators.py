"""Literal cases of the rules, and properties that must hold for any input."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from advisorium.functions import nested as N
from advisorium.functions import severity as S
from advisorium.functions import text as X
from advisorium.functions import times as D
from advisorium.operators import documents as O
from advisorium.operators import html_tables as T
from advisorium.operators import monitor as M
from advisorium.operators import progress as J
from advisorium.operators import validate as V

C = F.col


def one(spark, make, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(C("x")).alias("y")).first().y


@pytest.mark.parametrize("raw,want", [
    ("CVE-2024-1234", "2024-1234"), ("cve-2024-12345", "2024-12345"), (" 2024-1234 ", "2024-1234"), ("2024-123", None), ("CVE-24-1234", None), ("xCVE-2024-1234", None), (None, None), ("", None),
])
def test_cve_normalize(spark, raw, want):
    assert one(spark, X.cve_normalize, raw) == want


@pytest.mark.parametrize("raw,want", [
    ("1", "Critical"), ("超危", "Critical"), ("严重", "Critical"), ("CRITICAL", "Critical"), ("crit", "Critical"), ("高危", "High"), ("important", "High"), ("2", "High"), ("中", "Medium"), ("moderate", "Medium"), ("med", "Medium"),
    ("低危", "Low"), ("informational", "Low"), ("none", "Low"), ("High severity", "High"), ("critical!", "Critical"), ("7.5", None), ("score 9", None), ("", None), (None, None), ("weird", "Unknown"),
])
def test_severity(spark, raw, want):
    assert one(spark, S.severity_normalize, raw) == want


def test_numbers_are_cut(spark):
    assert one(spark, S.severity_of_number, 1.9, "double") == "Critical"


@pytest.mark.parametrize("raw,want", [
    ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"), ("2024-01-02T03:04:05.5+0800", "2024-01-01 19:04:05.5"), ("2024-01-02T03:04:05+08:00", "2024-01-01 19:04:05"), ("2024-1-2 3:4", "2024-01-01 19:04:00"), ("2024/01/02  03:04:05", "2024-01-01 19:04:05"),
    ("2024-01-02", "2024-01-01 16:00:00"), ("2 Jan 2024", "2024-01-01 16:00:00"), ("January 2, 2024", "2024-01-01 16:00:00"), ("2024", None), ("2024-02-31", None), ("soon", None), ("", None), (None, None),
])
def test_timestamps(spark, raw, want):
    got = one(spark, D.parse_hk, raw)
    assert got == (want and dt.datetime.fromisoformat(want))


@pytest.mark.parametrize("t,inside", [("2024-01-13 16:00:00", True), ("2024-01-13 15:59:59", False), ("2024-01-20 15:59:59", True), ("2024-01-20 16:00:00", False), (None, False)])
def test_window_edges_at_hong_kong_midnight(spark, t, inside):
    now = F.lit("2024-01-20 09:00:00").cast("timestamp_ntz")
    got = one(spark, lambda x: D.in_window(x.cast("timestamp_ntz"), D.window_bounds(now, 7)), t)
    assert got is inside
    with pytest.raises(ValueError):
        D.window_bounds(now, 0)


def test_compaction_keeps_false_and_zero(spark):
    df = spark.createDataFrame([((" ", 0, False, [" ", "x "], {"k": ""}, ("", [])),)], "x struct<a:string,n:int,b:boolean,l:array<string>,m:map<string,string>,s:struct<p:string,q:array<string>>>")
    got = df.select(N.compact(C("x"), df.schema["x"].dataType).alias("y")).first().y
    assert (got.a, got.n, got.b, got.l, got.m, got.s) == (None, 0, False, ["x"], None, None)
    assert one(spark, N.compact_json, '{"b":{"c":[""," "]},"a":false,"z":0}') == '{"a":false,"z":0}' and one(spark, N.compact_json, "{broken") is None


def test_spans_fill_the_grid(spark):
    html = "<table><tr><td rowspan=2>a</td><td colspan=2>b</td></tr><tr><td>c</td></tr><tr><td rowspan=0>d</td><td>e<table><tr><td>in</td></tr></table></td></tr><tr><td>f</td></tr></table>"
    inner, outer = one(spark, T.html_tables_grid, html)
    assert inner == [["in"]] and outer == [["a", "b", "b"], ["a", "c", ""], ["d", "e", ""], ["d", "f", ""]] or outer[2][1].startswith("e")


@pytest.mark.parametrize("bad", [None, "", "<table>", "<table><tr></table>", "plain", "<table><tr><td colspan=x>1</table>"])
def test_broken_html_is_no_error(spark, bad):
    df = spark.createDataFrame([(1, bad)], "page_id long, html string")
    assert df.select(T.html_text("html"), T.html_label_pairs("html"), T.html_sections("html"), T.html_tables_grid("html")).collect()


def test_frontier_stays_before_a_gap(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    w = spark.createDataFrame([("p", t(3), t(4)), ("p", t(1), t(2)), ("p", t(2), t(2)), ("q", t(5), t(6))], "provider string, since timestamp_ntz, until timestamp_ntz")
    marks = spark.createDataFrame([("p", t(1)), ("q", t(1)), ("r", t(1))], "provider string, boundary timestamp_ntz")
    got = {r.provider: (r.frontier, r.pending) for r in J.frontier_advance(w, marks, "provider").collect()}
    assert got == {"p": (t(2), 1), "q": (t(1), 1), "r": (t(1), 0)}


def test_interval_merge_is_idempotent_and_order_free(spark):
    r = random.Random(1)
    rows = [("p", dt.datetime(2024, 1, 1) + dt.timedelta(hours=(a := r.randrange(500))), dt.datetime(2024, 1, 1) + dt.timedelta(hours=a + r.randrange(9))) for _ in range(100)]
    schema = "provider string, since timestamp_ntz, until timestamp_ntz"
    a = J.interval_merge(spark.createDataFrame(rows, schema), "provider")
    b = J.interval_merge(spark.createDataFrame(rows[::-1], schema), "provider")
    key = lambda df: sorted(map(tuple, df.select("since", "until").collect()))
    assert key(a) == key(b) == key(J.interval_merge(a, "provider"))


def test_upsert_twice_is_upsert_once(spark):
    t = dt.datetime(2024, 1, 1)
    schema = "_id string, digest string, provider string, observed_at timestamp_ntz, classification string"
    stored = spark.createDataFrame([("a", "1", "p", t, "c"), ("b", "1", "p", t, None)], schema)
    batch = spark.createDataFrame([("a", "2", "p", t, 1), ("a", "3", "p", t, 2), ("c", "1", "p", t, 3)], "_id string, digest string, provider string, observed_at timestamp_ntz, pos int").withColumn("classification", F.lit(None).cast("string"))
    once = O.upsert_apply(stored, O.upsert_classify(stored, batch), ["classification"])
    twice = O.upsert_apply(once, O.upsert_classify(once, batch), ["classification"])
    rows = sorted((r._1, r.d, r.c) for r in once.select(C("_id").alias("_1"), C("digest").alias("d"), C("classification").alias("c")).collect())
    assert rows == [("a", "3", "c"), ("b", "1", None), ("c", "1", None)]
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    with pytest.raises(ValueError):
        O.upsert_classify(stored, batch, "ask")


def test_one_fresh_failure_marks_its_whole_run(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = [("p", 0, "a", t(0)), ("p", 1, "a", t(20)), ("p", 1, "b", t(20)), ("p", 2, "a", t(30)), ("p", 3, "a", t(45))]
    runs = spark.createDataFrame([(p, run, at, "x", who, "u", "e") for p, run, who, at in rows], "provider string, run long, run_at timestamp_ntz, phase string, identity string, url string, error string")
    got = [(r.run, r.fresh, r.alert) for r in M.alert_runs(runs, 24).orderBy("run").collect()]
    assert got == [(0, 1, True), (1, 1, True), (2, 0, False), (3, 1, True)]


def test_schema_problems(spark):
    df = spark.createDataFrame([], "_id string, code string, status string, extra int, schema_version int, title string, observed_at timestamp, source string")
    assert V.schema_problems(df.schema) == ["missing:details", "old:status", "unknown:extra"]


def test_empty_tables_do_not_fail(spark):
    w = spark.createDataFrame([], "provider string, since timestamp_ntz, until timestamp_ntz")
    assert J.interval_merge(w, "provider").collect() == [] and J.interval_clamp(w, F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-01-02").cast("timestamp_ntz")).collect() == []


def test_registry_warns_and_skips(caplog):
    from advisorium.plans.sources_registry import ProviderRules, SourceRegistry

    assert ProviderRules.of({"identity": "x"}) is None and ProviderRules.of({"identity": ["x"]}).identity == ("x",)
    r = SourceRegistry()
    r.register("nvd", lambda df: df)
    assert r["nvd"].rules.title == ("title",) and r.keys() == ["nvd"]
    with pytest.raises(ValueError):
        r.register("nvd", lambda df: df)


def test_dictionary_terms_of_any_length_and_script(spark):
    from advisorium.operators.matching import text_matches

    texts = spark.createDataFrame([(1, "Flaw in Log4j-Core and ASP.NET"), (2, "the big red apache web server is Größe 4")], "id long, text string")
    terms = spark.createDataFrame([("log4j-core",), ("asp.net",), ("big red apache web server",), ("größe",), ("gr",), ("",)], "term string")
    assert {(r.id, r.term, r.pos) for r in text_matches(texts, terms).collect()} == {(1, "log4j-core", 2), (1, "asp.net", 5), (2, "big red apache web server", 1), (2, "größe", 7)}


def test_product_tree_is_followed_to_its_end(spark):
    import pytest

    from advisorium.operators.documents import product_tree

    chain = spark.createDataFrame([(f"n{k}", f"n{k - 1}" if k else None, "x") for k in range(18)], "id string, parent string, name string").coalesce(1)
    assert product_tree(chain).count() == 18
    circle = spark.createDataFrame([("r", None, "x"), ("a", "r", "x"), ("b", "a", "x"), ("a", "b", "x")], "id string, parent string, name string")
    with pytest.raises(ValueError):
        product_tree(circle)


@pytest.mark.parametrize("html,headers,gate,blocked", [
    ("<script>var __jsl_clearance</script>", None, False, True), ("<SCRIPT src='//x/EOJSChallengeSDK.js'>", None, False, True), ('<textarea id="renderData">', None, False, True), ("<p>sigchl</p><TABLE>", None, False, False),
    ("Access denied bug", None, False, False), ("solve the captcha", None, False, False), ('<img src="data:image/png;x"><input type="text"> _waf_', None, True, False), ("<img src=DATA:image/gif>验证码", None, True, False),
    ("<img src=data:image/gif>", None, False, False), ("<table>", {"punish-type": "1"}, False, True), ("<p>", {"Punish-Type": ""}, False, False), ("Tencent Cloud EdgeOne", {}, False, True), (None, None, False, False),
])
def test_challenge_pages(spark, html, headers, gate, blocked):
    row = spark.createDataFrame([(html, headers)], "h string, m map<string,string>").select(X.captcha_gate(C("h")).alias("gate"), X.page_blocked(C("h"), C("m")).alias("blocked")).first()
    assert (row.gate, row.blocked) == (gate, blocked)


def test_path_delete(spark):
    f = lambda x: N.path_delete(x, "a.b", "c", "d.e.f")
    assert one(spark, f, '{"a":{"b":1,"k":[{"b":2}]},"c":null,"d":{"e":5}}') == '{"a":{"k":[{"b":2}]},"d":{"e":5}}'
    assert one(spark, f, '{"a":[1],"é":"x"}') == '{"a":[1],"é":"x"}' and one(spark, f, "no json") == "no json" and one(spark, f, None) is None


def test_spanned_cell_moves_past_every_taken_column(spark):
    html = "<table><tr><td>a</td><td rowspan=2>b</td><td>c</td></tr><tr><td colspan=2>d</td></tr><tr><td colspan=1000000000>e</td></tr></table>"
    grid = one(spark, T.html_tables_grid, html)[0]
    assert grid[0][:3] == ["a", "b", "c"] and grid[1][:4] == ["", "b", "d", "d"] and len(grid[0]) == 1000


@pytest.mark.parametrize("status,want", [
    ("classified", {"vendor": "v", "cpe": "c", "confidence": 0.5, "attempts": 2, "error": "e", "method": "m", "updated_at": None, "candidate": None}),
    ("failed", {"vendor": None, "error": "e", "attempts": 2, "method": "m", "confidence": None, "queued_at": dt.datetime(2024, 1, 1, 16)}),
    ("unclassified", {"vendor": None, "reason": "r", "error": None, "queued_at": None, "updated_at": dt.datetime(2024, 1, 2, 3), "method": None}), ("error", None), (None, None),
])
def test_stored_classification(spark, status, want):
    from advisorium.operators import classify as K

    cols = {"vendor": F.lit("v"), "best_vendor": F.lit("bv"), "cpe": F.lit("c"), "confidence": F.lit("0.5"), "attempts": F.lit(2), "error": F.lit("e"), "method": F.lit("m"), "reason": F.lit("r"), "queued_at": F.lit("2024-01-02"), "classified_at": F.lit("2024-01-02T03:00:00Z"), "taxonomy_version": F.lit("t")}
    got = one(spark, lambda s: K.shape(s, cols), status)
    if want is None:
        assert got is None
        return
    assert {k: got[k] for k in want} == want and (got.status, got.dictionary_version, got.classifier_version) == (status, "t", 2)
    assert (got.candidate is not None) == (status == "unclassified") and (got.candidate is None or (got.candidate.vendor, got.candidate.cpe) == ("bv", "c"))


def test_closed_envelope(spark):
    row = "'cve' AS provider, 'cve:1' AS _id, 2 AS schema_version, current_timestamp() AS observed_at, '{}' AS details, 'x' AS classification, CAST(NULL AS array<string>) AS cve_ids, 'High' AS severity"
    more = "'' AS code, CAST(NULL AS string) AS title, 'gone' AS change_type, named_struct('provider', 'zz', 'url', '', 'detail_url', CAST(NULL AS string)) AS source, array('provider', 'extra') AS source_keys, 'error' AS classification_status, 'soon' AS published_at, '2024-01-02' AS updated_at"
    df = spark.sql(f"SELECT {row}, {more}")
    got = df.select(V.violations(C("provider"), {c: C(c) for c in df.columns}).alias("v")).first().v
    assert got == ["no_code", "no_title", "change_type", "source_provider", "source_address", "source_field", "classification_status", "published_at_date"]
    bare = spark.sql(f"SELECT {row}")
    assert bare.select(V.violations(C("provider"), {c: C(c) for c in bare.columns}).alias("v")).first().v == []


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_alerts_do_not_depend_on_the_order_of_files(spark, tmp_path, order):
    from advisorium.streaming import stream as W

    cols = "provider string, run long, run_at timestamp_ntz, phase string, identity string, url string, error string"
    row = lambda run, day, who: ("p", run, dt.datetime(2024, 1, day), "x", who, "u", "e")
    files = [[row(1, 1, "a")], [row(2, 2, "a"), row(2, 2, "b")], [row(3, 9, "a")]]
    for k in (*order, None):
        rows = files[k] if k is not None else [("p", None, dt.datetime(2025, 1, 1), None, None, None, None)]
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = W.drain(W.alert_stream(W.read_files(spark, str(tmp_path / "in"), cols, 1), 48, late="60 days"), "append")
    want = M.alert_runs(spark.createDataFrame(sum(files, []), cols), 48)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 3
