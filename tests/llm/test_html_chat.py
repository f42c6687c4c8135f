import json

import pytest

from advisorium.llm.chat_tools import CALLS, RESULTS, call_depths, canonical_value, fits, format_chat
from advisorium.llm.html_wrapper import align, content_paths, extract_main_text, infer_wrappers, main_text, page_tree

PAGE = (
    '<html><head><title>t</title></head><body><div class="menu"><a href=/>Home</a></div><header>Site</header><div id="content"><h2>T{i} &amp; x</h2>{ps}'
    '<div class="cookie-notice"><p>ok?</p></div><div class="comments"><p>nice</p></div></div><form>q<input></form><aside>side</aside><script>var x="<p>";</script><footer>&copy; f</footer></body></html>'
)


def page(i, n):
    return PAGE.replace("{i}", str(i)).replace("{ps}", "".join(f"<p>One<b>two</b>  three\n {i}{k}" for k in range(n)))


def want(i, n):
    return " ".join([f"T{i} & x"] + [f"Onetwo three {i}{k}" for k in range(n)])


def test_article_of_pages_without_article_tag(spark):
    rows = [(i, f"https://H{i % 2}.example.org/p", page(i, 1 + i % 4)) for i in range(12)]
    rows += [(50, "https://h0.example.org/p", None), (51, None, "<article>lone &lt;text</article>"), (52, "https://h1.example.org/p", ""), (53, "https://h1.example.org/p", page(9, 2)), (53, "https://h1.example.org/p", page(9, 2))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string").repartition(4)
    got = sorted((r.page_id, r.text) for r in extract_main_text(df).collect())
    expected = [(i, want(i, 1 + i % 4)) for i in range(12)] + [(50, ""), (51, "lone <text"), (52, ""), (53, want(9, 2)), (53, want(9, 2))]
    assert got == sorted(expected)
    assert extract_main_text(df.limit(0)).collect() == []


def test_wrapper_has_groups_and_slots(spark):
    df = spark.createDataFrame([(i, "https://h.example.org/", page(i, 1 + i)) for i in range(3)], "page_id long, url string, html string")
    w = infer_wrappers(df).first()
    assert "(<p>" in w.wrapper and ")+" in w.wrapper and "#TEXT" in w.wrapper and "html/body/div.content/p" in w.paths


def test_optional_and_cut_pages():
    a, b = page_tree("<article><h1>x</h1><p>a</p></article>"), page_tree("<article><h1>y</h1><ul><li>q<li>r</ul><p>b</article>")
    w = align(a, b)
    assert "(<ul>" in str(w) and ")?" in str(w)
    paths = frozenset(content_paths(w))
    assert main_text("<article><h1>y</h1><p>cut <b>of", paths | {"article/p/b"}) == "y cut of"


def texts_of(spark, bodies, host="https://mix.example.org/"):
    df = spark.createDataFrame([(i, host, f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)], "page_id long, url string, html string").repartition(3)
    return [r.text for r in sorted(extract_main_text(df).collect())]


def test_host_with_several_templates(spark):
    words = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(16)]
    teaser = "".join(f"<article><a href=/>more {k}</a></article>" for k in range(3))
    shapes = ["<article><p>{}</p></article>", "<main><p>{}</p></main>", "<div><p>{}</p></div>", "<article></article><div><p>{}</p></div>"]
    assert texts_of(spark, [shapes[i % 4].format(w) for i, w in enumerate(words)]) == words
    assert texts_of(spark, [f"{teaser}<main><p>{w}</p></main>" for w in words]) == words


def test_constants_inside_the_article_stay(spark):
    body = "<article><h1>T{0}</h1><h2>Summary</h2><p>text {0} <i>by</i> a{0}</p><blockquote>Same words.</blockquote><div class=share>Share this</div>{1}</article>"
    assert texts_of(spark, [body.format(i, "<section>Only here</section>" * (i % 2)) for i in range(8)]) == sorted(f"T{i} Summary text {i} by a{i} Same words." + " Only here" * (i % 2) for i in range(8))
    assert texts_of(spark, ["<article><h1>Same</h1><p>" + "copied " * 60 + "</p></article>"] * 4) == ["Same " + ("copied " * 60).strip()] * 4
    plain = "<div class=x><p>Read our terms.</p></div><div class=story><p>text {0} " + "of many words " * 9 + "{0}</p></div>"
    assert all(t.startswith("text") for t in texts_of(spark, [plain.format(i) for i in range(8)]))


def test_quotes_inside_values_and_deep_pages(spark):
    assert texts_of(spark, ["<article><p title=it's>one</p><p title=\"a>b\">two's</p></article>"]) == ["one two's"]
    deep = "<article>" + "<div><b>" * 5000 + "deep</b> end</div>tail" + "</div>" * 10 + "</article>"
    assert texts_of(spark, [deep]) == ["deep end tail"]


TOOLS = {"add": {"a": ("integer", True), "b": ("integer", True)}, "say": {"text": ("string", True), "loud": ("boolean", False)}}


def test_calls_are_linked_ordered_and_checked(spark):
    messages = spark.createDataFrame([(1, 0, "user", 'Hi "you"\n'), (1, 1, "assistant", None), (1, 0, "user", 'Hi "you"\n'), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    calls = spark.createDataFrame(
        [
            (1, 1, "c1", "add", {"b": "2", "a": "1"}, []), (1, 1, "c2", "add", {"a": "x", "b": "007"}, ["c1"]), (1, 1, "c3", "say", {"text": "ü", "loud": "yes", "x": "1"}, ["c2", "gone"]), (1, 1, "c4", "nope", None, None),
            (1, 1, "r1", "say", {}, ["r2"]), (1, 1, "r2", "say", {"text": "1"}, ["r1"]), (1, 1, None, None, None, None), (1, 1, "c1", "add", {"b": "2", "a": "1"}, []),
        ],
        CALLS,
    )
    results = spark.createDataFrame([(1, "c1", "3"), (1, "c1", "3"), (1, "c2", "x"), (1, "c2", "y"), (1, "zz", None), (2, "c1", "other")], RESULTS)
    rows = format_chat(messages, calls, results, TOOLS).collect()
    by = {(r.kind, r.item_id): r for r in rows if r.conv_id == 1}
    assert {k: by["call", k].depth for k in ("c1", "c2", "c3", "c4", "r1")} == {"c1": 0, "c2": 1, "c3": 2, "c4": 0, "r1": None}
    assert {k: by["call", k].status for k in ("c1", "c2", "c3", "r1")} == {"c1": "linked", "c2": "several_results", "c3": "no_result", "r1": "circular"}
    assert by["call", "c1"].json == '{"arguments":{"a":1,"b":2},"id":"c1","name":"add","type":"tool_call"}' and by["call", "c1"].errors == ""
    assert by["call", "c2"].errors == "type:a,type:b" and by["call", "c3"].errors == "type:loud,unexpected_argument" and by["call", "c4"].errors == "unknown_tool" and by["call", "r1"].errors == "missing:text"
    assert by["result", "zz"].status == "no_call" and by["result", "c1"].depth == 0
    assert sum(r.kind == "message" for r in rows) == 3 and sum(r.kind == "result" for r in rows) == 5
    for r in rows:
        assert r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


@pytest.mark.parametrize("n", [0])
def test_empty_tables(spark, n):
    m = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_chat(m, spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), TOOLS).collect() == []


@pytest.mark.parametrize("text,kind,want", [
    ("5", "integer", "5"), ("-0", "integer", "0"), ("5\n", "integer", None), ("05", "integer", None), ("123456789012345678901234567890", "integer", "123456789012345678901234567890"),
    ("1.50E2", "number", "150"), ("-0.0", "number", "0"), ("1e7", "number", "10000000"), ("12345678.90", "number", "12345678.9"), ("0.00010", "number", "0.0001"), ("1e-7", "number", "1e-7"), ("2.5e20", "number", "2.5e+20"),
    ("1e999", "number", None), ("1.", "number", None), ("1.5\n", "number", None), ("0.1", "number", "0.1"), ("-3", "number", "-3"), ("true", "boolean", "true"), ("True", "boolean", None), ("false\n", "boolean", None),
])
def test_values_have_one_spelling(spark, text, kind, want):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(text,)], "x string").select(fits(F.col("x"), kind).alias("ok"), canonical_value(F.col("x"), kind).alias("v")).first()
    assert bool(row.ok) == (want is not None) and (want is None or (row.v == want and json.loads(row.v) == json.loads(text)))


def depths_by_hand(calls):
    """Longest path by plain recursion over each conversation; None in or behind a circle."""
    out = {}
    for conv in {c for c, _, _ in calls}:
        uses = {i: {u for u in us or [] if u in {j for c, j, _ in calls if c == conv}} for c, i, us in calls if c == conv}

        def depth(i, seen):
            if i in seen:
                return None
            found = [depth(u, seen | {i}) for u in uses[i]]
            return None if None in found else 1 + max(found, default=-1)

        out |= {(conv, i): depth(i, frozenset()) for i in uses}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_depths_equal_plain_recursion(spark, seed):
    import random

    r = random.Random(seed)
    calls = []
    for conv in range(12):
        for k in range(12):
            count = r.choice([0, 1, 1, 1, 2, 3])
            calls.append((conv, f"c{k}", [f"c{r.randrange(12 if r.random() < 0.12 else max(1, k))}" for _ in range(count)] + ["none"] * r.randrange(2)))
    calls += [(99, f"d{k}", [f"d{k - 1}"] if k else None) for k in range(300)] + [(98, "a", ["a"])]
    df = spark.createDataFrame(calls, "conv_id long, call_id string, uses array<string>")
    got = {(x.conv_id, x.call_id): x.depth for x in call_depths(df).collect()}
    small = [c for c in calls if c[0] != 99]
    assert got == depths_by_hand(small) | {(99, f"d{k}"): k for k in range(300)}


def test_chat_with_clashing_columns_and_long_texts(spark):
    long = "x\u2028\"\\ " * 50_000
    messages = spark.createDataFrame([(1, 0, "user", long, 5, "z"), (1, 0, "user", long, 5, "z")], "conv_id long, turn long, role string, text string, depth int, kind string")
    calls = spark.createDataFrame([(1, 0, "c1", "say", {"text": long}, [], "q")], CALLS + ", json string")
    rows = format_chat(messages, calls, spark.createDataFrame([], RESULTS), TOOLS).collect()
    assert [json.loads(r.json) for r in sorted(rows, key=lambda r: r.kind)] == [{"arguments": {"text": long}, "id": "c1", "name": "say", "type": "tool_call"}, {"content": long, "role": "user"}]
