"""Content comparison: literal cases of what is the same document and what is not."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from advisorium.functions.canonical import canonical_text
from advisorium.operators import documents as O

BASE = "struct<_id:string,title:string,names:array<string>,facts:map<string,string>,deep:struct<m:map<string,array<struct<x:int,y:string>>>>,updated_at:timestamp_ntz,observed_at:timestamp_ntz,source:struct<provider:string,url:string>,classification:string>"
AT = dt.datetime(2026, 11, 10, 8, 12, 13, 123456)


def row(**changes):
    base = {
        "_id": "a:1", "title": "t", "names": ["x", "y"], "facts": {"a": "1", "b": "2"}, "deep": {"m": {"k": [{"x": 1, "y": "z"}], "l": []}}, "updated_at": AT, "observed_at": AT,
        "source": {"provider": "avd", "url": "u"}, "classification": None,
    }
    return {**base, **changes}


CASES = [
    ({}, True), ({"facts": {"b": "2", "a": "1"}}, True), ({"deep": {"m": {"l": [], "k": [{"x": 1, "y": "z"}]}}}, True), ({"observed_at": None}, True), ({"classification": "c"}, True), ({"source": {"provider": "avd", "url": "other"}}, True),
    ({"updated_at": AT.replace(microsecond=123999)}, True), ({"updated_at": AT.replace(microsecond=124000)}, False), ({"names": ["y", "x"]}, False), ({"names": ["x, y"]}, False), ({"names": ["x", None, "y"]}, False),
    ({"names": ["x", "null"]}, False), ({"names": []}, False), ({"names": None}, False), ({"title": None}, False), ({"title": "~"}, False), ({"title": "t|updated_at="}, False), ({"title": 't","x":"'}, False), ({"title": "t\\"}, False),
    ({"facts": {"a": "1", "b": None}}, False), ({"facts": {"a": "1"}}, False), ({"facts": {"a": "2", "b": "1"}}, False), ({"facts": {}}, False), ({"facts": None}, False), ({"deep": {"m": {"k": [{"x": 1, "y": None}], "l": []}}}, False),
    ({"deep": None}, False), ({"source": {"provider": "nvd", "url": "u"}}, False), ({"source": None}, False), ({"updated_at": None}, False),
]


def test_same_and_different_documents(spark):
    rows = [(n, row(**changes)) for n, (changes, _) in enumerate(CASES)]
    later = spark.createDataFrame(rows, f"n int, d {BASE}").select(F.concat(F.lit("case-"), F.col("n").cast("string")).alias("_id"), *[F.col(f"d.{c}") for c in row() if c != "_id"])
    stored = later.select("_id").join(spark.createDataFrame([row()], BASE.removeprefix("struct<").removesuffix(">")).drop("_id"))
    got = {r._id: r.same for r in O.documents_match(stored, later).collect()}
    assert got == {f"case-{n}": same for n, (_, same) in enumerate(CASES)}


def test_same_document_in_other_types_and_orders(spark):
    one = spark.createDataFrame([("i", 1, 2.5, ["a"])], "_id string, n int, m double, names array<string>").withColumn("source", F.struct(F.lit("nvd").alias("provider")))
    two = spark.createDataFrame([(["a"], decimal.Decimal("2.50"), 1.0, "i")], "names array<string>, m decimal(9,2), n double, _id string").withColumn("source", F.struct(F.lit("u").alias("url"), F.lit("nvd").alias("provider")))
    two = two.withColumn("added", F.lit(None).cast("string"))
    assert [r.same for r in O.documents_match(one, two).collect()] == [True]
    assert [r.same for r in O.documents_match(one, two.where("n > 1")).collect()] == [False]


@pytest.mark.parametrize(
    "value,kind,text",
    [
        (1.0, "double", "1"), (-0.0, "double", "0"), (1.25, "double", "1.25"), (1e300, "double", "1.0E300"), (float("nan"), "double", "NaN"), (decimal.Decimal("100.00"), "decimal(9,2)", "100"), (decimal.Decimal("100"), "decimal(9,0)", "100"),
        (True, "boolean", "true"), ('a"b\\c', "string", '"a\\"b\\\\c"'), ({}, "map<string,int>", "{}"), ([], "array<int>", "[]"), ([None], "array<int>", "[null]"), ({"b": None, "a": 1}, "map<string,int>", '{"a":1,"b":null}'), (None, "array<int>", None),
        (dt.datetime(2026, 1, 2, 3, 4, 5, 6789), "timestamp_ntz", '{"$date":"2026-01-02 03:04:05.006"}'), (dt.date(2026, 1, 2), "date", '{"$date":"2026-01-02"}'), (bytearray(b"ab"), "binary", '{"$binary":"YWI="}'), ({"x": None, "y": None}, "struct<y:int,x:int>", "{}"),
    ],
)
def test_text_of_a_value(spark, value, kind, text):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert df.select(canonical_text(F.col("v"), df.schema["v"].dataType)).first()[0] == text


def test_zoned_instants_are_utc(spark):
    df = spark.sql("SELECT timestamp'2026-11-10 16:12:13.123456+08:00' AS v, timestamp_ntz'2026-11-10 08:12:13.123999' AS w")
    assert len({df.select(canonical_text(F.col(c), df.schema[c].dataType)).first()[0] for c in "vw"}) == 1


@pytest.mark.parametrize(
    "one,two,same",
    [
        ('{"a":1,"b":{"c":[1,2],"d":null}}', '{"b":{"d":null,"c":[1.0,2]},"a":1}', True), ('{"a":null}', "{}", False), ('{"a":"null"}', '{"a":null}', False), ('{"a":[1,2]}', '{"a":[2,1]}', False), ('{"_id":1,"observed_at":2}', '{"_id":3}', True),
        ('{"source":{"provider":"x","url":1}}', '{"source":{"provider":"x"}}', True), ('{"source":{"provider":"x"}}', '{"source":{"provider":"y"}}', False), ('{"a":"\\u00e9"}', '{"a":"é"}', True), ("[1]", "[1]", None), ("bad", "{}", None),
    ],
)
def test_open_documents(spark, one, two, same):
    a, b = spark.createDataFrame([(one, two)], "a string, b string").select(O.json_content_payload(F.col("a")), O.json_content_payload(F.col("b"))).first()
    assert (None if a is None or b is None else a == b) == same


def test_envelope_date_is_read_once_a_row(spark):
    plan = O.build_document(spark.createDataFrame([], "provider string, code string, title string, cve_raw string, severity_raw string, published_raw string, updated_raw string, observed_at timestamp_ntz, url string, detail_url string, status string, details map<string,string>"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    details = text[text.index("map_filter") : text.index("AS details")]
    assert "_published" in details and "published_raw" not in details
