"""One text for every value: equal values have equal texts, different ones different texts.

The text is JSON in a fixed form, made by expressions that follow the type of the column, so no
Python runs and nothing has to be guessed from a printed value:

* fields of a struct by name, null ones left out (a typed column cannot tell null from absent);
* maps by ascending key, whatever their order; an entry whose value is null stays and differs from no entry;
* lists element by element, null elements included;
* texts quoted, with backslash and quote escaped, so separators and the word null in a text mean nothing;
* numbers by value: 1, 1.0 and 1.00 are one number, also across integer, decimal and double;
* instants in UTC, cut to milliseconds, marked as dates; a timestamp without a zone is UTC already;
* variants with the same rules; a double in exponent form keeps its fraction (1e2 is 100.0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = 1e15  # doubles below are exact as integers


def quoted(text: Column) -> Column:
    """A JSON text; line ends and other control characters stay as they are, which keeps it one-to-one."""
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def _dated(text: Column) -> Column:
    return F.concat(F.lit('{"$date":"'), text, F.lit('"}'))


def _millis(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSS")


def _entry(key: Column, value: Column) -> Column:
    return F.concat(key, F.lit(":"), value)


def canonical_text(c: Column, kind: T.DataType) -> Column:
    """The text of a value of this type; null where the value is null."""
    inner = lambda x, k: F.coalesce(canonical_text(x, k), F.lit("null"))
    if isinstance(kind, T.StructType):
        fields = [_entry(F.lit(f'"{f.name}"'), canonical_text(c[f.name], f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(c.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: _entry(quoted(e["key"].cast("string")), inner(e["value"], kind.valueType)))
        return F.concat(F.lit("{"), F.array_join(F.array_sort(entries), ","), F.lit("}"))
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: inner(x, kind.elementType)), ","), F.lit("]"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = c.cast("double")
        return F.when((c == F.floor(c)) & (F.abs(c) < WHOLE), c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    if isinstance(kind, T.DecimalType):
        shown = c.cast("string")
        return F.when(shown.contains("."), F.regexp_replace(shown, r"\.?0+$", "")).otherwise(shown)
    if isinstance(kind, T.VariantType):
        return F.to_json(c)
    if isinstance(kind, T.TimestampType):
        return _dated(_millis(F.convert_timezone(None, F.lit("UTC"), c.cast("timestamp_ntz"))))
    if isinstance(kind, T.TimestampNTZType):
        return _dated(_millis(c))
    if isinstance(kind, T.DateType):
        return _dated(c.cast("string"))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit('{"$binary":"'), F.base64(c), F.lit('"}'))
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return quoted(c)
    return c.cast("string")


def canonical_fields(doc: Column) -> Column:
    """map of field to canonical text for a document as JSON text: nested objects have their keys sorted, a null field stays; null where it is no object."""
    return F.transform_values(F.from_json(doc, "map<string,variant>"), lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))
