"""Nested documents: compaction, paths, merging.  Structs are rewritten by expressions generated from their type."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def compact(c: Column, kind: T.DataType) -> Column:
    """Null, '', [] and empty structs become null, from the inside out; texts are trimmed, False and 0 stay."""
    if isinstance(kind, T.StringType):
        return F.nullif(F.trim(c), F.lit(""))
    if isinstance(kind, T.ArrayType):
        kept = F.filter(F.transform(c, lambda x: compact(x, kind.elementType)), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(kind, T.StructType):
        fields = [compact(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        filled = F.lit(False)
        for f in fields:
            filled = filled | f.isNotNull()
        return F.when(filled, F.struct(*fields))
    if isinstance(kind, T.MapType):
        kept = F.map_filter(F.transform_values(c, lambda _, v: compact(v, kind.valueType)), lambda _, v: v.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    return c


def _compact_value(x: object) -> object:
    if isinstance(x, dict):
        return {k: v for k, y in x.items() if (v := _compact_value(y)) is not None} or None
    if isinstance(x, list):
        return [v for y in x if (v := _compact_value(y)) is not None] or None
    return (x.strip() or None) if isinstance(x, str) else x


def _compact_text(text: str | None) -> str | None:
    try:
        value = _compact_value(json.loads(text)) if text else None
    except ValueError:
        return None
    return None if value is None else json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def compact_json(doc: Column) -> Column:
    """The same for open documents as JSON text, keys sorted; unreadable text gives null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(_compact_text)

    return run(doc)


def path_get(doc: Column, path: str) -> Column:
    """The text at a dotted path of JSON text; null where missing or empty."""
    return F.nullif(F.trim(F.get_json_object(doc, "$." + path)), F.lit(""))


def path_delete(doc: Column, *paths: str) -> Column:
    """JSON text without the values at dotted paths; where a path leads through something else than an object nothing changes."""
    import json

    def without(text: str | None) -> str | None:
        try:
            value = json.loads(text) if text is not None else None
        except ValueError:
            return text
        for path in paths:
            *way, last = path.split(".")
            node = value
            for key in way:
                node = node.get(key) if isinstance(node, dict) else None
            if isinstance(node, dict):
                node.pop(last, None)
        return None if value is None else json.dumps(value, ensure_ascii=False, separators=(",", ":"))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(without)

    return run(doc)


def path_first(doc: Column, paths: list[str]) -> Column:
    return F.coalesce(*[path_get(doc, p) for p in paths]) if paths else F.lit(None).cast("string")


def drop_keys(doc: Column, *names: str) -> Column:
    """JSON text of a flat object without the named keys, and without keys that begin with raw."""
    m = F.from_json(doc, "map<string,string>")
    kept = F.map_filter(m, lambda k, v: ~k.isin(*names) & ~k.startswith("raw") & v.isNotNull() & (F.trim(v) != "")) if names else F.map_filter(m, lambda k, v: ~k.startswith("raw") & v.isNotNull() & (F.trim(v) != ""))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept))))


def detail_flatten(details: Column, provider: Column) -> Column:
    """The details of the provider where they are nested under its name, else the details themselves."""
    return F.coalesce(F.try_element_at(details, provider), F.try_element_at(details, F.lit("*")))


def source_clean(provider: Column, url: Column, detail: Column) -> Column:
    """struct(provider, url, detail_url): blanks out, a url that only repeats the detail url out."""
    u, v = F.nullif(F.trim(url), F.lit("")), F.nullif(F.trim(detail), F.lit(""))
    return F.struct(provider.alias("provider"), F.when(~u.eqNullSafe(v), u).alias("url"), v.alias("detail_url"))


def change_type(status: Column) -> Column:
    low = F.lower(F.trim(status))
    return F.when(low == "new", "new").when(low.isin("update", "updated"), "updated")


def source_status(status: Column, severity: Column, details: Column) -> Column:
    """A status that is no change type stays, unless it repeats the severity or any detail text."""
    repeats = (F.lower(status) == F.lower(F.coalesce(severity, F.lit("")))) | F.exists(F.map_values(details), lambda v: F.lower(v) == F.lower(status))
    return F.when(change_type(status).isNull() & ~F.coalesce(repeats, F.lit(False)), F.nullif(F.trim(status), F.lit("")))


def dedupe_by_key(items: Column, key, kind: str) -> Column:
    """The first item for each key; items without a key are told apart by their JSON."""
    full = lambda x: F.coalesce(key(x), F.to_json(x))
    keep = lambda acc, x: F.when(F.exists(acc, lambda y: full(y) == full(x)), acc).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(items, F.array().cast(f"array<{kind}>"), keep)


def pick_language(texts: Column, lang: str = "en") -> Column:
    """The first text in the language that isn't blank, else the first that isn't blank."""
    filled = F.filter(texts, lambda d: F.trim(d.value) != "")
    return F.coalesce(F.get(F.filter(filled, lambda d: F.lower(d.lang).startswith(lang)), F.lit(0)).value, F.get(filled, F.lit(0)).value)


def merge_containers(first: Column, others: Column, name: str) -> Column:
    """A list field over the main container and all added ones, in order."""
    return F.flatten(F.transform(F.concat(F.array(first), others), lambda c: F.coalesce(c[name], F.array().cast("array<string>"))))


def names_of(ids: Column, names: Column) -> Column:
    """Names by identifier, unknown ones dropped, order kept."""
    return F.array_compact(F.transform(ids, lambda i: F.try_element_at(names, i)))


def fill(detail: Column, listing: Column, kind: T.DataType) -> Column:
    """The detail's value, the listing's where it is missing; arrays are united, the detail's first."""
    if isinstance(kind, T.ArrayType):
        empty = F.array().cast(kind)
        return F.array_distinct(F.concat(F.coalesce(detail, empty), F.coalesce(listing, empty)))
    if isinstance(kind, T.StringType):
        return F.coalesce(F.nullif(F.trim(detail), F.lit("")), F.nullif(F.trim(listing), F.lit("")))
    return F.coalesce(detail, listing)
