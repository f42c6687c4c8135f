"""Chat formatting with tool calls (DataFrame functions only).

Calls and results are linked by a hash join on their identifier, ordered so that a call comes after
every call whose result it uses, checked against the schema of their tool, and serialised as
canonical JSON: keys sorted, no white space, nulls left out, one spelling for each number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: tool -> argument -> (type, required).  Types: string, integer, number, boolean.
ToolSchemas = dict[str, dict[str, tuple[str, bool]]]

CALLS = "conv_id long, turn long, call_id string, name string, arguments map<string,string>, uses array<string>"
RESULTS = "conv_id long, call_id string, content string"

_PATTERNS = {"integer": r"\A-?(0|[1-9][0-9]*)\z", "number": r"\A-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?\z", "boolean": r"\A(true|false)\z"}


def fits(value: Column, kind: str) -> Column:
    """Whether a text is a value of a type; numbers beyond a double are none."""
    ok = value.rlike(_PATTERNS[kind])
    return ok & (F.abs(value.try_cast("double")) < float("inf")) if kind == "number" else ok


def canonical_value(value: Column, kind: str) -> Column:
    """One spelling for each value: integers keep all digits, other numbers are doubles, plain from 0.0001 up to 10**16 and with an exponent beyond."""
    if kind == "boolean":
        return value
    whole = F.regexp_replace(value, r"\A-0\z", "0")
    if kind == "integer":
        return whole
    x = value.try_cast("double")
    digits = F.regexp_replace(F.regexp_replace(x.try_cast("decimal(38,20)").cast("string"), r"\.?0+\z", ""), r"\A-0\z", "0")
    short = F.regexp_replace(F.regexp_replace(F.lower(x.cast("string")), r"\.0e", "e"), r"e(?=[0-9])", "e+")
    plain = (x == 0) | F.abs(x).between(1e-4, 1e16)
    return F.when(value.rlike(_PATTERNS["integer"]), whole).when(x == 0, "0").when(plain, F.when(x == F.floor(x), x.try_cast("decimal(38,0)").cast("string")).otherwise(digits)).otherwise(short)


def json_string(value: Column) -> Column:
    """A JSON string literal of a text."""
    return F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def argument_errors(name: Column, arguments: Column, schemas: ToolSchemas) -> Column:
    """The sorted violations of one call: unknown tool, missing, unexpected or ill-typed arguments."""
    known = F.array(*[F.lit(t) for t in sorted(schemas)])
    rules = [F.when(name.isNull() | ~F.array_contains(known, name), F.lit("unknown_tool"))]
    given = F.coalesce(arguments, F.create_map().cast("map<string,string>"))
    for tool, fields in sorted(schemas.items()):
        allowed = F.array(*[F.lit(f) for f in fields]).cast("array<string>")
        rules.append(F.when((name == tool) & (F.size(F.array_except(F.map_keys(given), allowed)) > 0), F.lit("unexpected_argument")))
        for field, (kind, required) in sorted(fields.items()):
            value = F.try_element_at(given, F.lit(field))
            if required:
                rules.append(F.when((name == tool) & value.isNull(), F.lit(f"missing:{field}")))
            if kind in _PATTERNS:
                rules.append(F.when((name == tool) & value.isNotNull() & ~fits(value, kind), F.lit(f"type:{field}")))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*rules))))


def canonical_arguments(name: Column, arguments: Column, schemas: ToolSchemas) -> Column:
    """Arguments as canonical JSON: sorted keys; values of a typed argument that pass its type stand bare, all others are strings."""
    typed = {k: F.array(*[F.lit(f"{t}\u0001{f}") for t, fs in sorted(schemas.items()) for f, (kind, _) in sorted(fs.items()) if kind == k]).cast("array<string>") for k in _PATTERNS}

    def one(entry: Column) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for kind, names in typed.items():
            own = F.coalesce(F.array_contains(names, F.concat(name, F.lit("\u0001"), entry.key)), F.lit(False))
            out = out.when(own & fits(entry.value, kind), canonical_value(entry.value, kind))
        return F.concat(json_string(entry.key), F.lit(":"), out.otherwise(json_string(entry.value)))

    entries = F.array_sort(F.filter(F.map_entries(F.coalesce(arguments, F.create_map().cast("map<string,string>"))), lambda e: e.value.isNotNull()))
    return F.concat(F.lit("{"), F.array_join(F.transform(entries, one), ","), F.lit("}"))


def call_depths(calls: DataFrame) -> DataFrame:
    """calls(conv_id, call_id, uses) -> conv_id, call_id, depth: 0 without uses, else one more than the deepest call used.

    Chains of calls that use one other call each are followed by doubling: each round a pointer jumps
    as far again, so their rounds grow with the logarithm of their length.  Calls that use several are
    then placed level by level.  Uses of calls that do not exist in the conversation do not count.
    Calls in or behind a circle get no depth (null).
    """
    keys = ["conv_id", "call_id"]
    nodes = calls.select(*keys).distinct()
    needs = (
        calls.select(*keys, F.explode("uses").alias("use")).distinct()
        .join(nodes.select("conv_id", F.col("call_id").alias("use")), ["conv_id", "use"])
    )
    needs = written(needs.select(*keys, "use"), "needs")
    if needs.isEmpty():
        return nodes.withColumn("depth", F.lit(0))
    counts = written(needs.groupBy(*keys).agg(F.count("*").alias("n"), F.min("use").alias("to")), "counts")
    jump = written(counts.where("n = 1").select(*keys, "to", F.lit(1).alias("steps")), "jump")
    longest = jump.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(int(longest).bit_length()):
        far = jump.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("further"), F.col("steps").alias("more"))
        moved = jump.join(far, ["conv_id", "to"], "left")
        jump = written(moved.select(*keys, F.coalesce("further", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "jump")
    ends = jump.join(counts.where("n = 1").select("conv_id", F.col("call_id").alias("to")), ["conv_id", "to"], "left_anti")  # the others run in a circle
    chains = written(ends.select(*keys, "to", "steps"), "chains")

    placed = written(nodes.join(counts, keys, "left_anti").withColumn("depth", F.lit(0)), "placed")
    several = needs.join(counts.where("n > 1").select(*keys), keys, "left_semi")
    along = chains.select("conv_id", F.col("call_id").alias("use"), "to", "steps")
    single = counts.where("n = 1").select("conv_id", F.col("call_id").alias("use"), F.lit(True).alias("single"))
    open_needs = several.join(along, ["conv_id", "use"], "left").join(single, ["conv_id", "use"], "left")
    open_needs = written(open_needs.select(*keys, F.when(F.col("to").isNull() & F.col("single").isNull(), F.col("use")).otherwise(F.col("to")).alias("to"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps")), "open")
    while not open_needs.isEmpty():
        known = placed.select("conv_id", F.col("call_id").alias("to"), "depth")
        ready = open_needs.join(known, ["conv_id", "to"], "left").groupBy(*keys).agg(F.count("*").alias("n"), F.count("depth").alias("there"), F.max(F.col("depth") + F.col("steps")).alias("depth"))
        ready = written(ready.where("n = there").select(*keys, "depth"), "ready")
        if ready.isEmpty():
            break
        placed = written(placed.unionByName(ready), "placed")
        open_needs = written(open_needs.join(ready.select(*keys), keys, "left_anti"), "open")
    hung = chains.join(placed.select("conv_id", F.col("call_id").alias("to"), F.col("depth").alias("base")), ["conv_id", "to"]).select(*keys, (F.col("base") + F.col("steps")).alias("depth"))
    return nodes.join(placed.unionByName(hung), keys, "left")


def format_chat(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: ToolSchemas) -> DataFrame:
    """messages(conv_id, turn, role, text), calls and results as in CALLS and RESULTS -> one row per message, call and result.

    Columns: conv_id, turn, depth, kind ('message', 'call', 'result'), item_id, status, errors, json.
    Sorting a conversation by (turn, depth, kind, item_id) reads it in order: a message, then its
    calls in topological order, each followed by its results.  ``status`` of a call is 'linked', 'no_result',
    'several_results' or, if its dependencies run in a circle, 'circular'; of a result 'linked' or
    'no_call'.  Results without a call keep turn and depth null.  Null text counts as empty; rows
    that repeat wholly come back once; null ids link with nothing.  Empty tables give empty parts;
    other columns are not read.  No conversation is gathered into one task.
    """
    messages = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "uses")
    results = results.select("conv_id", "call_id", "content").distinct()
    keys = ["conv_id", "call_id"]

    said = messages.distinct().select(
        "conv_id", "turn", F.lit(0).alias("depth"), F.lit("message").alias("kind"), F.lit("").alias("item_id"), F.lit("ok").alias("status"),
        F.lit("").alias("errors"),
        F.concat(F.lit('{"content":'), json_string(F.coalesce("text", F.lit(""))), F.lit(',"role":'), json_string(F.coalesce("role", F.lit(""))), F.lit("}")).alias("json"),
    )
    numbers = results.groupBy(*keys).agg(F.count("*").alias("n_results"))
    depths = call_depths(calls.where("call_id is not null"))
    linked = calls.join(depths, keys, "left").join(numbers, keys, "left")
    status = (
        F.when(F.col("call_id").isNotNull() & F.col("depth").isNull(), "circular").when(F.col("n_results").isNull(), "no_result")
        .when(F.col("n_results") > 1, "several_results").otherwise("linked")
    )
    asked = linked.select(
        "conv_id", "turn", "depth", F.lit("call").alias("kind"), F.col("call_id").alias("item_id"), status.alias("status"),
        F.array_join(argument_errors(F.col("name"), F.col("arguments"), schemas), ",").alias("errors"),
        F.concat(
            F.lit('{"arguments":'), canonical_arguments(F.col("name"), F.col("arguments"), schemas), F.lit(',"id":'), json_string(F.coalesce("call_id", F.lit(""))),
            F.lit(',"name":'), json_string(F.coalesce("name", F.lit(""))), F.lit(',"type":"tool_call"}'),
        ).alias("json"),
    ).distinct()
    place = asked.groupBy("conv_id", F.col("item_id").alias("call_id")).agg(F.min(F.struct("turn", "depth")).alias("at"), F.lit(1).alias("found"))
    told = results.join(place, keys, "left").select(
        "conv_id", "at.turn", "at.depth", F.lit("result").alias("kind"), F.col("call_id").alias("item_id"),
        F.when(F.col("found").isNull(), "no_call").otherwise("linked").alias("status"), F.lit("").alias("errors"),
        F.concat(
            F.lit('{"content":'), json_string(F.coalesce("content", F.lit(""))), F.lit(',"role":"tool","tool_call_id":'),
            json_string(F.coalesce("call_id", F.lit(""))), F.lit("}"),
        ).alias("json"),
    )
    return said.unionByName(asked).unionByName(told)
