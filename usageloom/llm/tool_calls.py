"""Tool-call linking for chat data.

Messages carry tool calls (``tool_calls``: a JSON array of objects with ``id``,
``name`` and ``arguments``), a result (``tool_call_id``) or both. The operator

* joins results to calls by (conversation, identifier);
* finds which other calls a call needs: every ``{"$ref": "<id>"}`` in its arguments;
* validates the arguments against the tool's schema;
* orders the calls so that each follows what it needs, and each result its call;
* serialises every event as canonical JSON: sorted keys, no spaces, shortest numbers.

Conversations whose calls already follow what they need keep their order. In
the others a call gets a level, the longest chain of calls it needs; calls
on or behind a cycle get none and go last, marked. Levels of a conversation of up to ``TANGLE`` needs are
found in one task; a larger one takes a round of joins per step of its longest chain, which stores that
step's calls alone.

``status`` is ``ok``; ``invalid`` (arguments break the schema, or no JSON);
``unknown_tool``; ``duplicate_id`` (a later call or result of a taken
identifier); ``unanswered`` (a call without result); ``orphan`` (a result without
call); ``missing_dependency`` or ``cycle``. ``problem`` says what is wrong.

Schemas may use the words in ``WORDS`` and ``NOTES``; a tool whose schema has any other is refused before the job.

Defined cases: null conversation or identifier: the event is kept and linked
with nothing, and without a conversation it has no position; null or empty texts become null content; the first of repeated
rows counts and later ones are duplicates; empty tables give an empty result.
Arguments nested deeper than ``DEPTH`` are ``invalid`` and kept as they are under ``raw``; half a surrogate pair,
which no UTF-8 text can hold, stays escaped.
``tool_calls`` that is neither null nor a JSON array, and each element that is
no object, is one ``invalid`` call without identifier whose JSON has the whole
column under ``raw``; arguments that are no JSON are under ``raw`` as well. A
message with calls and ``tool_call_id`` gives a result and its calls. A text
beside calls is the ``content`` of the result or else of the message's first call.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usageloom.llm.common import shared_folder, ship_code, written

EVENTS = ("conv_id long, turn long, place int, kind string, call_id string, name string,"
          " body string, needs array<string>, problem string")
CALLS = "array<struct<id:string,name:string,arguments:string>>"

#: schemas of the tools that stand for the turns of `conversations`
TOOLS = {
    "ask": {
        "type": "object", "required": ["text", "turn"], "additionalProperties": False,
        "properties": {
            "text": {"type": "string", "minLength": 1},
            "turn": {"type": "integer", "minimum": 0},
            "after": {"type": "object", "required": ["$ref"], "properties": {"$ref": {"type": "string"}}},
        },
    },
}


#: levels of objects and arrays that arguments may have
DEPTH = 200
#: needs of a conversation up to which one task orders its calls
TANGLE = 100_000

HALF_PAIR = re.compile("[\ud800-\udfff]")
BRACKETS = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}]', re.DOTALL)


def escaped(text: str) -> str:
    """Half surrogate pairs as JSON escapes, so that the text can be UTF-8."""
    return HALF_PAIR.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def depth(text: str) -> int:
    """Levels of brackets in a JSON text, counted without recursion."""
    if text.count("[") + text.count("{") <= DEPTH:
        return 0  # cannot be too deep
    now = most = 0
    for found in BRACKETS.finditer(text):
        if found[0] in "[{":
            now += 1
            most = max(most, now)
        elif found[0] in "]}":
            now -= 1
    return most


def canonical(value: Any) -> str:
    """Sorted keys, no white space, characters as they are, whole floats as integers."""
    def plain(x: Any) -> Any:
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        return int(x) if isinstance(x, float) and x.is_integer() and abs(x) < 2**53 else x

    return escaped(json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None), "number": (int, float)}
WORDS = {
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "minLength", "maxLength",
    "pattern", "items", "minItems", "maxItems", "uniqueItems", "properties", "required", "additionalProperties",
    "minProperties", "maxProperties", "anyOf", "allOf", "oneOf", "not",
}
#: words that say nothing about what is valid
NOTES = {"title", "description", "default", "examples", "$schema", "$id", "$comment", "deprecated", "readOnly", "writeOnly"}


def check_schema(schema: Any, where: str = "$") -> None:
    """Refuses a schema with words or types that ``breach`` does not know: they would pass silently."""
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"{where}: a schema is an object or a boolean")
    if unknown := sorted(set(schema) - WORDS - NOTES):
        raise ValueError(f"{where}: unknown schema words {', '.join(unknown)}")
    kinds = schema.get("type", [])
    for kind in kinds if isinstance(kinds, list) else [kinds]:
        if kind not in KINDS and kind != "integer":
            raise ValueError(f"{where}: unknown type {kind}")
    if "pattern" in schema:
        re.compile(schema["pattern"])
    for word in ("items", "additionalProperties", "not"):
        if word in schema:
            check_schema(schema[word], f"{where}.{word}")
    for name, part in schema.get("properties", {}).items():
        check_schema(part, f"{where}.{name}")
    for word in ("anyOf", "allOf", "oneOf"):
        for i, part in enumerate(schema.get(word, ())):
            check_schema(part, f"{where}.{word}[{i}]")


def is_kind(value: Any, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    return isinstance(value, KINDS[kind]) and (kind == "boolean" or not isinstance(value, bool))


def breach(value: Any, schema: dict | bool, where: str = "$") -> str | None:
    """The first way in which a value breaks a schema, or None."""
    if isinstance(schema, bool):
        return None if schema else f"{where}: not allowed"
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(is_kind(value, k) for k in kinds):
        return f"{where}: not of type {' or '.join(kinds)}"
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        return f"{where}: not one of the allowed values"
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        return f"{where}: not the allowed value"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return f"{where}: out of range"
        if "exclusiveMinimum" in schema and value <= schema["exclusiveMinimum"]:
            return f"{where}: out of range"
        if "exclusiveMaximum" in schema and value >= schema["exclusiveMaximum"]:
            return f"{where}: out of range"
        if "multipleOf" in schema and value % schema["multipleOf"]:
            return f"{where}: no multiple"
    if isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            return f"{where}: length"
        if "pattern" in schema and not re.search(schema["pattern"], value):
            return f"{where}: pattern"
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            return f"{where}: number of items"
        if schema.get("uniqueItems") and len(set(map(canonical, value))) < len(value):
            return f"{where}: repeated items"
        for i, x in enumerate(value):
            if found := breach(x, schema.get("items", True), f"{where}[{i}]"):
                return found
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                return f"{where}.{name}: missing"
        if not schema.get("minProperties", 0) <= len(value) <= schema.get("maxProperties", len(value)):
            return f"{where}: number of properties"
        for name in sorted(value):
            if found := breach(value[name], known.get(name, schema.get("additionalProperties", True)), f"{where}.{name}"):
                return found
    for part in schema.get("allOf", ()):
        if found := breach(value, part, where):
            return found
    if "anyOf" in schema and all(breach(value, part, where) for part in schema["anyOf"]):
        return f"{where}: none of the alternatives"
    if "oneOf" in schema and sum(breach(value, part, where) is None for part in schema["oneOf"]) != 1:
        return f"{where}: not exactly one of the alternatives"
    if "not" in schema and breach(value, schema["not"], where) is None:
        return f"{where}: what is not allowed"
    return None


def references(value: Any) -> set[str]:
    if isinstance(value, dict):
        own = {value["$ref"]} if isinstance(value.get("$ref"), str) else set()
        return own.union(*map(references, value.values()))
    return set().union(*map(references, value)) if isinstance(value, list) else set()


def events_of(messages: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """One row per call or result. ``messages``: conv_id, turn, text, tool_calls, tool_call_id."""
    for name, schema in tools.items():
        check_schema(schema, name)
    ship_code(messages.sparkSession)
    parsed = messages.select(
        "conv_id", "turn", "text", "tool_calls", "tool_call_id", F.from_json("tool_calls", CALLS).alias("calls"))
    answers = F.col("tool_call_id").isNotNull()

    def event(place: Column, kind: str, call_id: Column, name: Column, arguments: Column, raw: Column, text: Column) -> Column:
        return F.struct(
            place.cast("int").alias("place"), F.lit(kind).alias("kind"), call_id.alias("call_id"), name.alias("name"),
            arguments.alias("arguments"), raw.alias("raw"), text.alias("text"))

    nothing = F.lit(None).cast("string")
    beside = F.when(~answers, F.col("text"))
    calls = F.transform("calls", lambda c, i: event(
        i, "call", c["id"], c["name"], c["arguments"], F.when(c.isNull(), F.col("tool_calls")), F.when(i == 0, beside)))
    broken = F.when(F.col("tool_calls").isNotNull(), F.array(
        event(F.lit(0), "call", nothing, nothing, nothing, F.col("tool_calls"), beside)))
    # the result of a message that calls as well stands before its calls
    place = F.when(F.col("tool_calls").isNull(), 0).otherwise(-1)
    result = F.when(answers, F.array(
        event(place, "result", F.col("tool_call_id"), nothing, nothing, nothing, F.col("text"))))
    empty = F.slice(F.array(event(F.lit(0), "call", nothing, nothing, nothing, nothing, nothing)), 1, 0)
    events = parsed.select(
        "conv_id", "turn", F.inline(F.concat(F.coalesce(calls, broken, empty), F.coalesce(result, empty))))

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.schema([
            ("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.int32()), ("kind", pa.string()),
            ("call_id", pa.string()), ("name", pa.string()), ("body", pa.string()),
            ("needs", pa.list_(pa.string())), ("problem", pa.string())])
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                needs, problem = [], None
                if r["kind"] == "result":
                    text = canonical({"content": r["text"] or None, "tool_call_id": r["call_id"]})
                else:
                    body = {"arguments": None, "id": r["call_id"], "name": r["name"]}
                    body |= {"content": r["text"]} if r["text"] else {}
                    if r["raw"] is not None:
                        problem = "$: no array of calls"
                        text = canonical(body | {"raw": r["raw"]})
                    else:
                        sent = r["arguments"] or "null"
                        try:
                            if depth(sent) > DEPTH:
                                raise ValueError("nested too deeply")
                            arguments = json.loads(sent)
                            text = canonical(body | {"arguments": arguments})
                            needs = sorted(map(escaped, references(arguments)))
                            problem = ("unknown_tool" if r["name"] not in tools
                                       else breach(arguments, tools[r["name"]]))
                            problem = problem and escaped(problem)
                        except ValueError as wrong:
                            problem = f"$: {wrong}" if str(wrong) == "nested too deeply" else "$: not JSON"
                            text = canonical(body | {"raw": r["arguments"]})
                out.append({k: r[k] for k in ("conv_id", "turn", "place", "kind", "call_id", "name")}
                           | {"body": text, "needs": needs, "problem": problem})
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return events.mapInArrow(read, EVENTS)


def first_of_each(events: DataFrame) -> DataFrame:
    """``taken`` is true for a later call or result of an identifier that is in use.

    Events that cannot be repeated ones, without conversation or identifier, are dealt out by a hash.
    """
    named = F.col("call_id").isNotNull() & F.col("conv_id").isNotNull()
    spread = F.when(~named, F.xxhash64("conv_id", "turn", "place", "body"))
    rank = F.row_number().over(W.partitionBy("conv_id", "call_id", "kind", spread).orderBy("turn", "place", "body"))
    return events.withColumn("taken", named & (rank > 1))


def chain_levels(needs: dict[str, set[str]]) -> dict[str, int]:
    """The longest chain of needs of each call that needs another; none for calls on or behind a cycle."""
    needed_by: dict[str, list[str]] = {}
    for call, those in needs.items():
        for need in those:
            needed_by.setdefault(need, []).append(call)
    waiting = {call: len(those) for call, those in needs.items()}
    level = {need: 0 for need in needed_by if need not in needs}
    ready = list(level)
    while ready:
        need = ready.pop()
        for call in needed_by.get(need, ()):
            waiting[call] -= 1
            level[call] = max(level.get(call, 0), level[need] + 1)
            if not waiting[call]:
                ready.append(call)
    return {call: level[call] for call, left in waiting.items() if not left}


def levels(calls: DataFrame, needs: DataFrame, most: int = TANGLE) -> DataFrame:
    """(conv_id, call_id, level): calls by the longest chain of needs; none for those on or behind a cycle.

    ``needs``: conv_id, call_id, need. Only conversations with a call that comes before what it needs are given here.
    """
    key = ["conv_id", "call_id"]
    free = written(calls.select(*key).join(needs.select(*key).distinct(), key, "left_anti").withColumn("level", F.lit(0)), "levels")
    sizes = written(needs.groupBy("conv_id").agg((F.count(F.lit(1)) > most).alias("large")), "tangles")

    def order(group):
        import pyarrow as pa

        needed: dict[str, set[str]] = {}
        for call, need in zip(group.column("call_id").to_pylist(), group.column("need").to_pylist(), strict=True):
            needed.setdefault(call, set()).add(need)
        found = chain_levels(needed)
        conv = group.column("conv_id")[0].as_py()
        return pa.table([pa.array([conv] * len(found), pa.int64()), pa.array(list(found), pa.string()),
                         pa.array(list(found.values()), pa.int32())], names=["conv_id", "call_id", "level"])

    small = needs.join(sizes.filter("NOT large"), "conv_id", "left_semi").select(*key, "need")
    done = free.unionByName(small.groupBy("conv_id").applyInArrow(order, "conv_id long, call_id string, level int"))
    large = sizes.filter("large").select("conv_id")
    if large.isEmpty():
        return done
    open_needs = written(needs.join(large, "conv_id", "left_semi"), "needs")
    newest, round_, store = free, 0, shared_folder(needs.sparkSession, "levels")
    while True:
        ready = newest.select("conv_id", F.col("call_id").alias("need"))
        left = written(open_needs.join(ready, ["conv_id", "need"], "left_anti"), "needs")
        freed = open_needs.select(*key).distinct().join(left.select(*key).distinct(), key, "left_anti")
        round_ += 1
        freed.withColumn("level", F.lit(round_)).write.parquet(f"{store}/round={round_}")
        newest = needs.sparkSession.read.schema(done.schema).parquet(f"{store}/round={round_}")
        if newest.isEmpty():
            return done.unionByName(needs.sparkSession.read.schema(done.schema).parquet(store).select(*done.columns))
        open_needs = left


def linked_calls(messages: DataFrame, tools: dict[str, dict] | None = None) -> DataFrame:
    """Every call and result: conv_id, position in the conversation, kind, call_id, name, status, problem, json."""
    events = written(first_of_each(events_of(messages, TOOLS if tools is None else tools)), "tool-events")
    call_key = ["conv_id", "call_id"]
    calls = events.filter("kind = 'call' AND NOT taken AND call_id IS NOT NULL AND conv_id IS NOT NULL")
    results = events.filter("kind = 'result' AND NOT taken AND call_id IS NOT NULL AND conv_id IS NOT NULL")
    needs = (calls.select(*call_key, "turn", "place", F.explode(F.array_distinct("needs")).alias("need"))
             .join(calls.select("conv_id", F.col("call_id").alias("need"),
                                F.struct("turn", "place").alias("at")), ["conv_id", "need"], "left"))
    needs = written(needs.withColumn("late", F.col("at") >= F.struct("turn", "place")), "call-needs")
    missing = needs.filter("at IS NULL").groupBy(*call_key).agg(F.min("need").alias("missing"))
    tangled = needs.filter("late").select("conv_id").distinct()
    met = needs.filter("at IS NOT NULL").select(*call_key, "need").join(tangled, "conv_id", "left_semi")
    ranked = levels(calls.join(tangled, "conv_id", "left_semi"), met).withColumn("tangled", F.lit(True))
    marked = tangled.withColumn("in_tangle", F.lit(True))

    # events without conversation or identifier meet nothing, so they take no part in the joins
    named = F.col("call_id").isNotNull() & F.col("conv_id").isNotNull()
    alone = events.filter(~named).select(
        "*", F.lit(None).cast("struct<turn:bigint,place:int>").alias("call_at"), F.lit(None).cast("string").alias("call_name"),
        F.lit(None).cast("boolean").alias("answered"), F.lit(None).cast("string").alias("missing"),
        F.lit(None).cast("int").alias("level"), F.lit(None).cast("boolean").alias("in_tangle"))
    linked = (
        events.filter(named).join(calls.select(*call_key, F.struct("turn", "place").alias("call_at"), F.col("name").alias("call_name")),
                    call_key, "left")
        .join(results.select(*call_key, F.lit(True).alias("answered")), call_key, "left")
        .join(missing, call_key, "left")
        .join(ranked.drop("tangled"), call_key, "left")
        .join(marked, "conv_id", "left")).unionByName(alone)
    is_call, loose = F.col("kind") == "call", F.col("call_at").isNull() | F.col("taken")
    in_cycle = F.col("in_tangle") & F.col("level").isNull() & F.col("call_at").isNotNull()
    status = (
        F.when(F.col("taken"), "duplicate_id")
        .when(~is_call & loose, "orphan")
        .when(~is_call, "ok")
        .when(F.col("problem") == "unknown_tool", "unknown_tool")
        .when(F.col("problem").isNotNull(), "invalid")
        .when(F.col("missing").isNotNull(), "missing_dependency")
        .when(F.coalesce(in_cycle, F.lit(False)), "cycle")
        .when(F.coalesce("answered", F.lit(False)), "ok")
        .otherwise("unanswered"))
    # an event stands at its call's level and place, the call before its result; loose events at their own turn
    level = F.when(loose | F.col("in_tangle").isNull(), 0).otherwise(F.coalesce("level", F.lit(2**31 - 1)))
    at = F.when(loose, F.struct("turn", "place")).otherwise(F.col("call_at"))
    order = F.struct(level.alias("level"), at.alias("at"), F.col("call_id"), (~is_call).alias("second"),
                     F.col("turn"), F.col("place"), F.col("body"))
    return linked.select(
        "conv_id", "turn", "kind", "call_id", F.coalesce("name", "call_name").alias("name"),
        status.alias("status"), F.coalesce("problem", "missing").alias("problem"),
        order.alias("order"), F.col("body").alias("json"))


def positioned(linked: DataFrame, span: int = 1024) -> DataFrame:
    """``position``, gapless from 0 in each conversation, in the order of ``linked_calls``; null without a conversation.

    Long conversations are ranked in parts: events are dealt by (level, turn / span), parts are counted, and
    a part starts where the ones before it end, so no task holds a whole conversation.
    """
    columns = ("turn", "kind", "call_id", "name", "status", "problem", "json")
    part = F.struct(F.col("order.level").alias("level"), F.floor(F.col("order.at.turn") / span).alias("part"))
    parted = linked.filter("conv_id IS NOT NULL").withColumn("_part", part)
    sizes = parted.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("conv_id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = F.row_number().over(W.partitionBy("conv_id", "_part").orderBy("order"))
    ranked = parted.withColumn("_within", within - 1)
    same = ranked["conv_id"].eqNullSafe(starts["conv_id"]) & ranked["_part"].eqNullSafe(starts["_part"])
    return ranked.join(starts, same).select(
        ranked["conv_id"], (F.col("_start") + F.col("_within")).cast("long").alias("position"), *columns
    ).unionByName(linked.filter("conv_id IS NULL").select("conv_id", F.lit(None).cast("long").alias("position"), *columns))


def messages_of(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` as tool traffic: a user turn calls ``ask``, the assistant's next turn answers it.

    The second call of an exchange of four turns refers to the result of the first. System turns are left as
    plain messages, which carry no call. Numbers of turns are as given, so a conversation's rows may come in any order.
    """
    identifier = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("t"), turn.cast("string"))
    own = F.struct(
        F.col("text"), F.col("turn"),
        F.when((F.col("turn") % 4) >= 2, F.struct(identifier(F.col("turn") - 2).alias("$ref"))).alias("after"))
    call = F.to_json(F.array(F.struct(
        identifier(F.col("turn")).alias("id"), F.lit("ask").alias("name"), F.to_json(own).alias("arguments"))))
    return conversations.select(
        "conv_id", "turn",
        F.when(F.col("role") != "user", F.col("text")).alias("text"),  # a user turn's text is its call's argument
        F.when(F.col("role") == "user", call).alias("tool_calls"),
        F.when(F.col("role") == "assistant", identifier(F.col("turn") - 1)).alias("tool_call_id"))


def tool_call_report(conversations: DataFrame) -> DataFrame:
    return positioned(linked_calls(messages_of(conversations)))

