"""Chat messages with linked tool calls, as canonical JSON.

Calls are read from assistant messages (``tool_calls`` of a JSON message, or ``<tool_call>`` tags), results from tool messages (``tool_call_id``,
or any number of ``<tool_response>`` tags), declarations (``tools``, JSON schemas of the arguments) from any message. Calls and results are
joined by conversation and identifier; arguments are checked against the declared schema of their name; a result comes after its call,
and a call after the results that its arguments name (``{"$ref": id}``). Messages that take no part are never joined.

The result has a row per message with its place in the order, so a conversation that holds most rows is no group of its own.
``assembled`` puts conversations together where each fits a record.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table

TAG = re.compile(r"<(tool_call|tool_response)>(.*?)</\1>", re.S)
LAST = 2**62  # turn of messages without one
EDGES = 1_000_000  # a conversation with more dependencies is ordered round by round, all others in one task each
_LONE = re.compile("[\ud800-\udfff]")
TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "number": (int, float), "integer": int, "null": type(None)}
CALLS = "array<struct<id:string,name:string,arguments:string,refs:array<string>>>"


def canonical(value) -> str:
    """Sorted keys, no spaces, no escapes beyond the needed; numbers that are whole are written so."""
    def plain(v):
        if isinstance(v, dict):
            return {str(k): plain(x) for k, x in v.items()}
        if isinstance(v, list):
            return [plain(x) for x in v]
        if isinstance(v, float):
            return None if v != v or abs(v) == float("inf") else int(v) if v == int(v) and abs(v) < 2**53 else v
        return v

    told = json.dumps(plain(value), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", told)


def whole_text(text: str) -> str:
    """Halves of surrogate pairs, which JSON escapes can name and a column can't hold, become U+FFFD."""
    return _LONE.sub("\ufffd", text)


def loads(text):
    try:
        return json.loads(text) if isinstance(text, str) else text
    except (ValueError, RecursionError):
        return None


def errors(value, schema, at: str = "$") -> list[str]:
    """What is wrong with ``value``: type, required, properties, additionalProperties, items, enum, and bounds of numbers and lengths.

    A keyword whose own value makes no sense (``enum: 5``, ``required: "a"``) is the error ``schema`` there and checks nothing.
    """
    if not isinstance(schema, dict):
        return []
    out = []

    def given(key: str, good) -> bool:
        if key in schema and not good(schema[key]):
            out.append(f"{at}: schema")
            return False
        return key in schema

    number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool)
    names = lambda v: isinstance(v, list) and all(isinstance(x, str) for x in v)
    if given("type", lambda v: isinstance(v, str) or names(v)):
        kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        whole = isinstance(value, float) and abs(value) < 1e300 and value == int(value)
        if not any(isinstance(value, TYPES.get(k, object)) and not (isinstance(value, bool) and k in ("integer", "number")) or (k == "integer" and whole) for k in kinds):
            return [*out, f"{at}: type"]
    if given("enum", lambda v: isinstance(v, list)) and value not in schema["enum"]:
        out.append(f"{at}: enum")
    for low, high, kind, size in (("minimum", "maximum", number, lambda v: v), ("minLength", "maxLength", lambda v: isinstance(v, str), len), ("minItems", "maxItems", lambda v: isinstance(v, list), len)):
        there = given(low, number), given(high, number)
        if kind(value):
            out += [f"{at}: {low}"] if there[0] and size(value) < schema[low] else []
            out += [f"{at}: {high}"] if there[1] and size(value) > schema[high] else []
    known = schema["properties"] if given("properties", lambda v: isinstance(v, dict)) else {}
    required = schema["required"] if given("required", names) else []
    if isinstance(value, dict):
        out += [f"{at}.{k}: required" for k in sorted(required) if k not in value]
        for k in sorted(value):
            if k in known:
                out += errors(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        out += [e for i, x in enumerate(value) for e in errors(x, schema["items"], f"{at}[{i}]")]
    return out


def refs(value) -> list[str]:
    if isinstance(value, dict):
        own = [value["$ref"]] if set(value) == {"$ref"} and isinstance(value["$ref"], str) else []
        return own + [r for k in sorted(value) for r in refs(value[k])]
    return [r for v in value for r in refs(v)] if isinstance(value, list) else []


def _call(c) -> dict | None:
    if not isinstance(c, dict):
        return None
    f = c.get("function") if isinstance(c.get("function"), dict) else c
    args = loads(f.get("arguments", {}))
    name, ident = f.get("name"), c.get("id")
    if not isinstance(name, str):
        return None
    given = canonical(args) if args is not None or f.get("arguments") is None else whole_text(str(f.get("arguments")))
    return {"id": None if ident is None else whole_text(str(ident)), "name": whole_text(name), "arguments": given, "refs": [whole_text(r) for r in refs(args)]}


def parse(role: str | None, text: str | None) -> dict:
    """Content, calls, identifiers of the answered calls (each once; None without any), and declared schemas of one message. JSON nested
    too deeply to be read is content."""
    try:
        return _parsed(text)
    except RecursionError:
        return {"content": text, "calls": [], "answers": None, "schemas": []}


def _parsed(text: str | None) -> dict:
    out = {"content": text, "calls": [], "answers": None, "schemas": []}
    whole = loads(text) if text and text.lstrip()[:1] == "{" else None
    if isinstance(whole, dict) and (whole.keys() & {"tool_calls", "tool_call_id", "tools"}):
        content = whole.get("content")
        out["content"] = content if content is None else whole_text(content) if isinstance(content, str) else canonical(content)
        calls, tools = whole.get("tool_calls"), whole.get("tools")
        out["calls"] = [c for c in map(_call, calls if isinstance(calls, list) else []) if c]
        out["answers"] = None if whole.get("tool_call_id") is None else [whole_text(str(whole["tool_call_id"]))]
        for t in tools if isinstance(tools, list) else []:
            f = t.get("function", t) if isinstance(t, dict) else {}
            if isinstance(f, dict) and isinstance(f.get("name"), str):
                out["schemas"].append({"name": whole_text(f["name"]), "schema": canonical(f.get("parameters") or {})})
    elif text and "<tool_" in text:
        answers = []
        for m in TAG.finditer(text):
            got = loads(m[2])
            if m[1] == "tool_call" and (c := _call(got)):
                out["calls"].append(c)
            elif m[1] == "tool_response" and isinstance(got, dict) and got.get("tool_call_id") is not None:
                answers.append(whole_text(str(got["tool_call_id"])))
        out["answers"] = list(dict.fromkeys(answers)) or None
        if out["calls"] or out["answers"] is not None:
            out["content"] = TAG.sub("", text).strip() if out["calls"] else text
    return out


def messages(chats: DataFrame) -> DataFrame:
    """Stored rows of ``chats`` (``conv_id``, ``turn``, ``role``, ``text``), parsed, with a ``row`` number."""
    def read(parts):
        for pdf in parts:
            got = [parse(r, t) for r, t in zip(pdf.role, pdf.text, strict=True)]
            if got:
                yield pdf[["row", "conv_id", "turn", "role"]].assign(**{k: pd.Series([g[k] for g in got], dtype=object, index=pdf.index) for k in ("content", "calls", "answers", "schemas")})

    rows = chats.select(F.monotonically_increasing_id().alias("row"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return stored(rows.mapInPandas(read, f"row long, conv_id long, turn long, role string, content string, calls {CALLS}, answers array<string>, schemas array<struct<name:string,schema:string>>"), "messages")


def settled(src: list[int], dst: list[int], own: dict[int, int]) -> dict[int, tuple[int, int, bool]]:
    """Position, depth and whether it is cyclic of every node of one conversation's edges; time in proportion to the edges.

    A node stands at the largest turn among itself and what comes before it, as many steps deep as the longest way from there. Nodes are taken by
    strongly connected components, in order; where a component is a cycle, or the place comes from one, there is no depth: the node is cyclic.
    """
    after: dict[int, list[int]] = {}
    before: dict[int, list[int]] = {}
    for a, b in zip(src, dst, strict=True):
        after.setdefault(a, []).append(b)
        before.setdefault(b, []).append(a)
    number: dict[int, int] = {}
    low: dict[int, int] = {}
    held: list[int] = []
    inside: set[int] = set()
    parts: list[list[int]] = []  # each behind all it leads to
    path: list[tuple] = []

    def enter(node: int) -> None:
        number[node] = low[node] = len(number)
        held.append(node)
        inside.add(node)
        path.append((node, iter(after.get(node, ()))))

    for start in own:
        if start not in number:
            enter(start)
        while path:
            node, rest = path[-1]
            nxt = next(rest, None)
            if nxt is not None:
                if nxt not in number:
                    enter(nxt)
                elif nxt in inside:
                    low[node] = min(low[node], number[nxt])
                continue
            path.pop()
            if path:
                low[path[-1][0]] = min(low[path[-1][0]], low[node])
            if low[node] == number[node]:
                part = [held.pop()]
                while part[-1] != node:
                    part.append(held.pop())
                inside.difference_update(part)
                parts.append(part)
    place: dict[int, tuple[int, float]] = {}
    for part in reversed(parts):
        members = set(part)
        best = max([(own[v], 0) for v in part] + [(place[u][0], place[u][1] + 1) for v in part for u in before.get(v, ()) if u not in members])
        for v in part:
            place[v] = (best[0], float("inf")) if len(part) > 1 else best
    return {v: (own[v], 0, True) if d == float("inf") else (p, int(d), False) for v, (p, d) in place.items()}


def order(edges: DataFrame, turns: DataFrame, most: int = EDGES) -> DataFrame:
    """``row``, ``position``, ``depth``, ``cyclic`` of messages with dependencies: ``src`` before ``dst``.

    A conversation of up to ``most`` edges is ordered in one task, which sees numbers only. In larger ones positions move up along the
    edges round by round until nothing moves; a message deeper than there are edges in its conversation is on a cycle or behind one. Cyclic
    messages keep their own turn.
    """
    edges = stored(edges.filter("src <> dst").select("conv_id", "src", "dst").distinct(), "edges")
    large = stored(edges.groupBy("conv_id").count().filter(F.col("count") > most).select("conv_id"), "large")
    one = lambda c: turns.select(F.col("row").alias(c), F.col("own").alias(f"{c}_own"))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        src, dst = pdf.src.tolist(), pdf.dst.tolist()
        own = dict(zip(src + dst, pdf.src_own.tolist() + pdf.dst_own.tolist(), strict=True))
        return pd.DataFrame([(v, *p) for v, p in settled(src, dst, own).items()], columns=["row", "position", "depth", "cyclic"])

    small = edges.join(large, "conv_id", "left_anti").join(one("src"), "src").join(one("dst"), "dst")
    done = small.groupBy("conv_id").applyInPandas(settle, "row long, position long, depth long, cyclic boolean")
    return done if large.isEmpty() else done.unionByName(by_rounds(edges.join(large, "conv_id", "left_semi"), turns))


def by_rounds(edges: DataFrame, turns: DataFrame) -> DataFrame:
    """The same for edges of conversations of any size, by a written table a round."""
    edges = stored(edges, "edges")
    limit = edges.groupBy("conv_id").agg(F.count("*").alias("most"))
    ends = edges.select("conv_id", F.col("src").alias("row")).union(edges.select("conv_id", "dst")).distinct()
    at = ends.join(turns, "row").join(limit, "conv_id").select("row", "own", "most", F.col("own").alias("position"), F.lit(0).cast("long").alias("depth"))
    at = stored(at, "order")
    while True:
        before = at.select(F.col("row").alias("src"), F.struct("position", (F.col("depth") + 1).alias("depth")).alias("p"))
        push = edges.join(before, "src").groupBy(F.col("dst").alias("row")).agg(F.max("p").alias("p"))
        here = F.struct("position", "depth")
        moved = at.join(push, "row", "left").withColumn("p", F.when(F.col("depth") <= F.col("most"), F.greatest(here, F.col("p"))).otherwise(here))
        nxt = stored(moved.select("row", "own", "most", "p.position", "p.depth", (F.col("p") > here).alias("moved")), "order")
        at = nxt.drop("moved")
        if nxt.filter("moved").isEmpty():
            break
    cyclic = F.col("depth") > F.col("most")
    return at.select("row", F.when(cyclic, F.col("own")).otherwise(F.col("position")).alias("position"), F.when(cyclic, 0).otherwise(F.col("depth")).alias("depth"), cyclic.alias("cyclic"))


def linked(chats: DataFrame) -> DataFrame:
    """A row per message: ``conv_id``, ``turn``, ``position``, ``depth`` (its place: by both, then ``turn``), ``role``, ``n_calls``, ``n_answered``,
    ``n_invalid``, ``status`` (``ok``, ``no_call``: any of its results has no call, ``cyclic``) and ``json`` (``tool_call_ids`` where one message has several results).

    The first call with an identifier is the one that results belong to; calls without identifier are never answered. Messages without
    conversation are not linked; without turn they come last. NULL text gives NULL content; text that is no valid JSON is content.
    """
    made = messages(chats)
    own = F.coalesce("turn", F.lit(LAST)).alias("own")
    plain = made.filter((F.size("calls") == 0) & F.col("answers").isNull())
    tool = made.filter((F.size("calls") > 0) | F.col("answers").isNotNull())
    calls = stored(tool.filter(F.size("calls") > 0).select("row", "conv_id", own, F.posexplode("calls").alias("pos", "call")).select("row", "conv_id", "own", "pos", "call.*"), "calls")
    place = F.struct("own", "row", "pos")
    first = calls.filter("id IS NOT NULL AND conv_id IS NOT NULL").groupBy("conv_id", "id").agg(F.min(place).alias("c"))
    first = stored(first.select("conv_id", "id", F.col("c.row").alias("call_row"), F.col("c.pos").alias("call_pos")), "first-calls")
    results = tool.filter(F.col("answers").isNotNull()).select("row", "conv_id", F.explode("answers").alias("id"), own)
    met = stored(results.join(first, ["conv_id", "id"]).select("conv_id", "id", "row", "call_row", "call_pos", "own"), "met")
    asked = calls.select("conv_id", F.col("row").alias("dst"), F.explode("refs").alias("id"))
    needs = asked.join(met.groupBy("conv_id", "id").agg(F.min_by("row", F.struct("own", "row")).alias("src")), ["conv_id", "id"])
    edges = met.select("conv_id", F.col("call_row").alias("src"), F.col("row").alias("dst")).union(needs.select("conv_id", "src", "dst"))
    placed = order(edges, tool.select("row", own)).withColumnRenamed("row", "__row")

    schema = made.filter(F.size("schemas") > 0).select("row", "conv_id", own, F.posexplode("schemas").alias("pos", "s")).select("row", "conv_id", "own", "pos", "s.*")
    schema = stored(schema.groupBy("conv_id", "name").agg(F.min_by("schema", place).alias("schema")), "schemas")

    @F.pandas_udf("array<string>")
    def check(args: pd.Series, rule: pd.Series) -> pd.Series:
        return pd.Series([[] if r is None else errors(loads(a), loads(r)) for a, r in zip(args, rule, strict=True)], dtype=object)

    answered = met.select(F.col("call_row").alias("row"), F.col("call_pos").alias("pos"), F.lit(True).alias("answered")).distinct()
    told = calls.join(schema, ["conv_id", "name"], "left").join(answered, ["row", "pos"], "left")
    told = told.select("row", F.struct("pos", "id", "name", "arguments", F.coalesce("answered", F.lit(False)).alias("answered"), check("arguments", "schema").alias("errors")).alias("c"))
    told = told.groupBy("row").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    hit = met.groupBy("row").agg(F.count("*").alias("n_met"))
    joined = tool.join(told, "row", "left").join(hit, "row", "left").join(placed, F.col("row") == F.col("__row"), "left").withColumn("has_call", F.col("n_met") == F.size("answers"))
    kinds = "array<struct<pos:int,id:string,name:string,arguments:string,answered:boolean,errors:array<string>>>"
    cols = ["conv_id", "turn", "role", "content", "answers", "cs", "has_call", "position", "depth", "cyclic"]
    none = {"answers": "array<string>", "cs": kinds, "has_call": "boolean", "position": "long", "depth": "long", "cyclic": "boolean"}
    plain = plain.drop("answers").select(*[F.lit(None).cast(none[c]).alias(c) if c in none else F.col(c) for c in cols])

    def write(parts):
        for pdf in parts:
            out = []
            for r in pdf.itertuples():
                cs = [] if r.cs is None else list(r.cs)
                text = lambda v: v if isinstance(v, str) else None
                message = {"role": text(r.role), "content": text(r.content)}
                if cs:
                    message["tool_calls"] = [{"id": c["id"], "type": "function", "function": {"name": c["name"], "arguments": c["arguments"]}} for c in cs]
                answers = [] if r.answers is None else list(r.answers)
                if answers:
                    message |= {"tool_call_id": answers[0]} if len(answers) == 1 else {"tool_call_ids": answers}
                bad = sum(len(c["errors"]) > 0 for c in cs)
                status = "cyclic" if r.cyclic is True else "no_call" if answers and r.has_call is not True else "ok"
                out.append((len(cs), sum(bool(c["answered"]) for c in cs), bad, status, canonical(message)))
            if out:
                yield pdf[["conv_id", "turn", "position", "depth", "role"]].assign(**dict(zip(["n_calls", "n_answered", "n_invalid", "status", "json"], map(list, zip(*out, strict=True)), strict=True)))

    rows = plain.union(joined.select(*cols))
    rows = rows.withColumn("position", F.coalesce("position", "turn", F.lit(LAST))).withColumn("depth", F.coalesce("depth", F.lit(0)))
    return rows.mapInPandas(write, "conv_id long, turn long, position long, depth long, role string, n_calls int, n_answered int, n_invalid int, status string, json string")


def assembled(chats: DataFrame) -> DataFrame:
    """``conv_id`` and ``json`` of whole conversations, messages in order; each conversation must fit a record."""
    part = F.struct("position", "depth", F.coalesce("turn", F.lit(LAST)).alias("turn"), "json")
    got = linked(chats).groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("ms"))
    return got.select("conv_id", F.concat(F.lit('{"messages":['), F.concat_ws(",", F.transform("ms", lambda m: m["json"])), F.lit("]}")).alias("json"))


@query("op3_chat_tool_calls")
def op3(spark, folder):
    return linked(table(spark, folder, "conversations"))
