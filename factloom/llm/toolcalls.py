"""Chat formatting (operator 9): links tool calls to their results and serialises messages as canonical JSON.

DataFrame functions only.  An assistant message may be a JSON object {"content": ..., "tool_calls": [{"id", "name",
"arguments", "depends_on": [ids]}]}; a message of role tool is {"tool_call_id": ..., "content": ...}.  Calls and results of
a conversation are joined by identifier; calls are put in topological order by their depth; arguments are validated against
schemas; JSON objects are written with sorted keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Parameters by tool; type, and whether it is required.
SCHEMAS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "calculator": {"expression": ("string", True)},
    "weather": {"city": ("string", True), "unit": ("string", False)},
    "fetch": {"url": ("string", True), "headers": ("object", False)},
}
KINDS = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DECIMAL.*|DOUBLE)$", "boolean": "^BOOLEAN$", "object": "^OBJECT.*", "array": "^ARRAY.*"}
CALLS = "content string, tool_calls array<struct<id:string,name:string,arguments:string,depends_on:array<string>>>"
RESULT = "tool_call_id string, content string"


def valid_arguments(name: Column, value: Column, keys: Column, schemas: dict) -> Column:
    """Whether `value`, parsed JSON with these keys, is an object that has the named tool's required parameters, each of its type, and no other."""
    keys = F.coalesce(keys, F.array().cast("array<string>"))
    out = F.lit(False)
    for tool, params in schemas.items():
        facts = [F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False)), F.size(F.array_except(keys, F.array(*[F.lit(p) for p in params]).cast("array<string>"))) == 0]
        for param, (kind, required) in params.items():
            there = F.array_contains(keys, param)
            fits = F.coalesce(F.schema_of_variant(F.try_variant_get(value, f"$['{param}']", "variant")).rlike(KINDS[kind]), F.lit(False))
            facts.append(fits if required else ~there | fits)
        out = F.when(name == tool, reduce(Column.__and__, facts)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def canonical(text: Column) -> Column:
    """JSON with sorted keys and no blanks; null if it is not JSON."""
    return F.to_json(F.try_parse_json(text))


#: Calls of a conversation that are ordered within one array; those of longer ones are ordered in rounds of joins.
ARRAY_CALLS = 128
#: Parts that a conversation's calls are dealt to while they are told apart by their number.
PARTS = 16


def _same(a: str, b: str, x: str = "id", y: str = "id") -> Column:
    return F.col(f"{a}.conv").eqNullSafe(F.col(f"{b}.conv")) & (F.col(f"{a}.{x}") == F.col(f"{b}.{y}"))


def depths(calls: DataFrame, array_calls: int = ARRAY_CALLS) -> DataFrame:
    """(conv, id, depth) of calls (conv, id, depends_on), one row for each conv and id.

    depth is 0 for a call that waits for no other call of its conversation, else one more than the deepest it waits for;
    null for calls in or behind a cycle.  A conversation of up to `array_calls` calls is one array, whose depths settle in as
    many steps as the deepest; of a longer one each depth is a round of joins over what is left of it.
    """
    # Counted in parts, and the few counts copied to as many, so that no task gets all calls of one conversation.
    n = calls.groupBy("conv").agg(F.count("*").alias("n")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    dealt = calls.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int"))
    sized = stored(dealt.alias("c").join(n.alias("n"), F.col("c.conv").eqNullSafe(F.col("n.conv")) & (F.col("c.part") == F.col("n.part"))).select("c.conv", "c.id", "c.depends_on", "n.n"))
    small = sized.where(F.col("n") <= array_calls).groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("id", "depends_on"))).alias("calls"))
    ids = F.transform("calls", lambda c: c["id"])
    # Places of the calls that each waits for; ids that are no calls are left out.
    small = small.withColumn("ids", ids).withColumn("on", F.transform("calls", lambda c: F.filter(F.transform(F.coalesce(F.array_distinct(c["depends_on"]), F.array().cast("array<string>")), lambda d: F.array_position("ids", F.coalesce(d, F.lit("")))), lambda k: k > 0)))
    unknown = F.transform("on", lambda _: F.lit(None).cast("int"))
    # One step: a call's depth follows once those of all it waits for are known.
    step = lambda now: F.transform("on", lambda w: F.when(F.exists(w, lambda k: F.get(now, (k - 1).cast("int")).isNull()), F.lit(None).cast("int")).otherwise(F.coalesce(F.array_max(F.transform(w, lambda k: F.get(now, (k - 1).cast("int")))) + 1, F.lit(0))))
    settled = F.aggregate(F.sequence(F.lit(1), F.size("on")), F.struct(unknown.alias("now"), F.lit(True).alias("moving")), lambda a, _: F.when(a["moving"], F.struct(step(a["now"]).alias("now"), (F.to_json(step(a["now"])) != F.to_json(a["now"])).alias("moving"))).otherwise(a))
    ordered = small.select("conv", F.inline(F.arrays_zip(F.col("ids").alias("id"), settled["now"].alias("depth"))))
    large = sized.where(F.col("n") > array_calls)
    return ordered.select("conv", "id", "depth") if large.isEmpty() else ordered.select("conv", "id", "depth").unionByName(_depths_in_rounds(large))


def _depths_in_rounds(calls: DataFrame) -> DataFrame:
    """depths() by joins.  Chains of calls that wait for one other each are followed by doubling; then each round takes the
    calls of several waits whose waits are all over, and leaves the others."""
    names = calls.select("conv", "id")
    waits = calls.select("conv", "id", F.explode("depends_on").alias("on")).distinct()
    waits = stored(waits.alias("w").join(names.alias("n"), _same("w", "n", "on"), "left_semi"))
    number = stored(waits.groupBy("conv", "id").agg(F.count("*").alias("n"), F.min("on").alias("on")))
    jumps = stored(number.where("n = 1").select("conv", "id", F.col("on").alias("to"), F.lit(1).cast("long").alias("far")))
    for _ in range(max(jumps.count(), 1).bit_length()):
        if jumps.alias("a").join(jumps.alias("b"), _same("a", "b", "to"), "left_semi").isEmpty():
            break
        jumps = stored(jumps.alias("a").join(jumps.alias("b"), _same("a", "b", "to"), "left").select("a.conv", "a.id", F.coalesce("b.to", "a.to").alias("to"), (F.col("a.far") + F.coalesce("b.far", F.lit(0))).alias("far")))
    # A jump that still leads to a jump goes round in a cycle.
    jumps = stored(jumps.alias("a").join(jumps.alias("b"), _same("a", "b", "to"), "left_anti"))
    ready = stored(names.alias("n").join(number.alias("w"), _same("n", "w"), "left_anti").withColumn("depth", F.lit(0).cast("long")))
    several = waits.alias("w").join(number.where("n > 1").alias("n"), _same("w", "n"), "left_semi")
    left = several.alias("w").join(jumps.alias("j"), _same("w", "j", "on"), "left").select("w.conv", "w.id", F.coalesce("j.to", "w.on").alias("on"), (F.coalesce("j.far", F.lit(0)) + 1).alias("far"), F.lit(None).cast("long").alias("got"))
    left, done = stored(left), [ready]
    while not left.isEmpty():
        left = stored(left.alias("w").join(ready.alias("r"), _same("w", "r", "on"), "left").select("w.conv", "w.id", "w.on", "w.far", F.coalesce("w.got", F.col("r.depth") + F.col("w.far")).alias("got")))
        ready = stored(left.groupBy("conv", "id").agg(F.max("got").alias("depth"), F.count_if(F.col("got").isNull()).alias("open")).where("open = 0").select("conv", "id", "depth"))
        if ready.isEmpty():
            break
        left, done = stored(left.alias("w").join(ready.alias("r"), _same("w", "r"), "left_anti")), [*done, ready]
    found = reduce(DataFrame.unionByName, done)
    found = found.unionByName(jumps.alias("j").join(found.alias("d"), _same("j", "d", "to")).select("j.conv", "j.id", (F.col("d.depth") + F.col("j.far")).alias("depth")))
    return names.alias("n").join(found.alias("d"), _same("n", "d"), "left").select("n.conv", "n.id", F.col("d.depth").cast("int").alias("depth"))


def format_messages(turns: DataFrame, schemas: dict | None = None) -> DataFrame:
    """(conv_id, turn, role, n_calls, n_linked, n_valid, is_orphan, message) for each row of turns (conv_id, turn, role, text).

    message is canonical JSON: role, content and, for an assistant's calls ordered by depth and place, id, name, canonical
    arguments, depth (null in or behind a cycle), valid, and the content of the first result with that id (null if none).  Of calls
    with one id in a conversation the first counts as the call; later ones are written but not linked.  A result without a
    call is an orphan.  Text that is no such JSON is plain content; a null text stays null.  Repeated rows each give a row;
    further columns are left out; an empty table gives no row.
    """
    schemas = SCHEMAS if schemas is None else schemas
    asks, answers = F.lower("role") == "assistant", F.lower("role") == "tool"
    looks = F.ltrim("text").startswith("{")
    rows = turns.select(F.col("conv_id").alias("conv"), "turn", "role", "text")
    rows = rows.withColumns({"asked": F.when(asks & looks, F.from_json("text", CALLS)), "answer": F.when(answers & looks, F.from_json("text", RESULT))})
    rows = rows.withColumn("asked", F.when(F.size("asked.tool_calls") > 0, F.col("asked")))
    linking = F.col("asked").isNotNull() | F.col("answer.tool_call_id").isNotNull()
    rows = rows.withColumn("mark", F.when(linking, F.sha2("text", 256)))
    # The first call of an id, and what that one waits for; only names and places travel, not what messages say.
    calls = rows.where("asked is not null").select("conv", "turn", "mark", F.posexplode(F.transform("asked.tool_calls", lambda c: F.struct(c["id"].alias("id"), c["depends_on"].alias("depends_on")))).alias("at", "call"))
    first = calls.where("call.id is not null").groupBy("conv", F.col("call.id").alias("id")).agg(F.min(F.struct("turn", "mark", "at", "call.depends_on")).alias("first"))
    first = stored(first.select("conv", "id", "first.turn", "first.mark", "first.at", "first.depends_on"))
    replies = rows.where("answer.tool_call_id is not null").select("conv", "turn", "mark", F.col("answer.tool_call_id").alias("id"), F.col("answer.content").alias("content"))
    results = replies.groupBy("conv", "id").agg(F.min(F.struct("turn", "content")).alias("result"))
    linked = first.alias("f").join(results.alias("r"), _same("f", "r"), "left").join(depths(first.select("conv", "id", "depends_on")).alias("d"), _same("f", "d"), "left")
    linked = linked.select("f.conv", "f.turn", "f.mark", F.struct("f.at", "d.depth", "r.result").alias("link"), F.lit(False).alias("asked_for"))
    known = replies.select("conv", "turn", "mark", "id").distinct().alias("a").join(first.alias("f"), _same("a", "f"), "left_semi")
    known = known.select("conv", "turn", "mark", F.lit(None).cast(linked.schema["link"].dataType).alias("link"), F.lit(True).alias("asked_for"))
    links = linked.unionByName(known).groupBy("conv", "turn", "mark").agg(F.collect_list("link").alias("links"), F.max("asked_for").alias("asked_for"))
    on = F.col("m.conv").eqNullSafe(F.col("k.conv")) & F.col("m.turn").eqNullSafe(F.col("k.turn")) & (F.col("m.mark") == F.col("k.mark"))
    out = rows.alias("m").join(links.alias("k"), on, "left").select("m.*", "k.links", "k.asked_for")
    of_place = lambda i: F.get(F.filter("links", lambda k: k["at"] == i), 0)
    out = out.withColumn("calls", F.transform("asked.tool_calls", lambda c, i: F.struct(i.alias("at"), c["id"].alias("id"), c["name"].alias("name"), c["arguments"].alias("arguments"), F.try_parse_json(c["arguments"]).alias("value"), F.json_object_keys(c["arguments"]).alias("keys"), of_place(i).alias("link"))))
    shown = lambda c: F.coalesce(c["value"], F.to_variant_object(F.struct(c["arguments"].alias("raw"))))
    written = lambda c: F.to_json(F.struct(shown(c).alias("arguments"), c["link"]["depth"].alias("depth"), c["id"].alias("id"), c["name"].alias("name"), c["link"]["result"]["content"].alias("result"), c["valid"].alias("valid")), {"ignoreNullFields": "false"})
    out = out.withColumn("calls", F.transform("calls", lambda c: c.withField("valid", valid_arguments(c["name"], c["value"], c["keys"], schemas))))
    out = out.withColumn("calls", F.array_sort(F.transform("calls", lambda c: F.struct(F.coalesce(c["link"]["depth"], F.lit(2**31 - 1)).alias("deep"), c["at"].alias("at"), c["link"]["result"].isNotNull().alias("linked"), c["valid"].alias("valid"), written(c).alias("json")))))
    content = F.when(F.col("asked").isNotNull(), F.col("asked.content")).when(F.col("answer.tool_call_id").isNotNull(), F.col("answer.content")).otherwise(F.col("text"))
    head = F.to_json(F.struct(content.alias("content"), "role"), {"ignoreNullFields": "false"})
    body = F.when(F.col("calls").isNotNull(), F.concat(F.lit(',"tool_calls":['), F.array_join(F.transform("calls", lambda c: c["json"]), ","), F.lit("]"))).otherwise(
        F.when(F.col("answer.tool_call_id").isNotNull(), F.concat(F.lit(","), F.expr("substr(to_json(struct(answer.tool_call_id)), 2, length(to_json(struct(answer.tool_call_id))) - 2)"))).otherwise(F.lit(""))
    )
    counted = lambda test: F.when(F.col("calls").isNull(), F.lit(0)).otherwise(F.size(F.filter("calls", test))).cast("long")
    return out.select(
        F.col("conv").alias("conv_id"), "turn", "role", counted(lambda _: F.lit(True)).alias("n_calls"), counted(lambda c: c["linked"]).alias("n_linked"), counted(lambda c: c["valid"]).alias("n_valid"),
        (F.col("answer.tool_call_id").isNotNull() & F.col("asked_for").isNull()).alias("is_orphan"), F.concat(F.regexp_replace(head, r"\}$", ""), body, F.lit("}")).alias("message"),
    )
