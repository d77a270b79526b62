"""Chat formatting with tool calls: link, order, validate, serialise.

Calls and results meet in a hash join by identifier. Calls are ordered by what they need: chains of
needs are followed by doubling, and calls with several needs wait for all of them. Arguments are held against schemas through their VARIANT form, and every
message becomes one canonical JSON object: keys in alphabetical order, no blanks, no nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluxwell.llm.common import settle

#: Types of arguments, and how VARIANT names them.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|DECIMAL.*)", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}
Schemas = dict[str, dict[str, tuple[str, bool]]]


def fault(arguments: Column, tool: Column, schemas: Schemas) -> Column:
    """The first fault of a call's arguments, or null. ``arguments`` is a VARIANT, null where it isn't JSON."""
    found = F.when(F.coalesce(tool.isin(*schemas) if schemas else F.lit(False), F.lit(False)), F.lit(None).cast("string")).otherwise("unknown tool")
    for name, fields in schemas.items():
        own = F.lit(None).cast("string")
        for field, (kind, required) in sorted(fields.items(), reverse=True):
            value = F.variant_get(arguments, f"$.{field}", "variant")
            missing = F.lit(f"{field} is missing") if required else F.lit(None).cast("string")
            wrong = ~F.schema_of_variant(value).rlike(f"^{TYPES[kind]}$")
            absent = value.isNull() | F.is_variant_null(value)
            own = F.when(absent, F.coalesce(missing, own)).when(wrong, f"{field} is no {kind}").otherwise(own)
        own = F.when(arguments.isNull(), "arguments are no JSON").when(~F.schema_of_variant(arguments).rlike("^OBJECT"), "arguments are no object").otherwise(own)
        found = F.when(tool == name, own).otherwise(found)
    return found


def chains(single: DataFrame) -> DataFrame:
    """Where chains of single needs end: ``conv_id``, ``call_id``, ``up``, ``far``.

    ``single`` has calls with exactly one need, ``up``. In the result ``up`` is the first call on the way that isn't
    in ``single``, ``far`` needs away. Calls on a cycle of single needs, or after one, are left out. Each round doubles
    how far a call sees, so a chain takes a logarithm of its length in rounds.
    """
    inner = single.select("conv_id", F.col("call_id").alias("up"), F.lit(True).alias("more"))
    start = single.join(inner, ["conv_id", "up"], "left")
    ways = settle(start.select("conv_id", "call_id", "up", F.lit(1).alias("far"), F.coalesce("more", F.lit(False)).alias("open")), "ways")
    before, left = -1, ways.where("open").count()
    # a round in which no call arrives leaves cycles only
    while left and left != before:
        on = ways.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("far").alias("further"), F.col("open").alias("more"))
        step = ways.join(on, ["conv_id", "up"], "left")
        far = F.col("far") + F.coalesce("further", F.lit(0))
        ways = settle(step.select("conv_id", "call_id", F.coalesce("next", "up").alias("up"), far.alias("far"), F.coalesce("more", F.lit(False)).alias("open")), "ways")
        before, left = left, ways.where("open").count()
    return ways.where("NOT open").drop("open")


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id``, ``call_id`` and ``level`` (length of the longest chain of needs) of calls (``needs``: array of ids).

    Needs that no call of the conversation has are ignored; calls in a cycle, or after one, get no level. Chains of
    calls with one need each are followed by doubling; calls with several needs take a round per level of such calls.
    """
    key = ["conv_id", "call_id"]
    nodes = calls.select(*key).distinct()
    needs = calls.select(*key, F.explode("needs").alias("need")).distinct()
    needs = settle(needs.join(nodes.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_semi"), "needs")
    counted = settle(needs.groupBy(*key).agg(F.count("*").alias("n"), F.min("need").alias("up")), "counted")
    ways = chains(counted.where("n = 1").drop("n"))
    ready = settle(nodes.join(counted, key, "left_anti").withColumn("level", F.lit(0)), "level")
    via = ways.select("conv_id", F.col("call_id").alias("need"), "up", "far")
    several = needs.join(counted.where("n > 1").select(*key), key, "left_semi").join(via, ["conv_id", "need"], "left")
    edges = several.groupBy(*key, F.coalesce("up", "need").alias("up")).agg(F.max(F.coalesce("far", F.lit(0)) + 1).alias("far"))
    edges = settle(edges.withColumn("reached", F.lit(None).cast("int")), "edges")
    known = ready
    while not edges.isEmpty() and not ready.isEmpty():
        level = ready.select("conv_id", F.col("call_id").alias("up"), "level")
        met = edges.join(level, ["conv_id", "up"], "left")
        met = settle(met.select(*key, "up", "far", F.coalesce("reached", F.col("level") + F.col("far")).alias("reached")), "edges")
        free = met.groupBy(*key).agg(F.max("reached").alias("level"), F.count("reached").alias("m"), F.count("*").alias("n"))
        ready = settle(free.where("m = n").select(*key, "level"), "level")
        edges = settle(met.join(ready, key, "left_anti"), "edges")
        known = known.union(ready)
    ends = known.select("conv_id", F.col("call_id").alias("up"), F.col("level").alias("base"))
    return known.union(ways.join(ends, ["conv_id", "up"]).select(*key, (F.col("base") + F.col("far")).alias("level")))


def format_chat(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """Every message, call and result as canonical JSON.

    ``messages`` has ``conv_id``, ``turn``, ``role``, ``text``; ``calls`` has ``conv_id``, ``turn``, ``call_id``, ``tool``,
    ``arguments`` (JSON text), ``needs``; ``results`` has ``conv_id``, ``call_id``, ``content``; more columns are ignored.
    Returns ``conv_id``, ``turn``, ``kind`` (0 message, 1 call, 2 result), ``level``, ``call_id``, ``status`` and ``json``;
    by ``turn``, ``kind``, ``level``, ``call_id`` rows of a conversation stand in order.

    ``status`` is ``ok``, a fault of the arguments, ``no result``, ``cyclic``, or, for a result, ``no call`` (its turn is
    null, and so last). Of results that share an identifier the smallest content counts; of calls each. Nulls
    are left out of the JSON; rows without a conversation or identifier link with nothing.
    """
    value = F.try_parse_json(F.col("arguments"))
    read = calls.select("conv_id", F.col("turn").cast("long"), F.col("call_id").cast("string"), "tool", "arguments", F.coalesce("needs", F.array().cast("array<string>")).alias("needs"))
    order = levels(read.where("conv_id IS NOT NULL AND call_id IS NOT NULL"))
    one = results.groupBy("conv_id", F.col("call_id").cast("string").alias("call_id")).agg(F.min("content").alias("content"), F.count("*").alias("n"))
    linked = read.join(order, ["conv_id", "call_id"], "left").join(one, ["conv_id", "call_id"], "left")
    wrong = fault(value, F.col("tool"), schemas)
    status = F.coalesce(wrong, F.when(F.col("level").isNull(), "cyclic"), F.when(F.col("n").isNull(), "no result"), F.lit("ok"))
    # VARIANT keeps the keys of an object in order
    linked = linked.select("conv_id", "turn", "level", "call_id", "tool", F.coalesce(F.to_json(value), F.col("arguments")).alias("arguments"), "content", "n", status.alias("status"))
    linked = settle(linked, "linked")
    call_json = F.to_json(F.struct(F.col("arguments"), F.col("call_id").alias("id"), F.col("tool").alias("name"), F.lit("call").alias("role")))
    result_json = F.to_json(F.struct(F.col("content"), F.col("call_id").alias("id"), F.lit("tool").alias("role")))
    text_json = F.to_json(F.struct(F.col("text").alias("content"), F.col("role")))
    none = F.lit(None)
    out = messages.select("conv_id", F.col("turn").cast("long"), F.lit(0).alias("kind"), F.lit(0).alias("level"), none.cast("string").alias("call_id"), F.lit("ok").alias("status"), text_json.alias("json"))
    out = out.union(linked.select("conv_id", "turn", F.lit(1), "level", "call_id", "status", call_json))
    out = out.union(linked.where("n IS NOT NULL").select("conv_id", "turn", F.lit(2), "level", "call_id", "status", result_json))
    lost = one.join(read.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
    return out.union(lost.select("conv_id", none.cast("long"), F.lit(2), none.cast("int"), "call_id", F.lit("no call"), result_json))


#: Schemas of the tools that the derived calls use: field, type, whether it is required.
SCHEMAS: Schemas = {
    "search": {"query": ("string", True), "words": ("integer", True), "strict": ("boolean", False)},
    "lookup": {"query": ("string", True), "words": ("integer", True), "limit": ("integer", True)},
}


def with_turns_before(conversations: DataFrame) -> DataFrame:
    """Adds ``assistant_before`` and ``user_before``: the last turn of that role before a row's own turn, or null.

    Conversations are sorted into ranges of turns, so that one of any length spreads over many tasks; each range
    is read in order on its own, and what lies before a range comes from one row for each range.
    """
    order = ["conv_id", "turn"]
    turns = conversations.select("conv_id", F.col("turn").cast("long"), "role", "text")
    placed = settle(turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    own = lambda role: F.max(F.when(F.col("role") == role, F.col("turn")))
    before = Window.partitionBy("conv_id", "part").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    ends = placed.where("conv_id IS NOT NULL").groupBy("conv_id", "part").agg(own("assistant").alias("a"), own("user").alias("u"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("conv_id", "part", F.max("a").over(earlier).alias("a"), F.max("u").over(earlier).alias("u"))
    here = placed.withColumns({"assistant_before": own("assistant").over(before), "user_before": own("user").over(before)})
    met = here.join(carried, ["conv_id", "part"], "left")
    return met.select("conv_id", "turn", "role", "text", F.coalesce("assistant_before", "a").alias("assistant_before"), F.coalesce("user_before", "u").alias("user_before"))


def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a table of plain turns stands for.

    Each assistant turn calls a tool with its whole text and needs the call of the assistant turn before it, whatever
    stands between. A user turn is the result of the last assistant turn before it, unless another user turn came
    first; so the opening question, after a system turn or none, is no result. Short turns ask a lookup without a
    limit, which the schema wants. Rows without a conversation or a turn stand for neither.
    """
    words = F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "[ \n]+"))
    name = lambda turn: F.concat_ws("-", "conv_id", turn)
    tool = F.when(words < 30, "lookup").otherwise("search")
    arguments = F.to_json(F.struct(words.alias("words"), F.col("text").alias("query"), (words > 60).alias("strict")))
    turns = settle(with_turns_before(conversations).where("conv_id IS NOT NULL AND turn IS NOT NULL"), "linked-turns")
    needs = F.when(F.col("assistant_before").isNull(), F.array().cast("array<string>")).otherwise(F.array(name("assistant_before")))
    own = turns.where("role = 'assistant'")
    calls = own.select("conv_id", "turn", name("turn").alias("call_id"), tool.alias("tool"), arguments.alias("arguments"), needs.alias("needs"))
    answers = turns.where("role = 'user' AND assistant_before IS NOT NULL AND (user_before IS NULL OR user_before < assistant_before)")
    return calls, answers.select("conv_id", name("assistant_before").alias("call_id"), F.col("text").alias("content"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """:func:`format_chat` over a table of turns and the calls that it stands for."""
    calls, results = derived_calls(conversations)
    return format_chat(conversations, calls, results, SCHEMAS)
