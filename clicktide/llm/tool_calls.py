"""Tool-call linking: calls meet their results by identifier, in topological order, as canonical JSON.

Everything is DataFrame code. Calls and results of a conversation are joined on the call's identifier;
the same identifier in another conversation is another call. Every call may name a parent, the call whose result it follows; its level is the number of ancestors, found by
pointer doubling, so a chain of n calls takes log2(n) joins. (level, call before result, turn, id)
then orders a conversation topologically, without bringing it together anywhere. Arguments are
checked against the schema of the call's tool, and every message is one line of canonical JSON: keys
sorted, no blanks, numbers in their shortest form. Arguments that repeat a key count as no JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import delete_path
from clicktide.operators.ordered import join_per_key
from clicktide.session import materialize, scratch

#: JSON Schema types and what ``schema_of_variant`` calls such values.
_TYPES = {
    "string": "STRING",
    "boolean": "BOOLEAN",
    "integer": "BIGINT|DECIMAL\\(\\d+,0\\)",
    "number": "BIGINT|DECIMAL\\(.*|DOUBLE|FLOAT",
    "array": "ARRAY<.*",
    "object": "OBJECT<.*",
    "null": "VOID",
}


def canonical_json(text: str) -> Column:
    """The JSON text with sorted keys and no blanks; null if it is no JSON."""
    return F.to_json(F.try_parse_json(F.col(text)))


#: Texts from this size on may not fit a variant.
_LARGE = 16 << 20
#: What of JSON Schema is checked; a schema with anything else is refused.
_OBJECT_WORDS = {"type", "properties", "required", "additionalProperties"}
_VALUE_WORDS = _OBJECT_WORDS | {"minimum", "maximum", "minLength", "maxLength", "enum", "items", "description"}


def _step(name: str) -> str:
    if "'" in name or "[" in name:
        raise ValueError(f"no quotes or brackets in names of properties: {name}")
    return f"['{name}']"


def _known_words(schema: dict, words: set[str], where: str) -> None:
    if unknown := set(schema) - words:
        raise ValueError(f"no check for {sorted(unknown)} of {where or 'the arguments'}")


def _type_pattern(rule: dict) -> str:
    return "^(" + "|".join(_TYPES[t] for t in _as_list(rule.get("type", list(_TYPES)))) + ")$"


def _object_problems(root: Column, keys: Column, schema: dict, path: str, where: str) -> list[Column]:
    """What is wrong with the members of an object, each null where nothing is; ``keys`` are the object's
    own, ``path`` leads to it from ``root``, and ``where`` names it."""
    found = []
    required, properties = schema.get("required", []), schema.get("properties", {})
    for name in [*properties, *[r for r in required if r not in properties]]:
        there = F.array_contains(keys, name)
        if name in required:
            found.append(F.when(~there, F.lit(f"missing {where}{name}")))
        if name in properties:
            found += _value_problems(root, there, properties[name], path + _step(name), where + name)
    if schema.get("additionalProperties") is False:
        unknown = F.array_except(keys, F.array(*map(F.lit, properties)).cast("array<string>"))
        of = f" of {where[:-1]}" if where else ""
        found.append(F.when(F.size(unknown) > 0, F.lit(f"unknown property{of}")))
    elif schema.get("additionalProperties", True) is not True:
        raise ValueError("additionalProperties is true or false")
    return found


def _value_problems(root: Column, there: Column, rule: dict, path: str, name: str) -> list[Column]:
    _known_words(rule, _VALUE_WORDS, name)
    found = []
    value = F.try_variant_get(root, path, "variant")
    kind = F.schema_of_variant(value)
    good_type = kind.rlike(_type_pattern(rule))
    found.append(F.when(there & ~good_type, F.lit(f"type of {name}")))
    number = F.try_variant_get(root, path, "double")
    size = F.char_length(F.try_variant_get(root, path, "string"))
    limits = {
        "minimum": number < rule.get("minimum", 0),
        "maximum": number > rule.get("maximum", 0),
        "minLength": size < rule.get("minLength", 0),
        "maxLength": size > rule.get("maxLength", 0),
    }
    for limit, broken in limits.items():
        if limit in rule:
            is_kind = kind == "STRING" if "Length" in limit else kind != "STRING"
            found.append(F.when(there & good_type & is_kind & broken, F.lit(f"{limit} of {name}")))
    if "enum" in rule:
        text = F.try_variant_get(root, path, "string")
        allowed = [str(v) for v in rule["enum"]]
        found.append(F.when(there & good_type & ~text.isin(allowed), F.lit(f"enum of {name}")))
    if "items" in rule:
        _known_words(rule["items"], {"type", "description"}, f"items of {name}")
        items = F.try_variant_get(root, path, "array<variant>")
        pattern = _type_pattern(rule["items"])
        # A null item is null here as well.
        bad = F.exists(items, lambda v: ~F.coalesce(F.schema_of_variant(v), F.lit("VOID")).rlike(pattern))
        found.append(F.when(there & kind.startswith("ARRAY<") & bad, F.lit(f"items of {name}")))
    if _OBJECT_WORDS & set(rule) - {"type"}:
        is_object = there & kind.startswith("OBJECT<")
        keys = F.json_object_keys(F.to_json(value))
        inner = _object_problems(root, keys, rule, path, f"{name}.")
        found += [F.when(is_object, problem) for problem in inner]
    return found


def _problems(arguments: Column, keys: Column, schema: dict) -> Column:
    """Array of what is wrong with the arguments of one tool, in the schema's order."""
    _known_words(schema, _OBJECT_WORDS | {"description"}, "")
    found = _object_problems(arguments, keys, schema, "$", "")
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def _as_list(types: str | list[str]) -> list[str]:
    return [types] if isinstance(types, str) else types


def argument_problems(tool: str, arguments: str, schemas: dict[str, dict]) -> Column:
    """What is wrong with the arguments of a call, by the schema of its tool; empty if nothing.

    Members of objects are named by their path (``a.b``). Of arrays the type of the items is checked. A
    schema with other words of JSON Schema raises. Arguments too large to be parsed are reported so.
    """
    parsed, text = F.try_parse_json(F.col(arguments)), F.col(arguments)
    keys = F.json_object_keys(text)
    is_object = parsed.isNotNull() & F.schema_of_variant(parsed).startswith("OBJECT<")
    result = F.array(F.lit("unknown tool"))
    for name, schema in schemas.items():
        result = F.when(F.col(tool) == name, _problems(parsed, keys, schema)).otherwise(result)
    too_large = parsed.isNull() & (F.octet_length(text) >= _LARGE) & keys.isNotNull()
    return (
        F.when(is_object, result)
        .when(too_large, F.array(F.lit("arguments too large")))
        .otherwise(F.array(F.lit("arguments are no object")))
    )


def call_levels(calls: DataFrame) -> DataFrame:
    """(call_id, level): number of ancestors; null in or behind a cycle.

    ``calls`` has unique call_id and parent_id. A parent that is null or no call counts as none.
    Each round doubles how far a call sees; it stops when all have seen their first ancestor, or
    further than there are calls.
    """
    spark = calls.sparkSession
    known = calls.select(F.col("call_id").alias("_known"))
    # Calls without a parent, perhaps most of them, need not meet in the task of the null key.
    first = calls.where(F.col("parent_id").isNull()).select(
        "call_id", F.lit(None).cast("string").alias("ahead"), F.lit(0).alias("level")
    )
    later = calls.where(F.col("parent_id").isNotNull()).join(
        known, F.col("parent_id") == F.col("_known"), "left"
    )
    start = first.unionByName(
        later.select(
            "call_id", F.col("_known").alias("ahead"), F.col("_known").isNotNull().cast("int").alias("level")
        )
    )
    path = scratch(spark, "levels")
    start.write.parquet(path)
    total, reach = spark.read.parquet(path).count(), 1
    while True:
        now = spark.read.parquet(path)
        if reach > total or not now.where(F.col("ahead").isNotNull()).limit(1).count():
            break
        step = now.select(
            F.col("call_id").alias("ahead"), F.col("ahead").alias("_next"), F.col("level").alias("_more")
        )
        further = join_per_key(now.where("ahead IS NOT NULL"), step, ["ahead"], "inner").select(
            "call_id", F.col("_next").alias("ahead"), (F.col("level") + F.col("_more")).alias("level")
        )
        following = scratch(spark, "levels")
        now.where("ahead IS NULL").unionByName(further).write.parquet(following)
        delete_path(spark, path)
        path, reach = following, 2 * reach
    return now.select("call_id", F.when(F.col("ahead").isNull(), F.col("level")).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message: conv_id, level, is_result, turn, call_id, status, problems, json.

    ``calls``: conv_id, turn, call_id, parent_id, tool, arguments (JSON text). ``results``: conv_id,
    turn, call_id, content. Ids count within their conversation; rows without a conv_id make one of
    their own. Status of a call: "answered", "unanswered", "duplicate" (an id seen before, by turn,
    tool, arguments and parent; of equal rows all but one), "no id"; of a result: "linked", "orphan" (no
    such call), "no id". Every row gives a message. Results and duplicates have the level of their
    call, orphans none. Arguments that are no JSON stay as text in the canonical line. Other columns
    are ignored.
    """
    # Written first: a number tells equal rows apart, and must stay when a lost task runs again.
    named = materialize(
        calls.select("conv_id", "turn", "call_id", "parent_id", "tool", "arguments").withColumns(
            {
                "_key": _in_conversation("call_id"),
                "_parent": _in_conversation("parent_id"),
                "_row": F.monotonically_increasing_id(),
            }
        ),
        "calls",
    ).withColumn("_order", F.struct("turn", "tool", "arguments", "parent_id", "_row"))
    # The first call of each id; its copies are told apart by what orders them.
    firsts = (
        named.where("_key IS NOT NULL")
        .groupBy("_key")
        .agg(F.min(F.struct("_order", "_parent")).alias("_f"))
        .select("_key", F.col("_f._order._row").alias("_first"), F.col("_f._parent").alias("_parent"))
    )
    levels = call_levels(
        firsts.select(F.col("_key").alias("call_id"), F.col("_parent").alias("parent_id"))
    ).withColumnRenamed("call_id", "_key")
    first = firsts.select("_key", "_first").join(levels, "_key")
    keyed = results.select("conv_id", "turn", "call_id", "content").withColumn("_key", _in_conversation("call_id"))
    answers = keyed.where("_key IS NOT NULL").groupBy("_key").agg(F.count(F.lit(1)).alias("_answers"))
    per_call = first.join(answers, "_key", "left")
    from_calls = (
        join_per_key(named, per_call, ["_key"], "left")
        .withColumn(
            "status",
            F.when(F.col("call_id").isNull(), "no id")
            .when(F.col("_row") != F.col("_first"), "duplicate")
            .when(F.col("_answers").isNull(), "unanswered")
            .otherwise("answered"),
        )
        .withColumn("problems", argument_problems("tool", "arguments", schemas))
        .select(
            "conv_id",
            "level",
            F.lit(False).alias("is_result"),
            "turn",
            "call_id",
            "status",
            "problems",
            _line(
                ("arguments", F.coalesce(canonical_json("arguments"), _quoted("arguments"))),
                ("id", _quoted("call_id")),
                ("parent", _quoted("parent_id")),
                ("tool", _quoted("tool")),
            ).alias("json"),
        )
    )
    from_results = join_per_key(keyed, levels.withColumn("_call", F.lit(True)), ["_key"], "left").select(
        "conv_id",
        "level",
        F.lit(True).alias("is_result"),
        "turn",
        "call_id",
        F.when(F.col("call_id").isNull(), "no id").when(F.col("_call"), "linked").otherwise("orphan").alias("status"),
        F.array().cast("array<string>").alias("problems"),
        _line(("content", _quoted("content")), ("id", _quoted("call_id"))).alias("json"),
    )
    return from_calls.unionByName(from_results)


def _in_conversation(call_id: str) -> Column:
    """Key of a call: its id within its conversation; null for a null id."""
    return F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.col(call_id))


def _quoted(col: str) -> Column:
    """A text as JSON string, null as the JSON null."""
    text = F.to_json(F.struct(F.col(col).cast("string").alias("x")))
    return F.when(F.col(col).isNull(), "null").otherwise(F.substr(text, F.lit(6), F.length(text) - 6))


def _line(*members: tuple[str, Column]) -> Column:
    """A JSON object; the members come sorted by name."""
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in members]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


# What the conversations table gives: a user's turn asks a tool, an assistant's turn answers it.
SCHEMAS = {
    "answer": {
        "type": "object",
        "properties": {
            "conversation": {"type": "integer", "minimum": 0},
            "prompt": {"type": "string", "minLength": 1, "maxLength": 600},
            "turn": {"type": "integer", "minimum": 0},
        },
        "required": ["conversation", "prompt", "turn"],
        "additionalProperties": False,
    },
    "configure": {
        "type": "object",
        "properties": {"prompt": {"type": "string", "minLength": 1}},
        "required": ["prompt"],
    },
}


def calls_of_conversations(conversations: DataFrame) -> DataFrame:
    """User turns as calls of ``answer``, other turns but the assistant's as calls of ``configure``.

    A call's id is made of conversation and turn; its parent is the call two turns before, whose
    result the turn before was. A null text is an argument of null.
    """
    asks = F.col("role").eqNullSafe("user")
    arguments = F.when(
        asks,
        F.to_json(
            F.struct("turn", F.col("text").alias("prompt"), F.col("conv_id").alias("conversation")),
            {"ignoreNullFields": "false"},
        ),
    ).otherwise(F.to_json(F.struct(F.col("text").alias("prompt")), {"ignoreNullFields": "false"}))
    return conversations.where(~F.col("role").eqNullSafe("assistant")).select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        _id("turn").alias("call_id"),
        F.when(F.col("turn") > 1, _id(F.col("turn") - 2)).alias("parent_id"),
        F.when(asks, "answer").otherwise("configure").alias("tool"),
        arguments.alias("arguments"),
    )


def results_of_conversations(conversations: DataFrame) -> DataFrame:
    """Assistant turns as results of the call of the turn before."""
    return conversations.where("role = 'assistant'").select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        _id(F.col("turn") - 1).alias("call_id"),
        F.col("text").alias("content"),
    )


def _id(turn) -> Column:
    number = F.col(turn) if isinstance(turn, str) else turn
    return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), number.cast("string"))
