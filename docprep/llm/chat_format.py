"""Chat formatting with tool-call linking, in DataFrame operations alone.

A message of the assistant may be a JSON object with ``tool_calls`` (each with
id, name, arguments) and ``content``; a message of role ``tool`` is a JSON
object with ``tool_call_id`` and ``content``. Calls and results are hash-joined
by conversation and identifier. The order of a conversation is topological: a
result comes after its call, whatever turn it was recorded at, and otherwise
turns keep their order; (order_turn, order_sub) is the sort key, so that no task
has to hold a conversation. Arguments are checked against the tool's schema.
Each message becomes canonical JSON: keys sorted, no white space.

Edge cases: null texts are empty, null roles ``unknown``; text that isn't a
JSON object is plain content; of several results or calls with one identifier
the earliest is linked; a result without a call, a call without an identifier,
and one with a null conversation stay where they are, not linked; calls of
tools without a schema, or with arguments that aren't a JSON object, are not
valid. Repeated rows stay repeated; of two with one turn and identifier either may be the
earliest. Very long texts stay whole, an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGE = "tool_calls array<struct<id string, name string, arguments string>>, tool_call_id string, content string"
#: Types of a schema, as the engine names those of a parsed value.
TYPES = {"string": r"STRING", "integer": r"BIGINT", "number": r"BIGINT|DOUBLE|DECIMAL.*", "boolean": r"BOOLEAN", "array": r"ARRAY.*", "object": r"OBJECT.*"}
#: Schemas of tools: name -> parameter -> (type, required).
Schemas = dict[str, dict[str, tuple[str, bool]]]
SCHEMAS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "calculator": {"expression": ("string", True)},
    "get_weather": {"city": ("string", True), "unit": ("string", False)},
}


def json_string(c: Column) -> Column:
    one = F.to_json(F.array(c))
    return F.substring(one, F.lit(2), F.length(one) - 2)


def canonical(arguments: Column) -> Column:
    """JSON text with sorted keys and no white space; text that isn't JSON as a JSON string."""
    parsed = F.try_parse_json(arguments)
    return F.when(arguments.isNull(), "null").otherwise(F.coalesce(F.to_json(parsed), json_string(arguments)))


def valid_arguments(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Whether required parameters are there, of their types, and no others."""
    parsed = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    out = F.lit(False)
    for tool, params in sorted(schemas.items()):
        ok = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False)) & (F.size(F.array_except(keys, F.array(*map(F.lit, params)) if params else F.array().cast("array<string>"))) == 0)
        for p, (kind, required) in sorted(params.items()):
            found = F.schema_of_variant(F.try_variant_get(parsed, f"$.{p}", "variant"))
            ok = ok & F.coalesce(found.rlike(f"^({TYPES[kind]})$"), F.lit(not required))
        out = F.when(name == tool, ok).otherwise(out)
    return F.coalesce(out, F.lit(False))


def format_chats(messages: DataFrame, schemas: Schemas | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each message: conv_id, turn, order_turn, order_sub, role, n_calls, n_valid, n_linked, is_linked_result, message_json."""
    schemas = SCHEMAS if schemas is None else schemas
    text, role = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(role_col), F.lit("unknown"))
    base = messages.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    parsed = F.when(F.col("role").isin("assistant", "tool") & F.ltrim(F.col("text")).startswith("{"), F.from_json("text", MESSAGE))
    m = base.withColumn("p", parsed).withColumn("p", F.when(F.col("p.tool_calls").isNotNull() | F.col("p.tool_call_id").isNotNull(), F.col("p")))
    calls = F.when(F.col("role") == "assistant", F.coalesce(F.col("p.tool_calls"), F.array().cast("array<struct<id string, name string, arguments string>>"))).otherwise(F.array().cast("array<struct<id string, name string, arguments string>>"))
    m = m.withColumn("calls", F.filter(calls, lambda c: c.isNotNull())).withColumn("result_of", F.when(F.col("role") == "tool", F.col("p.tool_call_id")))
    call_rows = m.where(F.size("calls") > 0).select("conv", "turn", F.posexplode("calls").alias("pos", "c")).select("conv", "turn", "pos", F.col("c.id").alias("id")).where("id is not null").distinct()
    first_call = call_rows.groupBy("conv", "id").agg(F.min(F.struct("turn", "pos")).alias("at"))
    first_result = m.where("result_of is not null").groupBy("conv", F.col("result_of").alias("id")).agg(F.min("turn").alias("result_turn"))
    links = first_call.hint("shuffle_hash").join(first_result, ["conv", "id"])
    linked = links.groupBy("conv", F.col("at.turn").alias("turn")).agg(F.count("*").alias("n_linked"))
    to_call = links.select("conv", F.col("id").alias("result_of"), "at", F.col("result_turn").alias("turn"))
    out = m.join(linked, ["conv", "turn"], "left").join(to_call, ["conv", "turn", "result_of"], "left")
    call_json = F.transform("calls", lambda c: F.concat(F.lit('{"arguments":'), canonical(c["arguments"]), F.lit(',"id":'), F.coalesce(json_string(c["id"]), F.lit("null")), F.lit(',"name":'), F.coalesce(json_string(c["name"]), F.lit("null")), F.lit("}")))
    content = F.when(F.col("p").isNotNull(), F.coalesce(F.col("p.content"), F.lit(""))).otherwise(F.col("text"))
    message = F.concat(
        F.lit('{"content":'), json_string(content), F.lit(',"role":'), json_string(F.col("role")),
        F.when(F.col("result_of").isNotNull(), F.concat(F.lit(',"tool_call_id":'), json_string(F.col("result_of")))).otherwise(""),
        F.when(F.size("calls") > 0, F.concat(F.lit(',"tool_calls":['), F.array_join(call_json, ","), F.lit("]"))).otherwise(""), F.lit("}"),
    )
    return out.select(
        F.col("conv").alias("conv_id"), "turn", F.greatest("turn", "at.turn").alias("order_turn"), F.when(F.col("at").isNotNull(), F.col("at.pos").cast("long") + 1).otherwise(0).alias("order_sub"), "role",
        F.size("calls").cast("long").alias("n_calls"), F.size(F.filter("calls", lambda c: valid_arguments(c["name"], c["arguments"], schemas))).cast("long").alias("n_valid"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.col("at").isNotNull().alias("is_linked_result"), message.alias("message_json"),
    )
