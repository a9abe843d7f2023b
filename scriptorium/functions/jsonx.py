"""Column builders for ragged JSON: replies of models and recognised documents, read as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions.text import let, strip

VARIANTS = "array<variant>"


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def field_kind(v: Column, path: str) -> Column:
    """What a field is: STRING, BIGINT, BOOLEAN, ARRAY<..., OBJECT<..., VOID; null where it is missing."""
    return F.schema_of_variant(get(v, path, "variant"))


def plain(v: Column) -> Column:
    """A value of any kind as text, in the spelling None, True, False."""
    kind = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | (kind == "VOID"), F.lit("None"))
        .when(kind == "BOOLEAN", F.when(get(v, "$", "boolean"), "True").otherwise("False"))
        .otherwise(get(v, "$", "string"))
    )


def truthy_text(v: Column) -> Column:
    """A value as text, empty where it counts as false: missing, null, 0, false, and empty lists and objects."""
    kind = F.schema_of_variant(v)
    empty = v.isNull() | (kind == "VOID") | ((kind == "BOOLEAN") & ~F.coalesce(get(v, "$", "boolean"), F.lit(False))) | (kind.isin("BIGINT", "DOUBLE") & (get(v, "$", "double") == 0)) | kind.isin("ARRAY<VOID>", "OBJECT<>")
    return F.when(empty, F.lit("")).otherwise(plain(v))


def truthy_or_plain(v: Column) -> Column:
    """A value as text, empty where it is missing or null; unlike ``truthy_text``, 0 and false are texts."""
    return F.when(v.isNull() | (F.schema_of_variant(v) == "VOID"), F.lit("")).otherwise(plain(v))


def dump(c: Column, pretty: bool = False) -> Column:
    """A struct, map, array or VARIANT as JSON: without blanks, or indented; null fields of structs go, letters of any
    script stay as they are."""
    return F.to_json(c, {"pretty": "true"} if pretty else {})


def object_in_text(c: Column) -> Column:
    """The first JSON object in a reply, as VARIANT: of a tool call, of the whole text without its code fence, or from
    its first to its last brace; null without one."""
    text = strip(F.coalesce(c, F.lit("")))
    unfenced = lambda x: F.regexp_replace(F.regexp_replace(x, r"\A(?i:```(?:json)?)\s*", ""), r"\s*```\z", "")
    bare = let(text, lambda x: F.when(x.contains("```"), unfenced(x)).otherwise(x))

    def first_object(t: Column) -> Column:
        call = F.regexp_extract(t, r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>", 1)
        open_, close = F.instr(t, "{"), F.length(t) - F.instr(F.reverse(t), "}") + 1
        inner = F.when((open_ > 0) & (F.instr(t, "}") > 0) & (close > open_), F.substring(t, open_, close - open_ + 1))
        found = lambda s: let(F.try_parse_json(s), lambda v: F.when(is_object(v), v))
        # What comes later is parsed only where that before is no object; a text that is none costs an exception.
        return F.coalesce(F.when(t.contains("<tool_call>"), let(call, lambda c: F.when(c != "", found(c)))), found(t), found(inner))

    return let(bare, first_object)


def unwrap(v: Column, tool: str) -> Column:
    """The data of a tool call's object: its arguments (an object, or a text that holds one), of these the field data;
    null where that is no object."""

    def arguments(x: Column) -> Column:
        kind = field_kind(x, "$.arguments")
        parsed = object_in_text(get(x, "$.arguments", "string"))
        return F.when(kind == "STRING", F.coalesce(parsed, x)).when(kind.startswith("OBJECT"), get(x, "$.arguments", "variant")).otherwise(x)

    named = F.when((get(v, "$.name", "string") == tool) & field_kind(v, "$.arguments").startswith("OBJECT"), get(v, "$.arguments", "variant")).otherwise(v)
    data = let(let(named, arguments), lambda x: F.when(field_kind(x, "$.data").isNull(), x).otherwise(get(x, "$.data", "variant")))
    return let(data, lambda x: F.when(is_object(x), x))
