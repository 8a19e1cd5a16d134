"""VARIANT and JSON helpers: typed reads that keep null, missing and wrong type apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agentlake.functions.text import strip_ws


def kind(v: Column) -> Column:
    """Variant kind: object, array, string, integer, boolean, other, null (JSON) or SQL null."""
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(F.is_variant_null(v), "null")
        .when(s.startswith("OBJECT"), "object")
        .when(s.startswith("ARRAY"), "array")
        .when(s == "STRING", "string")
        .when(s == "BIGINT", "integer")
        .when(s == "BOOLEAN", "boolean")
        .otherwise("other")
    )


# How the schema text of a variant starts for each kind.
_SCHEMA_HEAD = {"object": "OBJECT<", "array": "ARRAY<", "string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "null": "VOID"}


def is_kind(v: Column, k: str) -> Column:
    """Test of one kind; SQL null for a missing value."""
    return F.schema_of_variant(v).startswith(_SCHEMA_HEAD[k])


def path(v: Column, p: str) -> Column:
    """Variant at a path, SQL null when missing."""
    return F.try_variant_get(v, p, "variant")


def text_at(v: Column, p: str) -> Column:
    """String value at a path; any other type is null."""
    x = path(v, p)
    return F.when(is_kind(x, "string"), F.try_variant_get(v, p, "string"))


def count_at(v: Column, p: str) -> Column:
    """Non-boolean integer at a path; any other type is null."""
    x = path(v, p)
    return F.when(is_kind(x, "integer"), F.try_variant_get(v, p, "bigint"))


def items(v: Column) -> Column:
    """Variant array as ARRAY<VARIANT>, null when it is not an array."""
    return F.when(is_kind(v, "array"), F.try_variant_get(v, "$", "array<variant>"))


def json_text(v: Column) -> Column:
    return F.to_json(v)


def record_text(content: Column) -> Column:
    """String content as is, else the text blocks joined by a line break."""
    blocks = F.filter(items(content), lambda b: text_at(b, "$.type") == "text")
    joined = F.array_join(F.transform(blocks, lambda b: F.coalesce(text_at(b, "$.text"), F.lit(""))), "\n")
    return (
        F.when(is_kind(content, "string"), F.try_variant_get(content, "$", "string"))
        .when(is_kind(content, "array"), joined)
        .otherwise("")
    )


def codex_text(v: Column) -> Column:
    """Every object with a string ``text`` plus bare strings, joined."""
    def piece(b: Column) -> Column:
        return F.when(is_kind(b, "object"), text_at(b, "$.text")).when(
            is_kind(b, "string"), F.try_variant_get(b, "$", "string")
        )

    parts = F.filter(F.transform(items(v), piece), lambda x: x.isNotNull())
    return (
        F.when(is_kind(v, "string"), F.try_variant_get(v, "$", "string"))
        .when(is_kind(v, "array"), F.array_join(parts, "\n"))
        .otherwise("")
    )


def cursor_text(v: Column) -> Column:
    """Only objects with a string ``text``."""
    parts = F.filter(
        F.transform(items(v), lambda b: F.when(is_kind(b, "object"), text_at(b, "$.text"))), lambda x: x.isNotNull()
    )
    return (
        F.when(is_kind(v, "string"), F.try_variant_get(v, "$", "string"))
        .when(is_kind(v, "array"), F.array_join(parts, "\n"))
        .otherwise("")
    )


def _as_input(v: Column) -> Column:
    """A variant wrapped as ``{input: v}``."""
    return F.parse_json(F.concat(F.lit('{"input":'), F.to_json(v), F.lit("}")))


def tool_input(payload: Column) -> Column:
    """Tool arguments as an object, whatever form they came in."""
    args = path(payload, "$.arguments")
    raw = F.when(args.isNull() | F.is_variant_null(args), path(payload, "$.input")).otherwise(args)
    text = F.try_variant_get(raw, "$", "string")
    parsed = F.try_parse_json(text)
    empty = F.parse_json(F.lit("{}"))
    wrapped_text = F.to_variant_object(F.named_struct(F.lit("input"), text))
    return (
        F.when(is_kind(raw, "object"), raw)
        .when((is_kind(raw, "string")) & (is_kind(parsed, "object")), parsed)
        .when((is_kind(raw, "string")) & parsed.isNotNull(), _as_input(parsed))
        .when(is_kind(raw, "string"), wrapped_text)
        .otherwise(empty)
    )


def tool_output(v: Column) -> Column:
    """String as is, null as empty, anything else as JSON text."""
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(""))
        .when(is_kind(v, "string"), F.try_variant_get(v, "$", "string"))
        .otherwise(F.to_json(v))
    )


def cursor_output(block: Column) -> Column:
    """A string result as is, else the experimental text, else the result as JSON."""
    result = path(block, "$.result")
    alt = cursor_text(path(block, "$.experimental_content"))
    return (
        F.when(is_kind(result, "string"), F.try_variant_get(result, "$", "string"))
        .when(alt != "", alt)
        .otherwise(tool_output(result))
    )


def record_size(json: Column) -> Column:
    """Characters of compact JSON with non-ASCII escaped: a character of the basic
    plane takes six, one beyond it twelve."""
    astral = F.regexp_count(json, F.lit(r"[\x{10000}-\x{10FFFF}]"))
    wide = F.regexp_count(json, F.lit(r"[^\x00-\x7F]"))
    return (F.length(json) + 5 * (wide - astral) + 11 * astral).cast("long")


def command_text(tool_input_: Column) -> Column:
    """list commands joined by blanks, strings as they are, other objects as JSON."""
    cmd = path(tool_input_, "$.command")
    parts = F.transform(
        items(cmd), lambda c: F.when(is_kind(c, "string"), F.try_variant_get(c, "$", "string")).otherwise(F.to_json(c))
    )
    return (
        F.when(is_kind(cmd, "array"), F.array_join(parts, " "))
        .when(is_kind(cmd, "string"), F.try_variant_get(cmd, "$", "string"))
        .when(is_kind(tool_input_, "object"), F.to_json(tool_input_))
        .otherwise("")
    )


def response_text(resp: Column) -> Column:
    """the readable parts of a tool response, null when there is no response."""
    keys = ("stderr", "stdout", "output", "error", "text")
    parts = F.concat_ws("\n", *[F.nullif(text_at(resp, f"$.{k}"), F.lit("")) for k in keys])
    return (
        F.when(resp.isNull() | F.is_variant_null(resp), F.lit(None).cast("string"))
        .when((is_kind(resp, "object")) & (parts != ""), parts)
        .when(is_kind(resp, "string"), F.try_variant_get(resp, "$", "string"))
        .otherwise(F.to_json(resp))
    )


# The names a usage counter may carry, best first.
CURSOR_USAGE_NAMES = {
    "input_tokens": ("inputTokens", "input_tokens"),
    "output_tokens": ("outputTokens", "output_tokens"),
    "cache_read_input_tokens": ("cacheReadTokens", "cache_read_tokens", "cache_read_input_tokens"),
    "cache_creation_input_tokens": ("cacheWriteTokens", "cache_write_tokens", "cache_creation_input_tokens"),
}


def cursor_usage(message: Column) -> Column:
    """Usage struct of a message; one bad value voids all, none measured is null."""
    usage = path(message, "$.usage")
    raw = F.when(is_kind(usage, "object"), usage).otherwise(path(message, "$.tokenCount"))
    fields, bad, measured = [], F.lit(False), F.lit(False)
    for name, aliases in CURSOR_USAGE_NAMES.items():
        v = F.coalesce(*[path(raw, f"$.{a}") for a in aliases])
        absent = v.isNull() | F.is_variant_null(v)
        n = F.when(is_kind(v, "integer"), F.try_variant_get(v, "$", "bigint"))
        bad = bad | (~absent & (n.isNull() | (n < 0)))
        measured = measured | ~absent
        fields.append(F.coalesce(n, F.lit(0).cast("long")).alias(name))
    return F.when((is_kind(raw, "object")) & ~bad & measured, F.struct(*fields))


def overview_text(structured: Column, texts: Column) -> Column:
    """the digest from a structured reply, a JSON envelope or raw text."""
    def pick(v: Column) -> Column:
        overview = path(v, "$.overview")
        falsy = overview.isNull() | F.is_variant_null(overview) | (text_at(v, "$.overview") == "")
        return F.when(falsy, text_at(v, "$.text")).otherwise(text_at(v, "$.overview"))

    first = F.get(F.filter(texts, lambda t: t.isNotNull() & (t != "")), F.lit(0))
    envelope = F.try_parse_json(first)
    own = F.when(is_kind(structured, "object"), pick(structured))
    return (
        F.when(strip_ws(own) != "", own)
        .when(is_kind(envelope, "object"), F.coalesce(pick(envelope), F.lit("")))
        .otherwise(F.coalesce(first, F.lit("")))
    )
