"""Time parsing and rendering. Everything is UTC and expressed in epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agentlake.functions import values as V


def parse_utc(raw: Column) -> Column:
    """epoch seconds (double) of an ISO text: ``Z``, ``+HH:MM``, ``+HHMM``, fractions or
    no zone (read as UTC); null when unreadable. Works in any session time zone."""
    t = F.regexp_replace(F.trim(raw), r"[Zz]$", "+00:00")
    t = F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2")
    t = F.when(t.rlike(r"[+-]\d{2}:\d{2}$"), t).when(
        t.rlike(r"\d{2}:\d{2}"), F.concat(t, F.lit("+00:00"))
    ).otherwise(F.concat(t, F.lit("T00:00:00+00:00")))
    ok = t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?[+-]\d{2}:\d{2}$")
    return F.when(ok, F.unix_micros(F.try_to_timestamp(t)) / F.lit(1_000_000.0))


def iso_millis(ms: Column) -> Column:
    """ISO-8601 UTC text with milliseconds, without going through the session zone."""
    days = F.floor(ms / 86_400_000)
    rem = ms - days * 86_400_000
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")), "yyyy-MM-dd")
    return F.when(
        ms.isNotNull(),
        F.format_string(
            "%sT%02d:%02d:%02d.%03dZ",
            day,
            F.floor(rem / 3_600_000),
            F.floor(rem % 3_600_000 / 60_000),
            F.floor(rem % 60_000 / 1000),
            (rem % 1000).cast("long"),
        ),
    )


def jwt_exp(token: Column) -> Column:
    """the ``exp`` claim of a token, null when it cannot be decoded."""
    body = F.translate(F.get(F.split(token, r"\."), F.lit(1)), "-_", "+/")
    pad = F.repeat(F.lit("="), ((4 - F.length(body) % 4) % 4).cast("int"))
    claims = F.try_parse_json(F.decode(F.try_to_binary(F.concat(body, pad), F.lit("base64")), "UTF-8"))
    exp = V.path(claims, "$.exp")
    return F.when(
        (V.is_kind(claims, "object")) & ~V.is_kind(exp, "null"), F.try_variant_get(claims, "$.exp", "double")
    )


def ago(seconds: Column, style: str = "board") -> Column:
    """``board`` counts seconds, minutes, hours; ``health`` only minutes and hours."""
    s = F.greatest(F.lit(0).cast("long"), seconds.cast("long"))
    if style == "board":
        return (
            F.when(s < 90, F.concat(s.cast("string"), F.lit("s ago")))
            .when(s < 5400, F.concat(F.floor(s / 60).cast("string"), F.lit("m ago")))
            .otherwise(F.concat(F.floor(s / 3600).cast("string"), F.lit("h ago")))
        )
    m = F.floor(s / 60)
    return F.when(m < 120, F.concat(m.cast("string"), F.lit("m ago"))).otherwise(
        F.concat(F.floor(m / 60).cast("string"), F.lit("h ago"))
    )
