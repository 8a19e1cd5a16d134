"""Identifiers, names and handles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agentlake.functions.text import strip_ws

# Fixed value: the RFC 4122 URL namespace.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
UUID_SHAPE = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Name-based UUID of a string, from the JVM's SHA-1."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("long").bitwiseAND(63).bitwiseOR(128)))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-5"),
        F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 19, 2), F.lit("-"),
        F.substring(h, 21, 12),
    )


def conversation_id(host: Column, session_id: Column, override: Column | None = None) -> Column:
    """``<host>-<session>``; the native host keeps the bare id."""
    own = F.when(host == "claude", session_id).otherwise(F.concat(host, F.lit("-"), session_id))
    return own if override is None else F.coalesce(override, own)


def sniff_host(path: Column) -> Column:
    """The host a path belongs to, null when its shape does not say."""
    name = F.substring_index(path, "/", -1)
    return (
        F.when(path.isNull() | (path == "") | (path == "latest"), F.lit(None).cast("string"))
        .when(name.startswith("rollout-") & name.endswith(".jsonl"), "codex")
        .when((name == "store.db") | path.rlike(r"(?:^|/)\.cursor(?:/|$)"), "cursor")
        .when(path.rlike(r"(?:^|/)\.codex(?:/|$)"), "codex")
        .when(path.rlike(r"(?:^|/)\.claude(?:/|$)"), "claude")
        .when(name.endswith(".jsonl"), "claude")
    )


def rollout_session(path: Column) -> Column:
    """Trailing UUID of a rollout file name, else its stem."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.jsonl$", "")
    hit = F.regexp_extract(stem, rf"-({UUID_SHAPE})$", 1)
    return F.when(hit != "", hit).otherwise(stem)


def flat_id(col: Column) -> Column:
    """An id in the characters of file names, at full length: this one serves as identity."""
    return F.regexp_replace(col, r"[^A-Za-z0-9._-]", "_")


def safe_id(col: Column, mode: str = "state") -> Column:
    """F16, for file names alone: ``state`` flattens to 80 characters, ``debounce`` to 64,
    ``fired`` deletes. Two ids may share a file name, so keys use ``flat_id``."""
    if mode == "fired":
        return F.regexp_replace(col, r"[^A-Za-z0-9_-]+", "")
    # a character becomes one character, so those that stay are cut out before they are flattened
    return flat_id(F.left(col, F.lit({"state": 80, "debounce": 64}[mode])))


def cursor_session_id(session_id: Column, conversation: Column, transcript: Column) -> Column:
    """the payload's id, else a UUID-shaped parent folder or stem, else null."""
    given = F.coalesce(F.nullif(session_id, F.lit("")), conversation)
    parts = F.split(transcript, "/")
    parent = F.element_at(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(1)), 1)
    stem = F.regexp_replace(F.element_at(parts, -1), r"(?<=.)\.[^.]*$", "")
    return (
        F.when(strip_ws(given) != "", strip_ws(given))
        .when((F.size(parts) > 1) & parent.rlike(rf"\A{UUID_SHAPE}\z"), parent)
        .when(stem.rlike(rf"\A{UUID_SHAPE}\z"), stem)
    )


def is_uuid(col: Column) -> Column:
    return F.coalesce(col.rlike(rf"\A{UUID_SHAPE}\z"), F.lit(False))


def room_name(remote: Column) -> Column:
    """last two path segments of a remote, letter case kept; null when empty."""
    base = F.regexp_replace(F.regexp_replace(strip_ws(remote), r"/+$", ""), r"\.git$", "")
    path = F.when(base.contains(":") & ~base.contains("//"), F.substring_index(base, ":", -1)).otherwise(base)
    segs = F.filter(F.split(path, "/"), lambda s: s != "")
    tail = F.slice(segs, F.greatest(F.size(segs) - 1, F.lit(1)), F.lit(2))
    return F.when(F.size(segs) > 0, F.concat(F.lit("Repo: "), F.array_join(tail, "/")))


def room_name_local(common_dir: Column) -> Column:
    """repo folder name from a common git folder."""
    d = F.regexp_replace(F.regexp_replace(common_dir, r"/+$", ""), r"/\.git$", "")
    return F.concat(F.lit("Repo: "), F.regexp_replace(F.element_at(F.split(d, "/"), -1), r"\.git$", ""))


def namespace(remote: Column) -> Column:
    """base name of a remote, null when unknown."""
    base = F.substring_index(F.regexp_replace(strip_ws(remote), r"/+$", ""), "/", -1)
    return F.nullif(F.regexp_replace(base, r"\.git$", ""), F.lit(""))


def env_for_url(url: Column) -> Column:
    """F22."""
    return F.when(F.lower(url).contains("staging"), "staging").otherwise("production")


def edited_path(file_path: Column, notebook_path: Column, cwd: Column) -> Column:
    """the first given path, made absolute with the event's folder."""
    p = F.coalesce(F.nullif(file_path, F.lit("")), F.nullif(notebook_path, F.lit("")))
    return F.when(p.startswith("/"), p).when(
        cwd != "", F.concat(F.regexp_replace(cwd, r"/+$", ""), F.lit("/"), p)
    )


def cwd_ok(cwd: Column) -> Column:
    """F32: an absolute path that cannot be read as an option."""
    return F.coalesce(cwd.rlike(r"\A(?:/|[A-Za-z]:[\\/])"), F.lit(False))


def handle_key(tool: Column, handle: Column, cwd: Column) -> Column:
    """readable head plus digest of the whole normalized handle; null without one."""
    norm = strip_ws(F.regexp_replace(handle, r"(?U)\s+", " "))
    digest = F.substring(F.sha2(norm, 256), 1, 16)
    return F.when(
        handle != "",
        F.concat_ws(":", F.coalesce(cwd, F.lit("")), tool, F.left(norm, F.lit(120)), digest),
    )


def handle_of(file_path: Column, notebook_path: Column, command: Column) -> Column:
    """the identifying argument of a tool call, first one present."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (file_path, notebook_path, command)])


def handle_args(args: Column, limit: int | None = None) -> Column:
    """F17 on MAP<STRING,STRING> inputs: identifying keys only, else every value, cut to
    ``limit`` characters where one is given."""
    names = ("file_path", "notebook_path", "command")
    ids = F.map_filter(args, lambda k, v: k.isin(*names) & (v != ""))
    return F.when(F.size(ids) > 0, ids).otherwise(args if limit is None else F.transform_values(args, lambda k, v: F.left(v, F.lit(limit))))


# Hook events only one host sends.
CURSOR_EVENTS = (
    "aftermcpexecution", "afterfileedit", "aftershellexecution",
    "beforemcpexecution", "beforeshellexecution", "beforesubmitprompt",
    "pretooluse", "posttooluse", "stop",
)


def _given(c: Column) -> Column:
    return F.coalesce(strip_ws(c) != "", F.lit(False))


def is_cursor_event(
    event: Column,
    version: Column,
    transcript: Column,
    conversation: Column,
    generation: Column,
    has_roots: Column,
    env_marker: Column | None = None,
) -> Column:
    """a version marker, a store path, or a known event with two identity marks."""
    marks = _given(conversation).cast("int") + _given(generation).cast("int") + F.coalesce(has_roots, F.lit(False)).cast("int")
    hit = (
        _given(version)
        | F.coalesce(F.replace(transcript, F.lit("\\"), F.lit("/")).contains("/.cursor/"), F.lit(False))
        | (F.coalesce(F.lower(strip_ws(event)).isin(*CURSOR_EVENTS), F.lit(False)) & (marks >= 2))
    )
    return hit if env_marker is None else hit | F.coalesce(env_marker, F.lit(False))


def boundary(event: Column) -> Column:
    """both ends of a turn mean ``stop``; other events are not captured."""
    return F.when(F.lower(event).isin("stop", "sessionend"), "stop")
