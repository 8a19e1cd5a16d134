"""Repair of conversations: turns are aligned with every feasible length of the alternating
grammar string ``s?(ua)+`` (or nothing) by Wagner and Fischer's table.

The incumbent, the cheapest cost so far, leaves out lengths that cannot beat it and cuts each
table to Ukkonen's band of diagonals; of equal costs the backtraced audits decide. A conversation
is a sorted stream of narrow rows (role initial and fault, no text) and at most ``SEGMENT`` rows
are in a table. A longer one is cut into segments: each is aligned with the grammar's pieces
between any two places of it, and the pieces are added up. At equal cost no audit of a segment is
the beginning of another, so the least audit of the whole is made of the least audits of segments.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.session import materialize

SEGMENT = 32
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = 1 << 60
#: Places in the grammar: nothing yet, behind s, behind u, behind a.
START, SYSTEM, USER, REPLY = range(4)
NAMES = {"u": "user", "a": "assistant"}
BLANK, CUT = "[^\\x20\\x09-\\x0D]", "[.!?][\\x20\\x09-\\x0D]*$"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with every twentieth row dropped, emptied, stripped of its
    sentence ends, repeated or given to the user, by the CRC of ``conv_id:turn``. Nulls in it, in
    role and in text are one space."""
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(s("conv_id"), F.lit(":"), s("turn")).cast("binary")) % 20
    text = F.when(F.col("way") == 1, F.lit("")).when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), s("role").alias("role"), s("text").alias("text"), way.alias("way")).filter("way <> 0")
    rows = rows.select("conv_id", "turn", F.when(F.col("way") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("way") == 3, 2).otherwise(1))).alias("once"))
    return rows.drop("once")


def _key() -> Column:
    return F.md5(F.col("text").cast("binary"))


def _sorted(rows: DataFrame, kind: str = "kind") -> DataFrame:
    """Conversations whole in a partition, turns in order; rows of one turn by role and digest."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "key", kind)


def _piece(p: int, q: int, most: int) -> list[str]:
    """The grammar strings of at most ``most`` letters that lead from place p to place q."""
    if q in (START, SYSTEM):
        return [""] if p == q else ["s"] if p == START else []
    out, turns = [""] if p == q else [], "au" if p == USER else "ua"
    walk = turns * (most // 2 + 1)
    for head in ("", "s") if p == START else ("",):
        out += [head + walk[:k] for k in range(1, most + 1 - len(head)) if walk[k - 1] == ("u" if q == USER else "a")]
    return out


def _bound(n: int, m: int) -> int:
    """No alignment of n rows with m letters is cheaper."""
    return DELETE * (n - m) if n > m else INSERT * (m - n)


def wagner_fischer(turns: str, target: str, most: int) -> tuple[int, str] | None:
    """The cheapest cost and its least audit of aligning ``turns`` (two letters a row: role
    initial, and . for sound, t for truncated, x for one that must go) with ``target``; None
    beyond ``most``. Only diagonals that can stay within ``most`` are computed."""
    n, m = len(turns) // 2, len(target)
    shift = m - n
    within = [k for k in range(-n, m + 1) if _bound(max(0, -k), max(0, k)) + _bound(max(0, k - shift), max(0, shift - k)) <= most]
    if not within or within[0] > 0 or within[-1] < 0:
        return None
    low, high = within[0], within[-1]
    table: list[dict[int, int]] = [{} for _ in range(n + 1)]  # cost of the rest from row i and letter j
    for i in range(n, -1, -1):
        row, below = table[i], table[i + 1] if i < n else {}
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = 0 if i == n and j == m else FAR
            if j < m and target[j] != "s":
                best = min(best, row.get(j + 1, FAR) + INSERT)
            if i < n:
                best = min(best, below.get(j, FAR) + DELETE)
                if j < m:
                    best = min(best, below.get(j + 1, FAR) + _match(turns[2 * i], turns[2 * i + 1], target[j]))
            row[j] = best
    cost = table[0][0]
    if cost > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:  # the least letter first: Delete, Insert, Keep, Rerole
        now = table[i][j]
        if i < n and table[i + 1].get(j, FAR) + DELETE == now:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and table[i].get(j + 1, FAR) + INSERT == now:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[2 * i] == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def _match(initial: str, fault: str, letter: str) -> int:
    if fault == "x":
        return FAR
    extra = TRUNCATED if fault == "t" else 0
    return KEEP + extra if initial == letter else FAR if letter == "s" else REROLE + extra


@lru_cache(maxsize=20_000)
def align(turns: str, p: int, q: int) -> tuple[int, str] | None:
    """The cheapest way of ``turns`` from place p to place q, of equal ones the least audit."""
    n = len(turns) // 2
    most = DELETE * n + INSERT * 3  # all deleted, and at most three turns inserted
    targets = sorted(_piece(p, q, n + most // INSERT), key=lambda t: (abs(len(t) - n), t))
    limit = DELETE
    while True:  # a narrow band first; wider only if nothing lies in it
        best = None
        for target in targets:
            least = best[0] if best else limit
            if _bound(n, len(target)) <= least and (got := wagner_fischer(turns, target, least)) and (best is None or got < best):
                best = got
        if best or limit >= most:
            return best
        limit *= 3


def _states(ways: dict, turns: str, ends: tuple) -> dict:
    """Place to (cost, audit) behind one more segment."""
    out: dict[int, tuple[int, str]] = {}
    for p, (cost, audit) in ways.items():
        for q in ends:
            if (got := align(turns, p, q)) is not None:
                way = (cost + got[0], audit + got[1])
                out[q] = min(out.get(q, way), way)
    return out


class _Talk:
    """One conversation of the stream."""

    def __init__(self, conv_id):
        self.conv_id, self.first, self.last, self.distinct = conv_id, None, None, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before, self.turns, self.done, self.base = None, [], [], 0
        self.ways = {START: (0, "")}
        self.new = None

    def add(self, turn, role, key, kind, fault) -> None:
        if kind < 0:
            return
        if kind == 0:
            self.new = (turn, role, key)
            return
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.last:
                self.last, self.distinct = turn, self.distinct + 1
        fresh = self.new == (turn, role, key)
        self.new = None if fresh else self.new
        state = "x" if fault == "b" or not fresh else fault
        self.blank += fault == "b"
        self.duplicate += fault != "b" and not fresh
        self.truncated += state == "t"
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.turns.append((initial if initial in ("s", "u", "a") else "-") + state)
        if len(self.turns) > SEGMENT:
            self.segment()

    def segment(self) -> None:
        turns, self.turns = "".join(self.turns[:SEGMENT]), self.turns[SEGMENT:]
        ways = _states(self.ways, turns, (START, SYSTEM, USER, REPLY))
        costs = {p: c for p, (c, _) in ways.items()}
        reply, user = costs.get(REPLY, FAR), costs.get(USER, FAR)
        # a place that another one, moved on by at most one deletion or insertion, always beats
        beaten = {START: min(reply + DELETE, user + DELETE + INSERT), SYSTEM: min(reply, user + INSERT), USER: reply + INSERT, REPLY: user + INSERT}
        ways = {p: w for p, w in ways.items() if w[0] <= beaten[p]}
        same = os.path.commonprefix([a for _, a in ways.values()])
        self.done.append(same)
        self.ways = {p: (c, a[len(same) :]) for p, (c, a) in ways.items()}

    def row(self) -> tuple:
        ends = _states(self.ways, "".join(self.turns), (START, REPLY))
        cost, audit = min(ends.values())
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.done) + audit


AUDITS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPAIRED = "conv_id long, place long, edit string, role string, text string"


def _batch(rows: list, schema: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(schema)], [n for n, _ in schema])


_AUDIT_TYPES = [(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in AUDITS.split(", ")]
_REPAIRED_TYPES = [(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in REPAIRED.split(", ")]


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    talk, out = None, []
    for b in batches:
        for conv_id, *rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if talk is None or talk.conv_id != conv_id:
                if talk is not None:
                    out.append(talk.row())
                talk = _Talk(conv_id)
            talk.add(*rest)
        if len(out) >= 1000:
            yield _batch(out, _AUDIT_TYPES)
            out = []
    if talk is not None:
        out.append(talk.row())
    yield _batch(out, _AUDIT_TYPES)


def audits(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Faults, cost and audit of each conversation of ``ids``; ``rows`` as ``damage`` gives them."""
    narrow = rows.select("conv_id", "turn", "role", _key().alias("key"), F.lit(1).alias("kind"), F.when(~F.col("text").rlike(BLANK), "b").when(F.col("text").rlike(CUT), ".").otherwise("t").alias("fault"))
    firsts = narrow.groupBy("conv_id", "role", "key").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("m"))
    firsts = firsts.select("conv_id", F.col("m.turn").alias("turn"), "role", "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("fault"))
    heads = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("key"), F.lit(-1).alias("kind"), F.lit(None).cast("string").alias("fault"))
    return _sorted(narrow.unionByName(firsts).unionByName(heads)).mapInArrow(_aligned, AUDITS)


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies audits to the rows behind them; the audit comes first in its conversation."""
    state = {"audit": "", "at": 0, "place": 0, "after": "", "conv": None}

    def inserts():
        while state["at"] < len(state["audit"]) and state["audit"][state["at"]] == "I":
            yield put("I", None, "")

    def put(edit, role, text):
        state["at"] += 1
        if edit == "D":
            return None
        if edit != "K":
            role = NAMES["a" if state["after"] == "u" else "u"]
        state["after"] = role[:1]
        state["place"] += 1
        return state["conv"], state["place"], edit, role, text

    for b in batches:
        out = []
        for conv_id, _turn, role, _key_, kind, text, audit in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if kind == 0:
                state.update(audit=audit, at=0, place=0, after="", conv=conv_id)
                out += inserts()
                continue
            row = put(state["audit"][state["at"]], role, text)
            out += [] if row is None else [row]
            out += inserts()
        yield _batch(out, _REPAIRED_TYPES)


def repaired(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) of the repaired conversations; edit is K, R or I.
    Rows of a conversation stay together in a partition, in order."""
    none = F.lit(None).cast("string")
    rows = rows.select("conv_id", "turn", "role", _key().alias("key"), F.lit(1).alias("kind"), "text", none.alias("audit"))
    heads = audit.select("conv_id", F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("key"), F.lit(0).alias("kind"), none.alias("text"), "audit")
    return rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", F.expr("kind > 0"), F.col("turn").asc_nulls_first(), "role", "key").mapInArrow(_rebuilt, REPAIRED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("conv_id", pa.int64()), ("repaired_sha256", pa.string())]
    now, digest = None, None
    for b in batches:
        out = []
        for conv_id, place, _edit, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if place == 1:
                if digest is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = conv_id, sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        yield _batch(out, kinds)
    yield _batch([] if digest is None else [(now, digest.hexdigest())], kinds)


def digests(fixed: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of what ``repaired`` gives: ``role:text``, newline-joined."""
    return fixed.mapInArrow(_hashed, "conv_id long, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every
    conversation, after ``damage``.

    Rows of one turn are taken by role and then by the digest of their text, so equal rows stand
    beside each other. Null conv_ids are one conversation. Roles count by their first character;
    one that is empty or has another initial can only be rerolled or deleted. One digest covers a
    whole conversation, so each is one stream; its rows never are in memory together. Further
    columns are ignored; an empty table gives no rows."""
    rows = damage(conversations)
    found = materialize(audits(rows, conversations), "audits")
    hashes = digests(repaired(rows, found)).withColumnRenamed("conv_id", "id")
    out = found.join(hashes, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    return out.select(*found.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
