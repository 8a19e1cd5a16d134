"""Conversation repair against the cheapest of all ways, found state by state."""

import hashlib
import random
import re
import zlib

import pytest

from agentlake.llm import conversation
from agentlake.llm.conversation import START, _piece, _Talk, repair, wagner_fischer

rng = random.Random(12)
WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        way = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        out += [(c, t, "user" if way == 4 else role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    return out


def brute(rows):
    out = []
    for c in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in damaged(rows) if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, fault = set(), []
        for _, role, text in mine:
            ink = text.strip(WHITE)
            fault.append("b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in mine if r[0] is not None]
        initials = [r[1][:1] for r in mine]
        step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
        ways = {"": (0, "", ())}

        def insert(ways):
            for _ in range(2):
                for p, (cost, audit, kept) in list(ways.items()):
                    new = "a" if p == "u" else "u"
                    way = (cost + 5, audit + "I", (*kept, ({"u": "user", "a": "assistant"}[new], "")))
                    ways[new] = min(ways.get(new, way), way)
            return ways

        for (_, role, text), f in zip(mine, fault, strict=True):
            new = {}
            for p, (cost, audit, kept) in insert(dict(ways)).items():
                todo = [(p, (cost + 2, audit + "D", kept))]
                if f not in ("b", "d"):
                    fee = 5 if f == "t" else 0
                    if (p, role[:1]) in step:
                        todo.append((role[:1], (cost + fee, audit + "K", (*kept, (role, text)))))
                    x = "a" if p == "u" else "u"
                    todo.append((x, (cost + fee + 1, audit + "R", (*kept, ({"u": "user", "a": "assistant"}[x], text)))))
                for q, way in todo:
                    new[q] = min(new.get(q, way), way)
            ways = new
        ends = insert(dict(ways))
        cost, audit, kept = min(w for p, w in ends.items() if p in ("", "a"))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append((c, gaps, fault.count("b"), fault.count("d"), fault.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [32, 3])
def test_against_every_way(spark, segment, monkeypatch):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "cut", " \t\n", "", None, "é. \r\n", "Yes.", "A. b", "w " * 3000 + "."]
    rows = [(c, t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"Text {rng.random()}.") for c in range(150) for t in rng.sample(range(20), rng.randint(1, 12))]
    rows += [(900, None, "user", "Yes."), (900, 1, "user", "Yes."), (900, 1, "user", "Yes."), (900, 1, "assistant", "No."), (None, 3, "user", "Hm."), (None, None, None, None)]
    rows += [(901, t, ("user", "assistant")[t % 2], "w.") for t in range(60)] + [(902, t, "x", f"{t}.") for t in range(40)]
    rows += [(903, 44, "user", "x."), *rows[:5]]
    df = spark.createDataFrame([(*r, "e", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, kind int")
    if segment != 32:  # tasks run in workers of their own: the stream is driven here
        monkeypatch.setattr(conversation, "SEGMENT", segment)
        assert drive(rows) == [x[:-1] for x in brute(rows)]
        return
    assert sorted((tuple(r) for r in repair(df).collect()), key=str) == brute(rows)
    assert repair(df.limit(0)).count() == 0


def drive(rows):
    out = []
    for c in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in damaged(rows) if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        talk, seen = _Talk(c), set()
        for turn, role, text in mine:
            ink = text.strip(WHITE)
            if (role, text) not in seen:
                talk.add(turn, role, text, 0, None)
            seen.add((role, text))
            talk.add(turn, role, text, 1, "b" if not ink else "." if ink[-1] in ".!?" else "t")
        out.append(talk.row())
    return sorted(out, key=str)


def test_bands_lose_nothing():
    for _ in range(300):
        n = rng.randint(0, 8)
        turns = "".join(rng.choice("sua-") + rng.choice("..tx") for _ in range(n))
        for q in (START, 3):
            for target in _piece(START, q, 9):
                full = wagner_fischer(turns, target, 10**6)
                if full is None:  # no row can be the target's s
                    assert "s" in target
                    continue
                for most in (full[0] - 1, full[0], full[0] + 3):
                    assert wagner_fischer(turns, target, most) == (full if most >= full[0] else None)


def test_a_very_long_conversation(spark):
    rows = spark.range(20_000).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id, '.') AS text")
    got = repair(rows).first()
    assert len(got.audit.replace("I", "")) == 20_000 - 1 * _dropped(20_000) + _repeated(20_000) and got.duplicate == _repeated(20_000)


def _way(k, n):
    return sum(zlib.crc32(f"7:{t}".encode()) % 20 == k for t in range(n))


def _dropped(n):
    return _way(0, n)


def _repeated(n):
    return _way(3, n)
