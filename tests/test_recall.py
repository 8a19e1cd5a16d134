"""The cut candidate join of recall against a brute-force ranking."""

import random
import re

from agentlake.operators import directives as D

WORDS = ["retry", "backoff", "entities", "alpha", "gamma", "delta", "serve", "queue"]


def tokens(trigger):
    t = trigger.strip().lower().replace("\\", "/")
    out = {t} if t else set()
    if "/" in t or "." in t:
        base = t.rsplit("/", 1)[-1]
        out |= {base, base.rsplit(".", 1)[0] if "." in base else base}
    out |= {w for w in re.split(r"[^a-z0-9_]+", t) if len(w) >= 5}
    return {w for w in out if len(w) >= 4}


def test_recall_equals_brute_force(spark):
    rnd = random.Random(5)
    dirs = []
    for i in range(120):
        trg = [rnd.choice(["app/{}.py", "{}", "x/{}/y.md", "(((( {}"]).format(rnd.choice(WORDS)) for _ in range(rnd.choice([0, 1, 2, 2]))]
        dirs.append((i, rnd.choice(["repo1", "repo2", None]), rnd.randrange(4), i, trg, rnd.choice([None, "s1", "s2"])))
    calls = []
    for i in range(80):
        hay = rnd.choice(["/w/app/{}.py", "run {} now", "((((( {}", ""]).format(rnd.choice(WORDS))
        calls.append((i, f"s{rnd.randrange(4)}", rnd.choice(["repo1", "repo2", None]), hay))
    fired = [(f"s{rnd.randrange(4)}", rnd.randrange(120)) for _ in range(60)]
    got = D.recall(
        spark.createDataFrame(calls, "call_id int, session_id string, repo string, hay string"),
        spark.createDataFrame(dirs, "id int, repo string, seen int, pos int, triggers array<string>, source_session_id string"),
        spark.createDataFrame(fired, "session_id string, directive_id int"),
    )
    got = {(r.call_id, r["rank"]): r.id for r in got.collect()}
    want = {}
    for cid, sid, repo, hay in calls:
        cand = []
        for i, drepo, seen, pos, trg, src in dirs:
            if (drepo and drepo != repo) or src == sid or (sid, i) in fired:
                continue
            if not trg or not hay:
                cand.append((0, -seen, pos, i))
                continue
            blocked = set(D.GENERIC_TOKENS) | {repo}
            hits = [
                len(t) for x in trg for t in tokens(x)
                if t not in blocked and re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", hay)
            ]
            if hits:
                cand.append((-max(hits), -seen, pos, i))
        for k, c in enumerate(sorted(cand)[:2], 1):
            want[(cid, k)] = c[3]
    assert got == want
