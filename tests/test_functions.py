"""Truth tables of the scalar rules."""

import uuid

import pytest
from pyspark.sql import functions as F

from agentlake.functions import commands as C
from agentlake.functions import globs as G
from agentlake.functions import ids as I
from agentlake.functions import text as T
from agentlake.functions import times as TM
from agentlake.functions import values as V
from agentlake.operators import directives as D

KEY = "mhk_" + "0123456789abcdefghij"


def each(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("x"))).collect()]


STRICT_YES = [
    "git commit -m x", "git -C /repo commit", "cd /x && git commit", "GIT_EDITOR=true git commit --amend", "env VAR=1 git commit",
    "nohup git commit", "timeout 60 git commit", "git -c a=b -c c=d -c e=f commit", "gh pr create", "gh pr merge 3",
    'MSG="a b" git commit',
]
STRICT_NO = ["ls -la", "git log --oneline | grep commit", "echo git commit", 'MSG="please git commit" ls', "git diff main commit", "git commit-tree", "gh pr list"]
AGENT_YES = ['bash -lc "git commit -m x"', "sh -c 'gh pr create -f'", "git --no-pager commit", "gh --repo o/r pr create", "sudo git commit", "x; " * 200 + "git commit", "gh pr comment 3"]
AGENT_NO = ["echo 'remember to git commit later'", "man git commit", "git push origin commit-branch", "git checkout commit", "gh pr list", "gh pr view", "gh pr checks", "gh pr diff"]


@pytest.mark.parametrize("mode,yes,no", [("strict", STRICT_YES, STRICT_NO), ("agent", AGENT_YES, AGENT_NO)])
def test_milestones(spark, mode, yes, no):
    assert each(spark, yes, lambda c: C.is_milestone(c, mode)) == [True] * len(yes)
    assert each(spark, no, lambda c: C.is_milestone(c, mode)) == [False] * len(no)


def test_mutating_commands(spark):
    yes = [
        "rm -rf x", "sudo -E rm x", "git push", "docker build .", "npm install left-pad", "pip --quiet install x", "gh pr create", "sed -i s/a/b/ f",
        "python x.py > out", "cat a | tee b", "python manage.py migrate", "FOO=1 /usr/bin/make", "if true; then rm x; fi", "timeout 60 make", "kubectl apply -f x", "a >> log",
    ]
    no = [
        "ls", "cat x 2>&1", "cat x > /dev/null", "git log", 'echo "git commit; rm x"', "gh pr view", "pip list", "sed s/a/b/ f", "grep rm x", "git -C /repo commit",
        "docker ps", "", "x 2>/dev/null", "env FOO=1",
    ]
    assert each(spark, yes, C.is_mutating) == [True] * len(yes)
    assert each(spark, no, C.is_mutating) == [False] * len(no)


def test_redaction(spark):
    texts = [f"key {KEY} end", f'"{KEY}"', f"{KEY} and {KEY}", "mhk_short", str(uuid.uuid4()), "x" + KEY]
    out = each(spark, texts, T.redact_text)
    assert out[0] == "key mhk_<redacted> end" and out[1] == '"mhk_<redacted>"' and out[2] == "mhk_<redacted> and mhk_<redacted>"
    assert out[3:] == texts[3:]
    for escape in ("\\n", "\\t", "\\r", "\\u2014", '\\"', "\\\\"):
        raw = '{"a":"x' + escape + KEY + '","' + KEY + '":1}'
        got = each(spark, [raw], T.redact_json)[0]
        assert KEY not in got, escape
        assert each(spark, [got], T.json_contains_secret) == [False]
        assert each(spark, [got], T.redact_json) == [got]


def test_command_wrappers(spark):
    yes = ["<command-name>/x</command-name>", " <command-name>/x</command-name>\n<command-args>a\nb</command-args>", "<local-command-stdout>x</local-command-stdout>"]
    no = ["say <command-name>/x</command-name>", "<command-name>/x</command-name> and more", "hello", "<command-name>/x"]
    f = lambda c: T.is_command_wrapper(F.lit("user"), c)
    assert each(spark, yes, f) == [True] * 3
    assert each(spark, no, f) == [False] * 4


def test_titles(spark):
    long = "word " * 30
    out = each(spark, ["hi  there", "<x", "<system-reminder>a</system-reminder> do it", long, "a" * 100, ""], T.title_text)
    assert out[:3] == ["hi there", None, "do it"]
    assert out[3] == ("word " * 15).strip() + "…" and out[4] == "a" * 79 + "…" and out[5] is None


def test_asks(spark):
    codex = each(
        spark,
        ["plain", "<environment_context>x</environment_context>\nreal", "# AGENTS.md instructions for a\n\n<INSTRUCTIONS>\nq\n</INSTRUCTIONS>\nreal", "# AGENTS.md instructions\nrest",
         "# Context from my IDE setup:\nf\n## My request for Codex:\n do it ", "# Context from my IDE setup:\nf", "<recommended_plugins>x</recommended_plugins>", ""],
        T.clean_codex_ask,
    )
    assert codex == ["plain", "real", "real", None, "do it", None, None, None]
    cursor = each(spark, ["<a>x</a><b c='1'>y</b> go", "<r>x</r><user_query>\n q \n</user_query>", "go <a>x</a>", "<a>x</a>"], T.clean_cursor_ask)
    assert cursor == ["go", "q", "go <a>x</a>", None]


def test_names(spark):
    rooms = each(spark, ["git@h:o/N.git", "https://h/o/n.git", "ssh://git@h:22/a/b/o/n", "h:n", "", "https://h/o/n/"], I.room_name)
    assert rooms == ["Repo: o/N", "Repo: o/n", "Repo: o/n", "Repo: n", None, "Repo: o/n"]
    assert each(spark, ["a", "é"], I.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_URL, x)) for x in ("a", "é")]
    hosts = each(spark, ["/h/rollout-x.jsonl", "/h/.cursor/a", "/a/.codex/b", "/h/.claude/x.jsonl", "/x/store.db", "latest", "abc", "/x/y.jsonl"], I.sniff_host)
    assert hosts == ["codex", "cursor", "codex", "claude", "cursor", None, None, "claude"]


def test_times(spark):
    out = each(spark, ["2024-01-02T03:04:05Z", "2024-01-02T04:04:05+01:00", "2024-01-02T02:04:05.5-0100", "2024-01-02T03:04:05", "soon", "2024-01-02"], TM.parse_utc)
    base = 1704164645.0
    assert out == [base, base, base + 0.5, base, None, 1704153600.0]
    assert each(spark, ["89", "90", "5399", "5400", "-5"], lambda c: TM.ago(c.cast("long"))) == ["89s ago", "1m ago", "89m ago", "1h ago", "0s ago"]
    assert each(spark, ["7199", "7200"], lambda c: TM.ago(c.cast("long"), "health")) == ["119m ago", "2h ago"]


def test_globs(spark):
    cases = [
        ("app/*.py", "app/a.py", True), ("app/*.py", "app/x/a.py", False), ("app/**/*.py", "app/a.py", True), ("app/**/*.py", "app/x/y/a.py", True),
        ("a/{x,y}/{p,q}.py", "a/y/q.py", True), ("a/{x,y}.py", "a/z.py", False), ("x.md|docs/**", "docs/a/b", True), ("retry.py", "app/retry.py", False),
        ("a/ma?n.py", "a/main.py", True), ("a/ma?n.py", "a/ma/n.py", False), ("**/README.md", "README.md", True), ("a+b.(c)", "a+b.(c)", True),
    ]
    rows = spark.createDataFrame([(i, g, p) for i, (g, p, _) in enumerate(cases)], "i int, g string, p string")
    got = rows.withColumn("re", G.compile_glob("g")).orderBy("i").select(G.glob_match(F.col("p"), F.col("re"))).collect()
    assert [r[0] for r in got] == [c[2] for c in cases]
    assert G.glob_keys("app/**/*.py|a/?/c") == [("2+,1=,-1.", "app/py"), ("3,1=,3=", "a/c")]


def test_token_rules(spark):
    assert set(each(spark, ["App/Net/backoff.py"], D.trigger_tokens)[0]) == {"app/net/backoff.py", "backoff.py", "backoff"}
    hay = each(spark, ["the part number", "particular", "a-part", "xpart", "part2"], lambda c: D.token_hit(F.lit("part"), c))
    assert hay == [True, False, True, False, False]


def test_record_size(spark):
    import json

    texts = ["plain", "é — ü", "😀 and é", ""]
    assert each(spark, texts, lambda c: V.record_size(c) + 2) == [len(json.dumps(t)) for t in texts]


def test_tool_values(spark):
    out = each(
        spark,
        ['{"arguments":"{\\"a\\":1}"}', '{"arguments":"[1]"}', '{"arguments":"x y"}', '{"input":{"b":2}}', "{}", '{"arguments":null,"input":"raw"}'],
        lambda c: F.to_json(V.tool_input(F.parse_json(c))),
    )
    assert out == ['{"a":1}', '{"input":[1]}', '{"input":"x y"}', '{"b":2}', "{}", '{"input":"raw"}']
    usage = each(spark, ['{"usage":{"inputTokens":3}}', '{"usage":{"inputTokens":true}}', '{"usage":{"inputTokens":3.5}}', '{"x":1}'], lambda c: V.cursor_usage(F.parse_json(c))["input_tokens"])
    assert usage == [3, None, None, None]


def test_redaction_behind_any_escapes(spark):
    texts = []
    for n in range(61):
        for tail in ("", "n", "u2014", '"', "u006dhk_" if n % 2 else ""):
            if n % 2 or tail != '"':
                texts.append('{"a":{"' + "\\" * n + (tail if n % 2 else "") + ("" if n % 2 and tail else " ") + KEY + '":[1]}}')
    texts += ['{"a":"' + KEY.replace("_", "\\u005f") + '"}', '{"a":"' + KEY[:9] + "\\u0061" + KEY[9:] + '"}']
    import json

    def valid(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False

    texts = [t for t in texts if valid(t)]
    assert len(texts) > 100
    got = each(spark, texts, T.redact_json)
    for before, after in zip(texts, got):
        assert KEY not in str(json.loads(after)) and KEY[4:] not in after, before
    assert each(spark, texts, T.json_contains_secret) == [True] * len(texts)
    assert each(spark, got, T.json_contains_secret) == [False] * len(texts)


def test_no_cut_hides_a_match(spark):
    assert each(spark, ["echo " + "x" * 20_000 + " && git commit"], lambda c: C.is_milestone(c, "agent")) == [True]
    assert each(spark, ["Traceback (most recent call last)\n" + "log\n" * 5000], C.error_gate) == [True]
    assert each(spark, ["true " * 3000 + "; rm x"], C.is_mutating) == [True]


def test_failure_behind_many_newer_rows(spark):
    from agentlake.operators import health as H

    rows = [("s0", "turn", 1000, None, "timeout", 1000)] + [(f"s{i}", "turn", 2000 + i, 2000 + i, None, None) for i in range(1, 60)]
    state = spark.createDataFrame(rows, "session_id string, capture_path string, at long, last_ok_at long, last_error string, last_error_at long")
    assert [r.session_id for r in H.recent_failure(state, 3000).collect()] == ["s0"]


def test_candidates_keep_every_match_and_little_else(spark):
    import random
    import re

    from agentlake.operators import artifacts as A

    rnd = random.Random(3)
    names = ["a", "b", "src", "x.py", "y.md", "a.b", ".env", "", "a,b=", "1"]
    signs = ["*", "**", "?", "*.py", "a*", "**.py", "a**", "x?py", "*.*"]
    paths = sorted({"/".join(rnd.choice(names) for _ in range(rnd.randint(1, 5))) for _ in range(250)})
    globs = sorted({"/".join(rnd.choice(names + signs) for _ in range(rnd.randint(1, 4))) for _ in range(250)})
    globs += ["**", "**/src/**", "**/*", "{a,b}/*.py|**/y.md", "src/**/a/**/x.py", "|", "a,{b,**}/1"]
    edits = spark.createDataFrame([(r, p) for r in ("r1", "r2") for p in paths], "repo string, rel_path string")
    links = spark.createDataFrame([("r1" if i % 4 else "r2", g, f"l{i}", "s") for i, g in enumerate(globs)], "repo string, glob string, artifact_id string, brain_id string")
    want = set()
    for i, g in enumerate(globs):
        pattern = G.glob_regex(g)
        want |= {("r1" if i % 4 else "r2", p, f"l{i}") for p in paths if pattern and re.search(pattern.replace(r"\z", r"\Z"), p)}
    got = A.governing_artifacts(edits, links).select("repo", "rel_path", "artifact_id").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    # where every segment is literal, an extension or a whole ``**``, the join gives matches alone;
    # a text between two ``**`` may stand last, too
    whole = spark.createDataFrame([("r1", g, g, "s") for g in ("a/b", "**/a/x.py", "src/**/*.py", "**/src/**", "**")], links.schema)
    lost = A.candidates(edits, A.compiled_links(whole)).filter(~F.rlike("rel_path", "regex")).distinct().collect()
    assert all(r.glob == "**/src/**" and r.rel_path.endswith("src") for r in lost)
