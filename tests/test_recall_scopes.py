"""Exclusions count only in the scopes that a session asks in."""

from agentlake.operators import directives as D

DIRECTIVES = "id int, repo string, seen int, pos int, triggers array<string>, source_session_id string"


def test_exclusions_of_other_scopes_are_not_expanded(spark, monkeypatch):
    kept = {}
    write = D.materialize

    def keep(df, name="step"):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(D, "materialize", keep)
    dirs = [(i, repo, 10 - i, i, ["retry"], None) for i, repo in enumerate(["repo1"] * 4 + ["repo2"] * 4 + [None])]
    dirs.append((0, "repo2", 1, 9, ["retry"], None))  # an id may stand in two scopes
    calls = [(1, "s1", "repo1", "run retry now"), (2, "s2", "repo2", "run retry now"), (3, None, "repo1", "run retry now"), (4, "s3", None, "")]
    fired = [("s1", i) for i in (0, 1, 4, 5, 6)] + [("s2", 0), ("s2", 0), (None, 0), ("s3", 8), ("s3", 4)]
    got = D.recall(
        spark.createDataFrame(calls, "call_id int, session_id string, repo string, hay string"),
        spark.createDataFrame(dirs, DIRECTIVES),
        spark.createDataFrame(fired, "session_id string, directive_id int"),
    )
    assert sorted((r.call_id, r["rank"], r.id) for r in got.collect()) == [(1, 1, 2), (1, 2, 3), (2, 1, 4), (2, 2, 5), (3, 1, 0), (3, 2, 1)]
    found = {(r.session_id, r.id, r.scope) for r in kept["excluded"].collect()}
    assert found == {("s1", 0, "repo1"), ("s1", 1, "repo1"), ("s2", 0, "repo2"), ("s3", 8, "")}
