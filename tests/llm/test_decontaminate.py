"""Decontamination against a scan of every text for every window."""

import hashlib
import random
import re

from agentlake.llm.decontaminate import decontaminate

rng = random.Random(11)


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(docs, items, size):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            if not v:
                continue
            wins = {tuple(v[k : k + size]) for k in range(max(1, len(v) - size + 1))}
            for n in {len(x) for x in wins}:
                for s in range(len(w) - n + 1):
                    if tuple(w[s : s + n]) in wins:
                        hit.update(range(s, s + n))
                        found |= set() if item is None else {item}
        ids = ",".join(sorted(map(str, found)))
        out.append((-1 if i is None else i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def test_against_brute_force(spark):
    vocab = ["the", "of", "And", "É", "é", "Été", "x1", "9", "日本", "to"] + [f"w{i}" for i in range(30)]
    sep = [" ", ", ", "\n", "\t\t", "_", "\x7f", ". "]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice(sep) for _ in range(n))
    items = [(k, text(rng.choice([1, 3, 9, 10, 11, 30]))) for k in range(25)] + [(100, ""), (101, None), (None, text(12)), (102, "the the the the the the the the the the the the"), (102, "the the the the the the the the the the the the"), (7, text(12))]
    docs = [(0, None), (1, ""), (2, "..."), (None, text(40)), (3, "the " * 300), (4, "a" * 50_000)]
    for k in range(60):
        t = text(rng.randint(1, 120))
        for _ in range(rng.randint(0, 3)):
            v = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(v) - 5))
            t += " " + " ".join(v[a : a + rng.randint(5, 30)]).upper() + " " + text(5)
        docs.append((k + 10, t))
    docs += [docs[-1], (999, docs[-1][1])]
    d = spark.createDataFrame([(*x, "q") for x in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, h int")
    for size in (10, 3):
        got = decontaminate(d, b, size).na.fill(-1, ["doc_id"]).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == brute(docs, items, size)
    assert {r.n_hit for r in decontaminate(d, b.limit(0)).collect()} == {0}
    assert decontaminate(d.limit(0), b).count() == 0


def test_proximity(spark):
    d = spark.createDataFrame([(1, "alpha beta gap gap gamma delta"), (2, "alpha beta gamma delta")], "doc_id long, text string")
    b = spark.createDataFrame([(5, "alpha beta gamma delta")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_near) for r in decontaminate(d, b).collect()}
    assert got[2] == (4, 0) and got[1][0] == 0


def test_proximity_of_replaced_words(spark):
    d = spark.createDataFrame([(1, "alpha beta other delta"), (2, "alpha beta gamma delta"), (3, "gamma gamma delta delta"), (4, "alpha")], "doc_id long, text string")
    b = spark.createDataFrame([(5, "alpha beta gamma delta")], "item_id long, text string")
    # beta and alpha are the rarest (of equal counts the first)
    got = {r.doc_id: (r.n_hit, r.n_near) for r in decontaminate(d, b).collect()}
    assert got == {1: (0, 1), 2: (4, 0), 3: (0, 0), 4: (0, 0)}


def test_proximity_matches_its_sql(spark, tmp_path):
    import duckdb

    from agentlake.llm.oracles import DECONTAMINATE
    from tests.compare import compare

    docs = [(1, "alpha beta other delta"), (2, "alpha beta gamma delta"), (3, "gamma gamma delta delta"), (4, "alpha"), (5, "beta gap gap gap alpha beta gamma"), (6, "nameless item here"), (7, None)]
    items = [(5, "alpha beta gamma delta"), (None, "nameless item"), (8, "nameless item here too"), (9, None)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    for name, df in (("documents", d), ("benchmark", b)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    assert compare(con, decontaminate(d, b), DECONTAMINATE) is None
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate(d, b).collect()}
    assert got[6] == (2, 0, True)
