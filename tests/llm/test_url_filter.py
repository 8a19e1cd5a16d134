"""URL rules against a plain reading, trees on held-out URLs."""

import re

from pyspark.sql import functions as F

from agentlake.llm import url_filter as uf

SF = "/root/testdata/sf0.1"
URLS = [None, "", "no scheme", "http://", "HTTP://A.ORG", "x://A.Org/", "https://example.org/es/1", "https://EXAMPLE.org/en/15?q#f", "https://notexample.org/es/", "http://m.example.org/en/2", "http://fr.com/fr/", "http://com/de/x", "a://b://c.com/de/", "http://x.com?/de/", "http://x.com#/de/", "http://É.org/ü", "http://x.net/" + "a1-" * 20_000, "://org/\n/x", "http://user@x.org:80/a"]


def plain(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1])
    fit = [r for _, r in uf.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and m[2].startswith("/" + r.split("/", 1)[1])]
    return host, m[2], max(fit, key=len, default=None)


def test_rules(spark):
    rows = [(i if i != 4 else None, u, "x") for i, u in enumerate(URLS)] + [(6, URLS[6], "x")]
    got = uf.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert sorted((r.host, r.path, r.rule or "") for r in got) == sorted((h, p, r or "") for h, p, r in (plain(u) for _, u, _ in rows))
    assert all(r.verdict == dict((b, a) for a, b in uf.RULES)[r.rule] for r in got if r.rule)
    assert all(r.verdict in ("allow", "block") for r in got)
    assert uf.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string").limit(0)).count() == 0


def test_trees_learn_held_out_urls(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    host, path = uf.parts(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("rule", uf.rule_of(F.col("host"), F.col("path"), uf.RULES))
    held = F.crc32("url") % 5 == 0
    model = uf.train(judged.filter(~held), uf.RULES)
    block = [r for v, r in uf.RULES if v == "block"]
    scored = model.with_suffixes(uf.lexical(judged.filter(held & F.col("rule").isNotNull()))).select((model.margin() >= 0).alias("hit"), F.col("rule").isin(block).alias("label"))
    right, base = scored.agg(F.avg((F.col("hit") == F.col("label")).cast("int")), F.avg(F.col("label").cast("int"))).first()
    assert right > max(base, 1 - base)


def test_sql_of_trees_equals_numpy(spark):
    rows = [{f: float((i * (k + 3)) % 17) for k, f in enumerate(uf.FEATURES[:-2])} | {"suffix": "ab"[i % 2]} for i in range(200)]
    labels = [int(r["length"] > 8) ^ (i % 7 == 0) for i, r in enumerate(rows)]
    model = uf.fit(rows, labels)
    import numpy as np

    x = np.array([[*(r[f] for f in uf.FEATURES[:-2]), *model.suffixes[r["suffix"]]] for r in rows])
    want = model.base + sum(uf._apply(t, x) for t in model.trees)
    got = model.with_suffixes(spark.createDataFrame([(i, *r.values()) for i, r in enumerate(rows)], ["i", *rows[0]])).orderBy("i").select(model.margin().alias("m")).toPandas().m
    assert abs(got - want).max() < 1e-9


def test_suffix_statistics_count_all_rows(spark):
    urls = [f"http://a{i}.net/x" for i in range(400)] + [f"http://b{i}.com/{'de' if i % 4 else 'fr'}/" for i in range(200)] + [f"http://c.s{i}/" for i in range(300) for _ in range(2)]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = uf.parts(F.col("url"))
    judged = rows.withColumns({"host": host, "path": path}).withColumn("rule", uf.rule_of(F.col("host"), F.col("path"), uf.RULES))
    model = uf.train(judged, uf.RULES, sample=50)
    got = {r.suffix: (r.suffix_rate, r.suffix_share) for r in model.with_suffixes(uf.lexical(judged)).select("suffix", "suffix_rate", "suffix_share").distinct().collect()}
    rate = 150.5 / 201
    want = {"net": (rate, 400 / 1200), "com": ((150 + 5 * rate) / 205, 200 / 1200)} | {f"s{i}": (rate, 2 / 1200) for i in range(300)}
    assert got.keys() == want.keys()
    assert all(abs(a - b) < 1e-12 for k in want for a, b in zip(got[k], want[k], strict=True))
    assert uf.filter_urls(rows.withColumn("page_id", F.lit(1))).count() == len(urls)
