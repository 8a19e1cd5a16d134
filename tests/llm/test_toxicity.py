"""The network's gradients, held-out accuracy and odd rows."""

import numpy as np

from agentlake.llm import toxicity as tox

SF = "/root/testdata/sf0.1"


def test_gradients_match_differences():
    net = tox.Network({"a": 1, "bb": 2}, np.array([0.5, -0.2]), dtype=np.float64)
    words, at = ["a", "bb", "other"], np.array([[0, 1, 2, 1], [2, 0, -1, -1]])
    y, weights = np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        p = net.forward(net.project(net.features(words)[0]), at)
        return (-(y * np.log(p) + (1 - y) * np.log(1 - p)) * weights).sum() / weights.sum()

    x, rows, grams = net.features(words)
    for name, g in net.gradients(x, rows, grams, at, y, weights).items():
        for i in np.flatnonzero(np.abs(g.ravel()) > 1e-6)[:6]:
            flat = net.p[name].reshape(-1)
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - g.ravel()[i]) < 1e-6, name


def test_windows_cover_the_text():
    for n in (0, 1, 31, 32, 33, 56, 57, 400):
        w = tox.window_index(n)
        assert set(range(n)) == set(w[w >= 0])


def test_every_window_is_scored():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    net = tox.Network({w: i + 1 for i, w in enumerate(words)}, rng.standard_normal(40))
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 31, 32, 33, 53, 57, 400, 5000)]
    got = tox.Scorer(net).scores(texts)
    for text, score in zip(texts, got, strict=True):
        w = text.split()
        names, at = tox._numbered([w])
        terms = net.project(net.features(names)[0])
        rows = [at[0][i : i + 32] for i in range(max(1, len(w) - 31))]
        want = net.forward(terms, np.array([np.append(r, [-1] * (32 - len(r))) for r in rows], dtype=np.int64))
        assert abs(score - want.max()) < 1e-5, len(w)
        begin = tox._highest(net, terms, at)[1][0]
        assert abs(want[begin] - want.max()) < 1e-5, len(w)


def test_the_sliding_pass_only_chooses(monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(40)]
    net = tox.Network({w: i + 1 for i, w in enumerate(words)}, rng.standard_normal(40))
    texts = [" ".join(rng.choice(words, n)) for n in (33, 40, 4200, 9000)] + ["w1 w2 " * 300]
    want, passed = tox.Scorer(net).scores(texts), tox.Network.slide

    def rough(self, terms, at):
        p = passed(self, terms, at)
        rows = at[np.arange(len(p))[:, None] + np.arange(tox.LENGTH)]
        assert np.abs(p - self.score(terms, rows)).max() < tox.CLOSE / 4
        return p + (rng.random(len(p)) - 0.5).astype(p.dtype) * np.float32(tox.CLOSE / 2)

    monkeypatch.setattr(tox.Network, "slide", rough)
    assert (tox.Scorer(net).scores(texts) == want).all()


def test_a_small_memory_of_words_changes_no_score(monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"{a}{i}{b}" for i in range(60) for a, b in (("w", ""), ("W", ""), ("", ","), ('"w', '"'))]
    net = tox.Network({f"w{i}": i + 1 for i in range(60)}, rng.standard_normal(60))
    texts = [" ".join(rng.choice(words, n)) for n in (5, 50, 300, 80, 2)]
    want = tox.Scorer(net).scores(texts)
    monkeypatch.setattr(tox, "MEMO", 100)
    small = tox.Scorer(net)
    got = np.concatenate([small.scores([t], at_once=1) for t in texts])
    assert np.abs(got - want).max() < 1e-6
    assert len(tox.Scorer(net).numbers([["w1", "W1", "w1,", '"w1"']])) == 1 and len(set(tox.Scorer(net).numbers([["w1", "W1,", '"w1"']])[0])) == 1


def test_few_windows_are_scored_anew_where_all_are_clean(monkeypatch):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(400)]
    net = tox.Network({w: i + 1 for i, w in enumerate(words)}, rng.standard_normal(400))
    net.p["c"] -= 11  # every window has less than CLOSE, so they lie close to each other
    texts = [" ".join(rng.choice(words, n)) for n in (40, 700, 3000)]
    seen, scored = [], tox.Network.score
    monkeypatch.setattr(tox.Network, "score", lambda self, terms, at: seen.append(len(at)) or scored(self, terms, at))
    got = tox.Scorer(net).scores(texts)
    assert got.max() < 1e-4 and sum(seen) < 100
    for text, score in zip(texts, got, strict=True):
        w = text.split()
        want = net.forward(net.project(net.features(w)[0]), np.arange(len(w) - 31)[:, None] + np.arange(32))
        assert abs(score / want.max() - 1) < 1e-4


def test_windows_that_round_to_the_highest_are_near():
    net = tox.Network({"w": 1, "v": 2}, np.array([3.0, -3.0]))
    net.p["c"] += 40  # every probability rounds to 1: the first window counts, as it always did
    w = ["v"] * 60 + ["w"] * 60
    names, at = tox._numbered([w])
    out, begin = tox._highest(net, net.project(net.features(names)[0]), at)
    assert out[0] == 1 and begin[0] == 0


def test_words_are_split_and_plain_as_in_training():
    odd = ["a\x1cb", "\u2003İstanbul, ΟΔΥΣΣΕΥΣ.", "«Été»", "...", " ", "", "x\u0085y\u00a0\"Z!\"", "ab><<cd ab ><<cd", "日本。 日本"]
    net = tox.Network({"a": 1, "istanbul": 2, "été": 3, "οδυσσευς": 4, "z": 5, "": 6}, np.arange(6.0))
    got = tox.Scorer(net).scores(odd)
    for text, score in zip(odd, got, strict=True):
        w = [tox.plain(x) for x in tox.words_of(text)]
        at = np.array([[*range(len(w)), *[-1] * (32 - len(w))]])
        assert abs(score - net.forward(net.project(net.features(w)[0]), at)[0]) < 1e-6, text


def test_trigrams_of_words_do_not_cross():
    words = ["", "a", "abc", "déjà", "toolong"]
    flat, counts = tox.trigrams(words)
    assert len(flat) == counts.sum()
    one = [tox.trigrams([w])[0].tolist() for w in words]
    assert sum(one, []) == flat.tolist()


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = tox.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(got) > 300
    # some texts marked toxic hold no toxic word at all, so no score can reach full recall here
    assert got.predicted[got.toxic == 1].mean() > 0.85
    assert got.predicted[got.toxic == 0].mean() < 0.02


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "", "y"), (2, "a b c", "z"), (2, "a b c", "z"), (3, "w " * 70_000, "q")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0), (2, 0)], "doc_id long, toxic int")
    got = tox.toxicity(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    none = tox.toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert tox.toxicity(docs.limit(0), labels).count() == 0
