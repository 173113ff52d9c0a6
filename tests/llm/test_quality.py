import math
import re
from collections import Counter
import xxhash
import numpy as np
import random

import pytest

pytest.importorskip("tesselon.llm")

from test_simhash import word_hash  # noqa: E402

from tesselon.llm import quality  # noqa: E402

SCHEMA = "doc_id long, text string, source string, lang string, keep string, posterior string"


def prose(r, n):
    return " ".join(r.choice(["the", "of", "and", "house", "river", "seven", "light", "walk", f"w{r.randrange(500)}"]) for _ in range(n)) + "."


def junk(r, n):
    return r.choice([lambda: " ".join(r.choice(["buy", "now", "x"]) + r.choice(["%%%", "$$$"]) for _ in range(n)), lambda: "spam " * n, lambda: " | ".join(f"k{r.randrange(99)}" for _ in range(n))])()


def corpus(n=600):
    r = random.Random(3)
    rows = [(i, (junk if (bad := r.random() < (0.8 if i % 5 == 0 else 0.1)) else prose)(r, r.randrange(20, 200)), f"s{i % 5}", "en" if i % 2 else "de", bad) for i in range(n)]
    return rows


def frames(spark, rows, labelled):
    docs = spark.createDataFrame([(*row[:4], "clash", "clash") for row in rows], SCHEMA)
    return docs, spark.createDataFrame([(i, int(not bad), 0) for i, _, _, _, bad in rows if labelled(i)], "doc_id long, quality int, toxic int")


def test_held_out_documents(spark):
    rows = corpus()
    docs, labels = frames(spark, rows, lambda i: i < 300)
    out = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    right = [out[i]["keep"] == (not bad) for i, *_, bad in rows if i >= 300]
    assert sum(right) / len(right) > 0.98
    assert out[0]["host_posterior"] < min(out[i]["host_posterior"] for i in range(1, 5))


def test_sparse_sites_shrink_towards_the_levels_above(spark):
    rows = [(i, float(lo), h, p) for i, (h, p, lo) in enumerate([("a", "x", 3)] * 200 + [("a", "y", 3)] * 100 + [("b", "x", -3)] * 200 + [("a", "z", -3)] + [("c", "x", -3)])]
    scored = spark.createDataFrame([(lo, h, p) for _, lo, h, p in rows], "__logit double, source string, lang string")
    table, prior = quality.sites(scored)
    got = {(r["__host"], r["__path"]): (r["host_posterior"], r["path_posterior"]) for r in table.collect()}
    assert 0.55 < prior < 0.65
    assert got["a", "x"][0] > 0.9 and got["b", "x"][0] < 0.1
    low = 1 / (1 + 2.718281828**3)
    assert low < got["c", "x"][0] < prior and low < got["a", "z"][1] < got["a", "z"][0]
    assert got["c", "x"][0] - low > got["b", "x"][0] - low


def test_odd_rows_and_no_labels(spark):
    rows = [(1, None, "a", None, False), (2, "", None, "en", False), (None, "the river and the house.", "a", "en", False), (4, "x " * 300_000, None, None, False), (5, "same", "a", "en", False), (5, "same", "a", "en", False)]
    docs, labels = frames(spark, rows, lambda i: False)
    out = quality.classify(docs, labels).collect()
    assert sorted((r["doc_id"] or -1, r["keep"]) for r in out) == [(-1, True), (1, False), (2, False), (4, True), (5, True), (5, True)]
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.classify(empty, labels).collect() == []


def test_more_sites_than_are_broadcast(spark, monkeypatch):
    rows = corpus(200)
    docs, labels = frames(spark, rows, lambda i: True)
    want = sorted((r["doc_id"], round(r["posterior"], 9)) for r in quality.classify(docs, labels).collect())
    monkeypatch.setattr(quality, "MOST_SITES", 0)
    assert sorted((r["doc_id"], round(r["posterior"], 9)) for r in quality.classify(docs, labels).collect()) == want


def plain_features(text, lexicon=None):
    """The features of a text by their rules."""
    b = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", b)
    n, size = max(len(words), 1), max(len(b), 1)

    def count(chars):
        return sum(c in chars for c in b)

    up, low = count(bytes(range(65, 91))), count(bytes(range(97, 123)))
    times = Counter(words)
    runs = list(zip(words, words[1:], words[2:]))
    return [
        math.log1p(len(words)), up / max(up + low, 1), count(b"0123456789") / size, min(count(b"#$%&*@^~=+<>{}[]\\/_") / n, 2), min(count(b"|") / n, 1), min(count(b"!?") / n, 2), min(count(b".,;:") / n, 2),
        sum(c > 127 for c in b) / size, sum(x == y for x, y in zip(words, words[1:])) / n, len(times) / n if words else 1, max(times.values()) / n if len(words) > 3 else 0,
        1 - len(set(runs)) / len(runs) if len(words) > 3 else 0, min(sum(map(len, words)) / n, 30), min(count(b"\n") / n, 1), sum(len(w) > 24 for w in words) / n,
        sum(lexicon[word_hash(w) >> 51] for w in times) / len(times) if words and lexicon else 0,
    ]


def plain_classes(docs, labels):
    """By id: evidence, host and path posterior, posterior, keep. docs: (id, text, host, path); labels: {id: 0 or 1}."""
    texts = {i: t or "" for i, t, _, _ in docs if i in labels}
    fold = {i: xxhash.xxh64_intdigest(str(i).encode(), xxhash.xxh64_intdigest(b"fold", 42)) & 1 for i in texts}

    def lexicon(folds):
        has, all_ = [Counter(), Counter()], [0, 0]
        for i, t in texts.items():
            if fold[i] in folds:
                all_[labels[i]] += 1
                has[labels[i]].update({word_hash(w) >> 51 for w in re.findall(rb"[^\x20\x09-\x0D]+", t.encode())})
        return [math.log((has[1][k] + 2) / (all_[1] + 4)) - math.log((has[0][k] + 2) / (all_[0] + 4)) for k in range(1 << 13)]

    x = np.array([plain_features(t, lexicon({1 - fold[i]})) for i, t in texts.items()])
    y = np.array([labels[i] for i in texts], float)
    mean, sd = x.mean(0), x.std(0)
    sd[sd < 1e-9] = 1
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / sd, -8, 8)])
    w, ridge = np.zeros(z.shape[1]), np.array([1e-6] + [1.0] * x.shape[1])
    for _ in range(500):
        p = 1 / (1 + np.exp(-z @ w))
        w -= 0.5 * np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(ridge), z.T @ (p - y) + ridge * w)
    whole = lexicon({0, 1})
    logit = {i: float(np.clip(w[0] + np.clip((np.array(plain_features(t, whole)) - mean) / sd, -8, 8) @ w[1:], -30, 30)) for i, t, _, _ in docs}
    prob = {i: 1 / (1 + math.exp(-v)) for i, v in logit.items()}
    prior = min(1 - 1e-4, max(1e-4, sum(prob.values()) / len(prob)))

    def strength(groups):  # of (n, mean, mean of the level above)
        n, g = sum(a for a, _, _ in groups), len(groups)
        if g < 2:
            return 100.0
        within = sum(a * u * (1 - u) for a, _, u in groups) / n
        between = (sum(a * (m - u) ** 2 for a, m, u in groups) - (g - 1) * within) / max(1, n - sum(a * a for a, _, _ in groups) / n)
        return min(10_000, max(1, within / between - 1)) if between > 0 else 10_000

    def sums(key):
        out = {}
        for i, _, h, q in docs:
            n, s = out.get(key(h, q), (0, 0))
            out[key(h, q)] = n + 1, s + prob[i]
        return out

    hosts, paths = sums(lambda h, q: h), sums(lambda h, q: (h, q))
    k = strength([(n, s / n, prior) for n, s in hosts.values()])
    hosts = {h: (s + k * prior) / (n + k) for h, (n, s) in hosts.items()}
    k = strength([(n, s / n, hosts[h]) for (h, _), (n, s) in paths.items()])
    paths = {hp: (s + k * hosts[hp[0]]) / (n + k) for hp, (n, s) in paths.items()}

    def log_odds(p):
        p = min(max(p, 1e-4), 1 - 1e-4)
        return math.log(p / (1 - p))

    out = {}
    for i, t, h, q in docs:
        p = 1 / (1 + math.exp(-(logit[i] + log_odds(paths[h, q]) - math.log(prior / (1 - prior)))))
        out[i] = logit[i], hosts[h], paths[h, q], p, p >= 0.5 and bool((t or "").split())
    return out


def test_matches_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [(r["doc_id"], r["text"], r["source"], r["lang"]) for r in docs.collect()]
    want = plain_classes(rows, {r["doc_id"]: r["quality"] for r in labels.collect()})
    for r in quality.classify(docs, labels).collect():
        assert [r["evidence"], r["host_posterior"], r["path_posterior"], r["posterior"]] == pytest.approx(want[r["doc_id"]][:4], abs=2e-5)
        assert r["keep"] == want[r["doc_id"]][4]


def test_repeated_ids_do_not_add_labels(spark):
    rows = corpus(200)
    docs, labels = frames(spark, rows, lambda i: True)
    more = docs.where("doc_id < 5").crossJoin(spark.range(300)).drop("id")
    one, many = quality.train(docs, labels), quality.train(docs.unionByName(more), labels)
    assert one[0] == many[0] and one[2] == many[2]
