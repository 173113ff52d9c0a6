import re
from itertools import combinations

import pytest

pytest.importorskip("tesselon.llm")

SCHEMA = "doc_id long, text string, source string, n_shingles string"


def brute(rows, n, num, den):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    comp, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        c, u = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if c and den * c >= num * u:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            comp[y] = x
    return {i: (len(sets[i]), find(i), links[i]) for i in sets}


def got(spark, rows, n, num, den, **more):
    from tesselon.llm.ngram_join import ngram_jaccard_join

    df = spark.createDataFrame([(i, t, "s", "x") for i, t in rows], SCHEMA)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_jaccard_join(df, n=n, num=num, den=den, **more).collect()}


def corpus(k, base=40, step=3):
    words = [f"w{i % 17}x{i}" for i in range(400)]
    rows = [(7, None), (8, ""), (9, " \t\n"), (10, "One"), (11, "one"), (12, "one two"), (13, "One  Two")]
    for i in range(k):
        w = words[: base + (i * step) % 37]
        w = [*w[: i % 11], f"new{i % 5}", *w[i % 11 + 1 :]] if i % 3 else w
        rows.append((100 + i, " ".join(w)))
    rows += [(1000 + i, " ".join(words[i : i + 9 + i % 3])) for i in range(40)]
    return rows


@pytest.mark.parametrize(("n", "num", "den"), [(3, 90, 100), (5, 80, 100), (1, 90, 100)])
def test_matches_brute_force(spark, n, num, den):
    rows = corpus(60)
    assert got(spark, rows, n, num, den) == brute(rows, n, num, den)


def test_tiles_give_the_same(spark):
    rows = corpus(60)
    assert got(spark, rows, 3, 90, 100, block_docs=7) == brute(rows, 3, 90, 100)


def test_long_texts_null_ids_and_no_rows(spark):
    from tesselon.llm.ngram_join import ngram_jaccard_join

    long = " ".join(f"v{i}" for i in range(200_000))
    rows = [(1, long), (2, long + " end"), (3, "x" * 3_000_000), (None, long), (None, None)]
    out = ngram_jaccard_join(spark.createDataFrame([(i, t, "s", "x") for i, t in rows], SCHEMA), n=3, num=90).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["n_links"]) for r in out) == [
        (-1, 0, None, 0), (-1, 199_998, None, 0), (1, 199_998, 1, 1), (2, 199_999, 1, 1), (3, 1, 3, 0)]
    assert ngram_jaccard_join(spark.createDataFrame([], SCHEMA)).collect() == []


def test_words_that_collide_in_polynomials(spark):
    x, y = "a", "b"
    for _ in range(10):
        x, y = x + y, y + x
    rows = [(1, x), (2, y), (3, f"one two {x}"), (4, f"one two {y}"), (5, f"ONE two {x}")]
    assert got(spark, rows, 3, 90, 100) == brute(rows, 3, 90, 100)


def test_contract_columns_come_first(spark):
    from tesselon.llm.ngram_join import ngram_jaccard_join

    assert ngram_jaccard_join(spark.createDataFrame([], SCHEMA)).columns[:3] == ["doc_id", "n_shingles", "component_id"]


def test_repeated_rows(spark):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (4, text)]
    from tesselon.llm.ngram_join import ngram_jaccard_join

    out = ngram_jaccard_join(spark.createDataFrame([(i, t, "s", "x") for i, t in rows], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["n_links"]) for r in out) == [(4, 4, 1), (5, 4, 1), (5, 4, 1)]


def test_components_of_a_long_chain(spark):
    from tesselon.llm.shared import connected_components

    e = spark.range(1, 300).selectExpr("id as u", "id - 1 as v").union(spark.createDataFrame([(900, 901), (901, 901), (None, 3)], "u long, v long"))
    out = {r["node"]: r["component"] for r in connected_components(e)[0].collect()}
    assert out == {**{i: 0 for i in range(1, 300)}, 901: 900}


def test_repeated_rows_count_once(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(4, " ".join(words)), (4, " ".join(words)), (6, " ".join([*words, "end"]))]
    from tesselon.llm.ngram_join import ngram_jaccard_join

    out = ngram_jaccard_join(spark.createDataFrame([(i, t, "s", "x") for i, t in rows], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["n_links"]) for r in out) == [(4, 4, 1), (4, 4, 1), (6, 4, 1)]


def test_intermediate_tables_can_be_cleared(spark):
    import os

    from tesselon.llm import shared

    df, path = shared.written(spark.range(3), "x")
    assert df.count() == 3 and os.path.exists(path.removeprefix("file://"))
    shared.clear(spark)
    assert not os.path.exists(path.removeprefix("file://"))


@pytest.mark.parametrize("most", [0, 3, 1000])
def test_any_table_of_frequent_grams_gives_the_same(spark, monkeypatch, most):
    from tesselon.llm import ngram_join

    monkeypatch.setattr(ngram_join, "MOST_HOT", most)
    rows = corpus(60)
    assert got(spark, rows, 5, 80, 100) == brute(rows, 5, 80, 100)


def test_overlaps_of_rare_and_frequent_grams(monkeypatch):
    import numpy as np

    from tesselon.llm import ngram_join

    monkeypatch.setattr(ngram_join, "PAIRS", 500)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40 if i % 3 else 4000, rng.integers(0, 90))).astype(np.uint64) for i in range(150)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    got = ngram_join.overlaps(sets)
    shared = np.bincount(np.concatenate(sets).astype(int)) > 1
    assert all(got[i][j] == want[i][j] for i in range(150) for j in range(150) if i != j) and shared.any()
