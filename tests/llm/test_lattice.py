import numpy as np
import pytest

pytest.importorskip("tesselon.llm")

from tesselon.llm import lattice  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, cosine=0.95):
    ok = {i: np.array(v, np.float64) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links, comp = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(ok)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = ok[a], ok[b]
            if len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(a), find(b)))
                comp[q] = p
    return {i: (links[i], find(i), find(i) == i) for i in links}


def got(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], SCHEMA)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in lattice.near_vectors(df, **more).collect()}


def corpus(n=300, groups=8, each=30, size=64, noise=0.02):
    rng = np.random.default_rng(2)
    x = [rng.normal(size=size) for _ in range(n)]
    for _ in range(groups):
        base = rng.normal(size=size)
        x += [base * rng.uniform(0.1, 9) + rng.normal(size=size) * noise for _ in range(each)] + [base] * 2
    return [(int(i), np.float32(v).tolist()) for i, v in zip(rng.permutation(len(x) * 3), x)]


def test_e8_decoding_is_nearest():
    near = lattice.minimal_vectors()
    assert len(near) == 240 == len({tuple(v) for v in near.tolist()}) and set((near**2).sum(1).tolist()) == {8}
    x = np.random.default_rng(1).normal(size=(500, 8)) * 2
    p = lattice.nearest_e8(x)
    gap = ((2 * x - p) ** 2).sum(1)
    assert gap.max() <= 4 + 1e-9  # the covering radius is 1
    for v in near:
        assert (((2 * x - p - v) ** 2).sum(1) >= gap - 1e-9).all()
    assert ((p % 2).std(1) == 0).all() and (p.sum(1) % 4 == 0).all()


def test_matches_brute_force(spark):
    rows = corpus()
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, block_docs=10) == brute(rows)


@pytest.mark.parametrize("plan", range(len(lattice.PLANS)))
def test_every_plan_finds_links_at_the_threshold(plan):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(2, 4000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    x, y = (lattice.cells(v, lattice.PLANS[plan], 5) for v in (a, 0.95 * a + np.sqrt(1 - 0.95**2) * b))
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(x.tolist(), y.tolist())]) >= 0.975


def test_comparisons_stay_flat():
    rng = np.random.default_rng(3)
    met = {}
    for n in (50_000, 500_000):
        x = rng.normal(size=(n, 64))
        x /= np.linalg.norm(x, axis=1)[:, None]
        keys = np.concatenate([lattice.cells(x[k : k + 20_000], lattice.plan_for(n), 5).ravel() for k in range(0, n, 20_000)])
        size = np.diff(np.flatnonzero(np.concatenate([[True], np.diff(np.sort(keys)) != 0, [True]])))
        met[n] = (size.astype(float) * (size - 1)).sum() / n
    assert met[500_000] < 2 * met[50_000] + 50 and max(met.values()) < 1000, met


def test_hot_cells_are_thinned(monkeypatch, spark):
    from tesselon.llm import ties

    rng = np.random.default_rng(6)
    base = rng.normal(size=64)
    rows = [(i, (base + rng.normal(size=64) * 0.12).tolist()) for i in range(500)] + [(1000 + i, rng.normal(size=64).tolist()) for i in range(50)]
    want = brute(rows)
    assert got(spark, rows) == want
    monkeypatch.setattr(ties, "FLUSH", 300)
    monkeypatch.setattr(ties, "HOT", 3)
    assert got(spark, rows, block_docs=100) == want


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(500):
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (0.951 * a + np.sqrt(1 - 0.951**2) * b).tolist())]
    found = got(spark, rows)
    want = brute(rows)
    assert sum(v[0] for v in found.values()) >= 0.97 * sum(v[0] for v in want.values())
    assert all(found[i][0] <= want[i][0] for i in want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0] * 8), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-30, 0.0]), (11, [3e38, 0.0])]
    out = got(spark, rows)
    assert {i: v for i, v in out.items() if i < 7 or i == 9} == {i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 9)}
    assert {out[i][:2] for i in (7, 8, 10, 11)} == {(3, 7)}
    df = spark.createDataFrame([(5, [1.0, 2.0], 0, ""), (5, [1.0, 2.0], 0, ""), (None, [1.0, 2.0], 0, ""), (6, [1.0, 2.0], 0, "")], SCHEMA)
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in lattice.near_vectors(df).collect()) == [(-1, 0, None), (5, 1, 5), (5, 1, 5), (6, 1, 5)]
    assert lattice.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
