import math
import os

import duckdb
import pytest

from tesselon.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    assert rows
    if name in catalogue.ORACLES:
        got = duck.execute(catalogue.ORACLES[name])
        names = [d[0] for d in got.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert sorted(repr(tuple(plain(r[i]) for i in at)) for r in got.fetchall()) == rows


def test_plans_stay_on_the_jvm_and_limit_groups_early(spark):
    def plan(name):
        return catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()

    assert "WindowGroupLimit" in plan("q_topk_per_slide") and "WindowGroupLimit" in plan("q_spatial_cap")
    for name in catalogue.QUERIES:
        if name.startswith("q_"):
            assert "Python" not in plan(name) and "Pandas" not in plan(name) and "CartesianProduct" not in plan(name), name


def test_scans_take_the_filters_of_gates(spark, tmp_path):
    from tesselon.operators import gate, metrics

    spark.createDataFrame([("s", 1, 0.5, 1)], "slide string, patch int, prob double, y int").write.parquet(str(tmp_path / "scored"))
    scored = spark.read.parquet(str(tmp_path / "scored"))
    for out, wanted in ((gate.regate(scored, "slide", "prob", "patch", gate.TumorGate()), "IsNotNull(prob)"), (gate.high_only(scored, "slide", "prob", "patch", gate.TumorGate()), "GreaterThanOrEqual(prob,0.738)"), (metrics.histogram(scored, [], "prob", 5), "IsNotNull(prob)")):
        pushed = out._jdf.queryExecution().executedPlan().toString().partition("PushedFilters: [")[2].partition("]")[0]
        assert wanted in pushed, pushed


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
