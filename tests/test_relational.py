"""Operators against plain Python, and properties: caps, quotas, upserts, splits, streams, sources and sinks."""

import os
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tesselon.functions import columns as C
from tesselon.functions import ranks
from tesselon.operators import gate, geo, metrics, select, split, summary
from tesselon.schemas import PATCH_INDEX, conform
from tesselon.sources import sinks, slides


def test_diagnostics_prefer_the_effective_status(spark):
    schema = "mask_status string, mask_status_effective string, status_basis string, fallback_used string, sparse_canvas_mode string, mask_frac string, mask_frac_effective string, profile_used string"
    rows = [("low_tissue", "ok", "effective", "True", "yes", "0.1", "0.4", "p"), ("ok", "NaN", None, None, "0", "nan", None, None), ("ok", " ", None, "f", None, "x", "1", None)]
    out = gate.resolved_diagnostics(spark.createDataFrame(rows, schema)).collect()
    assert [r["mask_status"] for r in out] == ["ok", "ok", "ok"]
    assert [r["mask_status_global"] for r in out] == ["low_tissue", "ok", "ok"]
    assert [(r["fallback_used"], r["sparse_canvas_mode"], r["mask_frac"]) for r in out] == [(True, True, 0.1), (False, False, None), (False, False, None)]


def test_sparse_canvas_and_retry(spark):
    rows = [(".mrxs", 0.10, 0.90, True), (".svs", 0.80, 0.50, True), (".ndpi", 0.20, 0.10, True), (".svs", 0.20, 0.40, False)]
    df = spark.createDataFrame(rows, "s string, b double, f double, want boolean")
    assert all(r[0] == r[1] for r in df.select(C.sparse_canvas("s", "b", "f"), "want").collect())
    rows = [(0.002, 5000, 0.90, 0.05, "ok", False), (0.002, 5000, 0.90, 0.005, "ok", True)]
    df = spark.createDataFrame(rows, "g double, p int, n double, l double, s string, want boolean")
    assert all(r[0] == r[1] for r in df.select(C.retry_accepted("g", "p", "n", "l", "s"), "want").collect())


def plain_quota(rows, q):
    """The rules of the quotas, one after another."""
    rows = sorted(rows, key=lambda r: (-r[1], r[0]))
    sel = []
    for kind in "ABC":
        sel += [r for r in rows if r[2] == kind][: q.wanted(kind)]
    sel = sorted(sel, key=lambda r: (-r[1], r[0]))[: q.target]
    first = {r[0] for r in rows if r[2] in "ABC" and r in sel} | {r[0] for k in "ABC" for r in [x for x in rows if x[2] == k][: q.wanted(k)]}
    for r in rows:
        if len(sel) < q.target and r[0] not in first and r[2] != "D":
            sel.append(r)
    room = min(q.target - len(sel), round(q.target * q.max_d))
    if q.one_d_at_least and len(sel) < q.target:
        room = max(room, 1)
    sel += [r for r in rows if r[2] == "D"][: max(0, room)]
    if not q.allow_under_target:
        have = {r[0] for r in sel} | first
        sel += [r for r in rows if r[0] not in have][: max(0, q.target - len(sel))]
    return {r[0] for r in sel}


@pytest.mark.parametrize("seed", range(5))
def test_quotas_against_the_rules(spark, seed):
    r = random.Random(seed)
    rows = [(i, round(r.random(), 2), r.choice("AABBCDDD"), "s") for i in range(60)]
    df = spark.createDataFrame(rows, "k long, v double, t string, s string")
    for q in (
        select.Quotas(r.randrange(5, 50), {"A": 0.5, "B": 0.3, "C": 0.2}, blood_cap=0.2, max_d=0.1),
        select.Quotas(r.randrange(5, 50), {"A": 0.2, "B": 0.1, "C": 0.1}, max_d=0.0, one_d_at_least=True),
        select.Quotas(r.randrange(40, 70), {"A": 0.1, "B": 0.1, "C": 0.0}, max_d=0.05, allow_under_target=False),
    ):
        got = {x["k"] for x in select.quota_select(df, ["s"], "v", "t", "k", q).collect()}
        assert got == plain_quota([x[:3] for x in rows], q)
        assert len(got) <= q.target


def test_quota_frame_by_hand(spark):
    kinds = "AABBCDDDDD"
    df = spark.createDataFrame([("s", i, 1.0 - i / 10, k) for i, k in enumerate(kinds)], "s string, k int, v double, t string")
    out = select.quota_select(df, ["s"], "v", "t", "k", select.Quotas(10, {"A": 0.5, "B": 0.3, "C": 0.2}, blood_cap=0.2, max_d=0.1)).collect()
    assert sorted(r["t"] for r in out) == list("AABBCD")


def test_cap_keeps_at_most_n_and_ranks_ignore_row_order(spark):
    r = random.Random(1)
    rows = [("s", i, r.randrange(500), r.randrange(500), float(r.randrange(20))) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, k int, x int, y int, v double")
    capped = select.spatial_cap(df, ["s"], "x", "y", "v", "k", 100, 7)
    n = capped.groupBy(F.floor(F.col("x") / 100), F.floor(F.col("y") / 100)).count().agg(F.max("count")).first()[0]
    assert n <= 7
    a = {x["k"]: x["p"] for x in df.withColumn("p", ranks.pct_rank_avg(["s"], "v")).collect()}
    b = {x["k"]: x["p"] for x in df.orderBy(F.rand(3)).withColumn("p", ranks.pct_rank_avg(["s"], "v")).collect()}
    assert a == b
    v = sorted(x[4] for x in rows)
    for k, _, _, _, val in ((x[1], *x[1:]) for x in rows[:50]):
        lo, hi = v.index(val) + 1, len(v) - v[::-1].index(val)
        assert a[k] == pytest.approx((lo + hi) / 2 / len(v))


def test_upsert_twice_is_upsert_once(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "k string, v int, w string")
    new = spark.createDataFrame([("b", 9, 5.0), ("c", 3, None)], "k string, v int, z double")
    once = summary.upsert(old, new, ["k"], "v")
    twice = summary.upsert(once, new, ["k"], "v")
    want = {("a", 1, "x", None), ("b", 9, None, 5.0), ("c", 3, None, None)}
    assert {(r["k"], r["v"], r["w"], r["z"]) for r in once.collect()} == want == {(r["k"], r["v"], r["w"], r["z"]) for r in twice.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_hard_split_is_a_partition_with_both_labels(spark, seed):
    r = random.Random(seed)
    fracs = [r.choice([0.0, 1.0, round(r.random(), 3)]) for _ in range(r.randrange(2, 25))]
    df = spark.createDataFrame([(f"s{i}", f) for i, f in enumerate(fracs)], "slide_id string, tumor_frac double")
    s = split.HardSplit(val_frac=0.3, seed=seed)
    out = {x["slide_id"]: x["part"] for x in split.hard_group_split(df, s=s).collect()}
    val = [f for i, f in enumerate(fracs) if out[f"s{i}"] == "val"]
    assert len(out) == len(fracs) and 0 < len(val) < len(fracs)
    if any(f <= s.low for f in fracs):
        assert len(val) == max(1, min(round(len(fracs) * 0.3), len(fracs) - 1))
    lows = [f for f in fracs if f <= s.low]
    if len(val) >= 4 and len(lows) >= 3:
        assert sum(f <= s.low for f in val) >= 2
    can = any(f > 0 for f in fracs) and any(f < 1 for f in fracs)
    if can and len(val) >= 2:
        assert any(f > 0 for f in val) and any(f < 1 for f in val)


def test_metrics_against_all_pairs(spark):
    r = random.Random(5)
    rows = [(i, int(r.random() < 0.4), round(r.random(), 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, y int, s double")
    pairs = [(a, b) for a, b in itertools.product([x[2] for x in rows if x[1]], [x[2] for x in rows if not x[1]])]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    assert metrics.roc_auc(df, "y", "s").first()[0] == pytest.approx(want)
    sweep = {round(x["threshold"], 6): (x["tn"], x["fp"], x["fn"], x["tp"]) for x in metrics.threshold_sweep(df, "y", "s", 101).collect()}
    for k in range(101):
        t = k / 100
        assert sweep[round(t, 6)] == tuple(sum(1 for _, y, s in rows if y == a and (s >= t) == b) for a, b in ((0, False), (0, True), (1, False), (1, True)))
    one = df.where("y = 1")
    assert metrics.roc_auc(one, "y", "s").first()[0] is None and metrics.average_precision(one, "y", "s").first()[0] is None


def test_polygon_borders_are_outside(spark):
    square = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]
    hole = [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0]]
    polygons = spark.createDataFrame([("s", [square, hole])], "s string, rings array<array<array<double>>>")
    points = spark.createDataFrame([("s", float(x), float(y)) for x in range(-1, 12) for y in range(-1, 12)] + [("t", 5.0, 1.0)], "s string, x double, y double")
    got = {(r["x"], r["y"]) for r in geo.points_in_polygons(points, polygons, ["s"], cell=3).collect()}
    assert got == {(x, y) for x in range(1, 10) for y in range(1, 10) if not (4 <= x <= 6 and 4 <= y <= 6)}
    assert geo.points_in_polygons(points, polygons, ["s"], "left_anti", 3).count() == points.count() - len(got)


def test_canvas_points(spark):
    df = spark.createDataFrame([(5, 5), (-20, 3), (500, 1), (-900, 0)], "x int, y int").withColumns({"bx": F.lit(30), "by": F.lit(0), "w": F.lit(100), "h": F.lit(100)})
    x, y = geo.to_canvas("x", "y", "bx", "by", "w", "h")
    assert [tuple(r) for r in df.select(x, y).collect()] == [(5, 5), (10, 3), (None, None), (None, None)]


def test_conform(spark):
    df = spark.createDataFrame([("002", "7", "nan", "x")], "`Slide_ID ` string, X string, mpp string, other string")
    out = conform(df, PATCH_INDEX, {"y": ("y_qp",)})
    assert out.schema == PATCH_INDEX
    assert out.first().asDict() == {"slide_id": "002", "x": 7, "y": None, "label": None, "mpp": None, "read_px": None, "png_path": None}


def test_files_and_names(spark, tmp_path):
    for name in ("c1/a.svs", "c1/sub/a.SVS", "c1/b.txt", "c2/a.mrxs", "c1/002__x5__y-7__mpp0.250__r448.png"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    files = slides.listed(spark, [str(tmp_path / "c1"), str(tmp_path / "c2")])
    got = {(r["center"], r["slide_id"], r["slide_relpath"]) for r in slides.slide_records(files).collect()}
    assert got == {("c1", "a", "a"), ("c1", "a", "sub/a"), ("c2", "a", "a")}
    found = slides.first_mask(slides.slide_records(files).limit(1), spark.createDataFrame([("/m/a.png",), ("/m/a.npy",)], "path string")).first()
    assert found["mask_path"] == "/m/a.npy"
    p = slides.patches_by_path(spark.createDataFrame([("/t/1/002__x5__y-7__mpp0.250__r448.png",), ("/t/none/x.png",)], "path string")).collect()
    assert [(r["slide_id"], r["label"], r["x"], r["y"], r["mpp"], r["read_px"]) for r in p] == [("002", 1, 5, -7, 0.25, 448)]


def test_lookup_never_fans_out(spark):
    s = spark.createDataFrame([("u1", "i1"), (" ", "i2"), (None, "i9")], "slide_uid string, slide_id string")
    t = spark.createDataFrame([("u1", "i1", 5), ("u1", "i1", 4), (None, "i2", 7)], "slide_uid string, slide_id string, v int")
    assert sorted((r["slide_id"], r["v"]) for r in gate.lookup(s, t, ["v"]).collect()) == [("i1", 5), ("i2", 7), ("i9", None)]
    t = t.withColumn("seq", -F.col("v"))
    assert sorted((r["slide_id"], r["v"]) for r in gate.lookup(s, t, ["v"], order="seq").collect()) == [("i1", 4), ("i2", 7), ("i9", None)]


def test_precheck_raises(spark):
    s = spark.createDataFrame([("a",), ("b",)], "slide_uid string")
    m = spark.createDataFrame([("a", "ok")], "slide_uid string, mask_status string")
    with pytest.raises(ValueError, match="masks"):
        gate.require(gate.precheck(s, m), "missing = 0", "masks are missing")


def test_sinks(spark, tmp_path):
    scored = spark.createDataFrame([("s", i, i / 10, "c1" if i % 2 else "c2") for i in range(10)], "slide string, patch int, prob double, center string")
    sinks.scored_outputs(scored, str(tmp_path / "g"), "slide", "prob", "patch", gate.TumorGate(high=0.75, topk=4))
    assert spark.read.parquet(str(tmp_path / "g/topk_scored")).count() == 4 and spark.read.parquet(str(tmp_path / "g/high_only")).count() == 2
    assert sinks.read_scored(spark, str(tmp_path / "g")).count() == 10 and sinks.read_scored(spark, str(tmp_path / "none")) is None
    sinks.by_center(scored, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).where("center = 'c1'").count() == 5
    assert sinks.csv(scored, str(tmp_path / "t"), ["patch"]) is None
    assert sinks.csv(scored.limit(1), str(tmp_path / "t")) is not None and spark.read.option("header", True).csv(str(tmp_path / "t")).count() == 1
    sinks.with_log(scored.withColumn("error", F.when(F.col("patch") < 3, "bad")), str(tmp_path / "ok"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 7 and spark.read.parquet(str(tmp_path / "log")).count() == 10


def test_incremental_upsert(spark, tmp_path):
    from pyspark.sql import types as T

    from tesselon.streaming.incremental import files, upsert_stream

    schema = T.StructType([T.StructField("slide_uid", T.StringType()), T.StructField("n", T.IntegerType())])
    src, root, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.createDataFrame([("a", 1), ("b", 1)], schema).coalesce(1).write.mode("append").parquet(src)
    upsert_stream(files(spark, src, schema), root, ["slide_uid"], "n", ck).awaitTermination()
    spark.createDataFrame([("b", 2), ("c", 1)], schema).coalesce(1).write.mode("append").parquet(src)
    upsert_stream(files(spark, src, schema), root, ["slide_uid"], "n", ck).awaitTermination()
    upsert_stream(files(spark, src, schema), root, ["slide_uid"], "n", ck).awaitTermination()  # nothing new
    assert sorted(map(tuple, summary.read_current(spark, root).collect())) == [("a", 1), ("b", 2), ("c", 1)]


def test_mining_and_training_points(spark):
    from tesselon.plans import stages
    from tesselon.sources import plugins

    s = spark.createDataFrame([("s0", "/synthetic/0.svs"), ("s1", "/synthetic/1.svs")], "slide_uid string, path string")
    top = stages.mine_stage(s, plugins.SyntheticSlide, plugins.StandInClassifier, 3, 4.0, 32, s=stages.Settings(read=64, tile=32)).collect()
    assert len(top) == 6 and {r["rank"] for r in top} == {1, 2, 3}
    slides_ = spark.createDataFrame([("s0", 0.5, 1000, 1000)], "slide_id string, mpp double, w int, h int")
    ring = [[[100.0, 100.0], [900.0, 100.0], [900.0, 900.0], [100.0, 900.0]]]
    a = spark.createDataFrame([("s0", "Tumor", ring), ("s0", "Ignore", [[[100.0, 100.0], [500.0, 100.0], [500.0, 950.0], [100.0, 950.0]]])], "slide_id string, class_name string, rings array<array<array<double>>>")
    got = stages.training_points(slides_, a, {"Tumor": 1}, least=5, ignore=("Ignore",)).collect()
    assert got and all(500 <= r["x_qp"] < 900 and r["label"] == 1 for r in got)
    assert stages.training_points(slides_, a, {"Tumor": 1}, least=5000).count() == 0


def test_mining_joins_and_broadcasts_nothing(spark):
    import numpy as np

    from tesselon.operators import geo, raster
    from tesselon.plans import stages
    from tesselon.sources import plugins

    s = spark.createDataFrame([("s0", "/synthetic/0.svs"), ("s1", "/synthetic/1.svs"), (None, "/synthetic/2.svs")], "slide_uid string, path string").coalesce(1)
    top = stages.mine_stage(s, plugins.SyntheticSlide, plugins.StandInClassifier, 3, 4.0, 32, s=stages.Settings(read=64, tile=32))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan and "repartition" in plan.lower()
    assert {r["slide_uid"] for r in top.collect()} == {"s0", "s1"}
    mask = np.random.default_rng(3).random((23, 31)) < 0.4
    ys, xs = np.arange(0, 23, 5), np.arange(0, 31, 4)
    share = raster.window_share(mask, ys, xs, 3)
    want = [[mask[max(0, y - 3) : y + 4, max(0, x - 3) : x + 4].mean() for x in xs] for y in ys]
    assert np.array_equal(share, np.array(want))
    rows = spark.createDataFrame([("a", int(y), int(x)) for y, x in zip(*np.nonzero(mask))], "slide string, y int, x int")
    points = spark.createDataFrame([("a", int(y), int(x), 31, 23) for y in ys for x in xs], "slide string, y int, x int, width int, height int")
    joined = geo.window_density(points, rows, "slide", 3, 0.0)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert {(r["y"], r["x"]): r["density"] for r in joined.collect()} == {(y, x): share[i, j] for i, y in enumerate(ys.tolist()) for j, x in enumerate(xs.tolist())}


def test_failed_reads_are_rows(spark):
    from tesselon.sources import plugins

    def broken(path):
        if path.endswith("1.svs"):
            raise OSError("no such slide")
        return plugins.SyntheticSlide(path)

    p = spark.createDataFrame([("s0", 1, 0, 0, "/x/0.svs"), ("s1", 2, 0, 0, "/x/1.svs")], "slide_uid string, patch_id long, x0 int, y0 int, path string")
    scored = plugins.score_tiles(plugins.read_tiles(p, broken, 16, 32), plugins.StandInClassifier).collect()
    by = {r["slide_uid"]: r for r in scored}
    assert by["s0"]["tumor_prob"] is not None and by["s1"]["tumor_prob"] is None and "no such slide" in by["s1"]["error"]


def test_best_so_far(spark):
    df = spark.createDataFrame(list(enumerate([0.5, 0.50005, 0.50009, 0.6, 0.6, 0.6, 0.6, 0.9])), "e int, auc double")
    out = ranks.best_so_far(df, "e", "auc").orderBy("e").collect()
    assert [r["best"] for r in out] == [0.5, 0.5, 0.5, 0.6, 0.6, 0.6, 0.6, 0.9]
    assert [r["improved"] for r in out] == [True, False, False, True, False, False, False, False]
    assert [r["stopped"] for r in out] == [False] * 6 + [True, True]


def test_even_sample(spark):
    df = spark.range(50).selectExpr("'s' as s", "id as k")
    got = sorted(r["k"] for r in ranks.even_sample(df, ["s"], ["k"], 7).collect())
    assert got == sorted({int(i * 49 / 6) for i in range(7)})


def test_the_last_row_of_a_key_wins(spark):
    old = spark.createDataFrame([("a", "zz", 1), ("a", "aa", 2), ("b", "x", 9)], "k string, v string, seq int")
    assert sorted(map(tuple, summary.upsert(old.limit(0), old, ["k"], "seq").collect())) == [("a", "aa", 2), ("b", "x", 9)]
    new = spark.createDataFrame([("b", "older", 1)], "k string, v string, seq int")
    assert sorted(map(tuple, summary.upsert(old, new, ["k"], "seq").collect())) == [("a", "aa", 2), ("b", "older", 1)]


def test_versions_survive_what_dies_between(spark, tmp_path):
    import shutil

    root = str(tmp_path / "t")
    assert summary.read_current(spark, root) is None
    for n in range(5):
        summary.write_version(spark.range(n), root)
    assert summary.read_current(spark, root).count() == 4 and len([p for p in os.listdir(root) if p.startswith("v-")]) == 3
    spark.range(99).write.parquet(f"{root}/v-unfinished")  # a writer that died before its pointer
    open(f"{root}/_versions/tmp-v-unfinished", "w").close()
    assert summary.read_current(spark, root).count() == 4
    summary.write_version(spark.range(7), root)
    assert summary.read_current(spark, root).count() == 7
    shutil.rmtree(f"{root}/_versions")
    with pytest.raises(RuntimeError):
        summary.read_current(spark, root)
    with pytest.raises(RuntimeError):
        summary.write_version(spark.range(1), root)


def test_nan_is_no_score(spark):
    nan = float("nan")
    rows = [("s", 1, nan, 1), ("s", 2, None, 0), ("s", 3, 0.9, 1), ("s", 4, 0.2, 0), ("s", 5, nan, 0), ("s", 6, 0.8, 1)]
    df = spark.createDataFrame(rows, "slide string, patch int, p double, y int")
    r = gate.regate(df, "slide", "p", "patch", gate.TumorGate()).first()
    assert (r["scored_ok"], r["tumor_prob_ge_thr"]) == (3, 2)
    assert [x["patch"] for x in gate.high_only(df, "slide", "p", "patch", gate.TumorGate()).orderBy("patch").collect()] == [3, 6]
    assert [(x["patch"], x["p"]) for x in gate.top_scored(df, "slide", "p", "patch", 4).orderBy("rank").collect()] == [(3, 0.9), (6, 0.8), (4, 0.2), (1, None)]
    c = metrics.confusion(df, "y", "p").first()
    assert (c["tn"], c["fp"], c["fn"], c["tp"]) == (3, 0, 1, 2)
    assert metrics.roc_auc(df, "y", "p").first()["roc_auc"] == 1.0
    s = metrics.threshold_sweep(df, "y", "p", 11).where("threshold = 0.5").first()
    assert (s["tn"], s["fp"], s["fn"], s["tp"]) == (3, 0, 1, 2)
    assert sum(x["n"] for x in metrics.histogram(df, [], "p", 10).collect()) == 3
    assert {x["patch"]: x["r"] for x in df.select("patch", ranks.pct_rank_avg(["slide"], "p").alias("r")).collect()} == {1: None, 2: None, 5: None, 4: 1 / 3, 6: 2 / 3, 3: 1.0}
    assert [x["patch"] for x in select.spatial_cap(df.withColumns({"x": F.lit(1), "y0": F.lit(1)}), ["slide"], "x", "y0", "p", "patch", most=1).collect()] == [3]


def test_curves_of_crowded_scores(spark):
    """Nearly all scores next to 1: the ranges still hold about as many each."""
    n = 20_000
    df = spark.range(n).select((F.col("id") % 3 == 0).cast("int").alias("y"), F.when(F.col("id") % 100 == 0, F.col("id") / n).otherwise(0.9998 + F.col("id") * 1e-8).alias("s"))
    got = {r["score"]: (r["tp"], r["fp"]) for r in metrics.steps(df, "y", "s").collect()}
    tp = fp = 0
    for s, y in sorted(((r["s"], r["y"]) for r in df.collect()), reverse=True):
        tp, fp = tp + y, fp + 1 - y
        assert got[s] == (tp, fp)


def test_one_of_an_even_sample(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "g string, i int")
    assert sorted(map(tuple, ranks.even_sample(df, ["g"], ["i"], 1).collect())) == [("a", 0), ("b", 9)]


def test_each_tile_is_read_and_scored_once(spark, tmp_path):
    """Counts kept in files, as the work is done in other processes."""
    import numpy as np

    from tesselon.operators import masks
    from tesselon.operators import raster as R
    from tesselon.plans import stages
    from tesselon.sources import plugins

    log = str(tmp_path)

    def note(kind, n=1):
        fd = os.open(f"{log}/{kind}", os.O_WRONLY | os.O_APPEND | os.O_CREAT)
        os.write(fd, b"x" * n)
        os.close(fd)

    class Slide(plugins.SyntheticSlide):
        def read(self, x0, y0, level, w, h):
            if level == 0:
                note("reads")
            return super().read(x0, y0, level, w, h)

    class Model(plugins.StandInClassifier):
        def predict(self, tiles):
            note("tiles", len(tiles))
            return super().predict(tiles)

    class Normaliser:
        def normalize(self, rgb):
            if rgb.mean() > 200:
                raise ValueError("too little stain")
            return np.minimum(rgb, 250)

    def seen(kind):
        n = os.path.getsize(f"{log}/{kind}") if os.path.exists(f"{log}/{kind}") else 0
        if n:
            os.remove(f"{log}/{kind}")
        return n

    s = stages.Settings(mask=masks.configured(guard_px=8, crop_px=4, edge_strip=8), mask_downsample=4.0, stride=96, read=64, tile=32, max_candidates=30, qc=select.QcThresholds(0.0, 0, 0, 1, 1, None, None), quotas=select.Quotas(20), cell=16, per_cell=1, tumor=gate.TumorGate(high=0.4, mid=0.2, topk=10, min_high=1, min_scored=1, min_ratio=0.0))
    slides_ = spark.createDataFrame([("s0", "/synthetic/0.svs"), ("s1", "/synthetic/1.svs")], "slide_uid string, path string")
    points = spark.createDataFrame(stages.candidates(stages.mask_stage(slides_, plugins.SyntheticSlide, s), s).collect())
    n = points.count()
    pool = spark.createDataFrame(stages.qc_stage(slides_, points, Slide, s).collect())
    assert seen("reads") == n == pool.count() > 20
    chosen, _ = stages.select_stage(slides_, pool, s)
    chosen = chosen.select("slide_uid", "patch_id", "x0", "y0", "x_mask", "y_mask").collect()
    cells = [(r["slide_uid"], r["x_mask"] // 16, r["y_mask"] // 16) for r in chosen]
    assert len(set(cells)) == len(cells) < len({(r["slide_uid"], r["x_mask"], r["y_mask"]) for r in pool.collect()})  # the cap cuts, in the mask's coordinates
    scored, gated = stages.tumor_stage(slides_, points.select("slide_uid", "patch_id", "x0", "y0"), Slide, Model, s, Normaliser)
    rows, own = scored.collect(), gated.collect()
    failed = [r for r in rows if r["error"]]
    assert seen("reads") == n and seen("tiles") == n - len(failed)
    assert failed and all(r["tumor_prob"] is None and r["error"].startswith("normalise") for r in failed)
    assert sum(r["norm_or_read_fail"] for r in own) == len(failed) and sum(r["scored_ok"] or 0 for r in own) == n - len(failed)
    assert R.augmented(np.zeros((4, 6, 3), np.uint8), 3).shape in ((4, 6, 3), (6, 4, 3))
    slide = plugins.SyntheticSlide("/synthetic/0.svs")
    assert plugins.read_around(slide, 0, 0, 0.25, 0.5, 32).shape == (32, 32, 3) == plugins.read_around(slide, 5, 9999, 9.0, 0.1, 32).shape
    assert (plugins.read_point(slide, 100, 90, 8, (4, 5)) == slide.read(100, 91, 0, 8, 8)).all()


def test_low_tissue_gets_a_second_look(spark):
    from dataclasses import replace

    from tesselon.operators import masks
    from tesselon.plans import stages
    from tesselon.sources import plugins

    slides_ = spark.createDataFrame([("s0", "/synthetic/0.svs"), ("bad", "/none/1.svs")], "slide_uid string, path string")

    def opened(path):
        if path.startswith("/none"):
            raise OSError("gone")
        return plugins.SyntheticSlide(path)

    c = masks.configured(guard_px=8, crop_px=4, edge_strip=8)
    low = stages.Settings(mask=replace(c, expected=(0.9, 0.99), expected_effective=(0.9, 0.99)), mask_downsample=4.0)
    rows = {r["slide_uid"]: r for r in stages.mask_stage(slides_, opened, low).collect()}
    assert rows["s0"]["roi_attempted"] and rows["s0"]["roi_used"] is not None and rows["s0"]["mask"] is not None
    assert rows["bad"]["mask_status"] == "read_error"
    rows = {r["slide_uid"]: r for r in stages.mask_stage(slides_, opened, stages.Settings(mask=replace(c, expected=(0.0, 1.0)), mask_downsample=4.0)).collect()}
    assert rows["s0"]["roi_attempted"] is False
