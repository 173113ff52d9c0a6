"""Queries: joins, upserts, set algebra, splits, discovery and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import ranks
from ..operators import gate, geo, split, summary
from ..sources import slides
from .base import LABELLED, PATCHES, PIXELS, labelled, patches, pixels, query, table

_RUNS = "runs AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY o_custkey)"
_GATED = f"""WITH {_RUNS}, gated AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'DigitalSlide_' ELSE 'S_' END || c_custkey AS slide_id, CASE WHEN c_custkey % 5 = 0 THEN 'nan' WHEN c_custkey % 7 = 0 THEN 'low_tissue' ELSE 'ok' END AS eff,
  CASE WHEN c_custkey % 2 = 0 THEN 'High_Tissue' ELSE 'mask_error' END AS g0, coalesce(n, 0) AS cand, coalesce(f, 0) AS qc FROM customer LEFT JOIN runs ON k = c_custkey),
marked AS (SELECT slide_id, lower(CASE WHEN eff = 'nan' THEN g0 ELSE eff END) AS status, cand, qc FROM gated),
final AS (SELECT *, status IN ('ok', 'high_tissue') AND cand >= 5 AND qc >= 2 AS pass FROM marked)"""


def _gated(spark, sf):
    k = F.col("c_custkey")
    masks = table(spark, sf, "customer").select(
        k.cast("string").alias("slide_uid"),
        F.concat(F.when(k % 3 == 0, "DigitalSlide_").otherwise("S_"), k.cast("string")).alias("slide_id"),
        F.when(k % 5 == 0, "nan").when(k % 7 == 0, "low_tissue").otherwise("ok").alias("mask_status_effective"),
        F.when(k % 2 == 0, "High_Tissue").otherwise("mask_error").alias("mask_status"),
    )
    runs = table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("slide_uid")).agg(F.count("*").alias("candidates_after_mask"), F.count_if(F.col("o_orderstatus") == "F").alias("qc_pass"))
    return gate.gated_slides(masks, runs, _SLIDE_GATE)


_SLIDE_GATE = gate.SlideGate(min_candidates=5, min_qc_pass=2, dataset_rate=0.3, subset_rate=0.3)


@query(_GATED + " SELECT slide_id, status AS status_for_gate, cand AS candidates_after_mask, qc AS qc_pass, pass AS slide_pass FROM final")
def q_gate_left_join(spark, sf):
    return _gated(spark, sf).select("slide_id", "status_for_gate", "candidates_after_mask", "qc_pass", "slide_pass")


@query(_GATED + """, t AS (SELECT count(*) AS n, count(*) FILTER (pass) AS p, count(*) FILTER (starts_with(slide_id, 'DigitalSlide')) AS s, count(*) FILTER (pass AND starts_with(slide_id, 'DigitalSlide')) AS sp FROM final)
SELECT n AS n_total, p AS n_pass, s AS n_subset, sp AS n_subset_pass, ceil(0.3::DOUBLE * n)::BIGINT AS required, ceil(0.3::DOUBLE * s)::BIGINT AS required_subset, p >= ceil(0.3::DOUBLE * n) AND sp >= ceil(0.3::DOUBLE * s) AS passed FROM t""")
def q_gate_totals(spark, sf):
    return gate.gate_totals(_gated(spark, sf), _SLIDE_GATE)


@query("""WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE 'U' || o_custkey END AS uid, 'I' || o_custkey AS id FROM orders),
t AS (SELECT 'U' || c_custkey AS uid, 'I' || c_custkey AS id, c_mktsegment AS status, c_nationkey AS n FROM customer WHERE c_custkey % 5 <> 0)
SELECT k AS o_orderkey, coalesce(a.status, b.status) AS status, coalesce(a.n, b.n) AS n, coalesce(nullif(trim(s.uid), ''), trim(s.id)) AS key FROM s LEFT JOIN t a ON a.uid = trim(s.uid) LEFT JOIN t b ON b.id = s.id""")
def q_key_fallback_join(spark, sf):
    """Diagnostics by uid, else by id."""
    k = F.col("o_custkey").cast("string")
    s = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise(F.concat(F.lit("U"), k)).alias("slide_uid"), F.concat(F.lit("I"), k).alias("slide_id"))
    c = F.col("c_custkey").cast("string")
    t = table(spark, sf, "customer").where("c_custkey % 5 <> 0").select(F.concat(F.lit("U"), c).alias("slide_uid"), F.concat(F.lit("I"), c).alias("slide_id"), F.col("c_mktsegment").alias("status"), F.col("c_nationkey").alias("n"))
    return gate.lookup(s, t, ["status", "n"]).select("o_orderkey", "status", "n", C.slide_key("slide_uid", "slide_id").alias("key"))


@query("""WITH i AS (SELECT p_name AS stem, min(p_brand) AS path FROM part GROUP BY p_name), w AS (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' x' WHEN 2 THEN substr(p_name, 1, 5) ELSE 'none ' || p_partkey % 3 END AS name FROM part),
m AS (SELECT name, path, stem, CASE WHEN stem = name THEN 0 ELSE 1 END AS k FROM w JOIN i ON stem = name OR starts_with(stem, name) OR starts_with(name, stem))
SELECT w.name, stem, path FROM w LEFT JOIN (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY name ORDER BY k, stem) = 1) b ON b.name = w.name""")
def q_fuzzy_prefix_join(spark, sf):
    p = table(spark, sf, "part")
    index = p.groupBy(F.col("p_name").alias("stem")).agg(F.min("p_brand").alias("path"))
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.col("p_name")).when(k == 1, F.concat("p_name", F.lit(" x"))).when(k == 2, F.substring("p_name", 1, 5)).otherwise(F.concat(F.lit("none "), (F.col("p_partkey") % 3).cast("string")))
    return slides.found_slides(p.select(name.alias("name")).distinct(), index, "name").select("name", "stem", "path")


@query("""WITH s AS (SELECT 'c' || o_orderkey % 7 AS center, o_custkey AS id, 'u' || o_orderkey AS uid FROM orders), n AS (SELECT center, id, count(*) AS n, min(uid) AS uid FROM s GROUP BY ALL)
SELECT 'c' || c_custkey % 7 AS center, c_custkey::VARCHAR AS slide_id, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE '' END AS reason, CASE WHEN n = 1 THEN uid END AS slide_uid
FROM customer LEFT JOIN n ON n.id = c_custkey AND n.center = 'c' || c_custkey % 7""")
def q_unique_key_join_reason(spark, sf):
    def center(c):
        return F.concat(F.lit("c"), (F.col(c) % 7).cast("string")).alias("center")
    s = table(spark, sf, "orders").select(center("o_orderkey"), F.col("o_custkey").cast("string").alias("slide_id"), F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("slide_uid"))
    rows = table(spark, sf, "customer").select(center("c_custkey"), F.col("c_custkey").cast("string").alias("slide_id"))
    return slides.legacy_keys(rows, s).select("center", "slide_id", "reason", "slide_uid")


@query("""WITH s AS (SELECT s_suppkey AS slide, CAST(20 + s_suppkey % 17 AS INT) AS w, CAST(15 + s_suppkey % 11 AS INT) AS h, (1 << (s_suppkey % 6))::DOUBLE AS ds FROM supplier),
t AS (SELECT *, CASE WHEN ds <= 16 THEN greatest(4, CAST(floor(greatest(4, CAST(round_even(96.0::DOUBLE / ds, 0) AS INT)) / 2) AS INT)) ELSE greatest(4, CAST(round_even(96.0::DOUBLE / ds, 0) AS INT)) END AS step FROM s)
SELECT slide, step, y, x, CAST(round_even(x * ds, 0) AS INT) AS x0, CAST(round_even(y * ds, 0) AS INT) AS y0 FROM (SELECT *, unnest(range(0, h, step))::INT AS y FROM t) a, LATERAL (SELECT unnest(range(0, a.w, a.step))::INT AS x) b""")
def q_candidate_grid(spark, sf):
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier").select(k.alias("slide"), (F.lit(20) + k % 17).cast("int").alias("w"), (F.lit(15) + k % 11).cast("int").alias("h"), F.pow(F.lit(2.0), k % 6).alias("ds"))
    g = geo.grid(s.withColumn("step", C.grid_step(F.lit(96.0), "ds")), "w", "h", "step")
    return g.select("slide", "step", "y", "x", C.to_level0("x", "ds").alias("x0"), C.to_level0("y", "ds").alias("y0"))


_MASK = f"{PIXELS}, mask AS (SELECT img, y, x FROM pixels WHERE g < 150)"


def _mask(spark):
    return pixels(spark).where("g < 150").select("img", "y", "x")


@query(f"WITH {_MASK}, grid AS (SELECT i.img, y, x FROM (SELECT DISTINCT img FROM pixels) i, (SELECT unnest(range(0, 24, 3))::INT AS y), (SELECT unnest(range(0, 24, 3))::INT AS x)) SELECT img, y, x FROM grid SEMI JOIN mask USING (img, y, x)")
def q_mask_membership(spark, sf):
    g = geo.grid(pixels(spark).select("img").distinct().withColumns({"w": F.lit(24), "h": F.lit(24)}), "w", "h", 3)
    return geo.in_mask(g, _mask(spark), ["img", "y", "x"]).select("img", "y", "x")


@query(f"""WITH {_MASK}, grid AS (SELECT i.img, y, x FROM (SELECT DISTINCT img FROM pixels) i, (SELECT unnest(range(0, 24, 4))::INT AS y), (SELECT unnest(range(0, 24, 4))::INT AS x)),
d AS (SELECT g.img, g.y, g.x, count(m.x) / ((least(g.x + 3, 23) - greatest(g.x - 3, 0) + 1) * (least(g.y + 3, 23) - greatest(g.y - 3, 0) + 1)) AS d FROM grid g LEFT JOIN mask m ON m.img = g.img AND abs(m.x - g.x) <= 3 AND abs(m.y - g.y) <= 3 GROUP BY g.img, g.y, g.x)
SELECT img, y, x, round(d, 9) AS density FROM d WHERE d >= 0.1""")
def q_window_density(spark, sf):
    g = geo.grid(pixels(spark).select("img").distinct().withColumns({"width": F.lit(24), "height": F.lit(24)}), "width", "height", 4)
    return geo.window_density(g, _mask(spark), "img", 3, 0.1).select("img", "y", "x", F.round("density", 9).alias("density"))


_RINGS = {"a": [[[50, 10], [300, 10], [300, 80], [180, 40], [50, 80], [50, 10]], [[200, 20], [260, 20], [260, 35], [200, 35]]], "b": [[[0, 0], [120, 0], [0, 60]]]}


def _poly_sql(keep: str) -> str:
    tests = []
    for rings in _RINGS.values():
        parts = []
        for k, ring in enumerate(rings):
            e = list(zip(ring, ring[1:] + ring[:1]))
            odd = " + ".join(f"(CASE WHEN ({a[1]} > y) <> ({b[1]} > y) AND x < {b[0] - a[0]}::DOUBLE * (y - {a[1]}) / nullif({b[1] - a[1]}, 0) + {a[0]} THEN 1 ELSE 0 END)" for a, b in e)
            on = " OR ".join(f"({b[0] - a[0]} * (y - {a[1]}) = {b[1] - a[1]} * (x - {a[0]}) AND x BETWEEN {min(a[0], b[0])} AND {max(a[0], b[0])} AND y BETWEEN {min(a[1], b[1])} AND {max(a[1], b[1])})" for a, b in e)
            parts.append(f"(({odd}) % 2 = 1 AND NOT ({on}))" if k == 0 else f"NOT (({odd}) % 2 = 1 OR {on})")
        tests.append("(" + " AND ".join(parts) + ")")
    return f"WITH {PATCHES}, p AS (SELECT slide, patch, floor(value)::DOUBLE AS x, k::DOUBLE AS y FROM patches) SELECT slide, patch FROM p WHERE {keep} ({' OR '.join(tests)})"


def _polygons(spark, sf, how):
    text = "[" + ", ".join(f'{{"geometry": {{"type": "Polygon", "coordinates": {rings}}}, "properties": {{"name": "{n}"}}}}' for n, rings in _RINGS.items()) + "]"
    p = patches(spark, sf).select("slide", "patch", F.floor("value").cast("double").alias("x"), F.col("k").cast("double").alias("y"))
    polygons = geo.annotations(p.select("slide").distinct().withColumn("text", F.lit(text)), "text", ["slide"])
    return geo.points_in_polygons(p, polygons, ["slide"], how, cell=64).select("slide", "patch")


@query(_poly_sql(""))
def q_point_in_polygon(spark, sf):
    return _polygons(spark, sf, "left_semi")


@query(_poly_sql("NOT"))
def q_ignore_polygons(spark, sf):
    return _polygons(spark, sf, "left_anti")


@query("""SELECT * FROM (VALUES ('f', 'Tumor', 1, 4), ('f', 'other', 1, 3), ('g', 'list', 1, 3), ('g', 'list', 2, 3)) v(file, class_name, part, n_points)""")
def q_geojson_explode(spark, sf):
    """Polygons of a FeatureCollection and of a bare list, with the class from the nested property or the name."""
    a = '{"features": [{"geometry": {"type": "Polygon", "coordinates": [[[0,0],[1,0],[1,1],[0,0]]]}, "properties": {"name": "x", "classification": {"name": "Tumor"}}}, {"geometry": {"type": "Polygon", "coordinates": [[[0,0],[2,0],[2,2]]]}, "properties": {"name": "other"}}, {"geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {}}]}'
    b = '[{"geometry": {"type": "MultiPolygon", "coordinates": [[[[0,0],[1,0],[1,1]]], [[[5,5],[6,5],[6,6]]]]}, "properties": {"name": "list"}}]'
    files = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(n).alias("file"), F.lit(t).alias("text")) for n, t in (("f", a), ("g", b), ("h", "broken"))))).alias("v")).select("v.*")
    g = geo.annotations(files, "text", ["file"])
    return g.select("file", "class_name", (F.col("rings")[0][0][0] > 2).cast("int").alias("p"), F.size(F.col("rings")[0]).alias("n_points")).select("file", "class_name", (F.col("p") + 1).alias("part"), "n_points")


@query("""SELECT user_id, event_type, event_id, round(value, 6) AS v FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 2 DESC, event_id DESC) = 1""")
def q_upsert_keep_last(spark, sf):
    """Two runs merged, the later one's rows in the place of the earlier one's; of a run's rows of one key the last."""
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", F.round("value", 6).alias("v"))
    old, new = (e.where(F.col("event_id") % 2 == h) for h in (0, 1))
    return summary.upsert(old, new, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id", "v")


@query("SELECT md5(text) AS digest, min(doc_id) AS doc_id FROM documents GROUP BY ALL")
def q_keep_first(spark, sf):
    d = table(spark, sf, "documents").select(C.content_hash("text").alias("digest"), "doc_id")
    return ranks.keep_first(d, ["digest"], [F.col("doc_id")])


@query("SELECT o_orderkey, o_custkey, NULL::DOUBLE AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderkey % 2 = 1")
def q_union_missing_cols(spark, sf):
    o = table(spark, sf, "orders")
    return summary.union_all(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_totalprice"))


_HALVES = "a AS (SELECT md5(text) AS h FROM documents WHERE doc_id % 2 = 0), b AS (SELECT md5(text) AS h FROM documents WHERE doc_id % 2 = 1)"


def _halves(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", C.content_hash("text").alias("h"))
    return d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1")


@query(f"WITH {_HALVES} SELECT h FROM a INTERSECT SELECT h FROM b")
def q_hash_leak(spark, sf):
    return summary.overlap(*_halves(spark, sf), "h")


@query("SELECT source FROM documents WHERE doc_id // 7 % 2 = 0 INTERSECT SELECT source FROM documents WHERE doc_id // 7 % 2 = 1")
def q_intersect_leak(spark, sf):
    d = table(spark, sf, "documents").select("source", "doc_id")
    return summary.overlap(d.where("doc_id div 7 % 2 = 0"), d.where("doc_id div 7 % 2 = 1"), "source")


@query(f"WITH {_HALVES} SELECT h FROM a EXCEPT SELECT h FROM b")
def q_except(spark, sf):
    return summary.remaining(*_halves(spark, sf), "h")


@query("""WITH n AS (SELECT url, regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '//([^/]*)', 1), '[:.]', '-', 'g'), '_+', '_', 'g'), '-+', '-', 'g') AS new FROM pages)
SELECT new, count(DISTINCT url) AS n_names, min(url) AS first_name FROM n GROUP BY new HAVING count(DISTINCT url) > 1""")
def q_collisions(spark, sf):
    p = table(spark, sf, "pages").select("url", C.sanitize_stem(F.regexp_extract("url", "//([^/]*)", 1)).alias("new"))
    return summary.collisions(p, "url", "new")


@query(f"""WITH {LABELLED}, c AS (SELECT slide, count(*) AS n, avg(label) AS f, sum(label)::BIGINT AS p FROM labelled GROUP BY slide), s AS (SELECT *, CASE WHEN CAST(substr(slide, 4) AS INT) % 2 = 0 THEN 'even' ELSE 'odd' END AS part FROM c)
SELECT part, count(*) AS n_slides, sum(n)::BIGINT AS n_patches, round(avg(f), 9) AS mean_frac, round(min(f), 9) AS min_frac, round(max(f), 9) AS max_frac, sum(p)::BIGINT AS n_pos, count(*) FILTER (f <= 0.8) AS n_low, count(*) FILTER (f > 0.8 AND f < 0.9) AS n_mid,
  count(*) FILTER (f >= 0.9) AS n_high, count(*) FILTER (p = n) AS n_pos_only, count(*) FILTER (p = 0) AS n_neg_only FROM s GROUP BY part""")
def q_two_level_mean(spark, sf):
    """The mean of slide means and slides by stratum of each part."""
    c = summary.label_composition(labelled(spark, sf), "slide", "label").withColumn("part", F.when(F.substring("slide", 4, 9).cast("int") % 2 == 0, "even").otherwise("odd"))
    return summary.split_summary(c, ["part"], 0.8, 0.9).withColumns({k: F.round(k, 9) for k in ("mean_frac", "min_frac", "max_frac")})


@query("""WITH p AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS pos FROM embeddings WHERE embedding IS NOT NULL), m AS (SELECT label, pos, round(avg(v), 6) AS v, count(*) AS n FROM p GROUP BY label, pos)
SELECT label, pos::INT AS pos, v, n AS n_patches FROM m""")
def q_mean_pool(spark, sf):
    pooled = summary.mean_pool(table(spark, sf, "embeddings"), ["label"], "embedding")
    return pooled.select("label", F.posexplode("mean_vector").alias("pos", "v"), "n_patches").withColumn("v", F.round("v", 6))


_SLIDES = f"""{LABELLED}, c AS (SELECT slide, round(avg(CASE WHEN n_chars > 2000 THEN label ELSE 0 END), 6) AS f FROM labelled GROUP BY slide)"""


@query(f"""WITH {_SLIDES}, o AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || slide), slide) AS r, CASE WHEN f <= 0.35 THEN 'low' WHEN f < 0.5 THEN 'mid' ELSE 'high' END AS band FROM c),
low AS (SELECT slide FROM o WHERE band = 'low' ORDER BY r LIMIT 2), n AS (SELECT greatest(1, least(CAST(round_even(count(*) * 0.4::DOUBLE, 0) AS INT), count(*) - 1)) AS val, (SELECT count(*) FROM low) AS got FROM o),
mid AS (SELECT slide FROM o, n WHERE band = 'mid' QUALIFY row_number() OVER (ORDER BY r) <= least(val - got, greatest(1, (val - got) // 2))),
rest AS (SELECT slide, row_number() OVER (ORDER BY CASE band WHEN 'high' THEN 1 WHEN 'mid' THEN 2 ELSE 3 END, r) AS k FROM o WHERE slide NOT IN (SELECT slide FROM low UNION ALL SELECT slide FROM mid)),
val AS (SELECT slide FROM low UNION ALL SELECT slide FROM mid UNION ALL SELECT slide FROM rest, n WHERE k <= val - got - (SELECT count(*) FROM mid))
SELECT slide, f AS tumor_frac, CASE WHEN slide IN (SELECT slide FROM val) THEN 'val' ELSE 'train' END AS part FROM o""")
def q_group_split(spark, sf):
    """A hard validation set without leaks: low slides first, some mid ones, then high ones."""
    c = labelled(spark, sf).groupBy("slide").agg(F.round(F.avg(F.when(F.col("n_chars") > 2000, F.col("label")).otherwise(0)), 6).alias("tumor_frac"))
    return split.hard_group_split(c, "slide", split.HardSplit(val_frac=0.4, low=0.35, high=0.5)).select("slide", "tumor_frac", "part")


@query("""WITH s AS (SELECT DISTINCT source AS slide FROM documents), o AS (SELECT slide, row_number() OVER (ORDER BY md5('9:' || slide), slide) AS r, count(*) OVER () AS n FROM s)
SELECT slide, CASE WHEN r <= greatest(1, least(ceil(n * 0.25::DOUBLE), n - 1)) THEN 'val' ELSE 'train' END AS part FROM o""")
def q_group_shuffle_split(spark, sf):
    s = table(spark, sf, "documents").select(F.col("source").alias("slide")).distinct()
    return split.group_shuffle_split(s, "slide", 0.25, 9).select("slide", "part")


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_slides FROM events GROUP BY event_type")
def q_status_counts(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_slides"))


@query("SELECT count(DISTINCT user_id) AS n_slides, count(DISTINCT event_type) AS n_centers, count(DISTINCT user_id || '/' || event_type) AS n_pairs FROM events")
def q_distinct_counts(spark, sf):
    return table(spark, sf, "events").agg(F.count_distinct("user_id").alias("n_slides"), F.count_distinct("event_type").alias("n_centers"), F.count_distinct(F.concat_ws("/", "user_id", "event_type")).alias("n_pairs"))


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 50 < 25 AND doc_id % 3 = 0 THEN 0 ELSE 1 END AS src FROM documents), m AS (SELECT doc_id % 50 AS slide, min(src) AS src FROM d GROUP BY 1)
SELECT d.doc_id % 50 AS slide, count(*) AS n, CASE m.src WHEN 0 THEN 'all' ELSE 'top' END AS source FROM d JOIN m ON m.slide = d.doc_id % 50 AND m.src = d.src GROUP BY d.doc_id % 50, m.src""")
def q_first_source(spark, sf):
    """Of each slide the rows of the first source that has it."""
    d = table(spark, sf, "documents").select((F.col("doc_id") % 50).alias("slide"), "doc_id")
    first = (F.col("doc_id") % 50 < 25) & (F.col("doc_id") % 3 == 0)
    a = d.where(first).withColumn("source", F.lit("all"))
    b = d.where(~first).withColumn("source", F.lit("top"))
    return slides.first_source([a, b], "slide").groupBy("slide", "source").agg(F.count("*").alias("n"))


@query("""WITH m AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'read_error' WHEN 1 THEN 'ok' ELSE NULL END AS s FROM customer WHERE c_custkey % 3 <> 0), s AS (SELECT c_custkey AS k FROM customer)
SELECT count(*) AS slides, count(*) FILTER (m.k IS NOT NULL AND coalesce(m.s, '') <> 'read_error') AS found, count(*) FILTER (m.s = 'read_error') AS known_failures, count(*) FILTER (m.k IS NULL) AS missing FROM s LEFT JOIN m USING (k)""")
def q_precheck(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(k.cast("string").alias("slide_uid"), k, F.when(k % 4 == 0, "read_error").when(k % 4 == 1, "ok").alias("mask_status"))
    return gate.precheck(c.select("slide_uid"), c.where("c_custkey % 3 <> 0"))


@query("""WITH s AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey % 3 * 10 END AS x, CASE WHEN c_custkey % 5 < 2 THEN 900 ELSE 1000 END AS w, c_custkey % 11 = 0 AS failed FROM customer)
SELECT x IS NOT NULL AS has_bounds, coalesce(x <> 0, FALSE) AS needs_shift, x IS NOT NULL AND w < 1000 AS bounds_smaller, failed, count(*) AS n FROM s GROUP BY ALL""")
def q_bounds_audit(spark, sf):
    """Slides by what their bounds are like."""
    k = F.col("c_custkey")
    s = table(spark, sf, "customer").select(
        F.lit(1000).alias("width"), F.lit(800).alias("height"), F.when(k % 4 != 0, k % 3 * 10).alias("bounds_x"), F.lit(0).alias("bounds_y"), F.when(k % 5 < 2, 900).otherwise(1000).alias("bounds_w"), F.lit(800).alias("bounds_h"),
        F.when(k % 11 == 0, "OSError").alias("error"),
    )
    return slides.bounds_audit(s)


@query("SELECT l_suppkey, l_orderkey, l_extendedprice FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_extendedprice FROM lineitem) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey) = 1")
def q_best_tile(spark, sf):
    """The best tile of each image, the first of equal ones."""
    t = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_extendedprice").distinct()
    return slides.best_tile(t, "l_suppkey", "l_extendedprice", "l_orderkey")
