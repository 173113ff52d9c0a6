"""Queries: names, casts, statuses, geometry and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources import slides
from .base import query, table

_SAN = "substr(CASE WHEN s = '' THEN 'item' ELSE s END, 1, {n})"


def _clean(x: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(replace(trim({x}), chr(92), '/'), '[^A-Za-z0-9._-]+', '_', 'g'), '_+', '_', 'g'), '^[._]+|[._]+$', '', 'g')"


_PATHS = """paths AS (SELECT page_id, 'center ' || (page_id % 3) AS center, '/data/center ' || (page_id % 3) AS center_root,
  '/data/center ' || (page_id % 3) || '/sub' || (page_id % 4) || '/' || regexp_extract(url, '//([^/]*)', 1) || CASE page_id % 4 WHEN 0 THEN '.svs' WHEN 1 THEN '.MRXS' WHEN 2 THEN '.png' ELSE '.tif' END AS path FROM pages),
stems AS (SELECT *, regexp_replace(substr(path, length(center_root) + 2), '\\.[^./]*$', '') AS rel, regexp_extract(path, '[^/]*$') AS file FROM paths)"""


def _paths(spark, sf):
    k = F.col("page_id")
    c = F.concat(F.lit("center "), (k % 3).cast("string"))
    suffix = F.when(k % 4 == 0, ".svs").when(k % 4 == 1, ".MRXS").when(k % 4 == 2, ".png").otherwise(".tif")
    path = F.concat(F.lit("/data/"), c, F.lit("/sub"), (k % 4).cast("string"), F.lit("/"), F.regexp_extract("url", "//([^/]*)", 1), suffix)
    return table(spark, sf, "pages").select("page_id", F.concat(F.lit("/data/"), c).alias("center_root"), path.alias("path"))


@query(f"""WITH {_PATHS}, u AS (SELECT *, regexp_replace(file, '\\.[^.]*$', '') AS id, {_clean('center')} AS cc, {_clean("regexp_extract(rel, '[^/]*$')")} AS ss FROM stems WHERE lower(regexp_extract(file, '\\.[^.]+$')) IN ('.svs', '.mrxs', '.tif')),
r AS (SELECT path, center, center_root, id AS slide_id, substr(CASE cc WHEN '' THEN 'item' ELSE cc END, 1, 40) || '__' || substr(CASE ss WHEN '' THEN 'item' ELSE ss END, 1, 80) || '__' || substr(sha1(center || '::' || rel), 1, 10) AS slide_uid, rel AS slide_relpath FROM u)
SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY slide_uid ORDER BY path) = 1""")
def q_slide_uid(spark, sf):
    """Slide records from paths: the first path of each uid."""
    return slides.slide_records(_paths(spark, sf))


@query(f"""WITH {_PATHS}, u AS (SELECT regexp_replace(file, '\\.[^.]*$', '') AS stem, path, CASE lower(regexp_extract(file, '\\.[^.]+$')) WHEN '.svs' THEN 0 WHEN '.mrxs' THEN 1 WHEN '.tif' THEN 3 END AS p FROM stems)
SELECT stem, path FROM u WHERE p IS NOT NULL QUALIFY row_number() OVER (PARTITION BY stem ORDER BY p, path) = 1""")
def q_slide_index(spark, sf):
    return slides.slide_index(_paths(spark, sf))


@query(f"WITH n AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), c AS (SELECT doc_id, {_clean('t')} AS s FROM n) SELECT doc_id, {_SAN.format(n=20)} AS part FROM c")
def q_sanitize(spark, sf):
    return table(spark, sf, "documents").select("doc_id", C.sanitize_part(F.coalesce("text", F.lit("")), 20).alias("part"))


_NAME = "'S' || l_orderkey || '__x' || l_partkey || '__y' || l_suppkey || '__mpp' || printf('%.3f', l_discount + 0.2) || '__r' || l_linenumber"


@query(f"WITH n AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount FROM lineitem) SELECT {_NAME} AS name FROM n")
def q_filename_format(spark, sf):
    n = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount").distinct()
    return n.select(C.patch_name(F.concat(F.lit("S"), F.col("l_orderkey").cast("string")), "l_partkey", "l_suppkey", F.col("l_discount") + 0.2, "l_linenumber").alias("name"))


@query(f"""WITH n AS (SELECT CASE l_linenumber WHEN 3 THEN 'broken__x' || l_partkey ELSE {_NAME} || '.png' END AS name FROM lineitem)
SELECT name, regexp_extract(name, '^(.*?)__x', 1) AS slide_id, try_cast(regexp_extract(name, '__x(-?\\d+)', 1) AS INT) AS x, try_cast(regexp_extract(name, '__y(-?\\d+)', 1) AS INT) AS y, try_cast(regexp_extract(name, '__mpp(\\d+(?:\\.\\d+)?)', 1) AS DOUBLE) AS mpp,
  try_cast(regexp_extract(name, '__r(\\d+)', 1) AS INT) AS read_px FROM n""")
def q_filename_parse(spark, sf):
    n = table(spark, sf, "lineitem")
    good = F.concat(C.patch_name(F.concat(F.lit("S"), F.col("l_orderkey").cast("string")), "l_partkey", "l_suppkey", F.col("l_discount") + 0.2, "l_linenumber"), F.lit(".png"))
    n = n.select(F.when(F.col("l_linenumber") == 3, F.concat(F.lit("broken__x"), F.col("l_partkey").cast("string"))).otherwise(good).alias("name"))
    return n.select("name", *(v.alias(k) for k, v in C.patch_name_parts("name").items()))


_TEXTS = ["1", "TRUE", " yes ", "no", "0", "f", "", "nan", "None", "abc", "12", " 7.9", "-3.5", "1e3", "ok,Bad , ,HIGH", "Ümlaut Header "]


@query("WITH t AS (SELECT unnest(range(16)) AS i, unnest([" + ", ".join(f"'{t}'" for t in _TEXTS) + """]) AS t), v AS (SELECT *, lower(trim(t)) AS s, try_cast(trim(t) AS DOUBLE) AS x FROM t)
SELECT i, s IN ('1', 'true', 't', 'yes', 'y') AS b, CASE WHEN s IN ('1', 'true', 't', 'yes', 'y') THEN TRUE WHEN s IN ('0', 'false', 'f', 'no', 'n') THEN FALSE END AS b3, CASE WHEN x IS NULL OR isnan(x) THEN -1 ELSE trunc(x)::BIGINT END AS n, CASE WHEN isnan(x) THEN NULL ELSE x END AS x,
  s IN ('', 'nan', 'none') AS gone, CASE WHEN s IN ('', 'nan', 'none') THEN 'fallback' ELSE trim(t) END AS status, CASE WHEN len(list_filter(string_split(t, ','), lambda p: trim(p) <> '')) = 0 THEN 'ok' ELSE array_to_string(list_filter(list_transform(string_split(t, ','), lambda p: lower(trim(p))), lambda p: p <> ''), '|') END AS statuses, s AS header FROM v""")
def q_tolerant_casts(spark, sf):
    t = spark.range(1).select(F.posexplode(F.array(*map(F.lit, _TEXTS))).alias("i", "t"))
    return t.select(
        F.col("i").cast("long").alias("i"), C.to_bool("t").alias("b"), C.to_bool_or("t").alias("b3"), C.to_int("t", -1).alias("n"), C.to_float("t").alias("x"), C.missing("t").alias("gone"),
        C.resolved_status("t", F.lit("fallback")).alias("status"), F.array_join(C.status_list("t"), "|").alias("statuses"), C.normalize_header("t").alias("header"),
    )


_PROPS = "l_orderkey % 7 AS k, l_quantity AS q, l_tax AS t"


@query("""WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_orderkey % 7 AS k, l_quantity AS q, l_tax AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, q, t, CASE WHEN k IN (0, 1) AND t > 0 THEN round(t / 2 + 0.125, 9) WHEN k IN (2, 3) AND t > 0 THEN round(t, 9) WHEN k <> 6 AND q >= 40 THEN 0.25 WHEN k <> 6 AND q >= 20 THEN 0.5 END AS mpp FROM l""")
def q_mpp_chain(spark, sf):
    """Microns a pixel from a map of properties."""
    k, q, t = F.col("l_orderkey") % 7, F.col("l_quantity"), F.col("l_tax")
    m = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", q.alias("q"), t.alias("t")).distinct()
    def s(c):
        return c.cast("string")
    props = F.map_from_entries(
        F.filter(
            F.array(
                F.struct(F.lit("openslide.mpp-x").alias("k"), F.when(k < 2, s(F.col("t"))).alias("v")),
                F.struct(F.lit("openslide.mpp-y").alias("k"), F.when(k < 2, F.lit("0.25")).alias("v")),
                F.struct(F.lit("aperio.MPP").alias("k"), F.when(k.isin(2, 3), s(F.col("t"))).alias("v")),
                F.struct(F.lit("openslide.objective-power").alias("k"), F.when(k < 5, s(F.col("q"))).alias("v")),
                F.struct(F.lit("aperio.AppMag").alias("k"), F.when(k == 5, s(F.col("q"))).alias("v")),
            ),
            lambda e: e["v"].isNotNull(),
        )
    )
    return m.select("l_orderkey", "l_linenumber", "q", "t", F.round(C.mpp(props), 9).alias("mpp"))


@query("""WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey % 300 - 20 AS x, l_suppkey * 3 AS y, CASE WHEN l_linenumber = 2 THEN NULL ELSE 400 + l_orderkey % 300 END AS w, 350 AS h FROM lineitem),
b AS (SELECT *, w IS NOT NULL AS ok FROM l), p AS (SELECT l_orderkey, l_linenumber, CASE WHEN ok THEN x ELSE 0 END AS x, CASE WHEN ok THEN y ELSE 0 END AS y, CASE WHEN ok THEN w ELSE 500 END AS w, CASE WHEN ok THEN h ELSE 420 END AS h FROM b)
SELECT l_orderkey, l_linenumber, x AS bx, y AS by, w AS bw, h AS bh, greatest(0, least(x, 500)) AS cx, greatest(0, least(y, 420)) AS cy, least(w, 500 - greatest(0, least(x, 500))) AS cw, least(h, 420 - greatest(0, least(y, 420))) AS ch FROM p""")
def q_bounds_detect(spark, sf):
    n = F.col("l_linenumber") == 2
    m = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 300 - 20).alias("x"), (F.col("l_suppkey") * 3).alias("y"), F.when(~n, F.lit(400) + F.col("l_orderkey") % 300).alias("w"), F.lit(350).cast("long").alias("h")
    ).distinct()
    cw, ch = F.lit(500).cast("long"), F.lit(420).cast("long")
    plain, inside = C.bounds("x", "y", "w", "h", cw, ch), C.bounds("x", "y", "w", "h", cw, ch, clamped=True)
    out = m.select("l_orderkey", "l_linenumber", *(c.alias(f"b{k}") for k, c in zip("xywh", plain)), *(c.alias(f"c{k}") for k, c in zip("xywh", inside)))
    return out.select("l_orderkey", "l_linenumber", *(F.col(c).cast("long").alias(c) for c in out.columns[2:]))


@query("""WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_discount + 0.2 AS mpp, l_partkey * 2 AS x, l_quantity::INT AS lo FROM lineitem), r AS (SELECT *, greatest(CAST(round_even(round(224.0::DOUBLE * 0.5 / mpp, 9), 0) AS INT), 224) AS px FROM l)
SELECT l_orderkey, l_linenumber, px, greatest(0, least(x, greatest(0, 3000 - px)))::INT AS x0, greatest(0, lo - greatest(8, CAST(round_even((70 - lo) * 0.05::DOUBLE, 0) AS INT)))::INT AS low, least(90, 70 + greatest(8, CAST(round_even((70 - lo) * 0.05::DOUBLE, 0) AS INT)))::INT AS high FROM r""")
def q_read_window(spark, sf):
    m = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") + 0.2).alias("mpp"), (F.col("l_partkey") * 2).alias("x"), F.col("l_quantity").cast("int").alias("lo")).distinct()
    px = F.greatest(F.bround(F.round(F.lit(224.0) * 0.5 / F.col("mpp"), 9)).cast("int"), F.lit(224))
    low, high = C.expanded("lo", F.lit(70), F.lit(90), 8, 0.05)
    return m.withColumn("px", px).select("l_orderkey", "l_linenumber", "px", C.clamp_origin("x", F.lit(3000), F.col("px")).cast("int").alias("x0"), low.cast("int").alias("low"), high.cast("int").alias("high"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity / 50 AS f, l_discount AS d, l_tax AS t, l_extendedprice / 100000 AS e FROM lineitem)
SELECT CASE WHEN f < 0.15 THEN 'low_tissue' WHEN f > 0.6 THEN 'high_tissue' ELSE 'ok' END AS status, f >= 0.75 OR e <= 0.15 OR l_linenumber = 1 AS sparse, (d >= 0.05 OR l_quantity_px >= 3000) AND f >= 0.4 AND t <= 0.04 AND NOT f > 0.6 AS accepted,
  greatest(0.15 - e, e - 0.6, 0) < greatest(0.15 - f, f - 0.6, 0) AS swap, CASE WHEN e >= 0.738 THEN 'high' WHEN e >= 0.5 THEN 'mid' ELSE 'low' END AS band, count(*) AS n FROM (SELECT *, f * 5000 AS l_quantity_px FROM l) GROUP BY ALL""")
def q_band_status(spark, sf):
    """Status by band, sparse canvas, accepted retries, the nearer of two masks and tumour bands."""
    rows = table(spark, sf, "lineitem").select("l_linenumber", (F.col("l_quantity") / 50).alias("f"), F.col("l_discount").alias("d"), F.col("l_tax").alias("t"), (F.col("l_extendedprice") / 100000).alias("e"))
    status = C.band_status("f", 0.15, 0.6)
    out = rows.select(
        status.alias("status"),
        C.sparse_canvas(F.when(F.col("l_linenumber") == 1, ".MRXS").otherwise(".svs"), "f", "e").alias("sparse"),
        C.retry_accepted("d", F.col("f") * 5000, "f", "t", status, min_gain=0.05, min_nonwhite=0.4, max_leak=0.04).alias("accepted"),
        (C.band_distance("e", 0.15, 0.6) < C.band_distance("f", 0.15, 0.6)).alias("swap"),
        C.tumor_band("e").alias("band"),
    )
    return out.groupBy("status", "sparse", "accepted", "swap", "band").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL), f AS (SELECT e AS q FROM a ORDER BY vec_id LIMIT 1)
SELECT vec_id, round(list_cosine_similarity(e, q), 6) AS cos, round(sqrt(list_dot_product(e, e)), 6) AS norm, round(e[2] * q[3] - e[3] * q[2], 6) AS cross_x FROM a, f""")
def q_vec_cosine(spark, sf):
    e = table(spark, sf, "embeddings").where("embedding is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    q = e.orderBy("vec_id").limit(1).select(F.col("e").alias("q"))
    return e.crossJoin(F.broadcast(q)).select("vec_id", F.round(C.cosine("e", "q"), 6).alias("cos"), F.round(C.norm("e"), 6).alias("norm"), F.round(C.cross("e", "q")[0], 6).alias("cross_x"))


@query("""WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice / 37) AS BIGINT) AS s FROM orders)
SELECT o_orderkey, CASE WHEN s >= 3600 THEN printf('%dh%02dm%02ds', s // 3600, s % 3600 // 60, s % 60) WHEN s >= 60 THEN printf('%dm%02ds', s // 60, s % 60) ELSE printf('%ds', s) END AS took FROM o""")
def q_duration_format(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.duration(F.floor(F.col("o_totalprice") / 37)).alias("took"))
