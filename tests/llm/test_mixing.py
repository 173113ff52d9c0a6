import hashlib
import math
from collections import Counter

import pytest

pytest.importorskip("tesselon.llm")

from tesselon.llm.mixing import mix_sources, target_rates  # noqa: E402

SCHEMA = "doc_id long, text string, source string, copy string"


def drawn(key, mean, seed=17, step=16.0):
    """The draw in plain Python."""
    parts, n = max(1, math.ceil(mean / step)), 0
    for j in range(1, parts + 1):
        u = int(hashlib.md5(f"{seed}:{key}:{j}".encode()).hexdigest()[:13], 16) / 2**52
        m, k = mean / parts, 0
        p = total = math.exp(-m)
        while u >= total and k < 120:
            k += 1
            p *= m / k
            total += p
        n += k
    return n if mean > 0 else 0


def frame(spark, n=3000):
    return spark.createDataFrame([(i, f"t{i}", "hot" if i % 3 else f"s{i % 7}", "clash") for i in range(n)], SCHEMA)


def key(i, t):
    return f"{'' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}"


def test_every_draw_and_the_totals(spark):
    df = frame(spark)
    rates = {r["mix_source"]: r["mix_rate"] for r in target_rates(df, None, None).collect()}
    out = Counter(r["doc_id"] for r in mix_sources(df).collect())
    have = {r["doc_id"]: r for r in df.collect()}
    assert {i: n for i in have if (n := drawn(key(i, have[i]["text"]), rates[have[i]["source"]]))} == dict(out)
    by = Counter()
    for i, n in out.items():
        by[have[i]["source"]] += n
    want = 3000 / len(rates)
    assert all(abs(by[s] - want) < 5 * math.sqrt(want) for s in rates)


def test_large_means_are_split(spark):
    df = spark.createDataFrame([(i, "t", "rare", "c") for i in range(20)], SCHEMA)
    out = Counter(r["doc_id"] for r in mix_sources(df, {"rare": 1.0, "absent": 2.0}, rows=20_000).collect())
    assert dict(out) == {i: drawn(key(i, "t"), 1000.0) for i in range(20)}
    assert abs(sum(out.values()) - 20_000) < 5 * math.sqrt(20_000)


def test_order_is_global_and_the_same_each_time(spark):
    a = [(r["doc_id"], r["copy"], r["mix_key"]) for r in mix_sources(frame(spark)).collect()]
    b = [(r["doc_id"], r["copy"], r["mix_key"]) for r in mix_sources(frame(spark).repartition(5)).collect()]
    assert a == b and [x[2] for x in a] == sorted(x[2] for x in a)
    assert a != sorted(a)


def test_odd_rows(spark):
    rows = [(None, None, None, "c"), (1, "", "a", "c"), (2, "x" * 500_000, "a", "c"), (2, "x" * 500_000, "a", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mix_sources(df, rows=400).collect()
    n = Counter((r["doc_id"], r["source"]) for r in out)
    assert n[None, None] == drawn(key(None, None), 200.0)
    assert n[2, "a"] == 2 * drawn(key(2, "x" * 500_000), 200 / 3)
    assert mix_sources(df, {}).collect() == [] and mix_sources(df, {"none": 1.0}).collect() == []
    empty = spark.createDataFrame([], SCHEMA)
    assert mix_sources(empty).collect() == [] and mix_sources(empty).columns == [*empty.columns[:3], "copy", "mix_key"]


def test_more_sources_than_are_broadcast(spark, monkeypatch):
    from tesselon.llm import mixing

    want = [(r["doc_id"], r["copy"]) for r in mix_sources(frame(spark)).collect()]
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    assert [(r["doc_id"], r["copy"]) for r in mix_sources(frame(spark)).collect()] == want


def test_any_other_column_names_are_free(spark):
    names = ["mix_source", "mix_rate", "mix_id", "mix_n", "mix_copy", "mix_order", "mix_part", "MIX_KEY"]
    df = frame(spark, 200).select("doc_id", "text", "source", *(mix_col(n) for n in names))
    out = mix_sources(df)
    assert out.columns == ["doc_id", "text", "source", *names[:-1], "copy", "mix_key"]
    rows = out.collect()
    assert rows and all(r[n] == f"own {n} {r['doc_id']}" for r in rows for n in names[:-1])
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in mix_sources(frame(spark, 200)).collect())
    with pytest.raises(ValueError):
        mix_sources(df, copy_col="text")


def mix_col(name):
    from pyspark.sql import functions as F

    return F.concat(F.lit(f"own {name} "), F.col("doc_id").cast("string")).alias(name)
