import hashlib
import random
import re

import pytest

pytest.importorskip("tesselon.llm")

SCHEMA = "doc_id long, text string, n_words string"


def brute(rows, window=13):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            first[x] = min(first.get(x, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def got(spark, rows, **more):
    from tesselon.llm.substrings import remove_repeats

    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA).repartition(5)
    return sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"]) for r in remove_repeats(df, **more).collect())


def corpus(seed, n=150):
    r = random.Random(seed)
    passages = [[f"p{k}w{i}é" for i in range(r.choice([12, 13, 14, 20, 60]))] for k in range(8)]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "x " * 40), (5, "x " * 60), (6, "x " * 12), (7, "x " * 13)]
    for i in range(n):
        w = [f"d{i}u{k}" for k in range(r.randrange(60))]
        for _ in range(r.randrange(3)):
            k = r.randrange(len(w) + 1)
            w[k:k] = r.choice(passages)[r.randrange(3) :]
        rows.append((100 + r.randrange(10_000) * 2, r.choice([" ", "\n", "  "]).join(w)))
    rows += [(50_000 + i, rows[i + 8][1]) for i in range(20)]
    return list({i: t for i, t in rows}.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    assert got(spark, rows) == brute(rows)


def test_small_flushes_and_other_windows(spark, monkeypatch):
    from tesselon.llm import meeting

    rows = corpus(3, 80)
    assert got(spark, rows, window=7) == brute(rows, 7)
    monkeypatch.setattr(meeting, "BUCKET", 5)
    assert got(spark, rows, window=20) == brute(rows, 20)


def test_words_that_collide_in_polynomials(spark):
    x, y = "a", "b"
    for _ in range(10):
        x, y = x + y, y + x
    start = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join([*start, x])), (2, " ".join([*start, y])), (3, " ".join([*start, x, y]))]
    assert got(spark, rows) == brute(rows)
    assert brute(rows)[1][2] == 0 and brute(rows)[2][2] == 13


def test_odd_rows(spark):
    from tesselon.llm.substrings import remove_repeats

    text = " ".join(f"w{i}" for i in range(30))
    long = " ".join(f"v{i}" for i in range(150_000))
    rows = [(5, text), (5, text), (None, text), (None, None), (4, "a " + text), (9, long), (10, "b " + long + " c")]
    out = remove_repeats(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA), text_out=False).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"]) for r in out) == [(-1, 0, 0), (-1, 30, 0), (4, 31, 0), (5, 30, 30), (5, 30, 30), (9, 150_000, 0), (10, 150_002, 150_000)]
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_steps_leave_no_shuffle_files(spark):
    """Once the texts' windows are written, what the steps before have shuffled is gone; the session's setting stays."""
    import os
    import time

    from tesselon.llm import shared, substrings

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return sum(f.length() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllFiles()) if os.path.basename(f.getPath()).startswith("shuffle_"))

    rows = corpus(4)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(5)
    before, was = spark.conf.get(key, None), shuffled()
    out = substrings.remove_repeats(df, text_out=False)
    until = time.time() + 20
    while shuffled() > was + 5_000 and time.time() < until:  # files go in the background; the few bytes of a sum may stay
        time.sleep(0.2)
    assert shuffled() <= was + 5_000 and spark.conf.get(key, None) == before
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out.collect()) == [x[:4] for x in brute(rows)]
    kept = spark.range(50).groupBy("id").count()
    assert shared.written(kept, "again", free=True)[0].count() == kept.count() == 50


@pytest.mark.parametrize("checked", [False, True])
def test_blobs_round_trip(checked):
    import numpy as np

    from tesselon.llm.meeting import packed, unpacked

    rng = np.random.default_rng(1)
    h, r = rng.integers(0, 1 << 48, 5000, dtype=np.uint64), rng.integers(-(1 << 62), 1 << 62, 5000)
    c = rng.integers(0, 1 << 62, 5000, dtype=np.uint64) if checked else None
    back = [unpacked(size, blob) for _, size, blob, _, _ in packed(h, r, c, 7, 48, False) if blob]
    assert sorted(zip(h.tolist(), r.tolist(), c.tolist() if checked else h.tolist())) == sorted((a, b, d) for x, z, y in back for a, b, d in zip(x.tolist(), y.tolist(), (z if checked else x).tolist()))


def test_equal_hashes_with_unlike_checks_do_not_meet():
    import numpy as np

    from tesselon.llm.meeting import packed

    h = np.array([5, 5, 5, 9, 9], np.uint64) << np.uint64(50)
    rows = list(packed(h, np.array([1, 2, 3, 4, 5]), np.array([7, 8, 7, 1, 1], np.uint64), 3, 64, True))
    assert sorted((r[3], [x >> 50 for x in r[4].tolist()]) for r in rows if r[2] is None) == [(3, [5]), (5, [9])]
