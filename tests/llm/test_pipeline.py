import hashlib
import re
from collections import Counter
from itertools import combinations

import pytest

pytest.importorskip("tesselon.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
P = pytest.importorskip("public_tokenizers")

from test_mixing import drawn, key  # noqa: E402
from test_quality import plain_classes  # noqa: E402
from test_secrets import plain_base  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_run_matches_plain_python(spark):
    import math

    from tesselon.llm import bpe

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = docs.collect()
    keep = plain_classes([(r["doc_id"], r["text"], r["source"], r["lang"]) for r in docs], {r["doc_id"]: r["quality"] for r in labels.collect()})
    kept = [r for r in docs if keep[r["doc_id"]][4]]
    sets = {r["doc_id"]: set(zip(*(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))[k:] for k in range(5)))) or {r["text"]} for r in kept}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            top[y] = x
    rows = []
    for r in kept:
        if find(r["doc_id"]) == r["doc_id"]:
            out, end = "", 0
            for _, a, b in plain_base(r["text"]):  # these texts assign no other literals
                if a >= end:
                    out += r["text"][end:a] + "[SECRET]"
                end = max(end, b)
            rows.append((r["doc_id"], out + r["text"][end:], r["source"]))
    have = Counter(s for _, _, s in rows)
    with open(P.path(corpus_pipeline.RANKS), "rb") as f:
        enc = bpe.encoding(f.read(), P.PATTERN)
    want = Counter()
    for i, t, s in rows:
        rate = 1.0 / len(have) * len(rows) / have[s]
        want[i, tuple(enc.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()] = drawn(key(i, t), rate)
    assert math.isclose(sum(want.values()), len(rows), rel_tol=0.5)
    got = Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want


def test_stages_keep_columns_and_rows_without_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "plain words that stay here", "en", "a", 26), (None, None, None, None, None), (2, "", "en", "a", 0), (3, "token = abcdef123", "en", "b", 17), (3, "token = abcdef123", "en", "b", 17)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(docs.collect(), schema)
        assert all("abcdef123" not in (r["text"] or "") for r in docs.collect())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def test_extra_columns_and_very_long_texts(spark):
    """Columns named like those that the operators make come through as they are."""
    names = ["evidence", "posterior", "keep", "component_id", "n_shingles", "spans", "mix_id", "mix_rate", "copy", "mix_key", "id", "s1"]
    long = " ".join(f"word{i}" for i in range(200_000)) + " token = abcdef123"
    docs = spark.createDataFrame([(1, long, "en", "a", len(long)), (2, long + " end", "en", "a", len(long) + 4), (3, "some plain words stay", "en", "b", 21)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", *(f"concat('own {n} ', doc_id) as {n}" for n in names))
    seen = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert all(r[n] == f"own {n} {r['doc_id']}" for r in rows for n in names)
        seen = spark.createDataFrame(rows, docs.schema)
    assert all("abcdef123" not in r["text"] for r in seen.collect())
