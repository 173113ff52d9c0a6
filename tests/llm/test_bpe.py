import hashlib

import pytest

pytest.importorskip("tesselon.llm")
P = pytest.importorskip("public_tokenizers")

from tesselon.llm import bpe  # noqa: E402

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def enc():
    with open(PATH, "rb") as f:
        return bpe.encoding(f.read(), P.PATTERN)


@pytest.mark.parametrize(
    "text",
    ["plain words, it's 12 o'clock\n\n  next", "  " * 12_000 + "end", "a" * 60_000, "x" * 30_000 + " " * 25_000, " " * 21_000 + "b" + "\n" * 30_000, "é 語 🙂 " * 5000, "ab12" * 9000, "word " * 9000 + "\u3000" * 20_001, "tab\t" * 8000, "'s't" * 8000],
)
def test_cut_texts_have_the_same_ids(enc, text):
    want = enc.encode_ordinary(text)
    assert bpe.encoded(enc, text, most=1000).tolist() == want
    assert bpe.encoded(enc, text).tolist() == want


def test_whitespace_that_the_library_alone_cannot_take(enc):
    text = "a" + " " * 3_000_000 + "b"
    ids = bpe.encoded(enc, text)
    assert enc.decode(ids.tolist()) == text


def test_digests(spark, enc):
    texts = [(1, "Hello  world <|endoftext|>"), (2, None), (3, ""), (3, ""), (None, "x" * 200_000), (4, "word é\n" * 50_000)]
    rows = bpe.digests(spark.createDataFrame([(i, t, "clash") for i, t in texts], "doc_id long, text string, ids string"), PATH, P.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in texts:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    key = lambda r: (r[0] or -1, r[1])
    assert sorted((tuple(r) for r in rows), key=key) == sorted(want, key=key)
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN).collect() == []


def test_decode_replaces_its_column_and_keeps_nulls(spark):
    df = spark.createDataFrame([(1, [31373], "a"), (2, None, "b"), (3, [], "c"), (4, [None, 31373], "d")], "doc_id long, ids array<int>, decoded string")
    assert {r["doc_id"]: r["decoded"] for r in bpe.bpe_decode(df, PATH, P.PATTERN).collect()} == {1: b"hello", 2: None, 3: b"", 4: b"hello"}


def test_a_large_vocabulary_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_BYTES", 10)
    with pytest.raises(ValueError):
        bpe.bpe_encode(spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN)


def test_other_patterns_are_not_cut(spark):
    import tiktoken

    assert P.PATTERN in bpe.CUT_SAFELY
    pattern = r"[a-z0-9 ]+|."
    with open(PATH, "rb") as f:
        own = bpe.encoding(f.read(), pattern)
    text = "ab1 " * 30_000 + " " * 30_000
    assert isinstance(own, tiktoken.Encoding)
    out = bpe.bpe_encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, pattern).first()["ids"]
    assert out == own.encode_ordinary(text)


def test_bytes_that_are_no_text(spark):
    """Every text operator takes them as U+FFFD."""
    from tesselon.llm.html import extract_text
    from tesselon.llm.ngram_join import ngram_jaccard_join
    from tesselon.llm.secrets import redacted, secret_scan
    from tesselon.llm.simhash import compare_neighbours, fingerprint_documents
    from tesselon.llm.substrings import remove_repeats

    df = spark.range(2).selectExpr("id as doc_id", "cast(unhex('70617373776F72643D616263646566FF20C3') as string) as text")
    text = "password=abcdef\ufffd \ufffd"
    assert {tuple(r) for r in bpe.digests(df, PATH, P.PATTERN).select("decoded_sha256").collect()} == {(hashlib.sha256(text.encode()).hexdigest(),)}
    assert [[(s["start"], s["end"]) for s in r["spans"]] for r in secret_scan(df).collect()] == [[(0, 15)]] * 2
    assert {r["text"] for r in redacted(df).collect()} == {"[SECRET]\ufffd \ufffd"}
    assert {r["text"] for r in extract_text(df.withColumnRenamed("text", "html").withColumnRenamed("doc_id", "page_id"), keep=("page_id",)).collect()} == {text}
    assert len({r["fingerprint"] for r in fingerprint_documents(df).collect()}) == 1 and {r["n_chars"] for r in compare_neighbours(df).collect()} == {18}
    assert {r["component_id"] for r in ngram_jaccard_join(df).collect()} == {0}
    assert {r["n_words"] for r in remove_repeats(df).collect()} == {2}
