"""A corpus pipeline of the training-data operators: filter, de-duplicate, redact, mix, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Stages
read their input several times, so each is given a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselon.llm import bpe, mixing, ngram_join, quality, secrets
from tesselon.llm.shared import written

RANKS = "byte_bpe_50k.tiktoken"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps: none without words, else those whose posterior is 0.5 or more.

    Repeated rows are each judged, ties count as kept, null sources and languages are groups like others, rows without an id
    are judged too, no rows give none; columns of any name come through.
    """
    return quality.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest id, once.

    Rows without an id stay, as do null and empty texts, which are like no other; of rows with one id and text one stays;
    texts of any length are compared whole; no rows give none; columns of any name come through.
    """
    groups = ngram_join.ngram_jaccard_join(docs, n=5, num=80, den=100)
    stay = groups.where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(docs.where("doc_id is null"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of every secret of the whole text, and n_chars as it is then.

    Null and empty texts, repeated rows and columns of any name stay as they are; no rows give none.
    """
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """About as many rows as there are, each source with the same expected share of them, in a global random order.

    A null source is one like others; rows without id or text are drawn by what they have, repeated rows alike; texts of
    any length stay whole; no rows give none; columns of any name come through.
    """
    return mixing.mix_sources(docs, copy_col=None, order_col=None)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the whole text, their number, and the digest of the bytes that they decode to.

    Null and empty texts have no ids; repeated rows and rows without an id stay; no rows give none; other columns go.
    """
    import public_tokenizers

    how = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    tokens = bpe.bpe_decode(bpe.bpe_encode(docs, *how), *how)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", tokenise),
]

#: SQL can express neither the classifier nor the tokeniser; tests/llm/test_pipeline.py holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, _ = written(docs, f"stage{k + 1}")
    return docs
