"""Queries of the training-data operators over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, mixing


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of documents: 3-word shingles, Jaccard likeness of at least 0.9."""
    from .ngram_join import ngram_jaccard_join

    return ngram_jaccard_join(_table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article's text of every page."""
    from .html import extract_text

    return extract_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated so that each source has the same expected number of rows, in a global random order."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    from .secrets import digests

    return digests(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, their likeness, and the search for near ones."""
    from .simhash import compare_neighbours, with_near

    return with_near(compare_neighbours(_table(spark, sf_dir, "documents")))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence, site posteriors and the decision for every document."""
    from .quality import classify

    out = classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "source", "lang", "evidence", "host_posterior", "path_posterior", "posterior", "keep")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes that they decode to."""
    import public_tokenizers

    from .bpe import digests

    return digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts hold control strings, formatted and read back."""
    own = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))))).alias("t"))
    own = own.select(F.lit(-1).cast("long").alias("conv_id"), "t.turn", "t.role", F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digests(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own))


def _op8_sql() -> str:
    t = chat.INST
    slash, codes = t.codes()
    escaped = f"replace(text, '\\', '{slash}')"
    for code, control in zip(codes, t.controls, strict=True):
        escaped = f"replace({escaped}, '{control}', '{code}')"
    size = "".join(f"WHEN '{x.role}' THEN {len(x.opening) + len(x.closing)} " for x in t.turns)
    return f"""
WITH turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
sums AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length({escaped}) + CASE role {size}END)::BIGINT AS formatted_chars, string_agg(role, '>' ORDER BY turn, role, text) AS roles
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
  regexp_full_match(roles, '(system>)?user(>assistant>user)*(>assistant)?') AS valid FROM sums"""


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of embeddings: cosine of at least 0.95."""
    from .lattice import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.95)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 13-word windows that start in an earlier document."""
    from .substrings import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), window=13, text_out=False)


_OP1_SQL = """
WITH RECURSIVE texts AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM texts),
sizes AS (SELECT id, count(*) AS n FROM grams GROUP BY id),
sets AS (SELECT id, md5(string_agg(g, chr(10) ORDER BY g)) AS s FROM grams GROUP BY id),
nodes AS (SELECT min(id) AS id, s, count(*) AS copies FROM sets GROUP BY s),
own AS (SELECT g.id, g.g FROM grams g JOIN nodes USING (id)),
pairs AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM own a JOIN own b ON a.g = b.g AND a.id <> b.id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs p JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT id, id AS root FROM nodes UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.root = l.a),
roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
counts AS (SELECT l.a AS id, sum(n.copies) AS k FROM links l JOIN nodes n ON n.id = l.b GROUP BY l.a)
SELECT t.id AS doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(n.id, t.id) AS class_id, coalesce(r.root, t.id) AS component_id, (coalesce(n.copies, 1) - 1 + coalesce(c.k, 0))::BIGINT AS n_links
FROM texts t LEFT JOIN sizes z USING (id) LEFT JOIN sets s USING (id) LEFT JOIN nodes n ON n.s = s.s LEFT JOIN roots r ON r.id = n.id LEFT JOIN counts c ON c.id = n.id"""

_OP9_SQL = """
WITH RECURSIVE nodes AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (SELECT a.id AS a, b.id AS b FROM nodes a JOIN nodes b ON a.id <> b.id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT id, id AS root FROM nodes UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.root = l.a),
roots AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, component_id = id AS kept FROM roots"""

_OP10_SQL = """
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM texts WHERE len(w) >= 13),
keyed AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM windows),
firsts AS (SELECT k, min(doc_id) AS first FROM keyed GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM keyed JOIN firsts USING (k) WHERE first < doc_id),
each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM texts),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM texts t LEFT JOIN kept USING (doc_id)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_html_text,
        op3_mix_sources,
        op4_secret_scan,
        op5_simhash,
        op6_quality_classifier,
        op7_byte_bpe,
        op8_chat_formatting,
        op9_near_vectors,
        op10_substring_dedup,
    )
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": _OP1_SQL,
    "op3_mix_sources": mixing.mix_sql(),
    "op8_chat_formatting": _op8_sql(),
    "op9_near_vectors": _OP9_SQL,
    "op10_substring_dedup": _OP10_SQL,
}
