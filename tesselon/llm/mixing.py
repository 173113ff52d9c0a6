"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source's target repetition rate is its weight's share of the wanted rows over the rows that it has. Each document
draws how often it is repeated from a Poisson distribution of that mean, by inverting the distribution at a uniform value
hashed from seed, id and text. The draw is a function of the row alone: repeated runs, lost executors and any partitioning
give the same mix, and no source is gathered anywhere. Means over `step` are drawn as sums of equal smaller ones,
each with a hash of its own, so that exp(-mean) keeps its precision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

MOST_DRAW = 120  # for means of at most 16 the chance of a larger draw is under 1e-60, beyond what 52 bits can show
MOST_SOURCES = 100_000  # that are broadcast: some MB
_TWO52 = float(1 << 52)


def uniform(*parts: Column) -> Column:
    """A value in [0, 1) from the first 52 bits of the MD5 of the parts joined by colons; null parts count as empty."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(_TWO52)


def poisson(u: Column, mean: Column) -> Column:
    """The smallest k whose cumulative Poisson probability exceeds u."""
    first = F.struct(F.lit(0).alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("total"), F.lit(False).alias("done"))

    def step(s, k):
        done = s["done"] | (u < s["total"])
        p = s["p"] * mean / k
        return F.when(done, F.struct(s["k"].alias("k"), s["p"].alias("p"), s["total"].alias("total"), F.lit(True).alias("done"))).otherwise(
            F.struct(k.alias("k"), p.alias("p"), (s["total"] + p).alias("total"), F.lit(False).alias("done"))
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST_DRAW)), first, step, lambda s: s["k"])


def repetitions(key: Column, mean: Column, seed: int, step: float = 16.0) -> Column:
    """How often a row is repeated: a Poisson draw of the mean, null or non-positive means give 0."""
    parts = F.greatest(F.ceil(mean / step), F.lit(1)).cast("int")
    small = mean / parts
    drawn = F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda n, j: n + poisson(uniform(F.lit(str(seed)), key, j), small))
    return F.when(mean > 0, drawn).otherwise(F.lit(0))


def target_rates(docs: DataFrame, weights: dict[str, float] | None, rows: float | None, source_col: str = "source") -> DataFrame:
    """(source, rate) for each source that docs has; null is a source like others.

    weights: by source name, others get none; None gives all sources the same. rows: wanted in all, as many as there are
    by default. Weights of sources without documents are spread over the others.
    """
    have = docs.groupBy(F.col(source_col).alias("mix_source")).agg(F.count("*").alias("have"))
    if weights is None:
        have = have.withColumn("weight", F.lit(1.0))
    else:
        named = F.create_map(*(F.lit(x) for k, w in weights.items() for x in (k, float(w)))) if weights else None
        have = have.withColumn("weight", F.coalesce(named[F.col("mix_source")], F.lit(0.0)) if weights else F.lit(0.0))
    total = have.agg(F.sum("weight").alias("all_weight"), F.sum("have").alias("all_have"))
    wanted = F.lit(float(rows)) if rows is not None else F.col("all_have").cast("double")
    return have.join(F.broadcast(total)).select("mix_source", F.when(F.col("all_weight") > 0, F.col("weight") / F.col("all_weight") * wanted / F.col("have")).otherwise(F.lit(0.0)).alias("mix_rate"))


def mix_sources(
    docs: DataFrame, weights: dict[str, float] | None = None, rows: float | None = None, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", copy_col: str | None = "copy", order_col: str | None = "mix_key"
) -> DataFrame:
    """Each row as often as drawn, in a global random order, with the columns of docs and the two named ones.

    copy_col numbers the copies of a row from 1, order_col is the hash that the result is in order of; None leaves a column
    out. Columns of these names in docs are replaced, whatever their case; any other names are free to docs. Rows that
    repeat id and text are drawn alike and all repeated. Rows with null id or text are drawn by what they have, texts of any
    length by their digest. No rows give none.

    Rows are dealt by the hash itself, each partition a range of it, which needs no sample of what is drawn.
    """
    replaced = {c.lower() for c in (copy_col, order_col) if c}
    cols = [c for c in docs.columns if c.lower() not in replaced]
    if missing := {c.lower() for c in (id_col, text_col, source_col)} - {c.lower() for c in cols}:
        raise ValueError(f"columns {sorted(missing)} are missing or named like a column of the result")
    taken = {c.lower() for c in (*cols, copy_col or "", order_col or "")}

    def free(name: str) -> str:
        while name in taken:
            name += "_"
        return name

    source, rate, key, n, copy, order, part = map(free, ("mix_source", "mix_rate", "mix_id", "mix_n", "mix_copy", "mix_order", "mix_part"))
    rates, _ = written(target_rates(docs, weights, rows, source_col).toDF(source, rate), "rates")
    if rates.count() <= MOST_SOURCES:  # beyond that the join shuffles, and adaptive execution splits hot sources
        rates = F.broadcast(rates)

    def col(name):
        return F.col(f"`{name}`")

    out = docs.select(*map(col, cols)).join(rates, col(source_col).eqNullSafe(col(source)))
    out = out.withColumn(key, F.concat_ws(":", F.coalesce(col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(col(text_col).cast("string"), F.lit("")))))
    out = out.withColumn(n, repetitions(col(key), col(rate), seed)).where(col(n) > 0)
    out = out.withColumn(copy, F.explode(F.sequence(F.lit(1), col(n))))
    out = out.withColumn(order, F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), col(key), col(copy).cast("string"))), 1, 15))
    own = [F.col(f"`{c}`") for c in cols] + [col(copy).cast("long").alias(copy), col(order)]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.select(*own, F.floor(F.conv(F.substring(col(order), 1, 8), 16, 10).cast("double") / float(1 << 32) * parts).cast("int").alias(part))
    out = out.repartitionById(parts, col(part)).sortWithinPartitions(order)
    more = [col(c).alias(name) for c, name in ((copy, copy_col), (order, order_col)) if name]
    return out.select(*map(col, cols), *more)


def mix_sql(documents: str = "documents", seed: int = 17) -> str:
    """mix_sources with its defaults in DuckDB SQL."""
    return f"""
WITH RECURSIVE have AS (SELECT source, count(*) AS n FROM {documents} GROUP BY source),
rates AS (SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM have) * (SELECT sum(n) FROM have)::DOUBLE / n AS rate FROM have),
keyed AS (SELECT d.*, coalesce(d.doc_id::VARCHAR, '') || ':' || md5(coalesce(d.text, '')) AS k, r.rate, greatest(ceil(r.rate / 16.0), 1)::INT AS parts
  FROM {documents} d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
steps AS (SELECT DISTINCT rate / parts AS mean FROM keyed),
cdf AS (SELECT mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS total FROM steps
  UNION ALL SELECT mean, k + 1, p * mean / (k + 1), total + p * mean / (k + 1) FROM cdf WHERE k < {MOST_DRAW}),
tables AS (SELECT mean, list(total ORDER BY k) AS totals FROM cdf GROUP BY mean),
drawn AS (SELECT keyed.*, list_sum(list_transform(range(1, parts + 1), lambda j: least({MOST_DRAW}, len(list_filter(t.totals,
    lambda c: ('0x' || substr(md5('{seed}:' || k || ':' || j), 1, 13))::BIGINT::DOUBLE / {_TWO52:.1f} >= c)))))::INT AS times
  FROM keyed JOIN tables t ON keyed.rate / keyed.parts = t.mean)
SELECT doc_id, text, lang, source, n_chars, copy, substr(md5('{seed}:order:' || k || ':' || copy), 1, 15) AS mix_key
FROM (SELECT *, unnest(range(1, times + 1)) AS copy FROM drawn WHERE times > 0)"""
