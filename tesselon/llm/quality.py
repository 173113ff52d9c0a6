"""A quality classifier by hierarchical empirical Bayes.

A logistic model gives each document its evidence, from surface features and from a lexicon: the log-odds of good quality
of each of BUCKETS classes of words (by hash), counted over the labelled documents by grouped aggregation. A labelled
document's own lexical score comes from the other half of the labels, so that the model learns what the score is worth
for documents it has not seen. Grouped aggregation over all documents gives each
host (source) and each path of a host (source and language) its mean quality, shrunk towards the level above: a group
of n documents with mean m becomes (n m + k p) / (n + k), where p is the level above and k, the strength of that prior, is
estimated by moments from how much the groups differ. A document's posterior replaces the model's base rate by that of
its path. Sparse sites thus fall back to their host, and sparse hosts to the global prior.

The model is fitted on at most `max_labels` labelled rows, chosen by hash; all else covers all documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import dropped, map_arrow, written

FEATURES = ("log_words", "upper", "digits", "symbols", "pipes", "marks", "points", "high", "same_next", "distinct", "top", "runs", "word_length", "lines", "long_words", "lexical")
BUCKETS = 1 << 13  # classes of words in the lexicon
MOST_SITES = 100_000  # paths that are broadcast: at most some 10 MB
_SIGNS = {"symbols": b"#$%&*@^~=+<>{}[]\\/_", "pipes": b"|", "marks": b"!?", "points": b".,;:", "lines": b"\n", "digits": b"0123456789"}


def features(column, lexicon=None):
    """A float64 matrix of FEATURES for the rows of an Arrow string column, and the number of words of each.

    The lexical one is the mean log-odds of the distinct words in the lexicon (BUCKETS numbers), 0 without one.
    """
    import numpy as np

    from .words import hashed_words, joined, run_hashes

    parts, counts = [], []
    table = {k: np.isin(np.arange(256), list(v)) for k, v in _SIGNS.items()}
    code = np.arange(256)
    table |= {"up": (code >= 65) & (code <= 90), "low": (code >= 97) & (code <= 122), "high": code >= 128}
    for _, rows, buf, offsets in joined(column):
        starts, ends, words = hashed_words(buf)
        at = np.searchsorted(starts, offsets)
        n = np.diff(at)
        size = np.maximum(np.diff(offsets) - 1, 1)
        c = {k: np.add.reduceat(t[buf].astype(np.int64), offsets[:-1]) for k, t in table.items()}
        c["lines"] = c["lines"] - 1  # the joint
        w = np.maximum(n, 1)
        same = np.concatenate([[False], words[1:] == words[:-1]]) if len(words) else np.zeros(0, bool)
        same[at[:-1][n > 0]] = False
        total = np.concatenate([[0], np.cumsum(same)])
        length = np.concatenate([[0], np.cumsum(ends - starts)])
        big = np.concatenate([[0], np.cumsum(ends - starts > 24)])
        runs = run_hashes(words, 3)
        distinct, top, fresh, lexical = np.ones(len(rows)), np.zeros(len(rows)), np.ones(len(rows)), np.zeros(len(rows))
        for i in np.flatnonzero(n):
            own, times = np.unique(words[at[i] : at[i + 1]], return_counts=True)
            distinct[i], top[i] = len(times) / n[i], times.max() / n[i] if n[i] > 3 else 0
            if lexicon is not None:
                lexical[i] = lexicon[bucket(own)].mean()
            if n[i] > 3:
                fresh[i] = len(np.unique(runs[at[i] : at[i + 1] - 2])) / (n[i] - 2)
        x = [np.log1p(n), c["up"] / np.maximum(c["up"] + c["low"], 1), c["digits"] / size, np.minimum(c["symbols"] / w, 2), np.minimum(c["pipes"] / w, 1), np.minimum(c["marks"] / w, 2), np.minimum(c["points"] / w, 2), c["high"] / size]
        x += [(total[at[1:]] - total[at[:-1]]) / w, distinct, top, 1 - fresh, np.minimum((length[at[1:]] - length[at[:-1]]) / w, 30), np.minimum(c["lines"] / w, 1), (big[at[1:]] - big[at[:-1]]) / w, lexical]
        parts.append(np.stack(x, axis=1))
        counts.append(n)
    if not parts:
        return np.zeros((0, len(FEATURES))), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(counts)


def fit(x, y, penalty: float = 1.0, rounds: int = 50):
    """Weights for [1, x] of a logistic model by Newton steps, with x standardised inside; None without both classes."""
    import numpy as np

    if len(y) < 10 or y.min() == y.max():
        return None
    mean, sd = x.mean(0), x.std(0)
    sd[sd < 1e-9] = 1.0
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / sd, -8, 8)])
    ridge = np.full(z.shape[1], penalty)
    ridge[0] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * w
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), grad)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return mean.tolist(), sd.tolist(), w.tolist()


def bucket(words):
    """The lexicon's place for each word hash."""
    import numpy as np

    return (words >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64)


def _presence(batches):
    """(fold, y, bucket) once for each bucket that a labelled text has a word of; bucket -1 for the text itself."""
    import numpy as np
    import pyarrow as pa

    from .words import hashed_words, joined

    for b in batches:
        for first, rows, buf, offsets in joined(b.column(2)):
            starts, _, words = hashed_words(buf)
            at = np.searchsorted(starts, offsets)
            found = [np.concatenate([[-1], np.unique(bucket(words[p:q]))]) for p, q in zip(at[:-1], at[1:])]
            row = pa.array(np.repeat(np.arange(first, first + len(rows)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(np.concatenate(found))], ["fold", "y", "bucket"])


def log_odds(counts, smooth: float = 2.0):
    """The lexicon of counts, (BUCKETS + 1) by 2: labelled texts of each class that have a word of a bucket, and last all texts."""
    import numpy as np

    share = (counts[:-1] + smooth) / (counts[-1] + 2 * smooth)
    return np.log(share[:, 1]) - np.log(share[:, 0])


def _matrix(lexicons):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                for fold in (0, 1):
                    mine = part.filter(pa.array(part.column(0).to_numpy() == fold))
                    if mine.num_rows:
                        x, _ = features(mine.column(2), np.array(lexicons.value[1 - fold]))
                        yield pa.RecordBatch.from_arrays([mine.column(1), *(pa.array(c) for c in x.T)], ["y", *FEATURES])

    return run


def train(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """A model fitted on at most max_labels labelled documents, those of the smallest hash of their id; None if there are not both classes.

    Of the labels of one id the smallest counts, and of its texts the first in order, so that no more rows than that leave
    the grouped aggregation.
    """
    import numpy as np

    some = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).cast("double").alias("y"))
    some = some.orderBy(F.md5(F.col("__id").cast("string")), "__id").limit(max_labels)
    one = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    rows = one.join(F.broadcast(some), "__id").groupBy("__id").agg(F.min("y").alias("y"), F.min("__text").alias("__text"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("__id").cast("string")), F.lit(2)).cast("long")
    rows, path = written(rows.select(fold.alias("fold"), (F.col("y") > 0.5).cast("long").alias("y"), "__text"), "labelled")
    counts = np.zeros((2, BUCKETS + 1, 2))
    for r in map_arrow(rows, _presence, "fold long, y long, bucket long").groupBy("fold", "y", "bucket").agg(F.count("*").alias("n")).collect():  # 4 * (BUCKETS + 1) rows at most
        counts[r["fold"], r["bucket"], r["y"]] = r["n"]
    if not (counts[:, -1].sum(0) > 0).all():
        return None
    lexicons = docs.sparkSession.sparkContext.broadcast([log_odds(c).tolist() for c in counts])
    found = map_arrow(rows, _matrix(lexicons), "y long, " + ", ".join(f"{f} double" for f in FEATURES)).toArrow()
    dropped(docs.sparkSession, path)
    data = np.column_stack([found.column(i).to_numpy() for i in range(found.num_columns)]).astype(float)
    data = data[np.lexsort(data.T)]  # the same sums in whatever order the rows came
    model = fit(data[:, 1:], data[:, 0])
    return model and (*model, log_odds(counts.sum(0)).tolist())


def with_evidence(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """docs with two columns more: __logit, the model's log-odds of good quality (0 without a model), and __words."""
    from pyspark.sql import types as T

    at, names = docs.columns.index(text_col), [*docs.columns, "__logit", "__words"]
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        mean, sd, w, lexicon = (np.array(v) for v in given.value) if given.value else [None] * 4
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                text = part.column(at)
                x, n = features(text if pa.types.is_string(text.type) else text.cast(pa.string()), lexicon)
                logit = np.zeros(len(x))
                if w is not None:
                    logit = w[0] + np.clip((x - mean) / sd, -8, 8) @ w[1:]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.clip(logit, -30, 30)), pa.array(n)], names)

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField("__logit", T.DoubleType()), T.StructField("__words", T.LongType())]))


def _logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(safe / (1 - safe))


def _strength(groups: DataFrame, mean: str, above: str) -> float:
    """How many documents the prior of a level counts for: moments of the groups' means around the level above."""
    row = groups.agg(
        F.sum("n").alias("n"),
        F.count("*").alias("g"),
        F.sum(F.col("n") * (F.col(mean) - F.col(above)) ** 2).alias("spread"),
        F.sum(F.col("n") * F.col(above) * (1 - F.col(above))).alias("noise"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    ).first()
    if not row["n"] or row["g"] < 2:
        return 100.0
    within = row["noise"] / row["n"]
    between = (row["spread"] - (row["g"] - 1) * within) / max(1.0, row["n"] - row["squares"] / row["n"])
    return min(10_000.0, max(1.0, within / between - 1)) if between > 0 else 10_000.0


def sites(scored: DataFrame, host: str = "source", path: str = "lang") -> tuple[DataFrame, float]:
    """(host, path, host_posterior, path_posterior) for each path, and the global prior."""
    p = 1 / (1 + F.exp(-F.col("__logit")))
    paths, _ = written(scored.groupBy(F.col(host).alias("__host"), F.col(path).alias("__path")).agg(F.count("*").alias("n"), F.sum(F.round(p * 1e6).cast("long")).alias("s")), "paths")
    hosts = paths.groupBy("__host").agg(F.sum("n").alias("n"), (F.sum("s") / 1e6).alias("s"))
    whole = hosts.agg(F.sum("n"), F.sum("s")).first()
    prior = whole[1] / whole[0] if whole[0] else 0.5
    prior = min(1 - 1e-4, max(1e-4, prior))
    hosts = hosts.withColumn("m", F.col("s") / F.col("n")).withColumn("up", F.lit(prior))
    k = _strength(hosts, "m", "up")
    hosts = hosts.select(F.col("__host").alias("__h"), ((F.col("s") + k * prior) / (F.col("n") + k)).alias("host_posterior"))
    both = paths.join(hosts, F.col("__host").eqNullSafe(F.col("__h"))).drop("__h").withColumn("s", F.col("s") / 1e6).withColumn("m", F.col("s") / F.col("n"))
    both, _ = written(both, "sites")
    k = _strength(both, "m", "host_posterior")
    return both.select("__host", "__path", "host_posterior", ((F.col("s") + k * F.col("host_posterior")) / (F.col("n") + k)).alias("path_posterior")), prior


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labels: int = 20_000, id_col: str = "doc_id", text_col: str = "text", host: str = "source", path: str = "lang", label_col: str = "quality") -> DataFrame:
    """docs with evidence (log-odds), host_posterior, path_posterior, posterior and keep; columns of these names are replaced.

    Texts without words (null, empty, blank) are never kept. A null host or path is a group like others. Without labels of
    both classes the evidence is 0, and all texts with words are kept. Repeated rows are each scored, texts of any length
    whole, no rows give none. Of the labels of one id the smallest counts.
    """
    new = ("evidence", "host_posterior", "path_posterior", "posterior", "keep")
    own = docs.drop(*new, "__logit", "__words")
    model = train(own, labels, max_labels, id_col, text_col, label_col)
    slim = own.select(F.col(host).alias("__h1"), F.col(path).alias("__p1"), F.col(text_col).cast("string").alias("__t1"))
    table, prior = sites(with_evidence(slim, model, "__t1"), "__h1", "__p1")
    table, _ = written(table, "posteriors")
    small = table.count() <= MOST_SITES
    scored = with_evidence(own, model, text_col)
    table = F.broadcast(table) if small else table
    out = scored.join(table, scored[host].eqNullSafe(F.col("__host")) & scored[path].eqNullSafe(F.col("__path")))
    odds = F.col("__logit") + (_logit(F.col("path_posterior")) - math.log(prior / (1 - prior)) if model else F.lit(0.0))
    posterior = 1 / (1 + F.exp(-odds))
    keep = (F.col("__words") > 0) & (posterior >= threshold)
    return out.select(*(F.col(f"`{c}`") for c in own.columns), F.col("__logit").alias("evidence"), "host_posterior", "path_posterior", posterior.alias("posterior"), keep.alias("keep"))


def filtered(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str = "source", path: str = "lang", **more) -> DataFrame:
    """The rows of docs that classify keeps, with all columns of docs, whatever their names."""
    plain = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    known = labels.withColumnRenamed(id_col, plain[id_col])
    out = classify(docs.toDF(*plain.values()), known, id_col=plain[id_col], text_col=plain[text_col], host=plain[host], path=plain[path], **more)
    return out.where("keep").select(*(F.col(p).alias(c) for c, p in plain.items()))
