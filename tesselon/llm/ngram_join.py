"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself.

Documents whose n-gram sets have Jaccard likeness of at least num/den are linked. Equal sets collapse into one class
first, so copies never meet as pairs. Two size-derived bounds decide what is multiplied. A set of n grams of which more
than (1 - t) * n are in no other class cannot reach likeness t: such sets drop out, on the evidence of a sample of the
grams by hash and then once more on all of them, by counting those that no other class has. The blocks of the product
come from the second bound: a set's n - ceil(t * n) + 1 rarest grams hold one of every set that it is linked to (see
prefix()). Documents that share such a gram form a block; inside a block the overlap counts are accumulated over column
blocks of the incidence matrix, and pairs below the bound c >= t * (a + b - c) are discarded. Blocks over `block_grams` or
`block_docs` are cut into tiles (see blocks.py): output stays linear in the documents for groups of any size. No link is
missed and no partner or block is capped; sets are compared by 64-bit gram hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import cluster_links
from .meeting import SENT, buckets_for, met
from .shared import dropped, map_arrow, written

BITS = 48  # of the sampled grams: one that meets another by chance only keeps a set in for longer
MOST_HOT = 500_000  # frequent grams that are broadcast, 8 MB; any choice of them gives the same links


def gram_sets(column, n: int, fold: bool):
    """For groups of rows: (first row, list of sorted distinct gram hashes of each text).

    A text with fewer words than n has its whole word sequence as one gram; one without words has none.
    """
    import numpy as np

    from .words import hashed_words, joined, run_hashes

    for first, rows, buf, offsets in joined(column):
        starts, _, words = hashed_words(buf, fold)
        cut = np.searchsorted(starts, offsets)
        grams = run_hashes(words, n)
        sets = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if b - a >= n:
                g = np.sort(grams[a : b - n + 1])
                sets.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
            else:
                sets.append(run_hashes(words[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
        yield first, sets


def prefix(grams, num: int, den: int, hot, times):
    """The grams that a set meets others by: its n - ceil(t * n) + 1 rarest ones.

    Sets of likeness t share at least ceil(t * n) of either's grams, so if both are sorted by one order of all grams, their
    prefixes share one. Any order will do; the rarest come first, by the table of frequent grams (hot, sorted, and times).
    """
    import numpy as np

    n = len(grams)
    k = n - -(-num * n // den) + 1
    if not len(hot):
        return grams[:k]
    at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
    often = np.where(hot[at] == grams, times[at], 0)
    return grams[np.argsort(often, kind="stable")[:k]]  # the grams are sorted, which settles ties


def hot_grams(texts: DataFrame, n: int, fold: bool, most: int):
    """(grams, times): about the `most` grams that the most texts hold, sorted; others may be missing.

    Tasks count the grams of some thousand texts at a time and pass on those of two texts or more.
    """
    import numpy as np

    def count(batches):
        import pyarrow as pa

        held, size = [], 0

        def out():
            u, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(u[c > 1].view(np.int64)), pa.array(c[c > 1])], ["gram", "c"])

        for b in batches:
            for _, sets in gram_sets(b.column(0), n, fold):
                held += sets
                size += sum(map(len, sets))
                if size > 1_000_000:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    seen, path = written(map_arrow(texts.select("text"), count, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c")), "frequent")
    # The lowest of some hundred thresholds that not more than `most` grams reach.
    step = F.floor(F.log("c") * 8).cast("int")
    least, above = None, 0
    for row in sorted(seen.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["step"]):
        above += row["n"]
        if above > most:
            break
        least = row["step"]
    if least is None:
        dropped(texts.sparkSession, path)
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    top = seen.where(step >= least).toArrow()
    dropped(texts.sparkSession, path)
    grams, times = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy()
    order = np.argsort(grams)
    return grams[order], times[order]


def signature(grams):
    """Two 64-bit hashes of a set of gram hashes."""
    import numpy as np

    from .words import mixed

    if not len(grams):
        return 0, 0
    return int(mixed(grams + np.uint64(11)).sum().view(np.int64)), int(mixed(grams ^ np.uint64(0x2545F4914F6CDD1D)).sum().view(np.int64))


def _survey(n: int, fold: bool, per_mille: int):
    """(id, n, m, s1, s2) of each text: the sizes of its set and of the set's sample, and its signature."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for first, sets in gram_sets(b.column(1), n, fold):
                s1, s2 = zip(*map(signature, sets))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array([len(sampled(s, per_mille)) for s in sets], pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64())], ["id", "n", "m", "s1", "s2"])

    return run


def sampled(grams, per_mille: int):
    """The grams that the bound is tested on, as BITS-bit hashes."""
    import numpy as np

    return grams[(grams & np.uint64(0xFFFF)) % np.uint64(1000) < np.uint64(per_mille)] >> np.uint64(64 - BITS)


def _send(n: int, fold: bool, per_mille: int, buckets: int):
    def run(batches):
        import numpy as np

        from .meeting import Sender

        out = Sender(buckets, BITS, False)
        for b in batches:
            for first, sets in gram_sets(b.column(1), n, fold):
                real = np.array(b.column(0).slice(first, len(sets)).is_valid())
                for s, ok in zip(sets, real):
                    if ok and len(s):
                        g = sampled(s, per_mille)
                        yield from out.add(g, np.full(len(g), signature(s)[0], np.int64))
        yield from out.flush()

    return run


def _may_link(classes: DataFrame, texts: DataFrame, num: int, den: int, n: int, fold: bool, per_mille: int) -> DataFrame:
    """Those of the classes (with n, and m, the size of the sample) whose grams are not too often in no other class.

    A gram may be counted as common more than once, so a set may stay in for no reason, but none drops out for no reason.
    """
    buckets = buckets_for(classes.agg(F.sum("m")).first()[0] or 0)
    common = met(map_arrow(texts, _send(n, fold, per_mille, buckets), SENT), False, buckets).groupBy(F.col("ref").alias("s1")).agg(F.sum(F.size("hashes")).alias("common"))
    alone = F.col("m") - F.coalesce("common", F.lit(0))
    return classes.join(common, "s1", "left").where(den * (F.col("n") - alone) >= num * F.col("n")).drop("common")


def _keys(num: int, den: int, n: int, fold: bool, hot):
    """(id, n, copies, keys, text) of the texts that have the signature wanted of them."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            want = list(zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
            for first, sets in gram_sets(b.column(4), n, fold):
                take = [k for k, s in enumerate(sets) if signature(s) == want[first + k]]
                own = [sets[k] for k in take]
                each = [prefix(s, num, den, *hot.value) for s in own]
                keys, count = np.concatenate([np.zeros(0, np.uint64), *each]), [len(k) for k in each]
                rows = pa.array([first + k for k in take], pa.int64())
                offsets = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), pa.array([len(s) for s in own], pa.int64()), b.column(3).take(rows), pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64))), b.column(4).take(rows)],
                    ["id", "n", "copies", "keys", "text"],
                )

    return run


RARE = 48  # documents up to which a gram's pairs are counted one by one
PAIRS = 4_000_000  # that are counted at once


def overlaps(sets):
    """How many grams each two sets share: the incidence matrix times itself, summed over blocks of its columns.

    Columns of few documents are multiplied as lists of their pairs, the others as dense blocks.
    """
    import numpy as np

    m = len(sets)
    out = np.zeros((m, m), np.int32)
    grams, col = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(col, kind="stable")
    row, times = row[order], np.bincount(col, minlength=len(grams))
    start = np.cumsum(times) - times
    few = np.flatnonzero((times > 1) & (times <= RARE))
    pairs = np.cumsum(times[few] ** 2)
    at = 0
    while at < len(few):
        end = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + PAIRS, "right")))
        c, s = times[few[at:end]], start[few[at:end]]
        # Entry i of a column of c documents meets all c of them.
        first = np.repeat(s, c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        many = np.repeat(c, c)
        second = np.repeat(np.repeat(s, c), many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        out += np.bincount(np.repeat(row[first], many) * m + row[second], minlength=m * m).reshape(m, m).astype(np.int32)
        at = end
    often = np.flatnonzero(times > RARE)
    step = max(256, (1 << 22) // m)
    for at in range(0, len(often), step):
        part = often[at : at + step]
        x = np.zeros((m, len(part)), np.float32)
        c = times[part]
        entry = np.repeat(start[part], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        x[row[entry], np.repeat(np.arange(len(part)), c)] = 1
        out += (x @ x.T).astype(np.int32)
    return out


def _alike(num: int, den: int, n: int, fold: bool):
    """Whether the gram sets of texts are linked."""

    def product(texts):
        import numpy as np

        sets = [s for _, part in gram_sets(texts, n, fold) for s in part]
        size = np.array([len(s) for s in sets], np.int32)
        c = overlaps(sets)
        # den * c >= num * (a + b - c), a few rows at a time
        out = np.zeros(c.shape, bool)
        for k in range(0, len(size), 256):
            part = c[k : k + 256].astype(np.int64)
            out[k : k + 256] = (part > 0) & ((den + num) * part >= num * (size[k : k + 256, None].astype(np.int64) + size[None, :]))
        return out

    return product


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100, fold: bool = True, block_docs: int = 1024, block_grams: int = 2_000_000
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, class_id, n_links.

    component_id is the smallest id reachable by links (itself included), class_id the smallest id with the same gram
    set, n_links the number of other documents linked directly, copies among them. Texts that are null, empty or
    without words have no grams and are linked with nothing. Rows with a null id get a null component and no links.
    Rows that repeat an id are the same document if their grams are equal; each row is returned. Other columns are not
    read, so their names cannot clash.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    per_mille = min(1000, 2000 * (den - num) // den)
    feats, _ = written(map_arrow(given, _survey(n, fold, per_mille), "id long, n long, m long, s1 long, s2 long"), "grams")
    sets = feats.where("n > 0 and id is not null")
    classes, _ = written(sets.distinct().groupBy("s1", "s2", "n", "m").agg(F.min("id").alias("class_id"), F.count("*").alias("copies")), "classes")
    large = classes.where(F.col("n") * (den - num) >= num)  # smaller sets are linked to equal ones only
    may = _may_link(large, given, num, den, n, fold, per_mille)
    first, sampled_at = written(may.select(F.col("class_id").alias("id"), "s1", "s2", "n", "copies").join(given, "id"), "sampled")
    # Once more with all grams, among those that are left.
    some = first.select(F.col("id").alias("class_id"), "s1", "s2", "n", F.col("n").alias("m"), "copies").distinct()
    may = _may_link(some, first.select("id", "text"), num, den, n, fold, 1000)
    wide = may.select(F.col("class_id").alias("id"), "s1", "s2", "copies").join(first.select("id", "text"), "id").select("id", "s1", "s2", "copies", "text")
    hot = docs.sparkSession.sparkContext.broadcast(hot_grams(first, n, fold, MOST_HOT))
    docs_left, survivors = written(map_arrow(wide, _keys(num, den, n, fold, hot), "id long, n long, copies long, keys array<long>, text string"), "survivors")
    dropped(docs.sparkSession, sampled_at)
    posts = docs_left.select("id", F.explode("keys").alias("key"))
    lead = posts.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last").select("key", "lead")
    near = posts.join(lead, "key").where("id <> lead").select(F.col("id").alias("u"), F.col("lead").alias("v")).distinct()
    sizes = docs_left.groupBy("id").agg(F.max("copies").alias("copies"), F.max("n").alias("size"))
    label = cluster_links(near, sizes, docs_left.select("id", F.col("text").alias("p")), _alike(num, den, n, fold), block_docs, block_grams, num / den)
    dropped(docs.sparkSession, survivors)
    out = feats.select("id", "n", "s1", "s2").join(classes.drop("m").join(label, "class_id", "left"), ["s1", "s2", "n"], "left")
    real = F.col("id").isNotNull()
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(real, F.coalesce("component", "class_id", "id")).alias("component_id"),
        F.when(real, F.coalesce("class_id", "id")).alias("class_id"),
        F.when(real, F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )
