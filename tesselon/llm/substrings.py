"""Substring de-duplication with difference-cover anchors.

A window of `window` words is removed where its words also start in a document of smaller id. Hashing every window
of every document would move the corpus several times over. Instead only runs of `window - PERIOD + 1` words are hashed, and
only where their position modulo PERIOD is in COVER. Every difference of two positions is a difference of two members of
COVER, so any window found in two documents holds an anchor at the same place of both. Anchors of one document alone are
dropped, the others extend to all windows around them, and those are compared by 128-bit hashes of their words.

Hashes meet in compressed blobs, hot ones once a task (see meeting.py). Copies of whole documents have one signature and
take part once. What has met is written before the texts move, and the shuffle files of each step go with the step, so that
the disk holds one step's at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .meeting import SENT, Sender, buckets_for, met
from .shared import dropped, map_arrow, written

# A perfect difference cover.
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR_BITS = 48  # an anchor that meets another by chance only has its windows compared in vain


def _gathered(sent: DataFrame, later: bool, buckets: int) -> DataFrame:
    """(ref, hashes): the distinct hashes of each ref that have met; as many as its document holds at most."""
    return met(sent, later, buckets).select("ref", F.explode("hashes").alias("hash")).groupBy("ref").agg(F.collect_set("hash").alias("hashes"))


def word_table(column):
    """For groups of rows: (first row, texts, word hashes, first word of each text with one past the end)."""
    import numpy as np

    from .words import hashed_words, joined

    for first, rows, buf, offsets in joined(column):
        starts, ends, words = hashed_words(buf)
        yield first, rows, buf, (starts, ends, words), np.searchsorted(starts, offsets)


def signatures(words, at):
    """Two 64-bit hashes of each text's sequence of words."""
    import numpy as np

    from .words import mixed

    place = (np.arange(len(words)) - np.repeat(at[:-1], np.diff(at))).astype(np.uint64)
    out = []
    for odd in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(words + place * np.uint64(odd)))])
        out.append(mixed(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64))
    return out


def anchors(words, at, window: int):
    """Global word positions and ANCHOR_BITS hashes of the anchors of all texts of at least `window` words, and their text."""
    import numpy as np

    from .words import run_hashes

    n = np.diff(at)
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(words)) - at[:-1][doc]
    length = window - PERIOD + 1
    good = np.isin(place % PERIOD, COVER) & (place + length <= n[doc]) & (n[doc] >= window)
    pos = np.flatnonzero(good)
    return pos, run_hashes(words, length)[pos] >> np.uint64(64 - ANCHOR_BITS) if len(pos) else np.zeros(0, np.uint64), doc[pos]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, text_out: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 and, with text_out, the kept words joined by one space.

    Null, empty and blank texts have no words. Texts under `window` words lose none. Rows with a null id are left whole and
    take nothing from others. Rows of one id do not take from each other, repeated rows have the same result. Very long
    texts are taken whole, one at a time. Words are compared as they are, windows by 128-bit hashes. Other columns are not read, so their names cannot clash.
    """
    if window < PERIOD:
        raise ValueError(f"window must be at least {PERIOD}")
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def survey(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for b in batches:
            for first, rows, _, (_, _, words), at in word_table(b.column(1)):
                s1, s2 = signatures(words, at)
                sha = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in rows]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(rows)), pa.array(np.diff(at)), pa.array(s1), pa.array(s2), pa.array(sha)], ["id", "n", "s1", "s2", "sha"])

    table, _ = written(map_arrow(given, survey, "id long, n long, s1 long, s2 long, sha string"), "words", free=True)
    long_rows = table.where(F.col("id").isNotNull() & (F.col("n") >= window))
    classes, _ = written(long_rows.groupBy("s1", "s2", "n").agg(F.min("id").alias("class_id")), "classes", free=True)
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = buckets_for(int(total) * len(COVER) // PERIOD)

    def send_anchors(batches):
        import numpy as np

        out = Sender(buckets, ANCHOR_BITS, False)
        for b in batches:
            ids = b.column(0)
            for first, rows, _, (_, _, words), at in word_table(b.column(1)):
                s1, _ = signatures(words, at)
                s1 = np.where(np.array(ids.slice(first, len(rows)).is_valid()), s1, 0)
                _, h, doc = anchors(words, at, window)
                real = np.array(ids.slice(first, len(rows)).is_valid())[doc]
                yield from out.add(h[real], s1[doc][real])
        yield from out.flush()

    shared, at = written(_gathered(map_arrow(given, send_anchors, SENT), False, buckets).withColumnRenamed("ref", "s1"), "anchors", free=True)
    near = classes.join(shared.hint("merge"), "s1").select(F.col("class_id").alias("id"), "s1", "s2", "hashes")

    def extend(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids, s1s, s2s, cand = b.column(0), b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3)
            for first, rows, buf, (starts, ends, words), at in word_table(b.column(4)):
                own1, own2 = signatures(words, at)
                pos, h, doc = anchors(words, at, window)
                bound = np.searchsorted(doc, np.arange(len(rows) + 1))
                blobs, found, keep = [], [], []
                for i, text in enumerate(rows):
                    if own1[i] != s1s[first + i] or own2[i] != s2s[first + i]:
                        continue
                    p = pos[bound[i] : bound[i + 1]]
                    p = p[np.isin(h[bound[i] : bound[i + 1]], cand[first + i].values.to_numpy().view(np.uint64))]
                    starts_at = np.zeros(at[i + 1] - at[i] + 1, np.int64)
                    np.add.at(starts_at, np.maximum(p - at[i] - PERIOD + 1, 0), 1)
                    np.add.at(starts_at, np.minimum(p - at[i] + 1, at[i + 1] - at[i]), -1)
                    x = np.flatnonzero(np.cumsum(starts_at)[:-1] > 0)
                    x = x[x <= at[i + 1] - at[i] - window]
                    if len(x):
                        keep.append(first + i)
                        found.append(x)
                        blobs.append(pa.compress(text, codec="zstd", asbytes=True))
                if keep:
                    offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]), pa.int32())
                    part = pa.array(keep, pa.int64())
                    sizes = [len(rows[k - first]) for k in keep]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(part), b.column(1).take(part), b.column(2).take(part), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found), pa.int64()))],
                        ["id", "s1", "s2", "size", "blob", "windows"],
                    )

    wide = near.join(given, "id").select("id", "s1", "s2", "hashes", "text")
    held, _ = written(map_arrow(wide, extend, "id long, s1 long, s2 long, size long, blob binary, windows array<long>"), "windows", free=True)
    dropped(given.sparkSession, at)

    def send_windows(batches):
        import numpy as np
        import pyarrow as pa

        from .words import hashed_words, run_hashes

        out = Sender(buckets, 64, True)
        for b in batches:
            for i, size, blob, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                _, _, words = hashed_words(np.frombuffer(pa.decompress(blob, size, codec="zstd", asbytes=True), np.uint8))
                at = w.values.to_numpy()
                yield from out.add(run_hashes(words, window)[at], np.full(len(at), i, np.int64), run_hashes(words, window, 1)[at])
        yield from out.flush()

    repeated, _ = written(_gathered(map_arrow(held.select("id", "size", "blob", "windows"), send_windows, SENT), True, buckets).withColumnRenamed("ref", "id"), "repeated", free=True)

    def cut(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        from .words import hashed_words, run_hashes

        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                gone, sha, kept = [], [], []
                for size, blob, seen in zip(part.column(3).to_pylist(), part.column(4).to_pylist(), part.column(5)):
                    text = pa.decompress(blob, size, codec="zstd", asbytes=True)
                    starts, ends, words = hashed_words(np.frombuffer(text, np.uint8))
                    hit = np.flatnonzero(np.isin(run_hashes(words, window), seen.values.to_numpy().view(np.uint64)))
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, hit, 1)
                    np.add.at(cover, hit + window, -1)
                    stay = np.flatnonzero(np.cumsum(cover)[:-1] == 0)
                    left = b" ".join([text[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist())])
                    gone.append(len(words) - len(stay))
                    sha.append(hashlib.sha256(left).hexdigest())
                    kept.append(left.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(gone, pa.int64()), pa.array(sha), pa.array(kept if text_out else [None] * len(kept), pa.string())], ["id", "s1", "s2", "gone", "new_sha", "new_text"])

    changed = map_arrow(held.drop("windows").join(repeated.hint("merge"), "id").select("id", "s1", "s2", "size", "blob", "hashes"), cut, "id long, s1 long, s2 long, gone long, new_sha string, new_text string").dropDuplicates(["id", "s1", "s2"])
    out = table.join(classes, ["s1", "s2", "n"], "left").join(changed, ["id", "s1", "s2"], "left")
    copy = F.col("class_id") < F.col("id")
    none = F.lit("e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")  # the digest of nothing
    columns = [
        F.col("id").alias(id_col),
        F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, none).otherwise(F.coalesce("new_sha", "sha")).alias("kept_sha256"),
    ]
    if text_out:
        whole = F.trim(F.regexp_replace("text", "[\\x20\\x09-\\x0D]+", " "))
        out, columns = out.alias("o"), [*columns, F.when(copy, F.lit("")).otherwise(F.coalesce("new_text", "plain")).alias("kept")]
        plain = given.select(F.col("id").alias("pid"), F.coalesce(whole, F.lit("")).alias("plain"), F.sha2(F.coalesce(whole, F.lit("")), 256).alias("psha")).distinct()
        out = out.join(plain, F.col("id").eqNullSafe(F.col("pid")) & (F.col("sha") == F.col("psha")), "left")
    return out.select(*columns)
