"""Document fingerprints by SimHash.

The terms of a text are its words and its pairs of neighbouring words, whatever its length; a term that occurs c times
weighs 1 + ln c. Each term's hash votes with its weight on every bit of the fingerprint. Weights are whole numbers of
sixteenths, so that sums are exact and equal texts have equal fingerprints everywhere.

Fingerprints within a Hamming radius are found by permuted block tables: the bits are cut into radius + agree blocks, and
two fingerprints within the radius agree in `agree` blocks at least, whose table brings them together. What a table brings
together is compared before anything else is built on it (see ties.py).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import map_arrow, written

RADIUS = 8  # bits that near fingerprints may differ in, of 256


def fingerprints(texts: list[str], bits: int = 256):
    """A row of bits // 8 bytes for each text; all 0 for texts without words."""
    import numpy as np

    from .words import hashed_words, mixed, run_hashes

    lanes = bits // 64
    out = np.zeros((len(texts), bits // 8), np.uint8)
    if not texts:
        return out
    data = [t.encode("utf-8", "replace") for t in texts]
    cut = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
    starts, _, words = hashed_words(np.frombuffer(b"\n".join(data) + b"\n", np.uint8))
    pairs = run_hashes(words, 2)
    at = np.searchsorted(starts, cut)
    salt = mixed(np.arange(1, lanes + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))

    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        if a == b:
            continue
        terms, times = (np.concatenate(x) for x in zip(*(np.unique(t, return_counts=True) for t in (words[a:b], pairs[a : b - 1]))))
        weights = np.rint(16 * (1 + np.log(times))).astype(np.float32)
        votes = np.zeros(bits, np.float64)
        for k in range(0, len(terms), 4096):
            h = mixed(terms[k : k + 4096, None] ^ salt[None, :])
            w = weights[k : k + 4096]
            on = np.unpackbits(h.view(np.uint8).reshape(len(w), -1), axis=1).astype(np.float32)
            votes += 2.0 * (w @ on).astype(np.float64) - float(w.sum(dtype=np.float64))
        out[i] = np.packbits(votes > 0)
    return out


def likeness(a, b):
    """The share of equal bits of each pair of rows."""
    import numpy as np

    return 1.0 - np.unpackbits(a ^ b, axis=1).sum(1) / (8.0 * a.shape[1])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 256, fp_col: str = "fingerprint") -> DataFrame:
    """One row per input row: id and fingerprint (hex). Null, empty and blank texts give 0s, texts of any length are taken
    whole, repeated rows and null ids stay as they are. Other columns are not read.
    """

    def run(batches):
        import pyarrow as pa

        from .words import texts

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                fps = fingerprints([t or "" for t in texts(part.column(1))], bits)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([f.tobytes().hex() for f in fps], pa.string())], ["id", "fp"])

    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(given, run, "id long, fp string").select(F.col("id").alias(id_col), F.col("fp").alias(fp_col))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following one, or all of that."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_ROW = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids, texts, nexts, bits):
    import hashlib

    import pyarrow as pa

    made = [edited(t, x) for t, x in zip(texts, nexts)]
    fps = fingerprints([*texts, nexts[-1]], bits) if all(a is b for a, b in zip(texts[1:], nexts)) else None
    own, after = (fps[:-1], fps[1:]) if fps is not None else (fingerprints(texts, bits), fingerprints(nexts, bits))
    changed = fingerprints(made, bits)
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in made]),
        pa.array([f.tobytes().hex() for f in own]),
        pa.array([f.tobytes().hex() for f in changed]),
        pa.array(likeness(own, changed)),
        pa.array(likeness(own, after)),
    ]


_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 256) -> DataFrame:
    """Each document with its edited text and with the next document, by descending id (ties: text); the first follows the last.

    The documents are range-partitioned once; each task compares the rows it holds, and only the first and last row of
    each partition, at most two a partition, meet again to be compared across partitions. Null texts count as empty,
    null ids come last. One document alone follows itself. Repeated rows follow one another, no rows give none. Texts of
    any length are taken whole; bytes that are no UTF-8 become U+FFFD. Other columns are not read.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = given.repartitionByRange(n, F.desc_nulls_last("id")).sortWithinPartitions(F.desc_nulls_last("id"), "text")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from .words import texts as strings

        pid, last = TaskContext.get().partitionId(), None

        def out(ids, texts, nexts):
            return pa.RecordBatch.from_arrays([*_compared(ids, texts, nexts, bits), *(pa.nulls(len(ids), t) for t in (pa.int64(), pa.string(), pa.string()))], [*_NAMES, "pid", "side", "text"])

        def edge(row, side):
            return pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), *(pa.nulls(1, t) for t in (pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)), pa.array([pid], pa.int64()), pa.array([side]), pa.array([row[1]])], [*_NAMES, "pid", "side", "text"])

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = list(zip(part.column(0).to_pylist(), strings(part.column(1))))
                if last is None:
                    yield edge(rows[0], "first")
                else:
                    rows.insert(0, last)
                last = rows[-1]
                if len(rows) > 1:
                    texts = [r[1] for r in rows]
                    yield out([r[0] for r in rows[:-1]], texts[:-1], texts[1:])
        if last is not None:
            yield edge(last, "last")

    def ends(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                ids, texts, nexts = (c.to_pylist() for c in b.columns)
                yield pa.RecordBatch.from_arrays(_compared(ids, texts, nexts, bits), _NAMES)

    made, _ = written(map_arrow(ordered, run, _ROW + ", pid long, side string, text string"), "neighbours")
    firsts = made.where("side = 'first'").select("pid", F.col("text").alias("start"))
    lasts = made.where("side = 'last'").select("id", "pid", "text")
    # Two rows a partition: as many as there are partitions, whatever the size of the input.
    order = firsts.select("pid").withColumn("after", F.lead("pid").over(Window.orderBy("pid")))
    top = firsts.agg(F.min("pid").alias("top"))
    order = order.crossJoin(F.broadcast(top)).select("pid", F.coalesce("after", "top").alias("after"))
    seams = lasts.join(order, "pid").join(firsts.withColumnRenamed("pid", "after"), "after").select("id", "text", F.col("start").alias("next"))
    rows = made.where("side is null").select(*_NAMES).unionByName(map_arrow(seams, ends, _ROW))
    return rows.withColumnRenamed("id", id_col)


MOST_TABLES = 128


def agreeing(classes: int, radius: int, bits: int) -> int:
    """How many blocks a table's key holds: as few as give about a key to each fingerprint, within MOST_TABLES tables."""
    agree = 1
    while agree * bits / (radius + agree) < math.log2(max(2, classes)) and math.comb(radius + agree + 1, agree + 1) <= MOST_TABLES:
        agree += 1
    return agree


def table_keys(fps, radius: int, agree: int):
    """A key of each fingerprint (a row of bytes) for every choice of `agree` of radius + agree blocks of its bits.

    Two fingerprints within the radius differ in at most `radius` of the blocks, so they agree in all of some choice.
    """
    import itertools

    import numpy as np

    from .words import mixed

    bit = np.unpackbits(fps, axis=1)
    edges = np.linspace(0, bit.shape[1], radius + agree + 1).astype(int)
    blocks = []
    for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        h = np.full(len(fps), np.uint64(k + 1))
        for c in np.packbits(bit[:, lo:hi], axis=1).T:
            h = mixed(h ^ c.astype(np.uint64)) + np.uint64(k)
        blocks.append(h)
    out = []
    for t, chosen in enumerate(itertools.combinations(range(radius + agree), agree)):
        h = np.full(len(fps), np.uint64(t + 1))
        for k in chosen:
            h = mixed(h ^ blocks[k])
        out.append(h)
    return np.stack(out, axis=1)


def _signs(payload: list[bytes]):
    """Fingerprints as unit vectors of +-1: Hamming distances become angles."""
    import numpy as np

    bit = np.unpackbits(np.frombuffer(b"".join(payload), np.uint8).reshape(len(payload), -1), axis=1)
    return (2 * bit.astype(np.float32) - 1) / np.float32(math.sqrt(bit.shape[1]))


def near_fingerprints(fps: DataFrame, radius: int, id_col: str = "doc_id", fp_col: str = "fingerprint", agree: int | None = None, block_docs: int = 2048) -> DataFrame:
    """One row per input row: id, class_id (smallest id with an equal fingerprint), component_id and n_links, the number of
    other rows within the Hamming radius.

    All fingerprints (hex) have one length. Null fingerprints are linked with nothing, null ids get no component, repeated
    rows count once and are each returned; no rows give none. `agree`, which follows from the number of fingerprints unless
    given, changes the tables, not the result. Other columns are not read.
    """
    from .blocks import cluster_links
    from .ties import POST, Posts, tied

    given = fps.select(F.col(id_col).cast("long").alias("id"), F.col(fp_col).cast("string").alias("fp"))
    classes, _ = written(given.where("id is not null and fp is not null").distinct().groupBy("fp").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"), (4 * F.length("fp")).cast("long").alias("bits")), "classes")
    row = classes.agg(F.count("*").alias("n"), F.max("bits").alias("bits")).first()
    bits = row["bits"] or 64
    agree = agree or agreeing(row["n"], radius, bits)
    angle = math.acos(max(-1.0, 1 - 2 * radius / bits)) + 1e-4

    def tables(batches):
        import numpy as np

        out = Posts(angle, _signs)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                raw = [bytes.fromhex(x) for x in part.column(1).to_pylist()]
                fp = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
                yield from out.add(part.column(0).to_numpy(), table_keys(fp, radius, agree), np.zeros(len(raw)), raw)
        yield from out.flush()

    def alike(payload):
        x = _signs([bytes.fromhex(x) for x in payload.to_pylist()])
        return x @ x.T >= 1 - (2 * radius + 1) / bits

    reps = classes.select(F.col("class_id").alias("id"), "copies", F.lit(1).cast("long").alias("size"), F.col("fp").alias("p"))
    edges = tied(map_arrow(reps.select("id", "p"), tables, POST), angle, _signs)
    label = cluster_links(edges, reps.select("id", "copies", "size"), reps.select("id", "p"), alike, block_docs)
    out = given.join(classes.drop("bits").join(label, "class_id", "left"), "fp", "left")
    real = F.col("id").isNotNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(real, F.coalesce("class_id", "id")).alias("class_id"),
        F.when(real, F.coalesce("component", "class_id", "id")).alias("component_id"),
        F.when(real, F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def with_near(compared: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", fp_col: str = "fingerprint") -> DataFrame:
    """compared with near_component, the smallest id reachable over fingerprints within the radius, and n_near, the number of
    other rows within it. Rows without an id get none and 0.
    """
    rows, _ = written(compared, "compared")
    found = near_fingerprints(rows, radius, id_col, fp_col).where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min("component_id").alias("near_component"), F.max("n_links").alias("n_near"))
    out = rows.join(found, F.col(id_col) == F.col("__id"), "left").drop("__id")
    return out.withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
