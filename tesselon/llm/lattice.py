"""Embedding near-dedup by E8 lattice hashing.

Each table projects the unit vectors to 8 * blocks random dimensions and decodes each eight to the nearest point of the E8
lattice; these points and the table are a cell. A vector also probes the neighbouring cells that are nearest to it. Vectors
of a cell that are within the link's angle, with what rounding to bytes adds, are tied; hot cells are thinned to leaders
before they are shuffled (see ties.py). Ties are candidates only: inside their components all pairs are verified with the
cosine in double precision, tile by tile (see blocks.py).

How fine the cells are follows from the number of vectors (PLANS), so that a vector meets some hundred unrelated ones at
every size. Links are missed only where no table brings the two vectors together: pairs at a cosine of exactly 0.95 meet
with a measured chance of 0.985 or more in every plan, closer ones more often, and all links of a component count that any
chain of such meetings holds together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import cluster_links
from .shared import map_arrow, written
from .ties import POST, Posts, tied


@dataclass(frozen=True)
class Plan:
    """Up to how many vectors; blocks of eight dimensions, their scale, cells probed beside the own one, and tables."""

    most: float
    blocks: int
    scale: float
    probes: int
    tables: int


# Measured at a cosine of 0.95: the chance to meet, and unrelated vectors met as a share of all of them.
PLANS = (
    Plan(100_000, 2, 0.5, 4, 3),  # 0.986, 1.2e-3
    Plan(1_000_000, 2, 0.6, 4, 5),  # 0.995, 2.9e-4
    Plan(10_000_000, 3, 0.5, 4, 7),  # 0.990, 2.9e-5
    Plan(300_000_000, 3, 0.6, 8, 8),  # 0.990, 1.2e-6
    Plan(math.inf, 4, 0.6, 8, 15),  # 0.99, under 1e-7
)


def plan_for(vectors: int) -> Plan:
    return next(p for p in PLANS if vectors <= p.most)


def minimal_vectors():
    """The 240 shortest vectors of E8, doubled to whole numbers: two entries of +-2, or eight of +-1 with an even number of -1."""
    import itertools

    import numpy as np

    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((2, -2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in itertools.product((1, -1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(out, np.int64)


def nearest_e8(x):
    """The nearest point of E8 for each row, doubled to whole numbers: the better of the nearest points of D8 and of D8 + 1/2."""
    import numpy as np

    def d8(y):
        z = np.rint(y)
        odd = np.flatnonzero(z.sum(1) % 2 != 0)
        if len(odd):  # the coordinate that was rounded furthest goes the other way
            off = y[odd] - z[odd]
            k = np.abs(off).argmax(1)
            z[odd, k] += np.where(off[np.arange(len(odd)), k] >= 0, 1, -1)
        return z

    a, b = d8(x), d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.rint(2 * np.where(closer[:, None], a, b)).astype(np.int64)


def _lengths(column):
    """The vectors of an Arrow column in double precision, nulls in them as NaN, by length: rows of the column and their matrix."""
    import numpy as np

    flat = np.asarray(column.values.to_numpy(zero_copy_only=False), np.float64)
    ends = np.array(column.offsets)
    size = np.where(np.array(column.is_valid()), np.diff(ends), 0)
    out = {}
    for n in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == n)
        out[int(n)] = rows, flat[ends[rows][:, None] + np.arange(n)[None, :]]
    return out


def _unit(column):
    """Vectors of one length as unit rows in double precision, and which rows of the column they are, by length."""
    import numpy as np

    out = {}
    for n, (rows, x) in _lengths(column).items():
        with np.errstate(all="ignore"):
            good = np.isfinite(x).all(1)
            top = np.abs(np.where(good[:, None], x, 0)).max(1, initial=0)
            good &= top > 0
            x, rows = x[good] / top[good, None], rows[good]
            out[n] = rows, x / np.sqrt((x * x).sum(1))[:, None]
    return out


def _signed(whole: bool):
    """(id, sig) of each row, with p if whole: 128 bits of the numbers of a vector that can be compared, null for others.

    Whole rows come out only if they have a sig. Both zeros count as one.
    """

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                ids, column = part.column(0), part.column(1)
                known = np.array(ids.is_valid())
                sig = [None] * len(part)
                for rows, x in _lengths(column).values():
                    good = np.isfinite(x).all(1) & (x != 0).any(1) & known[rows]
                    for i, v in zip(rows[good].tolist(), x[good] + 0.0):
                        sig[i] = hashlib.blake2b(v.tobytes(), digest_size=16).digest()
                out = pa.RecordBatch.from_arrays([ids, pa.array(sig, pa.binary()), *([column] if whole else [])], ["id", "sig", "p"][: 2 + whole])
                yield out.filter(out.column(1).is_valid()) if whole else out

    return run


def unpacked(payload: list[bytes]):
    """Unit vectors of rows of signed bytes."""
    import numpy as np

    x = np.frombuffer(b"".join(payload), np.int8).reshape(len(payload), -1).astype(np.float32)
    return x / np.sqrt((x * x).sum(1))[:, None]


def cells(x, plan: Plan, seed: int):
    """The keys of the cells that each unit vector is in or probes, one row a vector."""
    import numpy as np

    from .words import mixed

    n, near = x.shape[1], minimal_vectors()
    y = (x @ (np.random.default_rng([seed, n]).normal(size=(n, plan.tables * plan.blocks * 8)) * plan.scale)).reshape(len(x), plan.tables, plan.blocks, 8)

    def key(points, t):
        h = np.full(len(points), np.uint64((n << 16) + t))
        for k in range(points.shape[1]):
            h = mixed(h ^ points[:, k].astype(np.uint64)) + np.uint64(k)
        return h

    out = np.zeros((len(x), plan.tables, 1 + plan.probes), np.uint64)
    for t in range(plan.tables):
        home = np.hstack([nearest_e8(y[:, t, k]) for k in range(plan.blocks)])
        out[:, t, 0] = key(home, t)
        # The nearest other cells: one block moves to the neighbour that is nearest to it.
        gap = np.hstack([((2 * y[:, t, k] - home[:, 8 * k : 8 * k + 8]) @ -near.T) * 2 + (near**2).sum(1) for k in range(plan.blocks)])
        best = np.argpartition(gap, plan.probes, axis=1)[:, : plan.probes]
        for p in range(plan.probes):
            moved = home.reshape(len(x), plan.blocks, 8).copy()
            moved[np.arange(len(x)), best[:, p] // len(near)] += near[best[:, p] % len(near)]
            out[:, t, 1 + p] = key(moved.reshape(len(x), -1), t)
    return out.reshape(len(x), -1)


def _posts(cosine: float, plan: Plan, seed: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        out = Posts(math.acos(min(1.0, cosine)), unpacked)
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                for rows, x in _unit(part.column(1)).values():
                    if not len(rows):
                        continue
                    small = np.rint(x * 127 / np.abs(x).max(1)[:, None]).astype(np.int8)
                    back = small / np.sqrt((small.astype(np.float64) ** 2).sum(1))[:, None]
                    rounding = 2 * np.arcsin(np.minimum(np.sqrt(((x - back) ** 2).sum(1)) / 2, 1)) + 1e-5
                    yield from out.add(part.column(0).take(pa.array(rows)).to_numpy(), cells(x, plan, seed), rounding, [v.tobytes() for v in small])
        yield from out.flush()

    return run


def _alike(cosine: float):
    def product(column):
        import numpy as np

        m = len(column)
        out = np.zeros((m, m), bool)
        for rows, x in _unit(column).values():
            out[np.ix_(rows, rows)] = x @ x.T >= cosine
        return out

    return product


def near_vectors(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", plan: Plan | None = None, seed: int = 5, block_docs: int = 512) -> DataFrame:
    """One row per input row: id, n_links (other vectors linked directly), component_id, kept (it is its own component).

    Vectors that are null, empty, zero or hold null or non-finite numbers are linked with nothing, and only vectors of one
    length are compared, long ones too. Rows with a null id have no links and no component and are kept. Rows that repeat
    an id are one vector if they are equal; each row is returned. Equal vectors are one class that takes part once. The
    plan follows from the number of classes unless one is given; plans are measured for a cosine of 0.95 and find closer
    pairs more often. Other columns are not read, so their names cannot clash.
    """
    kind = vectors.schema[vector_col].dataType.simpleString()
    vector = F.col(vector_col) if kind in ("array<float>", "array<double>") else F.col(vector_col).cast("array<double>")
    given = vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("p"))
    signed, _ = written(map_arrow(given, _signed(False), "id long, sig binary"), "signed")
    classes, _ = written(signed.where("sig is not null").select("sig", "id").distinct().groupBy("sig").agg(F.min("id").alias("class_id"), F.count("*").alias("copies")), "classes")
    plan = plan or plan_for(classes.count())
    reps = map_arrow(given, _signed(True), f"id long, sig binary, p {given.schema['p'].dataType.simpleString()}").join(classes, "sig").where("id = class_id").select("id", "p")
    if classes.agg(F.sum("copies")).first()[0] != signed.where("sig is not null").count():  # rows that repeat an id and its vector
        reps = reps.dropDuplicates(["id", "p"])
    edges = tied(map_arrow(reps, _posts(cosine, plan, seed), POST), math.acos(min(1.0, cosine)), unpacked)
    sizes = classes.groupBy(F.col("class_id").alias("id")).agg(F.max("copies").alias("copies")).withColumn("size", F.lit(1).cast("long"))
    label = cluster_links(edges, sizes, reps, _alike(cosine), block_docs)
    out = signed.join(classes.join(label, "class_id", "left"), "sig", "left")
    real = F.col("id").isNotNull()
    component = F.when(real, F.coalesce("component", "class_id", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(real, F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
