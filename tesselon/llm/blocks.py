"""Links inside candidate clusters, counted tile by tile.

Candidate edges only say which documents may be linked: their components are the clusters. A cluster that is too large
for one task is cut into sides, by size where links need like sizes and by hash within a size; each pair of sides that
can hold a link is a tile, a task of its own. A tile compares its documents by one product and returns a spanning forest
of the links it found, and how many links each document has in it. So the rows that leave a tile are as many as its
documents, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import connected_components, dropped, map_arrow, written


LEAST, MOST_SIDES = 128, 8


def _forest(alike, order):
    """For each row the first row in `order` that it reaches over links."""
    import numpy as np

    root, todo = np.arange(len(alike)), np.ones(len(alike), bool)
    for i in order:
        if not todo[i]:
            continue
        reach = np.zeros(len(alike), bool)
        front = [i]
        reach[i] = True
        while len(front):
            new = alike[front].any(0) & ~reach
            reach |= new
            front = np.flatnonzero(new)
        root[reach] = i
        todo &= ~reach
    return root


def _tiles(alike: Callable):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, tile = [], None

        def done():
            ids, side, copies = (np.concatenate([h.column(c).to_numpy() for h in held]) for c in (3, 4, 5))
            if len(ids) < 2:
                return None
            found = alike(pa.chunked_array([h.column(6) for h in held]).combine_chunks())
            if len(np.unique(ids)) < len(ids):  # rows that repeat an id are one document
                ids, one, row = np.unique(ids, return_index=True, return_inverse=True)
                every, found = found, np.zeros((len(ids), len(ids)), bool)
                a, b = np.nonzero(every)
                found[row[a], row[b]] = True
                side, copies = side[one], copies[one]
            np.fill_diagonal(found, False)
            if tile[1] != tile[2]:
                found &= side[:, None] != side[None, :]
            links = np.concatenate([found[k : k + 256] @ copies for k in range(0, len(ids), 256)])
            hit = np.flatnonzero(links > 0)
            root = _forest(found, np.argsort(ids, kind="stable"))
            return pa.RecordBatch.from_pydict({"id": pa.array(ids[hit]), "root": pa.array(ids[root[hit]]), "n_links": pa.array(links[hit])})

        for b in batches:
            key = np.stack([b.column(c).to_numpy() for c in range(3)])
            heads = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist(), b.num_rows] if b.num_rows else [0]
            for lo, hi in zip(heads[:-1], heads[1:]):
                now = tuple(key[:, lo].tolist())
                if now != tile:
                    if held and (out := done()) is not None:
                        yield out
                    held, tile = [], now
                held.append(b.slice(lo, hi - lo))
        if held and (out := done()) is not None:
            yield out

    return run


def cluster_links(edges: DataFrame, reps: DataFrame, payload: DataFrame, alike: Callable, block_docs: int = 1024, block_size: int = 2_000_000, ratio: float | None = None) -> DataFrame:
    """(class_id, component, links) of every document with a link: the smallest id reachable, and its number of links.

    edges: candidate pairs (u, v); reps: (id, copies, size), one row per document, a link to it counts `copies` times;
    payload: (id, p), what `alike` compares: it gets an Arrow array of p and returns a square matrix of booleans.
    ratio: the smaller size of two linked documents is at least so much of the larger one; None: sizes don't matter.
    A tile holds at most about 2 * block_docs documents and 2 * block_size of summed size, or one document. Clusters of more
    than LEAST documents are cut into up to MOST_SIDES sides, so that those of some hundred don't wait for one task.
    """
    spark = edges.sparkSession
    near, candidates = written(edges, "candidates")
    blocks, forest = connected_components(near)
    dropped(spark, candidates)
    members = blocks.union(blocks.select(F.col("component").alias("node"), "component").distinct()).withColumnRenamed("node", "id").join(reps, "id")
    whole = members.groupBy("component").agg(((F.count("*") <= min(LEAST, block_docs)) & (F.sum("size") <= block_size)).alias("whole"))
    # Sizes of two linked documents fall into one band or two neighbouring ones; the bands are a little wider than needed.
    band = F.floor(F.log(F.greatest("size", F.lit(1)).cast("double")) / (1.0001 * math.log(1 / ratio))) if ratio else F.lit(0)
    members = members.join(whole, "component").withColumn("band", F.when(F.col("whole"), F.lit(0)).otherwise(band).cast("long"))
    cut = members.groupBy("component", "band").agg(F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("size") / block_size), F.least(F.ceil(F.count("*") / LEAST), F.lit(MOST_SIDES))).cast("long").alias("cuts"))
    cut, cuts = written(cut, "cuts")
    # The cuts of a band and of its neighbours, in one row.
    around = cut.select("component", F.explode(F.array(*(F.struct((F.col("band") + d).alias("band"), F.lit(d).alias("d")) for d in (-1, 0, 1)))).alias("b"), "cuts")
    around = around.groupBy("component", F.col("b.band").alias("band")).agg(*(F.coalesce(F.max(F.when(F.col("b.d") == d, F.col("cuts"))), F.lit(0)).alias(f"cuts{d}") for d in (-1, 0, 1)))
    tiled = members.join(around, ["component", "band"])

    def side(b, h):
        return b * (1 << 20) + h

    def sides(b, n):
        return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)) - 1), lambda h: side(b, h))).otherwise(F.array().cast("array<long>"))

    own = side(F.col("band"), F.pmod(F.xxhash64("id"), F.col("cuts0")))
    # cuts1 came from the band below, cuts-1 from the band above.
    others = F.concat(sides(F.col("band"), F.col("cuts0")), sides(F.col("band") - 1, F.col("cuts1")), sides(F.col("band") + 1, F.col("`cuts-1`")))
    tiled = tiled.withColumn("side", own).withColumn("other", F.explode(others))
    tiled = tiled.select("component", F.least("side", "other").alias("t1"), F.greatest("side", "other").alias("t2"), "id", "side", F.col("copies").cast("long").alias("copies"))
    work = tiled.join(payload, "id").select("component", "t1", "t2", "id", "side", "copies", "p")
    work = work.repartition("component", "t1", "t2").sortWithinPartitions("component", "t1", "t2", "id")
    found, _ = written(map_arrow(work, _tiles(alike), "id long, root long, n_links long"), "links")
    for path in (forest, cuts):
        dropped(spark, path)
    linked, _ = connected_components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    label = found.groupBy("id").agg(F.sum("n_links").alias("links")).join(linked.withColumnRenamed("node", "id"), "id", "left")
    return label.select(F.col("id").alias("class_id"), "component", "links")
