"""Finding hashes that several owners share, without moving them row by row.

Hashes travel as blobs: a task sorts what it has and sends each bucket of hashes as differences in compressed byte
planes, every hash once with its smallest owner. A bucket meets in one task, which finds by one sort which hashes several
owners have. Owners that meet inside a task are settled there, so that a hash which a third of all owners hold reaches its
bucket once a task. The number of buckets grows with the input, so that a bucket fits in memory. Where a chance meeting of
two 64-bit hashes would count, each goes with a second one, its check, and only pairs of both meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.shipping import map_arrow

FLUSH = 1_000_000  # hashes that a task sorts at once
BUCKET = 500_000  # hashes that meet in one bucket


def _runs(h, c, r):
    """The pairs sorted by hash, and by check where there is one, with the start of each run of equal ones."""
    import numpy as np

    order = np.argsort(h, kind="stable")
    h, r, c = h[order], r[order], None if c is None else c[order]
    head = np.concatenate([[True], h[1:] != h[:-1]])
    if c is not None and (~head[1:] & (c[1:] != c[:-1])).any():  # equal hashes with unlike checks: seldom
        order = np.lexsort((c, h))
        h, r, c = h[order], r[order], c[order]
        head = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
    return h, c, r, np.flatnonzero(head), np.cumsum(head) - 1


def packed(hashes, refs, checks, buckets: int, bits: int, later: bool):
    """What a task sends of its (hash, ref) pairs: rows (bucket, size, blob, ref, hashes).

    A hash goes to its bucket once, with its smallest ref. What several refs here settle already goes along as it is:
    (ref, hashes) that have met, with `later` only where a smaller ref is here.
    """
    import numpy as np
    import pyarrow as pa

    if not len(hashes):
        return
    h, c, r, heads, run_of = _runs(hashes, checks, refs)
    least = np.minimum.reduceat(r, heads)
    for ref, found in _by_ref(h, r, heads, run_of, least, later):
        yield int(ref % buckets), None, None, int(ref), found
    h, c, r = h[heads], None if c is None else c[heads], least
    bucket = (h >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for lo, hi in zip(heads, [*heads[1:], len(h)]):
        names, at = np.unique(r[lo:hi], return_inverse=True)
        steps = np.diff(h[lo:hi], prepend=np.uint64(0))
        gaps = np.diff(names.view(np.uint64), prepend=np.uint64(0))
        parts = [steps, gaps, at.astype(np.uint32), *([] if c is None else [c[lo:hi]])]
        planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in parts]
        raw = np.array([hi - lo, len(names), c is not None], np.int64).tobytes() + b"".join(planes)
        yield int(bucket[lo]), len(raw), pa.compress(raw, codec="zstd", asbytes=True), None, None


def _by_ref(h, r, heads, run_of, least, later: bool):
    """(ref, its hashes) of the pairs whose hash has another ref, with `later` a smaller one."""
    import numpy as np

    hit = r > least[run_of] if later else (np.maximum.reduceat(r, heads) > least)[run_of]
    h, r = h[hit], r[hit]
    order = np.argsort(r, kind="stable")
    h, r = h[order], r[order]
    heads = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]])) if len(r) else np.zeros(0, int)
    for lo, hi in zip(heads, [*heads[1:], len(r)]):
        yield r[lo], h[lo:hi].view(np.int64)


def unpacked(size: int, blob: bytes):
    """The hashes, checks (None without them) and refs of a blob."""
    import numpy as np
    import pyarrow as pa

    raw = pa.decompress(blob, size, codec="zstd", asbytes=True)
    n, m, checked = np.frombuffer(raw[:24], np.int64)
    at, out = 24, []
    for count, kind in ((n, np.uint64), (m, np.uint64), (n, np.uint32), *([(n, np.uint64)] if checked else [])):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw[at : at + count * width], np.uint8).reshape(width, count).T).view(kind).ravel())
        at += count * width
    return np.cumsum(out[0], dtype=np.uint64), out[3] if checked else None, np.cumsum(out[1], dtype=np.uint64).view(np.int64)[out[2]]


def _met(later: bool):
    """Over the rows of packed(), sorted by bucket: (ref, hashes) that have met."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, bucket = [], None

        def out(pairs):
            for k in range(0, len(pairs), 4096):
                some = pairs[k : k + 4096]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for _, x in some])]), pa.int32())
                flat = pa.array(np.concatenate([x for _, x in some]), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([int(x) for x, _ in some], pa.int64()), pa.ListArray.from_arrays(offsets, flat)], ["ref", "hashes"])

        def done():
            h, c, r = zip(*held)
            h, _, r, heads, run_of = _runs(np.concatenate(h), None if c[0] is None else np.concatenate(c), np.concatenate(r))
            yield from out(list(_by_ref(h, r, heads, run_of, np.minimum.reduceat(r, heads), later)))

        for b in batches:
            settled = []
            for at, size, blob, ref, found in zip(*(b.column(c).to_pylist() for c in range(4)), b.column(4)):
                if blob is None:
                    settled.append((ref, found.values.to_numpy()))
                    continue
                if at != bucket:
                    if held:
                        yield from done()
                    held, bucket = [], at
                held.append(unpacked(size, blob))
            yield from out(settled)
        if held:
            yield from done()

    return run


def buckets_for(hashes: int) -> int:
    """How many buckets so many hashes go to: each fits in memory, and there are several to a partition."""
    return max(256, hashes // BUCKET)


def met(sent: DataFrame, later: bool, buckets: int) -> DataFrame:
    """(ref, hashes) of hashes that another ref has too, with `later` a smaller one; a ref may have several rows, and a
    hash may be in more than one of them. The partitions grow with the buckets, some of which share one.
    """
    session = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = sent.repartition(max(session, buckets // 4), "bucket").sortWithinPartitions("bucket")
    return map_arrow(one, _met(later), "ref long, hashes array<long>")


SENT = "bucket int, size long, blob binary, ref long, hashes array<long>"


class Sender:
    """Gathers hashes with their refs, and with checks that make them 128 bits wide, and yields batches of what packed() sends."""

    def __init__(self, buckets: int, bits: int, later: bool):
        self.how, self.held, self.n = (buckets, bits, later), [], 0

    def add(self, hashes, refs, checks=None):
        if len(hashes):
            self.held.append((hashes, refs, checks))
            self.n += len(hashes)
        if self.n > FLUSH:
            yield from self.flush()

    def flush(self):
        import numpy as np
        import pyarrow as pa

        if self.held:
            h, r, c = zip(*self.held)
            rows = list(packed(np.concatenate(h), np.concatenate(r), None if c[0] is None else np.concatenate(c), *self.how))
            self.held, self.n = [], 0
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
            for k in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[k : k + 256]), kinds)], ["bucket", "size", "blob", "ref", "hashes"])
