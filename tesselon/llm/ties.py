"""Ties of vectors that share a key, within an angle, in buckets of any size.

A search posts each vector under several keys; two vectors that may be linked share one. Every vector is a point on the
sphere with a reach, the angle within which those that it stands for lie (its own rounding, to begin with). A task first
looks at the keys that many of its vectors have: the vectors within `radius` of a leader are tied to it, and only the
leader goes on, with a reach that covers them. So a key that a third of all vectors have reaches its bucket as a few
leaders of each task. In the bucket two points are tied if their angle is at most `radius` and both reaches: by the triangle
inequality no two vectors within the radius lose their connection. Ties are candidates; what has a common tie is compared
exactly later on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .shared import map_arrow

POST = "key long, id long, other long, reach float, v binary"
NAMES = ["key", "id", "other", "reach", "v"]
FLUSH = 200_000  # posts that a task looks at together
HOT = 24  # of them under one key, from which on they are reduced to leaders; smaller groups are compared in one product


def _batch(keys, ids, others, reach, v):
    import numpy as np
    import pyarrow as pa

    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.nulls(n, pa.int64()) if others is None else pa.array(others, pa.int64()), pa.array(np.asarray(reach, np.float32)), pa.nulls(n, pa.binary()) if v is None else v], NAMES
    )


class Posts:
    """Gathers vectors with their keys (one row of them each) and yields batches of posts and of ties already found."""

    def __init__(self, radius: float, unpack: Callable):
        self.radius, self.unpack, self.held, self.n = radius, unpack, [], 0

    def add(self, ids, keys, reach, payload: list[bytes]):
        if len(ids):
            self.held.append((ids, keys, reach, payload))
            self.n += keys.size
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self):
        """The posts of what is held, by length of the payload: vectors of unlike lengths never meet."""
        import numpy as np

        parts, self.held, self.n = self.held, [], 0
        for size in sorted({len(p[3][0]) for p in parts}):
            own = [p for p in parts if len(p[3][0]) == size]
            ids, keys, reach = (np.concatenate([p[k] for p in own]) for k in range(3))
            yield from self._reduced(ids, keys, reach, [x for p in own for x in p[3]])

    def _reduced(self, ids, keys, reach, payload):
        import numpy as np
        import pyarrow as pa

        x = self.unpack(payload)
        data = pa.array(payload, pa.binary())
        flat, row = keys.ravel().view(np.int64), np.repeat(np.arange(len(ids)), keys.shape[1])
        order = np.argsort(flat, kind="stable")
        flat, row = flat[order], row[order]
        heads = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        size = np.diff([*heads, len(flat)])
        keep, far = np.ones(len(flat), bool), reach[row].copy()
        u, v = [], []
        for at, n in zip(heads[size >= HOT].tolist(), size[size >= HOT].tolist()):
            free = np.arange(at, at + n)
            while len(free):
                lead, rest = free[0], free[1:]
                angle = np.arccos(np.clip(x[row[rest]] @ x[row[lead]], -1, 1))
                near = angle <= self.radius
                mine = rest[near]
                keep[mine] = False
                far[lead] = max([far[lead], *(angle[near] + reach[row[mine]])])
                u.append(ids[row[mine]])
                v.append(np.full(len(mine), ids[row[lead]]))
                free = rest[~near]
        at = np.flatnonzero(keep)
        for k in range(0, len(at), 16384):
            p = at[k : k + 16384]
            yield _batch(flat[p], ids[row[p]], None, far[p], data.take(pa.array(row[p])))
        if u:
            u, v = np.concatenate(u), np.concatenate(v)
            both = np.unique(np.stack([u[u != v], v[u != v]]), axis=1)
            if both.shape[1]:  # under a key of their own, so that they are dealt evenly
                yield _batch((both[0] * 0x9E3779B1) ^ both[1], both[0], both[1], np.zeros(both.shape[1]), None)


def _small(x, reach, group, size, radius):
    """Pairs of rows that join what ties join, in groups of one small size, given by their first rows."""
    import numpy as np

    a, b = [], []
    step = max(1, (1 << 22) // (size * x.shape[1]))
    for k in range(0, len(group), step):
        at = group[k : k + step, None] + np.arange(size)
        part, far = x[at], reach[at]
        wide = np.minimum(radius + far[:, :, None] + far[:, None, :] + 1e-4, np.pi)
        tie = part @ part.transpose(0, 2, 1) >= np.cos(wide)
        tie |= np.eye(size, dtype=bool)
        label = np.broadcast_to(np.arange(size), at.shape)
        while True:  # each row takes the least label among its ties
            new = np.where(tie, label[:, None, :], size).min(2)
            if (new == label).all():
                break
            label = new
        g, i = np.nonzero(label != np.arange(size))
        a.append(at[g, i])
        b.append(at[g, label[g, i]])
    return a, b


def _large(x, reach, lo, hi, radius):
    """Pairs of the rows lo..hi that join what their ties join, fewer than there are rows."""
    import numpy as np

    n = hi - lo
    label, a, b = np.arange(n), [], []
    for k in range(0, n, 256):
        end = min(n, k + 256)
        far = reach[lo + k : lo + end, None] + reach[None, lo : lo + end]
        tie = x[lo + k : lo + end] @ x[lo : lo + end].T >= np.cos(np.minimum(radius + far + 1e-4, np.pi))
        tie &= np.arange(k, end)[:, None] > np.arange(end)[None, :]
        order = np.argsort(label[:end], kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], label[order][1:] != label[order][:-1]]))
        i, g = np.nonzero(np.logical_or.reduceat(tie[:, order], starts, axis=1))
        root = {}

        def find(y, root=root):
            while (up := root.get(y, y)) != y:
                y = up
            return y

        for row, q in zip((i + k).tolist(), label[order[starts[g]]].tolist()):  # of each row every group that it touches
            p, q = find(int(label[row])), find(q)
            if p != q:
                root[max(p, q)] = min(p, q)
                a.append(lo + row)
                b.append(lo + q)
        if root:
            to = np.arange(n)
            for y in sorted(root):
                to[y] = find(y)
            label = to[label]
    return [np.array(a, np.int64)], [np.array(b, np.int64)]


def tied(posts: DataFrame, radius: float, unpack: Callable) -> DataFrame:
    """(u, v): ties of posts that share a key, and those that came along."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def out(parts):
            """Ties of whole groups."""
            keys, ids, reach = (np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts]) for c in (0, 1, 3))
            head = np.concatenate([[True], keys[1:] != keys[:-1]])
            heads = np.flatnonzero(head)
            size = np.diff([*heads, len(keys)])
            shared = np.repeat(size > 1, size)
            if not shared.any():
                return
            x = unpack(pa.chunked_array([p.column(4) for p in parts]).filter(pa.array(shared)).to_pylist())
            ids, reach = ids[shared], reach[shared].astype(np.float64)
            size = size[size > 1]
            first = np.cumsum(size) - size
            a, b = [], []
            for n in np.unique(size[size <= HOT]).tolist():
                p, q = _small(x, reach, first[size == n], n, radius)
                a, b = a + p, b + q
            for at, n in zip(first[size > HOT].tolist(), size[size > HOT].tolist()):
                p, q = _large(x, reach, at, at + n, radius)
                a, b = a + p, b + q
            if sum(map(len, a)):
                u, v = ids[np.concatenate(a)], ids[np.concatenate(b)]
                both = np.unique(np.stack([np.maximum(u, v)[u != v], np.minimum(u, v)[u != v]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["u", "v"])

        held = []
        for b in batches:
            done = b.filter(pa.array(b.column(2).is_valid()))
            if done.num_rows:
                yield pa.RecordBatch.from_arrays([done.column(1), done.column(2)], ["u", "v"])
            b = b.filter(pa.array(b.column(2).is_null()))
            if not b.num_rows:
                continue
            keys = b.column(0).to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))  # the last group may go on in the next batch
            if last and held or held and held[-1].column(0)[-1].as_py() != keys[0]:
                yield from out([*held, b.slice(0, last)])
                held = []
            elif last:
                yield from out([b.slice(0, last)])
            held.append(b.slice(last))
        if held:
            yield from out(held)

    met = posts.repartition("key").sortWithinPartitions("key", "id")
    return map_arrow(met, run, "u long, v long").distinct()
