"""Words of UTF-8 text and their 64-bit hashes, over whole Arrow batches with numpy.

A word is a longest run of bytes other than space and 0x09-0x0D. Its bytes are taken eight at a time, all words of a
batch at once, and each eight are mixed into the hash with every bit spread before the next ones, so that no pattern of
letters cancels out as it can in a polynomial. Words over LONG bytes are hashed by BLAKE2b.
"""

from __future__ import annotations

import hashlib

import numpy as np

PIECE = 1 << 20  # bytes hashed at once; longer texts go piece by piece, cut at white space
LONG = 64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k bytes of eight


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(buf: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (byte offsets) and hashes of the words of a byte buffer; fold: A-Z count as a-z."""
    parts, at, n = [], 0, len(buf)
    while at < n:
        end = min(n, at + PIECE)
        while end < n:  # never cut a word in two
            gaps = np.flatnonzero(_BLANK[buf[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(n, end + PIECE)
        parts.append(_piece(buf[at:end], at, fold))
        at = end
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _piece(buf: np.ndarray, at: int, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~_BLANK[buf]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    data = np.zeros(len(buf) + 8, np.uint8)
    data[:-8] = _FOLD[buf] if fold else buf
    eight = np.ndarray((len(buf) + 1,), "<u8", data, 0, (1,))  # the eight bytes from each place on
    size = ends - starts
    h = mixed(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    todo, done = np.flatnonzero(size <= LONG), 0
    while len(todo):
        left = size[todo] - done
        h[todo] = mixed(h[todo] ^ (eight[starts[todo] + done] & _FIRST[np.minimum(left, 8)])) + np.uint64(0xD1342543DE82EF95)
        done += 8
        todo = todo[left > 8]
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return starts + at, ends + at, mixed(h)


def run_hashes(words: np.ndarray, k: int, family: int = 0) -> np.ndarray:
    """A hash for each k consecutive word hashes; each family is a hash of its own."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * i + 3 + 1000 * family)) & 0xFFFFFFFFFFFFFFFF | 1)
        total += mixed(words[i : n + i] ^ odd) * odd
    return mixed(total)


def texts(column) -> list[str | None]:
    """The texts of an Arrow string column; bytes that are no UTF-8 become U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [x if x is None else x.decode("utf-8", "replace") for x in column.cast("binary").to_pylist()]


def joined(column, most: int = PIECE):
    """Groups of rows of an Arrow string column, of about `most` bytes: (first row, byte buffer, word starts, ends, bounds).

    Yields (i, texts, buf, offsets): texts i.. as bytes, their buffer joined by line feeds, and each text's start in it
    with one more past the end. Null counts as empty.
    """
    rows, size, first = [], 0, 0
    for i, t in enumerate(column):
        t = t.as_buffer() if t.is_valid else b""
        t = b"" if t is None else bytes(t)
        if rows and size + len(t) > most:
            yield first, *_join(rows)
            rows, size, first = [], 0, i
        rows.append(t)
        size += len(t)
    if rows:
        yield first, *_join(rows)


def _join(rows: list[bytes]):
    sizes = np.fromiter((len(r) + 1 for r in rows), np.int64, len(rows))
    return rows, np.frombuffer(b"\n".join(rows) + b"\n", np.uint8), np.concatenate([[0], np.cumsum(sizes)])
