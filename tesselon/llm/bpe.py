"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file is read on the driver and broadcast: a vocabulary is of a fixed size, and it is refused beyond
`MOST_BYTES`. With the patterns of CUT_SAFELY long texts are cut before they reach the library, only where every match
ends too: after an ASCII letter or digit and before a space or line feed, or between an ASCII letter and an ASCII digit.
Very long runs of white space, which those patterns match with backtracking, are taken out and encoded as the one match
that they are. With any other pattern texts go to the library whole.
"""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow

MOST_BYTES = 32 << 20
PIECE = 100_000  # code points after which a text is cut at the next safe place
_SAFE = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
# A pattern for which the cuts are right.
CUT_SAFELY = ("'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+",)
# The code points that count as white space in the library's patterns.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LONG_RUN = re.compile(f"[{_SPACE}]{{20000,}}")


@functools.lru_cache(maxsize=4)
def encoding(ranks: bytes, pattern: str):
    """A tiktoken Encoding of the lines of a rank file, without special tokens."""
    import base64

    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def safe_parts(text: str, most: int = PIECE):
    """Cut text where every match of the pattern ends; a part is longer than `most` only if it holds no such place."""
    at = 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encoded(enc, text: str, most: int = PIECE):
    """The token ids of a text as a uint32 array, by parts of about `most` code points; infinity: by the library alone."""
    import numpy as np

    def ids(part):
        return np.array(enc.encode_ordinary(part), np.uint32)

    if len(text) <= min(most, 20_000) or most == math.inf:
        return ids(text)
    out, at = [], 0
    for run in _LONG_RUN.finditer(text):
        # Followed by more text, the run is one match up to its last code point, which goes with what follows.
        end = run.end() - (run.end() < len(text))
        out += [ids(p) for p in safe_parts(text[at : run.start()], most)]
        out.append(np.array(enc._encode_single_piece(text[run.start() : end]), np.uint32))
        at = end
    out += [ids(p) for p in safe_parts(text[at:], most)]
    return np.concatenate(out)


def _ranks(df: DataFrame, path: str):
    with open(path, "rb") as f:
        data = f.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"{path} is over {MOST_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(data)


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id and the token ids of its whole text (array<int>).

    Null and empty texts give an empty array. Rows, repeated ones too, stay as they are; null ids stay null; no rows give
    none. Bytes that are no UTF-8 become U+FFFD. Other columns are not read, so their names cannot clash.
    """
    data = _ranks(docs, ranks_path)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from .words import texts

        enc = encoding(data.value, pattern)
        most = PIECE if pattern in CUT_SAFELY else math.inf
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = [encoded(enc, t, most) if t else np.zeros(0, np.uint32) for t in texts(part.column(1))]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                flat = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))], ["id", "ids"])

    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(given, run, "id long, ids array<int>").select(F.col("id").alias(id_col), F.col("ids").alias(ids_col))


def bpe_decode(tokens: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """The input with one more column, the raw bytes of its token ids; a column of that name is replaced.

    Null ids give null, nulls among the ids are left out.
    """
    from pyspark.sql import types as T

    data = _ranks(tokens, ranks_path)
    kept = tokens.drop(bytes_col)
    where, names = kept.columns.index(ids_col), [*kept.columns, bytes_col]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        enc = encoding(data.value, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = part.column(where)
                if ids.flatten().null_count:
                    ids = pa.array([x and [i for i in x if i is not None] for x in ids.to_pylist()], pa.list_(pa.int32()))
                flat, ends = ids.flatten().to_numpy().tolist(), np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy()).tolist()
                out = [enc.decode_bytes(flat[a:b]) if ok else None for a, b, ok in zip([0, *ends], ends, ids.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names)

    return map_arrow(kept, run, T.StructType([*kept.schema.fields, T.StructField(bytes_col, T.BinaryType())]))


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids (decimal, joined by a space) and of the decoded bytes."""
    both = bpe_decode(bpe_encode(docs, ranks_path, pattern), ranks_path, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
