"""Secret scans by assignment-aware lexing.

Three base kinds come from fixed patterns. Beside them, source and configuration syntax is lexed into name-literal
pairs (`name = "x"`, `"name": "x"`, `NAME: x`, `export NAME=x`, `name := 'x'`, `--name=x`, `<name>x</name>`). Names that are
assigned a literal are constants: a later assignment of the constant, or of a sum of literals and constants, gives its
literals to the new name, over any number of steps. A literal is scored by the most sensitive name it reaches and by its
own look; at `least` points or more its span is of the kind `literal`, unless a base span covers it already.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow

KINDS = ("assign", "access", "hex", "literal")
# The base patterns and their least lengths.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Parts of names and how sensitive a value under such a name is.
SENSITIVE = {"password": 3, "passwd": 3, "passphrase": 3, "pwd": 2, "secret": 3, "token": 3, "apikey": 3, "api_key": 3, "accesskey": 3, "access_key": 3, "privatekey": 3, "private_key": 3, "credential": 2, "auth": 1, "signing": 1, "encryption": 1, "client_key": 2, "conn_str": 2, "connectionstring": 2}
_PARTS = sorted({k.replace("_", "") for k in SENSITIVE})
_NAME = r"[\w$.-]++"
_PAIR = re.compile(
    rf"""(?<![\w$.-])(?P<q>["']?)(?P<name>{_NAME})(?P=q)(?:\[\s?["']?(?P<key>{_NAME})["']?\s?\])?[ \t]*+(?::[ \t]*+[\w.\[\]]++[ \t]*+=(?!=)|:=|=>|=(?![=>~])|:(?![:/]))[ \t]*+(?P<value>)(?=[^\r\n])"""
    rf"""|<(?P<tag>{_NAME})>(?P<inner>[^<>\r\n]++)</(?P=tag)>""",
    re.A,
)
_TERM = re.compile(r"""[ \t]*+(?:[rbuf]?"(?P<a>(?:[^"\\\r\n]++|\\.)*+)"|[rbuf]?'(?P<b>(?:[^'\\\r\n]++|\\.)*+)'|`(?P<c>[^`\r\n]*+)`|(?P<id>[A-Za-z_$][\w$.-]*+)(?!\())""", re.A)
_PLUS = re.compile(r"[ \t]*+(?:\+|\.\.|&)")
_BLANK = re.compile(r"[ \t]*+")
_BARE = re.compile(r"[A-Za-z0-9+/_.=~!@#$%^&*-]++")
_CLOSED = re.compile(r"[ \t]*+(?:$|[,;}])")
_LINE = re.compile(r"[^\r\n]*+")
_DULL = re.compile(r"(?i)^(?:true|false|null|none|nil|undefined|changeme|example|placeholder|your[-_ ].*|x+|\*+|\.+|-+|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|todo|test|string|str|int|bool)$")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the three base kinds, leftmost and not overlapping within a kind."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    return out + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def sensitivity(name: str) -> int:
    """How sensitive the values of a name are, 0 to 3."""
    plain = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower().replace("-", "_").replace(".", "_")
    return max((v for k, v in SENSITIVE.items() if k in plain or k in plain.replace("_", "")), default=0)


def may_hold_names(text: str) -> bool:
    """False only if no name in the text is sensitive: what sensitivity() looks for is looked for without separators and case."""
    plain = text.lower().replace("-", "").replace("_", "").replace(".", "")
    return any(k in plain for k in _PARTS)


def strength(value: str) -> float:
    """0 to 3 points for a literal that looks like a secret: length, mixed characters, entropy; below 0 if it can't be one."""
    if len(value) < 6 or _DULL.match(value) or re.search(r"\s", value):
        return -9.0
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    bits = -sum(c / len(value) * math.log2(c / len(value)) for c in Counter(value).values())
    return min(1.0, len(value) / 16) + min(1.0, (kinds - 1) / 2) + min(1.0, bits / 4)


def scored_literals(text: str) -> list[tuple[int, int, int]]:
    """(sensitivity, start, end) of each literal that a name is given, by the most sensitive name that it reaches, directly or through constants."""
    const: dict[str, int] = {}  # the assignment that holds now
    points, spans, links = [], [], []  # of each assignment: its name's points, its own literals, the earlier ones that it takes over
    at = end = run = 0  # the line that holds the value ends at end, the bare characters last met at run: each is looked for once
    closed = False
    while m := _PAIR.search(text, at):
        if m["tag"]:
            points.append(sensitivity(m["tag"]))
            spans.append([(m.start("inner"), m.end("inner"))])
            links.append(())
            at = m.end()
            continue
        name, pos, got, taken = (m["key"] or m["name"]).lstrip(".-"), m.start("value"), [], set()
        first = pos
        if first >= end:
            end = _LINE.match(text, first).end()
        while t := _TERM.match(text, pos, end):  # a sum of literals and constants
            k = next((k for k in "abc" if t[k] is not None), None)
            if k:
                got.append((t.start(k), t.end(k)))
            elif t["id"] in const:
                taken.add(const[t["id"]])
            elif not got and not taken:
                break
            pos = t.end()
            plus = _PLUS.match(text, pos, end)
            if not plus:
                break
            pos = plus.end()
        if not got and not taken:
            bare = _BLANK.match(text, first, end).end()
            if bare >= run:
                b = _BARE.match(text, bare, end)
                run = b.end() if b else bare
                closed = bool(_CLOSED.match(text, run, end))
            if closed and run - bare >= 6:
                got, pos = [(bare, run)], run
        if got or taken:
            const[name] = len(points)
            const.setdefault(name.rpartition(".")[2], len(points))
            points.append(sensitivity(name))
            spans.append(got)
            links.append(taken)
        at = max(pos, m.start("value"), m.start() + 1)
    for i in reversed(range(len(points))):  # what is taken over stands earlier, so one pass reaches every step
        for j in links[i]:
            points[j] = max(points[j], points[i])
    return [(p, a, b) for p, own in zip(points, spans) for a, b in own]


def scan(text: str, least: float = 4.0) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then by kind."""
    base = base_spans(text)
    found = {}
    if may_hold_names(text):
        for s, a, b in scored_literals(text):
            if s and s + strength(text[a:b]) >= least:
                found[a, b] = True
    covers = sorted((a, b) for _, a, b in base)
    base += [("literal", a, b) for a, b in found if not any(x <= a and b <= y for x, y in covers)]
    return sorted(base, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and spans, array<struct<kind, start, end>> in code points, end exclusive, by start and kind.

    Null and empty texts have no spans; null ids stay null, repeated rows are each scanned, no rows give none. Names, values
    and texts of any length are read whole, in time that grows with the text; bytes that are no UTF-8 become U+FFFD. Other columns are not read.
    """

    def run(batches):
        import pyarrow as pa

        from .words import texts

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)] if t else [] for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["id", "spans"])

    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(given, run, "id long, spans array<struct<kind:string,start:long,end:long>>").select(F.col("id").alias(id_col), "spans")


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", count_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with every span, joined where they overlap, replaced by a mark; count_col gets the new length.

    Texts without spans, null ones too, stay as they are, as do repeated rows and columns of any name; no rows give none.
    Bytes that are no UTF-8 become U+FFFD.
    """
    schema, at = docs.schema, docs.columns.index(text_col)

    def clean(text):
        out, last, end = [], 0, -1
        for _, a, b in scan(text):
            if a >= end:
                out += [text[last:a], mark]
            end = last = max(end, b)
        return text if end < 0 else "".join([*out, text[last:]])

    def run(batches):
        import pyarrow as pa

        from .words import texts

        for b in batches:
            new = pa.array([clean(t) if t else t for t in texts(b.column(at))], b.column(at).type)
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(b.columns)], b.schema.names)

    out = map_arrow(docs, run, schema)
    if count_col in docs.columns:
        out = out.withColumn(count_col, F.when(F.col(text_col).isNull(), F.col(count_col)).otherwise(F.length(text_col)).cast(schema[count_col].dataType))
    return out


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans by kind, the digest of the base spans and all spans as a string."""
    found = secret_scan(docs)
    base = F.filter("spans", lambda s: s["kind"] != "literal")

    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
