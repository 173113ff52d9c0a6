"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions only.

A conversation's turns are put in order, the machine checks the order of their roles, and the template writes each turn
as three text segments - opening, text, closing - with a loss flag each. Control strings inside texts are escaped, so
that the formatted text can be read back exactly: a backslash becomes `\\0` and each control string a backslash and its
own sign (two or more where there are many), and as a backslash never ends such a pair, replacing the pairs one kind after another restores the text.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import islice, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How the template writes the turns of a role; loss: whether its text is trained on."""

    role: str
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Turns by role, how turns of any other role are written, the control strings, and the machine's moves.

    `moves` maps state and role to the next state; the machine starts in `start`, and a conversation is valid if it ends
    in one of `final`. No move leads to `stuck`, which is never left.
    """

    turns: tuple[Turn, ...]
    other: tuple[str, str, str]  # before the role, between role and text, after the text
    controls: tuple[str, ...]
    moves: dict[tuple[str, str], str]
    start: str = "start"
    final: tuple[str, ...] = ("asked", "answered")
    stuck: str = "stuck"
    signs: str = field(default="123456789abcdefghijklmnopqrstuvwxyz")

    def __post_init__(self):
        if odd := [c for c in self.controls if not c or "\\" in c or c[0] in "0" + self.signs]:
            raise ValueError(f"control strings may not be empty, hold a backslash or begin with a sign: {odd}")

    def codes(self) -> tuple[str, list[str]]:
        """What stands for a backslash, and for each control string, all of one length, as long as the controls need."""
        width = 1
        while len(self.signs) ** width < len(self.controls):
            width += 1
        return "\\" + "0" * width, ["\\" + "".join(x) for x in islice(product(self.signs, repeat=width), len(self.controls))]


INST = Template(
    turns=(
        Turn("system", "<<SYS>>\n", "\n<</SYS>>\n"),
        Turn("user", "[INST] ", " [/INST]"),
        Turn("assistant", "<s>", "</s>", loss=True),
    ),
    other=("[ROLE]", "[TURN]", "[/TURN]"),
    controls=("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TURN]", "[/TURN]"),
    moves={
        ("start", "system"): "told",
        ("start", "user"): "asked",
        ("told", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
)


def escaped(text: Column, template: Template = INST) -> Column:
    """The text without any control string; null counts as empty."""
    slash, codes = template.codes()
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit(slash))
    for code, control in zip(codes, template.controls, strict=True):
        out = F.replace(out, F.lit(control), F.lit(code))
    return out


def unescaped(text: Column, template: Template = INST) -> Column:
    """The text that was escaped."""
    slash, codes = template.codes()
    out = text
    for code, control in zip(codes, template.controls, strict=True):
        out = F.replace(out, F.lit(code), F.lit(control))
    return F.replace(out, F.lit(slash), F.lit("\\"))


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r"\^$.|?*+()[]{}<>/" else c for c in text)


def format_conversations(turns: DataFrame, template: Template = INST, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: id, state, valid, segments (array<struct<text, loss>>) and formatted, their texts joined.

    Turns are ordered by number, then role, then text; ties and repeated rows thus have one order and all stay. A null
    role counts as empty, a null text too; texts of any length stay whole; no rows give none. Invalid orders are written all the same and flagged. Rows with a null
    conversation id form one conversation. A conversation is one row of the result, so its turns meet in one task; other
    columns are not read, so their names cannot clash.
    """
    t = turns.select(
        F.col(conv_col).alias("conv"),
        F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).alias("t"),
    )
    made = t.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    moves = F.create_map(*(F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}>{role}", to)))
    state = F.aggregate("turns", F.lit(template.start), lambda s, x: F.coalesce(moves[F.concat(s, F.lit(">"), x["role"])], F.lit(template.stuck)))

    def part(text, loss=False):
        return F.struct(F.lit(text).alias("text") if isinstance(text, str) else text.alias("text"), F.lit(loss).alias("loss"))

    def written(x):
        before, between, after = template.other
        out = F.array(part(F.concat(F.lit(before), escaped(x["role"], template), F.lit(between))), part(escaped(x["text"], template)), part(after))
        for turn in template.turns:
            own = F.array(part(turn.opening), part(escaped(x["text"], template), turn.loss), part(turn.closing))
            out = F.when(x["role"] == turn.role, own).otherwise(out)
        return out

    made = made.select("conv", state.alias("state"), F.flatten(F.transform("turns", written)).alias("segments"))
    return made.select(
        F.col("conv").alias(conv_col),
        "state",
        F.col("state").isin(*template.final).alias("valid"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_back(formatted: Column, template: Template = INST) -> Column:
    """The turns of a formatted text: array<struct<role, text>>."""
    before, between, after = template.other
    kinds = [_quoted(t.opening) + "(.*?)" + _quoted(t.closing) for t in template.turns]
    any_turn = "(?s)" + "|".join([*kinds, _quoted(before) + ".*?" + _quoted(after)])

    def inner(x, opening, closing):
        return unescaped(F.substr(x, F.lit(len(opening) + 1), F.length(x) - len(opening) - len(closing)), template)

    def parsed(x):
        body = F.substr(x, F.lit(len(before) + 1), F.length(x) - len(before) - len(after))
        cut = F.locate(between, body)
        out = F.struct(unescaped(F.substr(body, F.lit(1), cut - 1), template).alias("role"), unescaped(F.substr(body, cut + len(between)), template).alias("text"))
        for t in template.turns:
            out = F.when(F.startswith(x, F.lit(t.opening)), F.struct(F.lit(t.role).alias("role"), inner(x, t.opening, t.closing).alias("text"))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(any_turn), F.lit(0)), parsed)


def digests(turns: DataFrame, template: Template = INST) -> DataFrame:
    """conv_id, and from the segments: turns read back and their digest, text under the loss mask and its digest."""
    out = format_conversations(turns, template).select("conv_id", "segments", "valid", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))
    out = out.select("conv_id", "formatted", read_back(F.col("formatted"), template).alias("back"), F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template)).alias("trained"), "valid")
    lines = F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join("trained", "")
    return out.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
