"""Chat formatting, in DataFrame functions only.

A finite-state machine over roles judges the order of turns. A declarative template turns each
turn into text segments, each with a loss flag. Control strings inside texts are broken
by an escape character, reversibly, so that markers in the output are only those of the
template, and the turns can be read back from it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Markers around a turn, what to escape, whose text is learned, and the order of roles.

    A turn is ``start`` role ``middle`` text ``end``. ``controls``: further strings that have
    a meaning to some trainer and are escaped too. ``moves``: state to role to next state; a
    conversation is valid if every turn has a move and the last state is in ``final``.
    """

    start: str = "<|turn|>"
    middle: str = "<|text|>"
    end: str = "<|end|>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    loss_roles: tuple[str, ...] = ("assistant",)
    moves: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            "begin": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked", "tool": "asked"},
        }
    )
    final: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        markers, every = (self.start, self.middle, self.end), self.every
        for c in every:
            if len(c) < 2 or ESCAPE in c:
                raise ValueError(f"control string too short or with the escape character: {c!r}")
            for i in range(1, len(c)):
                if c[:i] == c[-i:]:
                    raise ValueError(f"control string overlaps itself: {c!r}")
                if any(m.startswith(c[i:]) or m.endswith(c[:i]) for m in markers):
                    raise ValueError(f"control string may form across a marker: {c!r}")

    @property
    def every(self) -> list[str]:
        return list(dict.fromkeys((self.start, self.middle, self.end, *self.controls)))


def escape(text: Column, template: Template) -> Column:
    """Text without any control string; ``unescape`` gives the text back."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for c in template.every:
        text = F.replace(text, F.lit(c), F.lit(c[0] + ESCAPE + c[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _next_state(template: Template):
    moves = [
        (f"{state}>{role}", to)
        for state, roles in template.moves.items()
        for role, to in roles.items()
    ]
    table = F.create_map(*[F.lit(x) for move in moves for x in move])
    return lambda state, turn: F.coalesce(
        F.try_element_at(table, F.concat(state, F.lit(">"), turn["role"])), F.lit("invalid")
    )


def format_conversations(
    conversations: DataFrame,
    template: Template = Template(),
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: the id, n_turns, valid, state, segments and formatted.

    ``segments``: array of (text, loss), whose texts joined are ``formatted``; the loss
    covers the text of the learned roles alone, not their markers. ``state``: where the machine
    ends, ``invalid`` after a turn it has no move for. Invalid conversations are formatted
    all the same.

    Turns go by number, ties by role and text, repeated rows stay. NULL texts and roles are
    empty ones; NULL ids are one conversation of their own, NULL turn numbers come first. Other
    columns are not read. An empty table gives an empty table. A conversation becomes one
    string, which is what a trainer reads, so it has to fit into a row.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text"))
    turns = conversations.groupBy(F.col(f"`{id_col}`")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    learned = list(template.loss_roles)

    def segments(t: Column) -> Column:
        def one(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        head = F.concat(F.lit(template.start), escape(t["role"], template), F.lit(template.middle))
        return F.array(
            one(head, F.lit(False)),
            one(escape(t["text"], template), t["role"].isin(learned)),
            one(F.lit(template.end), F.lit(False)),
        )

    state = F.aggregate("turns", F.lit("begin"), _next_state(template))
    made = turns.select(
        F.col(f"`{id_col}`"),
        F.size("turns").cast("long").alias("n_turns"),
        state.alias("state"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )
    return made.select(
        F.col(f"`{id_col}`"),
        "n_turns",
        F.col("state").isin(list(template.final)).alias("valid"),
        "state",
        "segments",
        F.array_join(F.col("segments")["text"], "").alias("formatted"),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """Array of (role, text) read back from a formatted conversation."""

    def quoted(s: str) -> str:
        return "\\Q" + s + "\\E"

    parts = F.split(formatted, quoted(template.end), -1)
    turns = F.slice(parts, 1, F.size(parts) - 1)  # nothing follows the last end

    def one(turn: Column) -> Column:
        halves = F.split(turn, quoted(template.middle), 2)
        role = F.substring(halves[0], len(template.start) + 1, 1 << 30)
        return F.struct(unescape(role).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(turns, one)


def loss_text(segments: Column) -> Column:
    """What lies under the loss mask, unescaped and joined."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"])), "")
