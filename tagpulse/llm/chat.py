"""Chat formatting from a declarative template, in SQL expressions only.

A finite-state machine over roles says whether a conversation's turns come in a valid order;
every conversation is formatted, valid or not. Each turn gives three segments: an opening
marker, its text, a closing marker; a segment says whether it counts for the loss, as only
the texts of some roles do.

Control strings inside texts are escaped: one backslash goes between the first character of a
control string and the rest, also where backslashes already stand there. Undoing that takes
one backslash away, so any text comes back as it was, and no escaped text holds a marker.

Turns are ordered by turn, role, text (nulls first); repeated rows are repeated turns. A null
text is empty, a null role has the empty name; a role the template does not know is written
out by name and has no loss. Rows without a conversation id form one conversation. Other
columns are left out; an empty table gives an empty result. A conversation becomes one
string, so it must fit in a row, as any text must.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


#: The markers of a public chat format, and those for tools and other roles.
TURNS = {
    "system": Turn("<<SYS>>", "<</SYS>>"),
    "user": Turn("[INST]", "[/INST]"),
    "assistant": Turn("<s>", "</s>", loss=True),
    "tool": Turn("[TOOL]", "[/TOOL]"),
}
#: Which roles may follow which; "" is the start.
ORDER = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)}
INVALID = "invalid"


class Template:
    """Markers stand apart from texts by a blank, and a turn ends with a line break."""

    NAME_OPEN, NAME_CLOSE, OTHER_CLOSE = "<role>", "</role>", "<end>"

    def __init__(self, turns: dict[str, Turn] = TURNS, order: dict[str, tuple[str, ...]] = ORDER):
        self.turns, self.order = turns, order
        self.controls = [m for turn in turns.values() for m in (turn.open, turn.close)]
        self.controls += [self.NAME_OPEN, self.NAME_CLOSE, self.OTHER_CLOSE]
        for one in self.controls:
            if len(one) < 2 or re.search(r"\s|\\", one):
                raise ValueError(f"a marker needs two characters, no blanks and no backslash: {one!r}")
            if any(one != two and one in two for two in self.controls):
                raise ValueError(f"a marker inside another: {one!r}")
        if len({turn.open for turn in turns.values()}) < len(turns):
            raise ValueError("roles share an opening marker")
        rests: dict[str, list[str]] = {}
        for one in sorted(set(self.controls)):
            rests.setdefault(one[0], []).append(re.escape(one[1:]))
        #: The first character of a control string, whatever backslashes follow it.
        self._first = "|".join(f"{re.escape(c)}(?=\\\\*(?:{'|'.join(r)}))" for c, r in rests.items())
        starts = "|".join(f"{re.escape(c)}(?=\\\\+(?:{'|'.join(r)}))" for c, r in rests.items())
        self._marked = f"({starts})\\\\"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(f"({self._first})"), F.lit("$1\\\\"))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self._marked), F.lit("$1"))

    def _by_role(self, role: Column, of, other: Column) -> Column:
        chosen = other
        for name, turn in self.turns.items():
            chosen = F.when(role == name, of(turn)).otherwise(chosen)
        return chosen

    def segments(self, role: Column, text: Column) -> Column:
        """The three segments of a turn, as an array of (text, loss)."""
        named = F.concat(F.lit(self.NAME_OPEN), self.escape(role), F.lit(f"{self.NAME_CLOSE} "))
        opening = self._by_role(role, lambda t: F.lit(f"{t.open} "), named)
        closing = self._by_role(role, lambda t: F.lit(f" {t.close}\n"), F.lit(f" {self.OTHER_CLOSE}\n"))
        loss = self._by_role(role, lambda t: F.lit(t.loss), F.lit(False))
        parts = ((opening, F.lit(False)), (self.escape(text), loss), (closing, F.lit(False)))
        return F.array(*[F.struct(t.alias("text"), x.alias("loss")) for t, x in parts])

    def valid(self, roles: Column) -> Column:
        """Whether the machine accepts a sequence of roles."""
        moves = [(f"{a}>{b}", b) for a, after in self.order.items() for b in after]
        table = F.create_map(*[F.lit(x) for move in moves for x in move])
        end = F.aggregate(
            roles,
            F.lit(""),
            lambda state, role: F.coalesce(F.try_element_at(table, F.concat(state, F.lit(">"), role)), F.lit(INVALID)),
        )
        return ~end.isin("", INVALID)

    def parse(self, formatted: Column) -> Column:
        """The turns (role, text) of a formatted conversation."""
        either = lambda xs: "|".join(re.escape(x) for x in xs)
        opens = either(t.open for t in self.turns.values())
        closes = either([*(t.close for t in self.turns.values()), self.OTHER_CLOSE])
        name = f"{re.escape(self.NAME_OPEN)}(.*?){re.escape(self.NAME_CLOSE)}"
        pattern = F.lit(f"(?s)(?:({opens})|{name}) (.*?) (?:{closes})\n")
        roles = F.create_map(*[F.lit(x) for role, turn in self.turns.items() for x in (turn.open, role)])
        groups = [F.regexp_extract_all(formatted, pattern, F.lit(i)) for i in (1, 2, 3)]
        return F.transform(
            F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ("mark", "name", "text"), strict=True)]),
            lambda t: F.struct(
                F.coalesce(F.try_element_at(roles, t["mark"]), self.unescape(t["name"])).alias("role"),
                self.unescape(t["text"]).alias("text"),
            ),
        )


def format_chats(turns: DataFrame, template: Template | None = None, *, key: str = "conv_id") -> DataFrame:
    """A row for each conversation: key, ``n_turns``, ``valid``, ``segments`` (text, loss) and
    ``formatted``, all segments joined."""
    template = template or Template()
    row = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = turns.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    parts = F.flatten(F.transform("turns", lambda t: template.segments(t["role"], t["text"])))
    return grouped.select(
        key,
        F.size("turns").cast("long").alias("n_turns"),
        template.valid(F.col("turns.role")).alias("valid"),
        parts.alias("segments"),
    ).withColumn("formatted", F.array_join("segments.text", ""))


def lost_text(segments: Column, template: Template | None = None) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    template = template or Template()
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")
