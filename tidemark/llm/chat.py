"""Chat formatting (operator 6): a finite-state machine over roles.

``Template`` declares, for each role, the marks around a turn, whether its text
is under the loss, and the roles that may follow. Rows are sorted by
conversation and turn, and each task streams through them: the machine's state
is the last role, a turn that may not follow it makes the conversation invalid
(it is formatted all the same), and each turn gives three segments, mark, text
and mark, with a loss flag each. Inside texts control strings are escaped, so
that ``parse`` reads roles and texts back from the formatted string.

Defined results: a null text or role is empty; a role that the template
doesn't know gets the general marks with its name and is invalid; rows of one
turn number go by role and text, repeated rows each are a turn; null turns
come first; rows without a conv_id are one conversation; an empty table gives
an empty result; other columns are ignored. A conversation's turns pass
through one task in order, one batch in memory at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


@dataclass(frozen=True)
class Turn:
    """Marks before and after the text, and the roles that may come next."""

    before: str
    after: str
    follows: tuple[str, ...]
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Turns by role. Every mark holds a control string, but for the opening
    of one role (``plain``), which is told by the lack of another's."""

    turns: dict[str, Turn]
    first: tuple[str, ...]
    control: tuple[str, ...]
    other: tuple[str, str, str] = ("[ROLE:", "]\n", "[/ROLE]")
    _escape: re.Pattern = field(init=False, compare=False, default=None)

    def __post_init__(self):
        strings = sorted((*self.control, self.other[0], self.other[2]), key=len, reverse=True)
        object.__setattr__(self, "_escape", re.compile("|".join(map(re.escape, ("\\", *strings)))))

    def allowed(self, state: str | None) -> tuple[str, ...]:
        """Roles that may come after ``state`` (None: at the start)."""
        return self.first if state is None else self.turns[state].follows if state in self.turns else ()

    def escape(self, text: str) -> str:
        """Doubles backslashes and puts one inside each control string."""
        return self._escape.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        text = self.escape(text)
        if (turn := self.turns.get(role)) is None:
            return [(f"{self.other[0]}{self._role(role)}{self.other[1]}", False), (text, False), (self.other[2], False)]
        return [(turn.before, False), (text, turn.loss), (turn.after, False)]

    def _role(self, role: str) -> str:
        return self.escape(role).replace("]", "]\\")

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """Roles and texts of a formatted string."""
        out, at = [], 0
        plain = next(r for r, t in self.turns.items() if not any(c in t.before for c in self.control))
        while at < len(formatted):
            if formatted.startswith(self.other[0], at):
                mark = formatted.index(self.other[1], at)
                role, at = self.unescape(formatted[at + len(self.other[0]):mark]), mark + len(self.other[1])
                after = self.other[2]
            else:
                role = next((r for r, t in self.turns.items() if r != plain and formatted.startswith(t.before, at)), plain)
                at += len(self.turns[role].before)
                after = self.turns[role].after
            end = formatted.index(after, at)
            out.append((role, self.unescape(formatted[at:end])))
            at = end + len(after)
        return out


INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n\n", ("user",)),
        "user": Turn("<s>[INST] ", " [/INST]", ("assistant",)),
        "assistant": Turn(" ", " </s>", ("user",), loss=True),
    },
    first=("system", "user"),
    control=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"),
)

_TURNS = ("conv_id long, place long, valid boolean, segments array<struct<text:string,loss:boolean>>")
_SEGMENT = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def _emit(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, place, begun = None, None, 0, False
        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
                if not begun or c != conv:
                    begun, conv, state, place = True, c, None, 0
                role = role or ""
                valid = role in template.allowed(state)
                out.append((c, place, valid, [{"text": t, "loss": m} for t, m in template.segments(role, text or "")]))
                state, place = role, place + 1
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_()),
                 pa.array(cols[3], _SEGMENT)], ["conv_id", "place", "valid", "segments"])

    return run


def format_turns(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per turn: conv_id, place (in the conversation), valid (its role may
    follow the one before), segments of text and loss flag. A conversation's
    formatted string is its segments in order."""
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text") \
        .mapInArrow(_emit(template), _TURNS)


_DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, valid boolean")


def _read(template: Template):
    class Reading:
        def __init__(self, conv):
            self.conv, self.turns, self.valid = conv, 0, True
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()
            self.loss_chars = self.chars = 0

        def add(self, valid, segments):
            formatted = "".join(s["text"] for s in segments)
            for role, text in template.parse(formatted):
                self.all.update(f"{role}\n{text}\n".encode())
                self.turns += 1
            for s in segments:
                if s["loss"]:
                    text = template.unescape(s["text"])
                    self.loss.update(text.encode())
                    self.loss_chars += len(text)
            self.chars += len(formatted)
            self.valid &= valid

        def row(self):
            return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _DIGEST.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        now = None

        def rows(done):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*(d.row() for d in done)), types)], names)

        for batch in batches:
            done = []
            for c, valid, segments in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "valid", "segments"))):
                if now is None or now.conv != c:
                    if now is not None:
                        done.append(now)
                    now = Reading(c)
                now.add(valid, segments)
            if done:
                yield rows(done)
        if now is not None:
            yield rows([now])

    return run


def digests(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation, read back from ``format_turns``'s output: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return turns.repartition(n, "conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_read(template), _DIGEST)


def conversation_digests(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Writes the formatted turns into the shared work folder, reads them back."""
    turns, _ = materialize(format_turns(conversations, template), "chat-turns")
    return digests(turns, template)
