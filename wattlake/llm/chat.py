"""Chat formatting with a grammar round trip.

Grammar, after the opening ``<s>`` of a conversation::

    user       [INST] text [/INST]
    system     [SYS] text [/SYS]
    assistant  (space) text </s>
    any other  [ROLE] name [/ROLE] text </s>

Every turn is rendered, parsed again and compared with its source. Content that does not come back the same (it holds a
control string or a backslash) is escaped: backslashes are doubled and a backslash is put after the first character of
each control string. A turn that still differs is an error. Turns begin and end with control strings or a space, so what
holds for each turn holds for their concatenation.

- Turns are ordered by turn number, then role, then text; null numbers come first. Repeated rows are turns of their own.
- A null text or role counts as empty; a null conversation id is an id of its own. An empty table gives no rows.
- A conversation of any length streams through a task turn by turn; rendering and checking happen before the shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import batches_of, rows, text_of

OPEN, CLOSE = "<s>", "</s>"
CONTROL = (OPEN, CLOSE, "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


class GrammarError(ValueError):
    pass


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def _frame(role: str, name: str, text: str) -> tuple[str, str]:
    """What stands before the text, and the whole turn."""
    if role in ("user", "system"):
        mark = {"user": "INST", "system": "SYS"}[role]
        head, tail = f"[{mark}] ", f" [/{mark}]"
    else:
        head, tail = (" " if role == "assistant" else f"[ROLE] {name} [/ROLE] "), CLOSE
    return head, head + text + tail


def parse_turn(s: str, at: int) -> tuple[str, int, int, int]:
    """Role, start and end of the (escaped) text, and end of the turn that begins at ``at``."""

    def upto(start: int, closing: str) -> int:
        m = _CONTROL.search(s, start)
        end = m.start() - (closing[0] == " ") if m else -1
        if not m or m[0] != closing.strip() or end < start or not s.startswith(closing, end):
            raise GrammarError(f"expected {closing!r} after {start}")
        return end

    for role, head, closing in (("user", "[INST] ", " [/INST]"), ("system", "[SYS] ", " [/SYS]")):
        if s.startswith(head, at):
            end = upto(at + len(head), closing)
            return role, at + len(head), end, end + len(closing)
    if s.startswith("[ROLE] ", at):
        name_end = upto(at + 7, " [/ROLE]")
        start = name_end + 8
        if not s.startswith(" ", start):
            raise GrammarError(f"expected a space at {start}")
        end = upto(start + 1, CLOSE)
        return unescape(s[at + 7:name_end]), start + 1, end, end + len(CLOSE)
    if s.startswith(" ", at):
        end = upto(at + 1, CLOSE)
        return "assistant", at + 1, end, end + len(CLOSE)
    raise GrammarError(f"no turn begins at {at}")


def _comes_back(formatted: str, role: str, text: str) -> bool:
    try:
        got, start, end, stop = parse_turn(formatted, 0)
    except GrammarError:
        return False
    return stop == len(formatted) and (got, unescape(formatted[start:end])) == (role, text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn, and where its text stands; escaped no more than the round trip asks for."""
    for name, content in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        head, formatted = _frame(role, name, content)
        if _comes_back(formatted, role, text):
            return formatted, len(head), len(head) + len(content)
    raise GrammarError(f"a turn of role {role!r} does not come back")


def render(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Every turn rendered: conv_id, turn, role, formatted, text_start and text_end within ``formatted``, in_loss, and a digest
    of the source turn.

    Partitioned by conversation and sorted, so that the turns of a conversation follow each other in one partition.
    A conversation's formatted text is ``<s>`` and its turns in this order.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                        ("formatted", pa.string()), ("text_start", pa.int64()), ("text_end", pa.int64()), ("in_loss", pa.bool_()),
                        ("source", pa.binary())])

    def run(batches):
        def made():
            for conv_id, turn, role, text in rows(batches, "conv_id", "turn", "role", "text"):
                yield conv_id, turn, role, text, *render_turn(role, text), role == "assistant", _digest(role, text)

        return batches_of(made(), schema, 1024)

    plain = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        text_of(turns[role_col]).alias("role"), text_of(turns[text_col]).alias("text"),
    )
    made = plain.mapInArrow(run, "conv_id long, turn long, role string, text string, formatted string, text_start long, "
                                 "text_end long, in_loss boolean, source binary")
    return made.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("text")


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests of every conversation, read from the formatted text by the parser."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        return batches_of(_conversations(rows(batches, *columns)), schema)

    columns = ("conv_id", "formatted", "text_start", "text_end", "in_loss", "source")
    return rendered.select(*columns).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


class TurnStream:
    """The parser over text that comes in pieces, wherever they are cut."""

    def __init__(self):
        self.held, self.base, self.opened = "", 0, False

    def feed(self, piece: str) -> Iterator[tuple[str, str, int, int]]:
        """Role and text of each turn that is complete by now, and where its (escaped) text stands in the stream."""
        self.held += piece
        at = 0
        if not self.opened and len(self.held) >= len(OPEN):
            if not self.held.startswith(OPEN):
                raise GrammarError(f"expected {OPEN!r} at the beginning")
            self.opened, at = True, len(OPEN)
        while self.opened and at < len(self.held):
            try:
                role, start, end, stop = parse_turn(self.held, at)
            except GrammarError:  # not complete, or never will be
                break
            yield role, unescape(self.held[start:end]), self.base + start, self.base + end
            at = stop
        self.held, self.base = self.held[at:], self.base + at

    def close(self) -> None:
        if self.held or not self.opened:
            raise GrammarError(f"no turn at {self.base}")


class _Conversation:
    """One conversation read from its stream."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.stream, self.length = conv_id, TurnStream(), 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n, self.loss_chars = 0, 0
        self.sources, self.masks = deque(), deque()
        self.take(OPEN)

    def take(self, piece: str) -> None:
        self.length += len(piece)
        for role, text, start, end in self.stream.feed(piece):
            if not self.sources or self.sources.popleft() != _digest(role, text):
                raise GrammarError(f"the turn before {end} is not that of the source")
            if role == "assistant" and (not self.masks or self.masks.popleft() != (start, end)):
                raise GrammarError(f"the loss mask does not cover the text before {end}")
            self.said.update(f"{role}\n{text}\n".encode())
            self.n += 1

    def add(self, formatted: str, text_start: int, text_end: int, in_loss: bool, source: bytes) -> None:
        self.sources.append(source)
        if in_loss:
            self.masks.append((self.length + text_start, self.length + text_end))
            text = unescape(formatted[text_start:text_end])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.take(formatted)

    def result(self) -> tuple:
        self.stream.close()
        if self.sources or self.masks:
            raise GrammarError("turns are missing at the end")
        return self.conv_id, self.n, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.length


def _conversations(turns: Iterator[tuple]) -> Iterator[tuple]:
    held = None
    for conv_id, *turn in turns:
        if held is None or conv_id != held.conv_id:
            if held is not None:
                yield held.result()
            held = _Conversation(conv_id)
        held.add(*turn)
    if held is not None:
        yield held.result()
