"""Chat formatting of typed content parts.

A message is a list of parts: text, image, audio or document. A visitor walks the parts in order and
flattens them into one string: text with its control strings escaped, every other part as a numbered
placeholder that expands to a known number of tokens. What a placeholder stands for goes to a list of
attachments. The template puts each flattened message between turn marks, and the loss mask covers the
assistant's content.

Turns are formatted in the order of the conversation by a streaming pass over rows that Spark has
partitioned by conversation and sorted: a task holds one row and a few counters of the open
conversation, never the conversation itself, however many turns it has. ``read_back`` parses the output
the same way.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
PART = "type string, text string, ref string, width int, height int, seconds double, pages int"
ATTACHMENT = "array<struct<ordinal int, type string, ref string, at long, n_tokens long>>"
FORMATTED = (f"turn_index long, role string, formatted string, content_start long, content_end long, in_loss boolean, "
             f"attachments {ATTACHMENT}, n_expanded long")


class Template(NamedTuple):
    """How many tokens the placeholders expand to, and whose content carries loss."""

    tile: int = 28              # pixels on the side of an image token
    max_image_tokens: int = 1280
    audio_tokens_per_second: float = 25.0
    tokens_per_page: int = 256
    loss_role: str = "assistant"


# ---------------------------------------------------------------- escaping


def escape(text: str) -> str:
    """Reversible; the result holds no ``<|``, so no control string can begin inside a text."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    """``escape`` for the header line of a turn, which a line feed would end."""
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


# ---------------------------------------------------------------- the visitor


class PartVisitor:
    """Flattens the parts of one conversation; ordinals run over the whole conversation."""

    def __init__(self, template: Template):
        self.template, self.ordinal = template, 0
        self.begin()

    def begin(self) -> None:
        """Start a message."""
        self.out, self.length, self.attachments = [], 0, []
        self.is_open = False  # if what was written ends in "<"

    def visit(self, part: dict) -> None:
        kind = part["type"] or "text"
        handler = getattr(self, f"visit_{kind}", None)
        (handler or self.visit_other)(part)

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)
        self.is_open = text.endswith("<") if text else self.is_open

    def _write_text(self, text: str) -> None:
        """Escaped, also across the border to the part before it."""
        self._write("\\" + escape(text) if self.is_open and text.startswith("|") else escape(text))

    def _attach(self, part: dict, n_tokens: int) -> None:
        self.ordinal += 1
        self.attachments.append({"ordinal": self.ordinal, "type": part["type"], "ref": part["ref"], "at": self.length,
                                 "n_tokens": n_tokens})
        self._write(f"<|{part['type']}_{self.ordinal}|>")

    def visit_text(self, part: dict) -> None:
        self._write_text(part["text"] or "")

    def visit_image(self, part: dict) -> None:
        side = self.template.tile
        tiles = math.ceil((part["width"] or side) / side) * math.ceil((part["height"] or side) / side)
        self._attach(part, max(1, min(tiles, self.template.max_image_tokens)))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, max(1, math.ceil((part["seconds"] or 0.0) * self.template.audio_tokens_per_second)))

    def visit_document(self, part: dict) -> None:
        self._attach(part, max(1, part["pages"] or 1) * self.template.tokens_per_page)

    def visit_other(self, part: dict) -> None:
        """A part of an unknown type keeps its text and is otherwise noted as an attachment of no tokens."""
        self.attachments.append({"ordinal": None, "type": part["type"], "ref": part["ref"], "at": self.length, "n_tokens": 0})
        self._write_text(part["text"] or "")


def text_part(text: Column) -> Column:
    """A plain text column as a list of one text part (null text: empty)."""
    fields = [F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text")]
    fields += [F.lit(None).cast(t).alias(n) for n, t in (p.split() for p in PART.split(", ")[2:])]
    return F.array(F.struct(*fields))


# ---------------------------------------------------------------- formatting


def format_chat(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts", template: Template = Template()) -> DataFrame:
    """One row per message, in the order of its conversation, partitioned by conversation.

    Columns: ``conv_id``, ``turn_index`` (from 0), ``role``, ``formatted`` (the message with its marks; the
    conversation is their concatenation), ``content_start`` and ``content_end`` (code points in the
    formatted conversation), ``in_loss``, ``attachments`` (ordinal, type, ref, place of the placeholder in
    the formatted conversation, tokens it expands to) and ``n_expanded`` (their sum).

    Messages are ordered by turn (nulls first); ties and repeated rows are all kept, ordered by role and
    content. A null role is an empty one; null or empty parts give empty content; a part of unknown type is
    read as text. A null conversation id is a conversation of its own. An empty table gives an empty result;
    columns beyond the named ones are ignored.
    """
    rows = messages.select(
        messages[conv].alias("conv_id"), messages[turn].alias("_turn"), F.coalesce(messages[role], F.lit("")).alias("role"),
        F.transform(F.coalesce(messages[parts], F.expr(f"CAST(array() AS array<struct<{_fields()}>>)")),
                    lambda p: F.struct(*[p[n].alias(n) for n in _names()])).alias("_parts"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "_turn", "role", "_parts")
    schema = T.StructType([ordered.schema["conv_id"], *T.StructType.fromDDL(FORMATTED).fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_id, visitor, index, length = object(), None, 0, 0
        for batch in batches:
            out = []
            for key, who, content in zip(_keys(batch["conv_id"]), batch["role"], batch["_parts"], strict=True):
                if key != open_id:
                    open_id, visitor, index, length = key, PartVisitor(template), 0, 0
                visitor.begin()
                for part in content:
                    visitor.visit(part)
                head, body = f"{START}{escape_line(who)}\n", "".join(visitor.out)
                begin = length + len(head)
                found = [a | {"at": begin + a["at"]} for a in visitor.attachments]
                whole = f"{head}{body}{END}\n"
                out.append((key, index, who, whole, begin, begin + len(body), who == template.loss_role, found,
                            sum(a["n_tokens"] for a in found)))
                index, length = index + 1, length + len(whole)
            yield _frame(out, schema)

    return ordered.mapInPandas(run, schema)


def _names() -> list[str]:
    return [f.split()[0] for f in PART.split(", ")]


def _fields() -> str:
    return PART.replace(" ", ":", 1).replace(", ", ",").replace(" ", ":")


def _keys(ids: pd.Series) -> list:
    """Ids as Python values, a missing one as None."""
    return [None if missing else value for value, missing in zip(ids.tolist(), ids.isna().tolist(), strict=True)]


def _frame(rows: list[tuple], schema: T.StructType) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=schema.names, dtype=object)
    for field in schema.fields:
        if isinstance(field.dataType, T.LongType):
            frame[field.name] = frame[field.name].astype("Int64")
    return frame


# ---------------------------------------------------------------- reading back

READ = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, "
        "n_expanded long")


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and unescaped content of one formatted message; raises if its marks are not where they belong."""
    if not formatted.startswith(START) or not formatted.endswith(f"{END}\n"):
        raise ValueError("a formatted message must stand between its marks")
    head, _, rest = formatted[len(START):].partition("\n")
    content = rest[: -len(END) - 1]
    if START in content or END in content:
        raise ValueError("a control string stands inside a message")
    return unescape(head), unescape(content)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation from the output of ``format_chat`` (as it comes: partitioned and ordered).

    ``turns_sha256`` hashes role, line feed, content and line feed of every turn as parsed from the formatted
    text, ``loss_sha256`` the content under the loss mask, cut out by its recorded place. Both are kept as
    running states, so a conversation of any length takes constant memory.
    """
    schema = T.StructType([formatted.schema["conv_id"], *T.StructType.fromDDL(READ).fields])
    columns = ["conv_id", "formatted", "content_start", "content_end", "in_loss", "attachments", "n_expanded"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_id, state = object(), None
        for batch in batches:
            out = []
            for key, text, start, end, in_loss, found, expanded in zip(
                    _keys(batch["conv_id"]), *(batch[c] for c in columns[1:]), strict=True):
                if key != open_id:
                    if state:
                        out.append(state.row(open_id))
                    open_id, state = key, _Digest()
                state.add(text, int(start), int(end), bool(in_loss), len(found), int(expanded))
            yield _frame(out, schema)
        if state:
            yield _frame([state.row(open_id)], schema)

    return formatted.select(*columns).mapInPandas(run, schema)


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_attachments = self.expanded = 0

    def add(self, text: str, start: int, end: int, in_loss: bool, n_attachments: int, expanded: int) -> None:
        role, content = parse_turn(text)
        self.turns.update(f"{role}\n{content}\n".encode())
        if in_loss:
            under = unescape(text[start - self.chars:end - self.chars])
            self.loss.update(under.encode())
            self.loss_chars += len(under)
        self.n_turns, self.chars = self.n_turns + 1, self.chars + len(text)
        self.n_attachments, self.expanded = self.n_attachments + n_attachments, self.expanded + expanded

    def row(self, key) -> tuple:
        return (key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.n_attachments, self.expanded)
