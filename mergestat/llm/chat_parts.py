"""Chat formatting with typed content parts.

A turn is a list of parts: text, image, audio or document (a plain text column
is one text part).  A visitor flattens them in order: text is escaped, every
other part becomes a placeholder, its reference goes to the attachment list and
its length in model tokens (patches, frames, pages) is counted.

Template: ``<turn ROLE>`` parts ``</turn>`` line end.  Markers open with ``<``;
in texts and roles ``\\`` becomes ``\\\\`` and ``<`` becomes ``\\<`` (in roles also
``>`` ``\\>``), so nothing a text holds can be taken for a marker and reading
back gives the very texts.  The loss mask is the list of spans of the text parts
of trained roles.

Scale: one shuffle by conversation; a task streams its sorted turns and writes a
conversation in pieces of about ``piece_chars`` characters, cut between turns, so
a conversation of any length needs the memory of one turn.  ``read_back`` streams
the pieces again.

Defined cases: turns are ordered by turn, role and text, nulls first; a null text
is empty, a null role is marked as none and digests as empty; a null id is a
conversation of its own; null parts are no parts; parts of unknown type become
placeholders of no tokens; repeated rows are repeated turns; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

TRAINED = ("assistant",)
PIECE_CHARS = 1 << 20
PATCH, FRAMES_PER_SECOND, TOKENS_PER_PAGE = 14, 25, 512
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

_TOKEN = re.compile(r"\\(.)|<((?:[^>\\]|\\.)*)>|[^\\<]+", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class PartVisitor:
    """Flattens the parts of one turn; results are in its attributes."""

    def __init__(self, first_place: int = 0):
        self.out: list[str] = []
        self.texts: list[tuple[int, int]] = []
        self.attachments: list[tuple[int, str, str | None, int]] = []
        self.tokens = self.chars = 0
        self.place, self.after_text = first_place, False

    def visit(self, part: dict) -> None:
        method = getattr(self, "visit_" + str(part.get("type")), self.visit_other)
        method(part)
        self.after_text = part.get("type") == "text"

    def visit_text(self, part: dict) -> None:
        if self.after_text:
            self._put("<text>")
        start = self.chars
        self._put(escape(part.get("text") or ""))
        self.texts.append((start, self.chars))

    def visit_image(self, part: dict) -> None:
        self._attach(part, math.ceil((part.get("width") or 0) / PATCH) * math.ceil((part.get("height") or 0) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part.get("seconds") or 0) * FRAMES_PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part.get("pages") or 0) * TOKENS_PER_PAGE)

    def visit_other(self, part: dict) -> None:
        self._attach(part, 0)

    def _attach(self, part: dict, tokens: int) -> None:
        kind = part.get("type") if part.get("type") in ("image", "audio", "document") else "other"
        self._put(f"<{kind} {self.place} {tokens}>")
        self.attachments.append((self.place, kind, part.get("ref"), tokens))
        self.place += 1
        self.tokens += tokens

    def _put(self, s: str) -> None:
        self.out.append(s)
        self.chars += len(s)


def format_turn(role: str | None, parts: list[dict], first_place: int = 0) -> tuple[str, PartVisitor, int]:
    """(formatted turn, its visitor, offset of the body)."""
    v = PartVisitor(first_place)
    for p in parts:
        v.visit(p)
    head = "<turn>" if role is None else f"<turn {escape(role).replace('>', chr(92) + '>')}>"
    return f"{head}{''.join(v.out)}</turn>\n", v, len(head)


def parse(formatted: str):
    """(role, parts) of each turn of a formatted string.

    A part is ("text", text, start, end) or (kind, place, start, end), where
    start and end delimit it in the string.  An empty text part is found only
    beside another text part.
    """
    inside, at = False, 0
    role, parts, text, start, begun = None, [], [], 0, False
    for m in _TOKEN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"unreadable at {at}")
        at, marker = m.end(), m[2]
        if marker is None:
            if inside:
                text.append(m[1] if m[1] is not None else m[0])
            elif m[0] != "\n":
                raise ValueError(f"text between turns at {m.start()}")
            continue
        if marker == "turn" or marker.startswith("turn "):
            if inside:
                raise ValueError(f"turn within a turn at {m.start()}")
            role, inside, parts = (None if marker == "turn" else unescape(marker[5:])), True, []
        elif not inside:
            raise ValueError(f"part outside a turn at {m.start()}")
        elif text or begun or marker == "text":
            parts.append(("text", "".join(text), start, m.start()))
        if marker == "/turn":
            yield role, parts
            inside = False
        elif marker != "text" and marker.split(" ")[0] != "turn":
            kind, place, _ = marker.split(" ")
            parts.append((kind, int(place), m.start(), m.end()))
        text, start, begun = [], m.end(), marker == "text"
    if at != len(formatted) or inside:
        raise ValueError("unreadable end")


_FORMATTED = ("piece int, n_turns int, formatted string, loss array<struct<start:int,end:int>>, "
              "attachments array<struct<place:int,kind:string,ref:string,tokens:int>>, expanded_tokens long")


def format_chats(rows: DataFrame, ident: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str | None = "text", parts: str | None = None, trained: tuple[str, ...] = TRAINED,
                 piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Formatted conversations in pieces: id, piece, formatted, loss spans, attachments."""
    body = F.col(f"`{parts}`") if parts else F.array(F.struct(
        F.lit("text").alias("type"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))
    src = rows.select(F.col(f"`{ident}`").cast("long").alias("ident"), F.col(f"`{turn}`").alias("turn"),
                      F.col(f"`{role}`").alias("role"), body.cast(f"array<{PART}>").alias("parts"))
    order = ["ident", "turn", "role", F.transform("parts", lambda p: p["text"]), F.xxhash64("parts")]
    src = src.repartition("ident").sortWithinPartitions(*order).select("ident", "role", "parts")
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(),
             pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
             pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int32())])),
             pa.int64()]
    names = ["ident", "piece", "n_turns", "formatted", "loss", "attachments", "expanded_tokens"]

    def run(batches):
        done, held, now, piece, place = [], 0, _NONE, 0, 0
        out, chars, turns, loss, files, tokens = [], 0, 0, [], [], 0

        def close():
            done.append((now, piece, turns, "".join(out), loss, files, tokens))

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names)

        for b in batches:
            for i, r, p in zip(*(b.column(k) for k in range(3))):
                i, r, p = i.as_py(), r.as_py(), p.as_py()
                if i != now or now is _NONE or chars >= piece_chars:
                    if now is not _NONE:
                        close()
                        held += chars
                    piece = piece + 1 if i == now and now is not _NONE else 0
                    place = place if piece else 0
                    now, out, chars, turns, loss, files, tokens = i, [], 0, 0, [], [], 0
                    if held >= piece_chars:
                        yield flush()
                        done, held = [], 0
                s, v, at = format_turn(r, p or [], place)
                if r in trained:
                    loss += [{"start": chars + at + a, "end": chars + at + e} for a, e in v.texts]
                files += [dict(zip(("place", "kind", "ref", "tokens"), a)) for a in v.attachments]
                out.append(s)
                chars, turns, tokens, place = chars + len(s), turns + 1, tokens + v.tokens, v.place
        if now is not _NONE:
            close()
        if done:
            yield flush()

    return src.mapInArrow(run, f"ident long, {_FORMATTED}").withColumnRenamed("ident", ident)


_NONE = object()


def read_back(pieces: DataFrame, ident: str = "conv_id") -> DataFrame:
    """Turn count and digests of each conversation, parsed from its formatted pieces."""
    src = pieces.select(F.col(f"`{ident}`").alias("ident"), "piece", "formatted", "loss")
    src = src.repartition("ident").sortWithinPartitions("ident", "piece")
    names = [ident, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        now, rows = _NONE, []

        def close():
            rows.append((now, turns, all_.hexdigest(), loss_chars, learned.hexdigest(), chars))

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for b in batches:
            for i, s, loss in zip(b.column(0), b.column(2), b.column(3)):
                i, s, loss = i.as_py(), s.as_py(), loss.as_py()
                if i != now or now is _NONE:
                    if now is not _NONE:
                        close()
                    now, turns, loss_chars, chars = i, 0, 0, 0
                    all_, learned = hashlib.sha256(), hashlib.sha256()
                for role, parts in parse(s):
                    turns += 1
                    all_.update(f"{role or ''}\n{''.join(p[1] for p in parts if p[0] == 'text')}\n".encode())
                for span in loss:
                    text = unescape(s[span["start"]:span["end"]])
                    loss_chars += len(text)
                    learned.update(text.encode())
                chars += len(s)
            if rows:
                yield flush()
                rows = []
        if now is not _NONE:
            close()
            yield flush()

    return src.mapInArrow(run, f"`{ident}` long, n_turns long, turns_sha256 string, loss_chars long, "
                               "loss_sha256 string, formatted_chars long")


def formatted(rows: DataFrame, **options) -> DataFrame:
    """``format_chats`` written to the shared folder and read again."""
    return staged(format_chats(rows, **options), "chats")
