"""Chat formatting: turns with typed content parts to one marked text, and back.

A visitor flattens the parts of a turn (text, image, audio, document) into text with ordered
placeholders; it records each attachment's reference and how many tokens its placeholder stands for. The
template marks turns: ``<s>role, line feed, text</s>`` for the assistant, ``[INST]role, line feed,
text[/INST]`` for all others. A conversation is its turns' chunks in order. The loss mask covers the
assistant's texts and nothing else.

Marks and placeholders that stand in a text are escaped: a backslash goes behind their first character, and
backslashes are doubled. So no text can end its turn, and unescaping gives every text back.

Conversations are streamed in turn order through the task that holds them; a task keeps one turn and
running digests, however long a conversation is. Turns with the same number are ordered by role, then text. A
null text or role counts as empty, a null turn comes first, and rows without a conversation id make one
conversation. Repeated rows are turns of their own. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textkit import map_texts

ASSISTANT = "assistant"
KINDS = ("image", "audio", "document", "other")
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", *[f"<{kind}>" for kind in KINDS])
#: Tokens for an image patch side in pixels, for a second of audio, for a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 256

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_TURN = re.compile(r"\[INST\](.*?)\n(.*?)\[/INST\]|<s>(.*?)\n(.*?)</s>", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)

PARTS = "array<struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
FORMATTED = (
    "conv_id long, turn long, formatted string, loss_start long, loss_chars long, expanded_tokens long, "
    "attachments array<struct<position:long,kind:string,uri:string,tokens:long>>"
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def escape_role(role: str) -> str:
    """As ``escape``; a line feed becomes a backslash and a plus sign, as it ends the role."""
    return escape(role).replace("\n", "\\+")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "+" else m[1], text)


@dataclass
class Flattener:
    """Visits the parts of one turn in order."""

    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    chars: int = 0

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def _put(self, text: str) -> None:
        self.pieces.append(text)
        self.chars += len(text)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"position": self.chars, "kind": kind, "uri": part.get("uri"), "tokens": tokens})
        self._put(f"<{kind}>")

    def visit_text(self, part: dict) -> None:
        self._put(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(max(1, part.get(k) or 1) / PATCH) for k in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil(max(0.0, part.get("seconds") or 0.0) * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 1) * PAGE_TOKENS)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part, 0)


def joined_texts(parts: list[dict]) -> Iterator[dict]:
    """The parts, with neighbouring texts made one."""
    run: list[str] = []
    for part in parts:
        if part is None:
            continue
        if (part.get("type") or "text") == "text":
            run.append(part.get("text") or "")
            continue
        if run:
            yield {"type": "text", "text": "".join(run)}
            run = []
        yield part
    if run:
        yield {"type": "text", "text": "".join(run)}


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, int, int, Flattener]:
    """The chunk of a turn, start and length of its text in code points, and the visitor."""
    role, seen = role or "", Flattener()
    for part in joined_texts(parts):
        seen.visit(part)
    body = "".join(seen.pieces)
    mark, close = ("<s>", "</s>") if role == ASSISTANT else ("[INST]", "[/INST]")
    head = f"{mark}{escape_role(role)}\n"
    return f"{head}{body}{close}", len(head), len(body), seen


def parse_turns(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, escaped text, and its span, of each turn of a formatted text."""
    for m in _TURN.finditer(formatted):
        k = 2 if m[1] is not None else 4
        yield unescape(m[k - 1]), m[k], m.start(k), m.end(k)


def _format(batches):
    for batch in batches:
        columns = batch.to_pydict()
        out = {name: [] for name in ("formatted", "loss_start", "loss_chars", "expanded_tokens", "attachments")}
        for role, text, parts in zip(columns["role"], columns["text"], columns["parts"]):
            whole = [{"type": "text", "text": text}] if parts is None else parts
            chunk, start, length, seen = format_turn(role, whole)
            out["formatted"].append(chunk)
            out["loss_start"].append(start)
            out["loss_chars"].append(length if role == ASSISTANT else 0)
            out["expanded_tokens"].append(sum(a["tokens"] for a in seen.attachments))
            out["attachments"].append(seen.attachments)
        kinds = {
            "formatted": pa.string(), "attachments": pa.list_(pa.struct(
                [("position", pa.int64()), ("kind", pa.string()), ("uri", pa.string()), ("tokens", pa.int64())]
            )),
        }
        arrays = [pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["conv_id", "turn", *out])


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per turn, in order within its conversation (which is in one partition, and sorted there).

    ``turns`` has ``conv_id, turn, role, text`` and may have ``parts`` (see ``PARTS``), which then stand for the text.
    ``loss_start`` and ``loss_chars`` give the part of ``formatted`` under the loss mask; positions of
    attachments count from ``loss_start``.
    """
    parts = F.col("parts") if "parts" in turns.columns else F.lit(None)
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", parts.cast(PARTS).alias("parts")
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_texts(ordered, _format, FORMATTED)


def _read_back(batches):
    state = None

    def row():
        conv, n, turns, loss_chars, loss, chars = state
        return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    for batch in batches:
        out = []
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        starts, lengths = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for conv, formatted, start, length in zip(ids, texts, starts, lengths):
            if state is None or state[0] != conv:
                if state is not None:
                    out.append(row())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, body, _, _ in parse_turns(formatted):
                state[1] += 1
                state[2].update(f"{role}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
            masked = unescape(formatted[start : start + length])
            state[3] += len(masked)
            state[4].update(masked.encode("utf-8", "surrogatepass"))
            state[5] += len(formatted)
        yield _digests(out)
    if state is not None:
        yield _digests([row()])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = zip(*rows) if rows else [()] * len(kinds)
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from what ``format_conversations`` gives: every turn parsed out of the
    marked text again, and the unescaped text under the loss mask."""
    rows = formatted.select("conv_id", "formatted", "loss_start", "loss_chars")
    return map_texts(rows, _read_back, DIGESTS)
