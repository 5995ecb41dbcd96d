"""Chat formatting with typed content parts.

A turn's content is a list of typed parts: text, image, audio or document. A visitor flattens the parts of each turn in
order: text is escaped, every other part becomes a placeholder and an attachment record with its reference, its own
notation and the number of tokens that it will take the place of. A conversation's formatted text is

    <|turn|>ROLE<|text|>CONTENT<|end|>   and a line feed, for each turn, in order of turns.

Control strings are all that begin with <| in this form. Inside roles and texts a backslash is doubled and <| is written
<\\|, so no text can hold a control string, and each backslash says what the character behind it stands for. Spans of the
loss mask cover the content of the assistant's turns, without the marks around it.

Rows are dealt by ranges of (conv_id, turn), so a very long conversation is formatted by many tasks. It is stored in
pieces of about PIECE characters, a row each, which end between turns; read in the order of (part, piece), pieces give the
conversation. Only conversations that do not end in the piece and task where they began are brought together for reading,
as a stream that keeps the state of a hash and no texts.

Nulls: a null role or text is empty; rows with a null conv_id are one conversation; a null turn comes first. Rows with one
conv_id and turn are turns of their own, in the order of role, then of the text's hash; equal rows all stay. Empty texts
give empty turns. Very long texts are one part, whole. An empty table gives no rows. Parts of unknown kind, or null parts,
are an error. Other columns, of any names, are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, work_path

PIECE = 1 << 18
LEARNED = "assistant"
PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENT = "struct<turn: int, kind: string, ref: string, source: string, at: long, tokens: long>"
#: whole: the conversation is this piece, no more.
FORMATTED = f"conv_id long, part int, piece long, whole boolean, n_turns long, formatted string, loss array<struct<start: long, stop: long>>, attachments array<{ATTACHMENT}>, expanded_tokens long"

#: Tokens of attachments: a token for each PATCH x PATCH pixels, AUDIO_RATE a second, PAGE_TOKENS a page; parts of unknown
#: size count as one square of SIDE pixels, one second or one page.
PATCH, SIDE, AUDIO_RATE, PAGE_TOKENS = 28, 448, 25, 512

KINDS = {"image": "png jpg jpeg gif webp bmp", "audio": "wav mp3 ogg flac m4a", "document": "pdf doc docx odt html txt"}
_KIND_OF = {e: kind for kind, names in KINDS.items() for e in names.split()}
#: An attachment in a text: ![title](reference.extension)
_LINK = re.compile(r"!\[[^\[\]\n]*\]\(([^()\x00-\x20]+\.([A-Za-z0-9]+))\)")
_ESCAPED = re.compile(r"\\(.)", re.S)
_PLACE = re.compile(r"<\|(image|audio|document)\|>")
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def parts_of(text: str) -> list[dict]:
    """A text as typed parts: attachments written as ![title](reference) with a known extension, and what is between."""
    out, at = [], 0
    for m in _LINK.finditer(text):
        kind = _KIND_OF.get(m[2].lower())
        if kind:
            if m.start() > at:
                out.append({"kind": "text", "text": text[at : m.start()]})
            out.append({"kind": kind, "text": m[0], "ref": m[1]})
            at = m.end()
    if at < len(text) or not out:
        out.append({"kind": "text", "text": text[at:]})
    return out


@dataclass
class Visitor:
    """Flattens the parts of turns into one string and records what their placeholders stand for."""

    out: list[str] = field(default_factory=list)
    size: int = 0
    turns: int = 0
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def add(self, s: str) -> None:
        self.out.append(s)
        self.size += len(s)

    def turn(self, role: str, parts: Iterable[dict]) -> None:
        self.add(f"<|turn|>{escape(role)}<|text|>")
        start = self.size
        for p in parts:
            visit = getattr(self, f"visit_{(p or {}).get('kind')}", None)
            if visit is None:
                raise ValueError(f"a part of unknown kind: {p}")
            visit(p)
        if role == LEARNED:
            self.loss.append({"start": start, "stop": self.size})
        self.add("<|end|>\n")
        self.turns += 1

    def visit_text(self, part: dict) -> None:
        s = escape(part.get("text") or "")
        if s:  # <| may not come to be where two texts meet
            self.add("\\" + s if s[0] == "|" and self.out[-1].endswith("<") else s)

    def visit_image(self, part: dict) -> None:
        w, h = part.get("width") or SIDE, part.get("height") or SIDE
        self._attach(part, -(-w // PATCH) * -(-h // PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, max(1, round((part.get("seconds") or 1.0) * AUDIO_RATE)))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part.get("pages") or 1) * PAGE_TOKENS)

    def _attach(self, part: dict, tokens: int) -> None:
        self.attachments.append({"turn": self.turns, "kind": part["kind"], "ref": part.get("ref"), "source": part.get("text") or "", "at": self.size, "tokens": tokens})
        self.add(f"<|{part['kind']}|>")


def restored(content: str, sources: Iterator[str]) -> str:
    """The text that a content stands for: each placeholder gives way to the next of sources."""
    if "<|" not in content:
        return unescape(content)
    out, at = [], 0
    for m in _PLACE.finditer(content):
        out += [unescape(content[at : m.start()]), next(sources)]
        at = m.end()
    return "".join([*out, unescape(content[at:])])


def turns_of(formatted: str, attachments: list[dict]) -> Iterator[tuple[str, str]]:
    """The (role, text) of a piece's turns."""
    sources = iter([a["source"] for a in attachments])
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        yield unescape(m[1]), restored(m[2], sources)
        at = m.end()
    if at != len(formatted):
        raise ValueError("text that is no turn")


def learned_texts(formatted: str, loss: list[dict], attachments: list[dict]) -> Iterator[str]:
    """What is under the loss mask, with its placeholders and escapes undone."""
    for span in loss:
        inside = [a["source"] for a in attachments if span["start"] <= a["at"] < span["stop"]]
        yield restored(formatted[span["start"] : span["stop"]], iter(inside))


def formatted(convs: DataFrame, piece: int = PIECE) -> DataFrame:
    """The pieces of all conversations, see FORMATTED, ordered in tasks. convs has conv_id, turn, role, and parts (an array
    of PART) or text, in which attachments are looked for."""
    typed = "parts" in convs.columns
    content = F.col("parts") if typed else F.coalesce("text", F.lit(""))
    keys = ["conv_id", "turn", "role", "tie"]
    rows = convs.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.xxhash64(content).alias("tie"), content.alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held = TaskContext.get().partitionId(), 0, None
        conv, began_here, in_one = None, False, True  # of the conversation that is read now
        ready: list[dict] = []

        def row(last: bool) -> dict:
            return {"conv_id": conv, "part": part, "piece": n, "whole": last and began_here and in_one, "n_turns": held.turns, "formatted": "".join(held.out), "loss": held.loss, "attachments": held.attachments, "expanded_tokens": sum(a["tokens"] for a in held.attachments)}

        for b in batches:
            for c, role, what in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(4).to_pylist(), strict=True):
                if held is None or c != conv:
                    if held is not None and held.turns:
                        ready.append(row(True))
                        n += 1
                    # what a task sees first may have begun in the one before
                    began_here, in_one, conv, held = held is not None, True, c, Visitor()
                elif held.size >= piece:
                    in_one = False
                    ready.append(row(False))
                    n += 1
                    held = Visitor()
                held.turn(role, (what or []) if typed else parts_of(what))
                if len(ready) >= 64:
                    yield pa.RecordBatch.from_pylist(ready, schema=_arrow)
                    ready = []
        if held is not None and held.turns:
            ready.append(row(False))  # the next task may go on with it
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=_arrow)

    return rows.repartitionByRange(partitions(convs.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(run, FORMATTED)


_span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_attachment = pa.list_(pa.struct([("turn", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("source", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))
_arrow = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss", _span), ("attachments", _attachment), ("expanded_tokens", pa.int64())])


def write_formatted(convs: DataFrame, path: str | None = None, piece: int = PIECE) -> DataFrame:
    """Writes the pieces as Parquet and reads them back."""
    spark = convs.sparkSession
    path = path or work_path(spark, "chat")
    formatted(convs, piece).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(FORMATTED).parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each run of pieces of one conversation; pieces come in order."""
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    open_, done = None, []

    def close() -> None:
        conv, turns, loss, counts = open_
        done.append((conv, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), *counts[2:]))

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(types)], names=names)

    for b in batches:
        for r in b.to_pylist():
            if open_ is None or r["whole"] or r["conv_id"] != open_[0]:
                if open_ is not None:
                    close()
                open_ = (r["conv_id"], hashlib.sha256(), hashlib.sha256(), [0, 0, 0, 0, 0])
            _, turns, loss, counts = open_
            for role, text in turns_of(r["formatted"], r["attachments"]):
                turns.update(f"{role}\n{text}\n".encode())
                counts[0] += 1
            for text in learned_texts(r["formatted"], r["loss"], r["attachments"]):
                loss.update(text.encode())
                counts[1] += len(text)
            counts[2] += len(r["formatted"])
            counts[3] += len(r["attachments"])
            counts[4] += r["expanded_tokens"]
        yield batch()
        done = []
    if open_ is not None:
        close()
        yield batch()


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, expanded_tokens long"


def read_back(pieces: DataFrame) -> DataFrame:
    """What the stored pieces say, a row for each conversation, see DIGESTS."""
    apart = pieces.filter("NOT whole").repartition(partitions(pieces.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return pieces.filter("whole").mapInArrow(_digests, DIGESTS).union(apart.mapInArrow(_digests, DIGESTS))
