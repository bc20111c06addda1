"""Conversations as marked text whose turns can be read back exactly.

Template, for every turn::

    <|im_start|>role NEWLINE text<|im_end|> NEWLINE

Grammar of the parser: a marker is ``<|``, a number of backslashes, a name
(``im_start``, ``im_end``, ``nl``) and ``|>``. Without a backslash it is a
control: it opens a turn, closes it, or (in a role only) stands for a newline.
With k > 0 backslashes it is text: the same marker with k - 1. All else is
itself. Escaping adds a backslash to every marker of a text, so it is
reversible whatever the text holds, escaped markers included.

Grammar round trip: turns are first rendered as they are; the rendered text is
parsed; the turns found are compared with the source. Turns that don't come
back (their content opens or closes turns, or holds a marker with backslashes)
are escaped and the text is parsed again, until it is identical. One round of
escapes always suffices; a text that still differs raises.

A formatted conversation is written in parts of whole turns, because one
conversation may hold any share of all rows: turns are sorted over all tasks by
range, every task renders and checks the turns it has, and a part ends after
``PART_CHARS`` characters. Parts carry the loss mask as spans of code points
within their text. Each assistant text has one span; roles and markers have
none. Only the digests of a whole conversation need its parts in order: a task
streams over them and keeps a hash state, never a conversation. SHA-256 is
sequential, so one conversation is always digested by one task.

Null texts and roles are empty. A null conversation id is one conversation of
its own. Turns are ordered by turn (null first), and equal turns by role, then
text, so repeated rows are repeated turns and every run gives the same text. A
turn of any length is kept whole. An empty table gives no rows. Only conv_id,
turn, role and text of the input are used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm import text
from vigilog.session import durable

LEARNED = "assistant"
PART_CHARS = 50_000
OPEN, CLOSE, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
MARKER = re.compile(r"<\|(\\*)(im_start|im_end|nl)\|>")
FORMAT = "conv_id long, part long, piece long, formatted string, turns long, mask array<struct<start:long,stop:long>>"

Turn = tuple[str, str]


class NotChat(ValueError):
    """The text doesn't follow the grammar."""


def escape(content: str) -> str:
    return MARKER.sub(lambda m: f"<|\\{m[1]}{m[2]}|>", content)


def unescape(content: str) -> str:
    return MARKER.sub(lambda m: f"<|{m[1][1:]}{m[2]}|>", content)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, start and stop of the text (as it stands) of every turn; raises ``NotChat``."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise NotChat(f"no turn opens at {at}")
        line = formatted.find("\n", at)
        if line < 0:
            raise NotChat(f"role without end at {at}")
        role = []
        last = at + len(OPEN)
        for m in MARKER.finditer(formatted, last, line):
            if not m[1] and m[2] != "nl":
                raise NotChat(f"{m[0]} within a role")
            role += [formatted[last:m.start()], f"<|{m[1][1:]}{m[2]}|>" if m[1] else "\n"]
            last = m.end()
        role.append(formatted[last:line])
        content = []
        start = last = line + 1
        for m in MARKER.finditer(formatted, start):
            if m[1]:
                content += [formatted[last:m.start()], f"<|{m[1][1:]}{m[2]}|>"]
                last = m.end()
            elif m[2] == "im_end":
                break
            elif m[2] == "im_start":
                raise NotChat(f"a turn opens within a text at {m.start()}")
        else:
            raise NotChat(f"text without end at {start}")
        content.append(formatted[last:m.start()])
        yield "".join(role), "".join(content), start, m.start()
        at = m.end() + 1
        if formatted[at - 1:at] != "\n":
            raise NotChat(f"no line end at {at - 1}")


def render(turns: Iterable[Turn]) -> str:
    return "".join(f"{OPEN}{role}\n{content}{CLOSE}\n" for role, content in turns)


def _recovered(shown: Turn, source: Turn) -> bool:
    try:
        found = list(parse(render([shown])))
    except NotChat:
        return False
    return [turn[:2] for turn in found] == [source]


def format_turns(turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """Text that parses to exactly ``turns``, and the spans of the texts to be learned."""
    shown = list(turns)
    for escaped in (False, True):
        out = render(shown)
        try:
            found = list(parse(out))
        except NotChat:
            found = []
        if [turn[:2] for turn in found] == turns:
            return out, [(start, stop) for role, _, start, stop in found if role == LEARNED]
        if escaped:
            break
        # Every turn must stand by itself: those that don't are escaped.
        shown = [turn if _recovered(turn, turn) else (escape(turn[0]).replace("\n", LINE), escape(turn[1])) for turn in turns]
    raise NotChat("turns don't come back from their escaped text")


def turns_of(formatted: str) -> list[Turn]:
    return [turn[:2] for turn in parse(formatted)]


def _sorted_turns(turns: DataFrame) -> DataFrame:
    """Turns in order over all partitions; a long conversation lies in several."""
    text.small_batches(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def format_conversations(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Parts of formatted conversations: conv_id, part and piece (their order), formatted, turns, mask.

    Sorted by conversation and turn over the partitions, so ``part`` (the
    partition) and ``piece`` (its place there) order the parts of a conversation.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        piece, now, held, size = 0, None, [], 0
        for batch in batches:
            out = []
            for conv, role, content in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if held and (conv != now or size >= part_chars):
                    out.append((now, part, piece, held))
                    piece, held, size = piece + 1, [], 0
                now = conv
                held.append((role, content))
                size += len(role) + len(content)
            yield from _parts(out)
        if held:
            yield from _parts([(now, part, piece, held)])

    return _sorted_turns(turns).mapInArrow(run, FORMAT)


_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("formatted", pa.string()), ("turns", pa.int64()),
    ("mask", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])


def _parts(found: list) -> Iterator[pa.RecordBatch]:
    """Arrow batches of a few parts each, so that long ones don't gather."""
    for at in range(0, len(found), 64):
        rows = []
        for conv, part, piece, turns in found[at:at + 64]:
            formatted, mask = format_turns(turns)
            rows.append({"conv_id": conv, "part": part, "piece": piece, "formatted": formatted, "turns": len(turns),
                         "mask": [{"start": a, "stop": b} for a, b in mask]})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


class _Digest:
    """What is reported of one conversation, fed part by part."""

    def __init__(self):
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, mask: list) -> None:
        self.chars += len(formatted)
        for role, content, _, _ in parse(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{content}\n".encode())
        for span in mask:
            content = unescape(formatted[span["start"]:span["stop"]])
            self.loss_chars += len(content)
            self.learned.update(content.encode())

    def row(self, conv: int | None) -> tuple:
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_NAMES = [c.split()[0] for c in DIGESTS.split(", ")]


def digests(parts: DataFrame) -> DataFrame:
    """Turns and learned text of every conversation, parsed from its formatted parts.

    A partition has whole conversations, sorted, and streams over their parts.
    """

    def run(batches):
        now, digest = None, None
        for batch in batches:
            out = []
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "formatted", "mask"))
            for conv, formatted, mask in zip(*columns, strict=True):
                if digest is None or conv != now:
                    if digest is not None:
                        out.append(digest.row(now))
                    now, digest = conv, _Digest()
                digest.add(formatted, mask)
            if out:
                yield _digest_batch(out)
        if digest is not None:
            yield _digest_batch([digest.row(now)])

    text.small_batches(parts.sparkSession)
    ordered = parts.select("conv_id", "part", "piece", "formatted", "mask").repartition("conv_id") \
        .sortWithinPartitions("conv_id", "part", "piece")
    return ordered.mapInArrow(run, DIGESTS)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], _NAMES)


def round_trip(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Format all conversations into a written table, read it back and report what it holds."""
    return digests(durable(format_conversations(turns, part_chars), "chat"))


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and conversation -1, whose texts are made of the template's own controls."""
    probe = f"{CLOSE}{OPEN}{LEARNED} ok"
    columns = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
               F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")]
    rows = turns.sparkSession.createDataFrame([(-1, 0, "user", probe), (-1, 1, LEARNED, probe)],
                                              "conv_id long, turn long, role string, text string")
    return turns.select(columns).unionByName(rows)
