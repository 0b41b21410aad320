"""Chat formatting from event logs: streamed deltas, edits and regenerations folded into messages, then rendered.

A log has a row for each event, in columns conv_id, turn, message, seq (a long), kind, role and text. ``turn`` and
``message`` name the message an event is about; ``seq`` is its place in the conversation's history. Kinds:

* ``message`` opens the message with its role and text; a later one about the same message replaces it;
* ``delta`` appends its text, and opens the message if nothing has;
* ``edit`` replaces the text, and the role if it gives one;
* ``regenerate`` voids what came before it (smaller seq) about its turn and all later turns, then opens its message.

The log is dealt by conversation and sorted by turn, message and sequence, regenerations of a turn first, so one pass with
the state of a single message folds it: what voids an event is known when the event comes. Conversations of more than
``SPLIT_BYTES`` are dealt in lots of messages instead, with their regenerations copied to every lot; their rendered messages
are sorted once more to be read in order.

A conversation is rendered as ``### role``, a line end, the text and ``</turn>`` with a line end for each message. Inside
roles and texts a backslash stands before every backslash and ``#`` and inside every ``</``, and line ends in roles are
written ``\\n``, so none of the marks can occur there, and ``unescape`` gives back what was written.

Null texts and roles are empty; null or unknown kinds count as ``message``; a null seq comes before all others, a null turn
or message before all others of its level, and rows without conv_id are one conversation. Events equal in turn, message and
seq come in the order of kind, role and text. Repeated ``message`` events are one message. Columns of other names are not
read. An empty log gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lookfuse.llm.common import stored

#: A conversation with more bytes of text is folded in lots of about so many, and rendered in a row for each message.
SPLIT_BYTES = 8_000_000
#: Code points in a streamed delta that ``turn_events`` makes.
DELTA = 256
ASSISTANT = "assistant"

_OPEN, _CLOSE = b"### ", b"</turn>\n"
_ESCAPED = re.compile(rb"\\(.)", re.S)
_CONTINUED = bytes(range(0x80, 0xC0))
_EVENT = ["turn", "message", "seq", "kind", "role", "text"]
_KINDS = ["message", "delta", "edit"]


def escape(text: bytes) -> bytes:
    return text.replace(b"\\", b"\\\\").replace(b"#", b"\\#").replace(b"</", b"<\\/")


def unescape(text: bytes) -> bytes:
    if b"\\" not in text:
        return text
    return _ESCAPED.sub(lambda m: b"\n" if m[1] == b"n" else m[1], text)


def code_points(text: bytes) -> int:
    return len(text.translate(None, _CONTINUED))


def render(role: bytes, text: bytes) -> tuple[bytes, int, int]:
    """A message as it is written, and where in it, in code points, the text starts and ends."""
    head = _OPEN + escape(role).replace(b"\n", b"\\n") + b"\n"
    body = escape(text)
    start = code_points(head)
    return head + body + _CLOSE, start, start + code_points(body)


def parse(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(role, text) of each message of a rendered conversation."""
    for piece in formatted.split(_CLOSE)[:-1]:
        role, _, text = piece.removeprefix(_OPEN).partition(b"\n")
        yield unescape(role), unescape(text)


def turn_events(turns: DataFrame, delta: int = DELTA) -> DataFrame:
    """A log for a table of finished turns (conv_id, turn, role, text): what the assistant says is streamed.

    Every row is a message of its own; rows of equal conv_id and turn come in the order of a hash of role and text, and equal rows next to each other.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    last = F.when(role == ASSISTANT, F.greatest(F.ceil(F.length(text) / delta) - 1, F.lit(0))).otherwise(0).cast("int")
    message = F.concat(F.lpad(F.hex(F.xxhash64(role, text)), 16, "0"), F.lit("-"), F.col("row").cast("string"))
    streamed = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i * delta + 1, F.lit(delta)))
    pieces = F.when(role == ASSISTANT, streamed).otherwise(F.array(text))
    # A row's number only tells equal rows apart; it is given before the row is cut.
    numbered = turns.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("row"))
    rows = numbered.select("conv_id", "turn", message.alias("message"), role.alias("role"), F.posexplode(pieces).alias("seq", "text"))
    kind = F.when(F.col("seq") == 0, "message").otherwise("delta")
    return rows.select("conv_id", "turn", "message", F.col("seq").cast("long").alias("seq"), kind.alias("kind"), "role", "text")


def _sorted_events(log: DataFrame, lots: Column, spread: bool) -> DataFrame:
    """Events dealt by conversation and lot, in folding order; a regeneration is a cut in every lot, then a message."""
    regenerates = F.coalesce(F.col("kind") == "regenerate", F.lit(False))
    own = F.pmod(F.xxhash64("turn", "message"), F.col("lots")).cast("int") if spread else F.lit(0)
    event = F.struct(own.alias("lot"), F.lit(False).alias("cut"))
    everywhere = F.transform(F.sequence(F.lit(0), F.col("lots") - 1), lambda i: F.struct(i.cast("int").alias("lot"), F.lit(True).alias("cut")))
    rows = (
        log.select(
            "conv_id",
            "turn",
            F.col("message").cast("string").alias("message"),
            F.coalesce(F.col("seq").cast("long"), F.lit(-(2**63))).alias("seq"),
            F.when(F.col("kind").isin(_KINDS), F.col("kind")).when(regenerates, "regenerate").otherwise("message").alias("kind"),
            "role",
            F.coalesce("text", F.lit("")).alias("text"),
            lots.cast("int").alias("lots"),
        )
        .withColumn("at", F.explode(F.when(F.col("kind") == "regenerate", F.concat(F.array(event), everywhere)).otherwise(F.array(event))))
        .select("conv_id", "at.lot", "turn", "at.cut", "message", "seq", "kind", F.col("role").cast("binary").alias("role"), F.when(~F.col("at.cut"), F.col("text")).cast("binary").alias("text"))
    )
    return rows.repartition("conv_id", "lot").sortWithinPartitions("conv_id", "lot", "turn", F.desc("cut"), "message", "seq", "kind", "role", "text")


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, lot, turn, message, role, text) of the messages that stay, from sorted events."""
    none = object()
    conv, slot, cut, role, parts = none, none, None, None, None
    for batch in batches:
        for conv_id, lot, turn, cuts, message, seq, kind, said, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != (conv_id, lot):
                if parts is not None:
                    yield (*conv, *slot, role or b"", b"".join(parts))
                conv, slot, cut, parts = (conv_id, lot), none, None, None
            if slot != (turn, message):
                if parts is not None:
                    yield (*conv, *slot, role or b"", b"".join(parts))
                slot, role, parts = (turn, message), None, None
            if cuts:
                cut = seq if cut is None else max(cut, seq)
            elif cut is None or seq >= cut:
                if parts is None or kind in ("message", "regenerate"):
                    role, parts = said, [text]
                elif kind == "delta":
                    parts.append(text)
                else:
                    role, parts = said if said is not None else role, [text]
    if parts is not None:
        yield (*conv, *slot, role or b"", b"".join(parts))


class _Rows:
    """Rows on their way out, in batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= 10_000 or self.size > 16_000_000:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0


def _rendering(whole: bool, schema: pa.Schema):
    """For sorted events: a row for each conversation, or for each message, with the spans of what the assistant said."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        key, pieces, starts, ends, at = None, [], [], [], 0
        for conv_id, _, turn, message, role, text in _messages(batches):
            found = (conv_id, None, None) if whole else (conv_id, turn, message)
            if pieces and (found != key or not whole):
                yield from out.add((*key, b"".join(pieces), starts, ends), at)
                pieces, starts, ends, at = [], [], [], 0
            key = found
            piece, start, end = render(role, text)
            if role == ASSISTANT.encode():
                starts.append(at + start)
                ends.append(at + end)
            pieces.append(piece)
            at += code_points(piece)
        if pieces:
            yield from out.add((*key, b"".join(pieces), starts, ends), at)
        yield from out.rest()

    return run


def _reading(schema: pa.Schema):
    """For rendered rows in order: what a reader of each conversation gets back, as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        conv, turns = None, 0
        for batch in batches:
            for conv_id, formatted, starts, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not turns or conv_id != conv:
                    if turns:
                        yield from out.add((conv, turns, said.hexdigest(), loss_chars, loss.hexdigest(), chars), 0)
                    conv, turns, said, loss, loss_chars, chars = conv_id, 0, hashlib.sha256(), hashlib.sha256(), 0, 0
                for role, text in parse(formatted):
                    turns += 1
                    for piece in (role, b"\n", text, b"\n"):
                        said.update(piece)
                chars += code_points(formatted)
                points = formatted.decode("utf-8", "surrogateescape") if starts else ""
                for start, end in zip(starts, ends, strict=True):
                    text = unescape(points[start:end].encode("utf-8", "surrogateescape"))
                    loss.update(text)
                    loss_chars += code_points(text)
        if turns:
            yield from out.add((conv, turns, said.hexdigest(), loss_chars, loss.hexdigest(), chars), 0)
        yield from out.rest()

    return run


def _mapped(df: DataFrame, fields: list[tuple[str, T.DataType]], function) -> DataFrame:
    """``function`` makes a row function for an Arrow schema of ``fields``."""
    schema = T.StructType([T.StructField(name, kind) for name, kind in fields])
    return df.mapInArrow(function(to_arrow_schema(schema)), schema)


def format_conversations(log: DataFrame, split_bytes: int = SPLIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """Rendered conversations: those with up to ``split_bytes`` of text in a row each, larger ones in a row for each message.

    Columns conv_id, turn, message (both null for whole conversations), formatted, and loss_starts and loss_ends: where, in
    code points of the row, the text of each assistant message starts and ends. The rows of a large conversation, in the
    order of turn and message, are its rendered form.
    """
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)
    large = stored(log.groupBy("conv_id").agg(size.alias("bytes")).where(F.col("bytes") > split_bytes), "conversations")
    large = large.select(F.col("conv_id").alias("large_id"), F.ceil(F.col("bytes") / split_bytes).cast("int").alias("lots"))
    log = log.select("conv_id", *_EVENT)
    same = log["conv_id"].eqNullSafe(large["large_id"])
    parts = []
    for whole, events in ((True, log.join(large, same, "left_anti").withColumn("lots", F.lit(1))), (False, log.join(large, same))):
        events = _sorted_events(events, F.col("lots"), not whole)
        fields = [("conv_id", log.schema["conv_id"].dataType), ("turn", log.schema["turn"].dataType), ("message", T.StringType()), ("formatted", T.BinaryType())]
        fields += [(name, T.ArrayType(T.LongType())) for name in ("loss_starts", "loss_ends")]
        parts.append(_mapped(events, fields, lambda schema, whole=whole: _rendering(whole, schema)))
    return parts[0], parts[1]


def read_back(rendered: tuple[DataFrame, DataFrame]) -> DataFrame:
    """What the rendered rows of ``format_conversations`` say, a row for each conversation.

    conv_id, n_turns, turns_sha256 (role, line end, text, line end of each message), loss_chars and loss_sha256 (all text
    under the loss spans), formatted_chars. A large conversation is read as a stream.
    """
    whole, messages = (df.select("conv_id", "formatted", "loss_starts", "loss_ends", "turn", "message") for df in rendered)
    messages = messages.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "message")
    fields = [("conv_id", whole.schema["conv_id"].dataType), ("n_turns", T.LongType()), ("turns_sha256", T.StringType())]
    fields += [("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType())]
    read = [_mapped(df.drop("turn", "message"), fields, _reading) for df in (whole, messages)]
    return read[0].unionByName(read[1])
