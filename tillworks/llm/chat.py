"""Chat transcripts from event logs, formatted for training with a loss mask.

A log holds one row per event: conversation, message, sequence number, kind and text. Kinds: ``open`` starts a message and
states its turn and role, ``delta`` appends a streamed piece, ``edit`` replaces the whole text, ``regenerate`` throws it
away and streams anew. ``messages`` partitions the log by conversation and message, sorts by sequence number and folds each
run of events into the final message; a task holds one message at a time, and the obsolete versions of none.

``formatted`` renders the messages in the order of their turns and cuts conversations into chunks of whole turns, so that
one of any length is a run of rows in several tasks and never one value. ``digests`` reads the chunks back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.storage import stored

OPEN, DELTA, EDIT, REGENERATE = "open", "delta", "edit", "regenerate"
TRAINED = "assistant"  # the role whose text is under the loss mask
CHUNK_CHARS = 1 << 18
BATCH_CHARS = 1 << 22
PIECE_CHARS, MOST_PIECES = 256, 64  # of a text as the registered query streams it
BEGIN, CLOSE, END = "<turn:", ">", "</turn>\n"
HEADER = re.compile(r"<turn:((?:[^\\>]|\\.)*)>", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
CONTROL = r"\### Assistant: </turn> ok"  # text of the planted conversation -7

_MESSAGE = "conv_id long, message long, turn long, role string, text string"
_CHUNK = "conv_id long, part int, chunk long, turns long, formatted string, loss_starts array<long>, loss_ends array<long>"
_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    """The text without any mark of the template; ``unescape`` gives it back."""
    return text.replace("\\", "\\\\").replace("<turn:", "<\\turn:").replace("</turn>", "<\\/turn>")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text lies in it."""
    head = BEGIN + escape(role).replace(">", "\\>") + CLOSE
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    for each in formatted.split(END)[:-1]:
        head = HEADER.match(each)
        if head is None:
            raise ValueError("a turn does not start with its mark")
        yield unescape(head[1]), unescape(each[head.end() :])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _in_batches(rows: Iterable[tuple], text_at: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of a bounded number of rows and characters (or one row)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_at] or "") + 64
        if size > BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def folded() -> Iterator[tuple]:
        key, at, place, pieces, started = None, None, (None, None), [], False
        for conv, message, seq, kind, where, role, text in _rows(batches):
            if not started or key != (conv, message):
                if started:
                    yield (*key, *place, "".join(pieces))
                key, place, pieces, started = (conv, message), (None, None), [], True
            elif seq == at:
                continue  # the same event, delivered again
            at = seq
            if kind == OPEN:
                place, pieces = (where, role), [text or ""]
            elif kind == DELTA:
                pieces.append(text or "")
            elif kind in (EDIT, REGENERATE):
                pieces = [text or ""]
        if started:
            yield (*key, *place, "".join(pieces))

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(("conv_id", "message", "turn", "role", "text"), kinds)))
    return _in_batches(folded(), 4, schema)


def messages(events: DataFrame) -> DataFrame:
    """The final messages of a log: ``conv_id``, ``message``, ``turn``, ``role`` and ``text``.

    ``events`` has ``conv_id``, ``message`` (which is told apart within its conversation), ``seq`` (order of a message's
    events, null first), ``kind``, ``turn``, ``role`` and ``text``; further columns are ignored. Null text is empty. Of
    events of one message with the same ``seq``, which are repeats, the first in order of kind and text counts. Unknown kinds
    change nothing. A message that was never opened has neither turn nor role. Null ids are ids like any other.
    """
    log = events.select("conv_id", "message", "seq", "kind", "turn", "role", "text")
    log = log.repartition("conv_id", "message").sortWithinPartitions("conv_id", "message", "seq", "kind", "text")
    return log.mapInArrow(_fold, _MESSAGE)


def _renderer(trained: str, chunk_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def chunks() -> Iterator[tuple]:
            key, number, held, size, starts, ends = None, 0, [], 0, [], []
            for conv, role, text in _rows(batches):
                if held and (conv != key or size >= chunk_chars):
                    yield key, part, number, len(held), "".join(held), starts, ends
                    held, size, starts, ends = [], 0, [], []
                    number += 1
                key = conv
                made, first, last = turn(role or "", text)
                if role == trained:
                    starts.append(size + first)
                    ends.append(size + last)
                held.append(made)
                size += len(made)
            if held:
                yield key, part, number, len(held), "".join(held), starts, ends

        longs = pa.list_(pa.int64())
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), longs, longs]
        names = ("conv_id", "part", "chunk", "turns", "formatted", "loss_starts", "loss_ends")
        return _in_batches(chunks(), 4, pa.schema(list(zip(names, kinds))))

    return run


def formatted(final: DataFrame, trained: str = TRAINED, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Formatted conversations from a stored table of messages: rows ``conv_id``, ``part``, ``chunk``, ``turns``,
    ``formatted``, and the loss mask's ``loss_starts`` and ``loss_ends`` (characters of ``formatted``).

    A conversation's turns are those of its chunks in the order of (part, chunk); most conversations are one chunk. Turns
    are ordered by turn (null last), role, text hash and message. Messages are dealt to tasks by ranges of that order, so
    that a conversation with many messages is shared by several. A role of null reads back as empty.
    """
    order = [F.col("conv_id"), F.asc_nulls_last("turn"), F.col("role"), F.xxhash64("text"), F.col("message")]
    parted = final.repartitionByRange(*order).sortWithinPartitions(*order)
    return parted.select("conv_id", "role", "text").mapInArrow(_renderer(trained, chunk_chars), _CHUNK)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def read() -> Iterator[tuple]:
        key, started, n, chars, loss_chars = None, False, 0, 0, 0
        whole, loss = hashlib.sha256(), hashlib.sha256()
        for conv, text, starts, ends in _rows(batches):
            if started and conv != key:
                yield key, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars
                n, chars, loss_chars, whole, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            key, started = conv, True
            for role, said in turns(text):
                n += 1
                whole.update(f"{role}\n{said}\n".encode())
            for first, last in zip(starts, ends):
                under = unescape(text[first:last])
                loss_chars += len(under)
                loss.update(under.encode())
            chars += len(text)
        if started:
            yield key, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return _in_batches(read(), 2, pa.schema(list(zip(names, kinds))))


def digests(chunks: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from them: number of turns, SHA-256 of role, line break, text and line
    break of all turns, characters and SHA-256 of the text under the loss mask, and formatted characters.

    A SHA-256 is one chain over a conversation's bytes, so a conversation's chunks pass through one task, a few at a time.
    """
    parted = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    return parted.select("conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(_digest, _DIGEST)


def log_of(rows: DataFrame, trained: str = TRAINED) -> DataFrame:
    """The event log of a stored table of ``conv_id``, ``turn``, ``role`` and ``text``: every row is a message, opened first;
    those of the trained role are begun, regenerated and streamed in pieces, the others drafted and edited."""
    text = F.coalesce("text", F.lit(""))
    size = F.greatest(F.lit(PIECE_CHARS), F.ceil(F.length(text) / MOST_PIECES)).cast("int")
    numbers = F.sequence(F.lit(0), F.floor((F.greatest(F.length(text), F.lit(1)) - 1) / size).cast("int"))

    def event(seq, kind: str, said, opens: bool = False):
        turn_, role = (F.col("turn"), F.col("role")) if opens else (F.lit(None).cast("long"), F.lit(None).cast("string"))
        return F.struct(F.lit(seq).cast("long").alias("seq") if isinstance(seq, int) else seq.cast("long").alias("seq"),
                        F.lit(kind).alias("kind"), turn_.alias("turn"), role.alias("role"), said.alias("text"))

    begun = [event(0, OPEN, F.lit(""), opens=True), event(1, DELTA, F.left(text, F.lit(PIECE_CHARS // 8)))]
    streamed = F.transform(numbers, lambda i: event(i + 3, DELTA, F.substring(text, i * size + 1, size)))
    regenerated = F.concat(F.array(*begun, event(2, REGENERATE, F.lit(""))), streamed)
    edited = F.array(*begun, event(2, EDIT, text))
    log = F.when(F.col("role") == trained, regenerated).otherwise(edited)
    return rows.select("conv_id", "message", F.explode(log).alias("e")).select("conv_id", "message", "e.*")


def conversations(rows: DataFrame) -> DataFrame:
    """Formatted conversations of a stored table of ``conv_id``, ``turn``, ``role`` and ``text``, and of conversation -7, whose
    two texts look like marks. Rows with the same turn, repeated ones too, are turns of their own; null conv_id is one
    conversation."""
    spark = rows.sparkSession
    planted = spark.createDataFrame(
        [(-7, 0, "user", CONTROL, -2), (-7, 1, TRAINED, CONTROL, -1)], "conv_id long, turn long, role string, text string, message long"
    )
    rows = rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("message"))
    return stored(formatted(stored(messages(log_of(rows.unionByName(planted))), "messages")), "conversations")


_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '<turn:', '<\turn:'), '</turn>', '<\/turn>')"
ORACLE = rf"""
WITH said AS (
    SELECT conv_id, turn, role AS stated, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', 'user', '{CONTROL}' UNION ALL SELECT -7, 1, 'assistant', 'assistant', '{CONTROL}'
), made AS (
    SELECT *, '<turn:' || replace({_ESCAPED.format('role')}, '>', '\>') || '>' || {_ESCAPED.format('text')} || '</turn>' || chr(10)
        AS formatted
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, stated NULLS FIRST)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (stated = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST) FILTER (stated = 'assistant'), '')) AS loss_sha256,
    sum(length(formatted))::BIGINT AS formatted_chars
FROM made GROUP BY conv_id
"""
