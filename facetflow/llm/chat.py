"""Chat formatting from an event log.

A log holds, per conversation and sequence number, events of a message: ``open``
(its role), ``delta`` (more text), ``edit`` (the text anew), ``regenerate`` (what
was streamed is void) and ``delete``. Events are folded per message, so a hot
conversation is spread over its messages, and rendered message by message. Only
the reading back of a conversation is sequential: its digests run over the sorted
segments and hold nothing but their state.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
#: Code points of a delta when a log is made from whole messages.
DELTA = 512
_READ = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def log_of(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, delta: int = DELTA) -> DataFrame:
    """The event log of finished messages: each is opened and streamed in deltas.

    Rows of one conversation are ordered by turn, then role and text; rows that
    share a turn are messages of their own. Null texts and roles are empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), text.alias("text")
    )
    same = Window.partitionBy("conv", "turn").orderBy("role", "text")
    rows = rows.withColumn("nth", F.row_number().over(same).cast("long"))
    pieces = F.floor((F.char_length("text") + delta - 1) / delta).cast("int")
    deltas = F.when(
        pieces > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(pieces, F.lit(1))),
            lambda i: F.struct(
                F.lit("delta").alias("kind"), i.cast("long").alias("step"), F.lit(None).cast("string").alias("role"), F.substring("text", (i - 1) * delta + 1, F.lit(delta)).alias("text")
            ),
        ),
    )
    opened = F.array(F.struct(F.lit("open").alias("kind"), F.lit(0).cast("long").alias("step"), F.col("role").alias("role"), F.lit(None).cast("string").alias("text")))
    events = rows.select("conv", F.struct("turn", "nth").alias("message"), F.inline(F.concat(opened, F.coalesce(deltas, F.filter(opened, lambda _: F.lit(False))))))
    return events.select("conv", F.struct("message", "step").alias("seq"), "message", "kind", "role", "text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (``conv, message, at, role, text``) of a log (``conv, seq, message, kind, role, text``).

    Events count in the order of ``seq`` (any orderable type; equal events at one
    place apply as often as they occur). ``at`` is the place of the message's
    first opening. A message that is never opened, or deleted after its last
    opening, is not there. An edit's text and later deltas follow each other;
    texts are null where nothing was said, roles those of the last opening.
    """
    state = events.groupBy("conv", "message").agg(
        F.min(F.when(F.col("kind") == "open", F.col("seq"))).alias("at"),
        F.max(F.when(F.col("kind") == "open", F.struct("seq", "role"))).alias("opening"),
        F.max(F.when(F.col("kind") == "delete", F.col("seq"))).alias("deleted"),
        F.array_sort(F.collect_list(F.when(F.col("kind") != "delete", F.struct("seq", "kind", "text")))).alias("told"),
    )
    # Position of the last event that makes what went before void.
    resets = F.transform("told", lambda e, i: F.when(e["kind"] != "delta", i).otherwise(-1))
    state = state.withColumn("from", F.greatest(F.array_max(resets), F.lit(0)))
    texts = F.transform(F.slice("told", F.col("from") + 1, F.size("told") - F.col("from")), lambda e: F.coalesce(e["text"], F.lit("")))
    state = state.where("at is not null and (deleted is null or deleted < opening.seq)")
    return state.select("conv", "message", "at", F.coalesce("opening.role", F.lit("")).alias("role"), F.concat_ws("", texts).alias("text"))


def escape(text: Column) -> Column:
    """No control string stands in the result; ``unescape`` gives the text back."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(messages: DataFrame) -> DataFrame:
    """``conv, at, segment, loss_start, loss_end``: a conversation is its segments in the order of ``at``.

    The loss mask covers the escaped text of a trained role's message, as code
    points of the segment from ``loss_start`` up to ``loss_end``; both are null
    elsewhere.
    """
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n"))
    head, body = F.concat(F.lit(START), role, F.lit("\n")), escape(F.col("text"))
    trained = F.col("role") == TRAINED
    return messages.select(
        "conv",
        "at",
        F.concat(head, body, F.lit(END + "\n")).alias("segment"),
        F.when(trained, F.char_length(head)).cast("long").alias("loss_start"),
        F.when(trained, F.char_length(head) + F.char_length(body)).cast("long").alias("loss_end"),
    )


def _role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def read_back(rendered: DataFrame) -> DataFrame:
    """One row per conversation, from the rendered text alone.

    ``n_turns``, ``turns_sha256`` (role, line feed, text, line feed per turn),
    ``loss_chars`` and ``loss_sha256`` (the unescaped text under the loss mask)
    and ``formatted_chars``. Conversations are partitioned and sorted by Spark
    and read segment by segment.
    """
    kind = rendered.schema["conv"].dataType
    schema = T.StructType(
        [T.StructField("conv", kind)]
        + [
            T.StructField(n, t)
            for n, t in (
                ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()),
                ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()),
            )
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out, arrow = None, [], None

        def closed():
            conv, turns, digest, loss, loss_digest, chars = state
            return conv, turns, digest.hexdigest(), loss, loss_digest.hexdigest(), chars

        def batch_of(rows):
            types = [arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)

        for batch in batches:
            arrow = batch.schema.field(0).type
            for conv, segment, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state[0] != conv:
                    if state is not None:
                        out.append(closed())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in _READ.findall(segment):
                    state[1] += 1
                    state[2].update(f"{_role(role)}\n{unescape(text)}\n".encode())
                if start is not None:
                    masked = unescape(segment[start:end])
                    state[3] += len(masked)
                    state[4].update(masked.encode())
                state[5] += len(segment)
            if len(out) >= 10_000:
                yield batch_of(out)
                out = []
        if state is not None:
            out.append(closed())
        if out:
            yield batch_of(out)

    ordered = rendered.repartition("conv").sortWithinPartitions("conv", "at")
    return ordered.select("conv", "segment", "loss_start", "loss_end").mapInArrow(run, schema)


def format_chats(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Segments of all conversations: the log of ``messages``, folded and rendered.

    Null texts and roles count as empty, null turns come first, rows without a
    conversation id form one of their own; repeated rows are turns of their own.
    Empty input gives no rows; other columns are not read.
    """
    return render(fold(log_of(messages, conv_col, turn_col, role_col, text_col)))
