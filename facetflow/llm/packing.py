"""Hierarchical multi-length packing of tokenised documents.

Every task tokenises its own documents, routes the pieces to context-size tiers
and packs them block by block, so no row is shuffled and no task holds more than
one block. A piece goes to the smallest tier that holds it; the gap it leaves is
filled with the longest shorter pieces that fit, and closed by cutting one more.
Windows of all tiers are therefore full. What is left at the end of a task goes
into ever smaller powers of two.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetflow.llm.encoding import word_encoder

TIERS = (512, 1024, 2048, 4096)


class _Pool:
    """Pieces by length."""

    def __init__(self):
        self.pieces: list[tuple[int, int, int, int]] = []  # length, age, document, start
        self.tokens = 0
        self._age = 0

    def put(self, length: int, document: int, start: int) -> None:
        self._age += 1
        bisect.insort(self.pieces, (length, self._age, document, start))
        self.tokens += length

    def take(self, at: int) -> tuple[int, int, int]:
        length, _, document, start = self.pieces.pop(at)
        self.tokens -= length
        return document, start, length

    def fill(self, gap: int) -> tuple[int, int, int]:
        """The longest piece that fits, else the shortest one, cut."""
        at = bisect.bisect_left(self.pieces, (gap + 1,)) - 1
        if at >= 0:
            return self.take(at)
        document, start, length = self.take(0)
        self.put(length - gap, document, start + gap)
        return document, start, gap


def _windows(pool: _Pool, tiers: tuple[int, ...], last: bool) -> Iterator[tuple[int, list]]:
    """Full windows (size, pieces) from the pool; unless ``last``, what can't fill one stays."""
    while pool.pieces:
        longest = pool.pieces[-1][0]
        size = next(t for t in tiers if t >= longest)
        if pool.tokens < size:
            if not last:
                return
            size = 1 << (pool.tokens.bit_length() - 1)
        pieces, gap = [], size
        while gap:
            pieces.append(pool.take(len(pool.pieces) - 1) if not pieces and longest <= size else pool.fill(gap))
            gap -= pieces[-1][2]
        yield size, pieces


class _Steps:
    """Windows in step groups of equal tokens: one tier each, the task's last ones mixed."""

    def __init__(self, step_tokens: int):
        self.step_tokens, self.open, self.done = step_tokens, {}, 0

    def add(self, size: int, pieces: list) -> list[tuple[int, int, list]]:
        group = self.open.setdefault(size, [])
        group.append(pieces)
        if len(group) * size < self.step_tokens:
            return []
        self.done += 1
        return [(self.done - 1, size, p) for p in self.open.pop(size)]

    def rest(self) -> Iterator[tuple[int, int, list]]:
        filled = 0
        for size in sorted(self.open, reverse=True):
            for pieces in self.open[size]:
                if filled + size > self.step_tokens:
                    self.done, filled = self.done + 1, 0
                filled += size
                yield self.done, size, pieces


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    tiers: tuple[int, ...] = TIERS,
    block_tokens: int = 1 << 20,
    step_tokens: int = 8 * 4096,
) -> DataFrame:
    """One row per piece of a document in a sequence.

    Columns: the id, ``start`` and ``length`` in the document's ids (``end_id``
    is the last of them), ``doc_tokens``, ``sequence_id``, ``offset`` in the
    sequence, ``window`` (the sequence's length), ``step`` (its step group) and
    ``ids`` (unsigned little-endian 32-bit). ``tiers`` are powers of two; every
    sequence is as long as its window, so none is padded.

    A null text counts as empty, a null id stays null; repeated rows are packed
    as often as they occur; very long documents are cut into windows of the
    largest tier; empty input gives no rows; other columns are not read.
    """
    sizes = tuple(sorted(tiers))
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset", "window", "step")]
        + [T.StructField("ids", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_encoder(tokenizer_path), end_id.to_bytes(4, "little")
        base, count = TaskContext.get().partitionId() << 33, 0
        pool, steps = _Pool(), _Steps(step_tokens)
        held: dict[int, tuple] = {}  # document: id, ids
        number = 0
        names = [f.name for f in schema]

        def rows(step: int, size: int, pieces: list) -> Iterator[tuple]:
            nonlocal count
            offset = 0
            for document, start, length in pieces:
                key, ids = held[document]
                yield key, start, length, len(ids) // 4, base + count, offset, size, base + step, ids[4 * start : 4 * (start + length)]
                offset += length
            count += 1

        def block(last: bool) -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            for size, pieces in _windows(pool, sizes, last):
                for group in steps.add(size, pieces):
                    out += rows(*group)
            if last:
                for group in steps.rest():
                    out += rows(*group)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), kinds)], names=names)
            waiting = {p[2] for p in pool.pieces} | {d for g in steps.open.values() for w in g for d, _, _ in w}
            for document in held.keys() - waiting:
                del held[document]

        kinds = None
        for batch in batches:
            kinds = kinds or [batch.schema.field(0).type, *[pa.int64()] * 7, pa.binary()]
            all_ids = encode.batch(text.as_py() or "" for text in batch.column(1))
            for key, ids in zip(batch.column(0).to_pylist(), all_ids):
                ids += end
                held[number] = key, ids
                n = len(ids) // 4
                for start in range(0, n, sizes[-1]):
                    pool.put(min(sizes[-1], n - start), number, start)
                number += 1
                if pool.tokens >= block_tokens:
                    yield from block(False)
        if kinds:
            yield from block(True)

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col)
