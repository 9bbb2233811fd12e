"""Near-duplicates by SimHash, compared bit plane by bit plane.

Equal fingerprints are folded first. Of ``radius + 2`` bit blocks two fingerprints
within the radius share at least two, so each fingerprint is keyed by every pair
of its blocks. A bucket is cut into parts of bounded size, and every pair of parts
is compared in a task of its own: the bits of all its fingerprints are stored as
vertical planes, one XOR and a few ANDs update the distances of 64 of them, and a
block is left as soon as every counter is beyond the radius.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetflow.llm.components import components

BITS = 64
#: Fingerprints in a part of a bucket; and lanes of small buckets compared together.
PART = 2048
LANES = 512
_QUERIES = 256
_EVERY = 8
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """The SimHash of one text, unsigned."""
    import xxhash

    words = (text or "").encode().lower().split()  # of bytes: ASCII only
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    starts, ends = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    digest, set_in = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        span = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])
        h = np.array([digest(joined[s:e], seed) for s, e in span], dtype="<u8")
        set_in += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id`` and ``fp`` (the fingerprint as a signed long) of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit b of every value in row b, 64 values a word."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return _packed(bits)


def _packed(bits: np.ndarray) -> np.ndarray:
    short = -bits.shape[1] % 64
    return np.ascontiguousarray(np.packbits(np.pad(bits, ((0, 0), (0, short))), axis=1, bitorder="little")).view(np.uint64)


def near(values: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of one group that differ in ``radius`` bits at most."""
    n, planes = len(values), _planes(values)
    depth = radius.bit_length()
    bias = (1 << depth) - 1 - radius
    everything = np.uint64(0xFFFFFFFFFFFFFFFF)
    lanes = np.arange(n)
    for at in range(0, n, _QUERIES):
        mine = lanes[at : at + _QUERIES]
        open_ = _packed((group[None, :] == group[mine, None]) & (lanes[None, :] > mine[:, None]))
        over = ~open_
        counters = [np.full(open_.shape, everything if bias >> k & 1 else 0, np.uint64) for k in range(depth)]
        for b in range(BITS):
            flip = np.where(values[mine] >> np.uint64(b) & np.uint64(1), everything, np.uint64(0))
            carry = planes[b][None, :] ^ flip[:, None]
            for k in range(depth):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
            if b % _EVERY == _EVERY - 1 and (over == everything).all():
                break
        else:
            found = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, :n]
            i, j = np.nonzero(found)
            yield mine[i], j


def _stars(values: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each value that has a smaller lane in its local component, and that lane's value."""
    label = np.arange(len(values))
    for i, j in near(values, group, radius):
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                break
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(values, group):
            v, u = _stars(values, group, radius)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        rest: np.ndarray | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
                rest = rows if rest is None else np.concatenate([rest, rows])
            if rest is None or not len(rest):
                continue
            new = np.flatnonzero((rest[1:, :-1] != rest[:-1, :-1]).any(axis=1)) + 1
            bounds = [0, *new.tolist()] + ([len(rest)] if batch is None else [])
            group = np.zeros(len(rest), np.int64)
            group[new] = 1
            group = np.cumsum(group)
            values, start = np.ascontiguousarray(rest[:, -1]).view(np.uint64), 0
            for end, after in zip(bounds[1:], [*bounds[2:], None]):
                if after is None or after - start > LANES:
                    yield edges(values[start:end], group[start:end])
                    start = end
            rest = rest[start:]

    return run


def _blocks(radius: int) -> list[int]:
    """A mask for every pair of the radius + 2 blocks of bits, as signed longs."""
    n = radius + 2
    cuts = [BITS * k // n for k in range(n + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(cuts)]
    pairs = [x | y for x, y in itertools.combinations(masks, 2)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in pairs]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Pairs u, v of fingerprints ``fp`` that connect all those within ``radius`` bits."""
    keys = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(_blocks(radius))]
    keyed = distinct.select("fp", F.inline(F.array(*keys)))
    shared = keyed.groupBy("t", "key").count().where("count > 1")
    rows = keyed.join(shared, ["t", "key"])
    parts = F.ceil(F.col("count") / PART).cast("int")
    rows = rows.select("t", "key", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("t", "key", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "fp")
    rows = rows.repartition("t", "key", "a", "b").sortWithinPartitions("t", "key", "a", "b")
    return rows.mapInArrow(_compare(radius), "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """The id, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Rows are linked when their fingerprints differ in ``radius`` bits at most;
    ``component_id`` is the smallest id reachable. A text without words (null or
    empty) has the fingerprint zero and is linked like any other. Null ids are
    passed over as component ids unless a component has no other. Repeated rows
    come back as often as they occur; empty input gives no rows; other columns
    are not read.
    """
    from facetflow.session import write_out

    fps = write_out(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(links(distinct.select("fp"), radius))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.join(smallest, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
