"""Token ids in files of directly addressable codes.

An id is split into chunks of fixed widths. Level 0 holds the lowest chunk of
every id, level 1 the next chunk of those that need one, and so on; a bitmap per
level marks the ids that go on, and a directory of ranks says where. So any id
is read with one look per level, without decoding what stands before it.

A file is made of segments of whole documents. One segment is an image

    magic ``DAC1``, number of levels, ids, documents       4 x uint32
    per level: width in bits, number of chunks              2 x uint32
    first id of every document, and the number of ids       uint32 each
    per level: chunks, bitmap, ranks before every 512 bits  padded to 8 bytes

in little-endian order (the last level has no bitmap). Spark writes the images
as rows of Parquet, next to the documents' ids, so that the files lie wherever
Spark can write and a lost task leaves nothing behind.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetflow.llm.encoding import word_encoder

MAGIC = b"DAC1"
#: Bits of the chunks, lowest first; together they hold 32 bits.
WIDTHS = (8, 8, 8, 8)
#: A segment is closed at so many ids.
SEGMENT = 1 << 16
_BLOCK = 512
#: Positions are matched with segments in steps of so many ids.
_STEP = 1 << 20


def _padded(data: bytes) -> bytes:
    """With 8 bytes at least after the end, and a length that 8 divides."""
    return data + bytes(8 + -len(data) % 8)


def _pack(values: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32) & 1).astype(np.uint8)
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def _bitmap(bits: np.ndarray) -> tuple[bytes, bytes]:
    """The bits and the number of ones before every block."""
    packed = np.packbits(bits, bitorder="little").tobytes()
    packed += bytes(-len(packed) % (_BLOCK // 8) + _BLOCK // 8)
    ones = np.bitwise_count(np.frombuffer(packed, np.uint64)).reshape(-1, _BLOCK // 64).sum(axis=1)
    ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
    return packed, ranks.tobytes()


def encode_image(ids: np.ndarray, starts: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """The image of one segment; ``starts`` are the places of its documents' first ids."""
    rest, shift, levels, parts = ids.astype(np.uint32), 0, [], []
    for level, width in enumerate(widths):
        levels.append((width, len(rest)))
        parts.append(_padded(_pack(rest & np.uint32((1 << width) - 1), width)))
        shift += width
        onward = rest >> np.uint32(width) if width < 32 else np.zeros_like(rest)
        goes_on = onward > 0
        if not goes_on.any():
            break
        if level + 1 == len(widths):
            raise ValueError(f"ids need more than {shift} bits")
        bits, ranks = _bitmap(goes_on)
        parts += [_padded(bits), _padded(ranks)]
        rest = onward[goes_on]
    head = MAGIC + struct.pack("<3I", len(levels), len(ids), len(starts))
    head += b"".join(struct.pack("<2I", *x) for x in levels)
    head += np.append(starts, len(ids)).astype("<u4").tobytes()
    return _padded(head) + b"".join(parts)


class Image:
    """Reads one segment; nothing is decoded before it is asked for."""

    def __init__(self, data: bytes):
        magic, levels, self.size, documents = struct.unpack_from("<4s3I", data)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at = 16 + 8 * levels
        self.starts = np.frombuffer(data, "<u4", documents + 1, at).astype(np.int64)
        at = len(_padded(bytes(at + 4 * (documents + 1))))
        self.levels = []
        for k in range(levels):
            width, count = struct.unpack_from("<2I", data, 16 + 8 * k)
            chunks = np.frombuffer(data, np.uint8, len(_padded(bytes(-(-width * count // 8)))), at)
            at += len(chunks)
            words = ranks = None
            if k + 1 < levels:
                length = -(-count // 8)
                length += -length % (_BLOCK // 8) + _BLOCK // 8
                words = np.frombuffer(data, "<u8", length // 8, at)
                at += len(_padded(bytes(length)))
                ranks = np.frombuffer(data, "<u4", length * 8 // _BLOCK, at)
                at += len(_padded(bytes(ranks.nbytes)))
            self.levels.append((width, chunks, words, ranks))

    @staticmethod
    def _chunks(chunks: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
        if width == 8:
            return chunks[at].astype(np.uint32)
        bit = at * width
        value = np.zeros(len(at), np.uint64)
        for k in range(5):
            value |= chunks[(bit >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
        return (value >> (bit & 7).astype(np.uint64) & np.uint64((1 << width) - 1)).astype(np.uint32)

    @staticmethod
    def _rank(words: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before every place."""
        word, block = at >> 6, at // _BLOCK
        out = ranks[block].astype(np.int64)
        for k in range(_BLOCK // 64):
            other = block * (_BLOCK // 64) + k
            out += np.where(other < word, np.bitwise_count(words[other]), 0)
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(words[word] & below)

    def get(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any places of the segment."""
        at = np.asarray(positions, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.size):
            raise IndexError("no such place in the segment")
        out, live, shift = np.zeros(len(at), np.uint32), np.arange(len(at)), 0
        for width, chunks, words, ranks in self.levels:
            out[live] |= self._chunks(chunks, width, at) << np.uint32(shift)
            shift += width
            if words is None:
                break
            on = np.flatnonzero(words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
            live, at = live[on], self._rank(words, ranks, at[on])
        return out

    def all(self) -> np.ndarray:
        """All ids in order: the chunks of a level belong to the marked ids of the one before."""
        live, shift = np.arange(self.size), 0
        out = np.zeros(self.size, np.uint32)
        for width, chunks, words, _ in self.levels:
            out[live] |= self._chunks(chunks, width, np.arange(len(live))) << np.uint32(shift)
            shift += width
            if words is not None:
                marked = np.unpackbits(words.view(np.uint8), count=len(live), bitorder="little")
                live = live[marked.view(bool)]
        return out


def write_ids(
    docs: DataFrame,
    tokenizer_path: str,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    widths: tuple[int, ...] = WIDTHS,
    segment_ids: int = SEGMENT,
) -> None:
    """Write the ids of all texts in ascending order of the document's id.

    Rows are dealt out by ranges of the id, then a digest of the text, so one id
    of many texts is spread; identical rows are told apart by where they were
    read. ``path`` gets ``segments`` (``part, number, first, n_ids, ids, image``;
    ``first`` counts within the part) and ``parts`` (``part, base``), one row per
    partition.

    A null id comes first; a null text is empty and has the end id only; rows of
    one id stand in the order of the digest; repeated rows are written as often
    as they occur; a document is never divided, so a very long one makes a long
    segment; an empty table gives empty files; other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("digest"), F.monotonically_increasing_id().alias("copy"))
    ordered = slim.repartitionByRange("id", "digest", "copy").sortWithinPartitions("id", "digest")
    longs = [T.StructField(n, T.LongType()) for n in ("part", "number", "first", "n_ids")]
    schema = T.StructType([*longs, T.StructField("ids", T.ArrayType(kind)), T.StructField("image", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_encoder(tokenizer_path), end_id.to_bytes(4, "little")
        part, number, first = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        texts: list[bytes] = []
        held, of = 0, None

        def segment() -> pa.RecordBatch:
            sizes = np.array([len(t) // 4 for t in texts])
            image = encode_image(np.frombuffer(b"".join(texts), "<u4"), np.cumsum(sizes) - sizes, widths)
            columns = [*([x] for x in (part, number, first, held)), [keys], [image]]
            types = [*[pa.int64()] * 4, pa.list_(of), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

        for batch in batches:
            of = batch.schema.field(0).type
            all_ids = encode.batch(text.as_py() or "" for text in batch.column(1))
            for key, ids in zip(batch.column(0).to_pylist(), all_ids):
                ids += end
                keys.append(key)
                texts.append(ids)
                held += len(ids) // 4
                if held >= segment_ids:
                    yield segment()
                    number, first = number + 1, first + held
                    keys, texts, held = [], [], 0
        if keys:
            yield segment()

    ordered.select("id", "text").mapInArrow(run, schema).write.parquet(f"{path}/segments")
    spark = docs.sparkSession
    sizes = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")).write.parquet(f"{path}/parts")


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the number of ids in all files before them."""
    parts = spark.read.parquet(f"{path}/parts")
    rows = spark.read.parquet(f"{path}/segments").join(F.broadcast(parts), "part")  # a row per partition of the writer
    return rows.withColumn("start", F.col("base") + F.col("first"))


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Every document of the files: its id, ``start``, ``n_tokens``, ``ids_crc32`` and, if wanted, ``ids`` (unsigned little-endian 32-bit)."""
    rows = segments(spark, path).select("ids", "start", "image")
    kind = rows.schema["ids"].dataType.elementType
    longs = [T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32")]
    own = [T.StructField("ids", T.BinaryType())] if with_ids else []
    schema = T.StructType([T.StructField("id", kind), *longs, *own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.schema.field(0).type.value_type
            for keys, start, data in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2)):
                image = Image(data.as_py())
                ids, starts = image.all().astype("<u4"), image.starts
                pieces = [ids[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                columns = [keys.values, start + starts[:-1], np.diff(starts), [zlib.crc32(p) for p in pieces], pieces]
                types = [of, *[pa.int64()] * 3, *[pa.binary()] * with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def ids_at(spark: SparkSession, path: str, wanted: DataFrame, position_col: str = "position") -> DataFrame:
    """``position, token``: the ids at any places of the whole corpus, places outside it left out.

    Places meet the segments that cover them; a segment is read only at the
    places asked for. Nulls and repeated places are dropped.
    """
    places = wanted.select(F.col(position_col).cast("long").alias("position")).dropna().distinct()
    step = F.floor(F.col("position") / _STEP)
    covered = segments(spark, path).select("part", "number", "start", "n_ids")
    steps = F.sequence(F.floor(F.col("start") / _STEP), F.floor((F.col("start") + F.col("n_ids") - 1) / _STEP))
    covered = covered.withColumn("step", F.explode(steps))
    met = places.withColumn("step", step).join(covered, "step")
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_ids"))
    asked = met.where(inside).groupBy("part", "number").agg(F.sort_array(F.collect_list("position")).alias("positions"))
    rows = segments(spark, path).join(asked, ["part", "number"]).select("start", "positions", "image")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, positions, data in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                at = positions.values.to_numpy(zero_copy_only=False)
                tokens = Image(data.as_py()).get(at - start)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(tokens.astype(np.int64))], names=["position", "token"])

    return rows.mapInArrow(run, "position long, token long")
