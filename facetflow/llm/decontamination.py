"""Benchmark decontamination by greedy string tiling.

Runs of words that a document shares with a test item are seeds. Where the seeds
could cover enough of an item, the longest matches of unmarked words are found by
running Karp-Rabin and marked, longest first, with ever shorter search lengths;
the tiles' share of the item's words is its coverage. Since tiles may stand in any
order, reordered passages are found too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_MATCH = 5
LEAST_COVERAGE = 0.8
#: Words of test items that one broadcast holds; larger sets go in blocks.
BLOCK_WORDS = 500_000
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``length`` ids, modulo 2^64."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, out = _powers(length), np.zeros(n, np.uint64)
    for k in range(length):
        out += ids[k : k + n] * power[length - 1 - k]
    return out


def _windows(ids: np.ndarray, length: int) -> np.ndarray:
    """As ``rolling``, from prefix hashes: their cost doesn't grow with the length."""
    power = _powers(len(ids))
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    prefix = np.concatenate(([np.uint64(0)], np.cumsum(ids * power[: len(ids)], dtype=np.uint64)))
    scale = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(ids), inverse, np.uint64))), dtype=np.uint64)
    n = len(ids) - length + 1
    return (prefix[length:] - prefix[:-length]) * scale[:n] if n > 0 else np.zeros(0, np.uint64)


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    """Which windows of ``length`` hold no marked word."""
    count = np.concatenate(([0], np.cumsum(marked)))
    return count[length:] == count[:-length] if len(marked) >= length else np.zeros(0, bool)


def tiles(document: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Non-overlapping matches (place in the document, in the item, length), longest first."""
    in_document, in_item = np.zeros(len(document), bool), np.zeros(len(item), bool)
    out, length = [], min(len(item), len(document))
    while length >= least > 0:
        h_document, h_item = _windows(document, length), _windows(item, length)
        places: dict[int, list[int]] = {}
        for t in np.flatnonzero(_free(in_item, length)).tolist():
            places.setdefault(int(h_item[t]), []).append(t)
        starts = np.flatnonzero(_free(in_document, length) & np.isin(h_document, np.array(list(places), np.uint64)))
        found = []
        for p in starts.tolist():
            for t in places[int(h_document[p])]:
                n = 0
                while (
                    p + n < len(document) and t + n < len(item) and document[p + n] == item[t + n]
                    and not in_document[p + n] and not in_item[t + n]
                ):
                    n += 1
                if n >= length:
                    found.append((-n, p, t))
        for n, p, t in sorted(found):
            n = -n
            if not in_document[p : p + n].any() and not in_item[t : t + n].any():
                in_document[p : p + n] = in_item[t : t + n] = True
                out.append((p, t, n))
        if found:
            continue  # matches that others have cut may still be as long as this
        if length == least:
            break
        length = max(least, length // 2)
    return out


class Items:
    """Test items by their words and word runs."""

    def __init__(self, items: list[tuple], least: int):
        self.vocabulary: dict[str, int] = {}
        self.items = []
        runs: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for key, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)], np.uint64)
            if not len(ids):
                continue
            size = min(least, len(ids))
            for at, h in enumerate(rolling(ids, size).tolist()):
                runs.setdefault(size, {}).setdefault(h, []).append((len(self.items), at))
            self.items.append((key, ids, size))
        self.runs = {k: (np.array(sorted(v), np.uint64), v) for k, v in runs.items()}

    def coverage(self, text: str | None, least_coverage: float) -> dict:
        """Item to coverage, of those with ``least_coverage`` or more."""
        get = self.vocabulary.get
        document = np.array([get(w, 0) for w in words(text)], np.uint64)
        seeded: dict[int, np.ndarray] = {}
        for size, (known, places) in self.runs.items():
            h = rolling(document, size)
            if not len(h):
                continue
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for value in np.unique(h[known[at] == h]).tolist():
                for number, start in places[value]:
                    covered = seeded.setdefault(number, np.zeros(len(self.items[number][1]), bool))
                    covered[start : start + size] = True
        out: dict = {}
        for number, covered in seeded.items():
            key, ids, size = self.items[number]
            if covered.mean() >= least_coverage:
                share = sum(n for _, _, n in tiles(document, ids, size)) / len(ids)
                if share >= least_coverage:
                    out[key] = max(share, out.get(key, 0.0))
        return out


def flag(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least_match: int = LEAST_MATCH,
    least_coverage: float = LEAST_COVERAGE,
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``items`` (of which it holds enough, ordered) and ``coverage``.

    An item counts when tiles of ``least_match`` words or more cover
    ``least_coverage`` of its words (of a shorter item: all its words in a row).
    ``items`` is an array of item ids as text, empty for a clean document,
    ``coverage`` the largest one found, else 0. Words are runs of letters, digits
    and underscores in lower case. Null and empty texts are clean, items without
    words are passed over, items that share an id count as one; repeated rows come
    back as often as they occur; names in ``docs`` may be any. The items go out in
    blocks of bounded size, each looked up in all documents; nothing is shuffled.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        F.struct("*").alias("row"), F.col(text_col).cast("string").alias("body"), F.array().cast("array<string>").alias("items"), F.lit(0.0).alias("coverage")
    )
    schema = T.StructType(rows.schema.fields)

    def looked_up(rows: DataFrame, block: list[tuple]) -> DataFrame:
        sent = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Items(sent.value, least_match)
            for batch in batches:
                found = [known.coverage(t, least_coverage) for t in batch.column(1).to_pylist()]
                items = [sorted({*old, *map(str, new)}) for old, new in zip(batch.column(2).to_pylist(), found)]
                best = [max(old, *new.values(), 0.0) for old, new in zip(batch.column(3).to_pylist(), found)]
                columns = [batch.column(0), batch.column(1), pa.array(items, pa.list_(pa.string())), pa.array(best, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "body", "items", "coverage"])

        return rows.mapInArrow(run, schema)

    block: list[tuple] = []
    size = 0
    for item in benchmark.select(F.col(item_col), F.col(item_text_col)).toLocalIterator():
        block.append((item[0], item[1]))
        size += len(words(item[1]))
        if size >= BLOCK_WORDS:
            rows, block, size = looked_up(rows, block), [], 0
    if block:
        rows = looked_up(rows, block)
    return rows.select("row", "items", "coverage")
