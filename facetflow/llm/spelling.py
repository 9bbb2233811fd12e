"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Words are counted by Spark. Two words one edit apart share their first or their
last half, counted in the shorter one's length, so every word goes to the
buckets of its halves. A task turns the words of some buckets into bitsets, one
per position and letter; a query reads its letters from left to right and keeps
four sets of words at once: those without an error so far, and those with one
letter replaced, one more or one less, which are matched at a shifted position.
All sets advance by word-parallel operations; no pair of words is ever listed.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetflow.session import write_out

#: What counts as a letter.
LETTERS = "A-Za-zÀ-ÿ"
#: Least length of a word, least number of occurrences.
LEAST_CHARS, LEAST_COPIES = 7, 2
#: One in so many occurrences loses a letter.
DAMAGE = 31
#: A form occurs at least so many times as often as the word.
RATIO = 10
#: Words and letters of one part of a bucket; only the spread of the work depends on them.
PART, PART_CHARS = 4096, 1 << 18
#: Index words that small buckets share.
_TOGETHER = 512


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = DAMAGE, least: int = LEAST_CHARS) -> DataFrame:
    """``word``: the runs of at least ``least`` letters, some of them damaged.

    A run whose checksum with the id is divisible by ``damage`` loses one code
    point; 0 damages none.
    """
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"[{LETTERS}]{{{least},}}+"), F.lit(0))
    each = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    run = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    if not damage:
        return each.select(run.alias("word"))
    each = each.select(run.alias("run"), F.crc32(F.concat("id", F.lit(":"), run).cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return each.select(F.when(F.col("h") % damage == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = LEAST_CHARS, copies: int = LEAST_COPIES) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    counted = words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= copies)


def _buckets(vocab: DataFrame, least: int) -> DataFrame:
    """Every word in the buckets of its halves, with the parts it meets there.

    A bucket ``(size, side, half)`` holds the words of ``size`` or one letter
    more whose first (side 0) or last (1) ``size // 2`` letters are ``half``. A
    part of a large bucket meets every other one; a row says whether the word
    stands in the index of the group, asks it, or both.
    """
    length = F.length("word")
    keys = []
    for less in (0, 1):
        size = (length - less).cast("int")
        half = F.floor(size / 2).cast("int")
        keys += [
            F.struct(size.alias("size"), F.lit(0).alias("side"), F.substring("word", F.lit(1), half).alias("half")),
            F.struct(size.alias("size"), F.lit(1).alias("side"), F.substring("word", length - half + 1, half).alias("half")),
        ]
    keyed = vocab.select("word", "n", F.inline(F.array(*keys))).where(F.col("size") >= least)
    bucket = ["size", "side", "half"]
    counted = keyed.groupBy(*bucket).agg(F.count("*").alias("words")).where("words > 1")
    chars = F.col("words") * F.col("size")
    parts = F.ceil(F.greatest(F.col("words") / PART, chars / PART_CHARS)).cast("int")
    met = keyed.join(counted.select(*bucket, parts.alias("parts")), bucket)
    met = met.withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    both = met.select("*", other.alias("other"))
    same = F.col("own") == F.col("other")
    ways = F.array(
        F.struct(F.col("other").alias("index"), F.col("own").alias("query"), same.alias("held"), F.lit(True).alias("asks")),
        F.struct(F.col("own").alias("index"), F.col("other").alias("query"), F.lit(True).alias("held"), same.alias("asks")),
    )
    ways = F.when(same, F.slice(ways, 1, 1)).otherwise(ways)
    return both.select(*bucket, "word", "n", F.inline(ways))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    short = -bits.shape[1] % 64
    return np.ascontiguousarray(np.packbits(np.pad(bits, ((0, 0), (0, short))), axis=1, bitorder="little")).view(np.uint64)


class PositionIndex:
    """Bitsets per (position, letter) over the words of one block, and what asks them.

    ``group`` numbers the bucket of every row; a query sees its own bucket only.
    Words of a bucket stand in the order (n falling, word), so the lowest bit
    of a result is its most frequent word.
    """

    def __init__(self, words: list[str], n: np.ndarray, group: np.ndarray):
        order = sorted(range(len(words)), key=lambda k: (group[k], -n[k], words[k]))
        self.words = [words[k] for k in order]
        self.n, self.group = n[order], group[order]
        self.lengths = np.array([len(w) for w in self.words])
        self.codes = _codes(self.words, int(self.lengths.max()) + 2)
        self.letters = np.unique(self.codes)

    def at(self, position: int) -> np.ndarray:
        """Row k: the words with letter k of ``letters`` at ``position``; the last row is empty."""
        column = self.codes[:, position] if 0 <= position < self.codes.shape[1] else np.zeros(len(self.words), np.int32)
        bits = column[None, :] == self.letters[:, None]
        bits[self.letters == 0] = False
        return _packed(np.concatenate([bits, np.zeros((1, len(self.words)), bool)]))

    def ask(self, words: list[str], group: np.ndarray, size: np.ndarray, side: np.ndarray):
        """Number of near words in the own bucket, and the place of the first, per query.

        In buckets of last halves a word that shares the first half, too, is left
        to that bucket, and pairs of the longer words to the next size.
        """
        lengths = np.array([len(w) for w in words])
        order = np.argsort(lengths, kind="stable")
        lengths, group, size, side = lengths[order], group[order], size[order], side[order]
        codes = _codes([words[k] for k in order], int(lengths.max()))
        letter = np.searchsorted(self.letters, codes).clip(max=len(self.letters) - 1)
        letter = np.where(self.letters[letter] == codes, letter, len(self.letters))
        exact = _packed(group[:, None] == self.group[None, :])
        none = np.zeros_like(exact)
        replaced, more, less, shared = none, none.copy(), none.copy(), none.copy()
        near = np.zeros_like(exact)
        of_length = {m: _packed((self.lengths == m)[None, :]) for m in range(int(lengths[0]) - 1, int(lengths[-1]) + 2)}
        before, here, after = self.at(-1), self.at(0), self.at(1)
        start = 0
        for i in range(int(lengths[-1]) + 1):
            half = (size[start:] // 2 == i) & (side[start:] == 1)
            if half.any():
                shared[start:][half] = exact[half]
            done = int(np.searchsorted(lengths[start:], i, side="right"))
            if done:
                ends = slice(start, start + done)
                short = (lengths[ends] == size[ends])[:, None]
                found = np.where(short, replaced[:done] & of_length[i], 0) | (more[:done] | exact[:done]) & of_length[i + 1] | less[:done] & of_length[i - 1]
                near[ends] = found & ~shared[ends]
                start += done
                exact, replaced, more, less = exact[done:], replaced[done:], more[done:], less[done:]
            if start == len(lengths):
                break
            asked = letter[start:, i]
            match = here[asked]
            replaced = replaced & match | exact & ~match
            more = (more | exact) & after[asked]
            less = less & before[asked] | exact
            exact = exact & match
            before, here, after = here, after, self.at(i + 2)
        counts, firsts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        block = (near != 0).argmax(axis=1)
        low = near[np.arange(len(words)), block]
        counts[order] = np.bitwise_count(near).sum(axis=1)
        firsts[order] = block * 64 + np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1))
        return counts, firsts


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points, 0 after the end."""
    return np.array(words, dtype=f"<U{width}").view(np.int32).reshape(len(words), width)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n_near, best_n, best`` for the sorted rows of ``_buckets``."""

    def answer(rows: list[tuple], group: list[int]) -> pa.RecordBatch:
        group = np.array(group)
        held = [k for k, r in enumerate(rows) if r[7]]
        asks = [k for k, r in enumerate(rows) if r[8]]
        index = PositionIndex([rows[k][5] for k in held], np.array([rows[k][6] for k in held]), group[held])
        size, side = (np.array([rows[k][c] for k in asks]) for c in (0, 1))
        words = [rows[k][5] for k in asks]
        counts, firsts = index.ask(words, group[asks], size, side)
        hits = np.flatnonzero(counts).tolist()
        best = [int(firsts[k]) for k in hits]
        columns = [[words[k] for k in hits], counts[hits], [int(index.n[b]) for b in best], [index.words[b] for b in best]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "best_n", "best"])

    rows: list[tuple] = []
    numbers: list[int] = []
    held = chars = 0
    each = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for number, (key, members) in enumerate(itertools.groupby(each, key=lambda r: r[:5])):
        if rows and (held >= _TOGETHER or chars >= PART_CHARS or key[0] > rows[0][0] + 8):
            yield answer(rows, numbers)
            rows, numbers, held, chars = [], [], 0, 0
        for r in members:
            rows.append(r)
            numbers.append(number)
            held += r[7]
            chars += key[0]
    if rows:
        yield answer(rows, numbers)


def near_counts(vocab: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``word, n_near, best`` (n, word of the most frequent near word) of words that have one.

    ``vocab`` has distinct ``word`` of at least ``least`` code points and ``n``.
    """
    group = ["size", "side", "half", "index", "query"]
    rows = _buckets(vocab, least).select(*group, "word", "n", "held", "asks")
    rows = rows.repartition(*group).sortWithinPartitions(*group)
    found = rows.mapInArrow(_near, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("best"))
    return merged.select("word", "n_near", F.struct((-F.col("best.minus")).alias("n"), F.col("best.word").alias("word")).alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """``word, root`` of words with a form; every round doubles the steps followed.

    A form occurs more often than its word, so the links end. A round that
    changes nothing is the last.
    """
    at = write_out(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not at.where("moved").isEmpty():
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = at.select("word", "root").join(onward, "root", "left")
        at = write_out(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
    return at.select("word", "root")


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_CHARS,
    copies: int = LEAST_COPIES,
    ratio: int = RATIO,
    damage: int = DAMAGE,
) -> DataFrame:
    """Every word with its form and the end of its chain of forms.

    Columns ``word, form, root, n, n_near, form_n``. A word is near another if
    one inserted, deleted or replaced code point makes them equal. The form is
    the near word with the largest n (ties: the smallest word in code-point
    order) if that n is at least ``ratio`` times the word's, else null; ``root``
    is the last form of the chain, the word itself without one.

    Null and empty texts have no words; a null id counts as empty text in the
    checksum; repeated rows count as often as they occur; texts and words of any
    length are read whole; empty input gives no rows; other columns are not read.
    """
    vocab = write_out(vocabulary(occurrences(docs, id_col, text_col, damage, least), least, copies), "vocabulary")
    joined = vocab.join(near_counts(vocab, least), "word", "left")
    frequent = F.col("best.n") >= ratio * F.col("n")
    formed = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best.word")).alias("form"),
        F.when(frequent, F.col("best.n")).alias("form_n"),
    )
    formed = write_out(formed, "forms")
    roots = _roots(formed.where("form is not null"))
    out = formed.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

