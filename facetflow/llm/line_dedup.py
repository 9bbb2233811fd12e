"""Line deduplication by a segment-partition edit join.

A line of which an earlier line is equal or within ``edits`` edits is removed.
Distinct lines are cut into ``edits + 1`` segments; a line within the distance
must hold one of them, so substrings of the right lengths near the right places
are looked up in an index of segments. Pairs that meet and whose letter counts
allow it are verified by a bit-parallel edit distance over the band of 2 edits + 1
diagonals. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDITS = 1
LEAST_CHARS = 40
#: Letters that are counted before a pair is verified; any eight give the same result.
LETTERS = "etaonrsi"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``at`` (id, text hash, line number), ``line``; a document is a pair of id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), F.posexplode(F.split(text, "\n")).alias("n", "line"))
    return rows.select(F.struct("id", "t", "n").alias("at"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "line")


def _letters(line: Column) -> Column:
    """How often each of eight letters occurs, modulo 256, in the bytes of a long."""
    counts = [F.pmod(F.char_length(line) - F.char_length(F.replace(line, F.lit(c), F.lit(""))), F.lit(256)).cast("long") for c in LETTERS]
    return sum((F.shiftleft(c, 8 * k) for k, c in enumerate(counts[1:], 1)), counts[0])


def _letters_apart(a: str, b: str) -> Column:
    """By how many letters two counts differ; an edit makes two at most."""

    def one(k: int) -> Column:
        d = F.abs(F.shiftright(a, 8 * k).bitwiseAND(F.lit(255)) - F.shiftright(b, 8 * k).bitwiseAND(F.lit(255)))
        return F.least(d, 256 - d)

    return sum((one(k) for k in range(1, len(LETTERS))), one(0))


def _segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """Start (from 1) and length of each of the ``edits + 1`` segments of a line."""
    parts, out = edits + 1, []
    small = F.floor(length / parts).cast("int")
    longer = (length - small * parts).cast("int")
    for i in range(parts):
        before = F.greatest(F.lit(0), F.lit(i) - (parts - longer))
        out.append(((small * i + before + 1).cast("int"), (small + F.when(F.lit(i) >= parts - longer, 1).otherwise(0)).cast("int")))
    return out


def _key(length: Column, i: int, piece: Column) -> Column:
    return F.xxhash64(length.cast("int"), F.lit(i), piece)


def _index(edits: int) -> Column:
    """Keys of a line's own segments."""
    n = F.col("size")
    return F.array(*(_key(n, i, F.substring("line", p, l)) for i, (p, l) in enumerate(_segments(n, edits))))


def _probes(edits: int) -> Column:
    """Keys of the substrings that may equal a segment of a line as long or up to ``edits`` shorter."""
    out = []
    for less in range(edits + 1):
        n = F.col("size") - less
        for i, (p, l) in enumerate(_segments(n, edits)):
            low, high = max(-i, less - (edits - i)), min(i, less + (edits - i))
            out += [_key(n, i, F.when(p + s >= 1, F.substring("line", p + s, l))) for s in range(low, high + 1)]
    return F.array(*out)


def _band(a: Column, b: str, edits: int) -> Column:
    """The edit distance of two arrays of characters if it is ``edits`` at most, else null.

    Bit d of the e-th word tells whether the prefix of ``b`` that ends d - edits
    places off the read prefix of ``a`` is within e edits of it.
    """
    band = range(2 * edits + 1)

    def mask(c: Column, i: Column) -> Column:
        bits = [F.when(F.get(b, i + d - edits) == c, F.lit(1 << d)).otherwise(F.lit(0)) for d in band]
        return sum(bits[1:], bits[0]).cast("long")

    start = F.struct(*(F.lit(((1 << (e + 1)) - 1) << edits).cast("long").alias(f"r{e}") for e in range(edits + 1)))
    all_bits = F.lit((1 << len(band)) - 1).cast("long")

    def step(s: Column, m: Column) -> Column:
        new = [s["r0"].bitwiseAND(m)]
        for e in range(1, edits + 1):
            old, less = s[f"r{e}"], s[f"r{e - 1}"]
            r = old.bitwiseAND(m).bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(new[-1], 1))
            new.append(r.bitwiseAND(all_bits))
        return F.struct(*(r.alias(f"r{e}") for e, r in enumerate(new)))

    place = (F.size(b) - F.size(a) + edits).cast("int")

    def finish(s: Column) -> Column:
        return F.coalesce(*(F.when(F.call_function("shiftright", s[f"r{e}"], place).bitwiseAND(F.lit(1)) == 1, F.lit(e)) for e in range(edits + 1)))

    return F.when(place.between(0, 2 * edits), F.aggregate(F.transform(a, mask), start, step, finish))


def with_distance(pairs: DataFrame, a: str, b: str, edits: int) -> DataFrame:
    """Pairs whose columns ``a`` and ``b`` are within ``edits``, with their ``distance``.

    The characters are columns of their own and the distance comes out of a
    generator, so neither is computed more than once for a pair.
    """

    def characters(c: str) -> Column:
        return F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(F.col(c), ""))

    split = pairs.select("*", characters(a).alias("_a"), characters(b).alias("_b"))
    distance = F.array_compact(F.array(_band(F.col("_a"), "_b", edits)))
    return split.select(*pairs.columns, F.explode(distance).alias("distance"))


def _distinct(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    lines = _lines(docs, id_col, text_col).where(F.char_length("line") >= least_chars)
    return lines.withColumn("letters", _letters(F.col("line"))).groupBy("h1", "h2").agg(
        F.min("at").alias("first"), F.count("*").alias("n"), F.max("line").alias("line"), F.max("letters").alias("letters")
    )


def line_links(lines: DataFrame, edits: int) -> DataFrame:
    """Pairs of different lines (``a1, a2`` and ``b1, b2``, their hashes) within ``edits``, with ``distance``.

    ``lines`` has ``h1, h2, line, letters``, each line once.
    """
    sized = lines.select("h1", "h2", "line", "letters", F.char_length("line").alias("size"))
    index = sized.select(F.explode(_index(edits)).alias("key"), F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("letters").alias("la"))
    probe = sized.select(F.explode(_probes(edits)).alias("key"), F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("letters").alias("lb"))
    differ = (F.col("a1") != F.col("b1")) | (F.col("a2") != F.col("b2"))
    alike = _letters_apart("la", "lb") <= 2 * edits
    met = index.join(probe, (index["key"] == probe["key"]) & differ & alike)
    one, two = F.struct(F.col("a1").alias("h1"), F.col("a2").alias("h2")), F.struct(F.col("b1").alias("h1"), F.col("b2").alias("h2"))
    pairs = met.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
    sides = pairs.select(F.explode(F.array(F.struct("a", "b", F.lit(True).alias("first_side"), F.col("a").alias("h")), F.struct("a", "b", F.lit(False).alias("first_side"), F.col("b").alias("h")))).alias("s")).select("s.a", "s.b", "s.first_side", F.col("s.h.h1").alias("h1"), F.col("s.h.h2").alias("h2"))
    # Read with the letters, as above, so that Spark shuffles the lines once for all three uses.
    texts = sides.join(lines.where("letters is not null").select("h1", "h2", "line"), ["h1", "h2"]).groupBy("a", "b").agg(
        F.max(F.when(F.col("first_side"), F.col("line"))).alias("x"), F.max(F.when(~F.col("first_side"), F.col("line"))).alias("y")
    )
    checked = with_distance(texts, "x", "y", edits)
    return checked.select(F.col("a.h1").alias("a1"), F.col("a.h2").alias("a2"), F.col("b.h1").alias("b1"), F.col("b.h2").alias("b2"), "distance")


def placed_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least_chars: int = LEAST_CHARS, fold_chars: int | None = None
) -> DataFrame:
    """Places of repeated and linked lines: ``id, t, n`` (document and line number from 0), ``links``, ``keeper`` and ``removed``.

    ``keeper`` (id, t, n) is the earliest equal or linked line, in the order of
    id, text hash and line number; a later place is ``removed``. ``links`` counts
    the different lines within the distance. Lines shorter than ``least_chars``
    are not linked; those that have ``fold_chars`` (by default as many) or more
    still go when an earlier line equals them.
    """
    fold_chars = least_chars if fold_chars is None else min(fold_chars, least_chars)
    lines = _distinct(docs, id_col, text_col, fold_chars)
    links = line_links(lines.where(F.char_length("line") >= least_chars) if fold_chars < least_chars else lines, edits)
    both = links.select("a1", "a2", "b1", "b2").union(links.select("b1", "b2", "a1", "a2"))
    firsts = lines.select("h1", "h2", "first", "n")
    near = both.join(firsts.where("n > 0").select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("first").alias("other")), ["b1", "b2"])
    near = near.groupBy(F.col("a1").alias("h1"), F.col("a2").alias("h2")).agg(F.min("other").alias("other"), F.count("*").alias("links"))
    kept = firsts.join(near, ["h1", "h2"], "left").where("n > 1 or links is not null")
    kept = kept.select("h1", "h2", F.least("first", F.coalesce("other", "first")).alias("keeper"), F.coalesce("links", F.lit(0)).alias("links"))
    places = _lines(docs, id_col, text_col).where(F.char_length("line") >= fold_chars).select("at", "h1", "h2")
    out = places.join(kept, ["h1", "h2"]).withColumn("removed", F.col("keeper") < F.col("at"))
    return out.select("at.id", "at.t", "at.n", "links", "keeper", "removed")


def by_document(placed: DataFrame) -> DataFrame:
    """Removed line numbers of each document, as an array without repeats, and the most links of a line of it."""
    gone = F.collect_set(F.when(F.col("removed"), F.col("n")))
    return placed.groupBy("id", "t").agg(F.sort_array(gone).alias("gone"), F.max("links").alias("links"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least_chars: int = LEAST_CHARS, fold_chars: int | None = None
) -> DataFrame:
    """``docs`` with removed lines taken out of the text (all columns kept, every row kept).

    A document is a pair of id and text, so rows that repeat both are treated
    alike; order is by id (null first), text hash and line number. A null text
    stays null, an empty one empty; a text may become empty. Lines end at a line
    feed. Other columns may have any names. Empty input gives no rows.
    """
    gone = by_document(placed_lines(docs, id_col, text_col, edits, least_chars, fold_chars).where("removed"))
    gone = gone.select(F.struct("id", "t").alias("_key"), "gone")
    rows = docs.select(F.struct("*").alias("row"), F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("t")).alias("_own"))
    joined = rows.join(gone, F.col("_own").eqNullSafe(F.col("_key")), "left")
    text = F.col("row").getField(text_col)
    lines = F.split(text, "\n")
    numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    left = F.array_join(F.transform(numbers, lambda i: F.get(lines, i)), "\n")
    return joined.select(*(F.when(F.col("gone").isNull(), text).otherwise(left).alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))


def report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least_chars: int = LEAST_CHARS, fold_chars: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: lines, lines removed, their numbers, and the most links that one of its lines has, kept or not."""
    gone = by_document(placed_lines(docs, id_col, text_col, edits, least_chars, fold_chars))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_t"), F.size(F.split(text, "\n")).cast("long").alias("n_lines"))
    joined = rows.join(gone, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_t") == F.col("t")), "left")
    return joined.select(
        F.col("_id").alias(id_col),
        "n_lines",
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("removed_lines"),
        F.coalesce("links", F.lit(0)).cast("long").alias("most_links"),
    )
