"""Conversation repair: the cheapest edits that make roles alternate, by grammar-compressed dynamic programming.

Every row of a conversation becomes a symbol, its role and fault. Sequences of
symbols are counted once for all conversations that share them, and Re-Pair turns
the sequences of a task into a grammar: the most frequent pair becomes a rule,
again and again. A symbol is a min-plus matrix over the states of the role
pattern ``(s?(ua)+)?``; the matrix of a rule is the product of those of its two
halves, worked out once, bottom-up. Its entries carry the audit, the initials of
the edits, as a rope of the audits of the halves. Long conversations are cut into
pieces, each a product of its own, and the products are folded in order.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetflow.operators.joins import lookup_join
from facetflow.session import write_out

#: White space of a blank text, and the marks that end a whole one.
_SPACE, _MARKS = r"\x20\x09-\x0D", ".!?"
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Roles of the pattern by initial.
ROLES = {"u": "user", "a": "assistant"}
#: Symbols: a row to delete, and the roles whole (small) and truncated (capital); ``o`` is any other role.
SYMBOLS = "xsuaoSUAO"
#: Start, after ``s``, after ``u``, after ``a``; the pattern may end in the first and last.
STATES, ENDS = range(4), (0, 3)
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Rows of one piece of a conversation, and symbols of one grammar; only the spread of the work depends on them.
PIECE, BLOCK = 4096, 1 << 16


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, turn, role, text, copies`` of rows of which some are dropped, emptied, cut, repeated or given to the user.

    A null role or text, and in the checksum a null id or turn, is one space. A
    dropped row has 0 copies, so its conversation is still known.
    """

    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(said(conv_col), F.lit(":"), said(turn_col)).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(said(text_col), _MARKS, "")).otherwise(said(text_col))
    return rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(said(role_col)).alias("role"),
        text.alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, copies`` counted, with ``blank``, ``first``, ``truncated`` and the symbol of the first copy.

    ``first``: no earlier row of the conversation has this role and text. The
    earliest turn of a text is aggregated and joined, so that a text repeated
    through a long conversation is not gathered.
    """
    counted = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    digest = {"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), "text")}
    counted = write_out(counted.withColumns(digest), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    same = ["conv", "role", "d1", "d2"]
    earliest = counted.where("copies > 0").groupBy(*same).agg(F.min(place).alias("earliest"))
    joined = lookup_join(counted, earliest, same, "left")
    first = F.coalesce(F.col("earliest.turn").eqNullSafe(F.col("turn")) & F.col("earliest").isNotNull(), F.lit(False))
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    kept = ~F.col("blank") & F.col("first")
    flagged = joined.withColumns(
        {
            "blank": ~F.col("text").rlike(f"[^{_SPACE}]"),
            "first": first,
            "truncated": ~F.col("text").rlike(rf"[{_MARKS}][{_SPACE}]*\z"),
            "initial": role,
        }
    )
    symbol = F.when(~kept, "x").when(F.col("truncated"), F.upper("initial")).otherwise(F.col("initial"))
    return flagged.withColumn("symbol", symbol).drop("d1", "d2", "earliest")


def counts(flagged: DataFrame) -> DataFrame:
    """Per conversation ``gaps, blank, duplicate, truncated``; each row's first fault counts."""
    n, there = F.col("copies"), F.col("copies") > 0
    turn = F.when(there, F.col("turn"))
    again = F.when(F.col("first"), n - 1).otherwise(n)
    total = {
        "blank": F.when(F.col("blank"), n),
        "duplicate": F.when(~F.col("blank") & there, again),
        "truncated": F.when(~F.col("blank") & there & F.col("first") & F.col("truncated"), 1),
    }
    return flagged.groupBy("conv").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"),
        *[F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(name) for name, x in total.items()],
    )


def pieces(flagged: DataFrame) -> DataFrame:
    """``conv, part, number, symbols, roles``: the conversations in order, cut after ``PIECE`` rows.

    Rows are dealt out by ranges, so a long conversation lies in several
    partitions; ``part`` and ``number`` order its pieces. ``roles`` are the
    initials of the first and last row and the number of illegal neighbours.
    """
    rows = flagged.where("copies > 0").withColumn("start", F.substring("text", 1, 16))
    rows = rows.repartitionByRange("conv", "turn", "role", "start").sortWithinPartitions("conv", "turn", "role", "text")
    kind = T.StructField("conv", flagged.schema["conv"].dataType)
    others = [("part", T.LongType()), ("number", T.LongType()), ("symbols", T.StringType()), ("ends", T.StringType()), ("illegal", T.LongType())]
    schema = T.StructType([kind, *[T.StructField(*x) for x in others]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        of, key = None, None
        symbols: list[str] = []
        initials: list[str] = []
        done: list[tuple] = []

        def close() -> None:
            nonlocal number
            if symbols:
                wrong = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
                done.append((key, part, number, "".join(symbols), initials[0] + initials[-1], wrong))
                number += 1
                symbols.clear()
                initials.clear()

        def out() -> pa.RecordBatch:
            types = [of, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=schema.names)

        for batch in batches:
            of = batch.schema.field(0).type
            for conv, symbol, initial, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != key:
                    close()
                    key = conv
                while copies:
                    now = min(copies, PIECE - len(symbols))
                    symbols += [symbol] + ["x"] * (now - 1)
                    initials += [initial] * now
                    copies, symbol = copies - now, "x"
                    if len(symbols) == PIECE:
                        close()
                        if len(done) >= 64:
                            yield out()
                            done.clear()
            if done:
                yield out()
                done.clear()
        close()
        if done:
            yield out()

    return rows.select("conv", "symbol", "initial", "copies").mapInArrow(run, schema)


def re_pair(sequences: list[list[int]], terminals: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules and the sequences written with them; rule k is symbol ``terminals + k``.

    The most frequent pair (ties: the smallest) is replaced until no pair occurs
    twice in one place or another.
    """
    symbol = [s for q in sequences for s in [*q, -1]]
    size = len(symbol)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)

    def pair(i: int) -> tuple[int, int] | None:
        if i < 0 or symbol[i] < 0 or after[i] >= size or symbol[after[i]] < 0:
            return None
        return symbol[i], symbol[after[i]]

    for i in range(size):
        if (p := pair(i)) is not None:
            places[p].add(i)
    heap = [(-len(at), p) for p, at in places.items() if len(at) > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, p = heapq.heappop(heap)
        at = places.get(p, ())
        if len(at) != -count:
            if len(at) > 1:
                heapq.heappush(heap, (-len(at), p))
            continue
        new, touched = terminals + len(rules), set()
        rules.append(p)
        for i in sorted(at):
            if pair(i) != p:
                continue  # overlapped by the one before
            j = after[i]
            for k in (before[i], j):
                if (old := pair(k)) is not None and old != p:
                    places[old].discard(k)
            symbol[i], symbol[j] = new, -2
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            for k in (before[i], i):
                if (now := pair(k)) is not None:
                    places[now].add(k)
                    touched.add(now)
        places.pop(p, None)
        for q in touched:
            if len(places.get(q, ())) > 1:
                heapq.heappush(heap, (-len(places[q]), q))
    out: list[list[int]] = [[]]
    for s in symbol:
        if s >= 0:
            out[-1].append(s)
        elif s == -1:
            out.append([])
    return rules, out[: len(sequences)]


#: A rope is a text or a pair of ropes; an entry a cost and a rope; a matrix 4 x 4 entries or None.
Rope = str | tuple
Matrix = list[list[tuple[int, Rope] | None]]


def _leaves(rope: Rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            if top:
                yield top
        else:
            stack += (top[1], top[0])


def _text(rope: Rope) -> str:
    return "".join(_leaves(rope))


def _less(a: Rope, b: Rope) -> bool:
    """Whether the text of ``a`` comes first; read only up to the first difference."""
    if a is b:
        return False
    x, y = (itertools.chain.from_iterable(_leaves(r)) for r in (a, b))
    for s, t in itertools.zip_longest(x, y, fillvalue=""):
        if s != t:
            return s < t
    return False


def _better(a: tuple[int, Rope] | None, b: tuple[int, Rope]) -> bool:
    """Whether ``b`` is cheaper than ``a``, or as cheap and first by text.

    Texts of equal cost between the same states are never prefixes of each other:
    they have the same rows, and what is longer has more inserts. So the least of
    a product is the product of the least.
    """
    return a is None or b[0] < a[0] or b[0] == a[0] and _less(b[1], a[1])


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [[None] * 4 for _ in STATES]
    for p in STATES:
        for r in STATES:
            if (x := a[p][r]) is None:
                continue
            for q in STATES:
                if (y := b[r][q]) is not None:
                    both = x[0] + y[0], (x[1], y[1])
                    if _better(out[p][q], both):
                        out[p][q] = both
    return out


def _inserts() -> Matrix:
    """Any number of inserted rows."""
    out: Matrix = [[None] * 4 for _ in STATES]
    for p in STATES:
        out[p][p] = 0, ""
        q, steps = p, 0
        for _ in range(2):
            q, steps = next(_STEP[q, r] for r in ROLES if (q, r) in _STEP), steps + 1
            if out[p][q] is None:
                out[p][q] = steps * INSERT, "I" * steps
    return out


def _row(symbol: str) -> Matrix:
    """Inserted rows, then the edit of one row."""
    out: Matrix = [[None] * 4 for _ in STATES]
    role, stays = symbol.lower(), TRUNCATED * symbol.isupper()
    for p in STATES:
        edits = [(p, (DELETE, "D"))]
        if role != "x":
            edits += [(_STEP[p, r], (REROLE + stays, "R")) for r in ROLES if (p, r) in _STEP]
            if (p, role) in _STEP:
                edits.append((_STEP[p, role], (stays, "K")))
        for q, edit in edits:
            if _better(out[p][q], edit):
                out[p][q] = edit
    return product(INSERTS, out)


INSERTS = _inserts()
TERMINALS = [_row(s) for s in SYMBOLS]


def transfer(sequences: list[str]) -> list[Matrix]:
    """The matrix of every sequence of symbols, by one grammar for all."""
    number = {s: k for k, s in enumerate(SYMBOLS)}
    rules, written = re_pair([[number[s] for s in q] for q in sequences], len(SYMBOLS))
    matrices = list(TERMINALS)
    for a, b in rules:
        matrices.append(product(matrices[a], matrices[b]))
    out = []
    for q in written:
        whole = matrices[q[0]]
        for s in q[1:]:
            whole = product(whole, matrices[s])
        out.append(whole)
    return out


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``symbols, costs, audits``, both row by row, for distinct sequences."""

    def out(block: list[str]) -> pa.RecordBatch:
        cells = [[e for row in m for e in row] for m in transfer(block)]
        costs = pa.array([[e and e[0] for e in c] for c in cells], pa.list_(pa.int64()))
        audits = pa.array([[e and _text(e[1]) for e in c] for c in cells], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(block, pa.string()), costs, audits], names=["symbols", "costs", "audits"])

    block, held = [], 0
    for symbols in (s for b in batches for s in b.column(0).to_pylist()):
        block.append(symbols)
        held += len(symbols)
        if held >= BLOCK:
            yield out(block)
            block, held = [], 0
    if block:
        yield out(block)


class _Fold:
    """The cheapest way to every state after the pieces so far.

    A way is a chain of audits, newest first; two ways of equal cost are
    compared from where their chains part.
    """

    def __init__(self):
        self.ways: list[tuple[int, tuple | None] | None] = [(0, None), None, None, None]
        self.illegal, self.last = 0, ""

    @staticmethod
    def _less(a: tuple, b: tuple) -> bool:
        x, y = [], []
        while a is not b:
            x.append(a[1])
            y.append(b[1])
            a, b = a[0], b[0]
        return "".join(reversed(x)) < "".join(reversed(y))

    def add(self, costs: list, audits: list, ends: str = "", illegal: int = 0) -> None:
        new: list = [None] * 4
        for p, way in enumerate(self.ways):
            for q in STATES:
                if way is None or costs[4 * p + q] is None:
                    continue
                one = way[0] + costs[4 * p + q], (way[1], audits[4 * p + q])
                if new[q] is None or one[0] < new[q][0] or one[0] == new[q][0] and self._less(one[1], new[q][1]):
                    new[q] = one
        self.ways = new
        self.illegal += illegal + (bool(self.last) and bool(ends) and self.last + ends[0] not in ("su", "ua", "au"))
        self.last = ends[-1:] or self.last

    def end(self) -> tuple[int, str, int]:
        """Cost, audit and illegal neighbours of the whole conversation."""
        flat = [e for row in INSERTS for e in row]
        self.add([e and e[0] for e in flat], [e and e[1] for e in flat])
        way = None
        for q in ENDS:
            one = self.ways[q]
            if one is not None and (way is None or one[0] < way[0] or one[0] == way[0] and self._less(one[1], way[1])):
                way = one
        cost, chain = way
        audit = []
        while chain is not None:
            audit.append(chain[1])
            chain = chain[0]
        return cost, "".join(reversed(audit)), self.illegal


def audits(cut: DataFrame) -> DataFrame:
    """``conv, cost, audit, illegal`` of the conversations whose ``pieces`` are given."""
    known = cut.select("symbols").distinct().mapInArrow(_transfers, "symbols string, costs array<bigint>, audits array<string>")
    joined = cut.join(known, "symbols").select("conv", "part", "number", "ends", "illegal", "costs", "audits")
    ordered = joined.repartition("conv").sortWithinPartitions("conv", "part", "number")
    longs = T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("illegal", T.LongType())
    schema = T.StructType([T.StructField("conv", cut.schema["conv"].dataType), *longs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fold = None, None
        for batch in batches:
            done = []
            for conv, _, _, ends, illegal, costs, audit in zip(*(c.to_pylist() for c in batch.columns)):
                if fold is None or conv != key:
                    if fold is not None:
                        done.append((key, *fold.end()))
                    key, fold = conv, _Fold()
                fold.add(costs, audit, ends, illegal)
            of = batch.schema.field(0).type
            yield _batch(done, of)
        if fold is not None:
            yield _batch([(key, *fold.end())], of)

    def _batch(rows: list[tuple], of: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (of, pa.int64(), pa.string(), pa.int64()))], names=schema.names)

    return ordered.mapInArrow(run, schema)


def _in_order(flagged: DataFrame, found: DataFrame) -> DataFrame:
    """Every conversation's audit, then its rows in order, in one partition."""
    rows = flagged.where("copies > 0").select("conv", F.lit(1).alias("what"), "turn", "role", "text", "copies")
    none = F.lit(None).cast("long")
    heads = found.select("conv", F.lit(0).alias("what"), none.alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), none.alias("copies"))
    both = heads.unionByName(rows)
    return both.repartition("conv").sortWithinPartitions("conv", "what", "turn", "role", "text").select("conv", "what", "role", "text", "copies")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv, edit, role, text)`` in order; a conversation starts with ``(conv, None, None, None)``."""
    audit, at, turn = "", 0, "u"

    def inserted(conv) -> Iterator[tuple]:
        nonlocal at, turn
        while at < len(audit) and audit[at] == "I":
            yield conv, "I", ROLES[turn], ""
            at, turn = at + 1, "a" if turn == "u" else "u"

    conv = None
    for batch in batches:
        for key, what, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if what == 0:
                yield from inserted(conv)
                conv, audit, at, turn = key, text, 0, "u"
                yield conv, None, None, None
                continue
            for _ in range(copies):
                yield from inserted(conv)
                edit, at = audit[at], at + 1
                if edit == "D":
                    yield conv, "D", role, text
                    continue
                yield conv, edit, ROLES[turn] if edit == "R" else role, text
                if role[:1] != "s" or edit == "R":
                    turn = "a" if turn == "u" else "u"
    yield from inserted(conv)


def repaired_turns(flagged: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, place, edit, role, text``: the repaired conversations, deleted rows left out."""
    kind = T.StructField("conv", flagged.schema["conv"].dataType)
    others = [("place", T.LongType()), ("edit", T.StringType()), ("role", T.StringType()), ("text", T.StringType())]
    schema = T.StructType([kind, *[T.StructField(*x) for x in others]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
        place, rows = 0, _edited(itertools.chain([first], batches))
        while block := list(itertools.islice(rows, 1000)):
            done = []
            for conv, edit, role, text in block:
                place = 0 if edit is None else place
                if edit not in (None, "D"):
                    done.append((conv, place, edit, role, text))
                    place += 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=schema.names)

    return _in_order(flagged, found).mapInArrow(run, schema)


def digests(flagged: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, repaired_sha256``: SHA-256 of the repaired ``role:text``, joined by newlines, read in a stream."""
    schema = T.StructType([T.StructField("conv", flagged.schema["conv"].dataType), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field(0).type, pa.string()]
        done, digest, empty, key = [], None, True, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=schema.names)

        for conv, edit, role, text in _edited(itertools.chain([first], batches)):
            if edit is None:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                    if len(done) == 1000:
                        yield out()
                        done = []
                key, digest, empty = conv, hashlib.sha256(), True
            elif edit != "D":
                digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
        done.append((key, digest.hexdigest()))
        yield out()

    return _in_order(flagged, found).mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """What is wrong with every conversation and how it is mended most cheaply.

    ``rows`` has ``conv, turn, role, text, copies`` (not null but for ``conv``
    and ``turn``), as from ``damage``; rows count as often as ``copies`` says and
    stand in the order (turn, nulls first; role; text). Columns: ``conv, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. A
    conversation without rows left has zeros, an empty audit and the hash of an
    empty text; a null id is a conversation of its own; long texts and
    conversations are read whole; equal rows are duplicates of the first; empty
    input gives no rows.
    """
    flagged = write_out(faults(rows), "faults")
    found = write_out(audits(write_out(pieces(flagged), "pieces")), "audits")
    table = lookup_join(counts(flagged), found, ["conv"], "left")
    table = lookup_join(table, digests(flagged, found), ["conv"], "left")
    return table.select(
        "conv",
        "gaps",
        "blank",
        "duplicate",
        "truncated",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
