import hashlib
import itertools
import random
import re
import zlib

import pytest

from facetflow.llm import queries, repair

SPACE = " \t\n\x0b\x0c\r"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def scripts(symbols):
    """Every edit script with at most two inserts in a row: cost, audit."""

    def go(k, state, inserts, cost, audit):
        if inserts < 2:
            for r in "ua":
                if (state, r) in STEP:
                    yield from go(k, STEP[state, r], inserts + 1, cost + 3, audit + "I")
        if k == len(symbols):
            if state in (0, 3):
                yield cost, audit
            return
        s = symbols[k]
        yield from go(k + 1, state, 0, cost + 4, audit + "D")
        if s != "x":
            cut = 3 * s.isupper()
            for r in "ua":
                if (state, r) in STEP:
                    yield from go(k + 1, STEP[state, r], 0, cost + cut + 3, audit + "R")
            if (state, s.lower()) in STEP:
                yield from go(k + 1, STEP[state, s.lower()], 0, cost + cut, audit + "K")

    return go(0, 0, 0, 0, "")


def cheapest(symbols):
    """The same by a plain table over rows and states."""
    best = {0: (0, "")}

    def inserts(best):
        out = dict(best)
        for _ in range(2):
            for state, (cost, audit) in list(out.items()):
                for r in "ua":
                    if (state, r) in STEP:
                        to, way = STEP[state, r], (cost + 3, audit + "I")
                        out[to] = min(out.get(to, way), way)
        return out

    for s in symbols:
        new = {}
        for state, (cost, audit) in inserts(best).items():
            ways = [(state, cost + 4, "D")]
            if s != "x":
                cut = 3 * s.isupper()
                ways += [(STEP[state, r], cost + cut + 3, "R") for r in "ua" if (state, r) in STEP]
                if (state, s.lower()) in STEP:
                    ways.append((STEP[state, s.lower()], cost + cut, "K"))
            for to, c, e in ways:
                new[to] = min(new.get(to, (c, audit + e)), (c, audit + e))
        best = new
    return min(way for state, way in inserts(best).items() if state in (0, 3))


def whole(matrix):
    fold = repair._Fold()
    cells = [e for row in matrix for e in row]
    fold.add([e and e[0] for e in cells], [e and repair._text(e[1]) for e in cells])
    return fold.end()[:2]


def test_every_short_sequence_against_all_scripts():
    sequences = ["".join(s) for n in (1, 2) for s in itertools.product(repair.SYMBOLS, repeat=n)]
    r = random.Random(1)
    sequences += ["".join(r.choice(repair.SYMBOLS) for _ in range(4)) for _ in range(40)]
    for s, matrix in zip(sequences, repair.transfer(sequences)):
        assert whole(matrix) == min(scripts(s)) == cheapest(s)


def test_long_sequences_share_one_grammar():
    r = random.Random(2)
    sequences = ["".join(r.choice("uaSuaxUA") for _ in range(r.randint(1, 300))) for _ in range(60)] + ["ua" * 500, "x" * 333, "a" * 257]
    for s, matrix in zip(sequences, repair.transfer(sequences)):
        assert whole(matrix) == cheapest(s)


def test_re_pair_writes_the_same_sequences():
    r = random.Random(3)
    sequences = [[r.randrange(3) for _ in range(r.randint(0, 80))] for _ in range(50)] + [[1] * 65]
    rules, written = repair.re_pair(sequences, 3)

    def full(s):
        return [s] if s < 3 else [x for part in rules[s - 3] for x in full(part)]

    assert [[x for s in q for x in full(s)] for q in written] == sequences
    pairs = [p for q in written for p in itertools.pairwise(q) if p[0] != p[1]]
    assert rules and len(pairs) == len(set(pairs))


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return {conv: judged(sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for conv, kept in convs.items()}


def judged(rows):
    seen, symbols, count = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        fault = None
        if not text.strip(SPACE):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif text.rstrip(SPACE)[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            count[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        symbols += "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = cheapest(symbols)
    out, left, turn = [], iter(rows), 0
    for edit in audit:
        if edit == "I":
            out.append(("user", "assistant")[turn] + ":")
            turn = 1 - turn
            continue
        _, role, text = next(left)
        if edit == "D":
            continue
        out.append((("user", "assistant")[turn] if edit == "R" else role) + ":" + text)
        if not (edit == "K" and role[:1] == "s"):
            turn = 1 - turn
    return gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def table(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = {"conv": "c", "copies": "x", "symbol": "y", "audit": "z", "first": "f"}
    from pyspark.sql import functions as F

    return frame.withColumns({k: F.lit(v) for k, v in clash.items()}).repartition(3)


def got(frame):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = frame.collect()
    out = {r.conv: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def talk(seed, conversations):
    r = random.Random(seed)
    texts = ["Well.", "Well. ", "no mark", "", " \t", None, "Why?\n", "ü!", "\xa0", "x" * 3000 + ".", "Ends. but", "a\x85"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "sage"]
    rows = []
    for conv in range(conversations):
        turn = r.randint(-2, 2)
        for _ in range(r.randint(1, 9)):
            rows.append((conv, None if r.random() < 0.05 else turn, r.choice(roles), r.choice(texts)))
            turn += r.choice([0, 1, 1, 1, 1, 3])
    return rows + [(None, 1, "user", "Hm."), (None, 2, "assistant", "Ah."), (None, 2, "assistant", "Ah.")]


@pytest.mark.parametrize("piece", [2, 4096])
def test_like_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    rows = talk(4, 250)
    want = expected(rows)
    assert got(repair.repair(repair.damage(table(spark, rows)))) == want
    assert any(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for v in want.values())


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 50)
    r = random.Random(6)
    rows = [(7, k, r.choice(["user", "assistant"]), f"Turn {k % 400}{r.choice(['.', '', '!'])}") for k in range(3000)]
    rows += [(8, 1, "user", "Same.")] * 500 + [(9, 1, "system", "Hi.")]
    assert got(repair.repair(repair.damage(table(spark, rows).repartition(8, "turn")))) == expected(rows)


def test_repaired_turns_alternate(spark):
    flagged = repair.faults(repair.damage(table(spark, talk(5, 80))))
    found = repair.audits(repair.pieces(flagged))
    turns = {}
    for r in sorted(repair.repaired_turns(flagged, found).collect(), key=lambda r: (r.conv or -1, r.place)):
        turns.setdefault(r.conv, []).append(r)
    assert turns
    for rows in turns.values():
        assert [r.place for r in rows] == list(range(len(rows)))
        assert re.fullmatch("s?(ua)+", "".join(r.role[:1] for r in rows))


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_repair(spark, sf_dir).withColumnRenamed("conv_id", "conv")) == expected(rows)


def test_empty_table(spark):
    assert repair.repair(repair.damage(table(spark, []))).count() == 0
