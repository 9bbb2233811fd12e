import random

import numpy as np
import pytest

from facetflow.llm import decontamination as D

from .cases import documents, empty, prose, texts


def slow_tiles(document, item, least):
    """Greedy string tiling as defined: the longest unmarked matches first."""
    a, b, out = [False] * len(document), [False] * len(item), []
    while True:
        best, found = least, []
        for p in range(len(document)):
            for t in range(len(item)):
                n = 0
                while p + n < len(document) and t + n < len(item) and document[p + n] == item[t + n] and not a[p + n] and not b[t + n]:
                    n += 1
                if n > best:
                    best, found = n, [(p, t)]
                elif n == best:
                    found.append((p, t))
        if not found:
            return out
        for p, t in found:
            if not any(a[p : p + best]) and not any(b[t : t + best]):
                a[p : p + best] = b[t : t + best] = [True] * best
                out.append((p, t, best))


@pytest.mark.parametrize("seed", range(12))
def test_tiles_cover_what_slow_tiling_covers(seed):
    r = random.Random(seed)
    item = [r.randint(1, 6) for _ in range(30)]
    parts = [item[i : i + 7] for i in range(0, 30, 7)]
    r.shuffle(parts)
    document = [r.randint(1, 6) for _ in range(20)] + [x for p in parts for x in p] + [r.randint(1, 6) for _ in range(9)]
    got = D.tiles(np.array(document, np.uint64), np.array(item, np.uint64), 5)
    want = slow_tiles(document, item, 5)
    assert max((n for *_, n in got), default=0) == max((n for *_, n in want), default=0)
    assert abs(sum(n for *_, n in got) - sum(n for *_, n in want)) <= 5
    used_p, used_t = [x for p, _, n in got for x in range(p, p + n)], [x for _, t, n in got for x in range(t, t + n)]
    assert len(set(used_p)) == len(used_p) and len(set(used_t)) == len(used_t)
    assert all(document[p : p + n] == item[t : t + n] and n >= 5 for p, t, n in got)


def test_window_hashes_are_the_rolling_ones():
    ids = np.random.default_rng(3).integers(0, 9, 200).astype(np.uint64)
    for n in (1, 5, 33, 200):
        a, b = D.rolling(ids, n), D._windows(ids, n)
        same_a = a[:, None] == a[None, :]
        assert (same_a == (b[:, None] == b[None, :])).all()
    assert len(D.rolling(ids, 201)) == len(D._windows(ids, 201)) == 0


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, row string")


def flagged(spark, rows, bench):
    out = D.flag(documents(spark, rows), items(spark, bench))
    return {(r["row"].doc_id): (r["items"], round(r.coverage, 3)) for r in out.collect()}


def test_exact_reordered_partial_and_clean(spark):
    test = prose(50, 40)
    w = test.split()
    noise = prose(51, 200)
    rows = [
        (1, f"{noise} {test} {noise}"),
        (2, " ".join([noise, *w[20:], noise, *w[:20]])),  # reordered
        (3, " ".join([noise, *w[:16], "other", *w[17:30]])),  # 29 of 40 words
        (4, " ".join(x for pair in zip(w, noise.split()) for x in pair)),  # no run of five
        (5, noise),
        (6, test.upper().replace(" ", ",\n")),
        (7, " ".join([*w[:19], "other", *w[20:]])),  # 39 of 40
        (8, "Tiny item here"),
        (9, "tiny item"),
    ]
    got = flagged(spark, rows, [(1, test, "x"), (2, "tiny ITEM, here", "x"), (3, None, "x"), (4, "", "x"), (5, "...", "x")])
    assert got == {
        1: (["1"], 1.0), 2: (["1"], 1.0), 3: ([], 0.0), 4: ([], 0.0), 5: ([], 0.0), 6: (["1"], 1.0), 7: (["1"], 0.975), 8: (["2"], 1.0), 9: ([], 0.0),
    }


def test_awkward_rows_blocks_and_empty(spark, monkeypatch):
    bench = [(1, prose(3, 120), "x"), (1, prose(2, 60), "x"), (None, prose(4, 30), "x"), (2, prose(60, 30), "x")]
    one = sorted(map(str, D.flag(documents(spark, texts()), items(spark, bench)).collect()))
    monkeypatch.setattr(D, "BLOCK_WORDS", 50)
    docs = documents(spark, texts())
    blocks = D.flag(docs, items(spark, bench))
    assert sorted(map(str, blocks.collect())) == one and len(one) == len(texts())
    assert blocks.select("row.*").columns == docs.columns
    assert sorted(r["row"].doc_id for r in blocks.collect() if r["items"] == ["1"]) == [1, 7, 7, 9]
    assert D.flag(empty(spark), items(spark, bench)).count() == 0
    assert {len(r["items"]) for r in D.flag(docs, items(spark, [])).collect()} == {0}
