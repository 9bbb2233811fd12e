import random
import re
import zlib
from collections import Counter

import pytest

from facetflow.llm import spelling

from .cases import documents, empty, texts


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words_of(rows):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(vocab):
    out, forms = {}, {}
    for w, n in vocab.items():
        close = [v for v in vocab if abs(len(v) - len(w)) <= 1 and near(w, v)]
        best = min(close, key=lambda v: (-vocab[v], v), default=None)
        form = best if best is not None and vocab[best] >= 10 * n else None
        forms[w] = form
        out[w] = [form, None, n, len(close), vocab.get(form)]
    for w in out:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def got(frame):
    rows = frame.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def family(seed):
    """Texts with chains of variants: each ten times as frequent as the one before."""
    r = random.Random(seed)
    rows = []
    for k in range(25):
        word = "".join(r.choice("abcé") for _ in range(r.randint(7, 11)))
        for times in (150, 12, 1):
            rows += [(1000 * k + j, f"{word} {word.upper()} x") for j in range(times)]
            at = r.randrange(len(word))
            word = r.choice([word[:at] + word[at + 1 :] + "c", word[:at] + "b" + word[at + 1 :], word[:at] + "a" + word[at:]])
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("part", [4, 4096])
def test_like_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(spelling, "PART", part)
    rows = family(3)
    vocab = words_of(rows)
    want = expected(vocab)
    assert got(spelling.variants(documents(spark, rows))) == want
    assert any(v[0] and want[v[0]][0] for v in want.values())  # a chain of two


def test_a_bucket_of_equal_halves(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PART", 16)
    r = random.Random(1)
    words = {"aaaa" + "".join(r.choice("ab") for _ in range(r.randint(4, 6))) for _ in range(60)}
    words |= {"".join(r.choice("ab") for _ in range(r.randint(3, 5))) + "bbbbb" for _ in range(60)}
    vocab = {w: r.randint(2, 400) for w in words}
    rows = spark.createDataFrame(list(vocab.items()), "word string, n long")
    want = expected(vocab)
    found = {x.word: (x.n_near, x.best.word, x.best.n) for x in spelling.near_counts(rows).collect()}
    for w, (_, _, _, count, _) in want.items():
        assert found.get(w, (0,))[0] == count
        if count:
            best = min((v for v in vocab if near(w, v)), key=lambda v: (-vocab[v], v))
            assert found[w][1:] == (best, vocab[best])


def test_awkward_rows(spark):
    long = "z" * 5000
    rows = [*texts(), (20, f"{long} {long[:-1]}y"), (21, f"{long} {long[:-1]}y Straße straße STRASSE"), (None, "Übermut übermut Übermut")]
    assert got(spelling.variants(documents(spark, rows))) == expected(words_of(rows))


def test_empty_table(spark):
    assert spelling.variants(empty(spark)).count() == 0
