import random
import re

import pytest
from pyspark.sql import functions as F

from facetflow.llm import line_dedup

from .cases import documents, empty, prose, texts


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def edited(r, text, n):
    for _ in range(n):
        at, c = r.randrange(len(text) + 1), r.choice("abcé \\")
        text = {"i": text[:at] + c + text[at:], "d": text[: max(at - 1, 0)] + text[at:], "s": text[: max(at - 1, 0)] + c + text[at:]}[r.choice("ids")]
    return text


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    r = random.Random(edits)
    pairs = [("", ""), ("a", ""), ("", "ab"), ("abc", "abc"), ("é", "e"), ("ab", "ba"), ("x" * 200, "x" * 199)]
    for _ in range(120):
        a = "".join(r.choice("abcdé") for _ in range(r.randint(0, 40)))
        pairs.append((a, edited(r, a, r.randint(0, edits + 2))))
    got = spark.createDataFrame(pairs, "a string, b string")
    got = {(x.a, x.b): x.distance for x in line_dedup.with_distance(got, "a", "b", edits).collect()}
    for a, b in pairs:
        d = distance(a, b)
        assert got.get((a, b)) == (d if d <= edits else None), (a, b, d)


def lines_of(rows):
    return [((i is not None, i or 0), n, line, k) for k, (i, t) in enumerate(rows) for n, line in enumerate((t or "").split("\n"))]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_links_equal_brute_force(spark, edits):
    r = random.Random(edits)
    lines = [prose(k, r.randint(3, 7)) for k in range(40)]
    lines += [edited(r, x, r.randint(1, edits + 1)) for x in lines for _ in range(3)] + ["zz" * 20, "zz" * 20 + "z"]
    lines = sorted(set(lines))
    table = spark.createDataFrame([(x,) for x in lines], "line string").select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "line", line_dedup._letters(F.col("line")).alias("letters"))
    text = {(x.h1, x.h2): x.line for x in table.collect()}
    got = {(frozenset([text[x.a1, x.a2], text[x.b1, x.b2]]), x.distance) for x in line_dedup.line_links(table, edits).collect()}
    want = {(frozenset([a, b]), distance(a, b)) for i, a in enumerate(lines) for b in lines[i + 1 :] if distance(a, b) <= edits}
    assert got == want


def removed_by_hand(rows, edits, least):
    seen, out = [], {}
    for key, n, line, k in sorted(lines_of(rows), key=lambda x: (x[0], x[1])):
        if len(line) >= least:
            if any(earlier < (key, n) and abs(len(o) - len(line)) <= edits and distance(o, line) <= edits for earlier, o in seen):
                out.setdefault(k, []).append(n)
            seen.append(((key, n), line))
    return out


def test_documents(spark):
    a, b, c = prose(70, 12), prose(71, 15), prose(72, 60)
    rows = [
        (5, f"{a}\nshort\n{b}"), (3, f"{b}\n{a}x\nshort\n{a}"), (8, f"{c}\n{c}\n{a[1:]}"), (9, c), (10, None), (11, ""), (12, "\n\n"),
        (None, f"{prose(73, 20)}\nend"), (14, f"{prose(73, 20)}\n"), (15, "x" * 300_000), (16, "x" * 300_000),
    ]
    gone = removed_by_hand([r for r in rows if r[0] not in (15, 16)], 1, 40)
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in line_dedup.report(docs).collect()}
    cleaned = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert line_dedup.dedup_lines(docs).columns == docs.columns and len(got) == len(cleaned) == len(rows)
    for k, (i, t) in enumerate(rows):
        if i in (15, 16):
            assert got[i].n_removed == (i == 16)
            continue
        lines = (t or "").split("\n")
        out = gone.get(k, [])
        assert (got[i].n_lines, got[i].n_removed, got[i].removed_lines) == (len(lines), len(out), ",".join(map(str, out)))
        assert cleaned[i].text == (t if not out else "\n".join(x for n, x in enumerate(lines) if n not in out))


def test_short_copies_are_folded_and_not_linked(spark):
    a = prose(80, 12)
    rows = [(1, f"menu\n{a}\n\nmenu"), (2, f"home\n{a}x\nmenu\n\nmenus"), (3, "x\nhome"), (4, "x\ny\n")]
    docs = documents(spark, rows)
    got = {r.doc_id: r.removed_lines for r in line_dedup.report(docs, fold_chars=1).collect()}
    assert got == {1: "3", 2: "1,2", 3: "1", 4: "0"}
    cleaned = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, fold_chars=1).collect()}
    assert cleaned == {1: f"menu\n{a}\n", 2: "home\n\nmenus", 3: "x", 4: "y\n"}
    import corpus_pipeline

    staged = corpus_pipeline.without_repeated_lines(spark, docs, "")
    assert {r.doc_id: r.text for r in staged.collect()} == cleaned


def test_links_of_kept_lines_are_reported(spark):
    a = prose(81, 12)
    rows = [(1, f"{a}\nother"), (2, f"{a}x"), (3, f"{a}y\nother"), (4, "nothing")]
    got = {r.doc_id: (r.removed_lines, r.most_links) for r in line_dedup.report(documents(spark, rows), fold_chars=1).collect()}
    assert got == {1: ("", 2), 2: ("0", 2), 3: ("0,1", 2), 4: ("", 0)}


def test_many_equal_lines_in_one_document(spark):
    import time

    rows = [(1, "\n".join(["ab"] * 100_000 + ["cd"])), (2, "ab\nef")]
    began = time.time()
    cleaned = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows), fold_chars=1).collect()}
    assert cleaned == {1: "ab\ncd", 2: "ef"}
    assert time.time() - began < 30


def test_repeated_rows_are_treated_alike(spark):
    rows = [(7, prose(3, 120)), (7, prose(3, 120)), (9, prose(3, 120)), (9, prose(3, 120))]
    got = sorted((r.doc_id, r.n_removed) for r in line_dedup.report(documents(spark, rows)).collect())
    assert got == [(7, 0), (7, 0), (9, 1), (9, 1)]
    assert line_dedup.report(documents(spark, texts())).count() == len(texts())


def test_empty_table_and_no_python(spark):
    assert line_dedup.report(empty(spark)).count() == 0 and line_dedup.dedup_lines(empty(spark)).count() == 0
    for out in (line_dedup.report(documents(spark)), line_dedup.dedup_lines(documents(spark))):
        assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())
