"""Awkward documents: nulls, empty and long texts, repeated rows, clashing names."""

from __future__ import annotations

import random

NAMES = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, score double, fp long, line string, shard string, kept string, t string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abdeilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(n))


def texts() -> list[tuple]:
    long = prose(1, 40_000)
    rows = [
        (1, prose(2, 60)),
        (2, None),
        (3, ""),
        (4, "one"),
        (5, "Élan Vital, K 42.\nZwei  Zeilen\r\n\ttabs"),
        (6, long),
        (7, prose(3, 120)),
        (7, prose(3, 120)),
        (9, prose(3, 120)),
        (None, prose(4, 30)),
        (None, None),
    ]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, None, "s", None, 77, "row", 0.5, 1, "line", "x", None, "t") for i, t in rows]
    return spark.createDataFrame(full, NAMES).repartition(3)


def empty(spark):
    return spark.createDataFrame([], NAMES)
