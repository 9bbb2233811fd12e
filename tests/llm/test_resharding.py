import itertools
import random

import pytest
from pyspark.sql import functions as F

from facetflow.llm import resharding

from .cases import documents, empty, texts


def moved(blocks, keep):
    return sum((n - keep[b]) * max(1, size // n) for b, (n, size) in blocks.items())


def brute(blocks, capacities):
    """The least bytes over all numbers of kept rows."""
    keys = list(blocks)
    best = None
    for kept in itertools.product(*(range((blocks[b][0] if b[0] < len(capacities) else 0) + 1) for b in keys)):
        keep = dict(zip(keys, kept))
        if all(sum(k for (old, _), k in keep.items() if old == s) <= c for s, c in enumerate(capacities)):
            cost = moved(blocks, keep)
            best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("seed", range(15))
def test_fewest_bytes_move(seed):
    r = random.Random(seed)
    blocks = {}
    for old in range(r.randint(1, 3)):
        for kind in r.sample(range(4), 2):
            n = r.randint(1, 4)
            blocks[old, kind] = n, n * r.randint(1, 50)
    total, shards = sum(n for n, _ in blocks.values()), r.randint(1, 4)
    capacities = [total // shards + (s < total % shards) for s in range(shards)]
    keep = resharding.plan_transfers(blocks, capacities)
    assert all(0 <= keep[b] <= blocks[b][0] for b in blocks)
    assert moved(blocks, keep) == brute(blocks, capacities)


def check(out, rows, shards):
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r.slot)
    counts = [len(by_shard.get(s, [])) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1 and set(by_shard) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert sorted((str((r["row"].doc_id, r["row"].text)) for r in out)) == sorted(map(str, rows))


@pytest.mark.parametrize("shards", [1, 4, 24])
def test_rows_are_even_and_none_is_lost(spark, shards):
    rows = texts() + [(i, f"text {i} " * (i % 9)) for i in range(100, 160)] + [(500, "same")] * 40
    docs = documents(spark, rows)
    out = resharding.reshard(docs, F.pmod(F.col("doc_id"), F.lit(3)), shards)
    check(out.collect(), rows, shards)
    assert out.select("row.*").columns == docs.columns


def test_rows_stay_where_they_can(spark):
    rows = [(i, "x" * 50) for i in range(40)]
    docs = documents(spark, rows)
    stay = resharding.reshard(docs, F.pmod(F.col("doc_id"), F.lit(4)), 4).collect()
    check(stay, rows, 4)
    assert all(r["row"].doc_id % 4 == r.shard for r in stay)
    grown = resharding.reshard(docs, F.pmod(F.col("doc_id"), F.lit(4)), 5).collect()
    check(grown, rows, 5)
    assert sum(r["row"].doc_id % 4 != r.shard for r in grown) == 8


def test_empty_table(spark):
    out = resharding.reshard(empty(spark), F.lit(0), 24)
    assert out.columns == ["row", "shard", "slot"] and out.count() == 0
