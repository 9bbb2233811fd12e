import numpy as np
import pytest
import xxhash

from facetflow.llm import components, simhash

from .cases import documents, empty, prose, texts


def slow(text, k=3):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("text", [None, "", "  \n", "a", "A b", "one Two three", "É x\x0bY z\x1cw", prose(5, 300), "a " * 70_000])
def test_fingerprints(text):
    if text and len(text) > 100_000:
        assert simhash.fingerprint(text, 3) == slow("a a a")
    else:
        assert simhash.fingerprint(text, 3) == slow(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 7])
def test_bit_sliced_distances(radius):
    r = np.random.default_rng(radius)
    v = r.integers(0, 2**64 - 1, 900, dtype=np.uint64)
    for i in range(400):
        v[i + 400] = v[i] ^ np.uint64(sum(1 << int(b) for b in r.choice(64, r.integers(0, 9), replace=False)))
    group = np.sort(r.integers(0, 3, 900))
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= radius
    expected = {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(near))) if i < j and group[i] == group[j]}
    assert {p for i, j in simhash.near(v, group, radius) for p in zip(i.tolist(), j.tolist())} == expected


@pytest.mark.parametrize("radius,part", [(3, 2048), (3, 4), (1, 16), (6, 64)])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, radius, part):
    monkeypatch.setattr(simhash, "PART", part)
    r = np.random.default_rng(part)
    v = [int(x) for x in r.integers(0, 2**64 - 1, 60, dtype=np.uint64)]
    for x in list(v):
        for _ in range(4):
            v.append(v[-1] ^ sum(1 << int(b) for b in r.choice(64, r.integers(1, radius + 3), replace=False)))
    v = sorted(set(v))
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in v], "fp long").repartition(3)
    got = groups([(a % 2**64, b % 2**64) for a, b in simhash.links(table, radius).collect()])
    want = groups([(a, b) for i, a in enumerate(v) for b in v[i + 1 :] if (a ^ b).bit_count() <= radius])
    assert {k: x for k, x in got.items()} == want


def test_documents(spark):
    base = prose(11, 400).split()
    rows = texts() + [(100 + i, " ".join(base[: 397 + i % 3])) for i in range(30)] + [(60, "  "), (61, prose(12, 80)), (62, prose(12, 80).upper())]
    out = simhash.near_duplicates(documents(spark, rows))
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()), key=str)
    fp = [(i, slow(t) if not t or len(t) < 50_000 else simhash.fingerprint(t, 3)) for i, t in rows]
    root = groups([(a, b) for a in range(len(fp)) for b in range(len(fp)) if (fp[a][1] ^ fp[b][1]).bit_count() <= 3])
    least = {}
    for k, (i, _) in enumerate(fp):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    assert got == sorted([(i, f"{f:016x}", least.get(root[k])) for k, (i, f) in enumerate(fp)], key=str)


def test_empty_table(spark):
    out = simhash.near_duplicates(empty(spark))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (5000, 5000), (None, 3), (7001, 7000)]
    edges = spark.createDataFrame(chain + star, "u long, v long").repartition(5)
    got = {r.node: r.root for r in components.components(edges).collect()}
    want = [set(range(301)), {1000 + i for i in range(300)}, {5000}, {7000, 7001}]
    assert got.keys() == set().union(*want)
    for nodes in want:
        roots = {got[n] for n in nodes}
        assert len(roots) == 1 and roots <= nodes
