"""Jaccard join against all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from cadastra.llm import combination_join as cj, components
from cadastra.llm.words import WordHashes


def brute(rows, n, percent):
    """(id, number of shingles, component) of every row."""
    sets = [(i, cj.shingles(cj.normal_words((t or "").encode()), n)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in combinations([s for s in sets if s[1] and s[0] is not None], 2):
        if 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    known = {frozenset(s): root(i) for i, s in sets if i is not None and s}
    return sorted(((i, len(s), root(i) if i is not None else known.get(frozenset(s))) for i, s in sets), key=str)


def texts(seed, n_groups=14):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "Straße", "x", "Éa", "a-b"]) + str(rng.randrange(50))
    passage = [word() for _ in range(25)]
    out = []
    for _ in range(n_groups):
        base = [word() for _ in range(rng.choice([1, 2, 3, 5, 20, 60, 150]))] + (passage if rng.random() < 0.4 else [])
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            out.append(rng.choice([" ", "\n"]).join(copy if rng.random() < 0.8 else [w.upper() if w.isascii() else w for w in copy]))
    rng.shuffle(out)
    return [(i + 1, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("limit,block", [(None, 2000), (2, 3)])
@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_equals_all_pairs(spark, monkeypatch, n, percent, limit, block):
    rows = texts(n + block) + [(900, None), (901, ""), (902, " \t "), (903, "one"), (904, "ONE"), (905, "one two"), (1, texts(n + block)[0][1])]
    rows += [(None, rows[3][1]), (None, "nowhere else " * 3), (906, "y " * 400), (907, "y " * 300)]
    if limit:  # most tokens count as frequent, so pairs are at work
        monkeypatch.setattr(cj, "frequency_classes", lambda counts, mean: (counts >= limit).astype(np.uint8))
        monkeypatch.setattr(cj, "BLOCK", block)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' AS size", "1 AS component", "2 AS node").repartition(3)
    got = cj.similar_documents(df, n=n, percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, n, percent)


def test_signatures_of_similar_sets_meet():
    rng = np.random.default_rng(2)
    for trial in range(400):
        size = int(rng.integers(1, 120))
        classes = np.zeros(1 << cj.SKETCH_BITS, np.uint8)
        share = rng.random()
        classes[rng.random(len(classes)) < share] = 1 + trial % 2
        base = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
        other = base.copy()
        for _ in range(int(rng.integers(0, max(1, size // 8) + 1))):
            other[rng.integers(size)] = rng.integers(0, 2**63, dtype=np.uint64)
        a, b = np.unique(base), np.unique(other if trial % 3 else other[: max(1, size - size // 9)])
        common = len(np.intersect1d(a, b))
        if 100 * common < 85 * (len(a) + len(b) - common):
            continue
        one, two = ({s: (before, pair) for s, before, pair in cj.signatures(v, classes, 85)} for v in (a, b))
        bits = [cj._folded(cj._bitmap(v, len(v)), cj.LIST_BITS // 8).tobytes() for v in (a, b)]
        rows = [
            [{"doc_id": i, "size": len(v), "before": d[s][0], "pair": d[s][1], "bits": bits[i - 1], "component": i, "block": 0} for i, v, d in ((1, a, one), (2, b, two))]
            for s in one.keys() & two.keys()
        ]
        assert any(list(cj.list_pairs(r, 85)) == [(1, 2)] for r in rows), (trial, size)


def test_hash_order_is_no_property_of_neighbours():
    found = cj.tokens([b"a", b"b", b"c"], 4, WordHashes())
    assert len(found) == 1 and found[0] == cj.tokens([b"a", b"b", b"c"], 3, WordHashes())[0]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40, 0, -1)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 180)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 42)}, 100: 100, 101: 100, 150: 150, 180: 150, 200: 150}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays(spark):
    rows = texts(77)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(i for i, _, c in brute(rows, 5, 80) if i == c)
    assert sorted(r["doc_id"] for r in cj.first_of_each_group(df).collect()) == want
    assert cj.similar_documents(df.limit(0)).collect() == []


def test_one_id_with_many_texts(spark, monkeypatch):
    monkeypatch.setattr(cj, "HEADS", 3)
    rng = random.Random(8)
    bases = [[f"w{rng.randrange(10_000)}" for _ in range(60)] for _ in range(25)]
    rows = [(5, " ".join(base)) for base in bases] + [(5, " ".join(bases[0]))] * 4
    rows += [(10 + i, " ".join(["new", *base[1:]])) for i, base in enumerate(bases)]
    rows += [(3, " ".join(base[:-1] + ["end"])) for base in bases[5:15]] + [(100 + i, f"other {i} text {i * i} here") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in cj.similar_documents(df).collect()), key=str)
    assert got == brute(rows, 4, 85) and sum(c == 3 for _, _, c in got) == 64


def test_rare_lists_follow_the_spread_of_the_loads():
    rng = np.random.default_rng(4)
    for mean in (0.0, 20.0, 2_000.0, 200_000.0):
        counts = rng.poisson(mean, 1 << 18).astype(np.uint32)
        counts[:100] += 10_000_000  # what stands out does not move the limit
        limit = cj.rare_limit(counts)
        assert abs(limit - (mean + cj.WANTED_LIST + 4 * mean ** 0.5)) <= 0.2 * mean ** 0.5 + 5
        classes = cj.frequency_classes(counts, limit)
        assert classes[:100].all() and classes[100:].mean() < 0.001


def test_copies_in_a_task_count_once():
    import pyarrow as pa
    import zstandard

    def counted(texts):
        batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
        out = pa.Table.from_batches(list(cj._survey(4)(iter([batch, batch])))).to_pylist()
        sums = [np.frombuffer(zstandard.decompress(r["counts"]), np.uint32).sum() for r in out if r["counts"]]
        return [(r["size"], r["words"], r["bits"]) for r in out if r["part"] is None], int(sum(sums))

    texts = ["one two three four five", "ONE two  three four five", None, "", "a b c d e f"]
    rows, total = counted(texts)
    assert rows[:5] == rows[5:] and rows[0] == rows[1] and rows[2] == rows[3] == (0, None, None) and total == 2 + 3
