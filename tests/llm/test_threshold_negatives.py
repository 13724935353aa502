from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from cadastra.llm import threshold_negatives as tn  # noqa: E402
from tools.compare import connect, difference  # noqa: E402

SCHEMA = "vec_id long, label int, embedding array<double>, v string, shard string"
LONG = 2**63


def brute(rows, anchors, positives=5, negatives=3, scale=256):
    """Over all pairs, with Python integers; rows are (id, label, vector)."""

    def whole(rows):
        kept = [r for r in rows if None not in r and all(x is not None and np.isfinite(x) for x in r[2])]
        return [(i, label, tuple(min(max(int(np.floor(scale * x)), -LONG), LONG - 1) for x in vector)) for i, label, vector in kept]

    out, rows = [], whole(rows)
    for anchor_id, label, vector in sorted(set(whole(anchors))):
        scored = [(sum(a * b for a, b in zip(vector, v)), i, same) for i, same, v in rows if i != anchor_id]
        scored = sorted(((min(max(s, -LONG), LONG - 1), i, x) for s, i, x in scored), key=lambda s: (-s[0], s[1]))
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fitting = [s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score]
            out += [(anchor_id, positive, rank, i, score, s) for rank, (s, i, _) in enumerate(fitting[:negatives], start=1)]
    return sorted(out)


def mine(spark, rows, anchors, **settings):
    frames = (tn.taking_part(spark.createDataFrame([(*r, "a", "b") for r in part], SCHEMA)) for part in (rows, anchors))
    out = tn.hard_negatives(*frames, **settings)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def made(count, width, labels, seed):
    rng = random.Random(seed)
    return [(i, rng.randrange(labels), [rng.gauss(0, 0.2) for _ in range(width)]) for i in range(count)]


@pytest.mark.parametrize("shard,block", [(4096, 256), (7, 3)])
def test_against_all_pairs(spark, shard, block):
    rows = made(150, 6, 4, 1)
    # Ties, repeated rows, a label that holds a third, zero, short, empty, null and infinite vectors.
    rows += [(200 + i, 9, [0.5, 0.5, 0.25, 0.0, 0.0, 0.0]) for i in range(60)] + [(300, 2, [0.5, 0.5, 0.25, 0.0, 0.0, 0.0])] * 3
    rows += [(400, 1, [0.0] * 6), (401, 1, [0.3]), (402, 2, []), (403, None, [0.1] * 6), (404, 1, None), (405, 1, [0.1, None])]
    rows += [(406, 1, [float("inf")] * 6), (None, 1, [0.4] * 6), (407, 1, [float("nan")] * 6), (0, 3, [0.9] * 6), (500, 77, [0.2] * 6)]
    anchors = [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] > 399)]
    assert mine(spark, rows, anchors, shard=shard, anchor_block=block) == brute(rows, anchors)


def test_huge_components(spark):
    rows = [(i, i % 2, [1e14 * (i - 5), -3e15 + i, 7.0]) for i in range(12)]
    assert mine(spark, rows, rows[:4]) == brute(rows, rows[:4])


def test_scan_stops_by_proof():
    """With few dimensions that carry the score, most candidates are never fetched; the results are those of all."""
    rng = np.random.default_rng(2)
    rows = np.rint(rng.normal(0, 1, (5000, 4)) * [1000, 30, 3, 1]).astype(np.int64)
    lists = tn.SortedLists(np.arange(5000), np.zeros(5000, np.int64), rows)
    everything = np.ones(5000, bool)
    for anchor in np.rint(rng.normal(0, 100, (20, 4))).astype(np.int64):
        scores = rows @ anchor
        top = int(scores.max())
        windows = [(*tn._LONG, 5), (-(-top // 2), 95 * top // 100, 3), (10**9, 10**9, 3), (5, 1, 3)]
        for (low, high, k), found in zip(windows, lists.scan(anchor, everything, windows)):
            order = sorted(((-int(s), i) for i, s in enumerate(scores.tolist()) if low <= s <= high))[:k]
            assert found == [(-s, i) for s, i in order]
    assert lists.accesses < lists.offered / 2


def test_empty_tables(spark):
    rows = made(10, 3, 2, 4)
    assert mine(spark, [], []) == mine(spark, rows, []) == mine(spark, [], rows) == []


def test_query_against_sql(spark):
    assert difference(spark, connect("/root/testdata/sf0.01"), "op13_threshold_negatives", "/root/testdata/sf0.01") == ""
