"""Top scores against all inner products."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from cadastra.llm import impact_search as imp


def brute(rows, queries, k, scale=64):
    q = lambda v: [math.floor(x * scale) for x in v]
    usable = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    out = []
    asked = {(i, tuple(q(v))) for i, v in queries if i is not None and usable(v)}
    for i, v in asked:
        scores = [(-sum(a * b for a, b in zip(v, q(w))), j) for j, w in rows if j is not None and usable(w) and j != i]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], start=1)]
    return sorted(out)


@pytest.mark.parametrize("shard,block", [(8192, 1024), (17, 5)])
def test_equals_all_products(spark, shard, block):
    rng = random.Random(shard)
    rows = [(i, [rng.gauss(0, 0.15) for _ in range(24)]) for i in range(260)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")] * 24), (None, [0.1] * 24), (305, [])]
    rows += [(306, [0.5]), (307, [0.2] * 40), (308, rows[5][1]), (309, rows[5][1]), (310, [0.0] * 24), (5, rows[5][1]), (320, [30.0] * 24), (321, [-30.0] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS block", "1 AS v", "2 AS score").repartition(3)
    asked = df.where("vec_id % 20 = 0 OR vec_id >= 300 OR vec_id = 5")
    got = imp.top_scores(df, asked, k=7, shard=shard, query_block=block)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, [r for r in rows if r[0] is not None and (r[0] % 20 == 0 or r[0] >= 300 or r[0] == 5)], 7)
    assert imp.top_scores(df.limit(0), asked.limit(0)).collect() == []


def test_fewer_than_k_and_one_vector(spark):
    df = spark.createDataFrame([(1, [0.5]), (2, [0.25])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in imp.top_scores(df, df, k=20).collect())
    assert got == [(1, 1, 2, 512), (2, 1, 1, 512)]
    assert imp.top_scores(df.where("vec_id = 1"), df.where("vec_id = 1")).collect() == []


def test_large_numbers_stay_exact():
    big = [2**40 + 1, -(2**33) + 3, 5]
    shard = imp.Shard(np.array([1, 2, 3, 4]), [big, [x + 1 for x in big], [2**52] * 3, [0, 0, 0]])
    got = list(imp.best_in_shard(np.array([9]), [big], shard, 2))
    exact = {i: sum(a * b for a, b in zip(big, row)) for i, row in zip((1, 2, 3, 4), shard.rows.tolist())}
    want = sorted(((-min(max(s, -(2**63)), 2**63 - 1), i) for i, s in exact.items()))[:2]
    assert got == [(9, i, -s) for s, i in want]


def test_scan_stops_before_the_last_segment():
    rng = np.random.default_rng(0)
    rows = np.floor(rng.normal(0, 2, (500, 16))).astype(int)
    rows[:3] += 60
    shard = imp.Shard(np.arange(500), rows.tolist())
    first = shard.segments[0][1]
    query = rows[0].astype(float)
    score = query @ shard.segments[0][0].T
    members = imp._members(score, np.linalg.norm(query) * first, np.arange(500) == 0, 2, 1e6, False)
    assert members is not None and set(members) >= {1, 2} and len(members) < 20
