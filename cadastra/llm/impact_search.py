"""Exact search for the largest integer inner products with an impact-ordered index.

Vectors are quantised to integers. A component is a posting whose impact is its absolute value; impacts
fall into levels by their highest bit. The index holds shards of at most ``shard`` vectors, each with one
segment per level and, behind every level, the exact norm of what is left of each vector.

A block of queries meets a shard's segments in descending impact and adds their products up. After each
segment the products still to come are at most ``|query| * |rest of the vector|`` (Cauchy-Schwarz). Once
this proves which vectors can be among the best ``k``, the scan of that shard stops; those are scored
exactly. The best of all shards are merged per query by an ordinary rank.

Every query must meet every shard: both travel as packed blocks, a shard once, followed by the blocks of
queries. A task holds one shard and one block of queries at a time. Rows are dealt to shards by their place as
well, so equal rows spread. On dense vectors whose components are all of a size, as random ones, the levels
prove nothing early and every posting is read; the README gives the share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cadastra.llm.words import arrow_schema, rows_of
from cadastra.sources.staging import stage

SHARD = 8192
QUERY_BLOCK = 1024
SCALE = 64
MOST_TASKS = 20_000
_LONG = (-(2**63), 2**63 - 1)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component as long; null where the vector takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Shard:
    """Integer vectors with their segments by impact level.

    Vectors of different lengths are filled up with zeros, so that only common components count.
    """

    def __init__(self, ids: np.ndarray, rows: list[list[int]]):
        width = max(map(len, rows), default=0)
        self.ids, self.width = ids, width
        self.rows = np.array([row + [0] * (width - len(row)) for row in rows], np.int64).reshape(len(rows), width)
        size = np.abs(self.rows.astype(np.float64))
        level = np.frexp(size)[1]  # 0 for 0, 1 for 1, 2 for 2 and 3, 3 for 4 to 7 ...
        self.segments: list[tuple[np.ndarray, np.ndarray]] = []
        # Low levels hold most of the postings and little of the score: they form one last segment.
        used = np.unique(level[level > 0])[::-1]
        groups = [[x] for x in used[:2]] + ([used[2:].tolist()] if len(used) > 2 else [])
        for group in groups:
            part = np.where(np.isin(level, group), self.rows, 0)
            rest = np.where((level > 0) & (level < min(group)), size, 0)
            # Rounded up, so that it stays a bound.
            self.segments.append((part.astype(np.float64), np.sqrt((rest * rest).sum(1)) * (1 + 1e-9)))


def best_in_shard(query_ids: np.ndarray, queries: list[list[int]], shard: Shard, k: int) -> Iterator[tuple[int, int, int]]:
    """``query, vector, score`` of the best ``k`` of a shard for each query, ties to the smaller id."""
    if not len(shard.ids):
        return
    width = shard.width
    integers = np.array([(q + [0] * width)[:width] for q in queries], np.int64).reshape(len(queries), width)
    floats = integers.astype(np.float64)
    norms = np.sqrt((floats * floats).sum(1)) * (1 + 1e-9)
    largest = float(np.abs(floats).max(initial=0)) * float(np.abs(shard.rows.astype(np.float64)).max(initial=0)) * max(width, 1)
    open_ = np.arange(len(queries))
    scores = np.zeros((len(queries), len(shard.ids)))
    own = query_ids[:, None] == shard.ids[None, :]
    for number, (part, rest) in enumerate(shard.segments or [(np.zeros((len(shard.ids), width)), np.zeros(len(shard.ids)))]):
        scores[open_] += floats[open_] @ part.T
        last = number >= len(shard.segments) - 1
        still = []
        for row in open_.tolist():
            members = _members(scores[row], norms[row] * rest, own[row], k, largest, last)
            if members is None:
                still.append(row)
                continue
            yield from _exact(int(query_ids[row]), integers[row], shard, members, k, largest)
        open_ = np.array(still, int)
        if not len(open_):
            return


def _members(score: np.ndarray, slack: np.ndarray, own: np.ndarray, k: int, largest: float, last: bool) -> np.ndarray | None:
    """Positions that can be among the best ``k``, or None while there are too many to be worth scoring.

    Sums of floats are off by less than ``largest * 1e-12``, which widens the bounds.
    """
    slack = slack + (largest * 1e-12 if largest >= 2**53 else 0.0)
    low = np.where(own, -np.inf, score - slack)
    if len(low) <= k:
        return np.flatnonzero(~own)
    threshold = np.partition(low, len(low) - k)[len(low) - k]
    possible = np.flatnonzero(~own & (score + slack >= threshold))
    return possible if last or len(possible) <= 8 * k else None


def _exact(query_id: int, query: np.ndarray, shard: Shard, members: np.ndarray, k: int, largest: float) -> list[tuple[int, int, int]]:
    """Integer scores of the possible members; Python integers where 64 bits could overflow, cut to 64 bits at the end."""
    rows = shard.rows[members]
    if largest < 2**62:
        exact = (rows @ query).tolist()
    else:
        exact = [min(max(sum(a * b for a, b in zip(row, query.tolist())), _LONG[0]), _LONG[1]) for row in rows.tolist()]
    order = sorted(zip(exact, shard.ids[members].tolist()), key=lambda x: (-x[0], x[1]))
    return [(query_id, vec_id, score) for score, vec_id in order[:k]]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, ids, components) rows, one block after another, to one row of packed arrays per block."""
    schema = arrow_schema("block long, ids binary, lengths binary, components binary")
    now, ids, rows = None, [], []

    def block() -> pa.RecordBatch:
        flat = np.array([x for row in rows for x in row], np.int64)
        packed = [np.array(ids, np.int64), np.array([len(r) for r in rows], np.int32), flat]
        return rows_of(schema, {n: [v] for n, v in zip(schema.names, [now, *(a.tobytes() for a in packed)])})

    for batch in batches:
        for key, id_, vector in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if key != now and ids:
                yield block()
                ids, rows = [], []
            now = key
            ids.append(id_)
            rows.append(vector)
    if ids:
        yield block()


def _unpack(ids: bytes, lengths: bytes, components: bytes) -> tuple[np.ndarray, list[list[int]]]:
    sizes = np.frombuffer(lengths, np.int32)
    flat = np.frombuffer(components, np.int64).tolist()
    ends = np.cumsum(sizes).tolist()
    return np.frombuffer(ids, np.int64), [flat[end - size:end] for size, end in zip(sizes.tolist(), ends)]


def _blocks(vectors: DataFrame, size: int, total: int) -> tuple[DataFrame, int]:
    """Vectors dealt to blocks of about ``size`` by a hash of id and place, and the number of blocks."""
    count = max(1, -(-total // size))
    place = F.xxhash64("vec_id", F.monotonically_increasing_id())
    dealt = vectors.select(F.pmod(place, F.lit(count)).alias("block"), "vec_id", "v")
    packed = dealt.repartition(count, "block").sortWithinPartitions("block")
    return packed.mapInArrow(_pack, "block bigint, ids binary, lengths binary, components binary"), count


def build_index(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shard: int = SHARD,
) -> tuple[DataFrame, int]:
    """Index of all vectors that take part, as packed shards in the scratch folder, and the number of shards."""
    rows = _taking_part(vectors, id, vector, scale)
    blocks, count = _blocks(rows, shard, rows.count())
    return stage(blocks, "impacts"), count


def _taking_part(vectors: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), quantised(F.col(vector), scale).alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("query_id long, vec_id long, score long")
        now, shard = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                packed = _unpack(row["ids"], row["lengths"], row["components"])
                if row["q_block"] < 0:
                    now, shard = row["block"], Shard(*packed)
                elif row["block"] == now:
                    found = list(best_in_shard(*packed, shard, k))
                    if found:
                        yield rows_of(schema, dict(zip(schema.names, zip(*found))))

    return run


def top_scores(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
    shard: int = SHARD, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``k`` vectors for each query, all if there are fewer.

    Scores are exact integers; ties go to the smaller id; a vector with the id of the query is never its
    result. Null vectors, vectors with a null or non-finite component and null ids take no part, neither as
    queries nor as candidates. An empty vector scores 0 with everything. Equal rows count once each as
    candidates, and once as a query.
    """
    index, shards = build_index(vectors, id, vector, scale, shard)
    asked = stage(_taking_part(queries, id, vector, scale).distinct(), "queries")
    blocks, _ = _blocks(asked, query_block, asked.count())
    # Each block of queries goes to each shard, by the number of the shard.
    everywhere = blocks.withColumnRenamed("block", "q_block").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))
    both = index.withColumn("q_block", F.lit(-1).cast("long")).unionByName(everywhere)
    dealt = both.repartition(min(shards, MOST_TASKS), "block").sortWithinPartitions("block", "q_block")
    found = dealt.mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
