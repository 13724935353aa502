"""Hard negatives of anchors by Fagin's threshold algorithm, with exact integer scores.

An anchor's positives are the best ``positives`` other vectors of its label. For each positive, the hard
negatives are the best ``negatives`` vectors of other labels whose score lies in a window below the
positive's.

Threshold algorithm
-------------------
Candidates are dealt to shards. A shard holds, per dimension, the list of its candidates in the order of
that component. For an anchor every list is read from the end that raises its score: from the top where the
anchor's component is positive, from the bottom where it is negative, not at all where it is zero. Each
candidate met for the first time is fetched whole and scored (random access). No candidate that is still
unseen can score more than the threshold, the anchor's product with the values the lists have come to. The
scan ends once the threshold is strictly below the ``k``-th score of every window, or below the window
itself, or when all candidates are seen. All windows of one anchor share one scan.

The shards' results are merged by an ordinary rank. Positives come first; their scores set the windows of
the second pass.

Scale and skew
--------------
* Shards are cut from the candidates in the order of label, then hash. So a positive pass meets only the
  shards that hold the anchors' labels, found by an equi-join on the label, and the negative pass skips the
  shards of the anchors' own label. A label with a third of all rows is many shards; equal rows are told
  apart by their place, so they spread too.
* A shard travels once and is followed by the blocks of anchors it has to meet. A task holds one shard and
  one block.
* Anchors are a stated set and every anchor must meet the candidates: the work is anchors times candidates,
  less what the threshold saves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from cadastra.llm.impact_search import quantised
from cadastra.llm.words import arrow_schema, rows_of
from cadastra.operators.windows import row_numbers
from cadastra.sources.staging import stage

SCALE = 256
SHARD = 4096
ANCHOR_BLOCK = 256
#: Entries read of every list before the first look at the threshold; doubled after each look.
FIRST_DEPTH = 8
MOST_TASKS = 20_000
_LONG = (-(2**63), 2**63 - 1)
_BLOCK = "block long, ids binary, labels binary, lengths binary, components binary"
_Window = tuple[int, int, int]  # least score, largest score, number wanted


class SortedLists:
    """Candidates of one shard with a sorted list per dimension.

    Vectors of different lengths are filled up with zeros, so that only common components count.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels = ids, labels
        self.largest = int(max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0)))))
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, self.order, axis=0)
        #: Candidates scored, and candidates there were, over all scans.
        self.accesses = self.offered = 0

    def _exactly(self, anchor: np.ndarray) -> np.dtype:
        """Type in which sums of products cannot overflow: floats while they are exact, Python integers beyond."""
        bound = self.largest * int(np.abs(anchor.astype(object)).max(initial=0)) * max(len(anchor), 1)
        return np.dtype(np.float64 if bound < 2**53 else object)

    def scan(self, anchor: np.ndarray, eligible: np.ndarray, windows: Sequence[_Window]) -> list[list[tuple[int, int]]]:
        """For each window its best ``(score, position)`` among eligible candidates, best first, ties to smaller ids."""
        width = min(len(anchor), self.rows.shape[1])
        anchor, kind = anchor[:width], self._exactly(anchor)
        left = int(eligible.sum())
        self.offered += left
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        signed = np.concatenate([anchor[up], anchor[down]]).astype(kind)
        exact, rows = anchor.astype(kind), self.rows[:, :width]
        unseen = eligible.copy()
        positions, scores = np.empty(0, np.int64), np.empty(0, kind)
        size, read, depth = len(self.ids), 0, FIRST_DEPTH
        while left:
            upto = min(size, read + depth) if len(signed) else size
            met = np.zeros(size, bool)
            met[self.order[size - upto:size - read, up]] = True
            met[self.order[read:upto, down]] = True
            if not len(signed):  # a zero vector has no lists, every candidate scores 0
                met[:] = True
            new = np.flatnonzero(met & unseen)
            unseen[new] = False
            left -= len(new)
            self.accesses += len(new)
            positions = np.concatenate([positions, new])
            scores = np.concatenate([scores, _cut(rows[new].astype(kind) @ exact)])
            read, depth = upto, 2 * depth
            if left:
                last = np.concatenate([self.values[size - upto, up], self.values[upto - 1, down]]).astype(kind)
                threshold = _cut(np.array([signed @ last], kind))[0]
                if all(_closed(scores, window, threshold) for window in windows):
                    break
        return [self._best(positions, scores, window) for window in windows]

    def _best(self, positions: np.ndarray, scores: np.ndarray, window: _Window) -> list[tuple[int, int]]:
        low, high, k = window
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        if len(inside) > k:
            kth = np.sort(scores[inside])[len(inside) - k]
            inside = inside[scores[inside] >= kth]
        found = [(int(scores[i]), int(positions[i])) for i in inside.tolist()]
        return sorted(found, key=lambda x: (-x[0], int(self.ids[x[1]])))[:k]


def _cut(scores: np.ndarray) -> np.ndarray:
    """Scores cut to 64 bits; those in floats are smaller anyway."""
    return scores if scores.dtype != object else np.array([min(max(s, _LONG[0]), _LONG[1]) for s in scores.tolist()], object)


def _closed(scores: np.ndarray, window: _Window, threshold) -> bool:
    """Whether no unseen candidate can be among the best of a window."""
    low, high, k = window
    if threshold < low or low > high:
        return True
    inside = scores[(scores >= low) & (scores <= high)]
    return len(inside) >= k and bool(threshold < np.sort(inside)[len(inside) - k])


def _packed(size: int):
    """(id, label, components) rows, sorted by label, to blocks of ``size`` with a number and their labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = arrow_schema(_BLOCK)
        schema = pa.schema([*base, ("of_labels", pa.list_(pa.int64()))])
        number, held, count = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(held).combine_chunks()
            vectors = table.column(2).combine_chunks()
            labels = table.column(1).to_numpy()
            parts = [table.column(0).to_numpy(), labels, vectors.value_lengths().to_numpy().astype(np.int32), vectors.flatten().to_numpy()]
            number += 1
            values = [number - 1, *(np.ascontiguousarray(p).tobytes() for p in parts)]
            columns = {n: [v] for n, v in zip(base.names, values)}
            return rows_of(schema, columns | {"of_labels": [np.unique(labels).tolist()]})

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - count)
                held.append(part)
                count, at = count + part.num_rows, at + part.num_rows
                if count == size:
                    yield block()
                    held, count = [], 0
        if held:
            yield block()

    return run


def _unpacked(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[prefix + name], np.int64) for name in ("ids", "labels"))
    lengths, flat = np.frombuffer(row[prefix + "lengths"], np.int32), np.frombuffer(row[prefix + "components"], np.int64)
    rows = np.zeros((len(ids), int(lengths.max(initial=0))), np.int64)
    rows[np.arange(rows.shape[1])[None, :] < lengths[:, None]] = flat
    return ids, labels, rows


def _blocks(rows: DataFrame, size: int, label: str) -> tuple[DataFrame, int]:
    """The rows in numbered blocks of at most ``size``, those of one label together, written down; and about how many."""
    count = max(1, -(-rows.count() // size))
    order = ["label", "__hash", "__place"]
    # The place tells equal rows apart, so that many of them do not meet in one task.
    dealt = rows.withColumn("__hash", F.xxhash64("vec_id", "v")).withColumn("__place", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(count, *order).sortWithinPartitions(*order).select("vec_id", "label", "v")
    schema = f"{_BLOCK.replace('long', 'bigint')}, of_labels array<bigint>"
    return stage(dealt.mapInArrow(_packed(size), schema), label), count


def taking_part(vectors: DataFrame, id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v`` of the rows with an id, a label and a vector of finite components; ``v`` in integers."""
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), quantised(F.col(vector), scale).alias("v"))
    return rows.where("vec_id is not null AND label is not null AND v is not null")


def _met(shards: DataFrame, pairs: DataFrame, blocks: DataFrame, tasks: int, search, schema: str) -> DataFrame:
    """Every shard, once, followed by its blocks of anchors."""
    wanted = pairs.join(blocks, "block")
    shard_rows = shards.select("shard", F.lit(-1).cast("long").alias("block"), *[F.col(c) for c in ("ids", "labels", "lengths", "components")])
    anchors = wanted.select("shard", "block", "ids", "labels", "lengths", "components", "windows")
    both = anchors.unionByName(shard_rows, allowMissingColumns=True)
    dealt = both.repartition(tasks, "shard").sortWithinPartitions("shard", "block")
    return dealt.mapInArrow(search, schema)


_POSITIVE = "block long, at int, vec_id long, score long"
_NEGATIVE = "block long, at int, positive int, vec_id long, score long"


def _streamed(visit, names: str):
    """Calls ``visit(lists, row, ids, labels, anchors)`` for each block of anchors with its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, shard, lists = arrow_schema(names), None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] < 0:
                    shard, lists = row["shard"], SortedLists(*_unpacked(row))
                elif row["shard"] == shard:
                    found = list(visit(lists, row, *_unpacked(row)))
                    if found:
                        yield rows_of(schema, dict(zip(schema.names, zip(*found))))

    return run


def _find_positives(k: int):
    def visit(lists: SortedLists, row: dict, ids, labels, anchors):
        for at in range(len(ids)):
            eligible = (lists.labels == labels[at]) & (lists.ids != ids[at])
            for score, place in lists.scan(anchors[at], eligible, [(*_LONG, k)])[0]:
                yield row["block"], at, int(lists.ids[place]), score

    return visit


def _find_negatives(k: int, low: int, high: int):
    def visit(lists: SortedLists, row: dict, ids, labels, anchors):
        by_anchor: dict[int, list] = {}
        for window in row["windows"]:
            by_anchor.setdefault(window["at"], []).append(window)
        for at, own in by_anchor.items():
            windows = [(-(-low * w["score"] // 100), high * w["score"] // 100, k) for w in own]
            eligible = (lists.labels != labels[at]) & (lists.ids != ids[at])
            for window, found in zip(own, lists.scan(anchors[at], eligible, windows)):
                for score, place in found:
                    yield row["block"], at, window["positive"], int(lists.ids[place]), score

    return visit


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    shard: int = SHARD, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` and ``anchors`` are in the form of :func:`taking_part`. Scores are integer inner products with
    the anchor, higher first, ties by smaller id. For each of an anchor's ``positives`` best other rows of its
    label, all if there are fewer, the ``negatives`` best rows of other labels with ``low * positive_score <=
    100 * negative_score <= high * positive_score``. A row with the id of the anchor is neither. Repeated rows
    count each for itself as candidates, equal anchors once; different anchors under one id are mined each for
    itself. Scores beyond 64 bits are cut to them. Without anchors, positives or negatives there is no row.
    """
    index, tasks = _blocks(rows, shard, "lists")
    shards = index.withColumnRenamed("block", "shard")
    blocks, _ = _blocks(anchors.distinct(), anchor_block, "anchors")
    tasks = min(tasks, MOST_TASKS)

    # Positives: a shard meets the blocks that share a label with it.
    of_shard = shards.select("shard", F.explode("of_labels").alias("label"))
    of_block = blocks.select("block", F.explode("of_labels").alias("label"))
    pairs = of_shard.join(of_block, "label").select("shard", "block").distinct()
    plain = blocks.withColumn("windows", F.lit(None).cast("array<struct<at:int,positive:int,score:bigint>>"))
    found = _met(shards, pairs, plain, tasks, _streamed(_find_positives(positives), _POSITIVE), _POSITIVE.replace("long", "bigint"))
    best = stage(_ranked(found, ["block", "at"], positives), "positives")

    # Negatives: every shard meets every block, unless both hold only one and the same label.
    window = F.struct("at", F.col("rank").alias("positive"), "score")
    windows = best.groupBy("block").agg(F.collect_list(window).alias("windows"))  # at most positives * anchor_block
    windowed = stage(blocks.join(windows, "block"), "windows")
    numbered = row_numbers(shards.select("shard", "of_labels"), "shard", "number")
    everywhere = windowed.select("block", F.col("of_labels").alias("wanted"), F.explode(F.sequence(F.lit(1), F.lit(max(numbered.count(), 1)))).alias("n"))
    meeting = everywhere.join(numbered, F.col("n") == F.col("number")).where((F.size("wanted") > 1) | (F.col("wanted") != F.col("of_labels")))
    search = _streamed(_find_negatives(negatives, low, high), _NEGATIVE)
    found = _met(shards, meeting.select("shard", "block"), windowed, tasks, search, _NEGATIVE.replace("long", "bigint"))
    hard = _ranked(found, ["block", "at", "positive"], negatives)

    named = blocks.select("block", "ids").mapInArrow(_anchor_ids, "block bigint, at int, anchor_id bigint")
    known = best.join(named, ["block", "at"]).select(
        "block", "at", F.col("rank").alias("positive"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return hard.join(known, ["block", "at", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _anchor_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("block long, at int, anchor_id long")
    for batch in batches:
        for block, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.frombuffer(ids, np.int64)
            yield rows_of(schema, {"block": [block] * len(ids), "at": np.arange(len(ids), dtype=np.int32), "anchor_id": ids})
