"""Best-fit packing of texts into sequences of several permitted lengths.

A text longer than the longest sequence is cut into full sequences and a rest. Pieces are placed in
decreasing length, each into the open sequence it fills best. If none has room, a new one is opened
with the length that costs least per word placed, judged by filling each permitted length with the
pieces still to come. At the end every sequence shrinks to the shortest permitted length that holds
its contents.

Rows of (id, size) are dealt to groups of about ``group`` pieces, whatever files and partitions they come
from; a group fills all but its last few sequences, so larger groups gain next to nothing, small ones would
lose (filled share with groups of 20,000, 200 and 20 pieces: 1.000, 0.997, 0.970). The number of groups is
counted from the data, and the dealt rows are written down, so a repeated task packs the same rows. Within
a group, pieces of equal length are handled together: the work grows with distinct lengths and opened
sequences, not with their product.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cadastra.llm.words import arrow_schema, n_words, rows_of
from cadastra.sources.staging import stage

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its length, in words: what makes few long sequences better than many short ones.
OVERHEAD = 32
GROUP = 20_000
MOST_TASKS = 20_000


class _Remaining:
    """Lengths still to be placed, with their counts."""

    def __init__(self, lengths: Sequence[int]):
        self.count: dict[int, int] = {}
        for length in lengths:
            self.count[length] = self.count.get(length, 0) + 1
        self.distinct = sorted(self.count)

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.count[length]
            self.distinct.pop(bisect_left(self.distinct, length))

    def filled(self, room: int) -> int:
        """Words that go into ``room`` when the longest piece that fits is taken again and again."""
        used, at = 0, bisect_right(self.distinct, room)
        while at and room >= self.distinct[0]:
            length = self.distinct[at - 1]
            times = min(self.count[length], room // length)
            used, room = used + times * length, room - times * length
            at = min(at - 1, bisect_right(self.distinct, room))
        return used


def best_fit(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD) -> tuple[list[int], list[int]]:
    """Sequence number of each length (all in 1..max(capacities)), and the final capacity of each sequence."""
    sizes = sorted(capacities)
    remaining = _Remaining(lengths)
    place, room, used = [0] * len(lengths), [], []
    open_bins: list[tuple[int, int]] = []  # (room, sequence), by room
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[i]
        remaining.take(length)
        at = bisect_left(open_bins, (length, -1))
        if at < len(open_bins):
            _, number = open_bins.pop(at)
        else:
            number = len(room)
            room.append(_least_cost(length, remaining, sizes, overhead))
            used.append(0)
        place[i] = number
        room[number] -= length
        used[number] += length
        if room[number]:
            insort(open_bins, (room[number], number))
    return place, [sizes[bisect_left(sizes, words)] for words in used]


def _least_cost(length: int, remaining: _Remaining, sizes: list[int], overhead: int) -> int:
    """Capacity with the least cost per word, the shorter one of equals.

    The cost is that of the length the sequence would shrink to.
    """
    best, choice = None, 0
    for size in sizes[bisect_left(sizes, length):]:
        words = length + remaining.filled(size - length)
        cost = (sizes[bisect_left(sizes, words)] + overhead) / words
        if best is None or cost < best:
            best, choice = cost, size
    return choice


_PLACED = "id long, piece int, start long, length long, bin_id long, capacity int, bin_offset int"


def _packer(capacities: Sequence[int], overhead: int, group: int):
    """Packs (id, size, group) rows, one group after another; a group over twice its size is packed in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, longest = arrow_schema(_PLACED), max(capacities)
        # Sequence numbers are unique because each task has its own range.
        following = TaskContext.get().partitionId() << 40
        pieces: list[tuple] = []
        now = None

        def pack() -> pa.RecordBatch:
            nonlocal following, pieces
            real = [p for p in pieces if p[3]]
            place, capacity = best_fit([p[3] for p in real], capacities, overhead)
            offset = [0] * len(capacity)
            out = [p + (None, None, None) for p in pieces if not p[3]]
            for piece, number in zip(real, place):
                out.append(piece + (following + number, capacity[number], offset[number]))
                offset[number] += piece[3]
            following += len(capacity)
            pieces = []
            return rows_of(schema, dict(zip(schema.names, zip(*out))))

        for batch in batches:
            for doc, size, place in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if place != now and pieces:
                    yield pack()
                now = place
                for number, start in enumerate(range(0, max(size, 1), longest)):
                    pieces.append((doc, number, start, min(longest, size - start)))
                    if len(pieces) == 2 * group:
                        yield pack()
        if pieces:
            yield pack()

    return run


def pack_documents(
    documents: DataFrame, id: str = "doc_id", text: str = "text", capacities: Sequence[int] = CAPACITIES,
    overhead: int = OVERHEAD, group: int = GROUP,
) -> DataFrame:
    """One row per piece: id, ``piece`` (from 0), ``start`` and ``length`` in words of the text,
    ``bin_id``, the ``capacity`` of that sequence and ``bin_offset``, the place of the piece in it.

    A text without words, null included, gives one row of length 0 without a sequence. Repeated rows
    are packed each for itself, null ids too; other columns are not carried. Sequence numbers are
    unique, not consecutive.
    """
    if not capacities or min(capacities) < 1:
        raise ValueError("capacities must be positive")
    sizes = documents.select(F.col(id).cast("long").alias("id"), n_words(text).alias("size"))
    # The place tells equal rows apart, so that they are dealt to all groups.
    sizes = stage(sizes.withColumn("place", F.xxhash64("id", F.monotonically_increasing_id())), "sizes")
    pieces = sizes.agg(F.sum(F.greatest(F.ceil(F.col("size") / max(capacities)), F.lit(1)))).first()[0] or 0
    groups = max(1, -(-pieces // group))
    dealt = sizes.select("id", "size", F.pmod("place", F.lit(groups)).cast("int").alias("group"), "place")
    dealt = dealt.repartition(min(groups, MOST_TASKS), "group").sortWithinPartitions("group", "place").drop("place")
    placed = dealt.mapInArrow(_packer(tuple(capacities), overhead, group), _PLACED.replace("long", "bigint"))
    return placed.withColumnRenamed("id", id)
