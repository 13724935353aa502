"""Removal of word windows that occur more than once anywhere in a corpus.

Every window of ``size`` words is filed under its minimiser, the smallest hash among its runs of
``anchor`` words. Equal windows have equal minimisers. Consecutive windows of a text that share the
minimiser travel to its bucket as one packed string, about three times the text in all instead of
``size`` times. In the bucket the windows are sorted and neighbours compared word for word.

Scale and skew
--------------
* A task packs identical strings of its chunk once. A string seen twice in a chunk is known to be
  repeated: its places are marked at once, and one copy without places travels on. So a passage
  held by a third of all texts sends one string per chunk to its bucket.
* Strings of one chunk and bucket are compressed together, about 1 MB to a packet, so a bucket grows in small steps.
* Places are columns of numbers, and a bucket's strings are cut into words a piece at a time: a bucket just under
  ``bucket_bytes`` takes about 200 MB, not 570.
* The number of buckets follows from the bytes of all texts, so that an even bucket holds a third of
  ``bucket_bytes`` at any size of the corpus. A bucket is read as a stream of such packets. Only if its strings
  outgrow ``bucket_bytes`` all the same (one minimiser in very many contexts), its windows are handed on one by
  one and counted by an ordinary aggregate on the whole window, which spreads over all tasks. The result is the same.
* The marks are written down before they meet the texts again, so a lost executor repeats one step.

Rows are told apart by id and a hash of the text: repeated rows and null ids are ordinary rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from cadastra.llm.words import WordHashes, arrow_schema, rows_of, text_bytes, window_hashes
from cadastra.sources.staging import stage

CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 48 << 20
PLACE_BYTES = 130
#: A packet holds no more text than this and one string; a bucket's strings are cut into words by such pieces.
PACKET_BYTES = 1 << 20
PIECE_BYTES = 1 << 20
#: Packed strings and their bookkeeping take about so many times the text.
_STRINGS_PER_TEXT = 6
_PACKETS = (
    "bucket int, strings binary, doc_id array<bigint>, fingerprint array<bigint>, at array<int>, upto array<int>"
)
_MARKS = "doc_id long, fingerprint long, first int, last int, window binary, copies int"
#: Place of a string that was seen twice in its chunk.
_NOWHERE = -1


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    count, block, reach = len(values) - width + 1, values, 1
    while reach * 2 <= width:
        block = np.minimum(block[:-reach], block[reach:])
        reach *= 2
    return np.minimum(block[:count], block[width - reach:width - reach + count])


def super_windows(words: list[bytes], hashes: WordHashes, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser: first window, end (exclusive) and minimiser of each."""
    if len(words) < size:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64)
    smallest = sliding_min(window_hashes(hashes.of(words), anchor), size - anchor + 1)
    first = np.concatenate([[0], np.flatnonzero(smallest[1:] != smallest[:-1]) + 1])
    return first, np.append(first[1:], len(smallest)), smallest[first]


class _Chunk:
    """Distinct packed strings of some texts with their places, which are kept as columns of numbers."""

    def __init__(self, size: int, buckets: int):
        self.size, self.buckets, self.bytes = size, buckets, 0
        self.index: dict[bytes, int] = {}
        self.bucket = array("q")
        self.rows: list[tuple] = []
        self.string, self.row, self.at, self.upto = (array("i") for _ in range(4))

    def add(self, row: tuple, words: list[bytes], runs) -> None:
        if not len(runs[0]):
            return
        for first, end, smallest in zip(*(r.tolist() for r in runs)):
            packed = b" ".join(words[first:end + self.size - 1])
            known = self.index.setdefault(packed, len(self.index))
            if known == len(self.bucket):
                self.bucket.append(smallest % self.buckets)
                self.bytes += len(packed)
            else:
                self.bytes += PLACE_BYTES  # a partition of copies has few strings and many places
            self.string.append(known)
            self.row.append(len(self.rows))
            self.at.append(first)
            self.upto.append(end - 1)
        self.rows.append(row)

    def packets(self, schema: pa.Schema, compressor) -> Iterator[pa.RecordBatch]:
        strings, of = list(self.index), np.array(self.string)
        bucket = np.array(self.bucket)
        often = np.bincount(of, minlength=len(strings)) > 1
        place = np.empty(len(strings), np.int64)
        place[of] = np.arange(len(of))  # the only place of a string seen once
        order = np.argsort(bucket, kind="stable")
        marks = np.flatnonzero(often[of])
        numbers, packed, ends = [], [], []
        start = filled = 0
        for i, k in enumerate(order.tolist()):
            filled += len(strings[k])
            if i + 1 == len(order) or filled >= PACKET_BYTES or bucket[k] != bucket[order[i + 1]]:
                numbers.append(int(bucket[k]))
                packed.append(compressor.compress(b"\n".join([strings[s] for s in order[start:i + 1].tolist()])))
                ends.append(i + 1)
                start, filled = i + 1, 0
        for i in range(0, len(marks), 4096):
            numbers.append(i // 4096 % self.buckets)
            packed.append(None)
            ends.append(len(order) + min(i + 4096, len(marks)))
        # Of a repeated string one copy without a place travels on.
        at = np.concatenate([place[order], marks])
        nowhere = np.concatenate([often[order], np.zeros(len(marks), bool)])
        row = pa.array(np.array(self.row)[at], mask=nowhere)
        ids, prints = (pa.array(column, pa.int64()).take(row) for column in zip(*self.rows))
        first, last = (pa.array(np.where(nowhere, _NOWHERE, np.array(x)[at]), pa.int32()) for x in (self.at, self.upto))
        offsets = pa.array([0] + ends, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, x) for x in (ids, prints.fill_null(0), first, last)]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packed, pa.binary()), *lists], schema=schema)


def _pack(size: int, anchor: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, hashes = _packet_schema(), WordHashes()
        compressor = zstandard.ZstdCompressor(level=3)
        chunk = _Chunk(size, buckets)
        for batch in batches:
            ids, prints = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, text in zip(zip(ids, prints), text_bytes(batch.column(2))):
                words = text.split()
                chunk.add(row, words, super_windows(words, hashes, size, anchor))
                if chunk.bytes >= 3 * CHUNK_BYTES:
                    yield from chunk.packets(schema, compressor)
                    chunk = _Chunk(size, buckets)
        if chunk.index:
            yield from chunk.packets(schema, compressor)

    return run


def _packet_schema() -> pa.Schema:
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    return pa.schema([
        ("bucket", pa.int32()), ("strings", pa.binary()), ("doc_id", longs), ("fingerprint", longs), ("at", ints), ("upto", ints),
    ])


def _windows(strings: list[bytes], first: int, end: int, size: int, hashes: WordHashes) -> list[np.ndarray]:
    """All windows of ``strings[first:end]``: number of the string, place in it, first byte, end and hash."""
    words = b" ".join(strings[first:end]).split(b" ")
    lengths = np.array([s.count(b" ") + 1 for s in strings[first:end]])
    starts = np.cumsum(lengths) - lengths
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1  # byte behind each word
    begins = np.concatenate([[0], ends[:-1] + 1])
    counts = np.maximum(lengths - size + 1, 0)
    owner = np.repeat(np.arange(len(lengths)), counts)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    place, origin = at + starts[owner], begins[starts[owner]]
    low, high = begins[place] - origin, ends[place + size - 1] - origin
    values = window_hashes(hashes.of(words), size)
    return [*(x.astype(np.int32) for x in (owner + first, at, low, high)), values[place]]


def _pieces(strings: list[bytes]) -> Iterator[tuple[int, int]]:
    first, filled = 0, 0
    for i, string in enumerate(strings, 1):
        filled += len(string)
        if filled >= PIECE_BYTES or i == len(strings):
            yield first, i
            first, filled = i, 0


def repeated_windows(strings: list[bytes], size: int, hashes: WordHashes) -> list[list[tuple[int, int]]]:
    """For each of some distinct strings the runs (first, last) of windows that occur twice among them.

    Windows are sorted by hash; neighbours of equal hash are compared as bytes, so a collision of
    hashes cannot make two windows equal. Strings are cut into words a piece at a time, since words
    take ten times the memory of their text.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in strings]
    if not strings:
        return found
    parts = [_windows(strings, a, b, size, hashes) for a, b in _pieces(strings)]
    owner, at, low, high, values = (np.concatenate(column) for column in zip(*parts))
    del parts
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    del values
    twice = np.zeros(len(owner), bool)
    equal = np.flatnonzero(ordered[1:] == ordered[:-1])
    collided: set[int] = set()
    for start in range(0, len(equal), 1 << 14):
        here = equal[start:start + (1 << 14)]
        left, right = ([x[order[k]].tolist() for x in (owner, low, high)] for k in (here, here + 1))
        for i, o, a, b, p, c, d in zip(here.tolist(), *left, *right):
            if strings[o][a:b] == strings[p][c:d]:
                twice[i] = twice[i + 1] = True
            else:
                collided.add(int(ordered[i]))
    for value in collided:
        groups: dict[bytes, list[int]] = {}
        for i in np.flatnonzero(ordered == np.uint64(value)).tolist():
            k = order[i]
            groups.setdefault(strings[owner[k]][low[k]:high[k]], []).append(i)
        for members in groups.values():
            twice[members] = len(members) > 1
    hit = np.sort(order[twice])  # positions in owner/at, which run string by string
    if len(hit):
        breaks = np.flatnonzero((np.diff(hit) != 1) | (np.diff(owner[hit]) != 0)) + 1
        firsts, lasts = hit[np.concatenate([[0], breaks])], hit[np.append(breaks, len(hit)) - 1]
        for o, a, b in zip(owner[firsts].tolist(), at[firsts].tolist(), at[lasts].tolist()):
            found[o].append((a, b))
    return found


class _Bucket:
    """Strings of one bucket and their places; hands its windows on one by one when it grows too large."""

    def __init__(self, size: int, limit: int, hashes: WordHashes):
        self.size, self.limit, self.hashes = size, limit, hashes
        self.open = True
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.repeated, self.bytes = bytearray(), 0
        self.owner, self.doc_id, self.print, self.at = array("i"), [], array("q"), array("i")

    def add(self, strings: list[bytes], places: Iterable[tuple]) -> Iterator[tuple]:
        for string, (doc_id, print_, at) in zip(strings, places):
            known = self.index.setdefault(string, len(self.index))
            if known == len(self.repeated):
                self.repeated.append(0)
                self.bytes += len(string) + 200
            else:
                self.repeated[known] = 1
            if at == _NOWHERE:
                self.repeated[known] = 1
            else:
                self.owner.append(known)
                self.doc_id.append(doc_id)
                self.print.append(print_)
                self.at.append(at)
                self.bytes += 100
        if self.bytes > self.limit or not self.open:
            self.open = False
            yield from self._single_windows()

    def _places(self) -> Iterator[tuple[bytes, bool, list[tuple]]]:
        """Each string, whether it is repeated as a whole, and its places."""
        owner = np.array(self.owner)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(self.index) + 1))
        for string, repeated, a, b in zip(self.index, self.repeated, bounds[:-1], bounds[1:]):
            yield string, repeated, [(self.doc_id[k], self.print[k], self.at[k]) for k in order[a:b].tolist()]

    def _single_windows(self) -> Iterator[tuple]:
        for string, repeated, places in self._places():
            words = string.split(b" ")
            windows = [b" ".join(words[i:i + self.size]) for i in range(len(words) - self.size + 1)]
            for doc_id, print_, at in places:
                for i, window in enumerate(windows):
                    yield doc_id, print_, at + i, at + i, window, 1
            if repeated:  # it stands somewhere else as well, where it is marked already
                yield from ((None, None, _NOWHERE, _NOWHERE, window, 2) for window in windows)
        self._clear()

    def close(self) -> Iterator[tuple]:
        found = repeated_windows(list(self.index), self.size, self.hashes)
        for (string, repeated, places), runs in zip(self._places(), found):
            if repeated:
                runs = [(0, string.count(b" ") + 1 - self.size)]
            for doc_id, print_, at in places:
                for first, last in runs:
                    yield doc_id, print_, at + first, at + last, None, 0


def _packets_of(batch: pa.RecordBatch) -> Iterator[list]:
    """The rows of a batch one at a time: as Python numbers their places take many times the bytes."""
    columns = batch.columns
    for i in range(batch.num_rows):
        bucket, strings, *places = (column[i] for column in columns)
        values = (x.values for x in places)
        yield [bucket.as_py(), strings.as_py(), *(x.to_pylist() if x.null_count else x.to_numpy().tolist() for x in values)]


def _count(size: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, hashes = arrow_schema(_MARKS), WordHashes()
        unpack = zstandard.ZstdDecompressor()

        def marks() -> Iterator[tuple]:
            bucket, now = None, None
            for batch in batches:
                for number, strings, doc_id, print_, at, upto in _packets_of(batch):
                    if strings is None:
                        yield from (row + (None, 0) for row in zip(doc_id, print_, at, upto))
                        continue
                    if number != now:
                        if bucket:
                            yield from bucket.close()
                        bucket, now = _Bucket(size, limit, hashes), number
                    yield from bucket.add(unpack.decompress(strings).split(b"\n"), zip(doc_id, print_, at))
            if bucket:
                yield from bucket.close()

        out: list[tuple] = []
        for mark in marks():
            out.append(mark)
            if len(out) == 20_000:
                yield rows_of(schema, dict(zip(schema.names, zip(*out))))
                out = []
        if out:
            yield rows_of(schema, dict(zip(schema.names, zip(*out))))

    return run


def repeated_places(documents: DataFrame, id: str, text: str, size: int, anchor: int, bucket_bytes: int) -> DataFrame:
    """``doc_id, fingerprint, runs``: for each text its runs (first, last) of windows found elsewhere as well."""
    spark = documents.sparkSession
    total = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-3 * _STRINGS_PER_TEXT * total // bucket_bytes))
    texts = documents.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(text).alias("fingerprint"), text)
    packets = texts.mapInArrow(_pack(size, anchor, buckets), _PACKETS).repartition("bucket").sortWithinPartitions("bucket")
    marks = stage(packets.mapInArrow(_count(size, bucket_bytes), _MARKS.replace("long", "bigint")), "windows")
    known = marks.where("window is null").select("doc_id", "fingerprint", "first", "last")
    single = marks.where("window is not null")
    often = single.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    late = single.where(F.col("first") >= 0).join(often, "window").select(known.columns)
    # Distinct first: the rows of a repeated row share their key, and their runs are the same.
    return known.unionAll(late).distinct().groupBy("doc_id", "fingerprint").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")  # no more than the text has windows
    )


def _remove(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("doc_id long, n_words long, n_removed long, kept string")
        for batch in batches:
            ids, runs = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out: dict[str, list] = {name: [] for name in schema.names}
            for doc_id, text, marks in zip(ids, text_bytes(batch.column(1)), runs):
                words = text.split()
                gone = np.zeros(len(words), bool)
                for mark in marks or ():
                    gone[mark["first"]:mark["last"] + size] = True
                removed = int(gone.sum())
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if removed else words
                for name, value in zip(schema.names, (doc_id, len(words), removed, b" ".join(kept))):
                    out[name].append(value)
            out["kept"] = pa.array(out["kept"], pa.binary()).cast(pa.string())
            yield rows_of(schema, out)

    return run


def remove_repeated(
    documents: DataFrame, id: str = "doc_id", text: str = "text", size: int = 35, anchor: int = 6, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed`` and ``kept``, the words left, joined by one space.

    A word goes if it lies in a window of ``size`` words that starts at another place too, in the same
    or any other row. Repeated rows repeat each other's windows. Null and empty texts have no words,
    texts shorter than a window lose none. Other columns of the input are not carried.
    """
    if not 1 <= anchor <= size:
        raise ValueError("anchor must lie between 1 and size")
    places = repeated_places(documents, id, text, size, anchor, bucket_bytes).toDF("__id", "__print", "runs")
    texts = documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__print"))
    joined = texts.join(places, same, "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_remove(size), "doc_id bigint, n_words bigint, n_removed bigint, kept string").withColumnRenamed("doc_id", id)
