"""Window removal against a plain count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from cadastra.llm import super_windows
from cadastra.llm.words import WordHashes


def brute(rows, size):
    """The rows that :func:`super_windows.remove_repeated` must return, sorted."""
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    windows = Counter(tuple(w[k:k + size]) for _, w in texts for k in range(len(w) - size + 1))
    out = []
    for i, w in texts:
        gone = {p for k in range(len(w) - size + 1) if windows[tuple(w[k:k + size])] > 1 for p in range(k, k + size)}
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return sorted(out, key=str)


def made_texts(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("ab cd é  x \x85y long-word and the of".split(" "))
    passage = " ".join(word() + str(rng.randrange(40)) for _ in range(30))
    rows = [(1, None), (2, ""), (None, "only a few words"), (3, "x " * 500), (3, "x " * 500), (4, "\t\n ")]
    for i in range(5, 60):
        parts = [" ".join(word() + str(rng.randrange(60)) for _ in range(rng.randrange(25))), passage if i % 3 else ""]
        rng.shuffle(parts)
        rows.append((i, rng.choice([" ", "\n", " \x0b "]).join(parts)))
    return rows + [rows[10], (None, rows[11][1]), (None, rows[11][1]), (99, " ".join(str(i) for i in range(3000)))]


@pytest.mark.parametrize("bucket_bytes", [super_windows.BUCKET_BYTES, 300])
@pytest.mark.parametrize("size,anchor", [(8, 3), (1, 1), (5, 5)])
def test_equals_plain_count(spark, size, anchor, bucket_bytes):
    rows = made_texts(size)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = super_windows.remove_repeated(df, size=size, anchor=anchor, bucket_bytes=bucket_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, size)


def test_chunks_of_one_text_each(spark, monkeypatch):
    rows = made_texts(2)
    packer = super_windows._pack(6, 2, 5)
    monkeypatch.setattr(super_windows, "CHUNK_BYTES", 1)
    import pyarrow as pa

    ids, texts = [i for i, _ in rows], [t for _, t in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(range(len(rows)), pa.int64()), pa.array(texts)], ["i", "f", "t"])
    packets = [p for b in packer(iter([batch])) for p in b.to_pylist()]
    assert {p["bucket"] for p in packets} <= set(range(5)) and len(packets) > len(rows) / 2


def test_colliding_hashes_are_told_apart(monkeypatch):
    hashes = WordHashes()
    monkeypatch.setattr(super_windows, "window_hashes", lambda h, n: h[:max(0, len(h) - n + 1)] * 0)
    strings = [b"a b c d", b"b c d e", b"x y z", b"a b c q a b c"]
    got = super_windows.repeated_windows(strings, 3, hashes)
    assert got == [[(0, 1)], [(0, 0)], [], [(0, 0), (4, 4)]]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_words int")
    assert super_windows.remove_repeated(empty).collect() == []
    df = spark.createDataFrame([(1, "a b", 5, "z")], "doc_id long, text string, n_words int, kept string")
    assert [tuple(r) for r in super_windows.remove_repeated(df, size=2, anchor=1).collect()] == [(1, 2, 0, "a b")]
    assert hashlib.sha256(b"a b").hexdigest()


def packed_rows(rows, size, anchor, buckets):
    import pyarrow as pa

    columns = [pa.array([i for i, _ in rows], pa.int64()), pa.array(range(len(rows)), pa.int64()), pa.array([t for _, t in rows])]
    batch = pa.RecordBatch.from_arrays(columns, ["i", "f", "t"])
    return pa.Table.from_batches(super_windows._pack(size, anchor, buckets)(iter([batch]))).sort_by("bucket")


@pytest.mark.parametrize("chunk_bytes", [1, 8 << 20])
def test_small_packets_and_pieces_mark_the_same(monkeypatch, chunk_bytes):
    for name, n in (("CHUNK_BYTES", chunk_bytes), ("PACKET_BYTES", 1), ("PIECE_BYTES", 1)):
        monkeypatch.setattr(super_windows, name, n)
    rows, size = made_texts(4), 6
    marks = [m for b in super_windows._count(size, 48 << 20)(iter(packed_rows(rows, size, 2, 3).to_batches())) for m in b.to_pylist()]
    texts = [(t or "").encode().split() for _, t in rows]
    windows = Counter(tuple(w[k:k + size]) for w in texts for k in range(len(w) - size + 1))
    wanted = {(n, k) for n, w in enumerate(texts) for k in range(len(w) - size + 1) if windows[tuple(w[k:k + size])] > 1}
    assert {(m["fingerprint"], k) for m in marks for k in range(m["first"], m["last"] + 1)} == wanted
    assert all(m["doc_id"] == rows[m["fingerprint"]][0] for m in marks)


def test_packets_of_a_common_minimiser_are_bounded():
    rng = random.Random(5)
    context = lambda: " ".join(str(rng.randrange(10**9)) for _ in range(8))
    rows = [(i, f"{context()} the same words stand here {context()}") for i in range(20_000)]
    packets = packed_rows(rows, 20, 5, 1)
    assert packets.num_rows > 1  # one bucket
    assert max(len(p) for p in packets["at"].to_pylist()) * 170 < 2 * super_windows.PACKET_BYTES
    assert sum(len(p) for p in packets["at"].to_pylist()) >= len(rows)


def test_memory_of_a_bucket_just_under_its_limit():
    import tracemalloc

    import zstandard

    rng, limit, schema = random.Random(6), 8 << 20, super_windows._packet_schema()
    vocabulary = [b"w%d" % i for i in range(2000)]
    packer = zstandard.ZstdCompressor()

    def packet(n):
        strings = [b" ".join(rng.choices(vocabulary, k=60)) for _ in range(500)]
        values = (0, packer.compress(b"\n".join(strings)), list(range(n, n + 500)), list(range(500)), [3] * 500, [30] * 500)
        return super_windows.rows_of(schema, {name: [v] for name, v in zip(schema.names, values)})

    batches = [packet(500 * i) for i in range(limit // (650 * 500))]
    tracemalloc.start()
    try:
        assert not list(super_windows._count(35, limit)(iter(batches)))  # nothing repeats, and no window is handed on
        assert tracemalloc.get_traced_memory()[1] < 6 * limit
    finally:
        tracemalloc.stop()
