"""Quality scores on held-out labels and odd rows."""

from __future__ import annotations

import zlib

import pytest

from cadastra.llm import compression_quality as cq

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))


@pytest.fixture(scope="module")
def model(tables):
    return cq.fit(*tables)


def test_held_out_accuracy(tables, model):
    documents, labels = tables
    rows = cq.score_documents(documents, model).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    right = [r["predicted"] == r["quality"] for r in rows]
    assert sum(right) >= 0.9 * len(right)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_score_depends_on_the_text_only(spark, tables, model):
    documents, labels = tables
    some = documents.limit(60)
    other = some.selectExpr("doc_id + 7 AS doc_id", "text", "'xx' AS lang", "'yy' AS source", "0.1 AS score", "9 AS predicted")
    scores = lambda df: sorted(r["score"] for r in cq.score_documents(df, model).collect())
    assert scores(some) == scores(other.repartition(3))
    assert cq.fit(documents.repartition(4), labels.repartition(2)) == model


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (None, "x"), (3, "word " * 60_000), (3, "word " * 60_000), (4, "é" * 5), (5, "\n" * 9000)]
    got = cq.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    by = sorted((str(r["doc_id"]), r["score"]) for r in got)
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in by)
    assert by[0][1] == by[1][1]  # null and empty
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert cq.score_documents(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_few_or_odd_labels(spark):
    documents = spark.createDataFrame([(i, f"text number {i} " * 9) for i in range(12)] + [(1, None), (None, "n")], "doc_id long, text string")
    for votes in ([], [(1, 1), (3, 1)], [(i, i % 2) for i in range(12)] + [(1, 0), (None, 1), (2, 7), (500, 0), (4, None)]):
        labels = spark.createDataFrame(votes, "doc_id long, quality int")
        fitted = cq.fit(documents, labels)
        scores = [r["score"] for r in cq.score_documents(documents, fitted).collect()]
        assert len(scores) == 14 and all(0 <= s <= 1 for s in scores)
        if not votes:
            assert set(scores) == {0.5}


def test_pieces_come_from_whole_texts(spark):
    """A mark that stands only late in long texts reaches the dictionary; pieces are those a plain cut gives."""
    import xxhash

    rows = [(1, "é" * 700 + "x" * 5000 + "late" * 300), (2, ""), (3, None), (4, "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [bytes(p) for p in r["p"]] for r in frame.select("doc_id", cq.chosen_pieces("text", 3).alias("p")).collect()}
    for doc_id, text in rows:
        data = (text or "").encode()
        cut = [data[i:i + cq.SAMPLE_PIECE] for i in range(0, max(len(data), 1), cq.SAMPLE_PIECE)]
        signed = lambda p: (h := xxhash.xxh64_intdigest(p, 42)) - (h >> 63 << 64)
        assert got[doc_id] == sorted(cut, key=signed)[:3]
    documents = spark.createDataFrame([(i, f"{'plain words here ' * 400} {i} " + f"mark{i % 5}-{'zebra' * 250}" * 6) for i in range(80)], "doc_id long, text string")
    fitted = cq.fit(documents, spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int"), pieces=20)
    assert b"zebra" in fitted.good


def test_scores_equal_plain_compression(tables, model):
    """Every score, worked out text by text with the library of the format."""
    import math

    import zstandard

    documents, _ = tables
    settings = zstandard.ZstdCompressionParameters.from_level(cq.LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
    good, bad = (zstandard.ZstdCompressor(compression_params=settings, dict_data=zstandard.ZstdCompressionDict(d)) for d in (model.good, model.bad))
    scores = {r["doc_id"]: r["score"] for r in cq.score_documents(documents, model).collect()}
    for row in documents.select("doc_id", "text").collect():
        data = (row["text"] or "").encode()
        sizes = [sum(len(c.compress(data[i:i + cq.PIECE])) for i in range(0, len(data), cq.PIECE)) for c in (good, bad)]
        difference, size = (sizes[1] - sizes[0]) / (len(data) + cq.SMOOTHING), min(sizes[0] / (len(data) + cq.SMOOTHING), cq.SIZE_CEILING)
        x = model.weights[0] * (difference if data else 0) + model.weights[1] * (size if data else cq.SIZE_CEILING) + model.weights[2]
        assert abs(scores[row["doc_id"]] - 1 / (1 + math.exp(-max(-40, min(40, x))))) < 1e-12
