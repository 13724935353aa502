"""Near duplicates by SimHash fingerprints within a Hamming radius, found by covering locality-sensitive hashing.

A text's fingerprint has a bit set where over half of its shingle hashes have it. Texts link when their
fingerprints differ in at most ``radius`` bits. Equal fingerprints are one node, so copies cost nothing
after the first step.

Covering masks
--------------
Every bit position is given a nonzero vector of ``radius + 1`` bits. Table ``v``, for every nonzero ``v``,
files a fingerprint under those of its bits whose vector has an odd product with ``v``. The vectors of at
most ``radius`` differing positions leave at least one ``v`` even with all of them, and in its table the two
fingerprints are filed alike. So every linked pair meets in one of ``2**(radius + 1) - 1`` tables: with
radius 3, 15 tables that compare 32 to 36 of 64 bits each. Nothing is left to chance, and there is no
candidate outside these tables.

Scale and skew
--------------
* Buckets are counted by an ordinary aggregate first; what is alone in its bucket goes no further.
* A bucket over ``bucket`` fingerprints is filed a second time, by covering masks on the bits that its own
  mask leaves open. Its pairs differ in these bits only, so none is lost, and at most 16 bits remain: a
  bucket of the second filing holds at most 65,536 different fingerprints, whatever the corpus is.
* A bucket is searched for its connected parts, in a task of its own size; it gives one link per member
  and not all pairs.
* Documents meet their component by a join on the fingerprint that Spark can split where one fingerprint is
  a third of all rows; both sides are written first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cadastra.llm.combination_join import normal_words
from cadastra.llm.components import connected_components
from cadastra.llm.words import arrow_schema, rows_of, text_bytes
from cadastra.sources.staging import stage

BITS = 64
SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
#: Larger buckets are filed a second time.
BUCKET = 1024
_PART = 1 << 16


def fingerprint(text: bytes, n: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text; 0 without words. Repeated shingles count each time."""
    words = normal_words(text)
    count = max(len(words) - n + 1, 1 if words else 0)
    set_bits = np.zeros(BITS, np.int64)
    for begin in range(0, count, _PART):  # long texts in parts, so that their bits do not stand in memory at once
        upto = min(begin + _PART, count)
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), SEED) for i in range(begin, upto)]
        bytes_ = np.array(hashes, "<u8").view(np.uint8).reshape(-1, BITS // 8)
        set_bits += np.unpackbits(bytes_, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > count, bitorder="little").view("<u8")[0])


def covering_masks(positions: Sequence[int], radius: int = RADIUS) -> list[int]:
    """Masks over the given bit positions: any ``radius`` positions are outside at least one of them."""
    vectors = range(1, 1 << (radius + 1))
    dealt = [(position, vectors[i % len(vectors)]) for i, position in enumerate(positions)]
    return [sum(1 << position for position, vector in dealt if (vector & v).bit_count() % 2) for v in vectors]


def _open_positions(mask: int) -> list[int]:
    return [p for p in range(BITS) if not mask >> p & 1]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _filed(masks: Sequence[int], names: tuple[str, str]) -> Column:
    """Array with the fingerprint's table numbers and kept bits."""
    kept = (F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long")) for mask in masks)
    return F.array(*[F.struct(F.lit(i).alias(names[0]), value.alias(names[1])) for i, value in enumerate(kept)])


def connected_parts(values: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Positions ``(first, other)`` of different values: the first of a connected part, and every other one of it.

    Every value is compared once with those not reached yet, so memory is a few arrays of their number.
    """
    waiting = np.arange(len(values))
    while len(waiting) > 1:
        first, waiting = int(waiting[0]), waiting[1:]
        front = [first]
        while front and len(waiting):
            near = np.bitwise_count(values[waiting] ^ values[front.pop()]) <= radius
            if near.any():
                reached = waiting[near].tolist()
                waiting = waiting[~near]
                front += reached
                yield from ((first, other) for other in reached)


def _bucket_links(keys: int, radius: int):
    """Links inside buckets; rows are sorted by the first ``keys`` columns, the last one is the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("a long, b long")
        now, members = None, []

        def close() -> Iterator[pa.RecordBatch]:
            values = np.array(members, np.int64)
            links = np.array(list(connected_parts(values.view(np.uint64), radius)), np.int64).reshape(-1, 2)
            if len(links):
                yield rows_of(schema, {"a": values[links[:, 0]], "b": values[links[:, 1]]})

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(keys + 1)]
            for *key, value in zip(*columns):
                if key != now:
                    yield from close()
                    now, members = key, []
                members.append(value)
        yield from close()

    return run


def _links_of(filed: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Links of all buckets; at most about the size of a bucket stands in a task's memory."""
    dealt = filed.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_bucket_links(len(keys), radius), "a bigint, b bigint")


def _with_counts(filed: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Rows of buckets that hold more than one, with their number ``n``."""
    counts = filed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return stage(filed.join(counts.select(*[F.col(k).alias(f"__{k}") for k in keys], "n"), [F.col(k) == F.col(f"__{k}") for k in keys])
                 .select(*keys, "fp", "n"), label)


def fingerprint_links(fingerprints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links whose connected components are those of all pairs within ``radius`` bits.

    ``fingerprints`` has distinct values in ``fp``. A link joins two members of one component; they need
    not be within the radius themselves.
    """
    masks = covering_masks(range(BITS), radius)
    filed = fingerprints.select("fp", F.explode(_filed(masks, ("masked", "bits"))).alias("f")).select("f.*", "fp")
    first = _with_counts(filed, ["masked", "bits"], "buckets")
    links = _links_of(first.where(F.col("n") <= bucket), ["masked", "bits"], radius)

    # The large ones once more, by masks on the bits that the first mask has left open.
    again = [_filed(covering_masks(_open_positions(mask), radius), ("masked2", "bits2")) for mask in masks]
    choice = F.element_at(F.array(*again), F.col("masked") + 1)
    finer = first.where(F.col("n") > bucket).select("masked", "bits", "fp", F.explode(choice).alias("f"))
    keys = ["masked", "bits", "masked2", "bits2"]
    second = _with_counts(finer.select("masked", "bits", "f.*", "fp"), keys, "buckets")
    return links.unionAll(_links_of(second, keys, radius)).distinct()


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("doc_id long, fp long")
        for batch in batches:
            values = [_signed(fingerprint(text, n)) for text in text_bytes(batch.column(1))]
            yield rows_of(schema, {"doc_id": batch.column(0), "fp": values})

    return run


def near_duplicates(
    documents: DataFrame, id: str = "doc_id", text: str = "text", n: int = SHINGLE_WORDS, radius: int = RADIUS, bucket: int = BUCKET,
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable by links, itself included.

    Words are runs of characters other than ASCII white space, A to Z in lower case; shingles are ``n``
    words, the whole sequence if it is shorter. Texts without words, null included, have the fingerprint 0
    and link like any other. Every row is a document of its own: repeated rows are copies of each other, and
    rows of one id with different texts are linked by their texts only. A row with a null id links others;
    its component is theirs, null if all ids in it are null. Other columns are not carried.
    """
    texts = documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stage(texts.mapInArrow(_fingerprints(n), "doc_id bigint, fp bigint"), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "fingerprints")
    parts = connected_components(fingerprint_links(nodes.select("fp"), radius, bucket)).toDF("__node", "component")
    placed = stage(nodes.join(parts, F.col("fp") == F.col("__node"), "left").select("fp", "smallest", F.coalesce("component", "fp").alias("component")), "fingerprints")
    lowest = placed.groupBy(F.col("component").alias("__component")).agg(F.min("smallest").alias("component_id"))
    named = placed.join(lowest, F.col("component") == F.col("__component")).select(F.col("fp").alias("__fp"), "component_id")
    # Written, so that the join below has exchanges of its own, which Spark can split at a hot fingerprint.
    named = stage(named, "fingerprints")
    joined = rows.join(named, F.col("fp") == F.col("__fp"))
    return joined.select(F.col("doc_id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
