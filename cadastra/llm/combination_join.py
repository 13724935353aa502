"""Exact Jaccard join of texts by prefixes of single rare tokens and of pairs of frequent tokens.

A text's tokens are the hashes of its distinct word n-grams, rare ones first. If two sets are similar, few
tokens of either miss in the other, so they share tokens near the beginning of that order:

* A set may miss ``e`` of its tokens. The first ``e + 1`` of them, if rare, are its signatures.
* Where rare tokens run out, frequent tokens follow, dealt to classes by hash. In a class, pairs are
  indexed instead of single tokens; ``c`` tokens of a class stand for ``c - 1`` in the count, so the prefix
  is extended until rare tokens and ``c - 1`` of every class are over ``e``. Then two similar sets share a
  rare token or two tokens of one class. The number of classes follows from a size level; a set near a
  level's end is indexed under both, so that partners always agree.

Rare and frequent are told by counts of all tokens of the corpus in a table of fixed size
(:data:`SKETCH_BITS`); counts that share a cell only move a token to the other class, which is always
correct. On a large corpus every cell is loaded, so frequent is what stands out of the spread of the loads
(:func:`rare_limit`); the lists of rare tokens then grow with that spread, not with the mean load.
Candidates are then restricted by size, position and a parity bitmap, and verified on the n-grams
themselves.

Large groups of near copies would give all pairs. So each list of a signature is first compared with one
hub, the member with the fewest rare tokens; verified links make components, and only members of
different components are compared with each other. Connected components need no more links than that.
Identical texts are one node from the start. Lists beyond :data:`BLOCK` members are compared block by
block in as many tasks, and the texts of an id with more than :data:`HEADS` rows are verified in parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from cadastra.llm.components import connected_components
from cadastra.llm.words import WordHashes, arrow_schema, mixed, rows_of, signed, text_bytes, window_hashes
from cadastra.sources.staging import stage

SKETCH_BITS = 22
_SKETCH_PART = 1 << 16
BLOCK = 2000
#: List length that makes a token frequent, beside the load its cell has anyway.
WANTED_LIST = 32
#: Texts of one id that a task holds to compare others with.
HEADS = 100
_KNOWN_BYTES = 8 << 20
#: Most bits of the short bitmap in lists; the full one of a text has about as many bits as the text has tokens.
LIST_BITS = 2048
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SURVEY = "doc_id long, size long, words binary, bits binary, few_bits binary, part int, counts binary"
_POSTING = "sig long, doc_id long, size int, before int, pair boolean"


def normal_words(text: bytes) -> list[bytes]:
    """Words with A to Z in lower case."""
    return text.translate(_LOWER).split()


def shingles(words: list[bytes], n: int) -> set[bytes]:
    """Distinct n-grams; the whole sequence if it is shorter; none without words."""
    if len(words) < n:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def tokens(words: list[bytes], n: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct n-grams, sorted."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes.of(words), min(n, len(words))))


def _cells(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _survey(n: int):
    """Per text: id, number of n-grams, key of its words, bitmap. Per task: counts of all tokens, by part of the table.

    Copies in a task count once, as they do in the lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_SURVEY)
        hashes, table = WordHashes(), np.zeros(1 << SKETCH_BITS, np.uint32)
        known: dict[bytes, tuple[int, bytes, bytes]] = {}
        held = 0
        for batch in batches:
            sizes, keys, bits, few_bits = [], [], [], []
            for text in text_bytes(batch.column(1)):
                words = normal_words(text)
                key = hashlib.md5(b" ".join(words)).digest() if words else None
                if words and key not in known:
                    found = tokens(words, n, hashes)
                    np.add.at(table, _cells(found), 1)
                    bitmap = _bitmap(found, len(found))
                    held += 200 + len(bitmap)
                    if held > _KNOWN_BYTES:
                        known, held = {}, 0
                    known[key] = len(found), bitmap, _folded(bitmap, LIST_BITS // 8).tobytes()
                size, bitmap, few = known[key] if words else (0, None, None)
                sizes.append(size)
                bits.append(bitmap)
                few_bits.append(few)
                keys.append(key)
            empty = [None] * len(sizes)
            columns = {"doc_id": batch.column(0), "size": sizes, "words": keys, "bits": bits, "few_bits": few_bits}
            yield rows_of(schema, columns | {"part": empty, "counts": empty})
        packer = zstandard.ZstdCompressor(level=1)
        for part in range(0, len(table), _SKETCH_PART):
            counts = table[part:part + _SKETCH_PART]
            if counts.any():
                row = dict.fromkeys(schema.names, [None]) | {"part": [part], "counts": [packer.compress(counts.tobytes())]}
                yield rows_of(schema, row)

    return run


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the counts of one part after another (rows sorted by part), cut at 32 bits."""

    def done(part: int, total: np.ndarray) -> pa.RecordBatch:
        return rows_of(schema, {"part": [part], "counts": [np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()]})

    schema, unpack = arrow_schema("part int, counts binary"), zstandard.ZstdDecompressor()
    now, total = None, None
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            if part != now:
                if total is not None:
                    yield done(now, total)
                now, total = part, np.zeros(_SKETCH_PART, np.uint64)
            total += np.frombuffer(unpack.decompress(counts.as_py()), np.uint32)
    if total is not None:
        yield done(now, total)


def rare_limit(counts: np.ndarray) -> float:
    """Most that the cell of a rare token counts: the median load, four times its spread, and a list of the wanted length.

    The spread is that between the median and the 84th percentile, one standard deviation of an even load;
    tokens that do stand out move neither.
    """
    middle, high = np.percentile(counts, (50, 84))
    return WANTED_LIST + float(middle + 4 * (high - middle))


def frequency_classes(counts: np.ndarray, limit: float) -> np.ndarray:
    """Class of some cells, one byte each: 0 rare, above that the more the higher the count."""
    steps = np.ceil(np.log2(np.maximum(counts, 1) / limit)).clip(0, 63) + 1
    return np.where(counts > limit, steps, 0).astype(np.uint8)


def _level(size: int) -> int:
    return size.bit_length() - 1


def _bitmap(values: np.ndarray, size: int) -> bytes:
    """Parity of the tokens per bit. Each token in one set only flips one bit, so the number of different
    bits is at most that of different tokens."""
    width = max(64, 1 << (size - 1).bit_length())
    parity = np.bincount((values & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def signatures(values: np.ndarray, classes: np.ndarray, percent: int) -> list[tuple[int, int, bool]]:
    """``(signature, own rare tokens before it, whether it is of a pair)`` of one set of tokens."""
    size = len(values)
    if not size:
        return []
    needed = size - -(-percent * size // 100) + 1
    kind = classes[_cells(values)]
    rare = values[kind == 0]
    # Two different mixings: one for the order, so that it is independent of the cells.
    rare = rare[np.argsort(mixed(rare), kind="stable")]
    out: list[tuple[int, int, bool]] = [(int(s), i, False) for i, s in enumerate(signed(mixed(rare[:needed])).tolist())]
    needed -= len(out)
    if needed <= 0:
        return out
    frequent = values[kind > 0]
    frequent = mixed(frequent[np.lexsort((mixed(frequent), kind[kind > 0]))])
    if size == 1:  # a partner has one token too
        return [(int(signed(frequent ^ np.uint64(1))[0]), 0, False)]
    for level in {_level(size), _level(100 * size // percent)}:
        n_classes = max(1, (1 << level) * (100 - percent) // 200)
        members: list[list[int]] = [[] for _ in range(n_classes)]
        left = needed
        for token, class_ in zip(frequent.tolist(), (frequent % np.uint64(n_classes)).tolist()):
            pair = members[class_]
            out += [(_pair(other, token, level), len(rare), True) for other in pair]
            left -= bool(pair)
            pair.append(token)
            if not left:
                break
    return out


_LOW64 = (1 << 64) - 1


def _pair(first: int, second: int, level: int) -> int:
    """Signature of two tokens at a level, as a signed 64-bit number."""
    value = ((first * 0x9E3779B97F4A7C15 + second) * 0xD6E8FEB86659FD93 + level) & _LOW64
    value ^= value >> 32
    return value - (1 << 64) if value >> 63 else value


def _post(n: int, percent: int, classes_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, hashes, classes = arrow_schema(_POSTING), WordHashes(), classes_of()
        seen: set[bytes] = set()
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                words = normal_words(text)
                key = hashlib.md5(b" ".join(words)).digest()
                # A copy of a text of this task has the same signatures; copies are one node anyway.
                if doc_id is None or key in seen:
                    continue
                seen = seen if len(seen) < 1 << 20 else set()
                seen.add(key)
                values = tokens(words, n, hashes)
                for sig, before, pair in signatures(values, classes, percent):
                    out["sig"].append(sig)
                    out["before"].append(before)
                    out["pair"].append(pair)
                added = len(out["sig"]) - len(out["doc_id"])
                out["doc_id"] += [doc_id] * added
                out["size"] += [len(values)] * added
                if len(out["sig"]) > 50_000:
                    yield rows_of(schema, out)
                    out = {name: [] for name in schema.names}
            yield rows_of(schema, out)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pairs, and those whose signature the row before or after has too; rows are sorted by signature."""
    held, done = None, False  # last row so far, and whether it is out already
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = batch.column(0).to_numpy()
        same = np.zeros(len(sig) + 1, bool)  # between a row and the one before
        same[1:-1] = sig[1:] == sig[:-1]
        if held is not None and held.column(0)[0].as_py() == sig[0]:
            same[0] = True
            if not done:
                yield held
        keep = same[:-1] | same[1:] | batch.column(4).to_numpy(zero_copy_only=False)
        held, done = batch.slice(len(sig) - 1, 1), bool(keep[-1])
        if keep.any():
            yield batch.filter(pa.array(keep))


def _popcount_differs(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one[None, :] ^ others).sum(1)


def _folded(bits: bytes, width: int) -> np.ndarray:
    """Bitmap brought to ``width`` bytes by folding; token bits keep their low part, so folding is exact."""
    array = np.frombuffer(bits, np.uint8)
    while len(array) > width:
        half = len(array) // 2
        array = array[:half] ^ array[half:]
    return array


def list_pairs(rows: list[dict], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs (smaller id first) of one list or pair of blocks that can be similar and are not connected yet.

    Rows of the same ``block`` as their ``other`` meet each other; rows of different blocks meet across.
    """
    rows.sort(key=lambda r: (r["size"], r["doc_id"]))
    count = len(rows)
    ids, size, before, comp, block = (np.array([r[c] for r in rows], np.int64) for c in ("doc_id", "size", "before", "component", "block"))
    pairs = rows[0]["pair"]
    width = min(len(r["bits"]) for r in rows)
    bits = np.stack([_folded(r["bits"], width) for r in rows])
    across = len(set(block.tolist())) > 1
    for i in range(count - 1):
        upto = np.searchsorted(size, 100 * size[i] // percent, "right")
        other = np.arange(i + 1, upto)
        if across:
            other = other[block[other] != block[i]]
        other = other[comp[other] != comp[i]]
        least = -(-percent * (size[i] + size[other]) // (100 + percent))  # least overlap of two similar sets
        if not pairs:  # in the list of the first token both have, all they share comes from there on
            can = np.minimum(size[i] - before[i], size[other] - before[other]) >= least
            other, least = other[can], least[can]
        other = other[_popcount_differs(bits[i], bits[other]) <= size[i] + size[other] - 2 * least]
        for j in ids[other].tolist():
            yield (int(ids[i]), j) if ids[i] < j else (j, int(ids[i]))


def _cross(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, now, rows = arrow_schema("a long, b long"), None, []

        def close() -> Iterator[pa.RecordBatch]:
            found = list(list_pairs(rows, percent)) if len(rows) > 1 else []
            for i in range(0, len(found), 50_000):
                yield rows_of(schema, dict(zip("ab", zip(*found[i:i + 50_000]))))

        for batch in batches:
            for row in batch.to_pylist():
                key = row["sig"], row["low"], row["high"]
                if key != now:
                    yield from close()
                    now, rows = key, []
                rows.append(row)
        yield from close()

    return run


def _lists(postings: DataFrame, nodes: DataFrame) -> DataFrame:
    """Postings of signatures that several different texts have, ids replaced by those of the first copy."""
    # Lists of rare tokens are short. Frequent pairs surely have partners: they need not meet here.
    salt = F.when(F.col("pair"), F.pmod(F.xxhash64("doc_id"), F.lit(1024))).otherwise(F.lit(0))
    sorted_ = postings.repartition("sig", salt).sortWithinPartitions("sig")
    shared = stage(sorted_.mapInArrow(_shared, postings.schema), "lists")
    first = nodes.select(F.col("doc_id").alias("__id"), "node").distinct()
    named = shared.join(first, F.col("doc_id") == F.col("__id")).select("sig", F.col("node").alias("doc_id"), "size", "before", "pair").distinct()
    named = stage(named, "lists")
    several = named.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1")
    return named.join(several, "sig")


def _hub_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Each member of a list with its hub, if sizes and positions make a link likely; what this misses is compared later."""
    rank = F.struct("before", "doc_id", "size")
    hubs = lists.groupBy(F.col("sig").alias("__sig")).agg(F.min(rank).alias("hub"))
    both = lists.join(hubs, F.col("sig") == F.col("__sig")).where(F.col("doc_id") != F.col("hub.doc_id"))
    common = F.least(F.col("size") - F.col("before"), F.col("hub.size") - F.col("hub.before"))
    likely = (100 + percent) * common >= percent * (F.col("size") + F.col("hub.size"))
    return both.where(likely).select(F.col("hub.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct()


def _open_pairs(lists: DataFrame, components: DataFrame, few_bits: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one list that are in different components and can be similar by size, position and bitmap."""
    known = components.select(F.col("node").alias("__node"), "component")
    rows = lists.drop("n").join(known, F.col("doc_id") == F.col("__node"), "left")
    rows = rows.select("sig", "doc_id", "size", "before", "pair", F.coalesce("component", "doc_id").alias("component"))
    open_ = rows.groupBy(F.col("sig").alias("__sig")).agg(
        F.min("component").alias("first"), F.max("component").alias("last"), F.count("*").alias("n")
    ).where("first < last")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = rows.join(open_.select("__sig", blocks.alias("blocks")), F.col("sig") == F.col("__sig"))
    named = few_bits.toDF("__id", "bits")
    dealt = dealt.join(named, F.col("doc_id") == F.col("__id")).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select(
        "sig", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "doc_id", "size", "before", "pair", "bits", "component", "block",
    )
    keyed = spread.repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high")
    return keyed.mapInArrow(_cross(percent), "a bigint, b bigint").distinct()


def _similar_bits(percent: int):
    """Keep the pairs whose bitmaps do not rule out a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b, m, n in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                width = min(len(a), len(b))
                differ = int(np.bitwise_count(_folded(a, width) ^ _folded(b, width)).sum())
                keep.append(differ <= m + n - 2 * -(-percent * (m + n) // (100 + percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verify(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, now, heads = arrow_schema("a long, b long"), None, []
        for batch in batches:
            found = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(5)))
            for (a, chunk, part, order, b), text in zip(keys, text_bytes(batch.column(5))):
                own = shingles(normal_words(text), n)
                if order == 0:  # several only if several texts have the id
                    heads = [*heads, own] if (a, chunk, part) == now else [own]
                    now = a, chunk, part
                elif own and (a, chunk, part) == now:
                    overlaps = ((len(own & head), len(head)) for head in heads)
                    if any(100 * common >= percent * (len(own) + size - common) for common, size in overlaps):
                        found.append((a, b))
            if found:
                yield rows_of(schema, dict(zip("ab", zip(*found))))

    return run


def _verified(
    pairs: DataFrame, documents: DataFrame, many: DataFrame, bitmaps: DataFrame, n: int, percent: int, chunk: int = 200,
) -> DataFrame:
    """The pairs whose n-grams are similar enough: first by bitmap, then by text.

    Pairs are grouped by their first id, at most about ``chunk`` in a group; the text of the first id
    comes first in its group and is compared with the texts that follow. Where ``many`` gives a first id
    several parts, its texts are dealt to them and the others come to each.
    """
    one, two = (bitmaps.toDF(f"{x}_id", f"{x}_size", f"{x}_bits") for x in "ab")
    both = pairs.join(one, F.col("a") == F.col("a_id")).join(two, F.col("b") == F.col("b_id"))
    both = both.select("a", "b", "a_bits", "b_bits", "a_size", "b_size")
    pairs = stage(both.mapInArrow(_similar_bits(percent), "a bigint, b bigint").distinct(), "pairs")

    often = pairs.groupBy(F.col("a").alias("__a")).agg(F.ceil(F.count("*") / chunk).alias("chunks"))
    dealt = pairs.join(often, F.col("a") == F.col("__a")).select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    members = dealt.select("a", "chunk", F.lit(1).alias("order"), F.col("b").alias("member"))
    heads = dealt.select("a", "chunk", F.lit(0).alias("order"), F.col("a").alias("member")).distinct()
    wanted = stage(heads.unionAll(members), "wanted")
    # Written first, so that its size is known: a short list of ids spares the texts a shuffle.
    ids = stage(wanted.select(F.col("member").alias("doc_id")).distinct(), "wanted")
    texts = documents.join(ids, "doc_id", "left_semi").distinct()  # repeated rows count once
    joined = texts.join(wanted, F.col("doc_id") == F.col("member")).join(many, F.col("a") == F.col("many_id"), "left")
    own = F.array(F.pmod(F.xxhash64("text"), F.col("parts")).cast("int"))
    parts = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("order") == 0, own).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = joined.select("a", "chunk", F.explode(parts).alias("part"), "order", "member", "text")
    ordered = dealt.repartition("a", "chunk", "part").sortWithinPartitions("a", "chunk", "part", "order")
    return stage(ordered.mapInArrow(_verify(n, percent), "a bigint, b bigint"), "links")


def _classes(spark: SparkSession, surveyed: DataFrame) -> Callable[[], np.ndarray]:
    """A function that gives the class table in a task. Its size is fixed: one byte per cell."""
    parts = surveyed.where("part is not null").select("part", "counts").repartition("part").sortWithinPartitions("part")
    sums = parts.mapInArrow(_sum_parts, "part int, counts binary").collect()  # 2**SKETCH_BITS counts in all
    table = np.zeros(1 << SKETCH_BITS, np.uint32)
    for row in sums:
        table[row["part"]:row["part"] + _SKETCH_PART] = np.frombuffer(row["counts"], np.uint32)
    classes = frequency_classes(table, rare_limit(table))
    shared = spark.sparkContext.broadcast(zstandard.compress(classes.tobytes()))
    return lambda: np.frombuffer(zstandard.decompress(shared.value), np.uint8)


def similar_documents(documents: DataFrame, id: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (smallest id reachable by links, itself included).

    Two documents link when their n-grams overlap by ``percent`` of their union. Texts without words, null
    included, have no n-grams and no links. Rows of one id are one document: a link of one of its texts is
    a link of the id. A row with a null id takes the component of a document with the same words, else
    null. Other columns are not carried.
    """
    if not 51 <= percent <= 100:
        raise ValueError("percent must lie between 51 and 100")
    spark = documents.sparkSession
    texts = documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    surveyed = stage(texts.mapInArrow(_survey(n), _SURVEY.replace("long", "bigint")), "survey")
    rows = surveyed.where("part is null").select("doc_id", "size", "words")
    with_words = surveyed.where("part is null AND words is not null AND doc_id is not null")
    bitmaps, few_bits = (with_words.select("doc_id", *columns).distinct() for columns in (("size", "bits"), ("few_bits",)))
    copies = rows.where("words is not null").groupBy(F.col("words").alias("__words")).agg(F.min("doc_id").alias("node"))
    # Written first: a join with exchanges of its own can be split where one text is a third of all rows.
    copies = stage(copies, "copies")
    nodes = rows.join(copies, F.col("words") == F.col("__words"), "left").select("doc_id", "size", F.coalesce("node", "doc_id").alias("node"))
    nodes = stage(nodes, "nodes")
    known = nodes.where(F.col("doc_id").isNotNull())
    parts = F.ceil(F.count("*") / HEADS).cast("int").alias("parts")
    many = stage(known.groupBy(F.col("doc_id").alias("many_id")).agg(parts).where("parts > 1"), "many")

    postings = texts.mapInArrow(_post(n, percent, _classes(spark, surveyed)), _POSTING.replace("long", "bigint"))
    lists = stage(_lists(postings, known), "lists")
    near = _verified(_hub_pairs(lists, percent), texts, many, bitmaps, n, percent)
    # Several texts of one id make one document, whatever their words.
    same_id = known.where(F.col("doc_id") != F.col("node")).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    rest = _verified(_open_pairs(lists, connected_components(near), few_bits, percent), texts, many, bitmaps, n, percent)
    found = connected_components(near.unionAll(rest).unionAll(same_id))
    labelled = nodes.join(found.toDF("__node", "component"), F.col("node") == F.col("__node"), "left")
    return labelled.select(F.col("doc_id").alias(id), F.col("size").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))


def first_of_each_group(documents: DataFrame, id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, without those that link, by however many steps, to a document of a smaller id.

    Rows with a null id and texts without words stay, and so do all rows of an id that stays.
    """
    groups = similar_documents(documents, id, text, n, percent).where(F.col(id) != F.col("component_id"))
    gone = groups.select(F.col(id).alias("__id")).distinct()
    return documents.join(gone, F.col(id).cast("long") == F.col("__id"), "left_anti")
