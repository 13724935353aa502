"""What all text operators agree on: a word is a run of characters other than ASCII white space.

``bytes.split()`` cuts UTF-8 text at exactly the same six characters as :data:`WORD`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, functions as F

from cadastra.functions.cols import ColumnLike, as_col

WORD = r"[^\x20\x09-\x0D]+"
_CACHED_WORDS = 1 << 18


def n_words(text: ColumnLike) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(as_col(text), F.lit(WORD)), F.lit(0)).cast("long")


def fold(number: ColumnLike) -> Column:
    """``crc32`` of an id as text, modulo 4. Remainder 2 is held out of every training."""
    return F.crc32(as_col(number).cast("string").cast("binary")) % 4


class WordHashes(dict):
    """64-bit hash of a word (bytes). The cache is emptied when it has grown to its bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_STEP, _LOW64 = 0x9E3779B97F4A7C15, (1 << 64) - 1


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` hashes, by doubling: runs of 1, 2, 4 ... are combined.

    Runs of equal content get equal hashes wherever they stand. Empty when there are too few.
    """
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    block, width, factor = hashes, 1, _STEP
    done, covered = None, 0
    rest = size
    while True:
        if rest & 1:  # append the present block behind what is covered so far
            tail = block[covered:covered + count]
            done = tail.copy() if done is None else done * np.uint64(factor) + tail
            covered += width
        rest >>= 1
        if not rest:
            break
        block = block[:-width] * np.uint64(factor) + block[width:]
        width *= 2
        factor = (factor * factor + 2) & _LOW64
    return mixed(done)


def mixed(values: np.ndarray) -> np.ndarray:
    """Bit mixing, so that order and low bits of hashes are as good as random."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column as UTF-8, one at a time; null counts as empty."""
    return (value.as_py() or b"" for value in column.cast(pa.large_binary()))


def rows_of(schema: pa.Schema, columns: dict[str, list | np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a comma-separated list ``name type`` with the types used here."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(","))])


Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
