"""Token counts under a unigram model over the pieces of a public vocabulary.

A word is cut into the pieces whose log-probabilities add up to most. The best score of a prefix does
not depend on what follows, so the distinct words of a batch are put into a trie and the forward step is
done once per trie node; the node a word ends in holds its number of tokens. Documents then only add up
the counts of their words. No shuffle: what travels is one row per document.

The trie is laid out by depth. In sorted words, those of one prefix stand together and the first of them
stands for the node; a level is one pass of array operations over its nodes, with the levels above as
input. Words are taken in blocks of :data:`BLOCK` and levels in slices, as deep as :data:`SLICE_CELLS`
allows for the words that reach them, so memory is bounded however long a word is.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cadastra.llm.words import arrow_schema, rows_of, text_bytes

WORD_START = "▁"
BLOCK = 1 << 15
#: Most pairs of a node and a length of pieces in a slice of levels.
SLICE_CELLS = 1 << 22
_KEEP_WORDS = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LETTER = np.uint64(0xD6E8FEB86659FD93)


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Log-probabilities of ranked pieces by Zipf's law: for vocabularies that store ranks only."""
    total = math.log(sum(1 / (rank + 1) for rank in range(len(pieces)))) if pieces else 0.0
    return {piece: -math.log(rank + 1) - total for rank, piece in reversed(list(enumerate(pieces)))}


def piece_scores(model_file: str) -> dict[str, float]:
    """Log-probabilities of the pieces of a sentencepiece file, without control and byte pieces.

    A unigram model stores them. A merge model stores minus the rank; there Zipf's law gives them.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in usable}
    if any(score != int(score) for score in scores.values()):
        return scores
    return zipf_scores(sorted(scores, key=lambda piece: -scores[piece]))


class PieceTrie:
    """Numbers of tokens of words under given scores of pieces."""

    def __init__(self, scores: Mapping[str, float]):
        self.longest = max(map(len, scores), default=1)
        # A character outside the vocabulary becomes its UTF-8 bytes; each byte is dearer than any piece.
        self.byte = min(scores.values(), default=0.0) - 1.0
        # Pieces by length, each as sorted hashes with their scores.
        self.pieces: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted(set(map(len, scores))):
            some = [p for p in scores if len(p) == length]
            letters = np.array([[ord(c) for c in p] for p in some], np.uint64)
            hashed = np.zeros(len(some), np.uint64)
            for place in range(length):
                hashed = hashed * _BASE + (letters[:, place] + np.uint64(1)) * _LETTER
            order = np.argsort(hashed)
            self.pieces[length] = hashed[order], np.array([scores[p] for p in some])[order]

    def count(self, words: Iterable[str]) -> dict[str, int]:
        """Number of tokens of each word."""
        counts, ordered = {}, sorted(words)  # by code point, so that words of one prefix stand together
        for first in range(0, len(ordered), BLOCK):
            block = ordered[first:first + BLOCK]
            counts.update(zip(block, self._walk(block).tolist()))
        return counts

    def _walk(self, words: list[str]) -> np.ndarray:
        """Numbers of tokens of sorted words, slice of levels by slice of levels.

        Of the levels before a slice, as many are kept as the longest piece reaches back, for the words
        that go on.
        """
        counts = np.zeros(len(words), np.int64)
        on = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)))
        # Rows are levels: those that a piece can begin at, the last of them the one before the slice.
        shape = self.longest + 1, len(on)
        hashes, scores, tokens = np.zeros(shape, np.uint64), np.full(shape, -np.inf), np.zeros(shape, np.int32)
        scores[-1] = 0.0
        same = np.zeros(len(on), bool)  # whether all before the slice is as in the word before
        same[1:] = True
        begin = 0
        while len(on):
            depth = max(1, SLICE_CELLS // (len(on) * (len(self.pieces) + 1)))
            parts = [words[i][begin:begin + depth] for i in on]
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            nodes, (hashes, scores, tokens) = self._slice(parts, lengths, same, hashes, scores, tokens)
            reached = len(nodes)
            counts[on] = tokens[self.longest + lengths, np.arange(len(on))]
            begin += reached
            further = lengths == reached
            further[further] = [len(words[i]) > begin for i in on[further]]
            group = np.cumsum(nodes[-1])[further]
            on, same = on[further], np.concatenate([np.zeros(1, bool), group[1:] == group[:-1]])[:len(group)]
            hashes, scores, tokens = (kept[reached:, further] for kept in (hashes, scores, tokens))
        return counts

    def _slice(self, parts, lengths, same, hashes, scores, tokens):
        """The forward step over a slice of levels.

        Returns which words stand for a node, by level, and the state with the levels of the slice below.
        """
        depth, back, rows = int(lengths.max()), self.longest, np.arange(len(parts))
        letters = np.array(parts, dtype=f"U{depth}").view(np.uint32).reshape(len(parts), depth).T
        widths = 1 + (letters >= 0x80).astype(np.int8) + (letters >= 0x800) + (letters >= 0x10000)
        # Length of what a word has in common with the word before it, within the slice.
        common = np.zeros(len(parts), np.int64)
        differs = np.concatenate([letters[:, 1:] != letters[:, :-1], np.ones((1, len(parts) - 1), bool)])
        common[1:] = np.minimum(differs.argmax(axis=0), np.minimum(lengths[1:], lengths[:-1]))
        common[~same] = 0
        common[~same] -= 1  # not even the level before the slice
        levels = np.arange(1, depth + 1)[:, None]
        nodes = (common < levels) & (lengths >= levels)
        hashes, scores, tokens = (np.concatenate([kept, np.zeros((depth, len(parts)), kept.dtype)]) for kept in (hashes, scores, tokens))
        for end in range(1, depth + 1):
            hashes[back + end] = hashes[back + end - 1] * _BASE + (letters[end - 1].astype(np.uint64) + np.uint64(1)) * _LETTER
        # Which pieces end at a node does not depend on scores: all nodes of the slice are looked up at once.
        level, row = np.nonzero(nodes)
        reach = np.array([0, *self.pieces], np.int64)  # the first row is the bytes of the last character
        values = np.full((len(reach), len(level)), -np.inf)
        values[0] = widths[level, row] * self.byte
        place = (back + 1 + level) * len(parts) + row
        whole = hashes.take(place)
        for number, (length, (known, value)) in enumerate(self.pieces.items(), 1):
            piece = whole - hashes.take(place - length * len(parts)) * _power(length)
            at = np.minimum(np.searchsorted(known, piece), len(known) - 1)
            hit = np.flatnonzero(known.take(at) == piece)
            values[number, hit] = value.take(at[hit])
        starts = np.searchsorted(level, np.arange(depth + 1)).tolist()
        reach[0] = 1
        for end in range(1, depth + 1):
            some = slice(starts[end - 1], starts[end])
            node = row[some]
            origin = (back + end - reach)[:, None] * len(parts) + node
            total = scores.take(origin) + values[:, some]
            spent = tokens.take(origin) + 1
            spent[0] += widths[end - 1, node] - 1
            best = total.max(axis=0)
            fewest = np.where(total == best, spent, np.iinfo(np.int32).max).min(axis=0)
            scores[back + end, node], tokens[back + end, node] = best, fewest
            stands_for = np.maximum.accumulate(np.where(nodes[end - 1], rows, 0))
            scores[back + end], tokens[back + end] = scores[back + end, stands_for], tokens[back + end, stands_for]
        return nodes, (hashes, scores, tokens)


def _power(length: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), length, 1 << 64))


def _counter(scores: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("id long, n_words long, n_tokens long")
        trie, known = PieceTrie(scores), {}
        for batch in batches:
            texts = [text.split() for text in text_bytes(batch.column(1))]
            new = {word for words in texts for word in words if word not in known}
            spelled = {word: WORD_START + word.decode(errors="replace") for word in new}
            counts = trie.count(set(spelled.values()))
            known.update((word, counts[text]) for word, text in spelled.items())
            sums = [sum(map(known.__getitem__, words)) for words in texts]
            yield rows_of(schema, {"id": batch.column(0), "n_words": [len(w) for w in texts], "n_tokens": sums})
            if len(known) > _KEEP_WORDS:
                known.clear()

    return run


def count_tokens(
    documents: DataFrame, scores: dict[str, float], id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: id, ``n_words`` and ``n_tokens``.

    Null and empty texts have none of either. Repeated rows and null ids are ordinary rows; other
    columns are not carried. Ties between cuttings go to the one with fewer tokens.
    """
    shared = documents.sparkSession.sparkContext.broadcast(scores)  # one vocabulary, a few MB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counter(shared.value)(batches)

    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, n_words bigint, n_tokens bigint").withColumnRenamed("id", id)
