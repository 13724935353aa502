"""Token counts against a plain search over all cuttings."""

from __future__ import annotations

import random
from functools import cache

import pytest

from cadastra.llm import trie_counts

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def brute(word, scores):
    byte = min(scores.values()) - 1.0

    @cache
    def best(end):
        if not end:
            return 0.0, 0
        width = len(word[end - 1].encode())
        options = [(best(end - 1)[0] + width * byte, best(end - 1)[1] - width)]
        options += [(best(b)[0] + scores[word[b:end]], best(b)[1] - 1) for b in range(end) if word[b:end] in scores]
        return max(options)

    return -best(len(word))[1]


def brute_long(word, scores):
    """The search without recursion, for words of any length."""
    byte, longest = min(scores.values()) - 1.0, max(map(len, scores))
    path = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        width = len(word[end - 1].encode())
        options = [(path[-1][0] + width * byte, path[-1][1] - width)]
        options += [(path[b][0] + scores[word[b:end]], path[b][1] - 1) for b in range(max(0, end - longest), end) if word[b:end] in scores]
        path.append(max(options))
    return -path[-1][1]


def test_trie_equals_search(monkeypatch):
    rng = random.Random(5)
    pieces = list({"".join(rng.choice("abc▁") for _ in range(rng.randrange(1, 5))) for _ in range(60)})
    scores = trie_counts.zipf_scores(pieces)
    trie = trie_counts.PieceTrie(scores)
    words = {"".join(rng.choice("abcdé▁\U0001f600\0") for _ in range(rng.randrange(0, 14))) for _ in range(3000)}
    for block in (1 << 15, 7):
        monkeypatch.setattr(trie_counts, "BLOCK", block)
        assert trie.count(words) == {word: brute(word, scores) for word in words}
    long = "ab" * 100 + "é"
    assert trie.count([long, ""]) == {long: brute(long, scores), "": 0}
    assert trie.count([]) == {}


def test_slices_of_levels_change_nothing(monkeypatch):
    rng = random.Random(6)
    pieces = list({"".join(rng.choice("abc▁") for _ in range(rng.choice([1, 2, 3, 5, 9]))) for _ in range(80)})
    scores = trie_counts.zipf_scores(pieces)
    trie = trie_counts.PieceTrie(scores)
    stems = ["".join(rng.choice("abc▁é") for _ in range(rng.randrange(1, 400))) for _ in range(20)]
    words = {stem[:rng.randrange(len(stem) + 1)] + "".join(rng.choice("abc\0") for _ in range(rng.randrange(4))) for stem in stems for _ in range(30)}
    words |= set(stems)
    want = {word: brute_long(word, scores) for word in words}
    assert all(want[word] == brute(word, scores) for word in words if len(word) < 200)
    for cells in (1, 3_000, 30_000, 1 << 22):
        monkeypatch.setattr(trie_counts, "SLICE_CELLS", cells)
        assert trie.count(words) == want


@pytest.fixture(scope="module")
def scores():
    return trie_counts.piece_scores(VOCABULARY)


def test_public_vocabulary(scores):
    trie = trie_counts.PieceTrie(scores)
    words = ["▁the", "▁reinvention", "▁Häuser", "▁日本語", "▁###", "▁x1y2"]
    assert trie.count(words) == {word: brute(word, scores) for word in words} and trie.count(words)["▁the"] == 1


def test_table(spark, scores):
    texts = ["the house the\nhouse", None, "", "\x0b ", "é" * 3000, "the house the\nhouse"]
    df = spark.createDataFrame([(i if i != 3 else None, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in trie_counts.count_tokens(df, scores).collect()}
    want = [(len((t or "").encode().split()), sum(brute("▁" + w.decode(), scores) for w in (t or "").encode().split())) for t in texts[:4]]
    assert [got[i] for i in (0, 1, 2, None)] == want
    assert got[4] == (1, brute_long("▁" + "é" * 3000, scores)) and got[5] == got[0]
    assert trie_counts.count_tokens(df.limit(0), scores).collect() == []
