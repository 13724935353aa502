from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from cadastra.llm import covering_simhash as cs
from conftest import SF_DIR

SCHEMA = "doc_id long, text string, fp string, component string"


def plain_fingerprint(text):
    """The definition, bit by bit."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=3):
    """(id, fingerprint, component) of (id, text) rows by all pairs."""
    prints = [plain_fingerprint(text) for _, text in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            label[root(i)] = root(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        lowest.setdefault(root(i), set()).add(doc_id)
    return sorted(
        ((doc_id, f"{prints[i]:016x}", min((x for x in lowest[root(i)] if x is not None), default=None)) for i, (doc_id, _) in enumerate(rows)), key=str,
    )


def run(spark, rows, **settings):
    frame = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], SCHEMA)
    out = cs.near_duplicates(frame, **settings)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted(map(tuple, out.collect()), key=str)


def test_every_pair_within_the_radius_is_filed_alike():
    masks = cs.covering_masks(range(64), 3)
    assert len(masks) == 15 and all(32 <= m.bit_count() <= 36 for m in masks)
    for positions in combinations(range(64), 3):
        assert any(not any(m >> p & 1 for p in positions) for m in masks)
    for mask in masks:
        left = cs._open_positions(mask)
        finer = cs.covering_masks(left, 3)
        assert all(len(left) - m.bit_count() <= 16 for m in finer)
        assert all(any(not any(m >> p & 1 for p in positions) for m in finer) for positions in combinations(left, 3))


def test_fingerprint_of_short_and_long_texts():
    rng = random.Random(1)
    words = ["Äpfel", "ZEBRA", "x", "foo,", "bar baz"]
    long_text = " ".join(rng.choice(words) for _ in range(70_000))
    for text in ("", " \t\n", "One", "one TWO", "One\x0btwo\rthree", long_text):
        assert cs.fingerprint(text.encode()) == plain_fingerprint(text)


def test_connected_parts():
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 1 << 12, 300, np.uint64))
    links = list(cs.connected_parts(values, 1))
    seen = {i: {i} for i in range(len(values))}
    for a, b in combinations(range(len(values)), 2):
        if int(values[a] ^ values[b]).bit_count() <= 1 and seen[a] is not seen[b]:
            seen[a] |= seen[b]
            for x in seen[b]:
                seen[x] = seen[a]
    assert {frozenset(s) for s in seen.values()} == {frozenset([a, *(y for x, y in links if x == a)]) for a in range(len(values)) if a not in {y for _, y in links}}
    assert len(links) == len(values) - len({id(s) for s in seen.values()})


def near_copies(count, seed):
    """Texts that differ in a word or two: many different fingerprints close together."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.choice((1, 2, 5))):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("bucket", [cs.BUCKET, 2])
def test_against_all_pairs(spark, bucket):
    rng = random.Random(5)
    texts = near_copies(60, 1) + near_copies(30, 2) + [" ".join(f"u{rng.randrange(90)}" for _ in range(rng.choice((1, 2, 3, 9, 40)))) for _ in range(60)]
    rows = [(rng.randrange(10_000), t) for t in texts + texts[:20]]
    rows += [(7, None), (3, ""), (9_999, "  "), (None, texts[0]), (None, None), (None, "quite alone among all of these"), (50, "One two"), (50, texts[70])]
    assert run(spark, rows, bucket=bucket) == brute(rows)


def test_chain_of_links_and_hot_fingerprint(spark):
    """Fingerprints in a chain are one component; a third of the rows share one text."""
    prints = [0]
    for step in range(20):
        prints.append(prints[-1] ^ (0b111 << (3 * step)))
    frame = spark.createDataFrame([(cs._signed(p),) for p in prints], "fp long")
    links = {(r["a"], r["b"]) for r in cs.fingerprint_links(frame).collect()}
    reach, before = {cs._signed(0)}, -1
    while len(reach) != before:
        before = len(reach)
        reach |= {y for a, b in links for x, y in ((a, b), (b, a)) if x in reach}
    assert len(reach) == len(prints)
    rows = [(i, "the same words again and again") for i in range(100, 400)] + [(i, f"text {i} {i * 7} {i * 11} {i * 13}") for i in range(100)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_given_documents(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = sorted(map(tuple, cs.near_duplicates(documents).collect()), key=str)
    assert got == brute(rows)
