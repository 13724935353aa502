from __future__ import annotations

import hashlib
import random
import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from cadastra.llm import prefix_trie as pt  # noqa: E402
from tools.compare import connect, difference  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, name string, depth string"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, name), (role, text)))
    own = {conv: [t for _, t in sorted(turns)] for conv, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        donor = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        out[conv] = own.get(donor, [])[:h] + turns[h:]
    return out


def brute(rows):
    """Nodes by walking every prefix of every conversation."""
    convs = {conv: tuple(turns) for conv, turns in rebuilt(rows).items()}
    members = {}
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        leaves[prefix] = sum(leaves[c] for c in below) or 1
        saved[prefix] = sum(saved[c] for c in below) + (len(members[prefix]) - 1) * (len(prefix[-1][1]) if prefix else 0)
    out = []
    for prefix, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(own), len(prefix), parent, len(own), len(children.get(prefix, [])), leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    out = pt.conversation_trie(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA))
    assert out.columns == [part.split()[0] for part in pt._NODE.split(", ")]
    return sorted(map(tuple, out.collect()), key=str)


def made(count, seed):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(0, 450), count):
        rows += [(conv, turn, rng.choice(("user", "assistant")), rng.choice(("a", "bß", "ccc"))) for turn in range(rng.randrange(1, 9))]
    rng.shuffle(rows)
    return rows


def test_against_walking_all_prefixes(spark):
    rows = made(120, 1)
    rows += [(500, turn, "user", f"t{turn % 3}") for turn in range(40)]  # a long one
    rows += [(conv, turn, "user", "same") for conv in range(700, 790) for turn in range(7)]  # many equal ones
    rows += [(-5, 0, "user", "a"), (-105, 0, None, None), (-105, None, "user", ""), (-200, 1, "user", "bß")]
    rows += [(600, 1, "user", "a")] * 5 + [(600, None, "x", "first"), (600, 1, None, "a"), (601, 1, "usera", ""), (602, 1, "user", "a")]
    rows += [(None, 1, "user", "a"), (None, None, None, None)]
    assert run(spark, rows) == brute(rows)


def test_members_without_turns_and_chunks(spark, monkeypatch):
    """Conversations without a donor whose turns are all cut off end in the root; their ids fill several chunks."""
    monkeypatch.setattr(pt, "CHUNK", 4)
    rows = [(conv, 0, "user", "a") for conv in range(801, 860)]
    got = run(spark, rows)
    assert got == brute(rows)
    alone = [c for c in range(801, 820) if zlib.crc32(str(c).encode()) % 6][:3]
    assert run(spark, [(c, 0, "user", "a") for c in alone]) == brute([(c, 0, "user", "a") for c in alone])


def test_one_conversation(spark):
    rows = [(0, turn, "user", "word") for turn in range(17)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == run(spark, [(None, 0, "user", "a")]) == []


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, sf_dir):
    assert difference(spark, connect(sf_dir), "op12_conversation_trie", sf_dir) == ""


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, rows) == brute(rows)
