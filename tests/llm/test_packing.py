"""Packing: nothing lost, nothing overlapping, good use of the sequences."""

from __future__ import annotations

from collections import defaultdict

from hypothesis import given, settings, strategies as st

from cadastra.llm import packing


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.sampled_from([(40,), (10, 40), (5, 13, 29, 40)]))
def test_every_piece_is_placed_and_bins_are_as_small_as_possible(lengths, capacities):
    place, capacity = packing.best_fit(lengths, capacities, 3)
    used = defaultdict(int)
    for number, length in zip(place, lengths):
        used[number] += length
    assert sorted(used) == list(range(len(capacity)))
    for number, words in used.items():
        assert capacity[number] == min(c for c in capacities if c >= words)
    if capacities == (40,) and lengths:  # best fit decreasing: at most 11/9 of the least number and one more
        assert len(capacity) <= 11 / 9 * max(1, -(-sum(lengths) // 40)) + 1 + sum(2 * x > 40 for x in lengths)


def test_joint_choice_beats_one_length_only():
    lengths = [300] * 40 + [700] * 30 + [90] * 25 + [4000] * 3
    _, several = packing.best_fit(lengths)
    _, one = packing.best_fit(lengths, (8192,))
    assert sum(several) <= sum(one)
    assert sum(lengths) / sum(several) > 0.95


def test_table(spark):
    texts = [(1, "a b c"), (2, None), (3, ""), (4, "x " * 23), (None, "q"), (1, "a b c"), (5, " \t\n")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("bin_id", __import__("pyspark").sql.functions.lit("clash"))
    got = packing.pack_documents(df, capacities=(4, 10), overhead=1).collect()
    by_bin = defaultdict(list)
    for r in got:
        if r["length"]:
            by_bin[r["bin_id"]].append((r["bin_offset"], r["length"], r["capacity"]))
    for members in by_bin.values():
        at = 0
        for offset, length, capacity in sorted(members):
            assert offset == at
            at += length
        assert at <= members[0][2]
    pieces = sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in got if r["doc_id"] == 4)
    assert pieces == [(4, 0, 0, 10), (4, 1, 10, 10), (4, 2, 20, 3)]
    assert sorted(r["doc_id"] for r in got if not r["length"]) == [2, 3, 5] and all(r["bin_id"] is None for r in got if not r["length"])
    assert sum(r["length"] for r in got) == 3 + 23 + 1 + 3
    assert packing.pack_documents(df.limit(0)).collect() == []


def test_small_groups(spark):
    df = spark.createDataFrame([(i, "w " * (i % 17)) for i in range(300)], "doc_id long, text string").repartition(3)
    got = packing.pack_documents(df, capacities=(8, 16), group=7).collect()
    used = defaultdict(int)
    for r in got:
        used[r["bin_id"], r["capacity"]] += r["length"]
    assert all(words <= (cap or 0) for (_, cap), words in used.items())
    assert sum(used.values()) == sum(i % 17 for i in range(300))


def plain_best_fit(lengths, capacities, overhead):
    """The method step by step: every open sequence is looked at, every filling is tried piece by piece."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    place, room, used = [0] * len(lengths), [], []
    for step, i in enumerate(order):
        fitting = [(room[n], n) for n in range(len(room)) if room[n] >= lengths[i]]
        if fitting:
            number = min(fitting)[1]
        else:
            costs = []
            for size in sorted(c for c in capacities if c >= lengths[i]):
                words = lengths[i]
                for j in order[step + 1:]:  # the longest that fits, again and again
                    words += lengths[j] if lengths[j] <= size - words else 0
                costs.append(((min(c for c in capacities if c >= words) + overhead) / words, size))
            number = len(room)
            room.append(min(costs, key=lambda c: c[0])[1])
            used.append(0)
        place[i] = number
        room[number] -= lengths[i]
        used[number] += lengths[i]
    return place, [min(c for c in capacities if c >= words) for words in used]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.sampled_from([(40,), (10, 40), (5, 13, 29, 40)]), st.integers(0, 9))
def test_equals_the_plain_method(lengths, capacities, overhead):
    assert packing.best_fit(lengths, capacities, overhead) == plain_best_fit(lengths, capacities, overhead)


def test_fill_does_not_depend_on_partitions(spark):
    """A table of very many small partitions fills its sequences as one of two does."""
    df = spark.createDataFrame([(i, "w " * (1 + i * 7919 % 13)) for i in range(1200)], "doc_id long, text string")
    filled = []
    for frame in (df.coalesce(2), df.repartition(150)):
        rows = packing.pack_documents(frame, capacities=(8, 16)).collect()
        bins = {r["bin_id"]: r["capacity"] for r in rows}
        filled.append(sum(r["length"] for r in rows) / sum(bins.values()))
    assert abs(filled[0] - filled[1]) < 0.003 and min(filled) > 0.97
