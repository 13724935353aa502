"""Statistics against plain Python; rules against held-out labels."""

from __future__ import annotations

import random
import re

from conftest import SF_DIR

from cadastra.llm import decision_rules as dr


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen: dict = {}
    for i, w in enumerate(wins):
        seen.setdefault(w, []).append(i)
    covered = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def test_statistics(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n\x0b", "a", "a a a a a", "a a a a a a", "x\ny\nx\n\n \n\nx", "é#\U0001f600 |<>& b", "one two three four five " * 40, "\x85  q"]
    texts += [rng.choice([" ", "\n", "  "]).join(rng.choice(["a", "b", "c", "#x", "é"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = [(i if i != 5 else None, t) for i, t in enumerate(texts)] + [(3, "a"), (3, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' AS n_words", "1 AS row", "2 AS t", "3 AS w")
    got = dr.judged(df, []).collect()
    want = []
    for i, t in rows:
        counts = plain(t)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        want.append((i, *counts, failed, not failed))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert dr.judged(df.limit(0), []).collect() == []


def test_learned_list():
    rng = random.Random(1)
    rows = []
    for i in range(900):
        row = dict.fromkeys(dr.FEATURES, 0.0) | {f: rng.random() for f in ("mean_word", "upper_share", "symbol_share")}
        row["label"] = int(not (row["upper_share"] > 0.8 or (row["symbol_share"] > 0.5 and row["mean_word"] < 0.3)))
        rows.append(row | {"part": i % 3})
    rules = dr.learn(rows)
    wrong = sum(any(dr._covers(rule, r) for rule in rules) == bool(r["label"]) for r in rows)
    assert 2 <= len(rules) <= 4 and wrong < 20
    assert dr.learn([r for r in rows if r["label"]]) == [] and dr.learn([]) == []


def test_held_out_labels(spark):
    documents, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rules = dr.fit(documents, labels, least_covered=2)
    got = dr.judged(documents, rules).join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 4 = 2 AND n_words >= 10").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in got)
    assert right >= 0.85 * len(got)
    again = dr.judged(documents.repartition(3), dr.fit(documents.repartition(5), labels, least_covered=2))
    assert again.exceptAll(dr.judged(documents, rules)).count() == 0
    assert dr.fit(documents, labels.limit(0)) == []


def test_expression_follows_the_list(spark):
    rules = [(dr.Condition("n_words", True, 3.0), dr.Condition("symbol_share", False, 0.5)), (dr.Condition("mean_word", True, 4.0),)]
    df = dr.with_statistics(spark.createDataFrame([(1, "a b c d"), (2, "# # # # #"), (3, "longer words")], "doc_id long, text string"))
    got = {r["id"]: r["v"] for r in df.select("row.doc_id", dr.verdict(rules).alias("v")).toDF("id", "v").collect()}
    assert got == {1: False, 2: True, 3: False}
    assert str(rules[0][0]) == "n_words > 3"
