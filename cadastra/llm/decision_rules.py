"""Quality rules: text statistics, and an ordered list of rejecting rules learned from labels.

Statistics are array and regular-expression functions over one text at a time: no shuffle, no Python.
Windows of five words are compared by hash first; only texts in which two hashes agree sort the windows
themselves, so the counts are exact and the sort is rare.

Learning is sequential covering. A rule grows by the threshold that gains most, on two thirds of a
bounded sample of labelled statistics; then it loses conditions from its end as long as that helps on
the last third; the texts it covers leave, and the next rule is grown on what is left. The list becomes
one ordered ``when ... when ... otherwise`` expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cadastra.llm.compression_quality import labelled_sample
from cadastra.llm.words import WORD, fold

WINDOW = 5
#: Inputs of the rules, all computed by :func:`with_statistics`.
FEATURES = (
    "n_words", "mean_word", "symbol_share", "upper_share", "mark_share", "digit_share", "dup_line_share", "repeat_share",
)


def with_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """All other columns become a struct column ``row``; added are ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` (long) and the shares of :data:`FEATURES` (double). A null text counts as empty.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    read = documents.select(F.struct(*[c for c in documents.columns if c != text]).alias("row"), content.alias("t"))
    count = lambda pattern: F.regexp_count("t", F.lit(pattern)).cast("long")
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(WORD))
    counted = read.select(
        "row", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("w"), lines.alias("lines"),
        (F.char_length("t") - count(r"[\x20\x09-\x0D]")).cast("long").alias("word_chars"), count(r"[#*$%&|<>]").alias("n_symbols"),
        count(r"\p{Lu}").alias("upper"), count(r"[!?]").alias("marks"), count(r"[0-9]").alias("digits"),
    )
    n = F.size("w")
    has_windows = n >= WINDOW
    spots = F.sequence(F.lit(0), n - WINDOW)
    words = lambda i: [F.get(F.col("w"), i + k) for k in range(WINDOW)]
    hashed = F.when(has_windows, F.transform(spots, lambda i: F.xxhash64(*words(i))))
    counted = counted.withColumn("h", hashed)
    suspect = F.size(F.array_distinct("h")) < F.size("h")
    # Only texts with two windows of one hash sort the windows themselves.
    ordered = F.sort_array(F.transform(spots, lambda i: F.struct(F.concat_ws(" ", *words(i)).alias("win"), i.alias("at"))))
    counted = counted.withColumn("s", F.when(suspect, ordered))
    window = lambda i: F.get(F.col("s"), i)["win"]
    twice = F.filter(
        F.sequence(F.lit(0), F.size("s") - 1),
        lambda k: F.coalesce(window(k) == window(k - 1), F.lit(False)) | F.coalesce(window(k) == window(k + 1), F.lit(False)),
    )
    counted = counted.withColumn("p", F.when(F.col("s").isNotNull(), F.sort_array(F.transform(twice, lambda k: F.get(F.col("s"), k)["at"]))))
    steps = F.sequence(F.lit(1), F.size("p") - 1)
    at = lambda k: F.get(F.col("p"), k)
    covered = F.aggregate(steps, F.lit(WINDOW), lambda sum_, k: sum_ + F.least(F.lit(WINDOW), at(k) - at(k - 1)))
    repeated = F.when(F.size("p") > 1, covered).otherwise(F.lit(0)).cast("long")
    n_lines = F.size("lines")
    out = counted.select(
        "row", n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (n_lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"), "upper", "marks", "digits", n_lines.alias("n_lines"),
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return out.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"), share("upper", "word_chars").alias("upper_share"),
        share("marks", "word_chars").alias("mark_share"), share("digits", "word_chars").alias("digit_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _best_condition(bad: list[dict], good: list[dict], weight: float) -> tuple[float, Condition | None]:
    """The condition with the largest gain of information about the covered bad rows; a good row counts ``weight``."""
    total = len(bad) + weight * len(good)
    before = math.log2(len(bad) / total)
    best: tuple[float, Condition | None] = (0.0, None)
    for feature in FEATURES:
        values = sorted([(row[feature], 1) for row in bad] + [(row[feature], 0) for row in good])
        low_bad, low = 0, 0.0
        for (value, is_bad), (following, _) in zip(values, values[1:]):
            low, low_bad = low + (1 if is_bad else weight), low_bad + is_bad
            if value == following:
                continue
            for above, b, all_ in ((False, low_bad, low), (True, len(bad) - low_bad, total - low)):
                gain = b * (math.log2(b / all_) - before) if b else 0.0
                if gain > best[0] + 1e-9:
                    best = gain, Condition(feature, above, (value + following) / 2)
    return best


def grow(bad: list[dict], good: list[dict], longest: int, weight: float = 1.0) -> Rule:
    rule: Rule = ()
    while bad and good and len(rule) < longest:
        _, condition = _best_condition(bad, good, weight)
        if condition is None:
            break
        rule += (condition,)
        bad, good = ([r for r in rows if condition.holds(r)] for rows in (bad, good))
    return rule


def prune(rule: Rule, bad: list[dict], good: list[dict], weight: float = 1.0) -> Rule:
    """The beginning of the rule that separates best on rows it was not grown on."""

    def worth(short: Rule) -> float:
        p, n = sum(_covers(short, r) for r in bad), weight * sum(_covers(short, r) for r in good)
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def learn(
    rows: list[dict], max_rules: int = 8, longest: int = 4, least_precision: float = 0.97, least_covered: int = 5, weight: float = 1.0,
) -> list[Rule]:
    """Rejecting rules from rows of features with ``label`` (0 bad, 1 good) and ``part`` (0, 1 grow, 2 prune).

    ``weight`` is what a good row counts against a bad one: above 1 where the sample holds too few good rows.
    """
    bad = [r for r in rows if r["label"] == 0]
    good = [r for r in rows if r["label"] == 1]
    rules: list[Rule] = []
    while len(rules) < max_rules:
        parts = [[r for r in side if (r["part"] == 2) == last] for last in (False, True) for side in (bad, good)]
        rule = prune(grow(parts[0], parts[1], longest, weight), parts[2], parts[3], weight)
        hit, wrong = (sum(_covers(rule, r) for r in side) for side in (bad, good))
        if not rule or hit < least_covered or hit < least_precision * (hit + weight * wrong):
            break
        rules.append(rule)
        bad, good = ([r for r in side if not _covers(rule, r)] for side in (bad, good))
    return rules


def fit(
    documents: DataFrame, labels: DataFrame, per_class: int = 1500, id: str = "doc_id", text: str = "text", label: str = "quality", **options,
) -> list[Rule]:
    """Rules from the statistics of at most ``per_class`` labelled texts of either label; see :func:`learn`.

    Held-out ids (:func:`cadastra.llm.words.fold`) are not used. Only the statistics of the sample come to the driver.
    """
    sample = labelled_sample(documents, labels, per_class, id, text, label)
    part = F.pmod(F.xxhash64(F.col("__id"), F.lit("part")), F.lit(3)).cast("int")
    rows = with_statistics(sample.select("__id", "__label", part.alias("part"), "__text"), "__text")
    rows = rows.select("row.__id", F.col("row.__label").alias("label"), "row.part", *FEATURES).collect()
    rows = [r.asDict() for r in sorted(rows, key=lambda r: r["__id"])]
    all_labels = labels.where((fold(id) != 2) & F.col(label).isin(0, 1)).agg(F.avg(label).alias("share")).first()["share"]
    n_good = sum(r["label"] for r in rows)
    n_bad = len(rows) - n_good
    weight = (all_labels / n_good) / ((1 - all_labels) / n_bad) if n_good and n_bad and 0 < all_labels < 1 else 1.0
    return learn(rows, weight=max(1.0, weight), **options)


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional expression: false at the first rule that holds, else true."""
    if not rules:
        return F.lit(True)
    chain = F
    for rule in rules:
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        chain = chain.when(holds, F.lit(False))
    return chain.otherwise(F.lit(True))


def judged(documents: DataFrame, rules: list[Rule], id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, the five counts, ``base_failed`` and ``kept``.

    ``base_failed``: under ten words, or over a fifth of the words in repeated windows. Null and empty texts
    have no words and fail. Repeated rows and null ids are judged like others; other columns are not carried.
    """
    rows = with_statistics(documents.select(F.col(id).alias("id"), F.col(text).alias("text")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.select(
        F.col("row.id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )
