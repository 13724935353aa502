"""Mixing sources to target weights without repeating any source too often.

Targets: the wanted size is dealt to the sources by weight; a source whose share is over ``max_epochs``
times its size is clamped there and the excess is dealt to the others by weight, again and again until
nothing is over. Each round is one aggregate over the table of sources and brings two numbers to the
driver.

Sampling: a source at 1.6 epochs takes every text once and texts worth 0.6 of its size once more. Those
are the first ones in the order of a seeded hash of id and text, up to the wanted size, so a source
misses its target by half a text at most and a rerun takes the same texts. The order is cut without
sorting a source: sizes are summed per leading hash digits (4,096 sums a source), and only the rows of
the one slice in which the cut falls are put in order, 1/4096 of the source.

Rows with equal id and text have one place in that order. Where the cut falls among them, as many of them
are taken as the target asks for; they are equal, so any will do, and they are numbered in a range
partitioning, however many they are. Only sizes, hashes and sources are shuffled, not texts, but for the
rows of that one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cadastra.functions.cols import ColumnLike, as_col
from cadastra.llm.words import n_words
from cadastra.operators.windows import row_numbers
from cadastra.sources.staging import stage

WEIGHTS = (3, 1, 2)
SLICE_DIGITS = 3


def draw(seed: str, id: ColumnLike, text: ColumnLike) -> Column:
    """Seeded hash of a row: 32 hexadecimal digits, null id and null text like empty ones."""
    own = F.coalesce(as_col(id).cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), own, F.md5(F.coalesce(as_col(text), F.lit("")))))


def _slice(hashed: ColumnLike) -> Column:
    return F.conv(F.substring(as_col(hashed), 1, SLICE_DIGITS), 16, 10).cast("int")


def weighted_sources(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``source, source_size, weight``: weights in turn, sources by code point, null last."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = row_numbers(totals, F.col("source").asc_nulls_last(), "__number")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return numbered.select("source", "source_size", F.get(turn, (F.col("__number") - 1) % len(weights)).alias("weight"))


def with_targets(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to ``source, source_size, weight`` by capped water-filling.

    ``share`` is the wanted size as a multiple of all sizes. When even ``max_epochs`` of every source
    are less than that, every source gets ``max_epochs``.
    """
    sources = stage(sources, "sources")
    cap = F.col("source_size") * F.lit(float(max_epochs))
    whole = sources.agg(F.sum("source_size").cast("double").alias("size"), F.sum("weight").alias("weight")).first()
    wanted = (whole["size"] or 0.0) * share
    level, clamped = wanted / whole["weight"] if whole["weight"] else 0.0, 0
    while True:
        over = F.col("weight") * F.lit(level) > cap
        now = sources.agg(
            F.count_if(over).alias("n"), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("free"),
        ).first()
        if now["n"] == clamped:
            break
        clamped = now["n"]
        if not now["free"]:
            level = float("inf")
            break
        level = (wanted - now["taken"]) / now["free"]
    raised = F.when(F.col("weight") > 0, F.col("weight") * F.lit(level)).otherwise(F.lit(0.0))
    return sources.withColumn("target", F.least(raised, cap))


def _with_cuts(sizes: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sources with whole epochs and the slice their order is cut in; hashes of that slice that are taken once more."""
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    sources = sources.withColumn("whole", rate.cast("int")).withColumn("more", F.col("target") - F.col("whole") * F.col("source_size"))
    slices = sizes.groupBy("source", _slice("draw").alias("slice")).agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, 0))
    slices = slices.withColumn("upto", upto).withColumnRenamed("source", "__source")
    same = F.col("source").eqNullSafe(F.col("__source"))
    cut = slices.join(sources, same).where(F.col("upto") > F.col("more"))
    cut = cut.groupBy("__source").agg(F.min("slice").alias("cut"), F.min(F.col("upto") - F.col("size")).alias("before"))
    plan = sources.join(cut, same, "left").select(*sources.columns, "cut", "before")
    plan = stage(plan, "mixing")

    inside = sizes.withColumnRenamed("source", "__source").join(plan, same).where(_slice("draw") == F.col("cut"))
    drawn = inside.groupBy("source", "draw", "more", "before").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    earlier = F.sum("size").over(W.partitionBy("source").orderBy("draw").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    # Rows of equal id and text, each of the same size: those whose middle lies before the cut.
    each = F.try_divide(F.col("size"), F.col("n"))
    inside_cut = F.ceil(F.try_divide(F.col("more") - F.col("before") - earlier, each) - 0.5)
    taken = drawn.withColumn("take", F.least("n", F.coalesce(inside_cut, F.lit(0)))).where("take > 0")
    return plan, stage(taken.select(F.col("source").alias("__source"), F.col("draw").alias("__draw"), "take", F.col("n").alias("of")), "mixing")


def with_copies(rows: DataFrame, plan: DataFrame, taken: DataFrame, source: str, hashed: str) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` (0 and more) to rows that carry source and hash."""
    added = plan.select(F.col("source").alias("__source"), "source_size", "target", "whole", "more", "cut")
    wide = rows.join(added, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
    # Without a cut the fraction takes everything, or there is nothing to take.
    at = F.coalesce(F.col("cut"), F.lit(1 << 4 * SLICE_DIGITS))
    more = (_slice(hashed) < at) & (F.col("more") > 0)
    keep = [*rows.columns, "source_size", "target"]
    sure = wide.where(_slice(hashed) != at).select(*keep, (F.col("whole") + more.cast("int")).alias("copies"))
    # Only the slices with a cut meet the drawn hashes.
    hit = F.col(source).eqNullSafe(F.col("__source")) & (F.col(hashed) == F.col("__draw"))
    edge = wide.where(_slice(hashed) == at).join(taken, hit, "left")
    split = F.col("take") < F.col("of")
    alike = edge.where(F.col("take").isNull() | ~split).select(*keep, (F.col("whole") + F.col("__draw").isNotNull().cast("int")).alias("copies"))
    # Equal rows of which some are taken: one place in the order of each source at most.
    parts = row_numbers(edge.where(split).withColumn("__place", F.monotonically_increasing_id()), [source, hashed, "__place"], "__number")
    first = parts.groupBy(F.col(source).alias("__s"), F.col(hashed).alias("__h")).agg(F.min("__number").alias("__first"))
    parts = parts.join(first, F.col(source).eqNullSafe(F.col("__s")) & (F.col(hashed) == F.col("__h")))
    some = F.col("whole") + (F.col("__number") - F.col("__first") < F.col("take")).cast("int")
    return sure.unionAll(alike).unionAll(parts.select(*keep, some.alias("copies")))


def mixing(
    documents: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS,
    share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of all rows (``id, source, size, draw``), the plan by source, and the hashes drawn from cut slices.

    The size of a text is its number of words. A null source is a source of its own, the last one.
    """
    sizes = stage(documents.select(
        F.col(id).alias("id"), F.col(source).alias("source"), n_words(text).alias("size"), draw(seed, id, text).alias("draw")
    ), "sizes")
    plan, taken = _with_cuts(sizes, with_targets(weighted_sources(sizes, weights), share, max_epochs))
    return sizes, plan, taken


def mixed_sizes(documents: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target`` of its source, ``copies`` and ``taken`` words.

    Null and empty texts have size 0 and take nothing. An empty table gives an empty result.
    """
    sizes, plan, taken = mixing(documents, id, **options)
    rows = with_copies(sizes, plan, taken, "source", "draw")
    return rows.select(
        F.col("id").alias(id), "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(documents: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", **options) -> DataFrame:
    """The documents of the mix, all columns, each row as often as it is taken.

    Texts are joined with the plan (one row per source) and, for 1/4096 of the rows, with the drawn
    hashes; both are small enough to be broadcast unless there are very many sources.
    """
    _, plan, taken = mixing(documents, id, text, source, seed=seed, **options)
    packed = documents.select(F.struct(*documents.columns).alias("__row"), F.col(source).alias("__from"), draw(seed, id, text).alias("__hash"))
    rows = with_copies(packed, plan, taken, "__from", "__hash").where("copies > 0")
    return rows.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")).select("__row.*")
