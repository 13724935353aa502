"""Prefix trie of conversations, built by van Emde Boas recursion over the depth.

The sequences of turns are cut at half depth. The cut prefixes are named; what lies above the cut is an
upper trie, what lies below is a forest of tries rooted at the named prefixes, and all of them are cut again
in the same way until they are one turn deep. Each round works on all tries of its height at once:

* On the way down, ``segments`` hold names of runs of 1, 2, 4 ... turns, each made of two shorter ones. A
  round cuts the ranges of ``2 * half`` depths in the middle: the name of a cut prefix is made of the name of
  its range's root and the name of the ``half`` turns from there. Every depth is the cut of one round.
* On the way up, a round joins an upper trie and its lower forests: the totals that the roots of the forests
  have so far are grafted on all their ancestors in the upper trie. Rounds go from one turn to the whole
  depth, so afterwards every node has the total of its subtree.

Names are SHA-256 digests of what they name, so equal prefixes get equal names without asking each other. A
node goes on as its smallest member and its depth.

Scale and skew
--------------
Texts are digested where they are read and do not travel. A round moves one row per segment, prefix or
grafted total, and their numbers halve from round to round on the way up; the number of rounds is the
logarithm of the longest conversation. A conversation is never gathered in one task: its turns are numbered
in a range partitioning that cuts long conversations, equal rows included, and its segments are grouped by
two. What many conversations share is pre-aggregated before it is shuffled, or joined from written tables, so
that Spark can split the join. Members that end in one node are joined to texts of at most :data:`CHUNK` ids
before one task digests them in their order, one chunk at a time. Every round is written down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cadastra.llm.words import arrow_schema, rows_of
from cadastra.operators.windows import row_numbers
from cadastra.sources.inline import local_table
from cadastra.sources.staging import stage

CHUNK = 1024
#: A conversation borrows the first turns of the first conversation of its hundred; below six of them.
GROUP, BORROWED = 100, 6
_NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turn_name(role: Column, text: Column) -> Column:
    """Digest of a turn. The length of the role tells where the text begins."""
    return _digest(F.char_length(role).cast("string"), F.lit(":"), role, text)


def ordered_turns(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, name, chars, row_number``: turns in the order of conversation and turn, null first, ties by name."""
    role_, text_ = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), turn_name(role_, text_).alias("name"),
        F.char_length(text_).cast("long").alias("chars"), F.monotonically_increasing_id().alias("place"),
    )
    # The place tells equal rows apart, so that any number of them is dealt to several tasks.
    return row_numbers(rows, ["conv_id", F.asc_nulls_first("turn"), "name", "place"]).drop("turn", "place")


def rebuilt_turns(
    conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    group: int = GROUP, borrowed: int = BORROWED,
) -> tuple[DataFrame, DataFrame]:
    """Turns (``conv_id, at`` from 0, ``name, chars``) and members (``conv_id, turns``) of the rebuilt conversations.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % group``, fewer if that has fewer,
    then its own from the ``h``-th on; ``h`` is ``crc32`` of the decimal id modulo ``borrowed``.
    """
    numbered = ordered_turns(conversations, id, turn, role, text)
    found = numbered.groupBy("conv_id").agg(F.min("row_number").alias("first"), F.count("*").alias("own"))
    found = stage(found.withColumn("donor", F.col("conv_id") - F.col("conv_id") % group)
                  .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % borrowed), "members")
    lengths = found.select(F.col("conv_id").alias("__donor"), F.col("own").alias("__own"))
    plan = found.join(lengths, F.col("donor") == F.col("__donor"), "left")
    plan = stage(plan.select("conv_id", "first", "own", "donor", "h", F.least("h", F.coalesce("__own", F.lit(0))).alias("taken")), "members")

    known = plan.select(F.col("conv_id").alias("__conv"), "first", "h", "taken")
    placed = stage(numbered.join(known, F.col("conv_id") == F.col("__conv")).withColumn("at", F.col("row_number") - F.col("first")), "turns")
    own = placed.where(F.col("at") >= F.col("h")).select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "name", "chars")
    # At most borrowed - 1 turns of a donor, for at most 2 * group conversations.
    heads = placed.where((F.col("at") < borrowed - 1) & (F.col("conv_id") % group == 0)).select(F.col("conv_id").alias("__donor"), "at", "name", "chars")
    lent = plan.where("taken > 0").select("conv_id", "donor", "taken").join(heads, F.col("donor") == F.col("__donor")).where(F.col("at") < F.col("taken"))
    turns = stage(own.unionByName(lent.select("conv_id", "at", "name", "chars")), "turns")
    return turns, plan.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"))


def named_prefixes(turns: DataFrame, members: DataFrame, height: int) -> DataFrame:
    """``conv_id, depth, node, chars``: the name of every prefix, and the length of its last text.

    ``height`` is a power of two above the number of turns of every conversation.
    """
    segments = {1: turns.withColumnRenamed("at", "number")}
    half = 1
    while 2 * half < height:
        right = F.col("number") % 2 == 1
        pairs = segments[half].groupBy("conv_id", F.shiftright("number", 1).alias("number")).agg(
            F.min(F.when(~right, F.col("name"))).alias("left"), F.min(F.when(right, F.col("name"))).alias("right"),
            F.min(F.when(right, F.col("chars"))).alias("chars"),
        )
        longer = pairs.where("right is not null").select("conv_id", "number", _digest(F.col("left"), F.col("right")).alias("name"), "chars")
        segments[2 * half] = stage(longer, "segments")
        half *= 2

    named: list[DataFrame] = []
    roots = members.where("turns > 0").select("conv_id", F.lit(0).cast("long").alias("depth"), _digest(F.lit("")).alias("node"))
    for half in sorted(segments, reverse=True):  # ranges of 2 * half depths are cut in the middle
        upper = segments[half].where(F.col("number") % 2 == 0)
        upper = upper.select(F.col("conv_id").alias("__conv"), (F.col("number") * half).alias("__root"), "name", "chars")
        cut = roots.join(upper, (F.col("conv_id") == F.col("__conv")) & (F.col("depth") == F.col("__root")))
        cut = stage(cut.select("conv_id", (F.col("depth") + half).alias("depth"), _digest(F.col("node"), F.col("name")).alias("node"), "chars"), "prefixes")
        named.append(cut)
        roots = roots.unionByName(cut.drop("chars"))
    return reduce(DataFrame.unionByName, named)


def subtree_totals(values: DataFrame, paths: DataFrame, height: int, columns: list[str]) -> DataFrame:
    """``conv_id, depth`` and the sums of ``columns`` over the subtree of every node, its top included.

    ``paths`` has the node (``top, depth``) of every prefix (``conv_id, depth``). A node's ancestors are on
    the path of its smallest member.
    """
    sums = [F.sum(c).alias(c) for c in columns]
    parts, half = [values], 1
    while half < height:
        place = F.col("depth") - 1
        at_cut = reduce(DataFrame.unionByName, parts).where((place % (2 * half)) == half)  # tops of lower forests
        lower = at_cut.groupBy("conv_id", "depth").agg(*sums)
        above = lower.withColumn("above", F.explode(F.sequence(F.col("depth") - half, F.col("depth") - 1))).drop("depth")
        on = (F.col("conv_id") == F.col("__conv")) & (F.col("above") == F.col("depth"))
        found = above.join(paths.select(F.col("conv_id").alias("__conv"), "depth", "top"), on)
        parts.append(stage(found.groupBy(F.col("top").alias("conv_id"), "depth").agg(*sums), "grafts"))
        half *= 2
    return reduce(DataFrame.unionByName, parts).groupBy("conv_id", "depth").agg(*sums)


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of one node after another, comma-joined; rows are sorted by node and chunk."""
    schema, now, state = arrow_schema("conv_id long, depth long, ends_sha256 string"), None, None
    for batch in batches:
        done = []
        for top, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (top, depth) != now:
                if state:
                    done.append((*now, state.hexdigest()))
                now, state = (top, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield rows_of(schema, dict(zip(schema.names, zip(*done))))
    if state:
        yield rows_of(schema, dict(zip(schema.names, zip((*now, state.hexdigest())))))


def _ends(members: DataFrame, paths: DataFrame, lowest: int | None) -> DataFrame:
    """``conv_id, depth, ends_sha256`` of the nodes in which conversations end."""
    numbered = stage(row_numbers(members, "conv_id").select("conv_id", "turns", F.floor((F.col("row_number") - 1) / CHUNK).alias("chunk")), "ends")
    tops = paths.select(F.col("conv_id").alias("__conv"), "depth", "top")
    ends = numbered.where("turns > 0").join(tops, (F.col("conv_id") == F.col("__conv")) & (F.col("turns") == F.col("depth")))
    empty = numbered.where("turns = 0").select(F.lit(lowest).cast("long").alias("top"), F.lit(0).cast("long").alias("depth"), "chunk", "conv_id")
    ids = ends.select("top", "depth", "chunk", "conv_id").unionByName(empty).groupBy("top", "depth", "chunk").agg(F.collect_list("conv_id").alias("ids"))
    texts = ids.select("top", "depth", "chunk", F.array_join(F.array_sort("ids").cast("array<string>"), ",").alias("ids"))
    dealt = texts.repartition("top", "depth").sortWithinPartitions("top", "depth", "chunk")
    return dealt.mapInArrow(_digest_chunks, "conv_id bigint, depth bigint, ends_sha256 string")


def trie_nodes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node of the trie of the given sequences, in the columns of :func:`conversation_trie`.

    ``turns`` has ``conv_id, at`` (0, 1, 2 ... in every conversation), ``name`` and ``chars``; ``members`` has
    every ``conv_id`` once with its number of ``turns``, which may be 0.
    """
    spark = turns.sparkSession
    deepest, lowest, total = members.agg(F.max("turns"), F.min("conv_id"), F.count("*")).first()
    if not total:
        return spark.createDataFrame([], _NODE)
    height = 1 << int(deepest).bit_length()
    prefixes = named_prefixes(turns, members, height) if deepest else turns.select("conv_id", F.col("at").alias("depth"), F.col("name").alias("node"), "chars")
    nodes = stage(prefixes.groupBy("node").agg(
        F.min("conv_id").alias("top"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("chars").alias("chars")
    ), "nodes")
    paths = prefixes.join(nodes.select(F.col("node").alias("__node"), "top"), F.col("node") == F.col("__node"))
    paths = stage(paths.select("conv_id", "depth", "top"), "paths")

    parents = paths.select(F.col("conv_id").alias("__conv"), F.col("depth").alias("__depth"), F.col("top").alias("parent"))
    nodes = nodes.join(parents, (F.col("top") == F.col("__conv")) & (F.col("depth") - 1 == F.col("__depth")), "left")
    nodes = nodes.select(F.col("top").alias("conv_id"), "depth", F.coalesce("parent", F.lit(lowest)).cast("long").alias("parent_conv_id"), "n_convs", "chars")
    nodes = stage(nodes, "nodes")
    children = nodes.groupBy(F.col("parent_conv_id").alias("__conv"), (F.col("depth") - 1).alias("__depth")).agg(F.count("*").alias("children"))
    same = (F.col("conv_id") == F.col("__conv")) & (F.col("depth") == F.col("__depth"))
    nodes = stage(nodes.join(children, same, "left").select(*nodes.columns, F.coalesce("children", F.lit(0)).cast("long").alias("n_children")), "nodes")

    own = nodes.select(
        "conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")
    )
    totals = stage(subtree_totals(own, paths, height, ["n_leaves", "saved_tokens"]), "totals")
    top = totals.where("depth = 1").agg(F.count("*"), F.coalesce(F.sum("n_leaves"), F.lit(1)), F.coalesce(F.sum("saved_tokens"), F.lit(0))).first()
    root = local_table(spark, [(lowest, 0, None, total, *top)], ", ".join(_NODE.split(", ")[:-1]))
    below = nodes.join(totals.withColumnsRenamed({"conv_id": "__conv", "depth": "__depth"}), same)
    ends = _ends(members, paths, lowest).withColumnsRenamed({"conv_id": "__conv", "depth": "__depth"})
    everything = stage(below.select(*root.columns).unionByName(root), "nodes")
    nothing = hashlib.sha256(b"").hexdigest()
    return everything.join(ends, same, "left").select(*root.columns, F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def conversation_trie(
    conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    group: int = GROUP, borrowed: int = BORROWED,
) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node: the smallest member as ``conv_id``, ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` of
    the subtree, and ``ends_sha256`` over the ids of the members that end there.

    A null role or text is an empty one; turns go by ``turn``, null first, equal ones by the digest of role
    and text, so repeated rows are repeated turns. Rows without an id take no part. An empty table has no
    nodes, not even a root. Conversations without turns end in the root. Other columns are not read.
    """
    return trie_nodes(*rebuilt_turns(conversations, id, turn, role, text, group, borrowed))
