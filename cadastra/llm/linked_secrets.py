"""Secrets in texts: certain patterns, and weak candidates that are confirmed by their counterparts.

Credentials come in parts: an identifier, a secret, and the endpoint they belong to. What looks weakly
like one part (an upper-case code, a long mixed token, an address) is common in clean text and only
reported when a complementary part stands within ``scope`` characters of it in the same text:
identifiers need a secret, secrets an identifier or an endpoint, endpoints a secret.

What keeps clean text clean:

* A token most of whose characters stand in runs of small letters is made of words, such as a path, and
  no candidate.
* A mixed token that lies in an address, such as the title in the path of a page, is no part beside
  addresses, its own or others: it counts with identifiers only.
* A host with a port is an endpoint if its name has a dot or is ``localhost``; ``section:2024`` is none.

An address with credentials (``scheme://user:secret@host``, or a long token before the ``@``) holds two
parts that complement each other: the secret is reported as ``login``, the whole address as ``endpoint``.

The interval join is a sweep: the parts of a text in the order of their start, with the largest end of
each role so far and the smallest start of each role still to come. It is linear in the parts, no
pairs are made. Positions come from the lengths of the matches and of what lies between them, summed
in a window over the matches of one text.

All of it is DataFrame expressions. Texts are scanned once, into a table of match lengths that is
written down; texts are not shuffled, and windows hold the matches of a single text. The patterns look
neither ahead nor behind and bound no length, so the SQL counterpart and the tests take the same ones.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cadastra.sources.staging import stage

#: The certain patterns, leftmost and not overlapping within a kind. Runs are maximal, so a
#: least length inside the pattern finds the same runs as one tested afterwards; the value of an
#: assignment must be tested afterwards, because a short one uses up its text.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak ones: token runs, told apart below; secrets in addresses; addresses.
TOKEN = r"[A-Za-z0-9+/_-]{16,}"
#: Behind "://": a name and a secret that is not just a port, or a long token alone.
LOGIN = r"""://(?:[^\x00-\x20"'<>/?#@:]*:(?:[0-9]*[^\x00-\x20"'<>/?#@0-9][^\x00-\x20"'<>?#@]*|[0-9]+)|[^\x00-\x20"'<>/?#@:]{20,})@"""
ENDPOINT = (
    r"""[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20"'<>]+|[0-9]{1,3}(?:\.[0-9]{1,3}){3}"""
    r"""|(?:localhost|(?:[A-Za-z0-9_-]+\.)+[A-Za-z][A-Za-z0-9-]*):[0-9]{2,5}"""
)
#: Runs of small letters, as words have them.
WORDY = r"[a-z]{4,}"

SCOPE = 200
LEAST_VALUE = 6
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "token": TOKEN, "login": LOGIN, "endpoint": ENDPOINT}
BASE = ("assign", "access", "hex")
#: Order of kinds at one start; "token" runs become "key_id" or "blob" or nothing.
KINDS = (*BASE, "key_id", "blob", "login", "endpoint")
ROLES = {
    "identifier": ("access", "key_id"), "secret": ("assign", "hex", "blob", "login"), "endpoint": ("endpoint",),
}
COMPLEMENTS = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("secret",)}


def _lengths(text: Column, kind: str) -> Column:
    """Array of the matches: kind, number, characters before the span since the last match, width, and characters of the match behind the span."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    between = F.split(text, PATTERNS[kind], -1)
    value = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(2)) if kind == "assign" else found

    def one(match: Column, number: Column) -> Column:
        name, skipped, behind = F.lit(kind), F.lit(0), F.lit(0)
        if kind == "assign":
            name = F.when(F.char_length(F.get(value, number)) >= LEAST_VALUE, F.lit(kind))
        if kind == "token":
            digit = match.rlike("[0-9]")
            mixed = digit & match.rlike("[A-Z]") & match.rlike("[a-z]")
            wordy = 2 * F.char_length(F.regexp_replace(match, WORDY, "")) < F.char_length(match)
            name = F.when(match.rlike("^[A-Z0-9]{16,32}$") & digit & match.rlike("[A-Z]"), F.lit("key_id")).when(
                (F.char_length(match) >= 32) & mixed & ~wordy, F.lit("blob")
            )
        if kind == "login":  # the secret stands behind the first colon after "://", if there is one, and before "@"
            skipped, behind = 3 + F.instr(F.substring(match, 4, 2**31 - 1), ":"), F.lit(1)
        return F.struct(
            F.lit(kind).alias("pattern"), number.alias("number"), (F.char_length(F.get(between, number)) + skipped).alias("before"),
            (F.char_length(match) - skipped - behind).alias("width"), behind.alias("behind"), name.alias("kind"),
        )

    none = F.array().cast("array<struct<pattern:string,number:int,before:int,width:int,behind:int,kind:string>>")
    return F.when(F.size(found) > 0, F.transform(found, one)).otherwise(none)


def scan(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, matches``: lengths of all matches of each row, written to the scratch folder."""
    content = F.coalesce(F.col(text), F.lit(""))
    matches = F.concat(*[_lengths(content, kind) for kind in PATTERNS])
    rows = documents.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(content).alias("fingerprint"), matches.alias("matches"))
    return stage(rows, "secrets")


def spans(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, fingerprint, kind, start, end`` of every reported span, once per distinct row key.

    Starts and ends count characters from 0, the end is exclusive. Weak spans that overlap a certain
    one are left out.
    """
    key = ["doc_id", "fingerprint"]
    # Repeated rows have the same matches; one of them stands for all.
    matches = scanned.where(F.size("matches") > 0).distinct().select(*key, F.explode("matches").alias("m")).select(*key, "m.*")
    order = W.partitionBy(*key, "pattern").orderBy("number").rowsBetween(W.unboundedPreceding, 0)
    placed = matches.withColumn("end", F.sum(F.col("before") + F.col("width") + F.col("behind")).over(order) - F.col("behind"))
    placed = placed.where(F.col("kind").isNotNull()).withColumn("start", F.col("end") - F.col("width"))

    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    sweep = W.partitionBy(*key).orderBy("start", rank)
    earlier, later = sweep.rowsBetween(W.unboundedPreceding, -1), sweep.rowsBetween(1, W.unboundedFollowing)
    certain = F.col("kind").isin(*BASE)

    def overlaps(members: Column) -> Column:
        before = F.max(F.when(members, F.col("end"))).over(earlier) > F.col("start")
        after = F.min(F.when(members, F.col("start"))).over(later) < F.col("end")
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    placed = placed.withColumn("__inside", (F.col("kind") == "blob") & overlaps(F.col("kind") == "endpoint"))

    def near(role: str, other: str) -> Column:
        member = F.col("kind").isin(*ROLES[other])
        if role == "endpoint":
            member = member & ~F.col("__inside")
        before = F.col("start") - F.max(F.when(member, F.col("end"))).over(earlier) <= scope
        after = F.min(F.when(member, F.col("start"))).over(later) - F.col("end") <= scope
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    def linked(role: str, other: str) -> Column:
        return near(role, other) & ~F.col("__inside") if other == "endpoint" else near(role, other)

    confirmed = [
        F.col("kind").isin(*kinds) & reduce(or_, [linked(role, other) for other in COMPLEMENTS[role]]) for role, kinds in ROLES.items()
    ]
    weak = ~overlaps(certain) & reduce(or_, confirmed)
    reported = placed.withColumn("__keep", certain | weak).where("__keep")
    return reported.select(*key, "kind", F.col("start").cast("int"), F.col("end").cast("int"))


def _by_row(found: DataFrame) -> DataFrame:
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    # No more than the matches of one text.
    listed = F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind")))
    return found.groupBy("doc_id", "fingerprint").agg(listed.alias("spans")).toDF("__id", "__print", "spans")


def _same_row() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("fingerprint") == F.col("__print"))


def secret_spans(documents: DataFrame, id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: id and ``spans``, an array of (start, rank, end, kind) by start, then kind.

    Null and empty texts have an empty array. Repeated rows and null ids are rows of their own; other
    columns are not carried.
    """
    scanned = scan(documents, id, text)
    joined = scanned.drop("matches").join(_by_row(spans(scanned, scope)), _same_row(), "left")
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return joined.select(F.col("doc_id").alias(id), F.coalesce("spans", none).alias("spans"))


def span_text(listed: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(listed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(documents: DataFrame, id: str = "doc_id", text: str = "text", mask: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """The documents, all columns, with every run of reported spans in the text replaced by ``mask``.

    Rows without a span, null texts included, stay as they are.
    """
    found = spans(scan(documents, id, text), scope)
    key = ["doc_id", "fingerprint"]
    order = W.partitionBy(*key).orderBy("start", "end")
    apart = F.col("start") > F.coalesce(F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    runs = found.withColumn("__run", F.sum(apart.cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    runs = runs.groupBy(*key, "__run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = runs.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__runs")).toDF("__id", "__print", "__runs")
    same = F.col(id).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__print"))
    joined = documents.withColumn("__text", F.col(text)).join(runs, same, "left")
    count = F.size("__runs")

    def piece(i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("__runs"), i - 1)["end"])
        end = F.when(i == count, F.char_length("__text")).otherwise(F.get(F.col("__runs"), i)["start"])
        return F.substring(F.col("__text"), begin + 1, end - begin)

    rebuilt = F.array_join(F.transform(F.sequence(F.lit(0), count), piece), mask)
    cleaned = F.when(F.col("__runs").isNull(), F.col("__text")).otherwise(rebuilt)
    return joined.select(*[cleaned.alias(c) if c == text else F.col(c) for c in documents.columns])
