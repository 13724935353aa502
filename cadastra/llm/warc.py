"""WARC archives with revisit records instead of repeated payloads.

Writing: every page becomes a header row with the digest of its payload. The headers, without
payloads, are counted and grouped by digest; one row of the smallest id of a digest becomes the response,
all others become revisit records that name it. Revisits are written from the headers alone; payloads meet
the decision only for the responses, after equal rows have been brought together. Every record gets a fresh
header.

Reading: the archive is split at its record boundaries by Spark's text reader. Digest and length of a
response are calculated anew from its payload; a revisit gets them from the response it refers to.

Everything is DataFrame expressions. Headers and payloads of equal rows are combined before they are
shuffled, and headers meet their digest in a join of written tables, which adaptive execution splits; so one
payload, or one whole row, may be a third of all pages.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cadastra.functions.cols import ColumnLike, as_col
from cadastra.sources.staging import fresh_dir, stage

#: Fixed values of the format: line end, version line, profile of a revisit by payload digest.
CRLF = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digits of base 32 as Spark's ``conv`` writes them, and as the format wants them.
_CONV_DIGITS, _BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_MARK = "WARC-Archive-Id"
#: Copies of one row that are written by one task at most.
_COPIES = 1000


def sha1_base32(data: ColumnLike) -> Column:
    """SHA-1 of binary data, 32 upper-case base-32 digits. Five hexadecimal digits are four of base 32."""
    hexa = F.sha1(as_col(data))
    parts = [F.lpad(F.conv(F.substring(hexa, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), _CONV_DIGITS, _BASE32_DIGITS)


def _payloads(pages: DataFrame, id: str, url: str, payload: str) -> DataFrame:
    """``page_id, url, payload, payload_bytes, sha256`` of every row."""
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    address = F.regexp_replace(F.col(url), r"[\x00-\x20\x7f]", "%20")
    rows = pages.select(F.col(id).cast("long").alias("page_id"), address.alias("url"), data.alias("payload"))
    return rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("sha256"))


def resolve_revisits(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """One row per distinct (id, address, payload): ``responses`` and ``revisits``, the numbers of its records.

    Of all rows with one payload, one is the response: the one with the smallest id, the smallest address
    among those; all others, repeated rows of that id included, revisit it. ``refers_to`` and ``refers_url``
    name it. Payloads under ``min_bytes``, and those of which no id is known, are responses throughout.
    Payloads are equal when SHA-256 and length are.
    """
    headers = _payloads(pages, id, url, payload).withColumn("payload_digest", sha1_base32("payload")).drop("payload")
    # Written, so that the join below has exchanges of its own, which Spark can split at a hot payload.
    counted = stage(headers.groupBy("page_id", "url", "payload_bytes", "payload_digest", "sha256").agg(F.count("*").alias("n")), "headers")
    known = counted.where(F.col("page_id").isNotNull() & (F.col("payload_bytes") >= min_bytes))
    first = known.groupBy(F.col("sha256").alias("__key"), F.col("payload_bytes").alias("__length")).agg(F.min(F.struct("page_id", "url")).alias("first"))
    same = (F.col("sha256") == F.col("__key")) & (F.col("payload_bytes") == F.col("__length"))
    joined = counted.join(stage(first, "headers"), same, "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    responses = F.when(F.col("first").isNull(), F.col("n")).otherwise(is_first.cast("long"))
    return joined.select(
        *counted.columns, responses.alias("responses"), (F.col("n") - responses).alias("revisits"),
        F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"),
    )


def _times(rows: DataFrame, number: str) -> DataFrame:
    """Each row as often as ``number`` says, numbered in ``copy`` from 0; many copies of one row are dealt to several tasks."""
    parts = rows.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(number) - 1) / _COPIES))))
    first = F.col("__part") * _COPIES
    copies = F.sequence(first, F.least(first + _COPIES, F.col(number)) - 1)
    return parts.hint("rebalance").withColumn("copy", F.explode(copies)).drop("__part")


def _record_id(page_id: ColumnLike, url: ColumnLike, sha256: ColumnLike, record_type: str, copy: ColumnLike) -> Column:
    """An id in the form of a UUID, the same whenever the record is written again."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in (page_id, sha256, copy, url)]
    h = F.md5(F.concat_ws(":", F.lit(record_type), *parts))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.substring(h, a, n), F.lit(">" if a == 21 else "-"))])


def _header(name: str, value: Column) -> Column:
    """A header line; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def write_archive(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0,
    date: str | None = None, records_per_file: int = 20_000, compression: str = "gzip",
) -> str:
    """Write one record per page below ``path`` and return the id of the archive.

    A null payload is empty. A null id or address leaves its header out; white space and control
    characters in an address become ``%20``, so that no address can add a header. Repeated rows
    give a record each, with an id of its own. Other columns are not carried. Files hold ``records_per_file``
    records at most, which also bounds the task that reads a compressed one; ``compression`` is ``gzip`` or
    ``none``. The date of the records is that of the call unless one is given.
    """
    archive = uuid.uuid4().hex  # later than all payloads, so that no payload holds it
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    decided = stage(resolve_revisits(pages, id, url, payload, min_bytes), "records")

    # Payloads travel once and for responses only, one of each id, address and payload. The join is on the
    # column they are grouped by; only rows that are several responses are dealt anew.
    key = ["page_id", "url", "sha256"]
    about = F.md5(F.concat("sha256", F.to_json(F.struct("page_id", "url")))).alias("__row")
    bodies = _payloads(pages, id, url, payload).select("payload", about).groupBy("__row").agg(F.first("payload").alias("payload"))
    wanted = decided.where("responses > 0").select(*decided.columns, about.alias("__wanted"))
    columns = [*key, "copy", "payload", "payload_bytes", "payload_digest"]
    one, several = (
        bodies.join(wanted.where(which), F.col("__row") == F.col("__wanted")) for which in ("responses = 1", "responses > 1")
    )
    responses = one.withColumn("copy", F.lit(0).cast("long")).select(*columns).unionAll(_times(several, "responses").select(*columns))
    revisits = _times(decided.where("revisits > 0"), "revisits").select(
        *key, "copy", "payload_bytes", "payload_digest", "refers_to", "refers_url"
    )

    def written(records: DataFrame, record_type: str) -> DataFrame:
        http = F.concat(
            F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
            F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF),
        ).cast("binary")
        is_response = record_type == "response"
        block = F.concat(http, F.col("payload")) if is_response else http
        about_first = [] if is_response else [
            _header("WARC-Profile", F.lit(REVISIT_PROFILE)),
            _header("WARC-Refers-To", _record_id("refers_to", "refers_url", "sha256", "response", F.lit(0))),
        ]
        head = F.concat(
            _header(_MARK, F.lit(archive)),
            _header("WARC-Type", F.lit(record_type)),
            _header("WARC-Record-ID", _record_id("page_id", "url", "sha256", record_type, "copy")),
            _header("WARC-Date", F.lit(date)),
            _header("WARC-Target-URI", F.col("url")),
            _header("WARC-Page-Number", F.col("page_id")),
            *about_first,
            _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            _header("Content-Type", F.lit("application/http; msgtype=response")),
            _header("Content-Length", F.octet_length(block)),
            F.lit(CRLF),
        )
        return records.select(F.concat(F.lit(VERSION + CRLF).cast("binary"), head.cast("binary"), block).cast("string").alias("value"))

    # The text writer puts the bytes of a value as they are, and the empty lines between records behind it.
    records = written(responses, "response").unionAll(written(revisits, "revisit"))
    writer = records.write.option("lineSep", CRLF * 2).option("compression", compression)
    writer.option("maxRecordsPerFile", records_per_file).text(path)
    return archive


def read_archive(spark: SparkSession, path: str, archive: str) -> DataFrame:
    """Records of an archive of :func:`write_archive`, without its revisits resolved.

    ``page_id, record_id, record_type, refers_to_record, url, declared_digest, payload, payload_digest,
    payload_bytes``; the last three are null for revisits. Records are split at the header that holds
    the id of the archive.
    """
    boundary = f"{VERSION}{CRLF}{_MARK}: {archive}{CRLF}"
    parts = spark.read.option("lineSep", boundary).text(path).where(F.octet_length("value") > 0).select(F.col("value").cast("binary").alias("raw"))
    # Positions in bytes: the same text read as one character per byte.
    parts = parts.withColumn("bytes", F.decode("raw", "ISO-8859-1"))
    parts = parts.withColumn("split", F.instr("bytes", CRLF * 2))
    head = F.concat(F.lit(CRLF), F.decode(F.substring("raw", F.lit(1), F.col("split") - 1), "UTF-8"), F.lit(CRLF))

    def value(name: str) -> Column:
        return F.nullif(F.regexp_extract("head", rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))

    parts = parts.withColumn("head", head).withColumn("length", value("Content-Length").cast("int"))
    block = F.substring("raw", F.col("split") + 4, F.col("length"))
    body = F.instr(F.substring("bytes", F.col("split") + 4, F.col("length")), CRLF * 2) + 4
    response = value("WARC-Type") == "response"
    records = parts.select(
        value("WARC-Page-Number").cast("long").alias("page_id"), value("WARC-Record-ID").alias("record_id"),
        value("WARC-Type").alias("record_type"), value("WARC-Refers-To").alias("refers_to_record"),
        value("WARC-Target-URI").alias("url"), F.regexp_replace(value("WARC-Payload-Digest"), "^sha1:", "").alias("declared_digest"),
        F.when(response, F.substring(block, body, F.lit(2**31 - 1))).alias("payload"),
    )
    return records.select("*", sha1_base32("payload").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))


def resolve_records(records: DataFrame) -> DataFrame:
    """One row per record: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A revisit takes id, length and digest of the response it refers to.
    """
    skinny = records.drop("payload", "url")
    originals = skinny.where("record_type = 'response'").select(
        F.col("record_id").alias("__record"), F.col("page_id").alias("__page"), F.col("payload_bytes").alias("__bytes"),
        F.col("payload_digest").alias("__digest"),
    ).distinct()
    joined = skinny.join(originals, F.col("refers_to_record") == F.col("__record"), "left")
    return joined.select(
        "page_id", F.coalesce("payload_bytes", "__bytes").alias("payload_bytes"), F.coalesce("payload_digest", "__digest").alias("payload_digest"),
        "record_type", F.col("__page").alias("refers_to"),
    )


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to a new archive in the shared scratch folder and return its resolved records."""
    path = fresh_dir(pages.sparkSession, "warc")
    archive = write_archive(pages, path, **options)
    return resolve_records(read_archive(pages.sparkSession, path, archive))
