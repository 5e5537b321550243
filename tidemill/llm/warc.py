"""WARC archives: pages are written as request, response (or revisit) and metadata records, and archives are read
back as one nested row per capture.

Writing. A page whose payload of at least ``REVISIT_BYTES`` bytes was captured under a larger page_id becomes a
revisit of it: digests are counted first, as narrow rows combined before the shuffle, and only pages of a digest
that comes twice meet the chosen one. Records are rows of one text column, and Spark's text writer ends each with
the two line ends that the format asks for; files are compressed. Pages are written by classes of size (equal payloads are
in one class), each with as many records to a file as keep it to about ``FILE_BYTES``; a larger page has its own.

Reading. Whole files are cut into records by their own lengths, so a payload may hold
anything. What is read is measured and hashed, and fails where its record tells another digest. Request and metadata
records name the response they belong to (WARC-Concurrent-To) and meet it by that identifier, in one shuffle after one
parse; revisits are joined to the record they refer to, and their length and digest are those of its payload.

Defined results: a null html is an empty payload; a null url has no target; a null page_id is an unnumbered capture,
smaller than any other; rows equal in page_id and payload are captures that share a record id, and each stays;
an empty table gives no files and no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.llm.common import shared_folder, written

REVISIT_BYTES = 1000
FILE_BYTES = 32 << 20
FILE_RECORDS = 1500
CLASSES = (64 << 10, 1 << 20, 8 << 20, 1 << 62)  # payload bytes below which pages share files
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
END = "\r\n"


def _id(*parts: Column) -> Column:
    """A record id made of what it names, in the form of a UUID."""
    hashed = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", *[F.substring(hashed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(kind: Column, fields: dict[str, Column], block: Column) -> Column:
    """One record without its closing line ends; fields that are null are left out."""
    named = [F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in fields.items()]
    length = F.octet_length(block).cast("string")
    head = F.concat_ws(END, F.lit(VERSION), F.concat(F.lit("WARC-Type: "), kind), *named,
                       F.concat(F.lit("Content-Length: "), length))
    return F.concat(head, F.lit(END + END), block)


def choose(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, payload, digest, bytes) with ``first``: the page that a revisit refers to, or null."""
    large = pages.where(F.col("bytes") >= revisit_bytes).select(F.col("digest").alias("__digest"), "page_id")
    again = large.groupBy("__digest").agg(F.max("page_id").alias("__last"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 and __last is not null").drop("n")
    met = pages.join(again, F.col("digest") == F.col("__digest"), "left")
    first = F.when(~F.col("page_id").eqNullSafe(F.col("__last")), F.col("__last"))
    return met.withColumn("first", first).drop("__digest", "__last")


def records(pages: DataFrame) -> DataFrame:
    """One text column ``value``: three records per chosen page, side by side."""
    revisit = F.col("first").isNotNull()
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    url, date = F.col("url"), F.lit(DATE)
    mine = _id(F.lit("response"), F.col("page_id"), F.col("digest"))
    path = F.regexp_replace(F.coalesce(url, F.lit("/")), r"^[a-z]+://[^/]*|[\r\n]", "")
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-z]+://([^/\r\n]*)", 1)
    ask = F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END + END))
    answer = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}Content-Length: "),
        F.col("bytes").cast("string"), F.lit(END + END),
        F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    about = F.concat(F.lit("pageId: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END))
    target = F.regexp_replace(url, r"[\r\n]", "")
    http = lambda what: F.lit(f"application/http; msgtype={what}")
    three = F.array(
        _record(F.lit("request"), {
            "WARC-Record-ID": _id(F.lit("request"), F.col("page_id"), F.col("digest")), "WARC-Date": date,
            "WARC-Target-URI": target, "WARC-Concurrent-To": mine, "Content-Type": http("request")}, ask),
        _record(F.when(revisit, "revisit").otherwise("response"), {
            "WARC-Record-ID": mine, "WARC-Date": date, "WARC-Target-URI": target, "WARC-Payload-Digest": digest,
            "WARC-Profile": F.when(revisit, PROFILE),
            "WARC-Refers-To": F.when(revisit, _id(F.lit("response"), F.col("first"), F.col("digest"))),
            "Content-Type": http("response")}, answer),
        _record(F.lit("metadata"), {
            "WARC-Record-ID": _id(F.lit("metadata"), F.col("page_id"), F.col("digest")), "WARC-Date": date,
            "WARC-Target-URI": target, "WARC-Concurrent-To": mine,
            "Content-Type": F.lit("application/warc-fields")}, about),
    )
    return pages.select(F.explode(three).alias("value"))


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          revisit_bytes: int = REVISIT_BYTES, file_records: int = FILE_RECORDS) -> None:
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    for low, high in zip((0, *CLASSES), CLASSES):
        some = rows.where((F.col("bytes") >= low) & (F.col("bytes") < high))
        (records(choose(some, revisit_bytes)).write.option("lineSep", END + END).option("compression", "gzip")
         .option("maxRecordsPerFile", min(file_records, max(FILE_BYTES // high, 1) * 3)).text(f"{folder}/below-{high}"))


def _unpacked(data: bytes) -> Iterator[bytes]:
    """Decompressed pieces of a file that may be plain, one gzip member or many."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data:
        member = zlib.decompressobj(31)
        piece = member.decompress(data, 1 << 20)
        while piece:
            yield piece
            piece = member.decompress(member.unconsumed_tail, 1 << 20)
        data = member.unused_data.lstrip(b"\0")


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records of a file, in order; what is cut off at its end is left out."""
    pieces, held = _unpacked(data), bytearray()

    def have(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    at = 0
    while True:
        if at > 1 << 20:
            del held[:at]
            at = 0
        while have(at + 2) and held[at:at + 2] == b"\r\n":
            at += 2
        stop, look = -1, at
        while stop < 0 and have(look + 1):
            stop = held.find(b"\r\n\r\n", max(at, look - 4))
            look = len(held)
        if stop < 0:
            return
        lines = bytes(held[at:stop]).decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields.get("content-length") or 0)
        if not have(stop + 4 + size):
            return
        yield fields, bytes(held[stop + 4:stop + 4 + size])
        at = stop + 4 + size


FIELDS = ["warc-type", "warc-record-id", "warc-target-uri", "warc-concurrent-to", "warc-refers-to", "warc-payload-digest"]
RECORD = ("kind string, id string, uri string, concurrent string, refers string, digest string, head string, bytes long, sha1 string, "
          "payload binary")


def measured(kind: str | None, digest: str | None, payload: bytes | None) -> tuple[int | None, str | None]:
    """Length and SHA-1 of a response's payload as it was read; an error if the record tells another digest."""
    if kind != "response" or payload is None:
        return None, None
    found = hashlib.sha1(payload).hexdigest()
    if digest and digest.lower().startswith("sha1:") and digest[5:].lower() != found:
        raise ValueError(f"damaged archive: a payload has SHA-1 {found}, its record says {digest}")
    return len(payload), found


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives of a folder: fields, ``head`` (HTTP head or fields), ``payload`` (with ``payloads``),
    its ``bytes`` and ``sha1``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                size = 0
                for fields, block in parse(content.as_py()):
                    head, payload = block, None
                    if fields.get("content-type", "").startswith("application/http"):
                        head, _, payload = block.partition(b"\r\n\r\n")
                    sums = measured(fields.get("warc-type"), fields.get("warc-payload-digest"), payload)
                    rows.append((
                        *[fields.get(f) for f in FIELDS], head.decode("utf-8", "replace"), *sums, payload if payloads else None))
                    size += len(block)
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        names = [part.split()[0] for part in RECORD.split(", ")]
        kinds = {"payload": pa.binary(), "bytes": pa.int64()}
        columns = [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("content")
    return files.mapInArrow(run, RECORD)


def captures(found: DataFrame) -> DataFrame:
    """One nested row per capture: ``request``, ``response`` and ``metadata``, brought together by concurrent-to identifiers.

    A record's capture is the one it names, or for a response or revisit its own. Request and metadata records of one
    capture are reduced to one; responses that share an identifier are as many captures, and equal.
    """
    main, kind = F.col("kind").isin("response", "revisit"), F.col("kind")
    beside = lambda name: F.min(F.when((kind == name) & F.col("concurrent").isNotNull(), F.struct("id", "uri", "head"))).alias(name)
    response = F.struct("kind", "id", "uri", "refers", "digest", "head", "bytes", "sha1", "payload")
    met = found.groupBy(F.when(main, F.col("id")).otherwise(F.col("concurrent")).alias("capture")).agg(
        F.min(F.when(main, response)).alias("response"), F.sum(main.cast("int")).alias("n"), beside("request"), beside("metadata"))
    rows = met.where("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.select("capture", "response", "request", "metadata")


def digests(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every capture of ``found``, by what was read.

    A revisit has the length and digest of the record it refers to; it is an error if its own record tells another
    digest, null if that record is not there.
    """
    rows = written(captures(found).select(
        F.col("response.id").alias("id"), F.col("response.refers").alias("refers"),
        F.regexp_extract("metadata.head", r"(?m)^pageId: *([0-9-]+)", 1).alias("page"), F.col("response.digest").alias("told"),
        F.col("response.bytes").alias("payload_bytes"), F.col("response.sha1").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
    ).withColumn("page_id", F.when(F.col("page") != "", F.col("page")).cast("long")), "captures")
    named = rows.where("record_type = 'response'").groupBy(F.col("id").alias("refers")).agg(
        F.max(F.struct("page_id", "payload_bytes", "payload_digest")).alias("first"))
    wanted = rows.where("refers is not null").select("refers").distinct()
    revisits = rows.where("refers is not null").drop("payload_bytes", "payload_digest").join(
        named.join(wanted, "refers"), "refers", "left")
    # Told in upper or lower case, with or without its name.
    other = F.lower(F.regexp_replace("told", "^sha1:", "")) != F.col("first.payload_digest")
    digest = F.when(other, F.raise_error(F.concat(F.lit("damaged archive: a revisit tells another digest than "), "refers")).cast("string"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return rows.where("refers is null").withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(
        revisits.select(
            "page_id", F.col("first.payload_bytes").alias("payload_bytes"),
            digest.otherwise(F.col("first.payload_digest")).alias("payload_digest"), "record_type",
            F.col("first.page_id").alias("refers_to")))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a folder of their own in the shared folder, read the archives back and sum them up."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/tidemill-warc-{uuid.uuid4().hex}"
    write(pages, folder, **options)
    return digests(read(spark, folder, payloads=False))
