"""WARC archives with revisit resolution.

Pages are written as WARC/1.1 records, each a gzip member of its own. Of pages with equal payloads of
at least ``MIN_REVISIT`` bytes, the one with the largest page_id is a response; the others are
revisit records, without the payload, that refer to it by digest and record id.

What is shuffled is headers (digest, id, size, url). A payload goes from the scan straight to the
writer unless its digest may be a repeated one, as a bitmap of fixed size tells; of those that may,
the rows that are revisits are taken out by id and digest. Tasks put records together into archives
of about ``ARCHIVE_BYTES``, and Spark's own writer lays these out, one file each, and commits them.
A file ends in a zero byte, which gzip takes for padding.

Reading takes archives of any maker, compressed or not, finds the records by their lengths, digests
each payload anew and joins the revisits with the responses by record id.

``deduplicate`` reads archives, resolves what repeats across all of them and writes new ones with
fresh headers: new record ids, and revisits that refer to the new responses.

Results in special cases: a null html is an empty payload; payloads below the bound are all
responses; rows that repeat the largest page_id of a payload are each a response; null ids count as
the smallest and are read back as null; null urls are read back as null; control characters in urls
are percent-encoded; an empty table makes archives without records; further columns are ignored.
A payload of any length is one record, and a record beyond ``ARCHIVE_BYTES`` an archive by itself;
an archive is read as one row, so it may have 2 GB, compressed, at most. Records without a page
(``warcinfo``, ``request``, ``metadata``) are passed over.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import SLICE_BYTES, join_hot, materialize, may_match, small_batches

MIN_REVISIT = 1000
#: Bytes of records, before compression, in one archive, about.
ARCHIVE_BYTES = 64 << 20
LEVEL = 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_END = "\r\n\r\n"
_CHUNK = 1 << 18
_READ = "page_id bigint, url string, record_id string, record_type string, payload_bytes bigint, payload_digest string, refers_to_id string, payload string"


def _header(name: str, value: Column) -> Column:
    """One header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def headers_of(pages: DataFrame, page_id: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest) of every page."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1("payload")})


def revisits(headers: DataFrame, min_revisit: int = MIN_REVISIT) -> tuple[DataFrame, DataFrame]:
    """Of (page_id, payload_bytes, payload_digest, ...): the rows that are revisits, with ``refers_to``, and the digests repeated (payload_digest, first, n)."""
    large = headers.filter(F.col("payload_bytes") >= min_revisit)
    repeated = large.groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = materialize(repeated.filter("n > 1 AND first IS NOT NULL"), "repeated")
    found = join_hot(large, repeated, "payload_digest", F.col("n"), headers.count())
    return found.filter(~F.col("page_id").eqNullSafe(F.col("first"))).drop("n").withColumnRenamed("first", "refers_to"), repeated


def resolve(pages: DataFrame, page_id: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of every page; revisits have no payload."""
    rows = headers_of(pages, page_id, url_col, html_col)
    heads = materialize(rows.drop("payload"), "headers")
    again, repeated = revisits(heads, min_revisit)
    again = materialize(again, "revisits")
    judged = may_match(rows, repeated, "payload_digest").withColumn("maybe", F.col("maybe") & (F.col("payload_bytes") >= min_revisit))
    # keyed by id and digest, so the copies of one payload go to many tasks
    gone = again.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest")).distinct()
    unsure = judged.filter("maybe").join(gone, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left_anti")
    kind = lambda df, name, to: df.select("page_id", "url", "payload", "payload_bytes", "payload_digest", F.lit(name).alias("record_type"), to.cast("bigint").alias("refers_to"))
    responses = judged.filter("NOT maybe").unionByName(unsure)
    return kind(responses, "response", F.lit(None)).unionByName(kind(again.withColumn("payload", F.lit(None).cast("string")), "revisit", F.col("refers_to")))


def _record_id(page_id: Column, digest: Column, made: str) -> Column:
    """A record's URN, from what it holds and the archive it is made for."""
    h = F.md5(F.concat_ws(" ", F.lit(made), F.coalesce(page_id.cast("string"), F.lit("-")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))


def records(resolved: DataFrame, made: str) -> DataFrame:
    """(value): each resolved page as the text of its record."""
    revisit = F.col("record_type") == "revisit"
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7f]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(_END))
    payload = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    when = lambda c: F.when(revisit, c)
    return resolved.select(
        F.concat(
            F.lit("WARC/1.1\r\n"),
            _header("WARC-Type", F.col("record_type")),
            _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"), made)),
            _header("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
            _header("WARC-Target-URI", url),
            _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            _header("WARC-Profile", when(F.lit(PROFILE))),
            _header("WARC-Refers-To", when(_record_id(F.col("refers_to"), F.col("payload_digest"), made))),
            _header("X-Page-Id", F.col("page_id").cast("string")),
            F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
            (F.octet_length(http) + F.octet_length(payload)).cast("string"),
            F.lit(_END),
            http,
            payload,
            F.lit(_END),
        ).alias("value")
    )


def pack(record: bytes) -> bytes:
    """A record as a gzip member."""
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


def write(resolved: DataFrame, path: str, made: str = "1", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the pages' records as archives under ``path``."""

    small_batches(resolved.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        whole = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])
        for batch in batches:
            for value in batch.column("value"):
                record = value.as_buffer().to_pybytes()
                held.append(pack(record))
                size += len(record)
                if size >= archive_bytes:
                    yield whole()
                    held, size = [], 0
        if held:
            yield whole()

    archives = records(resolved, made).mapInArrow(run, "archive binary")
    archives.select(F.col("archive").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def members(data: bytes) -> Iterator[bytes]:
    """What an archive's gzip members hold, or the archive itself if it is not compressed."""
    view, at, end = memoryview(data), 0, len(data)
    while at < end and data[at] == 0:
        at += 1
    if data[at : at + 2] != b"\x1f\x8b":
        yield data.rstrip(b"\0") if data[-1:] == b"\0" else data
        return
    while at < end:
        member, found = zlib.decompressobj(31), []
        while not member.eof:
            if at >= end:
                raise ValueError("the archive ends inside a record")
            step = view[at : at + _CHUNK]
            found.append(member.decompress(step))
            at += len(step)
        at -= len(member.unused_data)
        yield b"".join(found)
        while at < end and data[at] == 0:
            at += 1


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _hex(digest: str) -> str | None:
    """A SHA-1 label's digits in lower-case hex, be they hex or base 32."""
    kind, _, digits = digest.strip().partition(":")
    if kind.lower() != "sha1":
        return None
    return digits.lower() if len(digits) == 40 else base64.b32decode(digits.upper()).hex()


def parse(data: bytes) -> Iterator[dict]:
    """The pages' records of plain archive bytes: headers of the record, and the payload."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = _fields(lines)
        start = end + 4
        stop = start + int(head["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end at its length")
        at = stop + 4
        if head.get("warc-type") not in ("response", "revisit", "resource"):
            continue
        body, http = start, {}
        if data[start : start + 5] == b"HTTP/":
            cut = data.find(b"\r\n\r\n", start, stop)
            body = cut + 4 if cut >= 0 else stop
            http = _fields(data[start:body].decode("utf-8", "replace").split("\r\n")[1:])
        yield {**head, "http-length": http.get("content-length"), "payload": data[body:stop]}


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Every page's record under ``path``, with the bytes and digest of the full payload; revisits name the record they refer to.

    A response's bytes and digest are taken from the payload that is there; a record whose digest
    says otherwise is an error. Revisits have these of their headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for data in batch.column("content"):
                for member in members(data.as_buffer().to_pybytes()):
                    for record in parse(member):
                        rows.append(_row(record, with_payload))
                        size += 200 + len(rows[-1]["payload"] or "")
                        if size >= SLICE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([(n, pa.int64() if t == "bigint" else pa.string()) for n, t in (c.split() for c in _READ.split(", "))])
    # a scan's partition, and so a batch of files, is bounded by spark.sql.files.maxPartitionBytes and one file
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _READ)


def _row(r: dict, with_payload: bool) -> dict:
    revisit, size, digest = r["warc-type"] == "revisit", len(r["payload"]), hashlib.sha1(r["payload"]).hexdigest()
    said = _hex(r.get("warc-payload-digest", ""))
    if revisit:
        size, digest = int(r["http-length"]) if r["http-length"] else None, said
    elif said not in (None, digest):
        raise ValueError(f"record {r['warc-record-id']} does not hold what its headers say")
    return {
        "page_id": int(r["x-page-id"]) if "x-page-id" in r else None, "url": r.get("warc-target-uri"), "record_id": r["warc-record-id"],
        "record_type": "revisit" if revisit else "response", "payload_bytes": size, "payload_digest": digest, "refers_to_id": r.get("warc-refers-to") if revisit else None,
        "payload": r["payload"].decode("utf-8", "replace") if with_payload and not revisit else None,
    }


def join_revisits(found: DataFrame) -> DataFrame:
    """Add ``refers_to``: the page of the response that a revisit's record id leads to. Only headers are read, once from the archives."""
    heads = materialize(found.drop("payload"), "records")
    asked = heads.filter("record_type = 'revisit'")
    counts = asked.groupBy("refers_to_id").agg(F.count(F.lit(1)).alias("n"))
    responses = heads.filter("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(F.max("page_id").alias("refers_to"))
    targets = materialize(responses.join(counts, "refers_to_id"), "targets")
    led = join_hot(asked, targets, "refers_to_id", F.col("n"), heads.count(), "left").drop("n")
    return heads.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("bigint")).unionByName(led).drop("refers_to_id")


def deduplicate(spark: SparkSession, source: str, target: str, made: str = "2", min_revisit: int = MIN_REVISIT) -> None:
    """Read the archives under ``source`` and write them anew under ``target``, each payload stored once.

    Headers decide; a payload is read once for each record that becomes a response, from the record
    itself or, if that was a revisit, from a response with its digest.
    """
    full = materialize(read(spark, source, with_payload=True), "archives")
    heads = full.drop("payload")
    again, _ = revisits(heads, min_revisit)
    again = materialize(again, "revisits")
    gone = again.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest")).distinct()
    kept = full.join(gone, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left_anti")
    own = kept.filter("payload IS NOT NULL")
    bare = materialize(kept.filter("payload IS NULL").drop("payload"), "bare")
    wanted = bare.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"))
    payloads = full.filter("payload IS NOT NULL").join(wanted, "payload_digest").groupBy("payload_digest", "n").agg(F.first("payload").alias("payload"))
    filled = join_hot(bare, materialize(payloads, "payloads"), "payload_digest", F.col("n"), heads.count()).drop("n")
    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest"]
    responses = own.select(columns).unionByName(filled.select(columns)).withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("bigint")})
    rest = again.select("page_id", "url", F.lit(None).cast("string").alias("payload"), "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to")
    write(responses.unionByName(rest), target, made)
