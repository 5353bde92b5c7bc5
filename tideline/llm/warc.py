"""Web archives: legacy ARC records are parsed and rewritten as WARC, with copies as revisits."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import new_folder

#: The fields of a record's header line for each version of the legacy format.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
#: Records of one archive file.
RECORDS = 1000
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(data: bytes) -> bytes:
    """An archive's bytes, unpacked if they are packed."""
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else bytes(data)


def record_id(page: int | None) -> str:
    """The identifier of a page's record, the same whenever it is written."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def arc_start(version: int) -> bytes:
    """The version block that opens a legacy archive and tells how to read the header lines after it."""
    block = b"%d 0 tideline\n%s\n" % (version, " ".join(ARC_FIELDS[version]).encode())
    fields = {"url": "filedesc://pages.arc", "ip": "0.0.0.0", "date": "19700101000000", "type": "text/plain"}
    return arc_line(version, fields, len(block)) + block + b"\n"


def arc_line(version: int, fields: dict[str, str], length: int) -> bytes:
    values = [str(length) if f == "length" else fields.get(f) or "-" for f in ARC_FIELDS[version]]
    return " ".join(values).encode() + b"\n"


def arc_record(version: int, url: str | None, seconds: int, payload: bytes) -> bytes:
    """A page as a legacy record. Blanks and control characters of the address are escaped, as its line needs it."""
    when = datetime.fromtimestamp(seconds, UTC).strftime("%Y%m%d%H%M%S")
    safe = re.sub(r"[\x00-\x20\x7f\x80-\xa0]", lambda m: quote(m[0]), url or "") or "-"
    block = HEAD % len(payload) + payload
    fields = {"url": safe, "ip": "0.0.0.0", "date": when, "type": "text/html", "result": "200", "filename": "pages.arc"}
    return arc_line(version, fields | {"checksum": digest(payload)}, len(block)) + block + b"\n"


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The header fields and block of every record after the version block.

    The version block's first figure decides on the fields of all header lines; the declared length alone decides
    where a block ends, whatever it holds. A cut-off block or a line with other fields is an error.
    """
    at, version = 0, 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.index(b"\n", at)
        values = data[at:end].decode().rstrip("\r").split(" ")
        length = int(values[-1])
        block = data[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ValueError("a record is shorter than its declared length")
        at = end + 1 + length
        if not version:
            if not values[0].startswith("filedesc:"):
                raise ValueError("the archive does not begin with a version block")
            version = int(block.split(b" ", 1)[0])
            continue
        names = ARC_FIELDS[version]
        if len(values) != len(names):
            raise ValueError(f"a header line of version {version} has {len(names)} fields")
        yield dict(zip(names, values)), block


def warc_record(fields: dict[str, str], block: bytes, page: int | None, refers_to: int | None) -> bytes:
    """A legacy record as WARC: identifier, timestamp, type and digests are made up from what the record holds.

    With ``refers_to`` it is a revisit: the head alone is kept, digest and length of the full payload are stated.
    It ends before the two line ends that close a record.
    """
    head, _, payload = block.partition(b"\r\n\r\n")
    head += b"\r\n\r\n"
    when = datetime.strptime(fields["date"], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    kept = head if refers_to is not None else block
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {when}",
        f"WARC-Target-URI: {fields['url']}",
        f"WARC-IP-Address: {fields['ip']}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(kept)}",
        f"X-Payload-Length: {len(payload)}",
        *([] if page is None else [f"X-Page: {page}"]),
        *([] if refers_to is None else [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]),
        *([] if refers_to is None else [f"WARC-Profile: {PROFILE}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(kept)}",
    ]
    return "\r\n".join([*lines, "", ""]).encode() + kept


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record; the block ends by its declared length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no record where one is due")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        begin = end + 4
        at = begin + int(fields["content-length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, data[begin:at]
        at += 4


def with_reference(pages: DataFrame) -> DataFrame:
    """Adds ``refers_to`` to ``page_id``, ``url``, ``html``: the largest page of the same payload, if another one.

    The largest page of each payload is found by a grouping that reduces before the shuffle; payloads that occur once
    drop out of the joined side.
    """
    keyed = pages.withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    largest = keyed.groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    joined = keyed.join(largest.where("n > 1").drop("n"), "digest", "left")
    other = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select("page_id", "url", "html", F.when(other, F.col("largest")).alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", records: int = RECORDS
) -> None:
    """Writes WARC files into ``folder``, a record for each row, the payload its html in UTF-8 (null: empty).

    Each row passes through the legacy format, versions 1 and 2 by turns of the batches: framed, parsed by the
    declared length, converted. Of equal payloads the one with the largest key is the response, others revisit it;
    rows that share that key are all responses. A null key is smaller than any other. Spark's text writer commits the
    files, packed by gzip, with the two line ends after each record as separator; repeated tasks leave nothing behind.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    )

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for n, some in enumerate(batches):
            version = 1 + n % 2
            pages_of = [None if pd.isna(p) else int(p) for p in some["page_id"]]
            refers = [None if pd.isna(p) else int(p) for p in some["refers_to"]]
            out = []
            for page, refer, address, text in zip(pages_of, refers, some["url"], some["html"]):
                legacy = arc_start(version) + arc_record(version, address, (page or 0) % 2**31, text.encode())
                ((fields, block),) = parse_arc(legacy)
                out.append(warc_record(fields, block, page, refer).decode())
            yield pd.DataFrame({"value": out})

    converted = with_reference(rows).withColumns(
        # As text, since a null among numbers would turn them into floats.
        {"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")}
    )
    _save(converted.mapInPandas(convert, "value string"), folder, records)


def _save(archives: DataFrame, folder: str, records: int) -> None:
    archives.write.option("maxRecordsPerFile", records).text(folder, compression="gzip", lineSep="\r\n\r\n")


def convert_archives(spark: SparkSession, source: str, folder: str, records: int = RECORDS) -> None:
    """Converts whole legacy archives (UTF-8) under ``source`` into WARC files in ``folder``; a task reads a file at a time.

    A record's place in its file stands for its identifier. Payloads are not compared with each other.
    """

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for path, data in zip(files["path"], files["content"]):
                found = (
                    warc_record(fields, block, uuid.uuid5(uuid.NAMESPACE_URL, f"{path}#{n}").int >> 65, None)
                    for n, (fields, block) in enumerate(parse_arc(plain(data)))
                )
                yield pd.DataFrame({"value": [r.decode() for r in found]})

    files = spark.read.format("binaryFile").load(source).select("path", "content")
    _save(files.mapInPandas(convert, "value string"), folder, records)


def read_archives(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """A row for each record of the WARC files in ``folder``, with ``payload`` if that is asked for (null: revisit)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for data in files["content"]:
                rows = []
                for fields, block in parse_warc(plain(data)):
                    body = block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
                    stated = fields["warc-payload-digest"].removeprefix("sha1:")
                    if body is not None and digest(body) != stated:
                        raise ValueError("a payload does not have its digest")
                    size = len(body) if body is not None else int(fields["x-payload-length"])
                    rows.append(
                        (
                            fields.get("x-page"),
                            size,
                            stated,
                            fields["warc-type"],
                            fields.get("x-refers-to-page"),
                            fields["warc-target-uri"],
                            fields["warc-date"],
                            body if payload else None,
                        )
                    )
                yield pd.DataFrame(rows, columns=names)

    names = ["page", "payload_bytes", "payload_digest", "record_type", "refers", "url", "date", "payload"]
    schema = "page string, payload_bytes long, payload_digest string, record_type string, refers string, url string, date string, payload binary"
    found = spark.read.format("binaryFile").load(folder).select("content").mapInPandas(parse, schema)
    return found.select(
        F.col("page").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers").cast("long").alias("refers_to"),
        "url",
        "date",
        *(["payload"] if payload else []),
    )


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the archives into a new folder of the shared one and reads them back."""
    folder = new_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, key, url, html)
    return read_archives(pages.sparkSession, folder)
